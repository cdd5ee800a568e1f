"""Text search, nested grouping and document mutations on the three films."""

from pyspark.sql import functions as F

from rillflow.functions import analysed, highlight
from rillflow.operators import aggregates, mutate, relational, search, views
from tests.conftest import ids, rows


def test_inverted_index(films):
    index = {r.token: r.doc_ids for r in search.inverted_index(films, "id", "name").collect()}
    assert index == {
        "operation": [1, 2], "red": [1, 3], "sea": [1, 3], "meigong": [2], "river": [2], "incident": [3]
    }


def test_posting_lists_are_cut_into_blocks(spark):
    df = spark.range(1000).select("id", F.lit("same word").alias("name"))
    index = search.inverted_index(df, "id", "name", span=100)
    assert index.count() == 20 and index.agg(F.max(F.size("doc_ids"))).first()[0] == 100


def test_matches(films):
    scored = {r.id: r.score for r in search.match_any(films, "name", "operation red sea").collect()}
    assert scored == {1: 3, 2: 1, 3: 2}
    assert ids(search.match_all(films, "name", "red sea")) == [1, 3]
    assert ids(search.match_phrase(films, "name", "operation red")) == [1]
    assert ids(search.match_phrase(films, "name", "red operation")) == []
    assert ids(search.match_all(films, "name", "!?")) == []
    assert ids(search.nested_match(films, "actorList", "name", "zhang yi")) == [1, 2]
    assert ids(films.where(relational.nested_term(F.col("actorList"), "name", "zhang yi"))) == [1]


def test_every_match_of_all_words_matches_any(films):
    for text in ("operation red", "sea", "river red"):
        assert set(ids(search.match_all(films, "name", text))) <= set(ids(search.match_any(films, "name", text)))


def test_terms_and_ranges(films):
    name = F.col("name")
    assert ids(films.where(relational.term(name, "operation red sea"))) == [1]
    assert ids(films.where(search.token_term(name, "sea"))) == [1, 3]
    assert ids(films.where(search.token_term(name, "operation red sea"))) == []
    assert ids(films.where(relational.in_range(F.col("doubanScore"), gt=4, lte=8))) == [2, 3]
    actor = relational.nested_term(F.col("actorList"), "name", "zhang han yu")
    assert ids(search.filter_must(films, actor, "name", "red sea")) == [1]
    should = search.filter_should(films, actor, "name", "red sea").orderBy(F.desc("score"))
    assert [r.id for r in should.collect()] == [1, 2]


def test_groups(films):
    top = aggregates.terms_top(films, "actorList", "name", 3).collect()
    assert (top[0].group_key, top[0].doc_count) == ("zhang han yu", 2) and len(top) == 3
    by_avg = aggregates.terms_by_avg(films, "actorList", "name", "doubanScore", 10)
    assert [(r.group_key, r.avg_value) for r in by_avg.collect()] == [
        ("hai qing", 8.5), ("zhang yi", 8.5), ("zhang han yu", 8.25), ("lin na", 5.0)
    ]


def test_search_page(films):
    hits = search.search_page(
        films, "name", "red sea", "id", ["id", "name"],
        condition=relational.in_range(F.col("doubanScore"), gte=5), page_size=1,
        order=[F.col("doubanScore").desc(), F.col("id")],
    )
    assert hits.total.first().total == 2
    assert rows(hits.detail) == [(1, "operation <em>red</em> <em>sea</em>")]


def test_analysis_and_highlight_of_han_text(spark):
    df = spark.createDataFrame([("上海银行", "银行"), ("Sea上sea seas Été", "SEA 上 été")], "text string, query string")
    found = [r.t for r in df.select(analysed(F.col("text")).alias("t")).collect()]
    assert found == [["上", "海", "银", "行"], ["sea", "上", "sea", "seas", "été"]]
    marked = [
        df.where(F.col("query") == q).select(highlight(F.col("text"), q)).first()[0]
        for q in ("银行", "SEA 上 été")
    ]
    assert marked == [
        "上海<em>银</em><em>行</em>", "<em>Sea</em><em>上</em><em>sea</em> seas <em>Été</em>"
    ]


def test_mutations(spark, films):
    changed = mutate.update_where(
        films, relational.nested_term(F.col("actorList"), "name", "lin na"),
        actorList=mutate.with_first_item(F.col("actorList"), "name", "lin nana"),
    )
    assert {r.id: r.actorList[0].name for r in changed.collect()} == {1: "zhang yi", 2: "zhang han yu", 3: "lin nana"}
    hit = F.exists("actorList", lambda a: F.arrays_overlap(analysed(a["name"]), F.array(F.lit("zhang"))))
    assert ids(mutate.delete_where(films, hit)) == [3]
    unknown = mutate.delete_where(films, F.lit(None).cast("boolean"))
    assert ids(unknown) == [1, 2, 3]
    movie = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, movie_name string")
    batch = spark.createDataFrame([("2", "x", 1), ("2", "y", 2), ("3", "z", 1)], "id string, movie_name string, n int")
    last = mutate.last_per_key(batch, ["id"], ["n"]).drop("n")
    assert rows(mutate.put(movie, last, ["id"])) == [("1", "a"), ("2", "y"), ("3", "z")]
    assert rows(mutate.patch(movie, last, ["id"])) == [("1", "a"), ("2", "y")]
    keys = spark.createDataFrame([("2",)], "id string")
    assert rows(mutate.delete_by_key(movie, keys)) == [("1", "a")]
    assert rows(mutate.get_by_key(movie, keys)) == [("2", "b")]


def test_views(spark, films):
    views.publish("rated", films, only=relational.in_range(F.col("doubanScore"), gte=5, lte=8))
    assert ids(spark.table("rated")) == [2, 3]
    views.publish("current", films)
    views.publish("current", films.where("id = 3"))
    assert ids(spark.table("current")) == [3]
