"""Text search, grouping and mutation of documents."""

from pyspark.sql import functions as F

from rillflow.catalog.records import MOVIES, movies
from rillflow.catalog.registry import ORACLES, query
from rillflow.functions import analysed, highlight
from rillflow.functions.sqltext import register_text_functions
from rillflow.operators import aggregates, indexed, mutate, relational, search, views
from rillflow.session import scratch_path

# The oracle's analysis of a text: the same runs of letters, marks and digits.
TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+')"
DOCS = f"docs AS (SELECT *, {TOKENS} AS tokens FROM documents)"
QUERY = "The token and"


@query(f"""WITH {DOCS}, each AS (SELECT DISTINCT doc_id, unnest(tokens) AS token FROM docs)
SELECT token, doc_id // 65536 AS block, array_to_string(list(doc_id ORDER BY doc_id), ' ') AS doc_ids
FROM each GROUP BY token, block""")
def inverted_index(t):
    """SCH-10, SCH-05."""
    index = search.inverted_index(t.documents, "doc_id", "text")
    ids = F.array_join(F.transform("doc_ids", lambda i: i.cast("string")), " ")
    return index.select("token", "block", ids.alias("doc_ids"))


@query(f"""WITH {DOCS}, scored AS (
  SELECT doc_id, CAST(list_contains(tokens, 'the') AS INTEGER)
    + CAST(list_contains(tokens, 'token') AS INTEGER) + CAST(list_contains(tokens, 'and') AS INTEGER)
    AS score FROM docs)
SELECT doc_id, score FROM scored WHERE score > 0""")
def match_or_scored(t):
    """SCH-01."""
    return search.match_any(t.documents, "text", QUERY).select("doc_id", "score")


@query(f"""WITH {DOCS} SELECT doc_id FROM docs
WHERE list_has_all(tokens, ['the', 'token', 'and'])""")
def match_and(t):
    """SCH-02."""
    return search.match_all(t.documents, "text", QUERY).select("doc_id")


@query(f"""WITH {DOCS} SELECT doc_id FROM docs
WHERE contains(concat(' ', array_to_string(tokens, ' '), ' '), ' of the ')""")
def match_phrase(t):
    """SCH-03."""
    return search.match_phrase(t.documents, "text", "of the").select("doc_id")


def _index(t) -> indexed.TextIndex:
    return indexed.build_index(
        t.documents, "doc_id", "text", "documents_index", scratch_path(t.spark, "index")
    )


@query(ORACLES["match_or_scored"])
def index_match(t):
    """SCH-10, SCH-01: the same hits from the buckets of a saved index."""
    return indexed.index_match(_index(t), QUERY)


@query(ORACLES["match_and"])
def index_match_all(t):
    """SCH-10, SCH-02."""
    return indexed.index_match_all(_index(t), QUERY)


@query(ORACLES["match_phrase"])
def index_phrase(t):
    """SCH-10, SCH-03: positions of a saved index, joined."""
    return indexed.index_phrase(_index(t), "of the")


@query(f"""WITH {DOCS}, sizes AS (SELECT doc_id, coalesce(len(tokens), 0) AS length, tokens FROM docs),
whole AS (SELECT count(*) AS documents, avg(length) AS mean FROM sizes),
hits AS (
  SELECT doc_id, length, token, len(list_filter(tokens, lambda x: x = token)) AS found
  FROM sizes, (SELECT unnest(['the', 'token', 'and']) AS token) WHERE list_contains(tokens, token)),
holding AS (SELECT token, count(*) AS holding FROM hits GROUP BY token)
SELECT doc_id, round(sum(ln(1 + (documents - holding + 0.5) / (holding + 0.5)) * found * 2.2
  / (found + 1.2 * (0.75 * length / mean + 0.25))), 6) AS score
FROM hits JOIN holding USING (token), whole GROUP BY doc_id""")
def match_ranked(t):
    """SCH-01: scored by rarity and length, by the published formula, from a saved index."""
    ranked = indexed.index_ranked(_index(t), QUERY)
    return ranked.select("doc_id", F.round("score", 6).alias("score"))


@query("SELECT doc_id, text, n_chars FROM documents")
def match_everything(t):
    """SCH-09."""
    return t.documents.select("doc_id", "text", "n_chars")


@query(f"""WITH {DOCS} SELECT doc_id, len(tokens) AS tokens, len(list_distinct(tokens)) AS distinct_tokens
FROM docs""")
def analysed_lengths(t):
    """SCH-05."""
    tokens = analysed(F.col("text"))
    return t.documents.select(
        "doc_id", F.size(tokens).cast("bigint").alias("tokens"),
        F.size(F.array_distinct(tokens)).cast("bigint").alias("distinct_tokens"),
    )


@query("""SELECT p_partkey, regexp_replace(p_name, '\\b(red|bolt)\\b', '<em>\\1</em>', 'g') AS p_name
FROM part""", name="highlight")
def highlighted(t):
    """SCH-06."""
    return t.part.select("p_partkey", highlight(F.col("p_name"), "Red bolt").alias("p_name"))


@query(f"""WITH {MOVIES} SELECT id FROM movies
WHERE list_has_any(string_split(array_to_string(actors, ' '), ' '), ['red', 'economy'])""")
def nested_match(t):
    """SCH-04."""
    return search.nested_match(movies(t), "actorList", "name", "red economy").select("id")


@query(f"WITH {MOVIES} SELECT id FROM movies WHERE list_contains(actors, 'red economy')")
def nested_term(t):
    """FLT-09 on an array of objects."""
    found = relational.nested_term(F.col("actorList"), "name", "red economy")
    return movies(t).where(found).select("id")


@query(f"WITH {MOVIES} SELECT id FROM movies WHERE name = 'red bolt'")
def term_exact(t):
    """FLT-09."""
    return movies(t).where(relational.term(F.col("name"), "red bolt")).select("id")


@query(f"WITH {MOVIES} SELECT id FROM movies WHERE name LIKE 'red %'")
def token_term(t):
    """FLT-10."""
    return movies(t).where(search.token_term(F.col("name"), "red")).select("id")


@query(f"""WITH {MOVIES} SELECT id, "doubanScore" FROM movies
WHERE "doubanScore" > 4 AND "doubanScore" <= 8""")
def range_filter(t):
    """FLT-11."""
    return movies(t).where(relational.in_range(F.col("doubanScore"), gt=4, lte=8)).select("id", "doubanScore")


SCORE = """CAST(name LIKE 'red %' AS INTEGER) + CAST(name LIKE '% bolt' AS INTEGER)"""


@query(f"""WITH {MOVIES} SELECT id, {SCORE} AS score FROM movies
WHERE list_contains(actors, 'economy') AND {SCORE} > 0""")
def bool_filter_must(t):
    """FLT-12."""
    condition = relational.nested_term(F.col("actorList"), "name", "economy")
    return search.filter_must(movies(t), condition, "name", "red bolt").select("id", "score")


@query(f"""WITH {MOVIES} SELECT id, {SCORE} AS score FROM movies WHERE list_contains(actors, 'economy')""")
def bool_filter_should(t):
    """FLT-13."""
    condition = relational.nested_term(F.col("actorList"), "name", "economy")
    return search.filter_should(movies(t), condition, "name", "red bolt").select("id", "score")


@query(f"""WITH {MOVIES}, each AS (SELECT DISTINCT id, unnest(actors) AS group_key FROM movies)
SELECT group_key, count(*) AS doc_count FROM each GROUP BY group_key
ORDER BY doc_count DESC, group_key LIMIT 3""")
def terms_top(t):
    """AGG-12, SRT-04."""
    return aggregates.terms_top(movies(t), "actorList", "name", 3)


BY_AVG = """SELECT group_key, count(*) AS doc_count,
  CAST(sum(CAST(weight AS DECIMAL(28,10))) AS DOUBLE) / count(weight) AS avg_value
FROM each GROUP BY group_key ORDER BY avg_value DESC, group_key LIMIT 10"""
EACH = """each AS (
  SELECT DISTINCT id, "doubanScore" / 7 AS weight, unnest(actors) AS group_key FROM matched)"""


def _weighed(t):
    """Movies with a measure of many decimals."""
    return movies(t).withColumn("weight", F.col("doubanScore") / 7)


@query(f"WITH {MOVIES}, matched AS (SELECT * FROM movies), {EACH} {BY_AVG}")
def terms_by_avg(t):
    """AGG-13."""
    return aggregates.terms_by_avg(_weighed(t), "actorList", "name", "weight", 10)


@query(f"""WITH {MOVIES}, matched AS (
  SELECT * FROM movies WHERE name LIKE 'red %' OR name LIKE '% bolt'), {EACH} {BY_AVG}""")
def terms_by_avg_matched(t):
    """AGG-14: grouping in SQL over a view of the matching documents."""
    matched = search.match_any(_weighed(t), "name", "red bolt")
    aggregates.nested_groups(matched, "actorList", "name").createOrReplaceTempView("matched_movies")
    return t.spark.sql("""
        SELECT group_key, count(*) AS doc_count,
               CAST(sum(CAST(weight AS DECIMAL(28,10))) AS DOUBLE) / count(weight) AS avg_value
        FROM matched_movies GROUP BY group_key ORDER BY avg_value DESC, group_key LIMIT 10""")


@query(ORACLES["terms_by_avg_matched"])
def terms_by_avg_in_sql(t):
    """AGG-14: match and grouping in one statement."""
    register_text_functions(t.spark)
    _weighed(t).createOrReplaceTempView("weighed_movies")
    return t.spark.sql("""
        SELECT group_key, count(*) AS doc_count,
               CAST(sum(CAST(weight AS DECIMAL(28,10))) AS DOUBLE) / count(weight) AS avg_value
        FROM weighed_movies LATERAL VIEW explode(array_distinct(actorList.name)) AS group_key
        WHERE match(name, 'red bolt')
        GROUP BY group_key ORDER BY avg_value DESC, group_key LIMIT 10""")


@query(f"""WITH {DOCS} SELECT doc_id,
  CAST(list_contains(tokens, 'the') AS INTEGER) + CAST(list_contains(tokens, 'token') AS INTEGER) AS score,
  list_has_all(tokens, ['the', 'token']) AS every_token,
  contains(concat(' ', array_to_string(tokens, ' '), ' '), ' of the ') AS phrase
FROM docs WHERE list_has_any(tokens, ['the', 'token'])""")
def match_in_sql(t):
    """SCH-01, SCH-02, SCH-03 as functions of SQL."""
    register_text_functions(t.spark)
    t.documents.createOrReplaceTempView("searched_documents")
    return t.spark.sql("""
        SELECT doc_id, match_score(text, 'The token') AS score, match_all(text, 'The token') AS every_token,
               match_phrase(text, 'of the') AS phrase
        FROM searched_documents WHERE match(text, 'The token')""")


@query(f"""WITH {MOVIES}
SELECT id, regexp_replace(name, '\\b(red|bolt)\\b', '<em>\\1</em>', 'g') AS name, "doubanScore",
       {SCORE} AS score FROM movies WHERE "doubanScore" >= 5 AND {SCORE} > 0
ORDER BY "doubanScore" DESC, id LIMIT 10 OFFSET 10""")
def search_page(t):
    """SCH-07: filter, match, highlight, sort and the second page."""
    hits = search.search_page(
        movies(t), "name", "red bolt", "id", ["id", "name", "doubanScore", "score"],
        condition=relational.in_range(F.col("doubanScore"), gte=5),
        order=[F.col("doubanScore").desc(), F.col("id").asc()], page_no=2, page_size=10,
    )
    return hits.detail


# -- mutations ------------------------------------------------------------------------

PART = "part_names AS (SELECT p_partkey AS id, p_name AS movie_name, p_size AS size FROM part)"
RETURNED = """batch AS (
  SELECT l_partkey AS id, concat('returned ', max(l_shipdate)::DATE) AS movie_name
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey)"""


def _parts(t):
    return t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("movie_name"), F.col("p_size").alias("size")
    )


def _returned(t):
    """One write per returned line; the last one of a part wins."""
    lines = t.lineitem.where(F.col("l_returnflag") == "R").select(
        F.col("l_partkey").alias("id"), "l_shipdate",
        F.concat(F.lit("returned "), F.col("l_shipdate").cast("date").cast("string")).alias("movie_name"),
    )
    return mutate.last_per_key(lines, ["id"], ["l_shipdate"]).drop("l_shipdate")


@query(f"""WITH {PART}, {RETURNED}
SELECT id, movie_name, size FROM part_names WHERE id NOT IN (SELECT id FROM batch)
UNION ALL SELECT id, movie_name, CAST(NULL AS INTEGER) FROM batch""")
def put_documents(t):
    """MUT-01, MUT-06: whole replacement."""
    return mutate.put(_parts(t), _returned(t).withColumn("size", F.lit(None).cast("int")), ["id"])


@query(f"""WITH {PART}, {RETURNED}
SELECT p.id, coalesce(b.movie_name, p.movie_name) AS movie_name, size
FROM part_names p LEFT JOIN batch b ON b.id = p.id""")
def patch_documents(t):
    """MUT-02: partial update."""
    return mutate.patch(_parts(t), _returned(t), ["id"])


# Every line item is a mutation of its part, in order of its order.
LOG = """log AS (
  SELECT l_partkey AS id, l_orderkey * 10 + l_linenumber AS seq,
    CASE WHEN l_linenumber = 6 THEN 'delete' WHEN l_orderkey % 3 = 0 THEN 'put' ELSE 'patch' END AS op,
    CASE WHEN l_linenumber = 2 THEN NULL ELSE concat('line ', l_orderkey) END AS movie_name,
    CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE CAST(l_orderkey % 50 AS INTEGER) END AS size
  FROM lineitem)"""


def _part_log(t):
    number = F.col("l_linenumber")
    return t.lineitem.select(
        F.col("l_partkey").alias("id"), (F.col("l_orderkey") * 10 + number).alias("seq"),
        F.when(number == 6, mutate.DELETE).when(F.col("l_orderkey") % 3 == 0, mutate.PUT)
        .otherwise(mutate.PATCH).alias("op"),
        F.when(number != 2, F.concat(F.lit("line "), F.col("l_orderkey").cast("string"))).alias("movie_name"),
        F.when(number % 2 != 0, (F.col("l_orderkey") % 50).cast("int")).alias("size"),
    )


@query(f"""WITH {PART}, {LOG}, whole AS (
  SELECT id, max(seq) FILTER (op <> 'patch') AS base,
    coalesce(arg_max(op, seq) FILTER (op <> 'patch'), 'put') AS kind FROM log GROUP BY id
), start AS (
  SELECT coalesce(p.id, w.id) AS id, w.base,
    CASE WHEN w.base IS NULL THEN p.movie_name ELSE l.movie_name END AS movie_name,
    CASE WHEN w.base IS NULL THEN p.size ELSE l.size END AS size
  FROM part_names p FULL JOIN whole w ON w.id = p.id LEFT JOIN log l ON l.id = w.id AND l.seq = w.base
  WHERE coalesce(w.kind, 'put') = 'put' AND (p.id IS NOT NULL OR w.base IS NOT NULL)
), late AS (
  SELECT s.id, arg_max(l.movie_name, l.seq) FILTER (l.movie_name IS NOT NULL) AS movie_name,
    arg_max(l.size, l.seq) FILTER (l.size IS NOT NULL) AS size
  FROM start s JOIN log l ON l.id = s.id AND l.op = 'patch' AND l.seq > coalesce(s.base, -1) GROUP BY s.id
)
SELECT s.id, coalesce(late.movie_name, s.movie_name) AS movie_name, coalesce(late.size, s.size) AS size
FROM start s LEFT JOIN late ON late.id = s.id""")
def mutation_log(t):
    """MUT-01, MUT-02, MUT-04, MUT-06: puts, patches and deletes in order, as a new version."""
    path = scratch_path(t.spark, "parts")
    mutate.apply_log(_parts(t), _part_log(t), ["id"], ["seq"]).write.parquet(path)
    # Readers switch to the new version by name.
    views.publish("current_parts", t.spark.read.parquet(path))
    return t.spark.sql("SELECT id, movie_name, size FROM current_parts")


REPEATED = """batch AS (
  SELECT l_partkey AS id, concat('returned ', l_orderkey) AS movie_name, CAST(l_orderkey % 50 AS INTEGER) AS size,
    l_orderkey * 10 + l_linenumber AS seq FROM lineitem WHERE l_returnflag = 'R')"""


def _repeated(t):
    """Returned lines as they come: a part may be written many times."""
    return t.lineitem.where("l_returnflag = 'R'").select(
        F.col("l_partkey").alias("id"),
        F.concat(F.lit("returned "), F.col("l_orderkey").cast("string")).alias("movie_name"),
        (F.col("l_orderkey") % 50).cast("int").alias("size"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
    )


@query(f"""WITH {PART}, {REPEATED}
SELECT id, movie_name, size FROM part_names WHERE id NOT IN (SELECT id FROM batch)
UNION ALL SELECT id, arg_max(movie_name, seq), arg_max(size, seq) FROM batch GROUP BY id""")
def put_repeated_keys(t):
    """MUT-01, MUT-06: a batch that repeats its keys; the last write wins."""
    return mutate.put(_parts(t), _repeated(t), ["id"], ["seq"])


@query(f"""WITH {PART}, {REPEATED}, last AS (
  SELECT id, arg_max(movie_name, seq) AS movie_name,
    arg_max(size, seq) FILTER (size % 2 = 0) AS size FROM batch GROUP BY id)
SELECT p.id, coalesce(b.movie_name, p.movie_name) AS movie_name, coalesce(b.size, p.size) AS size
FROM part_names p LEFT JOIN last b ON b.id = p.id""")
def patch_repeated_keys(t):
    """MUT-02: the last value of every column that is not null."""
    batch = _repeated(t).withColumn("size", F.when(F.col("size") % 2 == 0, F.col("size")))
    return mutate.patch(_parts(t), batch, ["id"], ["seq"])


@query(f"""WITH {PART} SELECT id, CASE WHEN movie_name = 'red bolt' THEN 'blue bolt' ELSE movie_name END
AS movie_name, size FROM part_names""")
def update_by_query(t):
    """MUT-03."""
    return mutate.update_where(
        _parts(t), F.col("movie_name") == "red bolt", movie_name=F.lit("blue bolt")
    )


@query(f"""WITH {MOVIES} SELECT id, CASE WHEN list_contains(actors, 'economy') THEN 'renamed'
ELSE actors[1] END AS first_actor, actors[2] AS second_actor FROM movies""")
def update_first_item(t):
    """MUT-03: the first element of the array."""
    condition = relational.nested_term(F.col("actorList"), "name", "economy")
    new = mutate.with_first_item(F.col("actorList"), "name", "renamed")
    changed = mutate.update_where(movies(t), condition, actorList=new)
    return changed.select(
        "id", F.col("actorList")[0]["name"].alias("first_actor"),
        F.col("actorList")[1]["name"].alias("second_actor"),
    )


@query("""SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def delete_by_id(t):
    """MUT-04."""
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")
    keys = urgent.select(F.col("o_custkey").alias("c_custkey"))
    return mutate.delete_by_key(t.customer.select("c_custkey", "c_name"), keys)


@query(f"""WITH {MOVIES} SELECT id, name FROM movies
WHERE NOT list_has_any(string_split(array_to_string(actors, ' '), ' '), ['red', 'economy'])""")
def delete_by_query(t):
    """MUT-05."""
    hit = F.exists("actorList", lambda a: F.arrays_overlap(
        analysed(a["name"]), F.array(F.lit("red"), F.lit("economy"))
    ))
    return mutate.delete_where(movies(t), hit).select("id", "name")


@query("""SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def get_by_id(t):
    """MUT-07."""
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")
    keys = urgent.select(F.col("o_custkey").alias("c_custkey"))
    return mutate.get_by_key(t.customer.select("c_custkey", "c_name"), keys)


# -- views ----------------------------------------------------------------------------


@query(f"""WITH {MOVIES} SELECT id, name FROM movies WHERE "doubanScore" BETWEEN 5 AND 8""")
def filtered_view(t):
    """ALS-02."""
    views.publish("rated_movies", movies(t), only=relational.in_range(F.col("doubanScore"), gte=5, lte=8))
    return t.spark.sql("SELECT id, name FROM rated_movies")


@query("""SELECT c_custkey AS id, c_name AS name, CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""")
def united_view(t):
    """ALS-01: tables of different columns behind one name."""
    views.publish(
        "partners",
        t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
        t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                          F.col("s_acctbal").alias("balance")),
    )
    return t.spark.sql("SELECT id, name, balance FROM partners")


@query("SELECT s_suppkey AS id, s_name AS name FROM supplier")
def switched_view(t):
    """ALS-03: the name moves from one table to the other in one step."""
    views.publish("current_partners", t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")))
    views.publish("current_partners", t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))
    return t.spark.sql("SELECT id, name FROM current_partners")
