"""Native line operators against their SQL and plain Python."""

from collections import Counter

import duckdb
import pytest

from rillflow.llm import linefreq, templates
from tests.llm import tables


def sql_rows(docs, sql, columns):
    frame = docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"})
    db = duckdb.connect()
    db.register("documents", frame)
    return Counter(db.execute(f"SELECT {columns} FROM ({sql})").fetchall())


def rows(df, columns):
    return Counter(tuple(r) for r in df.selectExpr(*columns.split(", ")).collect())


def distinct_documents(spark):
    """The awkward documents without repeated or missing ids, which the SQL takes as keys."""
    return tables.documents(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])


def test_templates_equal_sql(spark):
    docs = distinct_documents(spark).cache()
    columns = "doc_id, text, n_lines, n_dropped, n_dropped_words"
    out = templates.drop_recurring_lines(spark, docs)
    assert rows(out, columns) == sql_rows(docs, templates.TEMPLATE_SQL, columns)


def test_fields_are_generalised(spark):
    data = [(i, f"own words of text number{i} here\nseen by user u{i} on day {i} at noon today ok")
            for i in range(30)]
    data += [(100 + i, f"the quick brown fox jumps over w{chr(97 + i)} lazy dogs all day long now")
             for i in range(25)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    out = {r["doc_id"]: r for r in templates.drop_recurring_lines(spark, docs).collect()}
    # The smallest document keeps the lines of a template.
    assert out[0]["n_dropped"] == 0 and out[100]["n_dropped"] == 0
    assert all(out[i]["text"] == "" for i in range(1, 30))
    assert all(out[100 + i]["text"] == "" for i in range(1, 25))


def test_long_lines_recur_in_two_texts(spark):
    long = "one of the long passages that two quite different documents have word for word"
    ten, nine = "a b c d e f g h i j", "k l m n o p q r s"
    table = "total 1 2 3 4 5 6 7 8 9 10 11 12"
    fields = "order 17 left the house of the old miller near the river at 5 today"
    other = "order 99 left the house of the old miller near the river at 23 today"
    data = [(1, f"first own\n {long}\n{ten}"), (2, f"second own\n{long}\n{nine}\n{table}"),
            (3, f"third own\n{nine}\n{long} \n{table}\n{fields}"), (4, f"fourth own\n{ten}\n{other}"),
            (5, f"second own\n{long}\n{nine}\n{table}")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    out = {r["doc_id"]: r["text"] for r in templates.drop_recurring_lines(spark, docs).collect()}
    assert out == {
        1: data[0][1], 2: f"second own\n{nine}\n{table}", 3: f"third own\n{nine}\n{table}\n{fields}",
        4: "fourth own", 5: f"second own\n{nine}\n{table}",
    }


def test_masks(spark):
    texts = ["  a\tb  c \n\n x1y  z\r\n \n9\x0b", "", "no", "1", " \n ", "é2 ü\n3.5% of it",
             "w" * 50_000 + " 7"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in df.select(templates.masked(df["t"])).collect()]
    plain = [
        "\n".join(" ".join("<*>" if any(c in "0123456789" for c in w) else w for w in x.split())
                  for x in t.split("\n")) for t in texts
    ]
    assert [f.split("\n") for f in found if f] == [
        p.split("\n") for p in plain if p.strip("\n") or "\n" in p]


def test_prose_stays(spark):
    data = [(i, tables.prose(i, 200)) for i in range(60)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    out = templates.drop_recurring_lines(spark, docs).collect()
    assert {r["doc_id"]: r["text"] for r in out} == dict(data)


def test_other_columns_and_repeated_rows_stay(spark):
    docs = tables.documents(spark)
    out = templates.drop_recurring_lines(spark, docs)
    assert out.count() == docs.count()
    assert set(docs.columns) <= set(out.columns)
    kept = Counter(r["line"] for r in out.select("line").collect())
    assert kept == Counter(r["line"] for r in docs.select("line").collect())


def test_templates_of_an_empty_table(spark):
    assert templates.drop_recurring_lines(spark, tables.empty(spark)).count() == 0


COUNTS = (
    "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,"
    " n_line_words, kept"
)


def test_line_verdicts_equal_sql(spark):
    docs = distinct_documents(spark).cache()
    out = linefreq.line_verdicts(docs)
    assert rows(out, COUNTS) == sql_rows(docs, linefreq.VERDICT_SQL, COUNTS)


def plain_counts(text):
    words = (text or "").encode().split()
    runs = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {
        k for i in range(len(words) - 2) if runs[tuple(words[i : i + 3])] > 1 for k in range(i, i + 3)
    }
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        len(words), sum(len(w.decode()) for w in words),
        sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
    )


def test_base_counts_equal_plain_python(spark):
    docs = tables.documents(spark)
    out = linefreq.line_verdicts(docs)
    found = Counter(
        tuple(r) for r in out.select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
        ).collect()
    )
    assert found == Counter((d, *plain_counts(t)) for d, t in tables.pairs_of(docs))


@pytest.mark.parametrize("copies", [1, 30])
def test_depleted_documents_are_rejected(spark, copies):
    menu = "\n".join(f"menu entry number {i} of the page with words" for i in range(9))
    data = [(i, tables.prose(i, 70), "a") for i in range(40)]
    data += [(100 + i, f"{menu}\nonly this is new w{i}", "a") for i in range(25)]
    data += [(200 + i, tables.prose(99, 80), "a") for i in range(copies)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    out = {r["doc_id"]: r["kept"] for r in linefreq.line_verdicts(docs).collect()}
    assert all(out[i] for i in range(40))
    assert not any(out[100 + i] for i in range(25))
    # Exact copies of a text are one text.
    assert all(out[200 + i] for i in range(copies))


def test_verdicts_of_an_empty_table(spark):
    assert linefreq.line_verdicts(tables.empty(spark)).count() == 0


def test_frequent_lines_go_from_every_text(spark):
    """Against a plain count of the different texts of a host that hold a line."""
    import re
    from collections import defaultdict

    docs = tables.documents(spark).cache()

    def name(line):
        return " ".join(re.sub("[0-9]", "0", line.lower()).split(" "))

    found, seen = defaultdict(set), defaultdict(set)
    rows = docs.select("line", "text", "source").collect()
    for r in rows:
        seen[r["source"] or ""].add(r["text"] or "")
        for line in re.split("\n", r["text"] or ""):
            if line.split():
                found[(r["source"] or "", " ".join(name(line).split()))].add(r["text"])
    gone = {k for k, t in found.items() if len(t) > 5 and len(t) > 0.01 * len(seen[k[0]])}
    assert gone
    wanted = {
        r["line"]: None if r["text"] is None else "\n".join(
            x for x in r["text"].split("\n")
            if (r["source"] or "", " ".join(name(x).split())) not in gone or not x.split())
        for r in rows
    }
    out = linefreq.without_frequent_lines(docs, texts=5)
    assert out.columns == docs.columns
    left = {r["line"]: r["text"] for r in out.collect()}
    assert left == wanted and any(left[r["line"]] != r["text"] for r in rows)
    assert linefreq.without_frequent_lines(tables.empty(spark)).count() == 0


def test_changed_copies_are_left(spark):
    base, passage = tables.prose(61, 60), tables.prose(62, 24)
    rows = [
        (1, base), (2, base.rsplit("\n", 1)[0] + "\n" + tables.prose(63, 12)),
        (3, passage), (4, tables.prose(64, 60) + "\n" + passage), (5, None), (6, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    strict, left = (
        {r["doc_id"]: (r["text"], r["n_dropped"], r["n_dropped_words"])
         for r in templates.drop_recurring_lines(spark, docs, leave_copies=x).collect()}
        for x in (False, True)
    )
    assert strict[2] == (tables.prose(63, 12), 4, 48)
    assert left[2] == (rows[1][1], 0, 0)
    # A passage within other text goes in both forms.
    assert strict[4] == left[4] == (tables.prose(64, 60), 2, 24)
    assert all(strict[i] == left[i] for i in (1, 3, 5, 6))


def test_templates_shuffle_hashes_of_words(spark):
    """A word goes between tasks as a hash beside its line's, and the words of a line meet in one number."""
    texts = [(i, f"one two three four five{'' if i % 2 else ' six'} seven eight nine ten eleven {i}") for i in range(6)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = templates.line_templates(spark, templates.masked_lines(docs))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "bit_xor" in plan
    # Three texts share all words; the leading four are constants as well.
    got = {(r["template"], r["constant"]) for r in found.collect()}
    assert sorted(n for _, n in got) == [10, 11]


def test_only_lines_that_do_not_recur_as_they_are_ask_for_shared_words(spark, monkeypatch):
    """Words are exploded and counted in leaves only where a line needs others to have a template."""
    kept = {}

    def saved(session, df, name, codec=None):
        kept[name] = save(session, df, name, codec)
        return kept[name]

    save = templates.saved
    monkeypatch.setattr(templates, "saved", saved)
    same = "here are many words that stand in two texts as they are"
    near = "there was an old miller by the river in the year {} of {} wars"
    mixed = "now comes a long line of which one word is {} in other texts again"
    data = [(i, f"own {i} {tables.prose(i, 12)}\n{same}") for i in range(3)]
    data += [(10 + i, f"{tables.prose(10 + i, 9)}\n" + near.format("one", w)) for i, w in enumerate(("two", "six"))]
    # A leaf with a line in two texts and lines in one.
    data += [(20 + i, f"{tables.prose(20 + i, 9)}\n" + mixed.format(w))
             for i, w in enumerate(("red", "red", "blue", "green"))]
    docs = spark.createDataFrame([(*r, "s") for r in data], "doc_id bigint, text string, source string").cache()
    columns = "doc_id, text, n_lines, n_dropped, n_dropped_words"
    out = templates.drop_recurring_lines(spark, docs)
    assert rows(out, columns) == sql_rows(docs, templates.TEMPLATE_SQL, columns)
    assert kept["held"].where(f"masked = '{same}'").count() == 1
    lines = kept["held"].join(kept["asking"], "leaf", "left_semi").collect()
    assert sorted(r["masked"] for r in lines) == sorted(
        [near.format("one", w) for w in ("two", "six")] + [mixed.format(w) for w in ("red", "blue", "green")]
    )
