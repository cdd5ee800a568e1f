"""Quality rules of single documents and of lines across the documents of a host.

Normalised lines are hashed and counted by host in distinct texts, so that a page and its exact
copies count once. Lines above the host's limit are page furniture; a document that would lose
most of its words with them is depleted and rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.scratch import saved

SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
# A line is furniture in more than this many texts of a host and more than this share of them.
LINE_TEXTS = 20
LINE_SHARE = 0.01


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once for a row, however often it is used."""
    return F.transform(F.array(value), use)[0]


def text_words(text: Column) -> Column:
    """The words of a text, cut at ASCII white space."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of three that the text holds twice or more."""

    def of_words(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 3)
        hashes = F.transform(
            starts, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        )
        return bound(hashes, of_hashes)

    def of_hashes(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        unique = F.size(F.array_distinct(h)) == F.size(h)
        return F.when(unique, 0).otherwise(bound(placed, of_sorted))

    def of_sorted(s: Column) -> Column:
        def again(x: Column, i: Column) -> Column:
            before, after = F.get(s, i - 1)["h"], F.get(s, i + 1)["h"]
            return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(
                after == x["h"], F.lit(False)
            )

        return bound(F.transform(F.filter(s, again), lambda x: x["p"]), covered)

    def covered(p: Column) -> Column:
        second, third = F.transform(p, lambda x: x + 1), F.transform(p, lambda x: x + 2)
        return F.size(F.array_union(F.array_union(p, second), third))

    return F.when(F.size(words) < 3, 0).otherwise(bound(words, of_words)).cast("bigint")


def word_lines(text: Column) -> Column:
    """The lines of a text that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def base_rules(docs: DataFrame) -> DataFrame:
    """Counts of each document and whether the base rules fail.

    A null text is empty: no words, which fails.
    """
    words, lines = F.col("_words"), F.col("_lines")
    counted = docs.withColumns({
        "_words": text_words(F.col("_text")), "_lines": word_lines(F.col("_text")),
    })
    plain = F.length(F.translate("_text", SPACE_CHARS, ""))
    counts = counted.withColumns({
        "n_words": F.size(words).cast("bigint"),
        "word_chars": plain.cast("bigint"),
        "n_symbols": (F.length("_text") - F.length(F.translate("_text", SYMBOLS, "")))
        .cast("bigint"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
        "n_repeat_words": repeated_words(words),
    }).drop("_words", "_lines")
    few = F.col("n_words") < 50
    return counts.withColumn(
        "base_failed", few | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    )


def normalised(line: Column) -> Column:
    """Lower case, digits as 0, white space as single spaces."""
    plain = F.regexp_replace(F.lower(line), "[0-9]", "0")
    return F.trim(F.regexp_replace(plain, SPACES, " "))


def _keyed(docs: DataFrame, host: str) -> DataFrame:
    """Rows with their host, text and a name for the text."""
    plain = docs.select(
        "doc_id", F.coalesce(host, F.lit("")).alias("_host"),
        F.coalesce("text", F.lit("")).alias("_text"),
    )
    return plain.withColumn("_key", F.xxhash64("_text"))


def _line(line: Column) -> Column:
    return F.xxhash64(normalised(line))


def host_lines(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per host, text and line, with its words in all copies, and the copies of each text."""
    pieces = F.transform(
        word_lines(F.col("_text")),
        lambda x: F.struct(_line(x).alias("line"), F.size(text_words(x)).alias("words")),
    )
    lines = keyed.select("_host", "_key", F.inline(pieces))
    # Copies of a text add up here and are divided out by the reader. The table is read three times.
    lines = lines.groupBy("_host", "_key", "line").agg(F.sum("words").alias("words"))
    copies = keyed.groupBy("_host", "_key").agg(F.count("*").alias("copies"))
    return saved(keyed.sparkSession, lines, "host-lines"), copies


def frequent_lines(lines: DataFrame, copies: DataFrame, texts: int, share: float) -> DataFrame:
    """The lines (_host, line) above the limits."""
    hosts = copies.groupBy("_host").agg(F.count("*").alias("texts"))
    counts = lines.groupBy("_host", "line").agg(F.count("*").alias("found"))
    return (
        counts.where(F.col("found") > texts)
        .join(hosts, "_host")
        .where(F.col("found") > share * F.col("texts"))
        .select("_host", "line")
    )


def without_frequent_lines(
    docs: DataFrame, host: str = "source", texts: int = LINE_TEXTS, share: float = LINE_SHARE
) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and a host column) without the lines above the limits.

    Every such line goes from every text of its host, the first included. All else of a text stays
    as it is, lines without a word too; a null text stays null. Other columns and repeated rows
    stay. An empty table gives an empty one.
    """
    keyed = _keyed(docs, host)
    lines, copies = host_lines(keyed)
    # A text's own lines that go: no more than it has.
    gone = (
        lines.join(frequent_lines(lines, copies, texts, share), ["_host", "line"])
        .groupBy("_host", "_key").agg(F.collect_set("line").alias("_gone"))
    )
    rows = docs.select(
        F.struct("*").alias("_row"), F.coalesce(host, F.lit("")).alias("_host"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_key"),
    ).join(gone, ["_host", "_key"], "left")
    left = F.filter(
        F.split("_row.text", "\n"), lambda x: ~F.array_contains(F.col("_gone"), _line(x))
    )
    text = F.when(F.col("_gone").isNotNull(), F.array_join(left, "\n")).otherwise(F.col("_row.text"))
    return rows.select(*[
        text.alias(c) if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns
    ])


def line_verdicts(
    docs: DataFrame, host: str = "source", texts: int = LINE_TEXTS, share: float = LINE_SHARE
) -> DataFrame:
    """Documents with their base rules, the words of lines above the limits and the verdict.

    ``docs`` has doc_id, text and a host column; a null host is the empty one. Documents without
    a line above the limits lose nothing. Rows that repeat are judged alike. Ties do not matter:
    a line at a limit stays. An empty table gives an empty one.
    """
    keyed = _keyed(docs, host)
    lines, copies = host_lines(keyed)
    frequent = frequent_lines(lines, copies, texts, share)
    removed = (
        lines.join(frequent, ["_host", "line"])
        .groupBy("_host", "_key").agg(F.sum("words").alias("words"))
        .join(copies, ["_host", "_key"])
        .select("_host", "_key", (F.col("words") / F.col("copies")).cast("bigint").alias("_gone"))
    )
    base = base_rules(keyed).drop("_text")
    judged = base.join(removed, ["_host", "_key"], "left").withColumn(
        "n_line_words", F.coalesce("_gone", F.lit(0)).cast("bigint")
    )
    depleted = 2 * F.col("n_line_words") > F.col("n_words")
    return judged.withColumn("kept", ~F.col("base_failed") & ~depleted).drop(
        "_host", "_key", "_gone"
    )


# The same rules for DuckDB.
VERDICT_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), windows AS (
  SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), twice AS (
  SELECT doc_id, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1
), again AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k)
  GROUP BY doc_id
), lines AS (
  SELECT doc_id, host, t, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words,
    trim(regexp_replace(regexp_replace(lower(x), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ',
      'g'), ' ') AS line
  FROM (SELECT doc_id, host, t, unnest(ls) AS x FROM w)
), hosts AS (
  SELECT host, count(DISTINCT t) AS texts FROM d GROUP BY host
), frequent AS (
  SELECT host, line FROM lines JOIN hosts USING (host)
  GROUP BY host, line, texts
  HAVING count(DISTINCT t) > 20 AND count(DISTINCT t) > 0.01 * texts
), gone AS (
  SELECT doc_id, sum(words) AS n FROM lines JOIN frequent USING (host, line) GROUP BY doc_id
), counted AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(gone.n, 0) AS BIGINT) AS n_line_words
  FROM w LEFT JOIN again USING (doc_id) LEFT JOIN gone USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * n_line_words <= n_words AS kept
FROM counted
"""
