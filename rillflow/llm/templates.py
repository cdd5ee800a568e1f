"""Line dedup by a template tree of fixed depth.

A line goes down the tree by its number of words and its leading words; words with a digit are
variable fields from the start. Within a leaf a word further on is constant where enough texts have
it at its place, and a variable field otherwise. What is left is the line's template. Templates
that recur across texts are dropped from every document but the first. How many texts are enough
depends on the line alone: a long one is no chance even in two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm.linefreq import text_words, word_lines
from rillflow.llm.scratch import saved

DEPTH = 4
# A template recurs in this many different texts; exact copies of a text count once.
TEXTS = 20
# With so many constant words it recurs in two.
LONG_WORDS, LONG_TEXTS = 10, 2
# Share of constant words among those without a digit that a template must have.
CONSTANT = 0.85
FIELD = "<*>"
COUNTS = ("n_lines", "n_dropped", "n_dropped_words")
# A table of at most so many small rows may be sent to every executor.
BROADCAST_ROWS = 500_000


def _row(df: DataFrame) -> DataFrame:
    """Rows with a name for the row and one for its text."""
    text = F.coalesce("text", F.lit(""))
    return df.withColumns({
        "_text": text, "_row": F.xxhash64("doc_id", text), "_key": F.xxhash64(text),
    })


def masked(text: Column) -> Column:
    """A text with single spaces in its lines and a field in place of every word with a digit.

    Every step reads the one before once, so that nothing is computed twice.
    """
    for blank in "\t\x0b\x0c\r":
        text = F.replace(text, F.lit(blank), F.lit(" "))
    text = F.regexp_replace(text, " {2,}", " ")
    for edge in (" \n", "\n "):
        text = F.replace(text, F.lit(edge), F.lit("\n"))
    # Matches begin at words only: long words without a digit are looked at once.
    return F.regexp_replace(F.trim(text), "(?<![^ \n])[^ \n0-9]*+[0-9][^ \n]*+", FIELD)


def masked_lines(docs: DataFrame) -> DataFrame:
    """The lines with a word of every row, masked, with their leaf in the tree."""
    lines = _row(docs).select(
        "_row", "_key", "doc_id",
        F.posexplode(F.split(masked(F.col("_text")), "\n")).alias("line_no", "masked"),
    ).where("masked <> ''")
    text = F.col("masked")
    n = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1
    fields = F.size(F.filter(F.split(text, " "), lambda t: t == FIELD))
    return lines.withColumn("n", n).select(
        "_row", "_key", "doc_id", "line_no", "masked", "n",
        F.xxhash64("n", F.substring_index("masked", " ", DEPTH)).alias("leaf"),
        F.xxhash64("masked").alias("line"),
        F.when(text.contains(FIELD), F.col("n") - fields).otherwise(F.col("n")).alias("worded"),
    )


def _checked(table: DataFrame, rows: int | None = None) -> DataFrame:
    """A saved table, marked for broadcast as long as it is small; joins work either way."""
    rows = table.count() if rows is None else rows
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def _enough(words: str, texts: int) -> Column:
    """The texts that make a template of so many constant words recur."""
    return F.when(F.col(words) >= LONG_WORDS, min(LONG_TEXTS, texts)).otherwise(texts)


def line_templates(spark: SparkSession, lines: DataFrame, texts: int = TEXTS) -> DataFrame:
    """The templates of lines longer than the tree is deep, in leaves that recur.

    Gives (leaf, line, template, constant) where enough of the line is constant.
    """
    deep = lines.where(F.col("n") > DEPTH)
    leaves = saved(
        spark,
        deep.select("leaf", "n", "_key").distinct().groupBy("leaf", "n").count()
        .where(F.col("count") >= _enough("n", texts)).select("leaf"),
        "leaves",
    )
    recurrent = deep.join(_checked(leaves), "leaf", "left_semi")
    # A line's text is shuffled once; its different texts are counted by hashes alone.
    counts = recurrent.select("line", "_key").distinct().groupBy("line").agg(F.count("*").alias("texts"))
    held = saved(
        spark,
        recurrent.groupBy("line").agg(*[F.max(c).alias(c) for c in ("leaf", "masked", "n", "worded")])
        .join(counts, "line"),
        "held",
    )
    split = F.split("masked", " ")
    # The leaf tells the leading words, so they need no count. A word is one with its place.
    places = F.transform(split, lambda word, pos: F.struct(word.alias("word"), pos.alias("pos")))
    places = F.filter(places, lambda x: (x["pos"] >= DEPTH) & (x["word"] != FIELD))
    placed = F.transform(places, lambda x: F.xxhash64("leaf", x["pos"], x["word"]))
    # All words of a line that recurs as it is are constant; only other lines ask what they share.
    alone = F.col("texts") >= _enough("n", texts)
    leaf = held.groupBy("leaf").agg(F.count("*").alias("lines"), F.min(alone).alias("settled"))
    asking = saved(
        spark, leaf.where((F.col("lines") > 1) & ~F.col("settled")).select("leaf"), "asking"
    )
    words = held.join(_checked(asking), "leaf", "left_semi").select(
        "line", "n", "texts", alone.alias("alone"), F.explode(placed).alias("word")
    )
    steady = (
        words.groupBy("word").agg(F.sum("texts").alias("seen"), F.max("n").alias("n"))
        .where(F.col("seen") >= _enough("n", texts)).select("word")
    )
    # The words of a line differ by their places, so none cancels another out.
    shared = words.where(~F.col("alone")).select("line", "word").join(steady, "word").groupBy("line").agg(
        F.bit_xor("word").alias("kept"), F.count("*").alias("found")
    )
    leading = F.size(F.filter(F.slice(split, 1, DEPTH), lambda w: w != FIELD))
    whole = F.aggregate(placed, F.lit(0).cast("bigint"), lambda kept, word: kept.bitwiseXOR(word))
    own = held.select(
        "leaf", "line", "worded", leading.alias("leading"), F.when(alone, whole).alias("whole"),
        F.when(alone, F.col("worded") - leading).alias("rest"),
    )
    constant = (F.col("leading") + F.coalesce("rest", "found", F.lit(0))).cast("int")
    return (
        own.join(shared, "line", "left")
        .withColumns({"constant": constant, "kept": F.coalesce("whole", "kept")})
        .where((F.col("constant") > 0) & (F.col("constant") >= CONSTANT * F.col("worded")))
        .select("leaf", "line", F.xxhash64("leaf", F.coalesce("kept", F.lit(0))).alias("template"), "constant")
    )


def drop_recurring_lines(
    spark: SparkSession, docs: DataFrame, texts: int = TEXTS, leave_copies: bool = False
) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with its text without recurring lines.

    A template recurs in ``texts`` different texts, with ten constant words or more in two. The
    document with the smallest doc_id keeps its lines of a template; lines of rows without a
    doc_id go whenever another document has the template. Lines without a word stay, and so do
    lines of digits alone. A null text is empty. Repeated rows are treated alike; rows with the
    same doc_id count as one document. Other columns stay, unless they have the name of a count.
    With ``leave_copies`` a document keeps the lines it shares with fewer than ``texts`` texts if
    they hold over half of its words: it is a changed copy, and whoever looks for those needs it.
    An empty table gives an empty one.
    """
    lines = saved(spark, masked_lines(docs.select("doc_id", "text")), "lines", "zstd")
    long = _checked(saved(spark, line_templates(spark, lines, texts), "templates"))
    short = F.when((F.col("n") <= DEPTH) & (F.col("worded") > 0), F.xxhash64("leaf", "line"))
    named = (
        lines.drop("masked").join(long, ["leaf", "line"], "left")
        .select(
            "_row", "_key", "doc_id", "line_no", "n", F.coalesce("template", short).alias("template"),
            F.coalesce("constant", "worded").alias("constant"),
        )
        .where("template IS NOT NULL")
    )
    recurring = saved(
        spark,
        named.groupBy("template", "constant", "_key").agg(F.min("doc_id").alias("doc_id"))
        .groupBy("template", "constant")
        .agg(F.count("*").alias("found"), F.min("doc_id").alias("first"))
        .where((F.col("found") >= _enough("constant", texts)) & F.col("first").isNotNull())
        .select("template", "first", (F.col("found") < texts).alias("few")),
        "recurring",
    )
    lost = (
        named.join(_checked(recurring), "template")
        .where(~F.col("doc_id").eqNullSafe(F.col("first")))
        .groupBy("_row", "line_no", "n").agg(F.min("few").alias("few"))
    )
    dropped = saved(
        spark,
        lost.groupBy("_row").agg(
            F.collect_list("line_no").alias("_dropped"), F.sum("n").alias("_lost"),
            F.collect_list(F.when(~F.col("few"), F.col("line_no"))).alias("_common"),
            F.coalesce(F.sum(F.when(F.col("few"), F.col("n"))), F.lit(0)).alias("_few"),
        ),
        "dropped",
    )
    places = dropped.agg(F.coalesce(F.sum(F.size("_dropped")), F.lit(0))).first()[0]
    others = [c for c in docs.columns if c not in ("doc_id", "text", *COUNTS)]
    own = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in others]).alias("_other"))
    if not others:
        own = docs.select("doc_id", "text")
    rows = _row(own).join(_checked(dropped, places), "_row", "left")
    if leave_copies:
        copy = (F.col("_few") > 0) & (2 * F.col("_few") > F.size(text_words(F.col("_text"))))
        rows = rows.withColumn("_copy", F.coalesce(copy, F.lit(False))).withColumns({
            "_dropped": F.when(F.col("_copy"), F.col("_common")).otherwise(F.col("_dropped")),
            "_lost": F.col("_lost") - F.when(F.col("_copy"), F.col("_few")).otherwise(0),
        })
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_dropped"))
    rest = F.array_join(F.transform(left, lambda i: F.get(F.col("_lines"), i)), "\n")
    gone = F.size("_dropped") > 0
    counts = rows.withColumn("_lines", F.split("_text", "\n")).select(
        "doc_id", F.when(gone, rest).otherwise(F.col("_text")).alias("text"),
        *([F.col("_other")] if others else []),
        F.size(word_lines(F.col("_text"))).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.coalesce("_lost", F.lit(0)).cast("bigint").alias("n_dropped_words"),
    )
    return counts.select("doc_id", "text", *([F.col("_other.*")] if others else []), *COUNTS)


_ENOUGH = f"CASE WHEN {{0}} >= {LONG_WORDS} THEN {LONG_TEXTS} ELSE {TEXTS} END"
# The same rules for DuckDB.
TEMPLATE_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS ls
  FROM documents
), l AS (
  SELECT doc_id, t, i, list_extract(ls, i) AS raw
  FROM (SELECT doc_id, t, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)
), m AS (
  SELECT *, regexp_replace(trim(regexp_replace(raw, '[\x20\x09-\x0D]+', ' ', 'g'), ' '),
    '[^ ]*[0-9][^ ]*', '{FIELD}', 'g') AS masked
  FROM l WHERE regexp_matches(raw, '[^\x20\x09-\x0D]')
), w AS (
  SELECT *, string_split(masked, ' ') AS ws,
    len(list_filter(string_split(masked, ' '), lambda x: x <> '{FIELD}')) AS worded,
    list_concat([CAST(len(string_split(masked, ' ')) AS VARCHAR)],
      string_split(masked, ' ')[1:{DEPTH}]) AS leaf
  FROM m
), leaves AS (
  SELECT leaf FROM w WHERE len(ws) > {DEPTH} GROUP BY leaf
  HAVING count(DISTINCT t) >= {_ENOUGH.format("any_value(len(ws))")}
), held AS (
  SELECT leaf, masked, worded, ws, count(DISTINCT t) AS texts FROM w JOIN leaves USING (leaf)
  WHERE len(ws) > {DEPTH} GROUP BY leaf, masked, worded, ws
), words AS (
  SELECT leaf, masked, worded, len(ws) AS n, texts, p, ws[p] AS word
  FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS p FROM held)
  WHERE ws[p] <> '{FIELD}'
), steady AS (
  SELECT leaf, p, word FROM words WHERE p > {DEPTH} GROUP BY leaf, p, word
  HAVING sum(texts) >= {_ENOUGH.format("any_value(n)")}
), constant AS (
  SELECT words.* FROM words JOIN steady USING (leaf, p, word) WHERE p > {DEPTH}
  UNION ALL SELECT * FROM words WHERE p <= {DEPTH}
), long AS (
  SELECT leaf, masked, list((p, word) ORDER BY p)::VARCHAR AS template, count(*) AS constant
  FROM constant
  GROUP BY leaf, masked, worded HAVING count(*) >= {CONSTANT} * worded
), named AS (
  SELECT w.doc_id, w.t, w.i, w.leaf::VARCHAR || coalesce(long.template, w.masked) AS template,
    coalesce(long.constant, w.worded) AS constant
  FROM w LEFT JOIN long USING (leaf, masked)
  WHERE long.template IS NOT NULL OR (len(ws) <= {DEPTH} AND worded > 0)
), recurring AS (
  SELECT template, min(doc_id) AS first FROM named GROUP BY template
  HAVING count(DISTINCT t) >= {_ENOUGH.format("any_value(constant)")}
), gone AS (
  SELECT DISTINCT doc_id, t, i FROM named JOIN recurring USING (template) WHERE doc_id <> first
)
SELECT l.doc_id,
  coalesce(string_agg(raw, chr(10) ORDER BY l.i) FILTER (gone.i IS NULL), '') AS text,
  count(*) FILTER (regexp_matches(raw, '[^\x20\x09-\x0D]')) AS n_lines,
  count(gone.i) AS n_dropped,
  CAST(coalesce(sum(words) FILTER (gone.i IS NOT NULL), 0) AS BIGINT) AS n_dropped_words
FROM (
  SELECT *, len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')) AS words FROM l
) l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.t = gone.t AND l.i = gone.i
GROUP BY l.doc_id
"""
