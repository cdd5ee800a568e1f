"""Wide-column scans, filters, loads and mutations."""

from pyspark.sql import functions as F

from rillflow.catalog.records import CELLS, customer_cells, text
from rillflow.catalog.registry import query
from rillflow.operators import keyrange, loads
from rillflow.operators import widecolumn as wc
from rillflow.session import scratch_path


@query("""SELECT CAST(c_custkey AS VARCHAR) AS row_key, c_name AS name,
  CAST(c_nationkey AS VARCHAR) AS nation,
  CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS segment FROM customer""")
def scan_family_rows(t):
    """SRC-10."""
    cells = wc.versions(customer_cells(t), "info")
    return wc.to_rows(cells, ["name", "nation", "segment"])


@query(f"""WITH {CELLS} SELECT * FROM cells WHERE row_key >= '2' AND row_key < '5'""")
def scan_key_range(t):
    """SRC-10: row keys compare by bytes."""
    return wc.scan(customer_cells(t), "info", "2", "5")


@query(f"""WITH {CELLS} SELECT row_key, string_agg(value, '_' ORDER BY qualifier) AS row_text
FROM cells GROUP BY row_key""")
def scan_family_join(t):
    """SRC-11, FUN-14."""
    return wc.row_texts(wc.versions(customer_cells(t), "info"), ["segment", "name", "nation"])


@query(f"WITH {CELLS} SELECT * FROM cells WHERE starts_with(row_key, '20')")
def row_prefix(t):
    """FLT-04."""
    return wc.key_prefix(customer_cells(t), "20")


@query(f"WITH {CELLS} SELECT * FROM cells WHERE regexp_matches(row_key, '7$')")
def row_regex(t):
    """FLT-05."""
    return wc.key_pattern(customer_cells(t), "7$")


@query(f"""WITH {CELLS} SELECT * FROM cells WHERE row_key NOT IN (
  SELECT row_key FROM cells WHERE qualifier = 'segment' AND value <> 'BUILDING')""")
def column_value_filter(t):
    """FLT-06: rows without the column pass."""
    return wc.column_value(customer_cells(t), "info", "segment", "=", "BUILDING")


@query(f"""WITH {CELLS} SELECT * FROM cells WHERE row_key IN (
  SELECT row_key FROM cells WHERE qualifier = 'segment' AND value = 'BUILDING')""")
def column_value_strict(t):
    """FLT-06: the strict form."""
    return wc.column_value(customer_cells(t), "info", "segment", "=", "BUILDING", keep_missing=False)


@query(f"WITH {CELLS} SELECT * FROM cells WHERE starts_with(qualifier, 'n')")
def column_prefix(t):
    """FLT-07."""
    return wc.column_prefix(customer_cells(t), "n")


@query(f"""WITH {CELLS} SELECT * FROM cells WHERE starts_with(qualifier, 'na') AND row_key IN (
  SELECT row_key FROM cells WHERE qualifier = 'segment' AND value = 'BUILDING')""")
def filter_list(t):
    """FLT-08."""
    return wc.row_and_column(customer_cells(t), "info", "segment", "=", "BUILDING", "na")


@query("""SELECT reverse(CAST(s_suppkey AS VARCHAR)) AS row_key, 'info' AS family, q AS qualifier,
  CAST(0 AS BIGINT) AS ts, CASE q WHEN 'name' THEN s_name ELSE CAST(s_nationkey AS VARCHAR) END AS value
FROM supplier, (VALUES ('name'), ('nation')) AS v(q)""")
def reversed_key_put(t):
    """SNK-11, FUN-07."""
    rows = t.supplier.select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    )
    return wc.to_cells(rows, "key", "info", reverse=True)


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS row_key, 'info' AS family, 'name' AS qualifier,
  CAST(0 AS BIGINT) AS ts, s_name AS value FROM supplier""")
def plain_key_put(t):
    """SNK-12."""
    rows = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return wc.to_cells(rows, "key", "info")


@query(r"""SELECT concat(substr(md5(CAST(p_partkey AS VARCHAR)), 1, 3), p_partkey) AS row_key,
  'info' AS family, q AS qualifier, CAST(0 AS BIGINT) AS ts,
  CASE q WHEN 'name' THEN p_name ELSE CAST(p_size AS VARCHAR) END AS value
FROM part, (VALUES ('name'), ('size')) AS v(q)""")
def salted_sorted_load(t):
    """SNK-13, SRT-02, FUN-08."""
    rows = t.part.select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    return wc.sorted_load(rows, "key", "info")


@query("""SELECT CAST(CAST(c_custkey AS VARCHAR) >= '3' AS INTEGER)
  + CAST(CAST(c_custkey AS VARCHAR) >= '6' AS INTEGER)
  + CAST(CAST(c_custkey AS VARCHAR) >= '9' AS INTEGER) AS bucket, count(*) AS cnt
FROM customer GROUP BY bucket""")
def range_buckets(t):
    """DST-01: the split points 3, 6, 9."""
    splits = keyrange.split_keys(3, 10, "0", "10")
    return keyrange.bucket_counts(t.customer.select(text("c_custkey").alias("row_key")), "row_key", splits)


@query(f"""WITH {CELLS} SELECT *, CAST(row_key >= '3' AS INTEGER) + CAST(row_key >= '6' AS INTEGER)
  + CAST(row_key >= '9' AS INTEGER) AS bucket FROM cells""")
def bucketed_load(t):
    """DST-02."""
    return keyrange.bucketed(customer_cells(t), keyrange.split_keys(3, 10, "0", "10"))


@query(r"""WITH salted AS (
  SELECT concat(substr(md5(CAST(p_partkey AS VARCHAR)), 1, 3), p_partkey) AS row_key, p_name, p_size FROM part)
SELECT row_key, 'info' AS family, q AS qualifier, CAST(0 AS BIGINT) AS ts,
  CASE q WHEN 'name' THEN p_name ELSE CAST(p_size AS VARCHAR) END AS value
FROM salted, (VALUES ('name'), ('size')) AS v(q) WHERE row_key >= '4' AND row_key < 'b7'""")
def written_load(t):
    """SNK-13: salted keys written as sorted files, and a key range read back."""
    rows = t.part.select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    path = scratch_path(t.spark, "load")
    loads.write_load(wc.sorted_load(rows, "key", "info"), path)
    return loads.read_range(t.spark, path, "4", "b7")


@query(f"""WITH {CELLS} SELECT *, CAST(row_key >= '3' AS INTEGER) + CAST(row_key >= '6' AS INTEGER)
  + CAST(row_key >= '9' AS INTEGER) AS bucket FROM cells WHERE row_key >= '25' AND row_key < '61'""")
def written_bucket_load(t):
    """DST-02: a folder per bucket, of which a range read opens its own."""
    path, splits = scratch_path(t.spark, "load"), keyrange.split_keys(3, 10, "0", "10")
    loads.write_load(customer_cells(t), path, splits)
    return loads.read_range(t.spark, path, "25", "61", splits)


def _moves(t):
    """Customers with an open order get their segment overwritten."""
    found = t.orders.where(F.col("o_orderstatus") == "O").select(text("o_custkey").alias("row_key")).distinct()
    return found.select(
        "row_key", F.lit("info").alias("family"), F.lit("segment").alias("qualifier"),
        F.lit(2).cast("bigint").alias("ts"), F.lit("MOVED").alias("value"),
    )


MOVES = """moves AS (
  SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS row_key, 'info' AS family, 'segment' AS qualifier,
         CAST(2 AS BIGINT) AS ts, 'MOVED' AS value FROM orders WHERE o_orderstatus = 'O')"""


@query(f"""WITH {CELLS}, {MOVES}
SELECT * FROM moves UNION ALL SELECT * FROM cells
WHERE NOT (qualifier = 'segment' AND row_key IN (SELECT row_key FROM moves))""")
def update_cells(t):
    """MUT-08, MUT-09: the newest version is read."""
    return wc.latest(wc.put_cells(customer_cells(t), _moves(t)))


@query(f"""WITH {CELLS}, {MOVES} SELECT * FROM cells
WHERE NOT (qualifier = 'segment' AND row_key IN (SELECT row_key FROM moves))""")
def delete_cells(t):
    """MUT-10: a column of some rows."""
    return wc.delete_cells(customer_cells(t), _moves(t).select("row_key", "family", "qualifier"))


@query(f"""WITH {CELLS}, {MOVES} SELECT * FROM cells
WHERE row_key NOT IN (SELECT row_key FROM moves)""")
def delete_rows(t):
    """MUT-10: whole rows."""
    return wc.delete_cells(customer_cells(t), _moves(t).select("row_key"))


@query(f"WITH {CELLS}, {MOVES} SELECT * FROM cells")
def delete_newest_version(t):
    """MUT-10: only the newest version goes, the one before comes back."""
    moves = _moves(t)
    versions = wc.put_cells(customer_cells(t), moves)
    return wc.latest(wc.delete_newest(versions, moves))


@query(f"WITH {CELLS} SELECT * FROM cells")
def drop_column_family(t):
    """MUT-11."""
    cells = customer_cells(t)
    other = cells.withColumn("family", F.lit("old"))
    return wc.drop_family(wc.put_cells(cells, other), "old")
