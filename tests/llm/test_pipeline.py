"""The pipeline stage by stage on a small table."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from rillflow.llm.arrow import map_batches
from tests.llm import tables

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def write_tables(spark, path):
    clean = [(i, tables.prose(i, 60 + i)) for i in range(90)]
    shout = [(200 + i, tables.prose(200 + i, 80).upper().replace(" ", "!! ")) for i in range(60)]
    copies = [(300 + i, tables.changed(clean[5][1], i, 1)) for i in range(10)]
    leaks = [(400, tables.prose(9000, 40) + "\n" + tables.prose(8000, 30))]
    notes = [(500 + i, tables.prose(500 + i, 70) + "\nall rights reserved") for i in range(30)]
    awkward = [(None, "one row without an id " * 5), (600, None), (601, "")]
    rows = clean + shout + copies + leaks + notes + awkward
    df = spark.createDataFrame(
        [(d, t, "en", f"s{i % 3}", None if t is None else len(t), i, "k")
         for i, (d, t) in enumerate(rows)],
        f"{tables.DOCUMENTS}, component_id int, key string",
    )
    df.write.parquet(f"{path}/documents.parquet")
    labels = [(d, int(d < 200), 0) for d, _ in clean + shout]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet")
    spark.createDataFrame([(1, tables.prose(8000, 30))], "item_id bigint, text string").write.parquet(
        f"{path}/benchmark.parquet")
    return df


def test_stages(spark, tmp_path):
    df = write_tables(spark, str(tmp_path))
    docs, left = df, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == COLUMNS
        left[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert not any(200 <= (d or 0) < 260 for d in left["quality"])
    assert set(range(90)) <= set(left["quality"])
    # The footer stays in the first document that has it.
    assert left["line_dedup"][500].endswith("all rights reserved")
    assert not any(left["line_dedup"][500 + i].endswith("reserved") for i in range(1, 30))
    assert 5 in left["near_dedup"] and not any(300 <= (d or 0) < 310 for d in left["near_dedup"])
    assert 400 in left["near_dedup"] and 400 not in left["decontaminate"]
    # Clean documents come through unchanged.
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    assert all(left["decontaminate"][i] == texts[i] for i in range(90))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert Counter(r["doc_id"] for r in packed).keys() == left["decontaminate"].keys()


def test_run_of_an_empty_table(spark, tmp_path):
    write_tables(spark, str(tmp_path / "full"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(str(tmp_path / f"full/{name}.parquet")).write.parquet(
            str(tmp_path / f"{name}.parquet"))
    tables.empty(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    named = queries()
    assert "pipeline" in named
    for n in range(1, 11):
        assert len([q for q in named if q.startswith(f"op{n}_")]) == 1
    assert {"op1_template_tree", "op7_line_frequency"} <= set(oracle_sql())


def test_batches_of_long_texts_end_at_a_size(spark, tmp_path):
    """Whoever calls a stage: Python never gets thousands of long texts at once."""
    limit, rows = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    spark.conf.unset(limit)
    try:
        corpus_pipeline.near_dedup(spark, write_tables(spark, str(tmp_path)), str(tmp_path))
        long = spark.range(0, 9000, 1, 1).select("id", F.repeat(F.lit("word "), 400).alias("text"))
        sizes = map_batches(long, lambda batch: [{"n": [batch.num_rows], "size": [batch.nbytes]}],
                            "n bigint, size bigint").collect()
    finally:
        spark.conf.set(limit, before)
    assert int(spark.conf.get(rows)) > 9000
    assert sum(r["n"] for r in sizes) == 9000
    assert max(r["size"] for r in sizes) < 5 << 20
