"""A training corpus from documents, stage by stage.

Each stage is one operator of ``rillflow.llm`` applied to all that its predecessor kept, and its
decisions take effect: rejected documents, recurring lines, further documents of a group of near
copies and documents with benchmark passages go; what is left is cut and packed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm import filters, linefreq, oddsketch, packing, passages, seeds, templates, tokens
from rillflow.llm.scratch import saved
from rillflow.session import configure, scratch_path

# What a stage calls near copies: these shingles of words, this similarity in percent.
NEAR_WORDS, NEAR_PERCENT = 5, 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def configured(stage: Stage) -> Stage:
    """The stage with the runtime settings, whoever made the session and calls it."""

    @wraps(stage)
    def run_configured(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(configure(spark), docs, sf_dir)

    return run_configured


@configured
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    model = passages.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return passages.accepted(docs, model)


@configured
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop recurring lines, and documents of which they leave nothing.

    What is left of any other document stays, however little: it may be the only place of its
    words. Copies are the next stage's, so changed ones reach it whole.
    """
    changed = templates.drop_recurring_lines(spark, docs, leave_copies=True)
    words = F.size(linefreq.text_words(F.col("text")))
    emptied = F.when(F.col("n_dropped_words") > 0, words == 0).otherwise(False)
    return changed.where(~emptied).select(
        "doc_id", "text", "lang", "source",
        F.length("text").cast("bigint").alias("n_chars"),
    )


@configured
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, the one with the smallest doc_id."""
    near = oddsketch.near_duplicates(spark, docs, NEAR_WORDS, NEAR_PERCENT)
    copies = saved(spark, near.where(~F.col("kept")).select("doc_id").distinct(), "copies")
    return filters.without(docs, "doc_id", copies, filters.slots(copies)).select(
        "doc_id", "text", "lang", "source", "n_chars"
    )


@configured
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that share a passage with the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = seeds.overlaps(spark, docs, benchmark).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(
        "doc_id", "text", "lang", "source", "n_chars"
    )


@configured
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut and pack the documents that are left; rows with a ``sequence`` are what to train on."""
    return packing.cut_sequences(packing.sequences(spark, docs, tokens.default_vocabulary()))


STAGES = [
    ("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
    ("decontaminate", decontaminate), ("packing", packed),
]
# Models, sketches and token ids have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
