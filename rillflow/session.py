"""Session settings, the shared scratch folder and plan size checks."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. Static settings (memory, cores) are left
# to spark-submit.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Batches for Python end at these bytes too, or ten thousand long texts are one batch, which
    # the executor and its Python worker hold several times over.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}

HOT_ROWS_KEY = "spark.rillflow.hotRows"
HOT_ROWS_DEFAULT = 5_000_000


def build_session(app: str = "rillflow", cpus: int | None = None) -> SparkSession:
    """A local session for tests and the benchmark."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in RUNTIME.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made by somebody else."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own: on a cluster a
    machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="rillflow-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan; huge when it does not know."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def hot_rows(spark: SparkSession) -> int:
    """Rows of one key that a single task may be given."""
    return int(spark.conf.get(HOT_ROWS_KEY, str(HOT_ROWS_DEFAULT)))


SPREAD_BYTES = 256 << 20
SPREAD_STEP = 256 << 10
# Bytes of a task when a large table is spread as well.
SPREAD_TASK = 8 << 20


def spread(df: DataFrame, large: bool = False) -> DataFrame:
    """Spread a small table over the cores before work that is heavy on the processor.

    A table of one small file is one task however long its rows take. Large tables come in
    many tasks already and are left alone, so the shuffle never exceeds ``SPREAD_BYTES``. Where
    rows are short and become many times as long, these tasks are too few: with ``large`` such a
    table is spread too, over tasks that follow its size.
    """
    if df.isStreaming:
        return df
    size, cores = plan_bytes(df), df.sparkSession.sparkContext.defaultParallelism
    tasks = min(max(cores, size // SPREAD_TASK) if large else cores, size // SPREAD_STEP)
    return df.repartition(tasks) if (large or size <= SPREAD_BYTES) and tasks > 1 else df


STATE_STEP = 64 << 20


def state_partitions(table: DataFrame) -> int:
    """Partitions for the state of a stream over a table.

    Their number is fixed when a query starts for the first time and each one costs a task and
    a store in every batch, so it follows the data: one per 64 MB, at least eight, and no more
    than the session would use.
    """
    spark = table.sparkSession
    most = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )
    return min(most, max(8, plan_bytes(table) // STATE_STEP))


BUCKET_STEP, BUCKETS_OF_PARTITION = 64 << 10, 8


def state_buckets(table: DataFrame, step: int = BUCKET_STEP) -> int:
    """Buckets of keys for the state of a stream over a table: one per ``step`` bytes."""
    return max(state_partitions(table) * BUCKETS_OF_PARTITION, plan_bytes(table) // step)
