import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rillflow.session import build_session, configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = configure(build_session("tests", 4))
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def sensors(spark):
    """Readings in file order: only the first is ahead of its time."""
    rows = [
        ("sensor_1", 1547718299, 26.8), ("sensor_6", 1547718201, 15.4), ("sensor_7", 1547718202, 6.7),
        ("sensor_10", 1547718205, 38.1), ("sensor_1", 1547718207, 37.2),
        ("sensor_1", 1547718212, 33.5), ("sensor_1", 1547718215, 38.3),
    ]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(
        [(i + 1, *r) for i, r in enumerate(rows)],
        "seq bigint, id string, timestamp bigint, temperature double",
    )
    return df.withColumn("ts", F.timestamp_seconds("timestamp"))


@pytest.fixture
def films(spark):
    return spark.createDataFrame(
        [
            (1, "operation red sea", 8.5, [(1, "zhang yi"), (2, "hai qing"), (3, "zhang han yu")]),
            (2, "operation meigong river", 8.0, [(3, "zhang han yu")]),
            (3, "incident red sea", 5.0, [(4, "lin na")]),
        ],
        "id bigint, name string, doubanScore double, actorList array<struct<id bigint, name string>>",
    )


def ids(df, column="id"):
    return sorted(r[column] for r in df.collect())


def rows(df):
    return sorted(tuple(r) for r in df.collect())
