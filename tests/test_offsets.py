"""Record streams by epoch, and starts from saved offsets."""

import os
from collections import Counter

import pytest

from rillflow.sources import records
from rillflow.streaming import jobs, offsets
from tests.conftest import rows


@pytest.fixture
def feed(spark, tmp_path):
    """Sends rows as the next epoch of a topic; its batches may be repeated."""
    records.register(spark)
    schema = "key string, value string"

    class Feed:
        topic, checkpoint = str(tmp_path / "topic"), str(tmp_path / "sent")

        def __init__(self):
            self.sent = []

        def send(self, *pairs):
            self.sent += pairs
            if pairs:
                spark.createDataFrame(pairs, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = jobs.file_stream(spark, str(tmp_path / "in"), "key string, value string")
            jobs.run(stream, self.checkpoint, path=self.topic, source="keyed_records")

        def read(self, **options):
            return spark.readStream.format("keyed_records").options(**options).load(self.topic)

    return Feed()


def forget_last_commit(checkpoint):
    """The state of a query that fell between its write and its commit."""
    folder = os.path.join(checkpoint, "commits")
    last = max(int(n) for n in os.listdir(folder) if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(os.path.join(folder, name)):
            os.remove(os.path.join(folder, name))


def test_epochs_pass_and_a_repeated_batch_counts_once(spark, tmp_path, feed):
    copy = str(tmp_path / "copy")
    for i in range(3):
        feed.send((f"k{i}", "a\tb\n"), (None, f"v{i}"), (f"n{i}", None))
        jobs.run(feed.read(rangeBytes=3), str(tmp_path / "got"), path=copy, source="keyed_records")
    batch = spark.read.format("keyed_records")
    assert Counter(map(tuple, batch.load(copy).collect())) == Counter(feed.sent)
    forget_last_commit(str(tmp_path / "got"))
    jobs.run(feed.read(), str(tmp_path / "got"), path=copy, source="keyed_records")
    forget_last_commit(feed.checkpoint)
    feed.send()
    for path in (copy, feed.topic):
        assert Counter(map(tuple, batch.load(path).collect())) == Counter(feed.sent)
    lists = [n for n in os.listdir(copy) if n.startswith(records.EPOCH_PREFIX)]
    assert len(lists) == 3


def test_start_from_saved_offsets(spark, tmp_path, feed):
    saved, got = str(tmp_path / "saved"), []
    assert offsets.saved_offsets(saved, "q") is None
    for life in range(3):
        feed.send((f"k{life}", "x"), ("again", str(life)))
        known = offsets.saved_offsets(saved, "q")
        assert known == ([{"epoch": life}] if life else None)
        stream = feed.read(**({"startingEpoch": known[0]["epoch"]} if known else {}))
        with offsets.OffsetKeeper(spark, saved, "q"):
            jobs.run(
                stream, str(tmp_path / f"checkpoint-{life}"), name="q",
                write=lambda batch, n: got.append(rows(batch)),
            )
    assert sorted(r for batch in got for r in batch) == sorted(feed.sent)
    # Nothing new: nothing is read and the offsets stay.
    with offsets.OffsetKeeper(spark, saved, "q"):
        jobs.run(feed.read(startingEpoch=3), str(tmp_path / "idle"), name="q", write=lambda b, n: got.append(rows(b)))
    assert sum(map(len, got)) == len(feed.sent) and offsets.saved_offsets(saved, "q") == [{"epoch": 3}]


def test_other_queries_and_failed_ones_leave_the_offsets(spark, tmp_path, feed):
    saved = str(tmp_path / "saved")
    feed.send(("k", "v"))

    def fail(batch, n):
        raise ValueError("no write")

    with pytest.raises(Exception, match="no write"):
        with offsets.OffsetKeeper(spark, saved, "q"):
            jobs.run(feed.read(), str(tmp_path / "failed"), name="q", write=fail)
    with offsets.OffsetKeeper(spark, saved, "q"):
        jobs.run(feed.read(), str(tmp_path / "other"), name="other", write=lambda b, n: b.count())
    assert offsets.saved_offsets(saved, "q") is None


def test_an_epoch_that_is_gone_is_an_error(spark, tmp_path, feed):
    feed.send(("k", "v"))
    feed.send(("l", "w"))
    with pytest.raises(Exception, match="epochs that are not in"):
        os.remove(os.path.join(feed.topic, f"{records.EPOCH_PREFIX}{0:020d}"))
        jobs.run(feed.read(), str(tmp_path / "gone"), write=lambda b, n: b.count())
