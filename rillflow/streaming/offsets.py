"""End offsets kept outside the checkpoint, and a start from them (STR-08, SRC-06).

Offsets are saved after a batch has been written. A query that fails in between writes that batch
again when it starts from them, so its sink should take a row twice, as a keyed table does.
"""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from rillflow.sources.records import open_path


class OffsetKeeper(StreamingQueryListener):
    """Saves where the sources of a named query ended, after each of its batches.

    Use it around a query: ``with OffsetKeeper(spark, path, name): jobs.run(..., name=name)``. Reports
    of a batch come a little after it; leaving waits until those of an ended query have come.
    """

    WAIT_SECONDS = 60

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path, self.name = spark, path, name
        self._runs: set[str] = set()
        self._changed = threading.Condition()
        self._failed: Exception | None = None

    def __enter__(self) -> OffsetKeeper:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        with self._changed:
            ended = self._changed.wait_for(lambda: not self._runs, self.WAIT_SECONDS)
        self.spark.streams.removeListener(self)
        if self._failed and not error[0]:
            raise self._failed
        if not ended and not error[0]:
            raise TimeoutError(f"no report of the end of {self.name}")

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            with self._changed:
                self._runs.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        ends = [source.endOffset for source in progress.sources]
        if progress.name != self.name or None in ends:
            return
        try:
            save_offsets(self.path, self.name, progress.batchId, ends)
        except Exception as failure:
            self._failed = failure

    def onQueryIdle(self, event) -> None:
        """Nothing was read."""

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._runs.discard(str(event.runId))
            self._changed.notify_all()


def save_offsets(path: str, name: str, batch: int, ends: list[str]) -> None:
    """Replace the saved offsets of a query: one JSON text per source, in the order of the query."""
    store, root = open_path(path)
    store.create_dir(root, recursive=True)
    new = f"{root}/_new-{uuid.uuid4().hex}"
    with store.open_output_stream(new) as sink:
        sink.write(json.dumps({"batch": batch, "ends": ends}).encode())
    store.move(new, f"{root}/{name}.json")


def saved_offsets(path: str, name: str) -> list[dict] | None:
    """The end offsets of a query's sources as saved last; None before the first batch."""
    store, root = open_path(path)
    if not store.get_file_info(f"{root}/{name}.json").is_file:
        return None
    with store.open_input_file(f"{root}/{name}.json") as source:
        return [json.loads(end) for end in json.loads(source.read())["ends"]]
