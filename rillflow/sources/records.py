"""A partitioned Python data source and sink for ``key<TAB>value`` record files (EXT-04, EXT-05),
in batches and as a stream.

It is the extension point for stores Spark has no connector for. Large files are read in byte
ranges, so a single big file does not end up in one task. Files are opened through Arrow's
file systems, local or remote, and rows pass as Arrow batches. Tabs, line ends and backslashes
inside a text are escaped, and null has an escape of its own.

Every write has a folder of its own. Its tasks write under their final names, and the commit lists
the files of the tasks that counted, so a lost task leaves nothing that is read and nothing is
renamed. Plain files beside those folders are read too.
"""

from __future__ import annotations

import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa

from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

RANGE_BYTES = 64 << 20
BATCH_ROWS = 8_192
WRITE_PREFIX, LISTED = "write-", "_files.json"
EPOCH_PREFIX, EPOCH_FILES = "_epoch-", f"{WRITE_PREFIX}epochs"

# Escapes of the record form.
NULL = "\\N"
ESCAPES = {"\\": "\\\\", "\t": "\\t", "\n": "\\n", "\r": "\\r"}
PLAIN = {code[1]: char for char, code in ESCAPES.items()}
ESCAPE_TABLE = str.maketrans(ESCAPES)


def escaped(text: str | None) -> str:
    return NULL if text is None else text.translate(ESCAPE_TABLE)


def unescaped(text: str) -> str | None:
    if text == NULL:
        return None
    if "\\" not in text:
        return text
    out, chars = [], iter(text)
    for char in chars:
        if char == "\\":
            code = next(chars, "")
            if code not in PLAIN:
                raise ValueError(f"no such escape in a record: \\{code}")
            char = PLAIN[code]
        out.append(char)
    return "".join(out)


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    end: int


@dataclass
class Written(WriterCommitMessage):
    name: str


def open_path(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _entries(store, root: str) -> list:
    from pyarrow import fs

    return store.get_file_info(fs.FileSelector(root, allow_not_found=True))


def _names(store, path: str) -> list[str]:
    with store.open_input_file(path) as source:
        return json.loads(source.read())


def _epochs(entries: list) -> dict[int, str]:
    """The lists of committed epochs by number."""
    lists = (e for e in entries if e.is_file and e.base_name.startswith(EPOCH_PREFIX))
    return {int(e.base_name.removeprefix(EPOCH_PREFIX)): e.path for e in lists}


def _files(store, root: str, listed: str) -> list:
    """The files an epoch's list names."""
    names = _names(store, listed)
    files = store.get_file_info([f"{root}/{EPOCH_FILES}/{name}" for name in names]) if names else []
    lost = [f.path for f in files if not f.is_file]
    if lost:
        raise FileNotFoundError(f"files of {listed} are gone: {lost[:5]}")
    return files


def _ranges(files: list, range_bytes: int) -> list[InputPartition]:
    return [
        ByteRange(i.path, at, min(at + range_bytes, i.size))
        for i in sorted(files, key=lambda i: i.path)
        for at in range(0, i.size, range_bytes)
    ]


def _write_part(path: str, folder: str, batches: Iterator[pa.RecordBatch]) -> Written:
    store, root = open_path(path)
    store.create_dir(f"{root}/{folder}", recursive=True)
    name = f"part-{uuid.uuid4().hex}"
    with store.open_output_stream(f"{root}/{folder}/{name}") as sink:
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            sink.write("".join(f"{escaped(k)}\t{escaped(v)}\n" for k, v in pairs).encode())
    return Written(name)


class RecordReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))

    def partitions(self) -> list[InputPartition]:
        store, root = open_path(self.path)
        files, entries = [], _entries(store, root)
        for entry in entries:
            if entry.base_name.startswith(WRITE_PREFIX) and not entry.is_file:
                inside = {i.base_name: i for i in _entries(store, entry.path)}
                if LISTED in inside:
                    files += [inside[name] for name in _names(store, inside[LISTED].path)]
            elif entry.is_file and not entry.base_name.startswith(("_", ".")):
                files.append(entry)
        for listed in _epochs(entries).values():
            files += _files(store, root, listed)
        return _ranges(files, self.range_bytes)

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        keys: list[str | None] = []
        values: list[str | None] = []
        for line in self._lines(partition):
            key, tab, value = line.partition("\t")
            if not tab:
                raise ValueError(f"a record without a tab in {partition.path}: {line[:80]!r}")
            keys.append(unescaped(key))
            values.append(unescaped(value))
            if len(keys) == BATCH_ROWS:
                yield self._batch(keys, values)
                keys, values = [], []
        if keys:
            yield self._batch(keys, values)

    @staticmethod
    def _batch(keys: list, values: list) -> pa.RecordBatch:
        columns = [pa.array(keys, pa.string()), pa.array(values, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["key", "value"])

    @staticmethod
    def _lines(partition: ByteRange) -> Iterator[str]:
        store, _ = open_path(partition.path)
        with io.BufferedReader(store.open_input_file(partition.path), 1 << 20) as source:
            # A range owns the lines that begin in it.
            at = partition.start
            if at:
                source.seek(at - 1)
                at += len(source.readline()) - 1
            while at < partition.end:
                line = source.readline()
                if not line:
                    break
                at += len(line)
                yield line.decode().rstrip("\n")


class RecordWriter(DataSourceArrowWriter):
    """One folder per write; the list of its files makes it visible at once."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.folder = f"{WRITE_PREFIX}{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return _write_part(self.path, self.folder, iterator)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = open_path(self.path)
        store.create_dir(f"{root}/{self.folder}", recursive=True)
        earlier = [e for e in _entries(store, root) if e.base_name != self.folder]
        with store.open_output_stream(f"{root}/{self.folder}/{LISTED}") as sink:
            sink.write(json.dumps([m.name for m in messages if m]).encode())
        if self.overwrite:
            for entry in earlier:
                (store.delete_file if entry.is_file else store.delete_dir)(entry.path)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = open_path(self.path)
        if any(e.base_name == self.folder for e in _entries(store, root)):
            store.delete_dir(f"{root}/{self.folder}")


class RecordStreamReader(DataSourceStreamReader):
    """Epochs in order; without a checkpoint from the first, or from ``startingEpoch``.

    A batch takes all epochs committed since the one before, in byte ranges of their files.
    """

    def __init__(self, options: dict[str, str]):
        self.path, self.options = options["path"], dict(options)
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))
        self.first = int(options.get("startingEpoch", 0))

    def initialOffset(self) -> dict:
        return {"epoch": self.first}

    def latestOffset(self) -> dict:
        store, root = open_path(self.path)
        epochs = _epochs(_entries(store, root))
        return {"epoch": max([self.first, *(epoch + 1 for epoch in epochs)])}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        store, root = open_path(self.path)
        epochs = _epochs(_entries(store, root))
        asked = range(start["epoch"], end["epoch"])
        missing = [epoch for epoch in asked if epoch not in epochs]
        if missing:
            raise ValueError(f"epochs that are not in {self.path}: {missing[:5]}")
        return _ranges([f for e in asked for f in _files(store, root, epochs[e])], self.range_bytes)

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        return RecordReader(self.options).read(partition)

    def commit(self, end: dict) -> None:
        """The files stay, for other readers and for a start from saved offsets."""


class RecordStreamWriter(DataSourceStreamArrowWriter):
    """An epoch per batch; its list makes it visible at once, and a repeated one replaces it."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return _write_part(self.path, EPOCH_FILES, iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        store, root = open_path(self.path)
        store.create_dir(root, recursive=True)
        names = [m.name for m in messages if m]
        # A reader must not see half a list.
        new = f"{root}/_new-{uuid.uuid4().hex}"
        with store.open_output_stream(new) as sink:
            sink.write(json.dumps(names).encode())
        store.move(new, f"{root}/{EPOCH_PREFIX}{batchId:020d}")

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        """What was written is in no list, so nothing reads it."""


class RecordSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "keyed_records"

    def schema(self) -> str:
        return "key string, value string"

    def reader(self, schema: StructType) -> RecordReader:
        return RecordReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> RecordWriter:
        return RecordWriter(self.options, overwrite)

    def streamReader(self, schema: StructType) -> RecordStreamReader:
        return RecordStreamReader(self.options)

    def streamWriter(self, schema: StructType, overwrite: bool) -> RecordStreamWriter:
        return RecordStreamWriter(self.options)


def register(spark) -> None:
    spark.dataSource.register(RecordSource)
