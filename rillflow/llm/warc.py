"""WARC archives of pages: one gzip member per record, read back in sequence.

Tasks write archives into the shared folder, and Spark commits a table that names them: files of
tasks that failed or ran twice are in no row of it and are never read. The reader inflates a
member piece by piece, frames the record by its Content-Length and checks its digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm.arrow import struct_of, to_arrow_schema
from rillflow.llm.scratch import saved
from rillflow.session import spread

# Payloads of this many bytes are written once; equal ones refer to it.
REVISIT_BYTES = 1000
# An archive is closed once it has this many bytes.
ARCHIVE_BYTES = 256 << 20
# Groups of equal payloads that may be sent to every executor, about 100 bytes each.
BROADCAST_ROWS = 200_000
LEVEL = 6
READ_BYTES = 1 << 18
BATCH_ROWS, BATCH_BYTES = 4096, 16 << 20

INDEX = "archive string, n_records bigint, n_bytes bigint"
RECORD = (
    "archive string, offset bigint, record_type string, record_id string, page_id bigint,"
    " url string, payload_bytes bigint, payload_digest string, refers_to_id string,"
    " refers_to bigint, payload binary, problem string"
)
# Fixed values of the format.
VERSION = b"WARC/1.1"
LINE, END = b"\r\n", b"\r\n\r\n"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"2024-01-01T00:00:00Z"
UNSAFE = re.compile(rb"[\x00-\x20\x7f]")


def _uuid(*parts: Column) -> Column:
    """A record id from what tells the row apart."""
    key = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    cut = [F.substring(key, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def with_roles(spark: SparkSession, pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Each row of ``pages`` (page_id, url, html) with what its record is.

    Of rows with equal payloads of at least ``least`` bytes the one with the largest page_id is
    the response (of several such rows the one with the largest url; nulls are the smallest), and
    all others revisit it. Payloads are equal when SHA-1, length and a second hash are.

    The response is told by its values: the table is scanned more than once, and a row number
    does not come out the same in every scan. Of rows equal in all columns one is the response.
    """
    keyed = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url",
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    ).withColumns({
        "_sha1": F.sha1("payload"), "_size": F.octet_length("payload"),
        "_more": F.xxhash64("payload"),
    })
    key = ["_sha1", "_size", "_more"]
    groups = saved(
        spark,
        keyed.where(F.col("_size") >= least).groupBy(*key, "page_id", "url").agg(F.count("*").alias("_n"))
        .groupBy(*key).agg(F.sum("_n").alias("_members"), F.max(F.struct("page_id", "url", "_n")).alias("_first"))
        .where("_members > 1").drop("_members"),
        "payloads",
    )
    n_groups, most = groups.agg(F.count("*"), F.max("_first._n")).first()
    if n_groups <= BROADCAST_ROWS:
        groups = F.broadcast(groups)
    first, own, none = F.col("_first"), F.monotonically_increasing_id(), F.lit(None)
    again = first.isNotNull()
    # Null outside groups, where there is no response to be.
    chosen = first["page_id"].eqNullSafe(F.col("page_id")) & first["url"].eqNullSafe(F.col("url")) & again

    def roles(rows: DataFrame, revisits: Column, number: Column) -> DataFrame:
        """The response of a group has a record id without a number, so that all others can name it."""
        return rows.select(
            "page_id", "url", "_sha1",
            F.when(revisits, none).otherwise(F.col("payload")).alias("payload"),
            F.col("_size").cast("bigint").alias("size"),
            _uuid(F.col("page_id"), F.when(~again | revisits, number), F.col("_sha1")).alias("record_id"),
            F.when(revisits, _uuid(first["page_id"], none, F.col("_sha1"))).alias("refers_to_id"),
            F.when(revisits, first["page_id"]).alias("refers_to"),
        )

    joined = keyed.join(groups, key, "left")
    if (most or 1) == 1:
        return roles(joined, again & ~chosen, own)
    equal = chosen & (first["_n"] > 1)
    copies = joined.where(equal).groupBy(*key, "page_id", "url", "_first").agg(
        F.any_value("payload").alias("payload")
    ).select("*", F.explode(F.sequence(F.lit(1), first["_n"])).alias("_copy"))
    rest = roles(joined.where(~equal | ~again), again & ~chosen, own)
    return rest.unionByName(
        roles(copies, F.col("_copy") > 1, F.concat(F.lit("copy "), F.col("_copy").cast("string")))
    )


def _digest(hexadecimal: str) -> bytes:
    return b"sha1:" + base64.b32encode(bytes.fromhex(hexadecimal))


def _record(fields: list[tuple[bytes, bytes]], block: bytes) -> bytes:
    """One record as a gzip member."""
    head = [VERSION, *[name + b": " + value for name, value in fields]]
    head.append(b"Content-Length: %d" % len(block))
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress(LINE.join(head) + END) + pack.compress(block + END) + pack.flush()


def info_record(name: str) -> bytes:
    """The record at the head of an archive."""
    fields = [
        (b"WARC-Type", b"warcinfo"),
        (b"WARC-Record-ID", b"<urn:archive:%s>" % name.encode()),
        (b"WARC-Date", DATE), (b"WARC-Filename", name.encode()),
        (b"Content-Type", b"application/warc-fields"),
    ]
    return _record(fields, b"software: rillflow\r\nformat: WARC File Format 1.1\r\n")


def page_record(row: dict) -> bytes:
    """The record of a page: an HTTP response, or its head alone when the payload is elsewhere."""
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % row["size"]
    ) + END
    block = http + (row["payload"] or b"")
    fields = [
        (b"WARC-Type", b"revisit" if row["refers_to_id"] else b"response"),
        (b"WARC-Record-ID", row["record_id"].encode()), (b"WARC-Date", DATE),
        (b"Content-Type", b"application/http; msgtype=response"),
        (b"WARC-Block-Digest", _digest(hashlib.sha1(block).hexdigest())),
        (b"WARC-Payload-Digest", _digest(row["_sha1"])),
    ]
    if row["url"]:
        target = UNSAFE.sub(lambda m: b"%%%02X" % m[0][0], row["url"].encode())
        fields.append((b"WARC-Target-URI", target))
    if row["page_id"] is not None:
        fields.append((b"Page-Id", b"%d" % row["page_id"]))
    if row["refers_to_id"]:
        fields += [(b"WARC-Refers-To", row["refers_to_id"].encode()), (b"WARC-Profile", PROFILE)]
        if row["refers_to"] is not None:
            fields.append((b"Refers-To-Page-Id", b"%d" % row["refers_to"]))
    return _record(fields, block)


def write_archives(spark: SparkSession, pages: DataFrame, path: str) -> None:
    """Write a record per row of ``pages`` into archives below ``path``.

    A null html is an empty payload. A null or empty url and a null page_id leave out their
    fields; blanks and control characters of a url are written as %XX. Repeated rows are records
    of their own. An empty table gives a folder without archives.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        store, root = fs.FileSystem.from_uri(f"{path}/archives")
        store.create_dir(root, recursive=True)
        sink, name, records, size, part = None, "", 0, 0, 0

        def close() -> pa.RecordBatch:
            sink.close()
            return pa.RecordBatch.from_pylist(
                [{"archive": name, "n_records": records, "n_bytes": size}], schema=schema
            )

        for batch in batches:
            for at in range(batch.num_rows):
                if sink is None:
                    name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{part:04d}.warc.gz"
                    sink = store.open_output_stream(f"{root}/{name}", compression=None)
                    part, records = part + 1, 0
                    size = sink.write(info_record(name))
                member = page_record(batch.slice(at, 1).to_pylist()[0])
                sink.write(member)
                records, size = records + 1, size + len(member)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    sink = None
        if sink is not None:
            yield close()

    schema = to_arrow_schema(struct_of(INDEX))
    with_roles(spark, spread(pages)).mapInArrow(write, INDEX).write.parquet(f"{path}/index")


class Damaged(Exception):
    """A record that is not what its headers say."""


class Archive:
    """Records of an archive one after the other; never more than a piece of one in memory."""

    def __init__(self, stream: BinaryIO):
        self._stream, self._rest = stream, b""
        self._taken = 0

    def _take(self) -> bytes:
        data, self._rest = self._rest or self._stream.read(READ_BYTES), b""
        self._taken += len(data)
        return data

    def _pieces(self) -> Iterator[bytes]:
        """The next member, inflated piece by piece; afterwards the archive stands behind it."""
        inflate = zlib.decompressobj(31)
        while not inflate.eof:
            data = inflate.unconsumed_tail or self._take()
            if not data:
                raise EOFError("the archive ends inside a record")
            out = inflate.decompress(data, READ_BYTES)
            if out:
                yield out
        self._rest = inflate.unused_data
        self._taken -= len(self._rest)

    def records(self, payloads: bool) -> Iterator[dict]:
        """Every record; one that is damaged has a ``problem`` and the next one follows.

        A member that cannot be inflated ends the archive, as nothing says where the next begins.
        """
        while True:
            self._rest = self._take()
            self._taken -= len(self._rest)
            if not self._rest:
                return
            out = {"offset": self._taken}
            pieces = self._pieces()
            try:
                try:
                    _read_record(pieces, out, payloads)
                except Damaged as reason:
                    out["problem"] = str(reason)
                for _ in pieces:
                    pass
            except (zlib.error, EOFError) as reason:
                yield {**out, "problem": f"unreadable from here on: {reason}"}
                return
            yield out


def _head(pieces: Iterator[bytes], data: bytes) -> tuple[list[bytes], bytes]:
    """Lines up to an empty one, and what was read beyond it."""
    while (at := data.find(END)) < 0:
        more = next(pieces, b"")
        if not more:
            raise Damaged("no end of the headers")
        data += more
    return data[:at].split(LINE), data[at + len(END) :]


def _fields(lines: list[bytes]) -> dict[bytes, bytes]:
    pairs = (line.partition(b":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _number(value: bytes | None) -> int | None:
    return int(value) if value is not None and re.fullmatch(rb"-?\d+", value) else None


def _hexadecimal(digest: bytes | None) -> str | None:
    """The SHA-1 of a digest field in hexadecimal; None for another kind."""
    kind, _, value = (digest or b"").partition(b":")
    try:
        return base64.b32decode(value.upper()).hex() if kind.lower() == b"sha1" else None
    except ValueError:
        return None


def _read_record(pieces: Iterator[bytes], out: dict, payloads: bool) -> None:
    """Fill ``out`` from one record; raises Damaged when it is not as its headers say."""
    lines, data = _head(pieces, b"")
    if not lines[0].startswith(b"WARC/"):
        raise Damaged("no record")
    fields = _fields(lines[1:])
    text = {k: fields[k].decode("utf-8", "replace") for k in fields}
    out |= {
        "record_type": text.get(b"warc-type"), "record_id": text.get(b"warc-record-id"),
        "url": text.get(b"warc-target-uri"), "page_id": _number(fields.get(b"page-id")),
        "refers_to_id": text.get(b"warc-refers-to"),
        "refers_to": _number(fields.get(b"refers-to-page-id")),
    }
    left = _number(fields.get(b"content-length"))
    if left is None or left < 0:
        raise Damaged("no Content-Length")
    block, payload = hashlib.sha1(), hashlib.sha1()
    http: bytes | None = b"" if fields.get(b"content-type", b"").startswith(b"application/http") else None
    has_head, size, parts = http is not None, 0, []
    while left:
        data = data or next(pieces, b"")
        if not data:
            raise Damaged("shorter than its Content-Length")
        piece, data = data[:left], data[left:]
        left -= len(piece)
        block.update(piece)
        if http is not None:
            http += piece
            if END not in http:
                continue
            http, _, piece = http.partition(END)
            sent, http = _fields(http.split(LINE)[1:]), None
        payload.update(piece)
        size += len(piece)
        if payloads and piece:
            parts.append(piece)
    tail = data + b"".join(pieces)
    said = _hexadecimal(fields.get(b"warc-payload-digest"))
    if out["record_type"] == "revisit":
        length = _number(sent.get(b"content-length")) if has_head and http is None else None
        out |= {"payload_bytes": length, "payload_digest": said}
    else:
        out |= {"payload_bytes": size, "payload_digest": payload.hexdigest()}
        out["payload"] = b"".join(parts) if payloads else None
        if said is not None and said != payload.hexdigest():
            raise Damaged("payload digest does not match")
    if tail != END:
        raise Damaged("longer than its Content-Length")
    if (own := _hexadecimal(fields.get(b"warc-block-digest"))) not in (None, block.hexdigest()):
        raise Damaged("block digest does not match")


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Every record of the archives that the index below ``path`` names.

    A damaged record has a ``problem`` and is not left out.
    """
    index = spark.read.schema(INDEX).parquet(f"{path}/index").select("archive")
    # One short row per archive; each is read from end to end by one task.
    tasks = max(1, min(index.count(), 10_000))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(f"{path}/archives")
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                held, size = [], 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for record in Archive(stream).records(payloads):
                        held.append({"archive": name, **record})
                        size += len(record.get("payload") or b"")
                        if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    schema = to_arrow_schema(struct_of(RECORD))
    return index.repartition(tasks).mapInArrow(read, RECORD)


def page_records(records: DataFrame) -> DataFrame:
    """What was read of pages: their payloads, types and, for revisits, the response's page."""
    return records.where(
        "record_type IS NULL OR record_type IN ('response', 'revisit')"
    ).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id",
        "refers_to_id", "archive", "offset", "problem",
    )


# What the archives must say, for DuckDB.
ARCHIVE_SQL = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN n >= {REVISIT_BYTES} AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {REVISIT_BYTES} AND page_id < top THEN top END AS refers_to
FROM g
"""
