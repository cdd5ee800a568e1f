"""Archives read back by the operator, by the gzip module and after damage."""

import gzip
import hashlib
import io
from collections import Counter, defaultdict

import pytest
from pyarrow import fs

from rillflow.llm import warc
from rillflow.session import scratch_path
from tests.llm import tables

PAGES = "page_id bigint, url string, html string"
LONG = "<p>" + "é long page " * 200 + "</p>"


def page_rows():
    other = tables.prose(5, 400)
    rows = [
        (1, "http://a.example/1", LONG), (2, "http://a.example/2", LONG), (9, None, LONG),
        (9, "http://a.example/9", LONG), (None, "http://a.example/n", LONG), (9, None, LONG),
        (3, "http://b.example/ x\r\ny: z", "short"), (4, "", "short"), (5, "u", None), (6, "u", ""),
        (-7, "http://c.example/", other), (None, None, None), (8, "w", "a\r\n\r\nWARC/1.1\r\n\r\n"),
        (10, "x", "x" * 999), (11, "x", "x" * 999), (12, "x", "y" * 1000), (13, "x", "y" * 1000),
        (20, "big", tables.prose(6, 200_000)),
    ]
    return rows + [(100 + i, f"http://d.example/{i}", tables.prose(100 + i, 40)) for i in range(50)]


def written(spark, rows, schema=PAGES):
    path = scratch_path(spark, "warc")
    warc.write_archives(spark, spark.createDataFrame(rows, schema), path)
    return path


def expected(rows):
    """Page id, bytes, digest, type and response's page of every row."""
    groups = defaultdict(list)
    for i, (page, _, html) in enumerate(rows):
        groups[(html or "").encode()].append((page is not None, page or 0, i))
    out = Counter()
    for payload, members in groups.items():
        last = max(members)
        for member in members:
            again = len(payload) >= 1000 and member != last
            page = rows[member[2]][0]
            out[(page, len(payload), hashlib.sha1(payload).hexdigest(),
                 "revisit" if again else "response", rows[last[2]][0] if again else None)] += 1
    return out


def test_round_trip(spark):
    rows = page_rows()
    more = [(*r, "clash", 1, b"x", "t") for r in rows]
    path = written(spark, more, f"{PAGES}, record_type string, size int, payload binary, _row string")
    records = warc.read_archives(spark, path, payloads=True)
    found = warc.page_records(records).collect()
    assert all(r["problem"] is None for r in found)
    assert Counter(tuple(r)[:5] for r in found) == expected(rows)
    assert len({r["record_id"] for r in found}) == len(rows)
    responses = {r["record_id"]: r["page_id"] for r in found if r["record_type"] == "response"}
    for r in found:
        if r["record_type"] == "revisit":
            assert responses[r["refers_to_id"]] == r["refers_to"]
    payloads = {(r["page_id"], r["payload"]) for r in records.where("record_type = 'response'").collect()}
    wanted = {(p, (h or "").encode()) for p, _, h in rows if p is not None}
    assert {x for x in wanted if len(x[1]) < 1000} <= {(p, bytes(b)) for p, b in payloads}
    assert any(bytes(b) == LONG.encode() and p == 9 for p, b in payloads)


def test_one_response_of_every_group_of_a_spread_table(spark, tmp_path):
    """Copies in several files, spread before the work, with rows equal in all columns."""
    rows = [
        (page + k * 1000, f"http://h.example/{page}", f"<p>{page}</p>" + tables.prose(page, 700))
        for k in range(3) for page in range(300)
    ]
    rows += 3 * rows[-5:] + 2 * [(None, "http://n.example/", LONG)]
    spark.createDataFrame(rows, PAGES).repartition(3).write.parquet(str(tmp_path / "pages"))
    pages = spark.read.parquet(str(tmp_path / "pages"))
    path = scratch_path(spark, "warc")
    warc.write_archives(spark, pages, path)
    found = warc.page_records(warc.read_archives(spark, path)).collect()
    assert Counter(tuple(r)[:5] for r in found) == expected(rows)
    assert len({r["record_id"] for r in found}) == len(rows)
    responses = {r["record_id"] for r in found if r["record_type"] == "response"}
    assert {r["refers_to_id"] for r in found if r["refers_to_id"]} <= responses


def archive_files(path):
    store, root = fs.FileSystem.from_uri(f"{path}/archives")
    return [
        store.open_input_stream(f.path, compression=None).read()
        for f in store.get_file_info(fs.FileSelector(root))
    ]


def test_other_readers_understand_the_archives(spark):
    rows = page_rows()
    path = written(spark, rows)
    heads = Counter()
    for data in archive_files(path):
        text = gzip.decompress(data)
        while text:
            head, _, text = text.partition(b"\r\n\r\n")
            fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
            block, text = text[: int(fields[b"Content-Length"])], text[int(fields[b"Content-Length"]) :]
            assert text.startswith(b"\r\n\r\n")
            text = text[4:]
            heads[fields[b"WARC-Type"]] += 1
            if fields[b"WARC-Type"] == b"response":
                http, _, payload = block.partition(b"\r\n\r\n")
                assert b"Content-Length: %d" % len(payload) in http
    assert heads[b"response"] + heads[b"revisit"] == len(rows)
    index = spark.read.parquet(f"{path}/index").collect()
    assert sum(r["n_records"] for r in index) == len(rows)


def test_archives_are_cut(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    rows = page_rows()
    path = written(spark, rows)
    assert len(archive_files(path)) > 5
    found = warc.page_records(warc.read_archives(spark, path)).collect()
    assert Counter(tuple(r)[:5] for r in found) == expected(rows)


def test_plain_join_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    rows = page_rows()
    found = warc.page_records(warc.read_archives(spark, written(spark, rows))).collect()
    assert Counter(tuple(r)[:5] for r in found) == expected(rows)


def test_files_of_failed_tasks_are_not_read(spark):
    rows = page_rows()
    path = written(spark, rows)
    store, root = fs.FileSystem.from_uri(f"{path}/archives")
    with store.open_output_stream(f"{root}/000000-999-0000.warc.gz", compression=None) as f:
        f.write(warc.info_record("stray") + b"half a rec")
    assert warc.page_records(warc.read_archives(spark, path)).count() == len(rows)


def record(page, html, **changes):
    payload = html.encode()
    row = {"page_id": page, "url": "u", "payload": payload, "size": len(payload),
           "_sha1": hashlib.sha1(payload).hexdigest(), "record_id": f"<urn:uuid:{page}>",
           "refers_to_id": None, "refers_to": None, **changes}
    return warc.page_record(row)


def read(data):
    return list(warc.Archive(io.BytesIO(data)).records(payloads=True))


def repacked(member, old, new):
    text = gzip.decompress(member)
    assert old in text
    return gzip.compress(text.replace(old, new))


@pytest.mark.parametrize("old, new, problem", [
    (b"hello", b"hallo", "payload digest"), (b"WARC/1.1", b"JUNK/1.1", "no record"),
    (b"HTTP/1.1 200 OK", b"HTTP/1.1 404 OK", "block digest"),
    (b"hello", b"hello and more", "longer"), (b"hello", b"h", "shorter"),
    (b"Content-Length", b"Content-Width", "no Content-Length"), (b"\r\n\r\n", b"\r\n", "no end"),
])
def test_damaged_records(old, new, problem):
    member = record(1, "hello")
    if new == b"hello and more":
        text = gzip.decompress(member)
        damaged = gzip.compress(text[:-4] + b" and more" + text[-4:])
    elif new == b"h":
        damaged = gzip.compress(gzip.decompress(member)[:-12])
    else:
        damaged = repacked(member, old, new)
    found = read(record(0, "first") + damaged + record(2, "third"))
    assert [r.get("page_id") for r in (found[0], found[2])] == [0, 2]
    assert problem in found[1]["problem"] and found[0].get("problem") is found[2].get("problem") is None


def test_broken_compression_ends_an_archive():
    whole = record(0, "first") + record(1, "second")
    cut = read(whole[:-9])
    assert cut[0].get("problem") is None and "unreadable" in cut[1]["problem"]
    assert cut[1]["offset"] == len(record(0, "first"))
    junk = read(record(0, "first") + b"\x00junk")
    assert junk[0]["payload"] == b"first" and "unreadable" in junk[1]["problem"]


def test_pieces_of_a_long_record(monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 7)
    texts = ["", "a", "b" * 5000, tables.prose(3, 300)]
    found = read(b"".join(record(i, t) for i, t in enumerate(texts)))
    assert [r["payload"].decode() for r in found] == texts
    assert all(r.get("problem") is None for r in found)


def test_empty_table(spark):
    path = written(spark, [])
    assert warc.read_archives(spark, path).count() == 0
