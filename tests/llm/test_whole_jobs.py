"""Nothing that a stage or an operator should keep, find or give out is left out."""

import numpy as np

import corpus_pipeline
from rillflow.llm import oddsketch, packing, tokens
from tests.llm import tables


def line(seed, words):
    return tables.prose(seed, words).replace("\n", " ")


def test_the_first_place_of_a_line_stays(spark):
    """Document 5 loses two long lines and is the first of a third one."""
    a, b, c = line(1, 100), line(2, 100), line(3, 30)
    rows = [(1, a), (2, b), (5, f"{a}\n{b}\n{c}")]
    rows += [(100 + i, f"{line(100 + i, 60)}\n{a}\n{b}\n{c}") for i in range(30)]
    rows += [(200, f"{a}\n{b}")]
    docs = spark.createDataFrame(
        [(d, f"{t}\nown words of {d}" if d < 5 else t, "en", "s", len(t)) for d, t in rows],
        tables.DOCUMENTS,
    )
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert left[5] == c and 200 not in left
    assert all(left[100 + i] == line(100 + i, 60) for i in range(30))


def shingles(text, width=5):
    words = text.split()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def test_copies_with_a_block_more_are_near_copies(spark):
    """An appended, inserted or cut block that leaves 0.82 of the shingles of five words."""
    rows = []
    for i in range(10):
        base, block = line(700 + i, 300), line(800 + i, 64)
        words = base.split()
        half = " ".join(words[:150]), " ".join(words[150:])
        other = [f"{base} {block}", f"{half[0]} {block} {half[1]}", " ".join(words[:248])][i % 3]
        x, y = shingles(base), shingles(other)
        assert 0.80 <= len(x & y) / len(x | y) < 0.84
        x, y = shingles(base, 3), shingles(other, 3)
        assert len(x & y) / len(x | y) < 0.85
        rows += [(i, base), (100 + i, other), (200 + i, line(900 + i, 300))]
    # Just too far apart.
    rows += [(50, line(60, 300)), (150, f"{line(60, 300)} {line(61, 80)}")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], tables.DOCUMENTS)
    left = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert left == {d for d, _ in rows} - {100 + i for i in range(10)}


def test_bands_follow_the_limit():
    assert [oddsketch.bands_of(p) for p in (80, 85)] == [54, 35]
    assert oddsketch.margin(85) == oddsketch.MARGIN < oddsketch.margin(80)


def test_packed_sequences_hold_the_ids(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.default_vocabulary())
    docs = tables.documents(spark, clashing=False)
    rows = corpus_pipeline.packed(spark, docs, "").collect()
    full = {r["sequence_id"]: np.frombuffer(r["sequence"], "<u4") for r in rows if r["sequence"]}
    assert len(full) == sum(r["sequence"] is not None for r in rows)
    assert full.keys() == {r["sequence_id"] for r in rows}
    filled = dict.fromkeys(full, 0)
    found = []
    for r in rows:
        ids = full[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]].tolist()
        filled[r["sequence_id"]] += r["length"]
        found.append((str(r["doc_id"]), r["start"], ids))
    wanted = []
    for doc, text in tables.pairs_of(docs):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        wanted += [(str(doc), at, ids[at : at + 2048]) for at in range(0, len(ids), 2048)]
    assert sorted(found) == sorted(wanted)
    for number, ids in full.items():
        assert len(ids) == 2048 and set(ids[filled[number] :]) <= {packing.PAD_ID}
