"""Odd sketches against all pairs of full sets."""

import random
from collections import Counter

from pyspark.sql import functions as F

from rillflow.llm import components, filters, oddsketch
from tests.llm import tables

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = (text or "").translate(LOWER).encode().split()
    if len(words) < 3:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 3]) for i in range(len(words) - 2))


def brute(rows):
    docs = {}
    for doc, text in rows:
        if doc is not None and shingles(text):
            docs[shingles(text)] = min(doc, docs.get(shingles(text), doc))
    sets = list(docs)
    parent = list(range(len(sets)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, x in enumerate(sets):
        for b, y in enumerate(sets[:a]):
            if 100 * len(x & y) >= 85 * len(x | y):
                parent[top(a)] = top(b)
    smallest = {}
    for i, x in enumerate(sets):
        smallest[top(i)] = min(docs[x], smallest.get(top(i), docs[x]))
    groups = {x: smallest[top(i)] for i, x in enumerate(sets)}
    out = []
    for doc, text in rows:
        group = None if doc is None else groups.get(shingles(text), doc)
        out.append((doc, len(shingles(text)), group, doc is None or doc == group))
    return Counter(out)


def found(spark, docs):
    return Counter(tuple(r) for r in oddsketch.near_duplicates(spark, docs).collect())


def test_groups_of_awkward_documents(spark):
    docs = tables.documents(spark)
    assert found(spark, docs) == brute(tables.pairs_of(docs))


def test_chains_and_large_groups_of_copies(spark):
    base = tables.prose(50, 150)
    rows = [(i, tables.changed(base, i, 1 + i % 3)) for i in range(120)]
    rows += [(1000 + i, base) for i in range(200)]
    chain = tables.prose(51, 200)
    for i in range(25):
        rows.append((2000 - i, chain))
        chain = tables.changed(chain, 300 + i, 5)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(spark, docs) == brute(rows)


def test_buckets_in_blocks(spark, monkeypatch):
    # Texts of one base that are linked in chains only, of sizes on several levels.
    base = tables.prose(52, 120)
    rows = [(i, tables.changed(base, i, 2 + i % 4)) for i in range(60)]
    rows += [(100 + i, tables.changed(base, 200 + i, 3) + " " + tables.prose(300 + i, 4 * i)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    wanted = brute(rows)
    for classes, shingles in ((4, 2_000_000), (1024, 500)):
        monkeypatch.setattr(oddsketch, "BLOCK", classes)
        monkeypatch.setattr(oddsketch, "BLOCK_SHINGLES", shingles)
        assert found(spark, docs) == wanted


def test_a_block_gives_no_more_links_than_join_its_groups(spark):
    base = tables.prose(53, 200)
    rows = [(i, tables.changed(base, i, 1)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    signed = oddsketch.signatures(docs)
    classes = signed.select(
        F.col("key_a").alias("node"), "key_b", F.col("doc_id").alias("rep"), "n_shingles", "bands", "sketch"
    )
    alone = spark.createDataFrame([], "node bigint, component bigint")
    # Without the groups of the bucket centres, blocks have all pairs to verify.
    members = oddsketch.cross_members(oddsketch._grouped(classes, alone))
    per_block = Counter((r["bucket"], r["i"], r["j"]) for r in members.collect())
    links = oddsketch.cross_links(docs, classes, alone)
    assert per_block and 29 <= links.count() <= sum(n - 1 for n in per_block.values())


def test_empty_table(spark):
    assert oddsketch.near_duplicates(spark, tables.empty(spark)).count() == 0


def test_sketches_estimate_the_similarity(spark):
    base = tables.prose(60, 600)
    rows = [(0, base), (1, tables.changed(base, 61, 12)), (2, tables.prose(62, 600))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    first, near, far = oddsketch.signatures(docs).orderBy("doc_id").select("sketch").collect()
    for other, text in ((near, rows[1][1]), (far, rows[2][1])):
        bits = sum((x ^ y).bit_count() if x ^ y >= 0 else ((x ^ y) + (1 << 64)).bit_count()
                   for x, y in zip(first[0], other[0]))
        x, y = shingles(base), shingles(text)
        guess = spark.range(1).select(oddsketch.similarity(F.lit(bits))).first()[0]
        assert guess < 0.4 or abs(guess - len(x & y) / len(x | y)) < 0.1


def test_components(spark):
    random.seed(1)
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (200, 200)]
    random.shuffle(links)
    df = spark.createDataFrame(links, "a bigint, b bigint")
    out = {r["node"]: r["component"] for r in components.components(df).collect()}
    assert all(out[i] == 0 for i in range(41))
    assert out[101] == 100 and out[200] == 200
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert components.components(none).count() == 0


def test_only_shared_buckets_and_asked_texts_are_shuffled(spark, monkeypatch):
    kept = {}

    def saved(session, df, name, codec=None):
        kept.setdefault(name, save(session, df, name, codec))
        return kept[name] if name in ("shared", "names") else save(session, df, name, codec)

    save = oddsketch.saved
    rows = [(i, tables.prose(400 + i, 80)) for i in range(60)]
    rows += [(100 + i, tables.changed(rows[0][1], 500 + i, 1)) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    classes = oddsketch.signatures(docs).select(
        F.col("key_a").alias("node"), F.col("doc_id").alias("rep"), "n_shingles", "bands", "sketch"
    ).cache()
    shared = Counter(r["bucket"] for r in oddsketch.shared_buckets(classes).collect())
    every = Counter(b for r in classes.collect() for b in r["bands"])
    assert shared == Counter({b: n for b, n in every.items() if n > 1}) and len(shared) < len(every) / 10
    assert set(map(tuple, oddsketch.star_pairs(classes).collect())) == set(
        map(tuple, oddsketch.star_pairs(classes, shared=oddsketch.shared_buckets(classes)).collect())
    )
    monkeypatch.setattr(oddsketch, "saved", saved)
    asked = classes.where("rep IN (0, 101)").select("node")
    assert oddsketch.full_sets(docs, classes, asked, 3).count() == 2
    texts = filters.possible(docs, "doc_id", filters.slots(kept["names"].select("doc_id")))
    assert sorted(r["doc_id"] for r in texts.collect()) == [0, 101]


def test_bitmaps_decide_nothing_alone(spark, monkeypatch):
    rows = [(i, str(i)) for i in range(-50, 300)] + [(None, "none"), (7, "again")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    gone = docs.where("doc_id % 5 = 2").select("doc_id").distinct()
    # A remainder has the sign of its number.
    wanted = Counter(r for r in rows if r[0] is None or r[0] < 0 or r[0] % 5 != 2)
    # In a bitmap of few bits other keys pass too, and a join decides.
    for bits in (filters.SLOT_BITS, 64, 128):
        monkeypatch.setattr(filters, "SLOT_BITS", bits)
        out = filters.without(docs, "doc_id", gone, filters.slots(gone))
        assert Counter(map(tuple, out.collect())) == wanted
        passed = {r["doc_id"] for r in filters.possible(docs, "doc_id", filters.slots(gone)).collect()}
        assert passed >= {r["doc_id"] for r in gone.collect()}
        assert bits <= 128 or len(passed) < 100
