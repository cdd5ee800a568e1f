"""Near-duplicate groups by MinHash bands, odd sketches and a check of the full shingle sets.

1. One pass over the texts gives each document its set size, a 128-bit name of its shingle set,
   MinHash bands and an odd sketch: every MinHash sample flips one bit of a parity bitmap, so the
   bits in which two bitmaps differ count the samples in which the documents differ.
2. Documents with the same set are one class, whatever their number. Only classes go on.
3. In each band bucket of several classes each is compared with the bucket's centre; the other
   buckets, which are most, are left after a count. The best centre of a class, if the sketches allow the similarity, is verified on the full sets, and links are joined up.
4. Buckets that still hold classes of different groups are compared in blocks, sketch against
   sketch, across groups only. A block names its members that have a pair to verify; their full sets
   come to the block, which verifies the pairs in its task and gives out the links that join groups.

Groups of copies therefore cost their size, not its square, and no pair leaves a task before it is
verified. What still grows with the square of a bucket is the comparing itself, block against block,
of texts that are nearly, but not quite, similar enough and belong to no common group.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm.arrow import byte_texts, map_batches
from rillflow.llm.components import components
from rillflow.llm.filters import possible, slots
from rillflow.llm.scratch import saved
from rillflow.llm.words import Hasher, mixed, numbers, windows
from rillflow.llm.worker import kept

WIDTH = 3
PERCENT = 85
# Samples of a band, and how often a pair at the limit may miss all bands.
ROWS, MISSED = 6, 1e-7
# The bands take the first samples, the sketch takes all.
SAMPLES = 630
SKETCH_LONGS = 16
# Sketches estimate the similarity with a standard deviation of about 0.016 at 85 %; a pair is
# dropped without a look at its sets only this far below that limit. See ``margin``.
MARGIN = 0.07
# Classes of a block, and shingles of all its classes together.
BLOCK, BLOCK_SHINGLES = 1024, 2_000_000

SIGNED = "doc_id bigint, n_shingles bigint, key_a bigint, key_b bigint, bands array<bigint>, sketch array<bigint>"


def bands_of(percent: int) -> int:
    """How many bands a limit needs: 35 at 85 %, 54 at 80 %.

    A pair of similarity s shares a band with probability s ** ROWS.
    """
    return math.ceil(math.log(MISSED) / math.log1p(-min(percent / 100, 0.999) ** ROWS))


def _deviation(similar: float) -> float:
    """Standard deviation of the estimate: of the samples, and of the bits that meet again."""
    apart, bits = 1 - similar, 64 * SKETCH_LONGS
    flips = 2 * SAMPLES * apart
    even = math.exp(-2 * flips / bits)
    met = max(bits * (1 - even * even) / 4 - flips * even * even, 0.0)
    return math.sqrt(similar * apart / SAMPLES + met / (2 * SAMPLES * even) ** 2)


def margin(percent: int) -> float:
    """The margin of a limit, in standard deviations the same as MARGIN at 85 %."""
    usual = _deviation(PERCENT / 100)
    return MARGIN * max(1.0, _deviation(percent / 100) / usual)


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """The distinct shingles of a text, ascending; a shorter text is one shingle."""
    if not len(hashes):
        return hashes
    return np.unique(windows(hashes, min(width, len(hashes)), seed=min(width, len(hashes))))


def _signed(column: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(column).view(np.int64)


def signatures(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with its set's size, name, bands and sketch."""
    n_bands = bands_of(percent)
    n_samples = max(SAMPLES, n_bands * ROWS)
    factors = (numbers(11, n_samples) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    shifts = (numbers(12, n_samples) >> np.uint64(32)).astype(np.uint32)
    band_factors, bit_seeds = numbers(13, ROWS), numbers(14, SAMPLES)
    band_seeds = numbers(15, n_bands)

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        hasher = kept(("hasher",), Hasher)
        doc_ids = batch.column("doc_id").to_pylist()
        texts = (x.lower() for x in byte_texts(batch.column("text")))
        for first, hashes, bounds in hasher.texts(texts):
            count = len(bounds) - 1
            sets = [shingle_set(hashes[a:b], width) for a, b in zip(bounds[:-1], bounds[1:])]
            sizes = np.fromiter(map(len, sets), np.int64, count)
            full = np.flatnonzero(sizes)
            key_a, key_b = np.zeros(count, np.uint64), np.zeros(count, np.uint64)
            bands = np.zeros((count, n_bands), np.uint64)
            sketch = np.zeros((count, SKETCH_LONGS), np.uint64)
            if len(full):
                flat = np.concatenate([sets[i] for i in full])
                starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                key_a[full] = np.add.reduceat(mixed(flat ^ np.uint64(0x5851F42D4C957F2D)), starts)
                key_b[full] = np.add.reduceat(mixed(flat + np.uint64(0x14057B7EF767814F)), starts)
                short = (flat >> np.uint64(32)).astype(np.uint32)
                samples = np.empty((n_samples, len(full)), np.uint32)
                for j in range(n_samples):
                    samples[j] = np.minimum.reduceat(short * factors[j] + shifts[j], starts)
                wide = samples.astype(np.uint64)
                grouped = wide[: n_bands * ROWS].reshape(n_bands, ROWS, len(full))
                grouped = grouped * band_factors[None, :, None]
                bands[full] = mixed(grouped.sum(1, dtype=np.uint64) + band_seeds[:, None]).T
                bits = mixed(wide[:SAMPLES] + bit_seeds[:, None]) % np.uint64(64 * SKETCH_LONGS)
                for j in range(SAMPLES):
                    at = bits[j].astype(np.int64)
                    sketch[full, at >> 6] ^= np.uint64(1) << (bits[j] & np.uint64(63))
            yield {
                "doc_id": doc_ids[first : first + count], "n_shingles": sizes,
                "key_a": _signed(key_a), "key_b": _signed(key_b),
                "bands": _lists(_signed(bands)), "sketch": _lists(_signed(sketch)),
            }

    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_batches(plain, work, SIGNED)


def _lists(table: np.ndarray) -> pa.ListArray:
    offsets = np.arange(0, table.size + 1, table.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(table.ravel()))


def similarity(differing: Column) -> Column:
    """The estimate from the number of bits in which two sketches differ."""
    bits = 64 * SKETCH_LONGS
    share = F.least(F.lit(1.0) - 2.0 * differing / bits, F.lit(1.0))
    apart = F.when(share > 0, -bits / 2.0 * F.log(share)).otherwise(2.0 * SAMPLES)
    return 1.0 - apart / (2.0 * SAMPLES)


def _least_similarity(percent: int) -> float:
    return percent / 100 - margin(percent)


def _differing_bits(a: Column, b: Column) -> Column:
    counts = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(counts, F.lit(0), lambda s, x: s + x)


def shared_buckets(classes: DataFrame) -> DataFrame:
    """The entries (bucket, node) of buckets that hold several classes; most hold one."""
    entries = classes.select(F.explode("bands").alias("bucket"), "node")
    several = entries.groupBy("bucket").count().where("count > 1").select("bucket")
    return entries.join(several, "bucket", "left_semi")


def star_pairs(
    classes: DataFrame, percent: int = PERCENT, shared: DataFrame | None = None
) -> DataFrame:
    """For each class the bucket centre most similar by its sketch, if that allows a link: (a, b).

    A bucket's centre is its smallest class. ``shared`` are the ``shared_buckets`` of the classes.
    """
    entries = shared_buckets(classes) if shared is None else shared
    centres = entries.groupBy("bucket").agg(F.min("node").alias("a"))
    pairs = (
        entries.join(centres, "bucket").where("node <> a")
        .select("a", F.col("node").alias("b")).distinct()
    )
    own = classes.select("node", "sketch", "n_shingles")
    left = own.select(*[F.col(c).alias(f"{c}_a") for c in own.columns])
    right = own.select(*[F.col(c).alias(f"{c}_b") for c in own.columns])
    both = pairs.join(right, pairs["b"] == right["node_b"]).join(left, F.col("a") == left["node_a"])
    small = F.least("n_shingles_a", "n_shingles_b")
    large = F.greatest("n_shingles_a", "n_shingles_b")
    near = similarity(_differing_bits(F.col("sketch_a"), F.col("sketch_b")))
    return (
        both.where(100 * small >= percent * large)
        .where(near >= _least_similarity(percent))
        .groupBy("b").agg(F.max_by("a", F.struct(near, "a")).alias("a"))
        .select("a", "b")
    )


def _grouped(classes: DataFrame, labels: DataFrame) -> DataFrame:
    return classes.join(labels, "node", "left").select(
        "node", "bands", "sketch", "n_shingles", F.coalesce("component", "node").alias("label")
    )


def _mixed_buckets(grouped: DataFrame, percent: int, shared: DataFrame | None = None) -> DataFrame:
    """Members of buckets with classes of different groups, in pairs of blocks (i, j).

    A large bucket is cut by set size into levels, of which only neighbours can hold a pair: the
    sizes of two levels apart differ by more than the limit allows. Levels are cut into blocks.
    """
    step = math.log(100 / min(percent, 99)) * (1 + 1e-9)
    shared = shared_buckets(grouped) if shared is None else shared
    level = F.floor(F.log("n_shingles") / step).cast("bigint").alias("level")
    entries = shared.join(grouped.select("node", "label", "n_shingles", level), "node")
    measures = [F.min("label").alias("low"), F.max("label").alias("high")]
    by_level = entries.groupBy("bucket", "level").agg(
        *measures, F.count("*").alias("n"), F.sum("n_shingles").alias("size")
    )
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("size") / BLOCK_SHINGLES))
    # A bucket has few levels, since they grow with the logarithm of a size.
    level = F.struct("level", F.struct("low", "high", blocks.alias("blocks")))
    buckets = by_level.groupBy("bucket").agg(
        F.min("low").alias("least"), F.max("high").alias("most"),
        ((F.sum("n") <= BLOCK) & (F.sum("size") <= BLOCK_SHINGLES)).alias("small"),
        F.map_from_entries(F.collect_list(level)).alias("levels"),
    ).where("least <> most").select("bucket", "small", "levels")

    at = F.col("levels")[F.col("level")]
    own = F.shiftleft(F.col("level"), 32) + F.pmod(F.xxhash64("node"), at["blocks"])

    def against(other: Column) -> Column:
        """Pairs of blocks with another level; none if both hold one and the same group."""
        there = F.col("levels")[other]
        mixed_labels = F.least(at["low"], there["low"]) != F.greatest(at["high"], there["high"])
        return F.when(there.isNull() | ~mixed_labels, F.array().cast("array<bigint>")).otherwise(
            F.transform(
                F.sequence(F.lit(0).cast("bigint"), there["blocks"] - 1),
                lambda block: F.shiftleft(other, 32) + block,
            )
        )

    others = F.concat(*[against(F.col("level") + away) for away in (-1, 0, 1)])
    dealt = entries.join(buckets, "bucket").select(
        "bucket", "node", F.when(F.col("small"), F.lit(0)).otherwise(own).alias("own"),
        F.when(F.col("small"), F.array(F.lit(0).cast("bigint"))).otherwise(others).alias("others"),
    ).select("bucket", "node", "own", F.explode("others").alias("other"))
    member = F.struct("own", "node", "label", "n_shingles", "sketch", "bands")
    return (
        dealt.select("bucket", "node", "own", F.least("own", "other").alias("i"),
                     F.greatest("own", "other").alias("j"))
        .join(possible(grouped, "node", slots(shared.select("node"))), "node")
        .groupBy("bucket", "i", "j").agg(F.collect_list(member).alias("members"))
        .select("bucket", "i", "j", "members")
    )


FIELDS = ("own", "node", "label", "n_shingles")


def _allowed(
    key: tuple, own: np.ndarray, label: np.ndarray, size: np.ndarray, sketch: np.ndarray,
    bands: np.ndarray, percent: int,
) -> Iterator[tuple[int, np.ndarray]]:
    """For the members of a block (bucket, i, j) those of other groups that their sketches allow.

    A pair belongs to the first bucket that its classes share. Yields positions in the block.
    """
    bucket, first, second = key
    bits = 64 * SKETCH_LONGS
    # The same estimate as ``similarity``, solved for the number of differing bits.
    most_bits = bits / 2 * (1 - np.exp(-4 * (1 - _least_similarity(percent)) * SAMPLES / bits))
    right = np.flatnonzero(own == second)
    for x in np.flatnonzero(own == first):
        y = right[right > x] if first == second else right
        y = y[label[y] != label[x]]
        small, large = np.minimum(size[y], size[x]), np.maximum(size[y], size[x])
        y = y[100 * small >= percent * large]
        differing = np.bitwise_count(sketch[y] ^ sketch[x]).sum(1, dtype=np.int64)
        y = y[differing <= most_bits]
        if len(y):
            y = y[bands[x][(bands[y] == bands[x]).argmax(1)] == bucket]
        if len(y):
            yield x, y


def _table(flat: Callable[[str], pa.Array], percent: int) -> dict[str, np.ndarray]:
    """The columns of members; sketches and bands as rows of a table."""
    out = {f: flat(f).to_numpy(False) for f in FIELDS}
    out["sketch"] = flat("sketch").flatten().to_numpy(False).view(np.uint64).reshape(-1, SKETCH_LONGS)
    out["bands"] = flat("bands").flatten().to_numpy(False).reshape(-1, bands_of(percent))
    return out


def cross_members(
    grouped: DataFrame, percent: int = PERCENT, shared: DataFrame | None = None
) -> DataFrame:
    """Members of blocks with a pair to verify there: (bucket, i, j, own, node)."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        lists = batch.column("members")
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        column = _table(lists.flatten().field, percent)
        keys = [batch.column(c).to_numpy() for c in ("bucket", "i", "j")]
        wanted = np.zeros(len(column["node"]), bool)
        for k, key in enumerate(zip(*keys)):
            here = slice(offsets[k], offsets[k + 1])
            fields = [column[f][here] for f in ("own", "label", "n_shingles", "sketch", "bands")]
            for x, y in _allowed(key, *fields, percent):
                wanted[here][x] = wanted[here][y] = True
        found = np.flatnonzero(wanted)
        if len(found):
            block = np.searchsorted(offsets, found, "right") - 1
            yield {
                **{c: k[block] for c, k in zip(("bucket", "i", "j"), keys)},
                "own": column["own"][found], "node": column["node"][found],
            }

    schema = "bucket bigint, i bigint, j bigint, own bigint, node bigint"
    return map_batches(_mixed_buckets(grouped, percent, shared), work, schema)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows in order of their block, block by block."""
    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("bucket", "i", "j")])
        edges = (np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist()
        for begin, end in zip([0, *edges], [*edges, batch.num_rows]):
            here = tuple(keys[:, begin].tolist())
            if held and here != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = here
            held.append(batch.slice(begin, end - begin))
    if held:
        yield key, pa.Table.from_batches(held)


def _joined(key: tuple, rows: pa.Table, percent: int) -> Iterator[tuple[int, int]]:
    """Links (a, b) that the full sets confirm, as many as join the groups of a block up."""
    column = _table(lambda f: rows.column(f).combine_chunks(), percent)
    sets = [np.frombuffer(x, np.uint64) for x in rows.column("shingles").to_pylist()]
    node, label = column["node"], column["label"]
    above: dict[int, int] = {}

    def top(group: int) -> int:
        while group in above:
            group = above[group]
        return group

    fields = [column[f] for f in ("own", "label", "n_shingles", "sketch", "bands")]
    for x, others in _allowed(key, *fields, percent):
        for y in others.tolist():
            one, other = top(int(label[x])), top(int(label[y]))
            if one != other and similar(sets[x], sets[y], percent):
                above[max(one, other)] = min(one, other)
                yield int(node[x]), int(node[y])


def cross_links(
    docs: DataFrame, classes: DataFrame, labels: DataFrame, width: int = WIDTH,
    percent: int = PERCENT, shared: DataFrame | None = None,
) -> DataFrame:
    """Links (a, b) between classes of different groups that join these groups up."""
    spark = docs.sparkSession
    grouped = _grouped(classes, labels)
    members = saved(spark, cross_members(grouped, percent, shared), "members")
    nodes = members.select("node").distinct()
    sets = full_sets(docs, classes, nodes, width)
    block = ["bucket", "i", "j"]
    own = possible(grouped, "node", slots(nodes))
    rows = members.join(sets, "node").join(own, "node").repartition(*block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, table in _blocks(batches):
            links = list(_joined(key, table, percent))
            if links:
                columns = [pa.array(c, pa.int64()) for c in zip(*links)]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return rows.sortWithinPartitions(*block).mapInArrow(run, "a bigint, b bigint")


def similar(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Whether two ascending sets reach the similarity."""
    places = np.minimum(np.searchsorted(other, one), len(other) - 1)
    shared = int((other[places] == one).sum())
    return 100 * shared >= percent * (len(one) + len(other) - shared)


def full_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """The shingle sets of the named classes: (node, shingles)."""
    names = classes.join(nodes, "node").select(F.col("rep").alias("doc_id"), "node")
    names = saved(docs.sparkSession, names, "names")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def sets(batch: pa.RecordBatch) -> Iterator[dict]:
        hasher = kept(("hasher",), Hasher)
        nodes = batch.column("node").to_pylist()
        lowered = (x.lower() for x in byte_texts(batch.column("text")))
        for first, hashes, bounds in hasher.texts(lowered):
            rows = []
            for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]), first):
                own = shingle_set(hashes[a:b], width)
                name = int(mixed(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                if name == nodes[i] % (1 << 64):
                    rows.append((nodes[i], own.tobytes()))
            yield {"node": [n for n, _ in rows], "shingles": [s for _, s in rows]}

    # Rows that repeat give the same set twice; rows with another text under the same doc_id
    # are left out by the name of the set.
    texts = possible(texts, "doc_id", slots(names.select("doc_id")))
    full = map_batches(texts.join(names, "doc_id"), sets, "node bigint, shingles binary")
    return full.dropDuplicates(["node"])


def verified(
    docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """The pairs whose full shingle sets are as similar as asked."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    full = full_sets(docs, classes, nodes, width)
    left = full.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    right = full.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))

    def check(batch: pa.RecordBatch) -> Iterator[dict]:
        good_a, good_b = [], []
        for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "set_a", "set_b"))):
            if similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent):
                good_a.append(a)
                good_b.append(b)
        yield {"a": good_a, "b": good_b}

    both = pairs.select("a", "b").join(right, "b").join(left, "a")
    return map_batches(both, check, "a bigint, b bigint")


def near_duplicates(
    spark: SparkSession, docs: DataFrame, width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with its group: the smallest doc_id it reaches.

    Texts are compared by their distinct shingles of ``width`` words, A-Z in lower case; a shorter
    text is one shingle. A document without words, or with a null text, is linked with nothing.
    A row without a doc_id keeps a null component and is kept. Rows with the same doc_id and
    different texts are grouped each by its own text. Repeated rows stay, each with its group. An
    empty table gives an empty one.
    """
    signed = saved(spark, signatures(docs, width, percent), "signatures")
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Rows of one key have the same set, and so the same size, bands and sketch.
    classes = usable.groupBy(F.col("key_a").alias("node"), "key_b").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands"), F.first("sketch").alias("sketch"),
    )
    classes = saved(spark, classes, "classes")

    shared = saved(spark, shared_buckets(classes), "shared")
    pairs = saved(spark, star_pairs(classes, percent, shared), "pairs")
    links = saved(spark, verified(docs, classes, pairs, width, percent), "links")
    labels = components(links)
    cross = saved(spark, cross_links(docs, classes, labels, width, percent, shared), "links")
    if not cross.isEmpty():
        labels = components(links.union(cross))

    # A group is named by the smallest document of its classes.
    grouped = classes.select("node", "key_b", "rep").join(labels, "node", "left").select(
        "node", "key_b", "rep", F.coalesce("component", "node").alias("label")
    )
    smallest = grouped.groupBy("label").agg(F.min("rep").alias("group"))
    named = grouped.join(smallest, "label").select(F.col("node").alias("key_a"), "key_b", "group")
    members = signed.select("doc_id", "n_shingles", "key_a", "key_b")
    joined = members.join(named, ["key_a", "key_b"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("group"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(component, "doc_id"))
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
