"""Whitening of embeddings on the leading eigenvectors of their covariance.

Sums of the covariance are exact: vectors are whole numbers, centred by the whole number next to
their mean before they are multiplied, and what the mean has beyond it is taken off at the end.
Tasks send sums of products, never vectors; the driver holds one matrix of the vectors' dimension.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm.arrow import map_batches, struct_of, to_arrow_schema
from rillflow.llm.eigen import WIDE, eigen
from rillflow.llm.scratch import saved

STEPS_PER_ONE = 256
COMPONENTS = 4
HALF = 32
# Bits of a digit; most sums of a task are one digit long.
DIGIT = 48
WRAP = 1 << 64
# Doubles hold every whole number up to here.
WHOLE = 1 << 53
WHITENED = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double,"
    " identity_error double"
)


def stepped(embeddings: DataFrame) -> DataFrame:
    """Usable rows of ``embeddings`` (vec_id, embedding) as whole numbers: (vec_id, x).

    Rows go whose vector is null or empty or holds null or non-finite entries.
    """
    finite = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    return embeddings.where(
        F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.coalesce(finite, F.lit(False))
    ).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.transform(
            "embedding", lambda c: F.floor(c.cast("double") * STEPS_PER_ONE).cast("bigint")
        ).alias("x"),
    )


def _table(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _digits(values: list[int], **keys) -> dict:
    """Numbers of any size as rows that Spark can add up: the digits of each, by their place."""
    rows = []
    for at, value in enumerate(values):
        place = 0
        while value >> (DIGIT - 1) not in (0, -1):
            rows.append((at, place, value & ((1 << DIGIT) - 1)))
            place, value = place + 1, value >> DIGIT
        rows.append((at, place, value))
    at, place, digit = zip(*rows)
    picked = list(at)
    return {"place": place, "digit": digit, **{k: np.asarray(v)[picked] for k, v in keys.items()}}


def _added(df: DataFrame, *keys: str) -> dict[tuple, int]:
    """The sum of the numbers of each key; the keys are dimensions, so there are few."""
    total = F.sum(F.col("digit").cast("decimal(38,0)")).alias("digit")
    out: dict[tuple, int] = {}
    for r in df.groupBy(*keys, "place").agg(total).collect():
        key = tuple(r[k] for k in keys)
        out[key] = out.get(key, 0) + (int(r["digit"]) << (DIGIT * r["place"]))
    return out


def _per_task(df: DataFrame, size: int, work, finish, schema: str) -> DataFrame:
    """``work`` takes the vectors of each batch; ``finish`` gives the rows of the task."""
    target = to_arrow_schema(struct_of(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                held = work(held, _table(batch.column("x"), size))
        if held is not None:
            columns = finish(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) for f in target], schema=target
            )

    return df.select("x").mapInArrow(run, schema)


def sums(fit: DataFrame, size: int) -> list[int]:
    """The exact sum of each dimension."""

    def work(held, x: np.ndarray):
        high = (x >> HALF).sum(0).astype(object)
        low = (x & ((1 << HALF) - 1)).sum(0).astype(object)
        total = high * (1 << HALF) + low
        return total if held is None else held + total

    def finish(held) -> dict:
        return _digits([int(v) for v in held], i=range(size))

    found = _added(_per_task(fit, size, work, finish, "i int, place int, digit bigint"), "i")
    return [found[(i,)] for i in range(size)]


def _products(z: np.ndarray) -> np.ndarray:
    """The exact sum of z z' over the rows, as Python numbers."""
    total = np.zeros((z.shape[1], z.shape[1]), object)
    top = np.abs(z).max(1, initial=0)
    # A product of two entries of these rows may have more digits than a double.
    wide = (top >= 1 << 26) | (top < 0)
    if wide.any():
        rows = z[wide].astype(object)
        total += rows.T @ rows
    plain = z[~wide].astype(float)
    step = max(1, WHOLE // max(1, int(top[~wide].max(initial=1)) ** 2))
    for at in range(0, len(plain), step):
        rows = plain[at : at + step]
        total += (rows.T @ rows).astype(np.int64).astype(object)
    return total


def products(fit: DataFrame, size: int, centre: list[int]) -> np.ndarray:
    """The exact sum of (x - centre)(x - centre)' as Python numbers."""
    upper = np.triu_indices(size)

    def work(held, x: np.ndarray):
        if np.abs(x.astype(float)).max() + max(map(abs, centre)) >= float(1 << 62):
            found = x.astype(object) - np.array(centre, object)
            found = found.T @ found
        else:
            found = _products(x - np.array(centre, np.int64))
        return found if held is None else held + found

    def finish(held) -> dict:
        return _digits([int(v) for v in held[upper]], i=upper[0], j=upper[1])

    schema = "i int, j int, place int, digit bigint"
    out = np.zeros((size, size), object)
    for (i, j), value in _added(_per_task(fit, size, work, finish, schema), "i", "j").items():
        out[i, j] = out[j, i] = value
    return out


def _quotient(top: int, bottom: int) -> np.longdouble:
    """A fraction to more than double precision."""
    near = top / bottom
    a, b = near.as_integer_ratio()
    return WIDE(near) + WIDE((top * b - a * bottom) / (bottom * b))


@dataclass
class Whitening:
    """What a fit knows: count, sums, centre, leading components and their eigenvalues."""

    n: int
    sums: list[int]
    centre: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def usable(self) -> np.ndarray:
        """Which components have a variance to divide by."""
        least = len(self.sums) * np.finfo(float).eps * max(self.values.max(initial=0), 0)
        return self.values > least

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, where the whole part of the mean goes first."""
        rest = [(s - self.n * m) / self.n for s, m in zip(self.sums, self.centre)]
        return (x - np.array(self.centre, np.int64)).astype(float) - np.array(rest)

    def project(self, x: np.ndarray) -> np.ndarray:
        """The whitened components of each vector; NaN where there is no variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.usable, 1 / np.sqrt(self.values), np.nan)
        return (self.centred(x) @ self.vectors) * scale

    def deviations(self, x: np.ndarray) -> np.ma.MaskedArray:
        """The sum of (n x - S)^2, exact; masked where it needs more than 64 bits."""
        n, s = self.n % WRAP, np.array([v % WRAP for v in self.sums], np.uint64)
        away = x.view(np.uint64) * np.uint64(n) - s
        exact = (away * away).sum(1, dtype=np.uint64).view(np.int64)
        about = ((self.centred(x) * self.n) ** 2).sum(1)
        return np.ma.array(exact, mask=about >= 2.0**63 * (1 - 1e-9))


def fit_whitening(
    spark: SparkSession, vectors: DataFrame, components: int = COMPONENTS
) -> Whitening | None:
    """Fit on each distinct vector of ``vectors`` (x) once; None when there is none.

    The dimension is the most frequent one among distinct vectors, of equally frequent ones the
    largest; others are left out.
    """
    distinct = saved(spark, vectors.select("x").distinct(), "vectors")
    sizes = distinct.groupBy(F.size("x").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    if most is None:
        return None
    size, n = most["size"], most["count"]
    fit = distinct.where(F.size("x") == size)
    totals = sums(fit, size)
    centre = [(2 * s + n) // (2 * n) for s in totals]
    rest = [s - n * m for s, m in zip(totals, centre)]
    found = products(fit, size, centre)
    covariance = np.array([
        [_quotient(n * found[i, j] - rest[i] * rest[j], n * n) for j in range(size)]
        for i in range(size)
    ], WIDE)
    values, columns = eigen(covariance)
    kept = min(components, size)
    model = Whitening(
        n, totals, centre, values[:kept].astype(float), columns[:, :kept].astype(float),
        float(np.trace(covariance)),
    )
    model.identity_error = identity_error(fit, size, model)
    return model


def identity_error(fit: DataFrame, size: int, model: Whitening) -> float | None:
    """The largest entry of the whitened vectors' covariance without the identity.

    Components without variance do not count; None when none has any.
    """
    kept = np.flatnonzero(model.usable)
    if not len(kept):
        return None
    i, j = np.triu_indices(len(kept))

    def work(held, x: np.ndarray):
        w = model.project(x)[:, kept]
        found = np.concatenate([w.sum(0), (w.T @ w)[i, j]])
        return found if held is None else held + found

    def finish(held) -> dict:
        return {"at": range(len(held)), "total": held}

    rows = (
        _per_task(fit, size, work, finish, "at int, total double")
        .groupBy("at").agg(F.sum("total").alias("total")).collect()
    )
    totals = np.array([r["total"] for r in sorted(rows, key=lambda r: r["at"])]) / model.n
    mean, found = totals[: len(kept)], totals[len(kept) :]
    # The mean of whitened vectors is what rounding left; it is taken off all the same.
    return float(np.abs(found - mean[i] * mean[j] - (i == j)).max())


def whiten(
    spark: SparkSession, embeddings: DataFrame, components: int = COMPONENTS
) -> DataFrame:
    """Each usable row of ``embeddings`` on the leading components, one row per component.

    Repeated rows stay and count once in the fit; a null vec_id stays null. Vectors of another
    dimension than most are left out like those with non-finite entries. A component without
    variance has no ``whitened``, a deviation beyond 64 bits is null, and without any variance
    ``explained`` is 0 and ``identity_error`` null. An empty table gives an empty one.
    """
    rows = stepped(embeddings)
    model = fit_whitening(spark, rows, components)
    if model is None:
        return spark.createDataFrame([], WHITENED)
    size, kept = len(model.sums), len(model.values)
    share = model.values / model.trace if model.trace > 0 else np.zeros(kept)

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        x = _table(batch.column("x"), size)
        count = len(x)
        found, away = model.project(x).ravel(), np.ma.repeat(model.deviations(x), kept)
        yield {
            "vec_id": batch.column("vec_id").take(pa.array(np.repeat(np.arange(count), kept))),
            "component": np.tile(np.arange(1, kept + 1, dtype=np.int32), count),
            "n": np.full(count * kept, model.n),
            "deviation": pa.array(away.data, mask=np.ma.getmaskarray(away)),
            "whitened": pa.array(found, mask=np.isnan(found)),
            "explained": np.tile(share, count),
            "identity_error": pa.array([model.identity_error] * (count * kept), pa.float64()),
        }

    return map_batches(rows.where(F.size("x") == size), work, WHITENED)
