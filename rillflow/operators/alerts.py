"""Keyed alerts over ordered readings (STA-01 .. STA-04)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.operators.ordered import HOT_ID, OrderedKeys, Running

# Fixed value: the text of the rise alarm, with the interval in seconds.
RISE_MESSAGE = "温度值连续{seconds}秒上升"

SHORT_RUN = 200


def jump_alerts(
    df: DataFrame, key: str, value: str, order: list[str], threshold: float,
    initial: float | None = None, every_row: bool = False, limit: int | None = None,
) -> DataFrame:
    """(key, previous, current) where a value moves by more than the threshold.

    ``initial`` is the value before the first row: none means no alert on it (STA-01),
    0 lets it alert (STA-02). With ``every_row`` quiet rows give (key, 0, 0) (STA-03).
    """
    scanned = OrderedKeys.of(df.select(key, value, *order), [key], order, limit)
    rows = scanned.previous(previous=value).frame()
    before = F.col("previous")
    if initial is not None:
        before = F.coalesce(before, F.lit(float(initial)))
    jumped = F.coalesce(F.abs(F.col(value) - before) > threshold, F.lit(False))
    if not every_row:
        return rows.where(jumped).select(
            key, *order, before.alias("previous"), F.col(value).alias("current")
        )
    quiet = F.lit(0.0)
    return rows.select(
        key, *order,
        F.when(jumped, before).otherwise(quiet).alias("previous"),
        F.when(jumped, F.col(value)).otherwise(quiet).alias("current"),
    )


def rise_alarms(
    df: DataFrame, key: str, value: str, time: str, order: list[str], seconds: int,
    limit: int | None = None,
) -> DataFrame:
    """Alarms for values that do not fall for ``seconds`` after a rise (STA-04).

    The first rise arms a timer, a fall up to and including the due time cancels it, an
    equal reading does neither; after firing, the next rise later than the due time arms
    again. The value before the first row is 0. ``time`` is in epoch milliseconds.
    """
    wait = seconds * 1000
    scanned = OrderedKeys.of(
        df.select(key, value, *{time, *order}), [key], order, limit
    ).previous(_before=value)
    before = F.coalesce(F.col("_before"), F.lit(0.0))
    scanned = scanned.map(
        lambda part: part.withColumns({
            "_fall": F.col(value) < before, "_rise": F.col(value) > before
        })
    ).running(_run=Running("sum", F.col("_fall").cast("bigint")))

    # A run has no fall inside. A rise counts for its own run, the fall that opens a run
    # tells when the one before ended; so one grouping has all there is to know of a run.
    fall = F.col("_fall")
    told = scanned.frame().where(fall | F.col("_rise")).select(
        key, F.when(fall, F.col("_run") - 1).otherwise(F.col("_run")).alias("_run"),
        F.col(time).alias("told_at"),
        F.when(~fall, F.col(time)).alias("rise_at"), F.when(fall, F.col(time)).alias("run_end"),
    )
    runs = OrderedKeys.of(told, [key, "_run"], ["told_at"], limit)
    grouped = runs.cold.groupBy(key, "_run").agg(
        F.sort_array(F.collect_list("rise_at")).alias("rises"), F.max("run_end").alias("run_end")
    )
    # Walk the sorted rise times of a run and keep each one later than the last due time. Short
    # runs, nearly all of them, are walked in the JVM; growing an array there costs a copy for
    # each alarm, so the longer ones are walked as arrays of a column.
    short = F.size("rises") <= SHORT_RUN
    walked = F.aggregate(
        "rises", F.array().cast("array<bigint>"),
        lambda kept, at: F.when(
            (F.size(kept) == 0) | (at > F.element_at(kept, -1) + wait),
            F.concat(kept, F.array(at)),
        ).otherwise(kept),
    )
    kept = [
        grouped.where(short).select(key, "run_end", F.explode(walked).alias("armed_at")),
        grouped.where(~short).select(key, "run_end", F.explode(_walk(wait)("rises")).alias("armed_at")),
    ]
    armed = kept[0].unionByName(kept[1])
    if runs.hot is not None:
        armed = armed.unionByName(_chain(runs, key, wait))
    due = F.col("armed_at") + wait
    fired = armed.where(F.col("run_end").isNull() | (due < F.col("run_end")))
    message = RISE_MESSAGE.format(seconds=seconds)
    return fired.select(key, "armed_at", due.alias("due_at"), F.lit(message).alias("message"))


def _walk(wait: int):
    """The kept rise times of long runs; each step jumps over the rises before the due time."""

    def walk(runs: pd.Series) -> pd.Series:
        def one(rises: np.ndarray) -> list[int]:
            kept, i = [], 0
            while i < len(rises):
                kept.append(rises[i])
                i = np.searchsorted(rises, rises[i] + wait, side="right")
            return kept

        return runs.map(one)

    return F.pandas_udf(walk, "array<bigint>")


def _chain(runs: OrderedKeys, key: str, wait: int) -> DataFrame:
    """Armed times of runs too long for one task, by pointer doubling.

    Every rise points to the first rise later than its due time. Following 1, 2, 4, ...
    pointers at once reaches the whole chain in a logarithmic number of joins.
    """
    rises = runs.hot.where("rise_at IS NOT NULL")
    rises = rises.select(HOT_ID, F.col("rise_at").alias("at")).distinct().checkpoint()
    # Scan backwards: due times look for the nearest rise already passed.
    points = rises.select(HOT_ID, "at", F.col("at").alias("pos"), F.lit(1).alias("kind"))
    dues = rises.select(HOT_ID, "at", (F.col("at") + wait).alias("pos"), F.lit(0).alias("kind"))
    both = points.unionByName(dues).withColumns({
        "back": -F.col("pos"), "point": F.when(F.col("kind") == 1, F.col("at"))
    }).withColumnRenamed(HOT_ID, "run_id")
    scan = OrderedKeys.of(both, ["run_id"], ["back", "kind", "at"], runs.limit)
    jumps = (
        scan.running(before=True, nxt=Running("min", F.col("point"))).frame()
        .where((F.col("kind") == 0) & F.col("nxt").isNotNull())
        .select("run_id", "at", "nxt").checkpoint()
    )
    reached = rises.groupBy(F.col(HOT_ID).alias("run_id")).agg(F.min("at").alias("at"))
    while True:
        found = reached.join(jumps, ["run_id", "at"]).select("run_id", F.col("nxt").alias("at"))
        grown = reached.unionByName(found).distinct().checkpoint()
        if grown.count() == reached.count():
            break
        reached = grown
        onward = jumps.select("run_id", F.col("at").alias("nxt"), F.col("nxt").alias("far"))
        jumps = (
            jumps.join(onward, ["run_id", "nxt"])
            .select("run_id", "at", F.col("far").alias("nxt")).checkpoint()
        )
    # One row per hot run: at most total rows / limit of them.
    about = runs.hot.groupBy(F.col(HOT_ID).alias("run_id")).agg(
        F.first(key).alias(key), F.max("run_end").alias("run_end")
    )
    named = reached.join(about, "run_id")
    return named.select(key, "run_end", F.col("at").alias("armed_at"))
