"""Event-time and count windows (WIN-01 .. WIN-07). Durations are whole seconds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.group import GroupedData
from pyspark.sql.types import StructType

from rillflow.operators.ordered import OrderedKeys, Running


def window_of(time: Column | str, size: int, slide: int | None = None, offset: int = 0) -> Column:
    """Tumbling or sliding window; any offset is reduced to one below the slide."""
    slide = slide or size
    return F.window(time, f"{size} seconds", f"{slide} seconds", f"{offset % slide} seconds")


def windowed(
    df: DataFrame, keys: list[str], time: str, size: int, slide: int | None = None, offset: int = 0
) -> GroupedData:
    """Group by key and window; built-in aggregates combine before the shuffle."""
    return df.groupBy(*keys, window_of(time, size, slide, offset).alias("window"))


def millis(time: Column) -> Column:
    return F.unix_millis(time.cast("timestamp"))


def window_counts(
    df: DataFrame, keys: list[str], time: str, size: int, slide: int | None = None, offset: int = 0
) -> DataFrame:
    """(key, window start in epoch ms, rows) (WIN-01 .. WIN-03).

    A batch of sliding windows is counted once per slide; the small counts, not the rows, are
    then copied into the windows they belong to.
    """
    rows = F.count(F.lit(1)).alias("cnt")
    shown = [*keys, millis(F.col("window.start")).alias("window_start"), "cnt"]
    slide = slide or size
    if slide == size or size % slide or df.isStreaming:
        return windowed(df, keys, time, size, slide, offset).agg(rows).select(*shown)
    panes = windowed(df, keys, time, slide, offset=offset).agg(rows).select(*shown)
    back = F.explode(F.sequence(F.lit(0), F.lit(size - slide), F.lit(slide)))
    copies = panes.withColumn("_back", back)
    starts = (F.col("window_start") - F.col("_back") * 1000).alias("window_start")
    return copies.groupBy(*keys, starts).agg(F.sum("cnt").alias("cnt"))


def sessions(
    df: DataFrame, keys: list[str], time: str, order: list[str], gap: int, limit: int | None = None
) -> DataFrame:
    """Sessions closed by silence longer than ``gap`` (WIN-04).

    Events exactly one gap apart stay together. Hot keys are scanned in slices and
    grouped by session, so no task holds a whole hot key.
    """
    split = OrderedKeys.of(df.select(*{*keys, time, *order}), keys, order, limit)
    silence = F.make_dt_interval(secs=F.lit(gap))

    def shaped(grouped: GroupedData) -> DataFrame:
        found = grouped.agg(
            F.min(time).alias("first_ts"), F.max(time).alias("last_ts"),
            F.count(F.lit(1)).alias("cnt"),
        )
        return found.select(
            *keys, millis(F.col("first_ts")).alias("session_start"),
            millis(F.col("last_ts") + silence).alias("session_end"), "cnt",
        )

    cold = shaped(split.cold.groupBy(*keys, F.session_window(time, f"{gap} seconds")))
    if split.hot is None:
        return cold
    starts = F.col("_before").isNull() | (F.col(time) > F.col("_before") + silence)
    hot = split.previous(_before=time).running(_session=Running("sum", starts.cast("bigint"))).hot
    return cold.unionByName(shaped(hot.groupBy(*keys, "_session")))


def count_windows(
    df: DataFrame, keys: list[str], order: list[str], size: int, slide: int,
    limit: int | None = None, **aggregates: Column,
) -> DataFrame:
    """Every ``slide`` rows of a key, aggregates over its last ``size`` rows (WIN-05).

    The first firings hold fewer than ``size`` rows.
    """
    scanned = OrderedKeys.of(df, keys, order, limit).numbered("rn").trailing(size, **aggregates)
    fired = scanned.map(lambda part: part.where(F.col("rn") % slide == 0))
    return fired.frame().select(*keys, "rn", *aggregates)


def full_window(
    df: DataFrame, keys: list[str], time: str, size: int, schema: StructType | str,
    partial: Callable[[pd.DataFrame, list[str]], pd.DataFrame],
    merge: Callable[[pd.DataFrame, list[str]], pd.DataFrame],
) -> DataFrame:
    """A user function over all rows of a window (WIN-07, EXT-02, EXT-03).

    The function comes in two parts so that no task must hold a whole window. ``partial`` gets
    a batch of rows of many windows and the grouping columns (keys and ``window_start``) and
    gives one row of ``schema`` per window; ``merge`` makes one row per window of such rows. A
    null key is a key: grouping inside them needs ``dropna=False``.
    Tasks merge before the shuffle and, as a window's rows arrive together, while they come in.
    """
    stamped = df.withColumn("window_start", millis(window_of(time, size)["start"]))
    group = [*keys, "window_start"]

    def plain(rows: pd.DataFrame) -> pd.DataFrame:
        """Columns of nulls alone as nulls of any type: pandas makes them numbers."""
        missing = [c for c in rows.columns if rows[c].isna().all()]
        return rows.assign(**{c: pd.Series([None] * len(rows), rows.index, object) for c in missing})

    def shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            found = partial(batch, group)
            held = found if held is None else merge(pd.concat([held, found]), group)
            if len(held) > 100_000:
                yield plain(held)
                held = None
        if held is not None:
            yield plain(held)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            found = merge(batch if held is None else pd.concat([held, batch]), group)
            mine, end = found[group], batch[group].iloc[-1]
            last = ((mine == end) | (mine.isna() & end.isna())).all(axis=1)
            held = found[last]
            yield plain(found[~last])
        if held is not None:
            yield plain(held)

    partials = stamped.mapInPandas(shrink, schema)
    together = partials.repartition(*group).sortWithinPartitions(*group)
    return together.mapInPandas(finish, schema)
