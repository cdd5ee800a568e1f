"""Keyed state for readings (STA-01 .. STA-06, WIN-05, AGG-04 as streams).

State is held per bucket of keys: a call to the store or a frame for every key and batch costs
about a millisecond, so a processor takes the rows of a bucket together and reads and writes the
state of its keys as one value of arrays. What happens to a key depends on its own rows alone.

Rows of a key come unordered inside a micro-batch, so every processor sorts them by
(ts, seq) first. A micro-batch holds what the source's rate limit lets in, which bounds
the rows of one bucket; late rows are the watermark's business.

Input columns: id, ts (timestamp), seq, temperature.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rillflow.operators.alerts import RISE_MESSAGE

BUCKET = "_bucket"
BUCKETS = 256


class _Table:
    """State of the keys of a bucket: the fields of every key, saved as one value of arrays."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, **fields: str):
        arrays = ", ".join(f"{field} array<{kind}>" for field, kind in {"id": "string", **fields}.items())
        self._state = handle.getValueState(name, arrays)

    def read(self) -> dict:
        """Fields by key; a single field stands for itself."""
        found = self._state.get()
        if found is None:
            return {}
        ids, *fields = found
        return dict(zip(ids, fields[0] if len(fields) == 1 else zip(*fields)))

    def write(self, held: dict) -> None:
        if not held:
            self._state.clear()
            return
        rows = [(key, *(value if isinstance(value, tuple) else (value,))) for key, value in held.items()]
        self._state.update(tuple(map(list, zip(*rows))))


class _Rows:
    """Rows of a bucket, sorted by key and (ts, seq): ``code`` numbers the keys, ``starts`` and
    ``ends`` bound the rows of each."""

    def __init__(self, parts: Iterator[pd.DataFrame]):
        rows = pd.concat(list(parts), ignore_index=True)
        rows = rows.sort_values(["ts", "seq"], kind="stable", ignore_index=True)
        code, ids = pd.factorize(rows["id"], use_na_sentinel=False)
        order = np.argsort(code, kind="stable")
        self.frame = rows.take(order).reset_index(drop=True)
        self.code = code[order]
        self.ids = [None if pd.isna(key) else key for key in ids]
        self.starts = np.flatnonzero(np.diff(self.code, prepend=-1))
        self.ends = np.append(self.starts[1:], len(self.code))
        self.temperature = self.frame["temperature"].to_numpy(dtype="float64", na_value=np.nan)

    @property
    def sizes(self) -> np.ndarray:
        return self.ends - self.starts

    @property
    def place(self) -> np.ndarray:
        """How many rows of its key stand before a row."""
        return np.arange(len(self.code)) - self.starts[self.code]

    @property
    def millis(self) -> np.ndarray:
        return (self.frame["ts"].dt.as_unit("us").astype("int64") // 1000).to_numpy()

    def each(self) -> Iterator[tuple[str | None, int, int]]:
        return zip(self.ids, self.starts.tolist(), self.ends.tolist())

    def last(self) -> list[float]:
        return self.temperature[self.ends - 1].tolist()


class _Readings(StatefulProcessor):
    """Common shape: open states in `init`, the sorted rows of a bucket in every batch."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        out = self.step(_Rows(rows))
        if out is not None and len(out):
            yield out

    def step(self, rows: _Rows) -> pd.DataFrame | None:
        raise NotImplementedError

    def close(self) -> None:
        pass


class JumpAlert(_Readings):
    """Last-value alert; ``initial`` and ``every_row`` as in the batch form."""

    schema = "id string, seq bigint, previous double, current double"

    def __init__(self, threshold: float, initial: float | None = None, every_row: bool = False):
        self.threshold, self.initial, self.every_row = threshold, initial, every_row

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = _Table(handle, "last", temperature="double")

    def step(self, rows):
        held = self.last.read()
        now = rows.temperature
        before = np.roll(now, 1)
        before[rows.starts] = np.array([held.get(key, self.initial) for key in rows.ids], dtype="float64")
        self.last.write({**held, **dict(zip(rows.ids, rows.last()))})
        jumped = np.abs(now - before) > self.threshold
        out = rows.frame[["id", "seq"]].assign(previous=before, current=now)
        if self.every_row:
            out.loc[~jumped, ["previous", "current"]] = 0.0
            return out
        return out[jumped]


class RiseAlarm(_Readings):
    """Alarm when a value has not fallen for some seconds after a rise.

    The timer is an event-time timer of the bucket, at the earliest due time: when the watermark
    has passed it, all keys whose due time has passed give their alarms. A row that is later than
    the due time also proves that it has passed.
    """

    schema = "id string, armed_at bigint, due_at bigint, message string"

    def __init__(self, seconds: int):
        self.wait = seconds * 1000
        self.message = RISE_MESSAGE.format(seconds=seconds)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # A due time of 0 is none.
        self.state = _Table(handle, "rises", last="double", due="bigint")

    def _alarms(self, found: list[tuple[str | None, int]]) -> pd.DataFrame:
        return pd.DataFrame(
            [(key, due - self.wait, due, self.message) for key, due in found],
            columns=["id", "armed_at", "due_at", "message"],
        )

    @staticmethod
    def _earliest(held: dict) -> int:
        return min((due for _, due in held.values() if due), default=0)

    def step(self, rows):
        held = self.state.read()
        armed, alarms = self._earliest(held), []
        times, values = rows.millis.tolist(), rows.temperature.tolist()
        for key, start, end in rows.each():
            last, due = held.get(key, (0.0, 0))
            for at, value in zip(times[start:end], values[start:end]):
                if due and at > due:
                    alarms.append((key, due))
                    due = 0
                if value > last and not due:
                    due = at + self.wait
                elif value < last:
                    due = 0
                last = value
            held[key] = (last, due)
        self.state.write(held)
        earliest = self._earliest(held)
        if earliest != armed:
            if armed:
                self.handle.deleteTimer(armed)
            if earliest:
                self.handle.registerTimer(earliest)
        return self._alarms(alarms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, fired = self.state.read(), expiredTimerInfo.getExpiryTimeInMs()
        passed = max(timerValues.getCurrentWatermarkInMs(), fired + 1)
        over = [(name, due) for name, (_, due) in held.items() if 0 < due < passed]
        if over:
            self.state.write({**held, **{name: (held[name][0], 0) for name, _ in over}})
            earliest = self._earliest(self.state.read())
            if earliest:
                self.handle.registerTimer(earliest)
            yield self._alarms(over)


class CountWindow(_Readings):
    """Every ``slide`` rows, count, lowest and highest of the last ``size`` rows."""

    schema = "id string, rn bigint, cnt bigint, low double, high double"

    def __init__(self, size: int, slide: int):
        self.size, self.slide = size, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.tails = _Table(handle, "tails", seen="bigint", tail="array<double>")

    def step(self, rows):
        held = self.tails.read()
        seen, parts, new = [], [], []
        for key, start, end in rows.each():
            before, tail = held.get(key, (0, []))
            seen.append(before - len(tail))
            parts.append(np.concatenate([np.array(tail, dtype="float64"), rows.temperature[start:end]]))
            new.append(np.arange(len(parts[-1])) >= len(tail))
            kept = parts[-1][len(parts[-1]) - min(len(parts[-1]), self.size - 1):]
            held[key] = (before + end - start, kept.tolist())
        self.tails.write(held)
        values = np.concatenate(parts)
        place = np.concatenate([np.arange(len(part)) for part in parts])
        low, high = values.copy(), values.copy()
        for back in range(1, min(self.size, len(values))):
            here = np.flatnonzero(place >= back)
            low[here] = np.fmin(low[here], values[here - back])
            high[here] = np.fmax(high[here], values[here - back])
        rn = np.repeat(seen, [len(part) for part in parts]) + place + 1
        new = np.concatenate(new)
        out = rows.frame[["id"]].assign(
            rn=rn[new], cnt=np.minimum(rn, self.size)[new], low=low[new], high=high[new]
        )
        return out[out["rn"] % self.slide == 0]


class CountChanges(_Readings):
    """Add and withdraw messages of a running count."""

    schema = "id string, is_add boolean, cnt bigint, step bigint"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = _Table(handle, "seen", n="bigint")

    def step(self, rows):
        held = self.seen.read()
        before = np.array([held.get(key, 0) for key in rows.ids], dtype="int64")
        self.seen.write({**held, **dict(zip(rows.ids, (before + rows.sizes).tolist()))})
        n = np.repeat(before[rows.code] + rows.place + 1, 2)
        add = np.tile([False, True], len(rows.code))
        out = pd.DataFrame({
            "id": np.repeat(rows.frame["id"].to_numpy(dtype=object), 2), "is_add": add,
            "cnt": n - ~add, "step": 2 * n - 1 - ~add,
        })
        return out[out["cnt"] > 0]


class ReadingStates(_Readings):
    """Value, list, map and reducing state side by side (STA-05).

    Value: rows seen; list: the last readings; map: rows per whole degree band of ten;
    reducing: latest time and lowest temperature.
    """

    schema = "id string, cnt bigint, kept bigint, bands bigint, latest bigint, lowest double"

    def __init__(self, keep: int = 3):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cnt = _Table(handle, "cnt", n="bigint")
        self.recent = _Table(handle, "recent", temperatures="array<double>")
        self.bands = _Table(handle, "bands", band="array<bigint>", n="array<bigint>")
        self.reduced = _Table(handle, "reduced", latest="bigint", lowest="double")

    def step(self, rows):
        tables = (self.cnt, self.recent, self.bands, self.reduced)
        cnt, recent, bands, reduced = (table.read() for table in tables)
        latest = rows.millis[rows.ends - 1].tolist()
        lowest = np.fmin.reduceat(rows.temperature, rows.starts).tolist()
        band = np.floor(rows.temperature / 10)
        for i, (key, start, end) in enumerate(rows.each()):
            cnt[key] = cnt.get(key, 0) + end - start
            recent[key] = [*recent.get(key, []), *rows.temperature[max(start, end - self.keep):end].tolist()][-self.keep:]
            counted = dict(zip(*bands.get(key, ([], []))))
            own = band[start:end]
            for value, n in zip(*(a.tolist() for a in np.unique(own[~np.isnan(own)], return_counts=True))):
                counted[int(value)] = counted.get(int(value), 0) + n
            bands[key] = (list(counted), list(counted.values()))
            old = reduced.get(key, (latest[i], lowest[i]))
            reduced[key] = (max(latest[i], old[0]), float(np.fmin(lowest[i], old[1])))
        for table, held in zip(tables, (cnt, recent, bands, reduced)):
            table.write(held)
        return pd.DataFrame([
            (key, cnt[key], len(recent[key]), len(bands[key][0]), *reduced[key]) for key in rows.ids
        ], columns=["id", "cnt", "kept", "bands", "latest", "lowest"])


class FirstOfKind(_Readings):
    """The first reading of each kind, forgotten a while after it was last seen anew (STA-09).

    The entries of the map state have a time to live and go by themselves; nothing scans for them.
    The map is that of a bucket, so its keys are read in one go. The input has a ``kind`` as well.
    """

    schema = "id string, kind string, seq bigint"

    def __init__(self, live_seconds: int):
        self.live = live_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "id string, kind string", "seq bigint", ttlDurationMs=self.live)

    def step(self, rows):
        known = {tuple(key) for key in self.seen.keys()}
        first = rows.frame[["id", "kind", "seq"]].drop_duplicates(["id", "kind"])
        names = [
            tuple(None if pd.isna(part) else part for part in name) for name in zip(first["id"], first["kind"])
        ]
        first = first[[name not in known for name in names]]
        for name, seq in zip((name for name in names if name not in known), first["seq"]):
            self.seen.updateValue(name, (int(seq),))
        return first


class FirstInDay(StatefulProcessor):
    """The first entry of a device and day; what a table holds already is seen from the start (STA-08).

    The state begins as the rows given to the query, so a query that has lost its checkpoint goes
    on where its sink stands. A bucket holds devices of one day, so days that are over cost nothing.
    """

    schema = "dt string, mid string, ts bigint"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = _Table(handle, "seen", ts="bigint")

    @staticmethod
    def _first(rows: pd.DataFrame) -> dict:
        first = rows.groupby("mid", sort=False, dropna=False)["ts"].min()
        return {None if pd.isna(mid) else mid: int(ts) for mid, ts in zip(first.index, first)}

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.seen.write({**self._first(initialState), **self.seen.read()})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.seen.read()
        first = self._first(pd.concat(list(rows), ignore_index=True))
        new = {mid: ts for mid, ts in first.items() if mid not in held}
        if new:
            self.seen.write({**held, **new})
            yield pd.DataFrame({"dt": key[0], "mid": list(new), "ts": list(new.values())})

    def close(self) -> None:
        pass


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def first_in_day(entries: DataFrame, known: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """New devices of a day among ``entries`` (dt, mid, ts), beside those ``known`` (dt, mid, ts).

    ``known`` is read once, when the query starts without a checkpoint. ``buckets`` are those of
    a day.
    """
    seen, came = (_bucketed(df.select("dt", "mid", "ts"), "mid", buckets) for df in (known, entries))
    return came.groupBy("dt", BUCKET).transformWithStateInPandas(
        statefulProcessor=FirstInDay(), outputStructType=FirstInDay.schema, outputMode="Append",
        timeMode="None", initialState=seen.groupBy("dt", BUCKET),
    )


def keyed(
    readings: DataFrame, processor: _Readings, event_time: bool = False, time: str = "None",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Run a processor over the ids; with event time the readings carry a watermark.

    State with a time to live needs ``time="ProcessingTime"``. ``buckets`` should follow the number
    of ids, some dozens to each, and stays as it is for the query's life.
    Start the result with `jobs.start(..., store=jobs.ROCKSDB)`: this state needs that store.
    """
    return _bucketed(readings, "id", buckets).groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=processor.schema,
        outputMode="Update" if not event_time else "Append",
        timeMode="EventTime" if event_time else time,
    )
