"""Event-time windows, alerts and late data."""

import pandas as pd
from pyspark.sql import functions as F

from rillflow.catalog.records import DELAYED, PAGE_VIEWS, READINGS, delayed_readings, page_views, readings
from rillflow.catalog.registry import query
from rillflow.operators import alerts, lateness, windows
from rillflow.plans.daily_users import entries, first_per_day

HOUR, DAY = 3600, 86_400


@query(f"""WITH {READINGS} SELECT id, ms - ms % 15000 AS window_start, count(*) AS cnt
FROM readings GROUP BY ALL""")
def tumbling_15s(t):
    """WIN-01."""
    return windows.window_counts(readings(t), ["id"], "ts", 15)


@query(f"""WITH {READINGS}, spread AS (
  SELECT id, ms - ms % 900000 - 900000 * unnest(range(4)) AS window_start FROM readings)
SELECT id, window_start, count(*) AS cnt FROM spread GROUP BY ALL""")
def sliding_window(t):
    """WIN-02: an hour long, every quarter of an hour."""
    return windows.window_counts(readings(t), ["id"], "ts", HOUR, 900)


@query(f"""WITH {READINGS}
SELECT id, (ms + 28800000) - (ms + 28800000) % 86400000 - 28800000 AS window_start, count(*) AS cnt
FROM readings GROUP BY ALL""")
def offset_day_window(t):
    """WIN-03: days that begin eight hours early."""
    return windows.window_counts(readings(t), ["id"], "ts", DAY, offset=-8 * HOUR)


SESSIONS = f"""WITH {READINGS}, marked AS (
  SELECT id, ts, seq, CASE WHEN ts - lag(ts) OVER w > INTERVAL 6 HOUR OR lag(ts) OVER w IS NULL
         THEN 1 ELSE 0 END AS opens FROM readings WINDOW w AS (PARTITION BY id ORDER BY ts, seq)),
numbered AS (SELECT id, ts, sum(opens) OVER (PARTITION BY id ORDER BY ts, seq) AS session FROM marked),
sessions AS (
  SELECT id, epoch_us(min(ts)) // 1000 AS session_start, epoch_us(max(ts) + INTERVAL 6 HOUR) // 1000 AS session_end,
         count(*) AS cnt FROM numbered GROUP BY id, session)"""


@query(f"{SESSIONS} SELECT * FROM sessions")
def session_window(t):
    """WIN-04."""
    return windows.sessions(readings(t), ["id"], "ts", ["ts", "seq"], 6 * HOUR)


COUNT_WINDOWS = f"""WITH {READINGS}, numbered AS (
  SELECT id, row_number() OVER o AS rn, count(*) OVER w AS cnt, min(temperature) OVER w AS low,
         max(temperature) OVER w AS high FROM readings
  WINDOW o AS (PARTITION BY id ORDER BY ts, seq),
         w AS (PARTITION BY id ORDER BY ts, seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
SELECT id, rn, cnt, low, high FROM numbered WHERE rn % 2 = 0"""


@query(COUNT_WINDOWS)
def count_window_10_2(t):
    """WIN-05."""
    return windows.count_windows(
        readings(t).select("id", "ts", "seq", "temperature"), ["id"], ["ts", "seq"], 10, 2,
        cnt=F.count(F.lit(1)), low=F.min("temperature"), high=F.max("temperature"),
    )


@query(f"""WITH {READINGS} SELECT id, ms - ms % 3600000 AS window_start, max("timestamp") AS "timestamp",
       min(temperature) AS temperature FROM readings GROUP BY ALL""")
def window_reduce(t):
    """WIN-06."""
    reduced = windows.windowed(readings(t), ["id"], "ts", HOUR).agg(
        F.max("timestamp").alias("timestamp"), F.min("temperature").alias("temperature")
    )
    start = windows.millis(F.col("window.start")).alias("window_start")
    return reduced.select("id", start, "timestamp", "temperature")


def _sizes(rows: pd.DataFrame, by: list[str]) -> pd.DataFrame:
    return rows.groupby(by, as_index=False, dropna=False).size().rename(columns={"size": "cnt"})


def _add_sizes(rows: pd.DataFrame, by: list[str]) -> pd.DataFrame:
    return rows.groupby(by, as_index=False, dropna=False)["cnt"].sum()


@query(f"""WITH {READINGS}, found AS (
  SELECT CASE WHEN kind <> 'click' THEN id END AS id, ms FROM readings)
SELECT id, ms - ms % 86400000 AS window_start, count(*) AS cnt FROM found GROUP BY ALL""")
def full_window_function(t):
    """WIN-07, EXT-02, EXT-03: a user function over whole windows, in two parts; null is a key."""
    some = F.when(F.col("kind") != "click", F.col("id")).alias("id")
    return windows.full_window(
        readings(t).select(some, "ts"), ["id"], "ts", DAY,
        "id string, window_start bigint, cnt bigint", _sizes, _add_sizes,
    )


JUMPS = f"""WITH {READINGS}, lagged AS (
  SELECT id, ts, seq, temperature AS current,
         lag(temperature) OVER (PARTITION BY id ORDER BY ts, seq) AS previous FROM readings)"""


@query(f"{JUMPS} SELECT id, seq, previous, current FROM lagged WHERE abs(current - previous) > 10")
def jump_alert(t):
    """STA-01."""
    return alerts.jump_alerts(readings(t), "id", "temperature", ["ts", "seq"], 10.0).drop("ts")


@query(f"""{JUMPS} SELECT id, seq, coalesce(previous, 0) AS previous, current FROM lagged
WHERE abs(current - coalesce(previous, 0)) > 10""")
def jump_alert_zero_init(t):
    """STA-02."""
    return alerts.jump_alerts(
        readings(t), "id", "temperature", ["ts", "seq"], 10.0, initial=0
    ).drop("ts")


@query(f"""{JUMPS}, flagged AS (
  SELECT *, abs(current - coalesce(previous, 0)) > 10 AS jumped FROM lagged)
SELECT id, seq, CASE WHEN jumped THEN coalesce(previous, 0) ELSE 0 END AS previous,
       CASE WHEN jumped THEN current ELSE 0 END AS current FROM flagged""")
def jump_alert_map(t):
    """STA-03: one output per input."""
    return alerts.jump_alerts(
        readings(t), "id", "temperature", ["ts", "seq"], 10.0, initial=0, every_row=True
    ).drop("ts")


WAIT = 6 * HOUR
RISES = f"""WITH RECURSIVE {READINGS}, lagged AS (
  SELECT id, ms, ts, seq, temperature AS now,
         coalesce(lag(temperature) OVER (PARTITION BY id ORDER BY ts, seq), 0) AS before
  FROM readings),
runs AS (
  SELECT *, sum(CASE WHEN now < before THEN 1 ELSE 0 END)
              OVER (PARTITION BY id ORDER BY ts, seq) AS run FROM lagged),
rises AS (SELECT id, run, ms FROM runs WHERE now > before),
ends AS (SELECT id, run - 1 AS run, ms AS run_end FROM runs WHERE now < before),
armed AS (
  SELECT id, run, min(ms) AS armed_at FROM rises GROUP BY id, run
  UNION ALL
  SELECT a.id, a.run, min(r.ms) FROM armed a
  JOIN rises r ON r.id = a.id AND r.run = a.run AND r.ms > a.armed_at + {WAIT * 1000}
  GROUP BY a.id, a.run),
alarms AS (
  SELECT a.id, armed_at, armed_at + {WAIT * 1000} AS due_at, '温度值连续{WAIT}秒上升' AS message
  FROM armed a LEFT JOIN ends e ON e.id = a.id AND e.run = a.run
  WHERE run_end IS NULL OR armed_at + {WAIT * 1000} < run_end)"""


@query(f"{RISES} SELECT id, armed_at, due_at, message FROM alarms")
def rise_alarm(t):
    """STA-04."""
    return alerts.rise_alarms(readings(t), "id", "temperature", "ms", ["ts", "seq"], WAIT)


LATE = f"""WITH {DELAYED}, marked AS (
  SELECT *, max(ms) OVER (PARTITION BY source ORDER BY arrival, seq
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1800000 AS watermark FROM delayed)"""


@query(f"""{LATE} SELECT seq, watermark, ms - ms % 3600000 AS window_start,
  CASE WHEN watermark IS NULL OR ms - ms % 3600000 + 3599999 > watermark THEN 'on_time'
       WHEN ms - ms % 3600000 + 3599999 + 1800000 > watermark THEN 'late'
       ELSE 'too_late' END AS fate FROM marked""")
def late_triage(t):
    """STR-03, STR-05: half an hour of disorder, half an hour of allowance."""
    marked = lateness.with_watermark_before(
        delayed_readings(t), "source", ["arrival", "seq"], "ms", 1_800_000
    )
    triaged = lateness.triage(marked, "ms", HOUR * 1000, 1_800_000)
    return triaged.select("seq", "watermark", "window_start", "fate")


@query(f"""WITH {DELAYED}, marked AS (
  SELECT *, max(CASE WHEN id = 'sensor_1' THEN ms END) OVER (PARTITION BY source ORDER BY arrival, seq
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1000 AS watermark FROM delayed)
SELECT seq, watermark, coalesce(ms <= watermark, false) AS is_late FROM marked""")
def punctuated_watermark(t):
    """STR-04: only one sensor's rows move the watermark."""
    marked = lateness.with_watermark_before(
        delayed_readings(t), "source", ["arrival", "seq"], "ms", 1000,
        advances=F.col("id") == "sensor_1",
    )
    return lateness.flag_late(marked, "ms").select("seq", "watermark", "is_late")


@query(f"""WITH {PAGE_VIEWS}, found AS (
  SELECT *, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS dt FROM page_views
  WHERE last_page_id IS NULL)
SELECT dt, mid, arg_min(ts, (ts, event_id)) AS ts, arg_min(event_id, (ts, event_id)) AS event_id
FROM found GROUP BY dt, mid""")
def dau_first_per_day(t):
    """STA-07."""
    found = entries(page_views(t)).select("dt", "mid", "ts", "event_id")
    return first_per_day(found, tie="event_id")
