"""Sensor readings: filters, counts, windows, alerts, late data."""

from pyspark.sql import functions as F

from rillflow.operators import aggregates, alerts, lateness, relational, windows
from tests.conftest import rows


def test_equality_filter_and_group_count(sensors):
    assert [r.seq for r in sensors.where("id = 'sensor_1'").orderBy("seq").collect()] == [1, 5, 6, 7]
    counted = dict(rows(aggregates.group_count(sensors, "id")))
    assert counted == {"sensor_1": 4, "sensor_6": 1, "sensor_7": 1, "sensor_10": 1}


def test_retract_changelog(sensors):
    log = aggregates.retract_changelog(sensors, "id", ["seq"]).where("id = 'sensor_1'").orderBy("step")
    assert [(r.is_add, r.cnt) for r in log.collect()] == [
        (True, 1), (False, 1), (True, 2), (False, 2), (True, 3), (False, 3), (True, 4)
    ]


def test_reduce_and_min_by(sensors):
    reduced = aggregates.reduce_readings(sensors, "id").where("id = 'sensor_1'")
    assert rows(reduced) == [("sensor_1", 1547718299, 26.8)]
    both = aggregates.min_and_min_by(
        sensors.select("id", "temperature", "timestamp", "seq").withColumn("temperature", -F.col("temperature")),
        "id", "temperature", ["seq"],
    ).where("id = 'sensor_1'").first()
    assert (both.temperature, both.min_timestamp, both.minby_timestamp) == (-38.3, 1547718299, 1547718215)


def test_side_output_threshold_is_exclusive(spark, sensors):
    high, low = relational.threshold_split(sensors, "temperature", 30)
    assert sorted(r.seq for r in high.collect()) == [4, 5, 6, 7]
    assert low.columns == ["id", "temperature", "timestamp"] and low.count() == 3
    edge = spark.createDataFrame([("a", 30.0, 1)], "id string, temperature double, timestamp bigint")
    assert relational.threshold_split(edge, "temperature", 30)[1].count() == 1


def test_tumbling_windows(sensors):
    base = 1547718000000
    assert rows(windows.window_counts(sensors, ["id"], "ts", 15)) == [
        ("sensor_1", base + 195_000, 1), ("sensor_1", base + 210_000, 2),
        ("sensor_1", base + 285_000, 1), ("sensor_10", base + 195_000, 1),
        ("sensor_6", base + 195_000, 1), ("sensor_7", base + 195_000, 1),
    ]


def test_window_offsets_wrap(spark):
    df = spark.sql("SELECT 1 AS id, timestamp_ntz'2024-01-02 15:59:59' AS ts UNION ALL "
                   "SELECT 1, timestamp_ntz'2024-01-02 16:00:00'")
    day = windows.window_counts(df, ["id"], "ts", 86_400, offset=-8 * 3600)
    starts = [r.window_start // 3_600_000 % 24 for r in day.collect()]
    assert starts == [16, 16] and day.count() == 2
    hour = windows.window_counts(df, ["id"], "ts", 3600, offset=-8 * 3600)
    assert hour.count() == 2


def test_sessions_touching_exactly_one_gap_apart_merge(spark):
    df = spark.sql("SELECT 1 AS id, 1L AS seq, timestamp_ntz'2024-01-01 00:00:00' AS ts UNION ALL "
                   "SELECT 1, 2L, timestamp_ntz'2024-01-01 00:01:00' UNION ALL "
                   "SELECT 1, 3L, timestamp_ntz'2024-01-01 00:02:01'")
    for limit in (None, 1):
        found = windows.sessions(df, ["id"], "ts", ["ts", "seq"], 60, limit=limit)
        assert sorted(r.cnt for r in found.collect()) == [1, 2]


def test_jump_alerts_follow_the_given_order(sensors):
    def found(order, **more):
        out = alerts.jump_alerts(sensors, "id", "temperature", order, 10.0, **more)
        return sorted((r.id, r.previous, r.current) for r in out.collect())

    assert found(["seq"]) == [("sensor_1", 26.8, 37.2)]
    assert found(["timestamp"]) == [("sensor_1", 38.3, 26.8)]
    assert found(["seq"], initial=0) == [
        ("sensor_1", 0.0, 26.8), ("sensor_1", 26.8, 37.2), ("sensor_10", 0.0, 38.1), ("sensor_6", 0.0, 15.4)
    ]
    every = found(["seq"], initial=0, every_row=True)
    assert len(every) == 7 and every.count(("sensor_1", 0.0, 0.0)) == 2


def test_rise_alarm(spark):
    def alarms(values, limit=None):
        df = spark.createDataFrame(
            [("a", i, at, float(v)) for i, (at, v) in enumerate(values)],
            "id string, seq bigint, ms bigint, temperature double",
        )
        out = alerts.rise_alarms(df, "id", "temperature", "ms", ["ms", "seq"], 10, limit=limit)
        return sorted(r.armed_at for r in out.collect())

    for limit in (None, 2):
        assert alarms([(0, 1), (5000, 2), (11_000, 2)], limit) == [0]          # equal does nothing
        assert alarms([(0, 1), (10_000, 0.5)], limit) == []                    # a fall when due cancels
        assert alarms([(0, 1), (10_001, 0.5)], limit) == [0]
        assert alarms([(0, 1), (10_000, 2), (10_001, 3)], limit) == [0, 10_001]  # arms again after firing
        assert alarms([(0, -1), (1000, 1), (2000, 0)], limit) == []            # starts at zero
        assert alarms([(0, 1), (4000, 3), (8000, 2), (9000, 4)], limit) == [9000]
    message = alerts.RISE_MESSAGE.format(seconds=10)
    assert message == "温度值连续10秒上升"


def test_file_order_makes_later_rows_late(sensors):
    ms = sensors.withColumns({"ms": F.col("timestamp") * 1000, "source": F.lit("file")})
    for limit in (None, 2):
        marked = lateness.with_watermark_before(ms, "source", ["seq"], "ms", 1000, limit=limit)
        late = {r.seq: r.is_late for r in lateness.flag_late(marked, "ms").collect()}
        assert late == {1: False, 2: True, 3: True, 4: True, 5: True, 6: True, 7: True}
        fates = {r.seq: r.fate for r in lateness.triage(marked, "ms", 15_000, 80_000).collect()}
        assert fates[1] == "on_time" and fates[7] == "late" and fates[2] == "too_late"


def test_punctuated_watermark_moves_for_one_sensor_only(sensors):
    ms = sensors.withColumns({"ms": F.col("timestamp") * 1000, "source": F.lit("file")})
    marked = lateness.with_watermark_before(
        ms, "source", ["seq"], "ms", 1000, advances=F.col("id") == "sensor_6"
    )
    marks = {r.seq: r.watermark for r in marked.collect()}
    assert marks[1] is None and marks[2] is None and marks[3] == 1547718200000
