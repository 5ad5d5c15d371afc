"""The large-data plan paths give the same answers as the small-data ones."""

import re

from helpers import T0, points, trip, TRIP_SCHEMA
from trackwise.operators.range_join import points_in_intervals
from trackwise.plans import complex as j2
from trackwise.plans import simple as j1
from trackwise.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


def test_shuffle_join_path_equals_broadcast_path(spark):
    pts, trips, coh = fx.gps_points(spark, SF), fx.trip_stat(spark, SF), fx.cohort(spark, SF)
    want1 = _rows(j1.simple_trip_features(pts, trips))
    want2 = _rows(j2.complex_trip_features(pts, trips, coh))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = j1.simple_trip_features(pts, trips)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert re.search(r"hashpartitioning\(deviceid#\d+, _bucket#\d+L", plan)
        assert _rows(df) == want1
        assert _rows(j2.complex_trip_features(pts, trips, coh)) == want2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_bucket_size_does_not_change_matches(spark):
    # one device, trips spanning several hours, points every 7 minutes
    rows = [(30.0 + i * 1e-3, 120.0, 10.0, 0, i * 420) for i in range(60)]
    pts = j1.seconds_points(points(spark, rows))
    tr = spark.createDataFrame([("1", "a", "v", T0 + 0, T0 + 3 * 3600 + 5),
                                ("1", "b", "v", T0 + 3600, T0 + 7200),          # overlaps a
                                ("1", "c", "v", T0 + 5 * 3600, T0 + 5 * 3600)], TRIP_SCHEMA)
    kw = dict(point_key="imei", interval_key="deviceid", ts="time_stamp", start="start", end="s_end")
    small = _rows(points_in_intervals(pts, tr, bucket_seconds=600, **kw).select("tid", "time_stamp"))
    hour = _rows(points_in_intervals(pts, tr, **kw).select("tid", "time_stamp"))
    whole = _rows(points_in_intervals(pts, tr, bucket_seconds=10 ** 9, **kw).select("tid", "time_stamp"))
    assert small == hour == whole
    assert sum(1 for t, _ in hour if t == "a") == 26 and sum(1 for t, _ in hour if t == "b") == 9


def test_kinematic_plan_has_one_trip_exchange(spark):
    rows = [(30.0 + i * 1e-4, 120.0, 10.0, (i * 7) % 360, i) for i in range(70)]
    df = j2.complex_trip_features(points(spark, rows), trip(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    trip_exchanges = re.findall(r"Exchange hashpartitioning\(imei#\d+, tripnumber#\d+", plan)
    assert len(trip_exchanges) == 1
    # the aggregate sits on the window output: no exchange in between
    top = plan.split("Window")[0]
    assert "Exchange" not in top


def test_stand_in_sums_in_chunks_equal_one_window(spark, monkeypatch):
    want = _rows(fx.gps_points(spark, SF))
    monkeypatch.setattr(fx, "CHUNK", 50)
    assert _rows(fx.gps_points(spark, SF)) == want
