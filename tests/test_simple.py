"""Per-trip basic features on literal rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import T0, points, trip
from trackwise.functions.geo import gps_dist
from trackwise.functions.timefmt import hour_of_day
from trackwise.plans import complex as j2
from trackwise.plans import simple as j1
from trackwise.schemas import SIMPLE_COLUMNS, SIMPLE_HOURS, SIMPLE_SPEED_BINS


def test_trip_bounds_closed_interval_fraction_kept(spark):
    pts = points(spark, [(30.0, 120.0, 1.0, 0, 0), (30.0, 120.0, 1.0, 0, 10), (30.0, 120.0, 1.0, 0, 10.5)])
    tr = trip(spark, 0, 10)
    got = j1.assign_trips(j1.seconds_points(pts), tr).select("time_stamp").collect()
    assert sorted(r[0] for r in got) == [T0, T0 + 10]            # s_end + 0.5 is out
    got = j2.trip_points_trunc(pts, tr).select("time_stamp").collect()
    assert sorted(r[0] for r in got) == [T0, T0 + 10, T0 + 10]   # truncated: in


def test_trips_with_non_positive_start_are_ignored(spark):
    from helpers import TRIP_SCHEMA
    pts = spark.createDataFrame([("1", 30.0, 120.0, 1.0, 0, 5000)], "imei string, lat double, lon double, speed double, direction int, time_stamp long")
    tr = spark.createDataFrame([("1", "t", "v", 0, 10)], TRIP_SCHEMA)
    assert j1.assign_trips(j1.seconds_points(pts), tr).count() == 0


def test_last_point_and_jumps_are_dropped(spark):
    step = 1e-4
    rows = [(30.0 + i * step, 120.0, 10.0, 0, i) for i in range(5)]
    rows[2] = (31.0, 120.0, 10.0, 0, 2)   # a 111 km jump
    out = j1.simple_trip_features(points(spark, rows), trip(spark)).first()
    # kept: row 0 (to row 1 is short)... row 1 -> jump: dropped, row 2 -> back: dropped,
    # row 3 -> row 4 kept, row 4 -> default (0, 0): dropped
    assert out["dura_valid"] == 2
    assert out["start_time"] == T0 and out["end_time"] == T0 + 3
    assert out["lat_st"] == 30.0 and out["lat_end"] == pytest.approx(30.0 + 3 * step)


def brute_force_simple(pts, trips):
    """The plain formulation: a window over every row (copies included)."""
    pts = j1.seconds_points(pts)
    tr = trips.select("tid", "vid", "deviceid", F.col("start").alias("tripnumber"), "s_end")
    d = pts.join(tr, (pts.imei == tr.deviceid) & (pts.time_stamp >= tr.tripnumber)
                 & (pts.time_stamp <= tr.s_end)).where(F.col("tripnumber") > 0)
    w = Window.partitionBy("imei", "tripnumber").orderBy(*[F.asc_nulls_first(c) for c in j1.ORDER])
    d = d.withColumns({"lat_0": F.lead("lat", 1, 0.0).over(w), "lon_0": F.lead("lon", 1, 0.0).over(w)})
    d = d.withColumn("am", gps_dist("lat", "lon", "lat_0", "lon_0")).where(F.col("am") < 10)
    h = hour_of_day(F.col("time_stamp"))
    k = F.ceil(F.col("speed") / 10)
    wf = Window.partitionBy("imei", "vid", "tripnumber").orderBy(
        *[F.asc_nulls_first(c) for c in ["time_stamp", "lat", "lon", "speed", "tid", "s_end"]]
    ).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = d.withColumns({"f_lat": F.first("lat").over(wf), "f_lon": F.first("lon").over(wf),
                       "l_lat": F.last("lat").over(wf), "l_lon": F.last("lon").over(wf)})
    aggs = [F.min("time_stamp").alias("start_time"), F.max("time_stamp").alias("end_time"),
            (F.max("s_end") - F.min("tripnumber")).alias("dura"),
            F.count_distinct("time_stamp").alias("dura_valid"),
            F.first("f_lat").alias("lat_st"), F.first("f_lon").alias("lon_st"),
            F.first("l_lat").alias("lat_end"), F.first("l_lon").alias("lon_end"),
            F.sum("am").alias("mileage")]
    aggs += [F.sum(F.when(h == i, F.col("am")).otherwise(0.0)).alias(n) for i, n in enumerate(SIMPLE_HOURS)]
    aggs += [F.sum(F.when(k == i, 1).otherwise(0)).cast("long").alias(n) for i, n in enumerate(SIMPLE_SPEED_BINS[:-1])]
    aggs.append(F.sum(F.when(F.col("speed") > 200, 1).otherwise(0)).cast("long").alias(SIMPLE_SPEED_BINS[-1]))
    return d.groupBy("imei", "vid", "tripnumber").agg(*aggs).select(*SIMPLE_COLUMNS)


def _rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_copy_collapsing_equals_plain_window(spark, seed):
    rnd = random.Random(seed)
    rows, lat = [], 30.0
    for i in range(150):
        lat += rnd.choice([1e-4, 2e-4, -1e-4])
        la = 31.5 if rnd.random() < 0.05 else (0.0 if rnd.random() < 0.03 else lat)
        sp = None if rnd.random() < 0.1 else rnd.choice([0.0, 5.0, 10.0, 55.5, 201.0])
        r = (la, 120.0, sp, 0, i + rnd.choice([0, 0.25, 0.5]))
        rows += [r] * rnd.choice([1, 1, 1, 2, 5])   # exact copies, also at the end
    pts = points(spark, rows)
    tr = trip(spark, 0, 150)
    assert _rows(j1.simple_trip_features(pts, tr)) == _rows(brute_force_simple(pts, tr))


def test_hot_copy_group_is_one_row_after_collapse(spark):
    rows = [(30.0, 120.0, 10.0, 0, 1)] * 500 + [(30.0001, 120.0, 10.0, 0, 2)]
    collapsed = j1.trip_point_rows(points(spark, rows), trip(spark))
    assert collapsed.count() == 2
    assert sorted(r["copies"] for r in collapsed.collect()) == [1, 500]
    out = j1.simple_trip_features(points(spark, rows), trip(spark)).first()
    # 499 copies have a copy as successor (kept), the last one the next point (kept);
    # the final point's successor is (0, 0): dropped
    assert out["speed_0_10"] == 500 and out["dura_valid"] == 1
