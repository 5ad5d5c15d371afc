"""Point-in-trip join edge cases."""

from pyspark.sql import functions as F

from helpers import T0, TRIP_SCHEMA, points
from trackwise.operators.range_join import points_in_intervals_outer
from trackwise.plans import simple as j1


def test_outer_form_keeps_one_row_per_unmatched_trip_spanning_buckets(spark):
    pts = j1.seconds_points(points(spark, [(30.0, 120.0, 5.0, 0, 10)]))
    trips = spark.createDataFrame([("1", "hit", "v", T0, T0 + 60),
                                   ("1", "miss", "v", T0 + 100, T0 + 5 * 3600),     # spans 6 buckets
                                   ("2", "other", "v", T0, T0 + 60)], TRIP_SCHEMA)
    out = points_in_intervals_outer(pts, trips, point_key="imei", interval_key="deviceid",
                                    ts="time_stamp", start="start", end="s_end",
                                    interval_id=["tid", "vid", "deviceid", "start", "s_end"])
    got = sorted((r["tid"], r["imei"]) for r in out.collect())
    assert got == [("hit", "1"), ("miss", None), ("other", None)]


def test_day_runs_match_points_and_trips_of_the_same_day_only(spark):
    rows = [(30.0 + i * 1e-4, 120.0, 5.0, 0, i) for i in range(5)]
    pts = points(spark, rows).withColumn(
        "stat_date", F.when(F.col("time_stamp") < (T0 + 3) * 1000, "20240101").otherwise("20240102"))
    trips = spark.createDataFrame([("1", "t", "v", T0, T0 + 10)], TRIP_SCHEMA) \
        .withColumn("stat_date", F.lit("20240101"))
    by_day = j1.assign_trips(j1.seconds_points(pts, ("stat_date",)), trips, by_day=True)
    assert sorted(r["time_stamp"] for r in by_day.collect()) == [T0, T0 + 1, T0 + 2]
    plain = j1.assign_trips(j1.seconds_points(pts), trips.drop("stat_date"))
    assert plain.count() == 5
