"""Days, repeated rows and ids that the small tables do not reach."""

import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

import oracle_sql
from compare import diff, duck, run_oracle
from helpers import POINT_SCHEMA, T0, TRIP_SCHEMA, points, trip
from trackwise import session
from trackwise.operators import range_join
from trackwise.plans import backfill, registry
from trackwise.plans import complex as j2
from trackwise.plans import rollup as j3
from trackwise.plans import simple as j1
from trackwise.sources import readers, sinks

SF = "/root/testdata/sf0.001"
DAY_QUERIES = ["date_range_backfill", "complex_date_range_backfill", "validity_join", "plausible_trips", "vehicle_rollup",
               "vehicle_csv_line", "trips_per_day"]


def rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def late_users(spark):
    """The smallest tables with users whose tracks lie years later and cross midnight."""
    d = tempfile.mkdtemp(prefix="tw-late-")
    for t in os.listdir(SF):
        if t != "events.parquet":
            os.symlink(f"{SF}/{t}", f"{d}/{t}")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    user = F.when(F.col("user_id") % 3 == 0, 52_800 + F.col("user_id")).when(F.col("user_id") % 3 == 1, 144).otherwise(60_000)
    ev.withColumn("user_id", user.cast(ev.schema["user_id"].dataType)).coalesce(1).write.parquet(f"{d}/events.parquet")
    return d


@pytest.mark.parametrize("key", DAY_QUERIES)
def test_no_day_is_lost(spark, late_users, key):
    got = registry.QUERIES[key](spark, late_users).toPandas()
    con = duck(SF)
    con.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM read_parquet('{late_users}/events.parquet/*.parquet')")
    assert diff(got, run_oracle(con, oracle_sql.oracle_sql()[key])) == []


def two_day_inputs(spark):
    """140 points around midnight; one trip over both days, listed under both."""
    start = 86400 - 70
    pts = points(spark, [(30.0 + i * 1e-4, 120.0, 10.0, (i * 7) % 360, start + i) for i in range(140)])
    trips = spark.createDataFrame([("1", "t", "v", T0 + start, T0 + start + 200)], TRIP_SCHEMA)
    days = F.explode(F.array(F.lit("20240101"), F.lit("20240102")))
    return (pts.withColumn("stat_date", F.when(F.col("time_stamp") < (T0 + 86400) * 1000, "20240101").otherwise("20240102")),
            trips.withColumn("stat_date", days))


@pytest.mark.parametrize("job", [backfill.simple_for_days, lambda p, t, a, b: backfill.complex_for_days(p, t, None, a, b)])
def test_a_two_day_run_is_two_one_day_runs(spark, job):
    pts, trips = two_day_inputs(spark)
    both = rows(job(pts, trips, "2024-01-01", "2024-01-02"))
    one = rows(job(pts, trips, "2024-01-01", "2024-01-01")) + rows(job(pts, trips, "2024-01-02", "2024-01-02"))
    assert len(both) == 2 and both == sorted(one, key=str)
    assert all(v is not None for v in (r[i] for r in both for i in range(8)))


def test_a_repeated_trip_row_changes_no_kinematic_feature(spark):
    pts = points(spark, [(30.0 + i * 1e-4, 120.0 + (i % 7) * 1e-5, 10.0 + i % 3, (i * 7) % 360, i) for i in range(90)])
    once = trip(spark, 0, 100)
    want = rows(j2.complex_trip_features(pts, once))
    assert len(want) == 1
    assert rows(j2.complex_trip_features(pts, once.unionByName(once))) == want
    assert rows(j2.complex_trip_features(pts, once.unionByName(trip(spark, 0, 300)))) == want


def test_copies_without_a_position_are_not_kept(spark):
    pts = points(spark, [(30.0 + i * 1e-4, 120.0, 10.0, 0, i) for i in range(10)])
    lost = spark.createDataFrame([("1", None, 120.0, 45.0, 0, (T0 + 20) * 1000)] * 5, POINT_SCHEMA)
    found = j1.simple_rows(pts.unionByName(lost), trip(spark))
    assert found.where("lat IS NULL").agg(F.sum("kept")).first()[0] == 0
    assert j1.aggregate_trips(found).select("speed_40_50").first()[0] == 0


def test_outer_join_matches_intervals_without_ids(spark):
    pts = j1.seconds_points(points(spark, [(30.0, 120.0, 1.0, 0, i) for i in range(5)]))
    iv = spark.createDataFrame([("1", None, "v", T0, T0 + 10), ("1", "b", None, T0 + 100, T0 + 110)], TRIP_SCHEMA)
    out = range_join.points_in_intervals_outer(pts, iv, point_key="imei", interval_key="deviceid", ts="time_stamp", start="start",
                                               end="s_end", interval_id=["tid", "vid", "deviceid", "start", "s_end"]).collect()
    assert len(out) == 6 and sum(r["imei"] is None for r in out) == 1


def test_an_endless_interval_costs_few_rows(spark):
    iv = spark.createDataFrame([("1", "a", "v", 0, 2_000_000_000), ("1", "b", "v", T0, T0 + 5)], TRIP_SCHEMA)
    assert range_join.expand_intervals(iv, "start", "s_end").count() < 100
    pts = j1.seconds_points(points(spark, [(30.0, 120.0, 1.0, 0, i * 3) for i in range(20)]))
    kw = dict(point_key="imei", interval_key="deviceid", ts="time_stamp", start="start", end="s_end")
    got = range_join.points_in_intervals(pts, iv, **kw).groupBy("tid").count().collect()
    assert {r["tid"]: r["count"] for r in got} == {"a": 20, "b": 2}


def test_points_are_not_shuffled_before_a_broadcast_join(spark):
    pts = points(spark, [(30.0 + i * 1e-4, 120.0, 10.0, (i * 7) % 360, i) for i in range(70)])
    j2_plan = j2.complex_trip_features(pts, trip(spark))._jdf.queryExecution().executedPlan().toString()
    # one exchange of the collapsed rows, one by trip
    assert j2_plan[:j2_plan.index("BroadcastHashJoin")].count("Exchange hashpartitioning") == 2
    for df in (j1.simple_trip_features(pts, trip(spark)), j2.complex_trip_features(pts, trip(spark))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        join = plan.index("BroadcastHashJoin")
        below = plan[join:].split("BroadcastExchange")[0]
        assert "Exchange" not in below.replace("BroadcastHashJoin", "")


def test_a_long_trip_is_spread_over_its_hours(spark):
    """Successors, first and last rows and sums across the hours of one trip equal one plain window."""
    from pyspark.sql import Window

    pts = points(spark, [(30.0 + (i % 50) * 1e-4, 120.0 + i * 1e-6, float(i % 90), 0, i * 7.25 + (i > 900) * 9000) for i in range(2000)])
    rows_ = j1.simple_rows(pts, trip(spark, 0, 40_000))
    w = Window.partitionBy("imei", "tripnumber").orderBy(*[F.asc_nulls_first(c) for c in j1.ORDER])
    plain = rows_.select("time_stamp", "lat_0", "lon_0", F.lead("lat", 1, 0.0).over(w).alias("a"), F.lead("lon", 1, 0.0).over(w).alias("b"))
    assert plain.where("lat_0 <> a OR lon_0 <> b").count() == 0 and rows_.select(j1.PART).distinct().count() == 5
    assert re.search(r"Exchange hashpartitioning\(imei#\d+, tripnumber#\d+, _part",
                     rows_._jdf.queryExecution().executedPlan().toString())
    r = j1.aggregate_trips(rows_).first()
    kept = rows_.where("kept > 0").orderBy("time_stamp").collect()
    assert (r["lat_st"], r["lon_st"], r["lat_end"], r["lon_end"]) == (kept[0]["lat"], kept[0]["lon"], kept[-1]["lat"], kept[-1]["lon"])
    assert abs(r["mileage"] - sum(k["am"] for k in kept)) < 1e-9 and r["dura_valid"] == len({k["time_stamp"] for k in kept})


def test_a_small_cohort_keeps_the_broadcast(spark):
    pts = points(spark, [(30.0 + i * 1e-4, 120.0, 10.0, 0, i) for i in range(70)])
    trips = spark.range(2000).selectExpr("cast(id AS string) AS deviceid", "'t' AS tid", "'v' AS vid", f"{T0} AS start", f"{T0 + 90} AS s_end")
    cohort = spark.createDataFrame([("1",)], "imei string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        plan = j2.complex_trip_features(pts, trips, cohort)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [imei" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_day_without_rows_loses_its_directory(spark):
    base = session.staging_path(spark, "days")
    df = spark.createDataFrame([("1", "20240101"), ("2", "20240102"), ("3", "20240105")], "imei string, stat_date string")
    sinks.write_day_partitioned(df, base)
    sinks.write_day_partitioned(df.where("imei = '1'"), base, days=("20240101", "20240103"))
    assert rows(readers.read_trip_features(spark, base)) == [("1", "20240101"), ("3", "20240105")]


def test_the_writer_runs_the_plan_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(100).selectExpr("cast(id AS string) AS imei", "cast(20240101 + id % 3 AS string) AS stat_date")
    sinks.write_day_partitioned(df.mapInArrow(count, df.schema), session.staging_path(spark, "once"))
    assert seen.value == 100


def test_rollup_does_not_expand_rows(spark):
    feats = registry._feature_table(spark, SF)
    df = j3.vehicle_features(feats, registry._validity(spark, SF))
    assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai"])
def test_rollup_in_two_session_zones(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = registry.vehicle_rollup(spark, SF).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert diff(got, run_oracle(duck(SF), oracle_sql.oracle_sql()["vehicle_rollup"])) == []


def test_no_machine_local_folder_on_a_cluster():
    class Conf:
        def get(self, key):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
