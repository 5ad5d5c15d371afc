"""Scans read only what the jobs use: column pruning and day-partition pruning."""

import re
import tempfile

from trackwise.plans import backfill
from trackwise.plans import complex as j2
from trackwise.plans import simple as j1
from trackwise.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def _staged(spark):
    d = tempfile.mkdtemp(prefix="tw-prune-")
    fx.with_point_day(fx.gps_points(spark, SF, full_schema=True)).write.partitionBy("stat_date").parquet(f"{d}/gps")
    fx.with_trip_day(fx.trip_stat(spark, SF)).write.partitionBy("stat_date").parquet(f"{d}/trips")
    return spark.read.parquet(f"{d}/gps"), spark.read.parquet(f"{d}/trips")


def _formatted(spark, df) -> str:
    """The text of df.explain("formatted")."""
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _gps_read_schema(plan: str) -> set[str]:
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    gps = [s for s in schemas if "time_stamp" in s]
    assert gps, plan
    return {f.split(":")[0] for f in gps[0].split(",")}


def test_basic_job_reads_five_gps_columns_and_prunes_days(spark):
    pts, trips = _staged(spark)
    df = backfill.simple_for_days(pts, trips, "2024-01-02", "2024-01-02")
    plan = df._jdf.queryExecution().executedPlan().toString()
    formatted = _formatted(spark, df)
    assert _gps_read_schema(formatted) == {"imei", "lat", "lon", "speed", "time_stamp"}
    assert "PartitionFilters: [isnotnull(stat_date" in formatted and "20240102" in formatted
    assert "BroadcastHashJoin" in plan or "SortMergeJoin" in plan


def test_kinematic_job_reads_six_gps_columns(spark):
    pts, trips = _staged(spark)
    df = j2.complex_trip_features(pts, trips)
    formatted = _formatted(spark, df)
    assert _gps_read_schema(formatted) == {"imei", "lat", "lon", "direction", "speed", "time_stamp"}
    # the no-fix filter lat <> 0 reaches the parquet scan
    assert "Not(EqualTo(lat,0.0))" in formatted and "IsNotNull(imei)" in formatted


def test_trip_start_filter_reaches_the_trip_scan(spark):
    pts, trips = _staged(spark)
    formatted = _formatted(spark, j1.simple_trip_features(pts, trips))
    assert "GreaterThan(start,0)" in formatted
