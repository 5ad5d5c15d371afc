"""Rejects of the trip table, declared schemas, the validity join by time."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from trackwise.plans import rollup as j3
from trackwise.schemas import COMPLEX_COLUMNS, COMPLEX_SCHEMA, SIMPLE_COLUMNS, SIMPLE_SCHEMA
from trackwise.sources import readers, sinks


def trip_line(device, start, end, more=15):
    return ",".join([device, f"t{device}", "v", str(start), "", str(end)] + [""] * more)


def test_bad_trip_rows_are_set_apart(spark):
    d = tempfile.mkdtemp(prefix="tw-bad-")
    lines = {"20240101": [trip_line("1", 100, 160), trip_line("2", "1e", 160), trip_line("3", 100, "x"), "4,t4,v,100", trip_line("5", 1, 2, 18), ""],
             "20240102": [trip_line("6", 100, ""), trip_line("7", 200, 260) + "abc"]}
    for day, text in lines.items():
        os.makedirs(f"{d}/stat_date={day}")
        with open(f"{d}/stat_date={day}/part.csv", "w") as fh:
            fh.write("\n".join(text) + "\n")
    good, rejects = readers.read_trip_stat_checked(spark, d, tempfile.mkdtemp(prefix="tw-checked-") + "/t")
    assert good.columns == readers.read_trip_stat(spark, d).columns
    assert sorted((r["deviceid"], r["start"], r["s_end"], r["stat_date"]) for r in good.collect()) == [
        ("1", 100, 160, "20240101"), ("6", 100, None, "20240102")]
    assert {(r["stat_date"], r["reason"], r["rows"]) for r in readers.reject_counts(rejects).collect()} == {
        ("20240101", "not a number", 2), ("20240101", "too few fields", 1), ("20240101", "too many fields", 1), ("20240102", "not a number", 1)}
    assert "4,t4,v,100" in [r["row"] for r in rejects.collect()]
    one_day = readers.read_trip_stat_checked(spark, d, tempfile.mkdtemp(prefix="tw-checked-") + "/t", days=["20240102"])
    assert (one_day[0].count(), one_day[1].count()) == (1, 1)
    # both results come from the one staged table
    assert "csv" not in good._jdf.queryExecution().executedPlan().toString().lower().replace("tw-checked", "")


@pytest.mark.parametrize("n", [10, 12])
def test_positional_read_needs_the_declared_columns(spark, n):
    d = tempfile.mkdtemp(prefix="tw-cols-")
    spark.range(3).select(*[F.lit(1.0).alias(f"c{i}") for i in range(n)]).write.parquet(f"{d}/stat_date=20240101")
    with pytest.raises(ValueError, match=f"11 columns expected .* have {n}"):
        readers.read_gps_points(spark, d, positional_cast=True)


def test_positional_read_refuses_other_types(spark):
    d = tempfile.mkdtemp(prefix="tw-types-")
    spark.range(1).select(*[(F.array(F.lit(1)) if i == 4 else F.lit(1)).alias(f"c{i}") for i in range(11)]).write.parquet(f"{d}/stat_date=20240101")
    with pytest.raises(ValueError, match=r"c4 array<int> \(for alon\)"):
        readers.read_gps_points(spark, d, positional_cast=True)


def test_datasets_without_files(spark):
    empty = tempfile.mkdtemp(prefix="tw-none-")
    assert readers.read_gps_points(spark, empty, positional_cast=True).collect() == []
    for schema, columns in ((SIMPLE_SCHEMA, SIMPLE_COLUMNS), (COMPLEX_SCHEMA, COMPLEX_COLUMNS)):
        df = readers.read_trip_features(spark, empty, schema=schema)
        assert df.columns == [*columns, "stat_date"] and df.collect() == []


def test_declared_schema_is_the_written_one(spark):
    d = tempfile.mkdtemp(prefix="tw-feat-") + "/t"
    row = spark.range(1).select(*[F.lit(1).cast(f.dataType).alias(f.name) for f in SIMPLE_SCHEMA.fields], F.lit("20240101").alias("stat_date"))
    sinks.write_day_partitioned(row, d)
    assert readers.read_trip_features(spark, d).schema == readers.read_trip_features(spark, d, schema=SIMPLE_SCHEMA).schema


def windows_and_trips(spark):
    """Windows from seconds to decades, reversed and open ones; trips of a hot device on
    400 days, some of which end before they start."""
    rng, day = random.Random(4), 86400
    windows = [(str(d), f"VIN{d}-{i}", "a", "b", s, s + span) for d in range(6) for i, span in enumerate(
        [0, 100, day, 40 * day, 300 * day, 2000 * day, 20_000 * day, -50]) for s in [rng.randrange(0, 500 * day)]]
    windows += [("0", "open", "a", "b", None, 9 * day), ("0", "open", "a", "b", 5, None), (None, "none", "a", "b", 0, 10 ** 9)]
    trips = [("0" if i % 3 else str(rng.randrange(6)), s, s + rng.choice([0, 60, 3000, 2 * day, -40, -3 * day]))
             for i in range(900) for s in [rng.randrange(0, 400 * day)]]
    trips += [(None, 5, 10), ("0", 7, None)]
    v = spark.createDataFrame(windows, "imei string, VIN string, valid_start string, valid_end string, valid_start_utc bigint, valid_end_utc bigint")
    t = spark.createDataFrame(trips, "imei string, tripnumber int, end int")
    return v, t.select("imei", "tripnumber", F.col("end").cast("double").alias("end_time"))


def test_validity_join_by_time_equals_broadcast(spark):
    v, t = windows_and_trips(spark)
    rows = lambda df: sorted(map(str, df.select("imei", "VIN", "valid_start_utc", "tripnumber", "end_time").collect()))
    want = rows(j3.validity_join(t, v))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = j3.validity_join(t, v)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "_bucket" in plan and "_salt" not in plan
        assert rows(joined) == want and len(want) > 900
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_device_is_spread_over_its_days(spark):
    """A third of the trips in one device: with windows of up to 64 days its trips meet on a key a day."""
    from trackwise.operators.range_join import expand_intervals
    day = 86400
    v = spark.createDataFrame([("0", i * 60 * day, (i + 1) * 60 * day) for i in range(5)], "imei string, s bigint, e bigint")
    widths = {"bucket_seconds": j3.BUCKET_SECONDS, "growth": j3.BUCKET_GROWTH, "levels": j3.BUCKET_LEVELS}
    ex = expand_intervals(v, "s", "e", **widths)
    assert ex.select("_level").distinct().count() == 1 and ex.select("_bucket").distinct().count() == 301
    long = expand_intervals(v.limit(1).withColumn("e", F.col("s") + 10_000 * day), "s", "e", **widths)
    assert long.count() <= 66
