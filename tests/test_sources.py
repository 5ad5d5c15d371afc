"""Readers and writers."""

import os
import tempfile

from trackwise.schemas import GPS_SCHEMA
from trackwise.sources import readers, sinks


def test_trip_csv_reader_types_and_day_pruning(spark):
    d = tempfile.mkdtemp(prefix="tw-trips-")
    for day, start in (("20240101", 1704067200), ("20240102", 1704153600)):
        os.makedirs(f"{d}/stat_date={day}")
        with open(f"{d}/stat_date={day}/part.csv", "w") as fh:
            fields = ["dev1", "t1", "v1", str(start), "", str(start + 60)] + [""] * 15
            fh.write(",".join(fields) + "\n")
    df = readers.read_trip_stat(spark, d, days=["20240102"])
    rows = df.collect()
    assert df.columns == ["tid", "vid", "deviceid", "start", "s_end", "stat_date"]
    assert len(rows) == 1 and rows[0]["start"] == 1704153600 and rows[0]["stat_date"] == "20240102"
    assert "PartitionFilters: [isnotnull(stat_date" in df._jdf.queryExecution().executedPlan().toString()


def test_gps_reader_fixed_schema_and_positional_cast(spark):
    d = tempfile.mkdtemp(prefix="tw-gps-")
    raw = spark.createDataFrame(
        [("7", 30.0, 120.0, 30.0, 120.0, 12.5, 90.0, 5.0, 1.0, 1704067200250, 1.0)],
        "a string, b double, c double, d double, e double, f double, g double, h double, "
        "i double, j long, k double")
    raw.write.parquet(f"{d}/stat_date=20240101")
    typed = readers.read_gps_points(spark, d, positional_cast=True)
    assert typed.columns == GPS_SCHEMA.fieldNames() + ["stat_date"]
    r = typed.first()
    assert r["direction"] == 90 and r["time_stamp"] == 1704067200250 and isinstance(r["altitude"], int)


def test_dynamic_partition_overwrite_keeps_other_days(spark):
    d = tempfile.mkdtemp(prefix="tw-out-")
    df = spark.createDataFrame([("20240101", 1), ("20240102", 2)], "stat_date string, v int")
    sinks.write_day_partitioned(df, d)
    sinks.write_day_partitioned(spark.createDataFrame([("20240101", 9)], "stat_date string, v int"), d)
    got = {r["stat_date"]: r["v"] for r in readers.read_trip_features(spark, d).collect()}
    assert got == {"20240101": 9, "20240102": 2}


def test_csv_line_fixed_decimals(spark):
    df = spark.createDataFrame([(1, 0.1, None)], "a int, b double, c string")
    assert sinks.csv_line(df, float_digits=3).first()[0] == "1,0.100,"


def test_validity_windows_from_csv_datetimes(spark):
    d = tempfile.mkdtemp(prefix="tw-valid-")
    with open(f"{d}/v.csv", "w") as fh:
        fh.write("imei,VIN,valid_start,valid_end\n")
        fh.write("42,VIN42,2024-01-01 00:00:00,2024-01-02 12:30:00\n")
    r = readers.read_validity(spark, d, fmt="csv").first()
    assert r["imei"] == "42" and r["VIN"] == "VIN42"
    assert r["valid_start_utc"] == 1704067200 and r["valid_end_utc"] == 1704067200 + 86400 + 12 * 3600 + 1800


def test_text_sink_round_trip(spark):
    d = tempfile.mkdtemp(prefix="tw-lines-") + "/out"
    lines = spark.createDataFrame([("a,1",), ("b,",)], "df_concat string")
    sinks.write_lines(lines, d)
    assert sorted(r[0] for r in spark.read.text(d).collect()) == ["a,1", "b,"]
