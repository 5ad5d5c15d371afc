"""Day manifest: a run that was stopped between two days, changed inputs, finished days."""

import os
import shutil
import threading

import pytest
from pyspark.sql import functions as F

from trackwise.plans import backfill, registry
from trackwise.schemas import SIMPLE_SCHEMA
from trackwise.session import staging_path
from trackwise.sources import sinks

SF = "/root/testdata/sf0.001"
DAYS = dict(first_day="2023-12-31", last_day="2024-01-02")


@pytest.fixture()
def inputs(spark):
    """Three days of inputs: the stand-in day, and a copy of it under the next day's name."""
    trips, gps = registry._staged_trips(spark, SF), registry._staged_points(spark, SF)
    for base in (trips, gps):
        assert os.path.isdir(f"{base}/stat_date=20240101")
        if not os.path.isdir(f"{base}/stat_date=20240102"):
            shutil.copytree(f"{base}/stat_date=20240101", f"{base}/stat_date=20240102")
    return dict(trips_base=trips, points_base=gps)


def records(spark, out):
    return {r["stat_date"]: (r["status"], r["rows"]) for r in backfill.manifest(spark, out).collect()}


def rows_by_day(spark, out):
    return {r["stat_date"]: r["count"] for r in backfill.read_finished(spark, out, SIMPLE_SCHEMA).groupBy("stat_date").count().collect()}


def test_stopped_run_is_resumed(spark, inputs, monkeypatch):
    out = staging_path(spark, "features")
    assert backfill.manifest(spark, out).collect() == [] and rows_by_day(spark, out) == {}
    write = sinks.write_day_partitioned

    def fails_on_the_last_day(df, base, **kw):
        write(df, base, **kw)
        if kw["days"][0] == "20240102":
            raise OSError("executor and driver lost")        # after the files, before the record

    monkeypatch.setattr(sinks, "write_day_partitioned", fails_on_the_last_day)
    with pytest.raises(OSError):
        backfill.run_simple(spark, out_base=out, chunk_days=1, **DAYS, **inputs)
    found = records(spark, out)
    assert found["20231231"] == ("done", 0) and found["20240101"][0] == "done" and found["20240102"] == ("running", 0)
    assert set(rows_by_day(spark, out)) == {"20240101"}                  # files of the unfinished day are not shown
    assert os.path.isdir(f"{out}/stat_date=20240102")
    monkeypatch.setattr(sinks, "write_day_partitioned", write)
    assert backfill.run_simple(spark, out_base=out, chunk_days=1, resume=True, **DAYS, **inputs) == ["20240102"]
    found = records(spark, out)
    assert {s for s, _ in found.values()} == {"done"}
    assert rows_by_day(spark, out) == {d: n for d, (_, n) in found.items() if n}
    whole = staging_path(spark, "features")
    assert backfill.run_simple(spark, out_base=whole, **DAYS, **inputs) == ["20231231", "20240101", "20240102"]
    pick = lambda base: sorted(map(str, backfill.read_finished(spark, base, SIMPLE_SCHEMA).select(
        "imei", "tripnumber", "stat_date", F.round("mileage", 9)).collect()))
    assert pick(out) == pick(whole)


def test_changed_inputs_and_settings(spark, inputs):
    out = staging_path(spark, "features")
    run = lambda **kw: backfill.run_simple(spark, out_base=out, resume=True, **DAYS, **inputs, **kw)
    assert len(run()) == 3 and run() == []
    day = f"{inputs['points_base']}/stat_date=20240101"
    part = next(f for f in sorted(os.listdir(day)) if f.endswith(".parquet"))
    shutil.copy(f"{day}/{part}", f"{day}/part-late.parquet")             # a late file
    assert run() == ["20240101"] and run() == []
    names = [f["path"].rsplit("/", 1)[-1] for f in backfill.manifest(spark, out).where("stat_date = '20240101'").first()["inputs"]]
    assert "part-late.parquet" in names
    assert len(run(tz="Asia/Shanghai")) == 3                             # other settings: all days
    assert len(backfill.run_simple(spark, out_base=out, **DAYS, **inputs)) == 3


def test_pending_ranges():
    days = ["20240130", "20240131", "20240201", "20240203", "20240204"]
    assert backfill._pending_ranges(days, None) == [("20240130", "20240201"), ("20240203", "20240204")]
    assert backfill._pending_ranges(days, 2) == [("20240130", "20240131"), ("20240201", "20240201"), ("20240203", "20240204")]
    assert backfill._pending_ranges([], 3) == []


def test_chunks_run_side_by_side(spark, inputs, monkeypatch):
    met, write = threading.Barrier(2), sinks.write_day_partitioned

    def waits_for_another_chunk(df, base, **kw):
        if kw["days"][0] != "20231231":
            met.wait(120)
        write(df, base, **kw)

    monkeypatch.setattr(sinks, "write_day_partitioned", waits_for_another_chunk)
    before = spark.conf.get("spark.sql.constraintPropagation.enabled")
    out = staging_path(spark, "features")
    assert backfill.run_simple(spark, out_base=out, chunk_days=1, **DAYS, **inputs) == ["20231231", "20240101", "20240102"]
    assert spark.conf.get("spark.sql.constraintPropagation.enabled") == before
    assert {s for s, _ in records(spark, out).values()} == {"done"}


def test_only_the_days_asked_for_are_listed(spark, tmp_path):
    for day in ("20231231", "20240101", "20240102", "20240201"):
        os.makedirs(tmp_path / f"stat_date={day}")
        (tmp_path / f"stat_date={day}" / "a.parquet").write_text("x")
    assert sorted(sinks.day_files(spark, str(tmp_path))) == ["20231231", "20240101", "20240102", "20240201"]
    assert sorted(sinks.day_files(spark, str(tmp_path), days=("20240101", "20240102"))) == ["20240101", "20240102"]
    assert sorted(sinks.day_files(spark, str(tmp_path), days=("20231231", "20240101"))) == ["20231231", "20240101"]
    assert sinks.day_files(spark, str(tmp_path / "none"), days=("20240101", "20240102")) == {}


def test_staged_inputs_are_about_a_file_a_day(spark, tmp_path):
    """Ten days of twelve users each: not a file for every task and day."""
    users = [day * 145 + i for day in range(10) for i in range(12)]
    spark.createDataFrame([(n * 120 + k, u, "view", 1.0) for n, u in enumerate(users) for k in range(3)],
                          "event_id long, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for stage in (registry._staged_trips, registry._staged_points, registry._staged_trips_with_errors):
            days = sinks.day_files(spark, stage(spark, str(tmp_path)))
            assert len(days) >= 10 and sum(map(len, days.values())) <= len(days) + 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
