"""Date-range runs: one job over a range of day partitions.

Instead of one job per day, the day range is a predicate on the partition
column (``stat_date BETWEEN first AND last``, yyyyMMdd strings compare in
date order) so Spark prunes the directories, and the day is part of the
point-in-trip join key and of every window and aggregate key, so every day is
computed exactly as a single-day run would (a trip listed under two days is
two trips). Output goes to one directory per day with dynamic partition
overwrite: re-running a range replaces those days only, and a day of the range
that has no rows any more loses its directory, which makes a failed or partial
run safe to repeat.

A run keeps a manifest beside the day directories: one record a day with the input
files it was computed from, its rows and its status. A day is marked as running before
its files are touched and as done after they are committed, so with ``resume`` a run
computes only the days that are not done or whose inputs have changed since, and
:func:`read_finished` shows finished days only, also while a run goes on.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackwise.functions.timefmt import day_keys
from trackwise.plans import complex as j2
from trackwise.plans import simple as j1
from trackwise.schemas import COMPLEX_SCHEMA, SIMPLE_SCHEMA
from trackwise.session import constraints_off
from trackwise.sources import readers, sinks

#: below the output's folder; names with an underscore are hidden from Spark's readers
MANIFEST = "_manifest"
#: chunks of a run under way at a time; a chunk of few days leaves most of a cluster idle
CHUNKS_AT_ONCE = 4
MANIFEST_SCHEMA = ("job string, status string, rows long, inputs array<struct<path:string, bytes:bigint, modified:bigint>>, "
                   "fingerprint string, stat_date string")


def day_key(day: str) -> str:
    """'2024-01-05' or '20240105' -> '20240105'."""
    return day.replace("-", "")


def day_chunks(first_day: str, last_day: str, chunk_days: int | None) -> list[tuple[str, str]]:
    """Consecutive [first, last] day ranges of at most ``chunk_days`` days."""
    a = dt.date.fromisoformat(_iso(first_day))
    b = dt.date.fromisoformat(_iso(last_day))
    if not chunk_days:
        return [(a.isoformat(), b.isoformat())]
    out = []
    while a <= b:
        e = min(b, a + dt.timedelta(days=chunk_days - 1))
        out.append((a.isoformat(), e.isoformat()))
        a = e + dt.timedelta(days=1)
    return out


def _iso(day: str) -> str:
    d = day.replace("-", "")
    return f"{d[:4]}-{d[4:6]}-{d[6:]}"


def in_days(df: DataFrame, first_day: str, last_day: str) -> DataFrame:
    return df.where(F.col("stat_date").between(day_key(first_day), day_key(last_day)))


def simple_for_days(points: DataFrame, trips: DataFrame, first_day: str, last_day: str,
                    **kw) -> DataFrame:
    """Per-trip basic features of every day in [first_day, last_day], with stat_date."""
    return j1.simple_trip_features(in_days(points, first_day, last_day),
                                   in_days(trips, first_day, last_day), by_day=True, **kw)


def complex_for_days(points: DataFrame, trips: DataFrame, cohort: DataFrame | None,
                     first_day: str, last_day: str, **kw) -> DataFrame:
    """Per-trip kinematic features of every day in [first_day, last_day], with stat_date."""
    return j2.complex_trip_features(in_days(points, first_day, last_day),
                                    in_days(trips, first_day, last_day), cohort,
                                    by_day=True, **kw)


def days_between(first_day: str, last_day: str) -> list[str]:
    a, b = dt.date.fromisoformat(_iso(first_day)), dt.date.fromisoformat(_iso(last_day))
    return [(a + dt.timedelta(days=i)).strftime("%Y%m%d") for i in range((b - a).days + 1)]


def manifest(spark: SparkSession, out_base: str) -> DataFrame:
    """The records of all days that a run has begun (no rows where none has)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out_base}/{MANIFEST}")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    df = spark.read.schema(MANIFEST_SCHEMA).parquet(str(path))
    return df.withColumn("stat_date", F.col("stat_date").cast("string"))


def read_finished(spark: SparkSession, out_base: str, schema: T.StructType) -> DataFrame:
    """The feature dataset, days that are done only."""
    days = [r[0] for r in manifest(spark, out_base).where("status = 'done'").select("stat_date").collect()]
    if not days:
        return spark.createDataFrame([], T.StructType([*schema.fields, readers.DAY_FIELD]))
    return readers.read_trip_features(spark, out_base, days, schema)


def _record(spark: SparkSession, out_base: str, records: list[tuple]) -> None:
    (spark.createDataFrame(records, MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("stat_date").parquet(f"{out_base}/{MANIFEST}"))


def _run_days(spark: SparkSession, job: str, compute: Callable[[str, str], DataFrame], schema: T.StructType, *,
              inputs: list[str], out_base: str, first_day: str, last_day: str, chunk_days: int | None,
              resume: bool, settings: dict) -> list[str]:
    """Compute, write and record the days in chunks of consecutive days; the days computed."""
    listings = [(base, sinks.day_files(spark, base)) for base in inputs]
    files = {day: [(f"{base}/stat_date={day}/{name}", size, changed) for base, days in listings for name, size, changed in days.get(day, [])]
             for day in days_between(first_day, last_day)}
    prints = {day: hashlib.sha256(json.dumps([job, settings, fs], default=str, sort_keys=True).encode()).hexdigest() for day, fs in files.items()}
    done = {}
    if resume:
        done = {r["stat_date"]: r["fingerprint"] for r in manifest(spark, out_base).where("status = 'done'").collect()}

    def run(chunk: tuple[str, str]) -> list[str]:
        first, last = chunk
        days = days_between(first, last)
        note = lambda status, rows: _record(spark, out_base, [
            (job, status, rows.get(d, 0), files[d], prints[d], d) for d in days])
        note("running", {})
        sinks.write_day_partitioned(compute(first, last), out_base, days=(first, last))
        note("done", _written(spark, out_base, days, schema))
        return days

    # every chunk replaces days of its own, through a staging folder of its own
    with constraints_off(spark), ThreadPoolExecutor(CHUNKS_AT_ONCE) as pool:
        # a thread for every chunk's job group and local properties
        begun = [pool.submit(inheritable_thread_target(spark)(run), chunk)
                 for chunk in _pending_ranges([d for d in files if done.get(d) != prints[d]], chunk_days)]
        try:
            return [day for chunk in begun for day in chunk.result()]
        except BaseException:
            pool.shutdown(wait=True, cancel_futures=True)
            raise


def _written(spark: SparkSession, out_base: str, days: list[str], schema: T.StructType) -> dict[str, int]:
    """Rows of every day that has any, without a listing of the other days' folders."""
    found = sinks.day_files(spark, out_base, days=(days[0], days[-1]))
    if not found:
        return {}
    table = spark.read.option("basePath", out_base).schema(T.StructType([*schema.fields, readers.DAY_FIELD])).parquet(
        *[f"{out_base}/stat_date={d}" for d in days if d in found])
    return {r["stat_date"]: r["count"] for r in table.groupBy("stat_date").count().collect()}


def _pending_ranges(days: list[str], chunk_days: int | None) -> list[tuple[str, str]]:
    """Ranges of consecutive days, of at most ``chunk_days`` each."""
    out: list[list[str]] = []
    for d in days:
        follows = out and days_between(out[-1][-1], d)[1:] == [d]
        if follows and (not chunk_days or len(out[-1]) < chunk_days):
            out[-1].append(d)
        else:
            out.append([d])
    return [(r[0], r[-1]) for r in out]


def run_simple(spark: SparkSession, *, trips_base: str, points_base: str, out_base: str,
               first_day: str, last_day: str, chunk_days: int | None = None, resume: bool = False,
               **options) -> list[str]:
    """Read the day directories of both inputs, compute, write day-partitioned; the days computed.

    With ``chunk_days`` the range runs as consecutive jobs of that many days,
    CHUNKS_AT_ONCE of them side by side, each committed on its own: a failure loses
    at most the chunks under way, and re-running the range (or a chunk) replaces exactly its days. With ``resume`` days
    that are done and whose input files are the same are left out. ``options``
    go to :func:`simple_for_days` (e.g. ``tz``).
    """
    pts = readers.read_gps_points(spark, points_base)
    trips = readers.read_trip_stat(spark, trips_base)
    return _run_days(spark, "simple", lambda a, b: simple_for_days(pts, trips, a, b, **options), SIMPLE_SCHEMA,
                     inputs=[trips_base, points_base], out_base=out_base, first_day=first_day, last_day=last_day,
                     chunk_days=chunk_days, resume=resume, settings=options)


def run_complex(spark: SparkSession, *, trips_base: str, points_base: str, out_base: str,
                first_day: str, last_day: str, cohort_source: str | None = None,
                chunk_days: int | None = None, resume: bool = False, **options) -> list[str]:
    """As :func:`run_simple` for the kinematic features of the cohort's trips. A cohort
    under another name counts as a change of all days; its contents are not compared."""
    pts = readers.read_gps_points(spark, points_base, positional_cast=True)
    trips = readers.read_trip_stat(spark, trips_base)
    cohort = readers.read_cohort(spark, cohort_source) if cohort_source else None
    return _run_days(spark, "complex", lambda a, b: complex_for_days(pts, trips, cohort, a, b, **options), COMPLEX_SCHEMA,
                     inputs=[trips_base, points_base], out_base=out_base, first_day=first_day, last_day=last_day,
                     chunk_days=chunk_days, resume=resume, settings={**options, "cohort": cohort_source})


def day_range(*tables: DataFrame) -> tuple[str, str] | None:
    """First and last stat_date of the tables (None: no rows), one aggregate over the day column."""
    days = None
    for t in tables:
        d = t.select("stat_date")
        days = d if days is None else days.unionByName(d)
    first, last = days.agg(F.min("stat_date"), F.max("stat_date")).first()
    return (first, last) if first else None


def trips_per_day(trips: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """(stat_date, trips) of every day of the range, days without trips included."""
    days = trips.sparkSession.range(1).select(F.explode(day_keys(_iso(first_day), _iso(last_day))).alias("stat_date"))
    counts = in_days(trips, first_day, last_day).groupBy("stat_date").agg(F.count("*").alias("n"))
    return days.join(counts, "stat_date", "left").select("stat_date", F.coalesce("n", F.lit(0)).alias("trips"))
