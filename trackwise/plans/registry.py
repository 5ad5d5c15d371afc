"""Registered queries: each job stage over the stand-in inputs.

Every query reads the test tables (``events``, ``customer``) and derives its
inputs with Spark, so its work grows with the tables. Queries that exercise
a reader or a writer first stage the derived inputs as files under the
shared folder (``spark.checkpoint.dir``) and read them back. Doubles are
rounded to 9 places on output for the cross-engine check (the jobs
themselves do not round).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackwise.plans import backfill
from trackwise.plans import complex as j2
from trackwise.plans import rollup as j3
from trackwise.plans import simple as j1
from trackwise.schemas import (COMPLEX_ACC_RUNS, COMPLEX_ACC_STATS, COMPLEX_COLUMNS,
                               COMPLEX_HEAD, COMPLEX_HOURS, COMPLEX_NORM_RUNS,
                               COMPLEX_NORM_STATS, COMPLEX_SPEED_BINS, COMPLEX_SPEED_STATS,
                               COMPLEX_SCHEMA, COMPLEX_TURN, SIMPLE_HOURS, SIMPLE_SCHEMA, SIMPLE_SPEED_BINS)
from trackwise.session import staging_path
from trackwise.sources import fixtures as fx
from trackwise.sources import readers, sinks

#: zone of hours and days in the queries, whatever the session's
TZ = "UTC"

TRIP_ROW_COLS = ["tid", "vid", "tripnumber", "s_end", "imei", "lat", "lon", "speed",
                 "direction", "time_stamp"]
DIST_COLS = ["tid", "vid", "tripnumber", "imei", "time_stamp", "lat", "lon", "speed",
             "lat_0", "lon_0", "am"]
TURN_RUN_COLS = [c for c in COMPLEX_TURN if c.endswith("_dura") or c.endswith("_times")]
TURN_SPEED_COLS = [c for c in COMPLEX_TURN if c not in TURN_RUN_COLS]


def present(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round doubles to ``digits`` places and fold -0.0 into 0.0 (magnitudes
    >= 1e6, i.e. epoch seconds, are left as they are)."""
    out = []
    for f in df.schema.fields:
        c = f"`{f.name}`"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            r = f"CASE WHEN abs({c}) >= 1000000D THEN {c} ELSE round({c}, {digits}) END"
            out.append(f"CASE WHEN {r} = 0 THEN 0D ELSE {r} END AS {c}")
        else:
            out.append(c)
    return df.selectExpr(*out)


# --- inputs -----------------------------------------------------------------

def _points(spark, sf_dir):
    return fx.gps_points(spark, sf_dir)


def _trips(spark, sf_dir):
    return fx.trip_stat(spark, sf_dir)


def _staged_trips(spark, sf_dir) -> str:
    """Trip table written as day directories of header-less CSV (rebalanced by day: about
    tasks + days files instead of tasks x days)."""
    path = staging_path(spark, "trip_stat")
    (fx.with_trip_day(fx.trip_stat(spark, sf_dir, full_schema=True)).hint("rebalance", "stat_date")
     .write.mode("overwrite").partitionBy("stat_date").option("header", False).csv(path))
    return path


def _staged_points(spark, sf_dir) -> str:
    """GPS points written as day directories of parquet (all 11 columns)."""
    path = staging_path(spark, "gps")
    (fx.with_point_day(fx.gps_points(spark, sf_dir, full_schema=True)).hint("rebalance", "stat_date")
     .write.mode("overwrite").partitionBy("stat_date").parquet(path))
    return path


# --- sources ----------------------------------------------------------------

def scan_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_trip_stat(spark, _staged_trips(spark, sf_dir))


def scan_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(readers.read_gps_points(spark, _staged_points(spark, sf_dir)))


def scan_points_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GPS parquet read with the file's own schema, re-typed by position."""
    return present(readers.read_gps_points(spark, _staged_points(spark, sf_dir), positional_cast=True))


def date_range_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = staging_path(spark, "simple_features")
    trips, points = _staged_trips(spark, sf_dir), _staged_points(spark, sf_dir)
    if days := _days(spark, trips, points):
        backfill.run_simple(spark, trips_base=trips, points_base=points, out_base=out,
                            first_day=days[0], last_day=days[1], tz=TZ)
    return present(backfill.read_finished(spark, out, SIMPLE_SCHEMA))


def resumed_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest after a run over the first day and a resumed run over all days:
    (stat_date, status, rows) of every day."""
    out = staging_path(spark, "simple_features")
    trips, points = _staged_trips(spark, sf_dir), _staged_points(spark, sf_dir)
    if days := _days(spark, trips, points):
        run = lambda last: backfill.run_simple(
            spark, trips_base=trips, points_base=points, out_base=out, first_day=days[0], last_day=last, chunk_days=2, resume=True, tz=TZ)
        run(days[0])
        run(days[1])
    return backfill.manifest(spark, out).select("stat_date", "status", F.col("rows").alias("n_rows"))


def _days(spark, trips_base: str, points_base: str) -> tuple[str, str] | None:
    """First and last day of the staged inputs (None: no rows)."""
    return backfill.day_range(readers.read_trip_stat(spark, trips_base), readers.read_gps_points(spark, points_base))


def trips_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = readers.read_trip_stat(spark, _staged_trips(spark, sf_dir))
    days = backfill.day_range(trips)
    return backfill.trips_per_day(trips, *days) if days else spark.createDataFrame([], "stat_date string, trips long")


def _staged_trips_with_errors(spark, sf_dir) -> str:
    """The staged trip table as it may arrive: of some devices the end is no number
    (device % 11 = 3), or the last fields are missing (device % 11 = 5)."""
    path = staging_path(spark, "raw_trip_stat")
    trips = fx.with_trip_day(fx.trip_stat(spark, sf_dir, full_schema=True))
    kind = F.pmod(F.col("deviceid").cast("long"), F.lit(11))
    fields = [F.coalesce(F.when(kind == 3, "none").otherwise(F.col(c).cast("string")) if c == "s_end" else F.col(c).cast("string"), F.lit(""))
              for c in trips.columns if c != "stat_date"]
    line = F.when(kind == 5, F.concat_ws(",", *fields[:6])).otherwise(F.concat_ws(",", *fields))
    trips.select(line.alias("value"), "stat_date").hint("rebalance", "stat_date").write.partitionBy("stat_date").text(path)
    return path


def _checked_trips(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return readers.read_trip_stat_checked(spark, _staged_trips_with_errors(spark, sf_dir), staging_path(spark, "checked_trips"))


def checked_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked_trips(spark, sf_dir)[0]


def rejected_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.reject_counts(_checked_trips(spark, sf_dir)[1]).withColumnRenamed("rows", "n_rows")


# --- joins ------------------------------------------------------------------

def trip_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    pts = j1.seconds_points(_points(spark, sf_dir), ("direction",))
    return present(j1.assign_trips(pts, _trips(spark, sf_dir)).select(*TRIP_ROW_COLS))


def trip_points_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(j2.trip_points_trunc(_points(spark, sf_dir), _trips(spark, sf_dir)))


def trip_points_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trackwise.operators.range_join import points_in_intervals_outer
    pts = j1.seconds_points(_points(spark, sf_dir), ("direction",))
    trips = (_trips(spark, sf_dir)
             .select("tid", "vid", "deviceid", F.col("start").alias("tripnumber"), "s_end")
             .where(F.col("tripnumber") > 0))
    out = points_in_intervals_outer(pts, trips, point_key="imei", interval_key="deviceid",
                                    ts="time_stamp", start="tripnumber", end="s_end")
    return present(out.select(*TRIP_ROW_COLS))


def cohort_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx.cohort(spark, sf_dir).createOrReplaceTempView("trackwise_cohort")
    cohort = readers.read_cohort(spark, "trackwise_cohort")
    return j2.cohort_trips(_trips(spark, sf_dir), cohort).select("tid", "vid", "deviceid", "start", "s_end")


# --- J1 ---------------------------------------------------------------------

def _simple_rows(spark, sf_dir):
    return j1.simple_rows(_points(spark, sf_dir), _trips(spark, sf_dir))


def point_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(j1.expand_rows(_simple_rows(spark, sf_dir)).select(*DIST_COLS))


def jump_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = j1.expand_rows(_simple_rows(spark, sf_dir))
    return present(rows.where(F.col("am") < j1.JUMP_KM).select(*DIST_COLS))


def _simple(spark, sf_dir):
    return j1.simple_trip_features(_points(spark, sf_dir), _trips(spark, sf_dir), tz=TZ)


def trip_hour_mileage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(_simple(spark, sf_dir).select("imei", "vid", "tripnumber", "mileage", *SIMPLE_HOURS))


def trip_speed_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(_simple(spark, sf_dir).select("imei", "vid", "tripnumber", *SIMPLE_SPEED_BINS))


def simple_trip_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(_simple(spark, sf_dir))


# --- J3 ---------------------------------------------------------------------

def _validity(spark, sf_dir):
    # windows arrive as datetime text; epoch bounds are derived from it
    v = fx.validity(spark, sf_dir).drop("valid_start_utc", "valid_end_utc")
    return readers.validity_from_datetimes(v, tz=TZ)


def _feature_table(spark, sf_dir) -> DataFrame:
    """The basic-feature dataset as the roll-up reads it: written day-partitioned
    to the shared folder for all days of the tables, read back (lineage cut)."""
    out = staging_path(spark, "simple_features")
    sinks.write_day_partitioned(
        j1.simple_trip_features(fx.with_point_day(_points(spark, sf_dir)),
                                fx.with_trip_day(_trips(spark, sf_dir)), by_day=True, tz=TZ), out)
    return readers.read_trip_features(spark, out, schema=SIMPLE_SCHEMA)


def validity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = j3.validity_join(_feature_table(spark, sf_dir), _validity(spark, sf_dir), tz=TZ)
    return present(out.select("imei", "VIN", "valid_start_utc", "valid_end_utc", "imei_1", "vid",
                              "tripnumber", "start_time", "end_time", "dura", "dura_valid",
                              "mileage", "day"))


def plausible_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = j3.validity_join(j3.plausible_trips(_feature_table(spark, sf_dir)), _validity(spark, sf_dir), tz=TZ)
    return present(out.select("imei", "VIN", "imei_1", "tripnumber", "speed_mean", "speed"))


def vehicle_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(j3.vehicle_features(_feature_table(spark, sf_dir), _validity(spark, sf_dir), tz=TZ))


def vehicle_csv_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    vehicles = j3.vehicle_features(_feature_table(spark, sf_dir), _validity(spark, sf_dir), tz=TZ)
    path = staging_path(spark, "vehicle_lines")
    sinks.write_lines(j3.vehicle_lines(vehicles, float_digits=9), path)
    return spark.read.text(path).select(F.col("value").alias("df_concat"))


# --- J2 ---------------------------------------------------------------------

def _kin(spark, sf_dir):
    rows = j2.clean_rows(_points(spark, sf_dir), _trips(spark, sf_dir), fx.cohort(spark, sf_dir))
    return j2.kinematic_rows(rows, tz=TZ)


def _complex(spark, sf_dir):
    return j2.aggregate_trips(_kin(spark, sf_dir))


def clean_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(_kin(spark, sf_dir).select(*j2.ROW_COLS))


def clean_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(_kin(spark, sf_dir).select("imei", "tripnumber", "time_stamp", "lat", "lon",
                                             "am", "hour"))


def kinematics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(_kin(spark, sf_dir).select("imei", "tripnumber", "time_stamp", "lat", "lon",
                                             "speed_cal", "heading_cal", "tan_acc", "norm_acc",
                                             "gps_acc"))


def turn_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(_kin(spark, sf_dir).select("imei", "tripnumber", "time_stamp", "lat", "lon",
                                             "angle_delta", "angle_cal_delta"))


def _complex_part(columns: list[str]):
    cols = [c for c in ["imei", "tripnumber"] if c not in columns] + columns

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(_complex(spark, sf_dir).select(*cols))
    return q


complex_trip_head = _complex_part(COMPLEX_HEAD)
complex_hour_mileage = _complex_part(COMPLEX_HOURS)
complex_speed_hist = _complex_part(COMPLEX_SPEED_BINS)
speed_stats = _complex_part(COMPLEX_SPEED_STATS)
acc_stats = _complex_part(COMPLEX_ACC_STATS)
norm_stats = _complex_part(COMPLEX_NORM_STATS)
turn_runs = _complex_part(TURN_RUN_COLS)
turn_speed_stats = _complex_part(TURN_SPEED_COLS)
acc_bin_runs = _complex_part(COMPLEX_ACC_RUNS)
norm_bin_runs = _complex_part(COMPLEX_NORM_RUNS)


def complex_trip_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(_complex(spark, sf_dir).select(*COMPLEX_COLUMNS))


def complex_date_range_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kinematic job as a date-range run: CSV trips and parquet points from
    day directories (file schema, positional types), cohort from a parquet
    table, output written day-partitioned and read back."""
    return _complex_backfill(spark, sf_dir)


def _complex_backfill(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    cohort_path = staging_path(spark, "cohort")
    fx.cohort(spark, sf_dir).write.parquet(cohort_path)
    out = staging_path(spark, "complex_features")
    trips, points = _staged_trips(spark, sf_dir), _staged_points(spark, sf_dir)
    if days := _days(spark, trips, points):
        backfill.run_complex(spark, trips_base=trips, points_base=points, out_base=out,
                             first_day=days[0], last_day=days[1], cohort_source=cohort_path, tz=TZ, **options)
    return present(backfill.read_finished(spark, out, COMPLEX_SCHEMA).select(*COMPLEX_COLUMNS, "stat_date"))


#: seconds of a part in the queries on split trips (the stand-in trips are short)
SPLIT_SECONDS = 60


def complex_trip_features_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kinematic table with every trip of over SPLIT_SECONDS computed in parts."""
    return present(j2.complex_trip_features(_points(spark, sf_dir), _trips(spark, sf_dir), fx.cohort(spark, sf_dir),
                                            tz=TZ, part_seconds=SPLIT_SECONDS))


def complex_date_range_backfill_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _complex_backfill(spark, sf_dir, part_seconds=SPLIT_SECONDS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_trips": scan_trips,
    "scan_points": scan_points,
    "scan_points_positional": scan_points_positional,
    "date_range_backfill": date_range_backfill,
    "resumed_backfill": resumed_backfill,
    "checked_trips": checked_trips,
    "rejected_trips": rejected_trips,
    "trips_per_day": trips_per_day,
    "trip_points": trip_points,
    "trip_points_trunc": trip_points_trunc,
    "trip_points_outer": trip_points_outer,
    "cohort_trips": cohort_trips,
    "point_distance": point_distance,
    "jump_filter": jump_filter,
    "trip_hour_mileage": trip_hour_mileage,
    "trip_speed_hist": trip_speed_hist,
    "simple_trip_features": simple_trip_features,
    "validity_join": validity_join,
    "plausible_trips": plausible_trips,
    "vehicle_rollup": vehicle_rollup,
    "vehicle_csv_line": vehicle_csv_line,
    "clean_points": clean_points,
    "clean_distance": clean_distance,
    "complex_trip_head": complex_trip_head,
    "complex_hour_mileage": complex_hour_mileage,
    "complex_speed_hist": complex_speed_hist,
    "speed_stats": speed_stats,
    "kinematics": kinematics,
    "turn_rate": turn_rate,
    "acc_stats": acc_stats,
    "norm_stats": norm_stats,
    "turn_runs": turn_runs,
    "turn_speed_stats": turn_speed_stats,
    "acc_bin_runs": acc_bin_runs,
    "norm_bin_runs": norm_bin_runs,
    "complex_trip_features": complex_trip_features,
    "complex_date_range_backfill": complex_date_range_backfill,
    "complex_trip_features_split": complex_trip_features_split,
    "complex_date_range_backfill_split": complex_date_range_backfill_split,
}
