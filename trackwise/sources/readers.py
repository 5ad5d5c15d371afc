"""Readers for the job inputs.

Day directories (``stat_date=YYYYMMDD``) are read through partition
discovery from the base path, so a day range is a predicate on the partition
column and Spark prunes the directories; the schema is always given, never
inferred.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackwise.functions.timefmt import epoch_seconds
from trackwise.schemas import (COHORT_SCHEMA, GPS_POSITIONAL_TYPES, GPS_SCHEMA, TRIP_COLUMNS,
                               TRIP_SCHEMA)

DAY_FIELD = T.StructField("stat_date", T.StringType())


def _with_day(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [DAY_FIELD])


def _days(df: DataFrame, days: Iterable[str] | None) -> DataFrame:
    return df if days is None else df.where(F.col("stat_date").isin(list(days)))


def read_trip_stat(spark: SparkSession, base: str, days: Iterable[str] | None = None,
                   all_columns: bool = False) -> DataFrame:
    """Comma-delimited trip table without header; keeps the 5 used columns + stat_date."""
    df = spark.read.schema(_with_day(TRIP_SCHEMA)).option("sep", ",").option("header", False) \
        .option("mode", "PERMISSIVE").csv(base)
    df = _days(df, days)
    return df if all_columns else df.select(*TRIP_COLUMNS, "stat_date")


def read_gps_points(spark: SparkSession, base: str, days: Iterable[str] | None = None,
                    positional_cast: bool = False) -> DataFrame:
    """GPS parquet with the fixed schema, or with the file schema re-typed by position."""
    if not positional_cast:
        return _days(spark.read.schema(_with_day(GPS_SCHEMA)).parquet(base), days)
    df = _file_schema_read(spark, base)
    data_cols = [f for f in df.schema.fields if f.name != "stat_date"]
    check_positional(data_cols, GPS_SCHEMA.fieldNames())
    typed = [F.col(f"`{f.name}`").cast(t).alias(n) for f, t, n in
             zip(data_cols, GPS_POSITIONAL_TYPES, GPS_SCHEMA.fieldNames())]
    return _days(df.select(*typed, F.col("stat_date").cast("string").alias("stat_date")), days)


def _file_schema_read(spark: SparkSession, base: str) -> DataFrame:
    """The files with their own schema; a dataset without files has the declared one."""
    try:
        return spark.read.parquet(base)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.read.schema(_with_day(GPS_SCHEMA)).parquet(base)


def check_positional(fields: list[T.StructField], names: list[str]) -> None:
    """Re-typing by position needs exactly the declared columns, each a number or text:
    raises ValueError for a file with other columns instead of cutting or shifting them."""
    if len(fields) != len(names):
        raise ValueError(f"positional read: {len(names)} columns expected ({', '.join(names)}), "
                         f"the files have {len(fields)} ({', '.join(f.name for f in fields)})")
    odd = [f"{f.name} {f.dataType.simpleString()} (for {n})" for f, n in zip(fields, names)
           if not isinstance(f.dataType, (T.NumericType, T.StringType))]
    if odd:
        raise ValueError(f"positional read: neither number nor text: {', '.join(odd)}")


def read_cohort(spark: SparkSession, source: str) -> DataFrame:
    """Cohort of device ids from a catalog table name or a parquet path."""
    df = spark.read.schema(COHORT_SCHEMA).parquet(source) if "/" in source else spark.table(source)
    return df.select(F.col("imei").cast("string").alias("imei"))


def validity_from_datetimes(df: DataFrame, fmt: str = "yyyy-MM-dd HH:mm:ss", tz: str | None = None) -> DataFrame:
    """Add epoch bounds valid_start_utc / valid_end_utc to windows given as datetime
    text of ``tz`` (default: the session zone)."""
    return df.withColumns({
        "imei": F.col("imei").cast("string"),
        "valid_start_utc": epoch_seconds(F.col("valid_start"), fmt, tz),
        "valid_end_utc": epoch_seconds(F.col("valid_end"), fmt, tz),
    })


def read_validity(spark: SparkSession, path: str, fmt: str = "parquet", tz: str | None = None) -> DataFrame:
    """Validity windows (imei, VIN, valid_start, valid_end) from parquet or CSV with header."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    return validity_from_datetimes(reader.format(fmt).load(path), tz=tz)


def read_trip_features(spark: SparkSession, base: str, days: Iterable[str] | None = None,
                       schema: T.StructType | None = None) -> DataFrame:
    """Trip-feature dataset written day-partitioned by the feature jobs.

    With ``schema`` (SIMPLE_SCHEMA, COMPLEX_SCHEMA) nothing is inferred, and a dataset
    without files is an empty table. The day value stays text (yyyyMMdd) rather than an
    inferred number."""
    reader = spark.read.option("basePath", base)
    df = (reader.schema(_with_day(schema)) if schema else reader).parquet(base)
    return _days(df.withColumn("stat_date", F.col("stat_date").cast("string")), days)


def read_trip_stat_checked(spark: SparkSession, base: str, staged: str, days: Iterable[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of the trip table: rows that fit the schema, and the others.

    A row with a field that is no number where one is due, or with too few or too many
    fields, is a reject: ``stat_date, reason, row`` (the text as read). The text is read and
    parsed once, into a table ``staged`` by quality and day; both results are read from it
    through partition pruning. ``good`` has the columns of :func:`read_trip_stat`; the
    staged table keeps all fields, so that a row is judged by every one of them.
    """
    bad = "_bad"
    schema = T.StructType([*TRIP_SCHEMA.fields, T.StructField(bad, T.StringType()), DAY_FIELD])
    df = (spark.read.schema(schema).option("sep", ",").option("header", False).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", bad)
          .option("columnPruning", False)
          .csv(base))
    fields = F.size(F.split(bad, ",", -1))
    reason = F.when(F.col(bad).isNull(), "").when(fields < len(TRIP_SCHEMA), "too few fields").when(
        fields > len(TRIP_SCHEMA), "too many fields").otherwise("not a number")
    keep = [F.when(F.col(bad).isNull(), F.col(c)).alias(c) for c in TRIP_SCHEMA.fieldNames()]
    (_days(df, days).select(*keep, F.col(bad).alias("row"), reason.alias("reason"), F.when(F.col(bad).isNull(), "good").otherwise("reject").alias("quality"),
                            "stat_date").write.partitionBy("quality", "stat_date").parquet(staged))
    table = spark.read.schema(T.StructType([*TRIP_SCHEMA.fields, T.StructField("row", T.StringType()), T.StructField("reason", T.StringType()),
                                            T.StructField("quality", T.StringType()), DAY_FIELD])).parquet(staged)
    return (table.where("quality = 'good'").select(*TRIP_COLUMNS, "stat_date"),
            table.where("quality = 'reject'").select("stat_date", "reason", "row"))


def reject_counts(rejects: DataFrame) -> DataFrame:
    """(stat_date, reason, rows) of the rejects."""
    return rejects.groupBy("stat_date", "reason").agg(F.count(F.lit(1)).alias("rows"))
