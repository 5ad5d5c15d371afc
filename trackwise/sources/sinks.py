"""Writers for the job outputs.

Outputs are written under one directory per day with dynamic partition
overwrite, so re-running days (after a failure or a late feed) replaces
exactly those days and nothing else; a requested day that has no rows any
more loses its old directory. File counts follow the data (AQE splits and
coalesces the partitions of the rebalanced rows) instead of forcing one task
per output.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackwise.session import staging_path


def day_files(spark: SparkSession, base: str, day_col: str = "stat_date",
              days: tuple[str, str] | None = None) -> dict[str, list[tuple[str, int, int]]]:
    """Day -> its files as (name, bytes, time of change), for the day directories below
    ``base``; with ``days`` those from the first to the last day, and only these are listed."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return {}
    begin = os.path.commonprefix(days) if days else ""
    dirs = {d.getPath().getName().split("=", 1)[1]: d.getPath() for d in fs.listStatus(path, hadoop.GlobFilter(f"{day_col}={begin}*"))}
    return {day: sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(d))
            for day, d in dirs.items() if not days or days[0] <= day <= days[1]}


def _day_files(spark: SparkSession, base: str, day_col: str, days: tuple[str, str]) -> dict[str, tuple]:
    return {day: tuple(name for name, _, _ in files) for day, files in day_files(spark, base, day_col, days).items()}


def write_day_partitioned(df: DataFrame, base: str, day_col: str = "stat_date",
                          days: tuple[str, str] | None = None) -> None:
    """Parquet under base/stat_date=YYYYMMDD/, overwriting the days present.

    The rows are rebalanced by day (AQE sizes the partitions; no sampling, so
    the plan runs once): a run over many days gives about tasks + days files
    instead of tasks x days. The shuffle moves feature rows (one per trip), not
    points. ``days`` (first, last) are the days the rows were computed for:
    directories of this range that the write left as they were had no rows this
    time and are removed.
    """
    spark = df.sparkSession
    before = _day_files(spark, base, day_col, days) if days else {}
    (df.hint("rebalance", day_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(day_col).parquet(base))
    if not days:
        return
    after = _day_files(spark, base, day_col, days)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for day, files in before.items():
        if after.get(day) == files:
            p = path(f"{base}/{day_col}={day}")
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def through_staging(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once for several
    readers, and a lost executor costs a re-read."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _field_text(c: str, dtype: T.DataType, float_digits: int | None) -> Column:
    col = F.col(c)
    if float_digits is not None and isinstance(dtype, (T.DoubleType, T.FloatType)):
        col = F.format_string(f"%.{float_digits}f", F.round(col, float_digits))
    return F.coalesce(col.cast("string"), F.lit(""))


def csv_line(df: DataFrame, columns: list[str] | None = None, sep: str = ",",
             float_digits: int | None = None, name: str = "df_concat") -> DataFrame:
    """All columns joined into one text column; NULL becomes an empty field so
    field positions never shift. ``float_digits`` fixes the decimals of
    floating columns (default: Spark's shortest round-trip text)."""
    columns = columns or df.columns
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    return df.select(F.concat_ws(sep, *[_field_text(c, types[c], float_digits)
                                        for c in columns]).alias(name))


def write_lines(df: DataFrame, path: str) -> None:
    """Text sink for a single string column."""
    df.write.mode("overwrite").text(path)
