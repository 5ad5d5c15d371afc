"""Literal GPS rows for unit tests."""

from pyspark.sql import types as T

T0 = 1704067200  # 2024-01-01 00:00:00 UTC

POINT_SCHEMA = T.StructType([
    T.StructField("imei", T.StringType()), T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()), T.StructField("speed", T.DoubleType()),
    T.StructField("direction", T.IntegerType()), T.StructField("time_stamp", T.LongType()),
])
TRIP_SCHEMA = T.StructType([
    T.StructField("deviceid", T.StringType()), T.StructField("tid", T.StringType()),
    T.StructField("vid", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("s_end", T.IntegerType()),
])


def points(spark, rows):
    """rows: (lat, lon, speed, direction, seconds after T0 [float]) for device '1'."""
    data = [("1", la, lo, sp, d, int(round((T0 + s) * 1000))) for la, lo, sp, d, s in rows]
    return spark.createDataFrame(data, POINT_SCHEMA)


def trip(spark, start_off=0, end_off=10_000, imei="1"):
    return spark.createDataFrame([(imei, "t1", "v1", T0 + start_off, T0 + end_off)], TRIP_SCHEMA)
