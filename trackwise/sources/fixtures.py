"""Stand-in inputs derived from the test tables.

The test data has no GPS feed, so a deterministic 1 Hz track per user is
derived from ``events`` (see FIXTURES.md): running sums of event-id
arithmetic give positions and headings, event ids select jumps, no-fix
points, missing speeds and exact copies. Trips, the cohort and validity
windows come from ``events``/``customer``. Everything is derived by Spark
from the tables, so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackwise.functions.timefmt import day_string, utc_day_key

# Fixed values of the stand-in data definition.
EPOCH0 = 1704067200          # 2024-01-01 00:00:00 UTC
USER_STRIDE = 599            # seconds between consecutive users' tracks (some cross midnight)
USERS = 500000               # ids go round after so many, so that times stay 32-bit seconds
TRIP1_END = 66               # first trip: [start, start + 66]
TRIP2_START, TRIP2_END = 67, 400
OTHER_END = 50               # second s_end of the first trip where it is listed twice
TRIP2_ID_OFFSET, VID_OFFSET = 500000, 100000


def track_start(user):
    """First second of a user's track."""
    return F.lit(EPOCH0) + F.pmod(user, F.lit(USERS)) * USER_STRIDE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: events of a user whose ids lie in one range of so many are summed in one window
CHUNK = 1_000_000


def _running_sums(events: DataFrame, steps: dict) -> DataFrame:
    """``events`` with the running number ``seq`` and running sums of ``steps`` per
    user in event order, in two levels: within ranges of event ids, and over the
    ranges, so a user with very many events is not one task."""
    chunked = events.withColumn("chunk", F.floor(F.col("event_id") / CHUNK))
    within = Window.partitionBy("user_id", "chunk").orderBy("event_id")
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = chunked.select("*", F.row_number().over(within).alias("seq"),
                            *[F.sum(e).over(so_far).cast("long").alias(n) for n, e in steps.items()])
    totals = chunked.groupBy("user_id", "chunk").agg(F.count(F.lit(1)).alias("seq"),
                                                     *[F.sum(e).cast("long").alias(n) for n, e in steps.items()])
    before = (Window.partitionBy("user_id").orderBy("chunk")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("user_id", "chunk", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_{n}")
                                                  for n in ("seq", *steps)])
    joined = inside.join(offsets, ["user_id", "chunk"])
    return joined.select(*events.columns, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in ("seq", *steps)])


def gps_points(spark: SparkSession, sf_dir: str, full_schema: bool = False) -> DataFrame:
    """GPS points (imei, lat, lon, speed, direction, time_stamp ms)."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    e = F.col("event_id")
    c = _running_sums(ev, {"cy": (e * 37) % 21 - 10, "cx": (e * 53) % 21 - 10, "ch": (e * 13) % 21 - 10})
    c2 = c.unionByName(c.where((e % 89 == 0) | (e % 103 == 0)))
    u = F.col("user_id")
    lat_tail = F.pmod(u, F.lit(USERS)) * F.lit(1e-2)
    lat = (F.when(e % 103 == 0, F.lit(None).cast("double"))
           .when(e % 101 == 0, F.lit(0.0))
           .when(e % 97 == 0, F.lit(31.0) + lat_tail + F.col("cy") * F.lit(2e-5))
           .otherwise(F.lit(30.0) + lat_tail + F.col("cy") * F.lit(2e-5)))
    lon = F.when(e % 103 == 0, F.lit(None).cast("double")).when(e % 101 == 0, F.lit(0.0)).otherwise(F.lit(120.0) + F.col("cx") * F.lit(2e-5))
    speed = (F.when(e % 83 == 0, F.lit(None).cast("double"))
             .when(F.col("event_type") == "error", F.lit(0.0))
             .otherwise(F.col("value")))
    ts = (track_start(u) + F.col("seq")) * 1000 + (e % 4) * 250
    out = c2.select(
        u.cast("string").alias("imei"), lat.alias("lat"), lon.alias("lon"),
        speed.alias("speed"), ((F.col("ch") + 36000) % 360).cast("int").alias("direction"),
        ts.cast("long").alias("time_stamp"))
    if full_schema:
        out = out.select(
            "imei", "lat", "lon", F.col("lat").alias("alat"), F.col("lon").alias("alon"),
            "speed", "direction", F.lit(0).alias("altitude"), F.lit(1.0).alias("pdop"),
            "time_stamp", F.lit(1).alias("protocal_type"))
    return out


def trip_stat(spark: SparkSession, sf_dir: str, full_schema: bool = False) -> DataFrame:
    """Two trips per user: [t0, t0+66] and [t0+67, t0+400], t0 = EPOCH0 + USER_STRIDE * (user mod USERS).

    Some first trips are listed twice, as they are (user % 5 = 2) or with another
    end (user % 5 = 4); some second trips have no tid (user % 7 = 3)."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    u = F.col("user_id")
    t0 = track_start(u)
    first = users.select(u.cast("string").alias("deviceid"), u.cast("string").alias("tid"),
                         (u + VID_OFFSET).cast("string").alias("vid"),
                         t0.cast("int").alias("start"), (t0 + TRIP1_END).cast("int").alias("s_end"))
    second = users.select(u.cast("string").alias("deviceid"),
                          F.when(u % 7 != 3, (u + TRIP2_ID_OFFSET).cast("string")).alias("tid"),
                          (u + VID_OFFSET).cast("string").alias("vid"),
                          (t0 + TRIP2_START).cast("int").alias("start"),
                          (t0 + TRIP2_END).cast("int").alias("s_end"))
    again = first.where(F.col("tid").cast("long") % 5 == 2)
    other = (first.where(F.col("tid").cast("long") % 5 == 4)
             .withColumn("s_end", (F.col("start") + OTHER_END).cast("int")))
    trips = first.unionByName(second).unionByName(again).unionByName(other)
    if full_schema:
        nulls = {c: F.lit(None).cast(t) for c, t in [
            ("actual_start", "int"), ("dura", "double"), ("period", "int"),
            *[(n, "double") for n in ("lat_st_ori", "lon_st_ori", "lat_en_ori", "lon_en_ori",
                                      "m_ori", "lat_st_def", "lon_st_def", "lat_en_def",
                                      "lon_en_def", "m_def", "speed_mean", "gps_speed_sd",
                                      "gps_acc_sd")]]}
        trips = trips.select("deviceid", "tid", "vid", "start", nulls["actual_start"].alias("actual_start"),
                             "s_end", *[v.alias(k) for k, v in nulls.items() if k != "actual_start"])
    return trips


def with_trip_day(trips: DataFrame) -> DataFrame:
    """One row per UTC day (stat_date, yyyyMMdd) that the trip touches at its start or
    end: a trip over midnight is listed under two days."""
    return trips.withColumn("stat_date", F.explode(F.array_distinct(F.array(
        utc_day_key(F.col("start")), utc_day_key(F.col("s_end"))))))


def with_point_day(points: DataFrame) -> DataFrame:
    """Partition value stat_date (yyyyMMdd, UTC) of a point (time_stamp in ms)."""
    return points.withColumn("stat_date", utc_day_key(F.col("time_stamp") / F.lit(1000)))


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "customer").where(F.col("c_custkey") % 10 != 3)
            .select(F.col("c_custkey").cast("string").alias("imei")))


def validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-vehicle validity windows of 0..200 s (imei, VIN, epoch bounds + datetime text)."""
    k = F.col("c_custkey")
    start = track_start(k)
    end = start + (k % 5) * 50
    return (table(spark, sf_dir, "customer").where(k % 10 != 3)
            .select(k.cast("string").alias("imei"), F.col("c_name").alias("VIN"),
                    day_string(start, "yyyy-MM-dd HH:mm:ss", "Etc/UTC").alias("valid_start"),
                    day_string(end, "yyyy-MM-dd HH:mm:ss", "Etc/UTC").alias("valid_end"),
                    start.cast("long").alias("valid_start_utc"),
                    end.cast("long").alias("valid_end_utc")))
