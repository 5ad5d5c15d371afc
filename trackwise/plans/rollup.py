"""Per-vehicle roll-up of the basic trip features inside validity windows.

Plan: trip features (day-partitioned, read with partition pruning) -> trip
speeds and the plausibility filter -> join with the validity windows on
imei, containment test as residual -> aggregates per (imei, VIN, trip number),
per (imei, VIN, day) and per (imei, VIN). The day is a function of the trip
number, so the distinct trips and days are row counts of the finer levels: no
row is expanded, and a vehicle with very many trips stays split until the last,
partially aggregated level.

The validity table is per vehicle; it is broadcast only when its measured
size (operators.broadcast) fits the broadcast threshold, otherwise the join
is a shuffle join on (imei, time bucket): windows are laid into buckets of
growing width and a trip probes by its start, so a hot vehicle is split over its
days, and the aggregate that follows combines partial results map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackwise.functions.timefmt import day_string
from trackwise.operators.range_join import expand_intervals, interval_facts
from trackwise.schemas import ROLLUP_COLUMNS, SIMPLE_COLUMNS, SIMPLE_HOURS, SIMPLE_SPEED_BINS
from trackwise.sources.sinks import csv_line

# Fixed value of the plausibility rule: path speed / histogram speed.
MAX_SPEED_RATIO = 1.5
VALIDITY_COLUMNS = ["imei", "VIN", "valid_start", "valid_end", "valid_start_utc", "valid_end_utc"]


# Buckets of the validity join: a day wide, or 4, 16, ... days for windows of more than 64 buckets.
BUCKET_SECONDS, BUCKET_GROWTH, BUCKET_LEVELS = 86400, 4, 10


def validity_join(features: DataFrame, validity: DataFrame,
                  salt_buckets: int | None = None, tz: str | None = None) -> DataFrame:
    """Trips lying inside a validity window of their device: the window must
    start no later than the trip start and end no earlier than its end.
    The features' device column is renamed imei_1; a ``day`` column (of ``tz``,
    default the session zone) is added.

    The window table is measured first (operators.range_join): if it fits the
    broadcast threshold it is broadcast as is (a broadcast join has no skew).
    Otherwise it is a shuffle join on (imei, level, bucket): a window is
    expanded to at most 65 time buckets of the narrowest width that allows it, a
    trip probes the bucket of its start at each width in use. A window that holds
    a trip holds its start, so a pair meets in exactly one bucket, and a device
    with a third of all trips is spread over its days. A trip that ends before it
    starts may lie in a window without its start: such rows meet every window
    of their device. ``salt_buckets`` asks for a join by a hash salt instead
    (every window copied to all salts).
    """
    v = validity.select(*VALIDITY_COLUMNS)
    f = (features.withColumnRenamed("imei", "imei_1")
         .withColumn("day", day_string(F.col("tripnumber"), tz=tz)))

    def contained(w: DataFrame, t: DataFrame):
        return ((w["imei"] == t["imei_1"]) & (w["valid_start_utc"] <= t["tripnumber"])
                & (w["valid_end_utc"] >= t["end_time"]))

    widths = {"bucket_seconds": BUCKET_SECONDS, "growth": BUCKET_GROWTH, "levels": BUCKET_LEVELS}
    facts = interval_facts(v, "valid_start_utc", "valid_end_utc", v, **widths)
    if facts.fits[1]:
        b = F.broadcast(v)
        return b.join(f, contained(b, f), "inner")
    if salt_buckets is not None:
        return _salted(v, f, contained, salt_buckets)
    every = v.withColumns({"_level": F.lit(-1), "_bucket": F.lit(0).cast("long")})
    windows = expand_intervals(v, "valid_start_utc", "valid_end_utc", **widths).unionByName(every).hint("merge")
    probes = F.array(*[F.struct(F.lit(i).alias("l"), F.floor(F.col("tripnumber") / (BUCKET_SECONDS * BUCKET_GROWTH ** i)).cast("long").alias("b"))
                       for i in facts.levels])
    odd = F.array(F.struct(F.lit(-1).alias("l"), F.lit(0).cast("long").alias("b")))
    trips = f.withColumn("_probe", F.explode(F.when(F.col("end_time") < F.col("tripnumber"), odd).otherwise(probes)))
    same = (windows["_level"] == trips["_probe.l"]) & (windows["_bucket"] == trips["_probe.b"])
    return windows.join(trips, contained(windows, trips) & same, "inner").drop("_level", "_bucket", "_probe")


def _salted(v: DataFrame, f: DataFrame, contained, salt_buckets: int) -> DataFrame:
    if salt_buckets <= 1:
        m = v.hint("merge")
        return m.join(f, contained(m, f), "inner")
    vs = v.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1)))).hint("merge")
    fs = f.withColumn("_salt", F.pmod(F.xxhash64("tripnumber", "end_time"), F.lit(salt_buckets)).cast("int"))
    out = vs.join(fs, contained(vs, fs) & (vs["_salt"] == fs["_salt"]), "inner")
    return out.drop(vs["_salt"]).drop(fs["_salt"])


def histogram_speed(df: DataFrame) -> "F.Column":
    """Mean speed (km/h) from the speed histogram: bin mid-points 5..195 and 205
    for > 200, weighted by counts, over the number of valid seconds."""
    total = None
    for k, name in enumerate(SIMPLE_SPEED_BINS[1:-1]):
        term = F.col(name) * F.lit(10 * k + 5)
        total = term if total is None else total + term
    total = total + F.col(SIMPLE_SPEED_BINS[-1]) * F.lit(205)
    return F.try_divide(total, F.col("dura_valid"))


def plausible_trips(features: DataFrame, max_ratio: float = MAX_SPEED_RATIO) -> DataFrame:
    """Adds speed_mean (histogram) and speed (mileage over time span, km/h) and
    keeps trips whose ratio speed / speed_mean is at most ``max_ratio``. An
    undefined ratio (zero time span or zero histogram speed) fails the test.

    The test reads trip columns only, so it runs before the validity join:
    the same rows survive and the join gets less input."""
    out = features.withColumns({
        "speed_mean": histogram_speed(features),
        "speed": F.try_divide(F.col("mileage") * F.lit(3600),
                              F.col("end_time") - F.col("start_time")),
    })
    return out.where(F.try_divide(F.col("speed"), F.col("speed_mean")) <= F.lit(max_ratio))


def rollup(trips: DataFrame) -> DataFrame:
    """57 columns per (imei, VIN)."""
    def sums(cast: bool) -> list:
        out = [F.sum(c).alias(c) for c in ["dura", "dura_valid", "mileage"] + SIMPLE_HOURS]
        return out + [(F.sum(c).cast("long") if cast else F.sum(c)).alias(c) for c in SIMPLE_SPEED_BINS]

    vehicle = ["imei", "VIN"]
    bounds = [F.min("valid_start_utc").alias("valid_start_utc"), F.max("valid_end_utc").alias("valid_end_utc")]
    by_trip = trips.groupBy(*vehicle, "tripnumber").agg(F.min("day").alias("day"), *bounds, *sums(False))
    by_day = by_trip.groupBy(*vehicle, "day").agg(
        F.count("tripnumber").alias("no_trip"), F.min("tripnumber").alias("first_time"),
        F.max("tripnumber").alias("last_time"), *bounds, *sums(False))
    out = by_day.groupBy(*vehicle).agg(
        F.min("valid_start_utc").alias("valid_start"),
        F.max("valid_end_utc").alias("valid_end"),
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
        F.count("day").alias("valid_days"),
        F.sum("no_trip").alias("no_trip"),
        *sums(True),
    )
    return out.select(*ROLLUP_COLUMNS)


def vehicle_features(features: DataFrame, validity: DataFrame,
                     max_ratio: float = MAX_SPEED_RATIO, tz: str | None = None) -> DataFrame:
    feats = features.select(*SIMPLE_COLUMNS)
    return rollup(validity_join(plausible_trips(feats, max_ratio), validity, tz=tz))


def vehicle_lines(vehicles: DataFrame, float_digits: int | None = None) -> DataFrame:
    """The roll-up as one comma-separated line per vehicle (NULL -> empty field)."""
    return csv_line(vehicles, ROLLUP_COLUMNS, float_digits=float_digits)
