"""Per-trip basic features (58 columns).

Plan: points (ms -> s) -> bucketed point-in-trip join (a broadcast join where
the trips fit, so nothing moves before it) -> collapse exact copies of the
joined rows (map-side combine, one exchange of the distinct matched rows) ->
exchange on (imei, tripnumber[, stat_date]) -> window for the successor point
-> jump filter -> local window on (imei, tripnumber, vid) for
first/last/new-second flags -> hash aggregate on the same partitioning
(fixed-width buffers, no further exchange). Where the trips do not fit a
broadcast, copies are collapsed before the shuffle join as well.

If any trip is longer than PART_SECONDS, exchange, windows and aggregate are
keyed by the hour of the trip as well, so a single long trip is spread over its
hours: the last point of an hour takes its successor from a table of the first
points (one row per trip and hour), and the hours are combined per trip at the
end. The rows are the same either way.

Semantics kept from the job definition:
* the successor of a trip's last point defaults to (0, 0), so the last
  point is normally removed by the 10 km jump filter;
* jumps remove the point before the jump and the jump point itself;
* fractional seconds are kept (closed interval [start, s_end]).

Copies: with c copies of a row, c - 1 of them have a copy as successor
(distance 0, kept) and one has the next distinct row. A collapsed row
therefore stands for ``kept = c - 1 + [am < jump]`` rows; without a position
the distance between copies is NULL too and none of them is kept.

With ``by_day`` every window is keyed by the day as well: a trip listed under
two days is two trips, as in two runs of one day each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackwise.functions.binning import ceil_bin_counts, sums_by_value
from trackwise.functions.geo import gps_dist
from trackwise.functions.timefmt import hour_of_day
from trackwise.operators.copies import collapse_copies, expand_copies
from trackwise.operators.range_join import (DEFAULT_BUCKET_SECONDS, IntervalFacts, interval_facts,
                                           points_in_intervals)
from trackwise.schemas import SIMPLE_COLUMNS, SIMPLE_HOURS, SIMPLE_SPEED_BINS

JUMP_KM = 10.0
POINT_COLS = ["imei", "lat", "lon", "speed", "time_stamp"]
TRIP_KEY = ["imei", "tripnumber"]
ORDER = ["time_stamp", "lat", "lon", "speed", "vid", "tid", "s_end"]
#: windows over longer trips are cut into parts of so many seconds
PART, PART_SECONDS = "_part", 3600
ROW_COLS = ["imei", "tid", "vid", "tripnumber", "s_end", "lat", "lon", "speed", "time_stamp"]


def _day_cols(df: DataFrame, by_day: bool) -> list[str]:
    return ["stat_date"] if by_day and "stat_date" in df.columns else []


def seconds_points(points: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """GPS points with time_stamp converted from ms to (fractional) seconds."""
    return points.select(*[c for c in POINT_COLS if c != "time_stamp"], *extra,
                         (F.col("time_stamp") / F.lit(1000)).alias("time_stamp"))


def assign_trips(points: DataFrame, trips: DataFrame, *, by_day: bool = False,
                 bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
                 facts: IntervalFacts | None = None) -> DataFrame:
    """Points (seconds) joined to the trips whose [start, s_end] contains them.

    Trips with start <= 0 are not trips. With ``by_day`` the points and trips
    of the same stat_date are matched only (one run per day).
    """
    day = _day_cols(trips, by_day)
    tr = numbered_trips(trips, by_day)
    extra = (("stat_date", "trip_day"),) if day else ()
    joined = points_in_intervals(points, tr, point_key="imei", interval_key="deviceid",
                                 ts="time_stamp", start="tripnumber", end="s_end",
                                 extra_keys=extra, bucket_seconds=bucket_seconds,
                                 facts=facts)
    joined = joined.drop("deviceid")
    return joined.drop("trip_day") if day else joined


def numbered_trips(trips: DataFrame, by_day: bool) -> DataFrame:
    """Trips with a positive start, which is their number."""
    day = [F.col(d).alias("trip_day") for d in _day_cols(trips, by_day)]
    return (trips.select("tid", "vid", "deviceid", F.col("start").alias("tripnumber"), "s_end", *day)
            .where(F.col("tripnumber") > 0))


def trip_facts(trips: DataFrame, by_day: bool, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> IntervalFacts:
    return interval_facts(numbered_trips(trips, by_day), "tripnumber", "s_end", bucket_seconds=bucket_seconds)


def trip_point_rows(points: DataFrame, trips: DataFrame, *, by_day: bool = False,
                    bucket_seconds: int = DEFAULT_BUCKET_SECONDS, facts: IntervalFacts | None = None) -> DataFrame:
    """Distinct (trip, point) rows with a ``copies`` weight."""
    day = _day_cols(points, by_day)
    pts = seconds_points(points, tuple(day))
    facts = facts or trip_facts(trips, by_day, bucket_seconds)
    if not facts.fits[0]:       # the points are shuffled for the join: without their copies
        pts = collapse_copies(pts, POINT_COLS + day)
    rows = assign_trips(pts, trips, by_day=by_day, bucket_seconds=bucket_seconds, facts=facts)
    return collapse_copies(rows, ROW_COLS + day)


def successor_rows(rows: DataFrame, jump_km: float = JUMP_KM) -> DataFrame:
    """Adds lat_0/lon_0 (successor, default 0), am (km to it) and ``kept``."""
    trip = [*TRIP_KEY, *_day_cols(rows, True)]
    if PART in rows.columns:
        out = _successors_by_part(rows, trip)
    else:
        w = Window.partitionBy(*trip).orderBy(*[F.asc_nulls_first(c) for c in ORDER])
        out = rows.select("*", F.lead("lat", 1, 0.0).over(w).alias("lat_0"), F.lead("lon", 1, 0.0).over(w).alias("lon_0"))
    out = out.withColumn("am", gps_dist("lat", "lon", "lat_0", "lon_0"))
    last_kept = F.coalesce(F.col("am") < F.lit(jump_km), F.lit(False))
    copies_kept = F.coalesce(gps_dist("lat", "lon", "lat", "lon") < F.lit(jump_km), F.lit(False))
    return out.withColumns({
        "last_kept": last_kept,
        "kept": F.when(copies_kept, F.col("copies") - 1).otherwise(F.lit(0)) + last_kept.cast("long"),
    })


def _successors_by_part(rows: DataFrame, trip: list[str]) -> DataFrame:
    """lat_0/lon_0 where the windows are cut into parts of a trip."""
    # struct order is the windows' order: column by column, NULL first
    first = rows.groupBy(*trip, PART).agg(F.min(F.struct(*ORDER)).alias("_first_row"))
    by_part = Window.partitionBy(*trip).orderBy(PART)
    following = first.select(*trip, PART, F.lead("_first_row").over(by_part).alias("_next"))
    w = Window.partitionBy(*trip, PART).orderBy(*[F.asc_nulls_first(c) for c in ORDER])
    inside = F.lead(F.lit(True)).over(w).isNotNull()

    def successor(c: str):
        after = F.when(F.col("_next").isNotNull(), F.col(f"_next.{c}")).otherwise(F.lit(0.0))
        return F.when(inside, F.lead(c).over(w)).otherwise(after).alias(f"{c}_0")

    return rows.join(following, [*trip, PART]).select(*rows.columns, successor("lat"), successor("lon"))


def expand_rows(rows: DataFrame) -> DataFrame:
    """One row per original GPS row: copies before the last one have a copy as
    successor (same position, distance 0)."""
    ex = expand_copies(rows)
    not_last = F.col("copy_no") < F.col("copies")
    return ex.withColumns({
        "lat_0": F.when(not_last, F.col("lat")).otherwise(F.col("lat_0")),
        "lon_0": F.when(not_last, F.col("lon")).otherwise(F.col("lon_0")),
        "am": F.when(not_last, gps_dist("lat", "lon", "lat", "lon")).otherwise(F.col("am")),
    })


def simple_rows(points: DataFrame, trips: DataFrame, *, by_day: bool = False,
                jump_km: float = JUMP_KM,
                bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    facts = trip_facts(trips, by_day, bucket_seconds)
    rows = trip_point_rows(points, trips, by_day=by_day, bucket_seconds=bucket_seconds, facts=facts)
    if facts.longest > PART_SECONDS:
        rows = rows.withColumn(PART, F.floor((F.col("time_stamp") - F.col("tripnumber")) / PART_SECONDS))
    return successor_rows(rows, jump_km)


def aggregate_trips(rows: DataFrame, tz: str | None = None, by_day: bool = False) -> DataFrame:
    """Per (imei, vid, tripnumber) features from successor rows (kept > 0).

    First/last rows and new seconds are flagged by a window on the group (same
    hash partitioning, local sort only), so the aggregate needs only fixed-width
    buffers: a partial+final hash aggregate with no exchange. Parts of a trip (a
    second lies in one part) are aggregated first and then combined.
    """
    day = _day_cols(rows, by_day)
    group = ["imei", "tripnumber", "vid", *day]
    part = [PART] if PART in rows.columns else []
    w = Window.partitionBy(*group, *part).orderBy(*[F.asc_nulls_first(c) for c in
                                              ["time_stamp", "lat", "lon", "speed", "tid", "s_end"]])
    kept = rows.where(F.col("kept") > 0).select(
        "*",
        F.lag(F.lit(1)).over(w).isNull().alias("_first"),
        F.lead(F.lit(1)).over(w).isNull().alias("_last"),
        (~F.lag("time_stamp").over(w).eqNullSafe(F.col("time_stamp"))).alias("_new_second"),
    )
    kept = kept.withColumns({
        "_am_kept": F.when(F.col("last_kept"), F.col("am")).otherwise(F.lit(0.0)),
        "_hour": hour_of_day(F.col("time_stamp"), tz),
    })
    am_kept = F.col("_am_kept")
    aggs = [
        F.min("time_stamp").alias("start_time"),
        F.max("time_stamp").alias("end_time"),
        F.max("s_end").alias("s_end"),
        F.count_if("_new_second").alias("dura_valid"),
        F.max(F.when(F.col("_first"), F.col("lat"))).alias("lat_st"),
        F.max(F.when(F.col("_first"), F.col("lon"))).alias("lon_st"),
        F.max(F.when(F.col("_last"), F.col("lat"))).alias("lat_end"),
        F.max(F.when(F.col("_last"), F.col("lon"))).alias("lon_end"),
        F.sum(am_kept).alias("mileage"),
    ]
    aggs += sums_by_value("_am_kept", "_hour", range(24), SIMPLE_HOURS)
    aggs += ceil_bin_counts("speed", "kept", SIMPLE_SPEED_BINS)
    out = kept.groupBy(*group, *part).agg(*aggs)
    if part:
        out = _combine_parts(out, group)
    return out.withColumn("dura", F.col("s_end") - F.col("tripnumber")).select(*SIMPLE_COLUMNS, *day)


def _combine_parts(parts: DataFrame, group: list[str]) -> DataFrame:
    return parts.groupBy(*group).agg(
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"), F.max("s_end").alias("s_end"),
        *[F.min_by(c, PART).alias(c) for c in ("lat_st", "lon_st")],
        *[F.max_by(c, PART).alias(c) for c in ("lat_end", "lon_end")],
        *[F.sum(c).alias(c) for c in ("dura_valid", "mileage", *SIMPLE_HOURS, *SIMPLE_SPEED_BINS)])


def simple_trip_features(points: DataFrame, trips: DataFrame, *, by_day: bool = False,
                         jump_km: float = JUMP_KM, tz: str | None = None,
                         bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """The 58-column per-trip table (plus stat_date with ``by_day``)."""
    rows = simple_rows(points, trips, by_day=by_day, jump_km=jump_km,
                       bucket_seconds=bucket_seconds)
    return aggregate_trips(rows, tz=tz, by_day=by_day)
