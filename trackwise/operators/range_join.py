"""Point-in-interval join on an equality key plus a closed time range.

Spark has no range-join strategy; an equi-join on the device key alone would
(a) compare every point of a device with every trip of that device and
(b) send all points of a hot device to one task. Both go away by adding a
time bucket to the key: each interval is expanded to the buckets it touches
(``explode(sequence(...))``), each point carries its one bucket, and the exact
range test stays as a residual predicate. A (point, interval) pair matches in
exactly one bucket, so no duplicates arise.

Broadcast only behind a measured size check of the expanded interval side
(interval_facts: its UnsafeRow size against the session's broadcast
threshold); beyond the threshold the join is a shuffle join on
(key, bucket), which spreads a hot device over its hours. Buckets are an hour
wide; an interval of more than FAN_OUT hours is expanded to buckets FAN_OUT
times as wide (and so on), so every interval costs a bounded number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackwise.operators.broadcast import broadcast_threshold, row_bytes
from trackwise.sources.sinks import through_staging

DEFAULT_BUCKET_SECONDS = 3600


#: an interval is expanded to at most FAN_OUT + 1 buckets; longer ones use
#: buckets FAN_OUT (or FAN_OUT ** 2, ...) times as wide
FAN_OUT = 64
LEVELS = 4


def _width(level, seconds: int, growth: int):
    return F.lit(seconds).cast("long") * F.pow(F.lit(growth), level).cast("long")


def expand_intervals(intervals: DataFrame, start: str, end: str, bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
                     growth: int = FAN_OUT, levels: int = LEVELS) -> DataFrame:
    """One row per (interval, time bucket it touches): width level in ``_level``,
    bucket in ``_bucket``. A level's buckets are ``growth`` times as wide as the
    level's below; an interval takes the lowest with at most FAN_OUT + 1 of them."""
    span = (F.col(end) - F.col(start)) / F.lit(bucket_seconds)
    level = F.lit(levels - 1)
    for i in reversed(range(levels - 1)):
        level = F.when(span <= FAN_OUT * growth ** i, F.lit(i)).otherwise(level)
    at = lambda c: F.floor(F.col(c) / _width(F.col("_level"), bucket_seconds, growth)).cast("long")
    return (intervals.where(F.col(start) <= F.col(end)).withColumn("_level", level)
            .withColumn("_bucket", F.explode(F.sequence(at(start), at(end)))))


@dataclass(frozen=True)
class IntervalFacts:
    """What one aggregate over the interval side tells before a join."""
    fits: list[bool]            # the expanded intervals fit a broadcast; then the other sides
    longest: float              # longest interval, 0 without intervals
    levels: list[int]           # width levels in use


def interval_facts(intervals: DataFrame, start: str, end: str, *others: DataFrame,
                   bucket_seconds: int = DEFAULT_BUCKET_SECONDS, growth: int = FAN_OUT, levels: int = LEVELS) -> IntervalFacts:
    """Size bound of the expanded intervals, longest interval and levels, and the size
    bounds of other sides of the plan, in one job."""
    iv = expand_intervals(intervals, start, end, bucket_seconds, growth, levels)
    sides = [iv.select(F.lit(0).alias("side"), row_bytes(iv).alias("bytes"), (F.col(end) - F.col(start)).cast("double").alias("span"),
                       F.col("_level").alias("level"))]
    sides += [o.select(F.lit(i).alias("side"), row_bytes(o).alias("bytes"), F.lit(None).cast("double").alias("span"),
                       F.lit(None).cast("int").alias("level")) for i, o in enumerate(others, 1)]
    union = sides[0]
    for x in sides[1:]:
        union = union.unionByName(x)
    found = {r["side"]: r for r in union.groupBy("side").agg(
        F.sum("bytes").alias("bytes"), F.max("span").alias("span"), F.collect_set("level").alias("levels")).collect()}
    limit = broadcast_threshold(intervals)
    fits = [limit >= 0 and (found[i]["bytes"] if i in found else 0) <= limit for i in range(len(sides))]
    own = found.get(0)
    return IntervalFacts(fits, own["span"] if own else 0.0, sorted(own["levels"]) if own else [0])


def points_in_intervals(points: DataFrame, intervals: DataFrame, *, point_key: str,
                        interval_key: str, ts: str, start: str, end: str,
                        extra_keys: tuple[tuple[str, str], ...] = (),
                        bucket_seconds: int = DEFAULT_BUCKET_SECONDS, growth: int = FAN_OUT, levels: int = LEVELS,
                        facts: IntervalFacts | None = None) -> DataFrame:
    """Inner join of points with intervals: key equal and start <= ts <= end.

    ``extra_keys`` are additional (point column, interval column) equalities,
    e.g. the day partition. Output has every column of both inputs. The expanded
    interval side is measured first (or ``facts`` were measured by the caller) and
    broadcast only if it fits the broadcast threshold (see operators.broadcast).
    Points are probed once per level of bucket width that the intervals use.
    """
    widths = {"bucket_seconds": bucket_seconds, "growth": growth, "levels": levels}
    if facts is None:
        facts = interval_facts(intervals, start, end, **widths)
    iv = expand_intervals(intervals, start, end, **widths)
    iv = F.broadcast(iv) if facts.fits[0] else iv.hint("merge")
    probe = [F.struct(F.lit(i).alias("l"), F.floor(F.col(ts) / F.lit(bucket_seconds * growth ** i)).cast("long").alias("b"))
             for i in facts.levels]
    pt = points.withColumn("_probe", probe[0] if len(probe) == 1 else F.explode(F.array(*probe)))
    pt = pt.withColumns({"_plevel": F.col("_probe.l"), "_pbucket": F.col("_probe.b")}).drop("_probe")
    cond = [pt[point_key] == iv[interval_key], pt["_pbucket"] == iv["_bucket"], pt["_plevel"] == iv["_level"],
            pt[ts] >= iv[start], pt[ts] <= iv[end]]
    cond += [pt[a] == iv[b] for a, b in extra_keys]
    return pt.join(iv, cond, "inner").drop("_bucket", "_pbucket", "_level", "_plevel")


def points_in_intervals_outer(points: DataFrame, intervals: DataFrame, *, point_key: str,
                              interval_key: str, ts: str, start: str, end: str,
                              interval_id: list[str] | None = None,
                              bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Interval-preserving (right outer) form: unmatched intervals keep one row
    with NULL point columns.

    The intervals are numbered in a written table (so that the numbers hold, whatever is
    computed again), joined once, and the matches written with their interval's number:
    the numbers in that table are the match marks, and an interval without one keeps its
    NULL row. Points are scanned and joined once; intervals with NULL ids, or listed
    twice, are told apart by their numbers (``interval_id`` is accepted and not needed).
    """
    numbered = through_staging(intervals.withColumn("_interval", F.monotonically_increasing_id()), "intervals")
    matches = through_staging(points_in_intervals(
        points, numbered, point_key=point_key, interval_key=interval_key, ts=ts, start=start, end=end,
        bucket_seconds=bucket_seconds), "matches")
    marks = matches.select("_interval").distinct()
    null_points = [F.lit(None).cast(f.dataType).alias(f.name) for f in points.schema.fields]
    unmatched = numbered.join(marks, "_interval", "left_anti").select(*intervals.columns, *null_points)
    return matches.drop("_interval").unionByName(unmatched)
