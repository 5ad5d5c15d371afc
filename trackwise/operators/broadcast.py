"""Broadcast behind a measured size check.

Spark's static size estimate of a derived side (e.g. trips expanded to the
hour buckets they span) does not see how many rows the expansion produces.
Before a join, :func:`size_checked` measures the side with one aggregate:
an upper bound of its in-memory size as UnsafeRows (null bitset, 8 bytes per
field, variable-length data rounded to 8 bytes; twice, for the key that the
hash relation stores beside the row; plus per-row hash-table overhead). At or under the session's broadcast threshold the side is hinted
``broadcast``; above it ``merge``, so the join is a shuffle join and Spark
cannot broadcast it on a low estimate. The side being measured is the small
one (trips, cohort, validity windows); the points are never scanned for it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_OVERHEAD_BYTES = 16     # hash-table slot and pointer per row
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def broadcast_threshold(df: DataFrame) -> int:
    """spark.sql.autoBroadcastJoinThreshold of the session, in bytes (-1: never)."""
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", raw)
    if not m:
        return 10 * 1024 * 1024
    return int(m.group(1)) * _UNITS.get(m.group(2).lower(), 1)


def row_bytes(df: DataFrame):
    """Upper bound of a row's bytes in a broadcast relation."""
    fields = df.schema.fields
    # the relation stores the key columns beside the row: at most the row once more
    fixed = 2 * (8 * ((len(fields) + 63) // 64) + 8 * len(fields)) + ROW_OVERHEAD_BYTES
    per_row = F.lit(fixed).cast("long")
    for f in fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            per_row = per_row + 2 * F.coalesce(F.ceil(F.octet_length(F.col(f.name)) / 8) * 8, F.lit(0))
    return per_row


def unsafe_size_bounds(*dfs: DataFrame) -> list[int]:
    """Upper bounds of the bytes each DataFrame takes as UnsafeRows in a
    broadcast relation, measured together in one job."""
    parts = [df.select(F.lit(i).alias("_side"), row_bytes(df).alias("_bytes")) for i, df in enumerate(dfs)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    sums = {r["_side"]: r["b"] for r in union.groupBy("_side").agg(F.sum("_bytes").alias("b")).collect()}
    return [int(sums.get(i) or 0) for i in range(len(dfs))]


def unsafe_size_bound(df: DataFrame) -> int:
    """Upper bound of the bytes ``df`` takes as UnsafeRows in a broadcast relation."""
    return unsafe_size_bounds(df)[0]


def fits_broadcast_all(*dfs: DataFrame, max_bytes: int | None = None) -> list[bool]:
    """:func:`fits_broadcast` for several sides, measured in one job."""
    limit = broadcast_threshold(dfs[0]) if max_bytes is None else max_bytes
    if limit < 0:
        return [False] * len(dfs)
    return [b <= limit for b in unsafe_size_bounds(*dfs)]


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """True when the measured size of ``df`` is at most ``max_bytes``
    (default: the session's broadcast threshold; -1 means never)."""
    limit = broadcast_threshold(df) if max_bytes is None else max_bytes
    return limit >= 0 and unsafe_size_bound(df) <= limit


def size_checked(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``df`` hinted for broadcast when its measured size is at most ``max_bytes``
    (default: the session's broadcast threshold), else hinted for a shuffle join."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df.hint("merge")
