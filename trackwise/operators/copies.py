"""Exact-copy collapsing.

GPS feeds repeat rows. A single repeated row may account for a large share
of a day's data; windows over such rows would put all copies of it into one
task. Collapsing copies into one row with a ``copies`` weight is an
aggregate, so Spark combines copies map-side before the shuffle and every
later stage sees at most one row per distinct value tuple.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collapse_copies(df: DataFrame, columns: list[str], weight: str = "copies",
                    marks: tuple[str, ...] = ()) -> DataFrame:
    """One row per distinct ``columns`` tuple with the number of copies.

    If ``df`` already has a ``weight`` column its values are summed. Of ``marks`` the
    greatest value is kept; a filter on a mark is not pushed below the exchange, so
    branches by a mark share it.
    """
    w = F.sum(weight) if weight in df.columns else F.count(F.lit(1))
    return df.groupBy(*columns).agg(w.cast("long").alias(weight), *[F.max(m).alias(m) for m in marks])


def expand_copies(df: DataFrame, weight: str = "copies", index: str = "copy_no") -> DataFrame:
    """Inverse of :func:`collapse_copies`: one row per copy, numbered 1..copies."""
    return df.withColumn(index, F.explode(F.sequence(F.lit(1).cast("long"), F.col(weight))))
