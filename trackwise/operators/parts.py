"""Long sequences in parts.

A window keyed by a sequence (a trip) puts all of its rows into one task. Cut
into parts, a neighbour may lie in another part: every part gets copies of the
rows just before and after it (its halo), taken from a table with one row a
part, so that stencils of bounded reach are plain windows over (key, part). Parts
without rows don't count: a halo reaches over as many short parts as it needs.

The rows are exchanged once, by (key, part); marking, edges, join and the windows
that follow all use that partitioning. Only the table of parts is exchanged and
ordered by key alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HALO = "_halo"


def with_halo(rows: DataFrame, key: list[str], part: str, order: list[str], before: int, after: int,
              totals: dict[str, Column], keep: Column) -> DataFrame:
    """``rows`` and, marked by HALO, copies of the ``before`` rows ahead of every part
    and the ``after`` rows behind it, under the part's number.

    ``totals`` are sums (of a row's columns) over the whole sequence; only sequences
    whose totals fulfil ``keep`` remain.
    """
    own = [c for c in rows.columns if c not in (*key, part)]
    w = Window.partitionBy(*key, part).orderBy(*[F.asc_nulls_first(c) for c in order])
    marked = rows.select("*", F.row_number().over(w).alias("_nth"),
                         F.lead(F.lit(True), 1).over(w).isNull().alias("_last"),
                         F.lead(F.lit(True), before).over(w).isNull().alias("_tail"))

    def edge(cond: Column) -> Column:          # at most before / after rows
        at_edge = F.collect_list(F.when(cond, F.struct("_nth", F.struct(*own).alias("row"))))
        return F.transform(F.sort_array(at_edge), lambda x: x["row"])

    parts = marked.groupBy(*key, part).agg(
        *[F.sum(x).alias(f"_sum_{n}") for n, x in totals.items()],
        edge(F.col("_nth") <= after).alias("_head"), edge(F.col("_tail")).alias("_tail"))
    along = Window.partitionBy(*key).orderBy(part)
    ahead = F.flatten(F.collect_list("_tail").over(along.rowsBetween(-before, -1)))
    behind = F.flatten(F.collect_list("_head").over(along.rowsBetween(1, after)))
    whole = Window.partitionBy(*key)
    parts = parts.select(*key, part, ahead.alias("_ahead"), behind.alias("_behind"),
                         *[F.sum(f"_sum_{n}").over(whole).alias(n) for n in totals]).where(keep)
    parts = parts.select(*key, part, F.slice("_ahead", F.greatest(F.size("_ahead") - before, F.lit(0)) + 1, before).alias("_ahead"),
                         F.slice("_behind", 1, after).alias("_behind"))

    def copies(cond: Column, edge_rows: str) -> Column:
        return F.when(cond, F.transform(edge_rows, lambda r: F.struct(F.lit(True).alias(HALO), r.alias("row")))).otherwise(F.array())

    itself = F.array(F.struct(F.lit(False).alias(HALO), F.struct(*own).alias("row")))
    out = marked.join(parts.hint("merge"), [*key, part]).select(*key, part, F.explode(F.concat(
        copies(F.col("_nth") == 1, "_ahead"), itself, copies(F.col("_last"), "_behind"))).alias("x"))
    return out.select(*key, part, *[F.col("x.row")[c].alias(c) for c in own], F.col(f"x.{HALO}").alias(HALO))
