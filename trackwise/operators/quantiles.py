"""Exact quantiles of large groups, without a value map per group.

Spark's ``percentile`` keeps a group's values in one map in one task. Here the
distinct values of a group are counted (combined before the exchange), laid into
buckets by a monotone function of the value, and numbered by running counts: of
the buckets within a group, and of the values within a bucket. The values at the
ranks on both sides of a quantile's position are picked out and interpolated in
the same arithmetic, so the result equals ``percentile`` bit for bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackwise.functions.binning import QUANTILE_PROBS, sql_double

#: monotone, about 100 buckets from 0.001 to 200 on either side of zero
_BUCKET = "cast(signum(value) * floor(ln(1 + abs(value) * 1024) * 8) AS int)"


def exact_quantiles(df: DataFrame, keys: list[str], blocks: dict[str, str],
                    probs: list[float] = QUANTILE_PROBS) -> DataFrame:
    """One row per key with an array of quantiles for every block (name -> SQL
    expression of the value); NULL values don't count, NULL for no value. Keys
    without any value have no row."""
    names = list(blocks)
    values = F.array(*[F.struct(F.lit(i).alias("_block"), F.expr(x).cast("double").alias("value")) for i, x in enumerate(blocks.values())])
    pairs = df.select(*keys, F.explode(values).alias("_x")).select(*keys, "_x.*").where("value IS NOT NULL")
    group = [*keys, "_block"]
    counts = pairs.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("_n")).withColumn("_bucket", F.expr(_BUCKET))
    in_group = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = counts.groupBy(*group, "_bucket").agg(F.sum("_n").alias("_n")).select(
        *group, "_bucket", F.coalesce(F.sum("_n").over(in_group), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*group)).alias("_total"))
    in_bucket = Window.partitionBy(*group, "_bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counts.withColumn("_upto", F.sum("_n").over(in_bucket)).join(buckets.hint("merge"), [*group, "_bucket"]).withColumn(
        "_upto", F.col("_before") + F.col("_upto"))

    def at(i: int, side: str) -> str:
        rank = f"{side}((_total - 1) * {sql_double(probs[i])}) + 1"
        return f"max(CASE WHEN _upto - _n < {rank} AND {rank} <= _upto THEN value END)"

    picked = placed.groupBy(*group).agg(
        F.max("_total").alias("_total"),
        *[F.expr(f"{at(i, side)} AS _{side}_{i}") for i in range(len(probs)) for side in ("floor", "ceil")])

    def between(i: int) -> str:
        pos = f"((_total - 1) * {sql_double(probs[i])})"
        return (f"CASE WHEN _floor_{i} = _ceil_{i} THEN _floor_{i} ELSE "
                f"(ceil({pos}) - {pos}) * _floor_{i} + ({pos} - floor({pos})) * _ceil_{i} END")

    lists = picked.select(*group, F.expr(f"array({', '.join(between(i) for i in range(len(probs)))}) AS _q"))
    return lists.groupBy(*keys).agg(*[F.max(F.when(F.col("_block") == i, F.col("_q"))).alias(n) for i, n in enumerate(names)])
