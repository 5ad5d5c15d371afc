"""Connected components of a link table, by alternating stars.

First the links of every partition are reduced to a spanning forest (union-find
inside a task over its own rows). Then each round joins every node to the
smallest of its neighbourhood (large star, small star), until every node has one
link, to a node that has none. Every round's table is written to the shared folder; links and labels are never
collected.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackwise.llm.batches import drop_path, write_table


def union(parent: dict, a, b) -> None:
    """Join the sets of a and b; the smaller root stays."""
    ra, rb = find(parent, a), find(parent, b)
    if ra != rb:
        parent[max(ra, rb)] = min(ra, rb)


def find(parent: dict, a):
    root = a
    while (up := parent.get(root, root)) != root:
        root = up
    while (up := parent.get(a, a)) != root:
        parent[a] = root
        a = up
    return root


def _forest(batches):
    parent: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            union(parent, a, b)
    nodes = list(parent)
    for i in range(0, len(nodes), 100_000):
        part = nodes[i:i + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int64()), pa.array([find(parent, x) for x in part], pa.int64())], ["u", "v"])


EDGE = "u long, v long"


def _stars(edges: DataFrame) -> DataFrame:
    """Large star (neighbours above a node go to the least of its neighbourhood),
    then small star (neighbours below it do)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    down = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(down, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
    return small.select("e.u", F.col("e.m").alias("v")).where("u > v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has at most one link up, and none if it has links down."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up = 1 AND down = 1").isEmpty()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node with a link: the smallest id it reaches."""
    spark = links.sparkSession
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v")
    # a table, so that the plan of the links is run once and not part of every round
    path = write_table(edges.mapInArrow(_forest, EDGE).where("u > v").distinct(), "components")
    while True:
        edges = spark.read.schema(EDGE).parquet(path)
        if _are_stars(edges):
            break
        last = path
        path = write_table(_stars(edges), "components")
        drop_path(spark, last)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
