"""Embedding near-duplicates: a cover-tree dual traversal.

Vectors are compared when their labels are equal; they are linked when their
cosine (in double precision) reaches the threshold t. On the unit sphere this
is a distance of at most d = sqrt(2 - 2t), so bounds by the triangle inequality
are exact: two nodes whose centres are further apart than the sum of their
covering radii plus d hold no link.

Top of the tree: centres from a bounded sample (PIVOT_SAMPLE rows; labels that
are not in it have one node). Every vector goes to its nearest centre; the
covering radii are the maxima over all vectors. A node of more than BLOCK
vectors is dealt into blocks, so no task holds an unbounded node. Pairs of
nodes that the bound leaves are expanded to pairs of their blocks, and each
pair of blocks is a task of at most about 2 * BLOCK vectors.

Below, each task covers its blocks with nested levels of halving radii (1, 1/2,
... down to less than d) and traverses the two trees together: pairs of nodes
are dropped by the same bound, the rest descends to the children, and pairs of
leaves are compared. A task returns each vector's number of links and a
spanning forest of the links, never the links themselves; connected components
of the forests give the groups.

Equal vectors of a label are one vector with a weight, so copies, however many,
are never compared with each other; their links are counted by weight.

Only centres and block counts are broadcast or planned with; where the data
has no structure (all distances alike) no bound prunes and the work is the
square of a label's size, in blocks.

A vector that is null, zero, empty or holds null or non-finite components, or
whose label or id is null, links with nothing. Vectors of different lengths are
not compared. Rows that repeat an id are one vector (the least of them). An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackwise.llm.batches import through_table
from trackwise.llm.components import connected_components, find, union

COSINE = 0.98
PIVOT_SAMPLE = 4096
BLOCK = 2000
#: slack of the bounds, far above the rounding of a distance
SLACK = 1e-6


def unit_rows(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    return x / np.sqrt((x * x).sum(1))[:, None]


#: centres that a level of a cover takes at a time
BATCH = 64


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of all unit rows of x from all of y."""
    return np.sqrt(np.maximum(0.0, 2 - 2 * (x @ y.T)))


class Cover:
    """Nested levels over unit vectors. A node has a centre (a row), the covering
    radius of its member rows, and children of half the level's radius."""

    def __init__(self, x: np.ndarray, least: float):
        self.x, self.least = x, least
        self.root = self._node(np.arange(len(x)), 0, 1.0)

    def _node(self, rows: np.ndarray, centre: int, radius: float) -> dict:
        if len(rows) == 1:
            return {"centre": centre, "radius": 0.0, "rows": rows, "children": []}
        covering = float(distances(self.x[rows], self.x[[centre]]).max())
        node = {"centre": centre, "radius": covering, "rows": rows, "children": []}
        while radius >= covering and radius > self.least:
            radius /= 2              # a level that one centre covers has one node
        if covering > self.least:
            node["children"] = [self._node(own, c, radius / 2) for c, own in self._level(rows, radius)]
        return node

    def _level(self, rows: np.ndarray, radius: float):
        """(centre, rows it covers): the first row that no centre covers is the next centre."""
        left = rows
        while len(left):
            first = left[:BATCH]
            near = distances(self.x[first], self.x[first]) <= radius
            chosen: list[int] = []
            for i in range(len(first)):
                if not near[i, chosen].any():
                    chosen.append(i)
            covered = distances(self.x[left], self.x[first[chosen]]) <= radius
            covered[chosen, range(len(chosen))] = True
            owner = np.where(covered.any(1), covered.argmax(1), len(chosen))
            order = np.argsort(owner, kind="stable")
            cuts = np.searchsorted(owner[order], np.arange(len(chosen) + 1))
            for k, c in enumerate(first[chosen].tolist()):
                yield c, left[order[cuts[k]:cuts[k + 1]]]
            left = left[order[cuts[-1]:]]


def leaf_pairs(a: Cover, b: Cover, reach: float):
    """Pairs of leaves that may hold a link; with a is b each unordered pair once."""
    stack = [(a.root, b.root)]
    while stack:
        p, q = stack.pop()
        if not p["children"] and not q["children"]:
            yield p, q
            continue
        ps, qs = p["children"] or [p], q["children"] or [q]
        gap = distances(a.x[[c["centre"] for c in ps]], b.x[[c["centre"] for c in qs]])
        limit = np.array([c["radius"] for c in ps])[:, None] + np.array([c["radius"] for c in qs]) + reach
        for i, j in zip(*(x.tolist() for x in np.nonzero(gap <= limit))):
            if p is not q or i <= j:
                stack.append((ps[i], qs[j]))


def compare_blocks(ids_a, x_a, w_a, ids_b, x_b, w_b, threshold: float):
    """(links per id, counted by weight; forest edges) between two blocks; one block with itself if ids_b is None."""
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    a = Cover(x_a, reach)
    b = a if ids_b is None else Cover(x_b, reach)
    ids_b, x_b, w_b = (ids_a, x_a, w_a) if ids_b is None else (ids_b, x_b, w_b)
    count_a, count_b = np.zeros(len(x_a), np.int64), np.zeros(len(x_b), np.int64)
    parent: dict = {}
    for p, q in leaf_pairs(a, b, reach):
        hit = x_a[p["rows"]] @ x_b[q["rows"]].T >= threshold
        if p is q:
            np.fill_diagonal(hit, False)
        else:
            count_b[q["rows"]] += w_a[p["rows"]] @ hit
        count_a[p["rows"]] += hit @ w_b[q["rows"]]
        _forest(hit, ids_a[p["rows"]], ids_b[q["rows"]], parent)
    links = [(i, n) for ids, c in ((ids_a, count_a), (ids_b, count_b)) for i, n in zip(ids.tolist(), c.tolist()) if n]
    return links, [(i, r) for i in list(parent) if (r := find(parent, i)) != i]


def _forest(hit: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, parent: dict) -> None:
    """Unite what the links of a bipartite matrix connect, breadth first."""
    left = hit.any(1)
    seen = np.zeros(hit.shape[1], bool)
    while left.any():
        start = int(left.argmax())
        left[start] = False
        rows, root = np.array([start]), ids_a[start].item()
        while len(rows):
            cols = hit[rows].any(0) & ~seen
            seen |= cols
            for i in ids_b[cols].tolist():
                union(parent, root, i)
            rows = np.flatnonzero(hit[:, cols].any(1) & left)
            left[rows] = False
            for i in ids_a[rows].tolist():
                union(parent, root, i)


def valid_vectors(vectors: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """(id, label, dim, v) of the vectors that can have links, one row per id."""
    ok = F.expr("""id IS NOT NULL AND label IS NOT NULL AND size(v) > 0
                   AND forall(v, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('inf'))
                   AND exists(v, c -> c != 0)""")
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"))
    one = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.*")
    return one.withColumn("dim", F.size("v")).where(F.coalesce(ok, F.lit(False)))


def pivots(valid: DataFrame, sample: int, block: int) -> dict:
    """(label, dim) -> centres, from the ``sample`` vectors of least hash: one for
    each ``block`` vectors of the label, chosen with halving distances."""
    rows = valid.orderBy(F.xxhash64("id")).limit(sample).collect()
    found: dict = {}
    for r in rows:
        found.setdefault((r["label"], r["dim"]), []).append(r["v"])
    total = valid.count()
    centres = {}
    for k, vs in found.items():
        x = unit_rows(vs)
        want = min(len(x), max(1, math.ceil(len(x) / max(1, len(rows)) * total / block)), 256)
        chosen, gap = [0], np.sqrt(np.maximum(0, 2 - 2 * x @ x[0]))
        while len(chosen) < want and gap.max() > 0:
            c = int(gap.argmax())
            chosen.append(c)
            gap = np.minimum(gap, np.sqrt(np.maximum(0, 2 - 2 * x @ x[c])))
        centres[k] = x[chosen]
    return centres


def near_duplicates(vectors: DataFrame, key: str = "vec_id", label: str = "label", vector: str = "embedding",
                    threshold: float = COSINE, sample: int = PIVOT_SAMPLE, block: int = BLOCK) -> DataFrame:
    """(key, n_links, component_id, kept) of every vector."""
    spark = vectors.sparkSession
    every = through_table(valid_vectors(vectors, key, label, vector), "vectors")
    valid = through_table(every.groupBy("label", "dim", "v").agg(F.min("id").alias("id"), F.count("*").alias("weight")),
                          "distinct_vectors")
    sent = spark.sparkContext.broadcast(pivots(valid, sample, block))
    fields = {f.name: f.dataType.simpleString() for f in valid.schema}

    def assign(frames):
        for pdf in frames:
            cell, far = np.zeros(len(pdf), np.int64), np.zeros(len(pdf))
            for k, at in pdf.groupby(["label", "dim"]).indices.items():
                c = sent.value.get((k[0].item() if hasattr(k[0], "item") else k[0], int(k[1])))
                if c is None:
                    far[at] = 2.0                    # no centre: the whole sphere
                    continue
                d = 2 - 2 * unit_rows(pdf["v"].iloc[at]) @ c.T
                cell[at] = d.argmin(1)
                far[at] = np.sqrt(np.maximum(0, d.min(1)))
            yield pdf.assign(cell=cell, far=far)

    placed = through_table(valid.mapInPandas(
        assign, f"label {fields['label']}, dim int, v {fields['v']}, id long, weight long, cell long, far double"), "placed")
    cells = placed.groupBy("label", "dim", "cell").agg(F.count("*").alias("n"), F.max("far").alias("radius"))
    cells = cells.withColumn("blocks", F.ceil(F.col("n") / block)).drop("n")
    centre_rows = [(k[0], k[1], i, c.tolist()) for k, cs in sent.value.items() for i, c in enumerate(cs)]
    centres = spark.createDataFrame(centre_rows, f"label {fields['label']}, dim int, cell long, centre array<double>")
    cells = cells.join(centres, ["label", "dim", "cell"], "left")
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    gap = F.sqrt(F.aggregate(F.zip_with("centre", "centre_b", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, x: s + x))
    right = cells.select("label", "dim", *(F.col(c).alias(f"{c}_b") for c in ("cell", "radius", "blocks", "centre")))
    pairs = cells.join(right, ["label", "dim"]).where("cell <= cell_b").where(
        (F.col("cell") == F.col("cell_b")) | (gap <= F.col("radius") + F.col("radius_b") + reach))
    tasks = (pairs.withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
             .withColumn("block_b", F.explode(F.expr("sequence(0L, blocks_b - 1)")))
             .where("cell < cell_b OR block <= block_b")
             .select("label", "dim", "cell", "block", "cell_b", "block_b"))
    task = F.struct("label", "dim", "cell", "block", "cell_b", "block_b")
    sides = tasks.select(task.alias("task"), F.explode(F.expr(
        "array_distinct(array(struct(label, dim, cell, block), struct(label, dim, cell_b AS cell, block_b AS block)))"
    )).alias("s")).select("task", "s.*")
    members = placed.join(cells.select("label", "dim", "cell", "blocks"), ["label", "dim", "cell"]).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks"))).drop("blocks", "far")
    work = members.join(sides, ["label", "dim", "cell", "block"]).select("task", "cell", "block", "id", "v", "weight")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        own = list(pdf.groupby(["cell", "block"]).indices.values())
        ids, weight = pdf["id"].to_numpy(), pdf["weight"].to_numpy()
        x = unit_rows(pdf["v"])
        t = pdf["task"].iloc[0]
        single = (t["cell"], t["block"]) == (t["cell_b"], t["block_b"])
        if single:
            links, edges = compare_blocks(ids, x, weight, None, None, None, threshold)
        elif len(own) < 2:
            links, edges = [], []
        else:
            p, q = own
            links, edges = compare_blocks(ids[p], x[p], weight[p], ids[q], x[q], weight[q], threshold)
        return pd.DataFrame([(i, n, None) for i, n in links] + [(a, 0, b) for a, b in edges],
                            columns=["id", "n", "other"]).astype({"id": "int64", "n": "int64", "other": "Int64"})

    found = through_table(work.groupBy("task").applyInPandas(compare, "id long, n long, other long"), "links")
    counts = found.where("other IS NULL").groupBy("id").agg(F.sum("n").alias("n"))
    component = connected_components(found.where("other IS NOT NULL"), "id", "other")
    judged = (valid.join(counts, "id", "left").join(component.withColumnRenamed("node", "id"), "id", "left")
              .select("label", "dim", "v", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                      F.coalesce("component", "id").alias("component")))
    linked = every.join(judged, ["label", "dim", "v"]).select("id", "n_links", "component")
    ids = vectors.select(F.col(key).cast("long").alias("id"))
    ids = ids.where("id IS NOT NULL").distinct().unionByName(ids.where("id IS NULL"))
    return (ids.join(linked, "id", "left")
            .select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False))))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: links by self-join, components by walking the links
OP10_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
r(id, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id),
c AS (SELECT id, min(root) AS component_id FROM r GROUP BY id),
n AS (SELECT a AS id, count(*) AS n_links FROM l GROUP BY a)
SELECT id AS vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, id = component_id AS kept
FROM c LEFT JOIN n USING (id)
"""
