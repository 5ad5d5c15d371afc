"""SimHash near-duplicates: a binary trie self-join.

A text's fingerprint has bit i set if bit i is set in over half of the XXH64
values of its word shingles. The distinct fingerprints form a binary trie.
Pairs of its nodes are traversed together from the root: a pair of nodes at one
depth goes on to the pairs of their descendants some levels below, the
differing bits add up, and a pair is dropped when they exceed the budget, when
the other node does not exist, or when both are the same node with a single
fingerprint. What arrives at the leaves are the links.

Of two fingerprints with at most k differing bits one half of the bits differs
in at most k // 2. So the trie is traversed twice, over the fingerprints and
over those with their halves exchanged, with the budget k // 2 for the first
half and k in all: about as many node pairs as fingerprints times the length of
a half survive, not a square. In the first half a round goes STRIDE levels down and
looks a node's partners up by masks (two equi-joins on node prefixes; the budget
there is small, the masks few). In the second half, where the budget is k but nodes
have few descendants, a round goes DEEP_STRIDE levels down and compares the lists of
descendants of both nodes, at most 2 ** DEEP_STRIDE each, so only pairs that survive
become rows. Equal fingerprints are one leaf, so copies are never paired. With known
components of the leaves only pairs between different components are made.

Words are runs of other characters than space and U+0009 to U+000D, A-Z
lower-cased. A text of fewer words than a shingle is one shingle of all of
them; a null text or one without words has the fingerprint zero. Keys are
integers; rows with a null key have a fingerprint, but no component and link
nothing. Repeated rows share their component; an empty table gives no row;
columns beside key and text are ignored; texts of any length are taken whole, in
bounded slices or alone.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from trackwise.llm.batches import documents, small_batches, text_slices, through_table
from trackwise.llm.components import connected_components

SHINGLE, MAX_BITS, SEED = 3, 3, 42
#: levels of a round in the first and the second half
STRIDE, DEEP_STRIDE = 16, 8

#: a byte's bits, each in a byte of its own
LANES = (((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.uint8).copy().view("<u8")).ravel()


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[:n - 1])).tolist()
    stops = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(whole[a:b], SEED) for a, b in zip(starts, stops)), "<u8", n)
    lanes = LANES[hashes.view(np.uint8).reshape(n, 8)]
    counts = np.add.reduceat(lanes, np.arange(0, n, 255), axis=0).view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp) of every row; fp is the fingerprint as a signed long."""
    kind = docs.schema[key].dataType
    arrow = to_arrow_type(kind)

    def run(batches):
        for keys, texts in text_slices(batches, "key", "text"):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, arrow), pa.array([fingerprint(t, shingle) for t in texts], pa.int64())], ["key", "fp"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind.simpleString()}, fp long")


def _masks(bits: int, most: int) -> list[tuple[int, int]]:
    """(mask, its bits) of all masks of at most ``most`` set bits."""
    return [(sum(1 << i for i in c), k) for k in range(most + 1) for c in combinations(range(bits), k)]


def trie_links(leaves: DataFrame, max_bits: int = MAX_BITS, stride: int = STRIDE) -> DataFrame:
    """(a, b): ids of leaves (fp, id; fp distinct) that differ in at most ``max_bits`` bits:
    all such pairs, or with a column ``component`` all those of different components."""
    turned = F.expr("(fp << 32) | shiftrightunsigned(fp, 32)")
    component = "component" if "component" in leaves.columns else "id"
    tries = leaves.select(F.explode(F.array(
        F.struct(F.lit(0).alias("trie"), F.col("fp").alias("x")),
        F.struct(F.lit(1).alias("trie"), turned.alias("x")))).alias("t"), "id", F.col(component).alias("c")).select("t.*", "id", "c")

    def nodes(depth: int) -> DataFrame:
        """The trie's nodes at a depth with the least and the greatest component under them."""
        return (tries.withColumn("node", F.shiftrightunsigned("x", 64 - depth)).groupBy("trie", "node")
                .agg(F.min("id").alias("id"), F.min("c").alias("lo"), F.max("c").alias("hi")))

    budget = max_bits // 2
    if budget == 0:         # the first half is equal: one step, one mask
        stride = 32
    pairs = None
    for depth in range(stride, 33, stride):
        pairs = _by_masks(pairs, nodes(depth), budget, stride)
    for depth in range(32 + DEEP_STRIDE, 65, DEEP_STRIDE):
        pairs = _by_lists(pairs, tries, depth, max_bits)
    return pairs.select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct()


def _by_masks(pairs: DataFrame | None, level: DataFrame, budget: int, stride: int) -> DataFrame:
    """Pairs of the nodes of ``level``, ``stride`` below those of ``pairs`` (None: the root with itself)."""
    masks = F.array(*(F.struct(F.lit(m).cast("long").alias("mask"), F.lit(k).alias("bits")) for m, k in _masks(stride, budget)))
    child = level.select("trie", F.shiftrightunsigned("node", stride).alias("a"), F.col("node").alias("a2"),
                         F.col("id").alias("a_id"), F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi"))
    if pairs is None:
        probes = child.withColumns({"b": F.col("a"), "diff": F.lit(0)})
    else:
        probes = pairs.select("trie", "a", "b", "diff").join(child, ["trie", "a"])
    # both orders of a pair would be found; the node of the lower number leads
    low = (1 << stride) - 1
    partner = lambda m: F.expr(f"(b << {stride}) | (a2 & {low}L)").bitwiseXOR(m["mask"])
    probes = probes.withColumn("m", F.explode(F.filter(masks, lambda m: (m["bits"] + F.col("diff") <= budget) & (
        (F.col("a2") < partner(m)) | ((F.col("a2") == partner(m)) & (F.col("a_lo") < F.col("a_hi")))))))
    probes = probes.select("trie", "a2", "a_id", "a_lo", "a_hi", (F.col("diff") + F.col("m.bits")).cast("int").alias("diff"),
                           partner(F.col("m")).alias("b2"))
    other = level.select("trie", F.col("node").alias("b2"), F.col("id").alias("b_id"), F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi"))
    return probes.join(other, ["trie", "b2"]).where("least(a_lo, b_lo) < greatest(a_hi, b_hi)").select(
        "trie", F.col("a2").alias("a"), F.col("b2").alias("b"), "diff", "a_id", "b_id")


def _by_lists(pairs: DataFrame, tries: DataFrame, depth: int, budget: int) -> DataFrame:
    """Pairs of the nodes at ``depth``, DEEP_STRIDE below those of ``pairs``, by comparing lists of descendants."""
    low = (1 << DEEP_STRIDE) - 1
    up = F.shiftrightunsigned("x", 64 - depth + DEEP_STRIDE)
    s = F.shiftrightunsigned("x", 64 - depth).bitwiseAND(F.lit(low).cast("long")).cast("int")
    # one exchange: both aggregates and both joins take the lists by their node
    below = (tries.select("trie", up.alias("up"), s.alias("s"), "id", "c").repartition("trie", "up").groupBy("trie", "up", "s")
             .agg(F.min("id").alias("id"), F.min("c").alias("lo"), F.max("c").alias("hi"))
             .groupBy("trie", "up").agg(F.collect_list(F.struct("s", "id", "lo", "hi")).alias("list")))
    ours, theirs = below.withColumnsRenamed({"up": "a", "list": "xs"}), below.withColumnsRenamed({"up": "b", "list": "ys"})
    survive = f"diff + bit_count(x.s ^ y.s) <= {budget} AND least(x.lo, y.lo) < greatest(x.hi, y.hi) AND (a <> b OR x.s <= y.s)"
    met = F.expr(f"flatten(transform(xs, x -> transform(filter(ys, y -> {survive}), y -> named_struct("
                 f"'a', (a << {DEEP_STRIDE}) | x.s, 'b', (b << {DEEP_STRIDE}) | y.s, 'diff', diff + bit_count(x.s ^ y.s), "
                 "'a_id', x.id, 'b_id', y.id))))")
    return pairs.select("trie", "a", "b", "diff").join(ours, ["trie", "a"]).join(theirs, ["trie", "b"]).select(
        "trie", F.explode(met).alias("m")).select("trie", "m.*")


def fingerprint_groups(leaves: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, group) of distinct fingerprints (fp): the smallest fingerprint that each reaches by links."""
    links = trie_links(leaves.select("fp", F.col("fp").alias("id")), max_bits)
    found = connected_components(links, "a", "b").select(F.col("node").alias("fp"), "component")
    return leaves.select("fp").join(found, "fp", "left").select("fp", F.coalesce("component", "fp").alias("group"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(key, fingerprint, component_id) of every row; component_id is the smallest key reachable by links."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    prints = through_table(fingerprints(rows, "key", "text", shingle), "fingerprints")
    leaves = through_table(prints.where("key is not null").groupBy("fp").agg(F.min("key").alias("id")), "leaves")
    groups = leaves.join(fingerprint_groups(leaves.select("fp"), max_bits), "fp")
    first = groups.groupBy("group").agg(F.min("id").alias("component_id"))
    named = groups.join(first, "group").select("fp", "component_id")
    return prints.join(named, "fp", "left").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("key").isNotNull(), F.col("component_id")).alias("component_id"))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
