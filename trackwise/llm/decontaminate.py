"""Benchmark decontamination: a prefix-filtered set join of windows.

A window is ``window`` consecutive words of a benchmark item (an item of fewer
words is one window). A document contains a window only if it holds all of the
window's shingles, so one of them, the rarest in all documents, is a sufficient
prefix. Steps:

1. one pass over the texts posts every shingle that occurs in the benchmark,
   with its position and the word ids around it (one row per document, written
   to the shared folder); texts are not shuffled;
2. the shingles are counted over all documents and ordered by rarity;
3. each window is joined with the postings of its rarest shingle; the shingle's
   offset in the window fixes the start, which must leave room for the whole
   window in the document (positional and length bounds);
4. the words there are compared with the window's (exact containment).

The benchmark is a query set: it is handled in blocks of about BLOCK_BYTES of
text, the bound of what is collected and broadcast; every block meets all
documents. Blocks are made of the distinct texts, and a text of more than PIECE_WORDS
words is cut into pieces that share window - 1 words, so that neither repeated rows nor
long items fill one; a block with too many distinct words for a shingle's code is
halved. The items of a text are joined on at the end, in Spark.

Words are maximal runs of 0-9, a-z (A-Z lower-cased) and non-ASCII characters.
Null texts have no words; items without words have no window; items with a null
id mark words but are not listed. Rows are judged one by one, so repeated ids
give repeated results; empty tables give an empty result or no hits; columns
beside key and text are ignored; texts of any length are taken whole, in bounded
slices or alone.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackwise.llm.batches import documents, small_batches, text_slices, through_table
from trackwise.llm.licenses import WORD_BYTES, words_of

WINDOW, SHINGLE = 10, 3
BLOCK_BYTES = 3_000_000
PIECE_WORDS = 50_000
#: bits of a word id within a shingle's code
ID_BITS = 21


def shingle_codes(ids: np.ndarray, size: int) -> np.ndarray:
    """Codes of the shingles of ``size`` ids at each position (0: holds a foreign word).
    Ids begin at 1, so codes of different sizes differ."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.empty(0, np.int64)
    code, whole = np.zeros(n, np.int64), np.ones(n, bool)
    for k in range(size):
        part = ids[k:k + n]
        code = (code << ID_BITS) | part
        whole &= part > 0
    return np.where(whole, code, 0)


def _posting_rows(batches, index, window: int, key_type: pa.DataType):
    from pyspark import TaskContext

    vocab, known = index["vocab"], index["codes"]
    row = TaskContext.get().partitionId() << 33
    posting = pa.struct([("shingle", pa.int64()), ("pos", pa.int64()), ("first", pa.int64()),
                         ("around", pa.list_(pa.int32()))])
    for keys, texts in text_slices(batches, "key", "text"):
        counts, posts = [], []
        for b in texts:
            words = b.translate(WORD_BYTES).split()
            counts.append(len(words))
            ids = np.fromiter(map(vocab.get, words, repeat(0)), np.int64, len(words))
            own = []
            if ids.any():
                for size, codes in known.items():
                    code = shingle_codes(ids, size)
                    at = np.searchsorted(codes, code)
                    for p in np.flatnonzero(codes[np.minimum(at, len(codes) - 1)] == code).tolist():
                        first = max(0, p - window + 1)
                        own.append({"shingle": int(code[p]), "pos": p, "first": first,
                                    "around": ids[first:p + window].tolist()})
            posts.append(own)
        rows = range(row, row + len(keys))
        row += len(keys)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(keys, key_type), pa.array(counts, pa.int64()),
             pa.array(posts, pa.list_(posting))], ["row", "key", "n_words", "postings"])


def _pieces(texts: DataFrame, window: int, piece_words: int) -> DataFrame:
    """(item, text) of distinct texts (item, text) in pieces that hold every window."""
    def run(batches):
        for items, rows in text_slices(batches, "item", "text"):
            out = []
            for i, t in zip(items, rows):
                words = t.translate(WORD_BYTES).split()
                starts = range(0, max(1, len(words) - window + 1), piece_words)
                out += [(i, b" ".join(words[a:a + piece_words + window - 1])) for a in starts if words]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.string()),
                                                  pa.array([t for _, t in out], pa.binary()).cast(pa.string())], ["item", "text"])

    return texts.mapInArrow(run, "item string, text string")


def _in_blocks(docs: DataFrame, items: list, window: int, shingle: int) -> list[tuple[DataFrame, DataFrame]]:
    """:func:`_block_matches` of the items, halved while they have too many distinct words."""
    words = {w for _, t in items for w in words_of(t)}
    if len(words) + 1 >= 1 << ID_BITS and len(items) > 1:
        half = len(items) // 2
        return _in_blocks(docs, items[:half], window, shingle) + _in_blocks(docs, items[half:], window, shingle)
    return [_block_matches(docs, items, window, shingle)]


def _block_matches(docs: DataFrame, items: list, window: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(documents: row, key, n_words; matches: row, start, length, item) for one block of items."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    vocab: dict[bytes, int] = {}
    coded = [(i, ids) for i, t in items if (ids := [vocab.setdefault(w, len(vocab) + 1) for w in words_of(t)])]
    codes: dict[int, set] = {}
    for _, ids in coded:
        size = min(shingle, len(ids))
        codes.setdefault(size, set()).update(shingle_codes(np.array(ids), size).tolist())
    index = spark.sparkContext.broadcast(
        {"vocab": vocab, "codes": {n: np.array(sorted(c), np.int64) for n, c in codes.items()}})
    key_type = to_arrow_type(docs.schema["key"].dataType)
    posted = through_table(docs.mapInArrow(
        lambda it: _posting_rows(it, index.value, window, key_type),
        f"row long, key {docs.schema['key'].dataType.simpleString()}, n_words long, "
        "postings array<struct<shingle:long,pos:long,first:long,around:array<int>>>"), "postings")
    postings = posted.select("row", "n_words", F.explode("postings").alias("p")).select("row", "n_words", "p.*")
    count = postings.groupBy("shingle").agg(F.count("*").alias("n"))

    blocks = spark.createDataFrame(coded, "item string, ids array<int>")
    windows = blocks.select("item", F.explode(F.expr(
        f"transform(sequence(1, greatest(size(ids) - {window - 1}, 1)), i -> slice(ids, i, {window}))")).alias("words"))
    shift = 1 << ID_BITS
    code = "aggregate({}, 0L, (a, x) -> a * " + str(shift) + "L + x)"
    shingles = windows.select("words").distinct().select("words", F.posexplode(F.expr(
        f"transform(sequence(1, greatest(size(words) - {shingle - 1}, 1)), "
        f"i -> {code.format(f'slice(words, i, {shingle})')})")).alias("offset", "shingle"))
    # a window with a shingle that occurs nowhere cannot occur
    prefix = (shingles.join(count, "shingle", "left").groupBy("words")
              .agg(F.min_by(F.struct("shingle", "offset"), F.struct(F.coalesce("n", F.lit(0)), "offset")).alias("rare"),
                   F.min(F.coalesce("n", F.lit(0))).alias("least"))
              .where("least > 0").select("words", "rare.*"))
    start = F.col("pos") - F.col("offset")
    size = F.size("words")
    matches = (postings.join(prefix, "shingle")
               .where((start >= 0) & (start + size <= F.col("n_words")))
               .where(F.expr("slice(around, cast(pos - offset - first + 1 as int), size(words))") == F.col("words"))
               .select("row", start.alias("start"), size.alias("length"), "words")
               .join(windows.distinct(), "words").select("row", "start", "length", "item"))
    return posted.select("row", "key", "n_words"), matches


def find_contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                       item: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
                       block_bytes: int = BLOCK_BYTES, piece_words: int = PIECE_WORDS) -> DataFrame:
    """(key, n_words, windows: array of (start, length) that occur, items: ids of their items) of every row."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    bench = benchmark.select(F.col(item).cast("string").alias("id"), F.sha2(F.coalesce(F.col(item_text), F.lit("")), 256).alias("item"),
                             F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    texts = bench.select("item", "text").dropDuplicates(["item"])
    pieces = through_table(_pieces(texts, window, piece_words), "pieces")
    size = pieces.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    heads = matches = None
    for b in range(blocks):
        part = pieces.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()
        for head, found in _in_blocks(rows, part, window, shingle):
            heads = heads or head
            matches = found if matches is None else matches.unionByName(found)
    windows = matches.groupBy("row").agg(F.collect_set(F.struct("start", "length")).alias("windows"))
    ids = (matches.select("row", "item").distinct().join(bench.where("id IS NOT NULL").select("item", "id").distinct(), "item")
           .groupBy("row").agg(F.collect_set("id").alias("items")))
    return heads.join(windows, "row", "left").join(ids, "row", "left").select(
        F.col("key").alias(key), "n_words", F.coalesce("windows", F.expr("array()")).alias("windows"),
        F.array_sort(F.coalesce("items", F.expr("array()"))).alias("items"))


#: words inside any window
N_HIT = "cast(size(array_distinct(flatten(transform(windows, w -> sequence(w.start, w.start + w.length - 1))))) as long)"


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", F.expr(N_HIT).alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("windows") > 0).alias("contaminated"))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
OP3_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, list_slice(w, i, i + {WINDOW - 1}) AS gram
      FROM b, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) t(i) WHERE len(w) > 0),
x AS (SELECT r, i, n, list_slice(w, i, i + n - 1) AS gram
      FROM d, (SELECT DISTINCT len(gram) AS n FROM g) z, unnest(range(1, len(w) - n + 2)) t(i)),
h AS (SELECT r, i, n, item_id FROM x JOIN g USING (gram)),
c AS (SELECT r, count(DISTINCT p) AS n_hit FROM h, unnest(range(i, i + n)) t(p) GROUP BY r),
m AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
      FROM (SELECT DISTINCT r, item_id::VARCHAR AS i FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN m USING (r)
"""
