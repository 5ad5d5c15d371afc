"""Ranked lexical search: NRA over impact-sorted lists.

Every query is a set of terms; a document's score is the sum of its terms'
impacts, weight * ((1000000000 * tf) div (1000 * tf + 20 * m)), where the weight
depends on the number of documents with the term and m on the document's length
against the mean. The TOP documents of highest score of each query are found,
exactly, ties by the smaller key.

Two passes. The first cuts all documents into terms and writes those that occur
in a query, with their counts and the document's length (texts are not shuffled);
from that table come the corpus counts. The second deals the table out as it
lies, and every task sorts the postings of a bounded slice of documents into one list a term,
highest impact first, and answers all queries by NRA (no random access): in
rounds, each list is read on down to a falling impact T. What a document has
shown so far is its lower bound; its upper bound adds, for every list not yet
read to its end in which it was not seen, the most that list can still hold (T,
or its first impact). With the TOP best lower bounds as the limit, a document whose upper
bound is below it is out, and unseen documents are once the open lists together
are. Reading goes on, for the documents still in, until lower and upper bound
are equal for all of them: then membership, ties and scores are settled. The best
of a task's earlier slices carry their limit on. The tasks' best are merged in
two levels, so no task receives more than a fraction of them.

Queries with the same terms are answered once. Queries are a query set and are
handled in blocks of about BLOCK_BYTES of distinct terms; every block meets all
documents, and only a block's terms, weights and results are ever held by the
driver or a task.

Terms are maximal strings of 0-9, a-z (A-Z lower-cased) and non-ASCII characters.
A null or empty text has none: such a document is in no result and not counted,
such a query has no result. Documents with equal keys are documents of their own;
a null key comes after all others in a tie. Repeated queries each get their
rows. Empty tables give no row; other columns are ignored; texts of any length
are taken whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackwise.llm.batches import documents, drop_path, small_batches, text_slices, write_table

TOP = 50
#: bytes of distinct query terms that are handled at once
BLOCK_BYTES = 8_000_000
#: postings and documents of a slice
SLICE_POSTINGS, SLICE_DOCUMENTS = 2_000_000, 20_000
#: T falls by this factor from round to round
FALL = 0.7
#: first level of the merge: parts of a query's candidates
PARTS = 64

#: bytes of terms as they are, A-Z lower-cased, all others blank
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

_POSTINGS = "key long, n long, terms array<int>, tfs array<int>"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def query_terms(queries: DataFrame, item: str, text: str) -> DataFrame:
    """(item, query, terms): the distinct terms of every row, sorted, and their hash."""
    kind = queries.schema[item].dataType

    def run(batches):
        for keys, texts in text_slices(batches, "item", "text"):
            sets = [sorted(set(terms_of(t))) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(keys, _arrow(kind)), pa.array(sets, pa.list_(pa.binary()))], ["item", "terms"])

    rows = queries.select(F.col(item).alias("item"), F.col(text).alias("text"))
    sets = rows.mapInArrow(run, f"item {kind.simpleString()}, terms array<binary>").where(F.size("terms") > 0)
    return sets.select("item", F.sha2(F.array_join(F.transform("terms", F.hex), " "), 256).alias("query"), "terms")


def _arrow(kind):
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def postings(docs: DataFrame, key: str, text: str, number) -> DataFrame:
    """(key, n, terms, tfs) of every document with a term: its length, and the numbers
    and counts of its terms that the broadcast ``number`` knows."""
    def run(batches):
        known = number.value.get
        for keys, texts in text_slices(batches, "key", "text"):
            rows = []
            for k, t in zip(keys, texts):
                words = terms_of(t)
                if words:
                    tf = Counter(map(known, words))
                    tf.pop(None, None)
                    rows.append((k, len(words), list(tf), list(tf.values())))
            if rows:
                k, n, terms, tfs = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                                                  pa.array(tfs, pa.list_(pa.int32()))], ["key", "n", "terms", "tfs"])

    small_batches(docs.sparkSession)
    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(run, _POSTINGS)


class Lists:
    """Impact-sorted lists of a slice: for a term the documents (numbers in the slice)
    and tf parts of the impact, the highest first."""

    def __init__(self, keys: list, n: list[int], doc: np.ndarray, term: np.ndarray, tf: np.ndarray, total: int, words: int):
        self.keys = keys
        m = np.array([50 + 50 * x * total // words for x in n], np.int64)
        part = (1_000_000_000 * tf) // (1000 * tf + 20 * m[doc])
        order = np.lexsort((-part, term))
        self.doc, self.part = doc[order], part[order]
        terms, begins = np.unique(term[order], return_index=True)
        self.place = dict(zip(terms.tolist(), zip(begins.tolist(), [*begins[1:].tolist(), len(order)])))

    def read(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.place.get(term, (0, 0))
        return self.doc[a:b], self.part[a:b]


def nra(lists: Lists, query: list[tuple[int, int]], limit: int, best: list[int], top: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of a slice that can be among the ``top``: all with a score of at
    least the limit reached, each score final. ``query`` is (term, weight); ``best`` are
    the scores found before, ``limit`` the least score that still counts."""
    size = len(lists.keys)
    lower, seen = np.zeros(size, np.int64), np.zeros(size, np.int64)   # seen: in so many of the open lists
    reads = []                                                         # [documents, impacts, read so far]
    for term, weight in query:
        docs, part = lists.read(term)
        if weight > 0 and len(docs):
            reads.append([docs, part * weight, 0])
    before = np.array(best, np.int64)
    live = None                                                        # None: unseen documents can still come in
    t = max((int(r[1][0]) for r in reads), default=0)
    while reads:
        t = int(t * FALL)
        still = []
        for r in reads:
            docs, impacts, at = r
            to = len(impacts) - int(np.searchsorted(impacts[::-1], t, side="left")) if t else len(impacts)
            if to > at:
                d, x = docs[at:to], impacts[at:to]
                if live is not None:
                    d, x = d[live[d]], x[live[d]]
                lower[d] += x
                seen[d] += 1
                r[2] = to
            if r[2] < len(impacts):
                still.append(r)
            else:
                seen[docs if live is None else docs[live[docs]]] -= 1
        reads = still
        # a list read down to t holds t at most, an unread one its first impact
        rest = sum(min(t, int(r[1][0])) for r in reads)
        shown = np.concatenate((before, lower[lower > 0]))
        if len(shown) >= top:
            limit = max(limit, int(np.partition(shown, len(shown) - top)[len(shown) - top]))
        if live is not None or rest < limit:
            upper = lower + rest - t * seen
            live = upper >= limit if live is None else live & (upper >= limit)
            if not (live & (upper > lower)).any():
                break
    found = np.flatnonzero(lower >= limit if live is None else live & (lower >= limit))
    return found, lower[found]


def _better(row: tuple) -> tuple:
    score, key = row
    return (-score, key is None, key or 0)


def search_slices(slices: Iterator[Lists], queries: list[list[tuple[int, int]]], top: int = TOP) -> list[list[tuple[int, int]]]:
    """For every query the best (score, key) over all slices, at most ``top``."""
    best: list[list[tuple]] = [[] for _ in queries]
    for lists in slices:
        for at, query in enumerate(queries):
            limit = best[at][-1][0] if len(best[at]) == top else 1
            docs, scores = nra(lists, query, limit, [s for s, _ in best[at]], top)
            if len(docs):
                rows = best[at] + [(s, lists.keys[d]) for d, s in zip(docs.tolist(), scores.tolist())]
                best[at] = sorted(rows, key=_better)[:top]
    return best


def _slices(batches, total: int, words: int) -> Iterator[Lists]:
    keys, lengths, parts, held = [], [], [], 0
    for batch in batches:
        ids, ns = batch.column("key").to_pylist(), batch.column("n").to_pylist()
        terms, tfs = batch.column("terms"), batch.column("tfs")
        sizes = np.diff(terms.offsets.to_numpy())
        flat, tf = terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(ids):
            # as many documents as the slice still takes, one at least
            room = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_POSTINGS - held, side="right"))
            to = min(max(room, at + 1 if not keys else at), at + SLICE_DOCUMENTS - len(keys), len(ids))
            a, b = int(ends[at - 1]) if at else 0, int(ends[to - 1]) if to else 0
            if to > at:
                parts.append((np.repeat(np.arange(len(keys), len(keys) + to - at), sizes[at:to]), flat[a:b], tf[a:b]))
                keys += ids[at:to]
                lengths += ns[at:to]
                held += b - a
                at = to
            if at < len(ids):
                yield Lists(keys, lengths, *map(np.concatenate, zip(*parts)), total, words)
                keys, lengths, parts, held = [], [], [], 0
    if keys:
        yield Lists(keys, lengths, *map(np.concatenate, zip(*parts)), total, words)


def _search_block(docs: DataFrame, key: str, text: str, block: list, top: int) -> DataFrame:
    """(query, key, score) of a block of (query, terms), written; at most ``top`` rows a query."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    names = sorted({t for _, terms in block for t in terms})
    number = sc.broadcast({t: i for i, t in enumerate(names)})
    path = write_table(postings(docs, key, text, number), "postings")
    table = spark.read.schema(_POSTINGS).parquet(path)
    total, words = table.agg(F.count(F.lit(1)), F.sum("n")).first()
    held = dict(table.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1))) for t, df in held.items()}
    own = number.value
    wanted = sc.broadcast([[(own[t], weight[own[t]]) for t in terms if own[t] in weight] for _, terms in block])

    def run(batches):
        for at, rows in enumerate(search_slices(_slices(batches, total, words), wanted.value, top)):
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([at] * len(rows), pa.int32()), pa.array([k for _, k in rows], pa.int64()),
                                                  pa.array([s for s, _ in rows], pa.int64())], ["at", "key", "score"])

    found = table.mapInArrow(run, "at int, key long, score long")
    order = [F.desc("score"), F.asc_nulls_last("key")]
    for by in (["at", "part"], ["at"]):
        found = found.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(PARTS))).withColumn(
            "rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
    ids = spark.createDataFrame([(i, q) for i, (q, _) in enumerate(block)], "at int, query string")
    out = write_table(found.join(F.broadcast(ids), "at").select("query", "rank", "key", "score"), "ranked")
    drop_path(spark, path)
    for b in (number, wanted):
        b.destroy()
    return spark.read.schema("query string, rank int, key long, score long").parquet(out)


def search(docs: DataFrame, queries: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
           query_text: str = "text", top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item, rank, key, score): for each row of ``queries`` the best documents, rank from 1."""
    spark = docs.sparkSession
    small_batches(spark)
    path = write_table(query_terms(queries, item, query_text), "query_terms")
    items = spark.read.parquet(path)
    distinct = items.dropDuplicates(["query"])
    total = distinct.agg(F.sum(F.expr("aggregate(terms, 0L, (s, t) -> s + 50 + length(t))"))).first()[0]
    n_blocks = -(-(total or 0) // block_bytes)
    found = None
    for i in range(n_blocks):
        rows = distinct.where(F.pmod(F.xxhash64("query"), F.lit(n_blocks)) == i).orderBy("query").collect()
        if rows:
            part = _search_block(docs, key, text, [(r["query"], [bytes(t) for t in r["terms"]]) for r in rows], top)
            found = part if found is None else found.unionByName(part)
    if found is None:
        return items.select(F.col("item").alias(item), F.lit(0).alias("rank"), F.lit(0).cast("long").alias(key),
                            F.lit(0).cast("long").alias("score")).limit(0)
    return items.select("item", "query").join(found, "query").select(
        F.col("item").alias(item), "rank", F.col("key").alias(key), "score")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = rf"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

#: every document's score for every item, then the best
OP12_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS terms FROM documents),
counted AS (SELECT row, doc_id, len(terms) AS n, terms FROM docs WHERE len(terms) > 0),
totals AS (SELECT count(*) AS n_docs, cast(sum(n) AS BIGINT) AS n_words FROM counted),
tfs AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM counted) GROUP BY row, term),
weights AS (SELECT term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tfs, totals GROUP BY term, n_docs),
lengths AS (SELECT row, doc_id, 100 - 50 + (50 * n * n_docs) // n_words AS m FROM counted, totals),
items AS (SELECT row_number() OVER () AS item, item_id, list_distinct({_TERMS}) AS terms FROM benchmark),
scores AS (SELECT item, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id, row,
                  cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
           FROM (SELECT item, item_id, unnest(terms) AS term FROM items) JOIN weights USING (term) JOIN tfs USING (term) JOIN lengths USING (row)
           GROUP BY item, row),
ranked AS (SELECT item_id, cast(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
           FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= {TOP}"""
