"""Substring dedup by recompression.

A window is ``window`` consecutive words of one document. It is a repeat if the
same words also start in a document with a smaller id; every word inside a
repeated window is removed. Windows are judged on the input.

Recompression parses every text in rounds: a round names maximal runs of one
symbol (symbol, length) and then pairs whose left symbol draws 0 and whose right
symbol draws 1 (a coin that depends on the symbol and the round alone). Names
are hashes of what they stand for, so the same words get the same interior
symbols in every document without a dictionary to exchange. With each symbol
goes the range of words that decided it; two occurrences of a window agree in
all symbols whose range lies inside the window (the window's stable symbols).
So a window can only be shared if all its stable symbols are shared.

1. parse all texts; send the stable symbols of the highest level, by name, to
   buckets; a bucket finds the names that occur in more than one document;
2. parse the documents that hold shared symbols again; windows whose stable
   symbols are all shared are candidates; send their 96-bit hashes to buckets;
   a bucket finds, for each hash, the documents above the smallest one;
3. join these marks with the texts and cut the words out.

Every slice of a task sends a name or hash once, whatever the number of its
occurrences there, so a passage in a third of all documents is a row per slice,
not per document. Buckets follow spark.sql.shuffle.partitions. Texts are
shuffled once (by id, for steps 2 and 3).

Words are runs of other characters than space and U+0009 to U+000D. Ids are
integers; rows with a null id neither lose words nor make others lose any. Rows
with the same id are not compared with each other. A null text has no words; an
empty table gives no row; columns beside key and text are ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackwise.llm.batches import documents, small_batches, text_slices, worker_state

WINDOW = 50
#: the rounds: words that repeat are merged first; later, equal neighbours are
#: rare and stay as they are (more symbols, the same result)
ROUNDS = ("run",) + ("pair",) * 7
#: symbols of fewer words are shared by chance and not sent
LEAST_SYMBOL = 4
#: bytes of text parsed at once
SLICE = 2_000_000
CACHE_WORDS = 800_000

U = np.uint64
FAR = 1 << 40


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def pair_name(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    return mix(a * U(0x9E3779B97F4A7C15) + mix(b + U(salt)))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words; a worker keeps those it has seen."""
    cache = worker_state().setdefault("word_hashes", {})
    if len(cache) > CACHE_WORDS:
        cache.clear()
    h = np.fromiter(map(cache.get, words, repeat(0)), U, len(words))
    for i in np.flatnonzero(h == 0).tolist():
        w = words[i]
        h[i] = cache[w] = xxhash.xxh64_intdigest(w, 7) | 1
    return h


class Parse:
    """Symbols of the last round over texts laid end to end: name, words that
    decided it [lo, hi) as positions in ``hashes``, number of words it stands for."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, rounds=ROUNDS):
        ends = np.cumsum(counts)
        n = len(hashes)
        # a barrier before each text and after the last one
        at = np.arange(n) + np.repeat(np.arange(1, len(counts) + 1), counts)
        size = n + len(counts) + 1
        name, lo, hi = np.zeros(size, U), np.full(size, -FAR), np.full(size, FAR)
        name[at], lo[at], hi[at] = hashes, np.arange(n), np.arange(1, n + 1)
        span = np.ones(size, np.int64)
        for r, kind in enumerate(rounds):
            name, lo, hi, span = (self._runs if kind == "run" else self._pairs)(name, lo, hi, span, r)
        real = name > 0
        self.name, self.lo, self.hi, self.span = name[real], lo[real], hi[real], span[real]
        self.begin, self.end = ends - counts, ends

    @staticmethod
    def _runs(name, lo, hi, span, r):
        new = np.concatenate(([True], (name[1:] != name[:-1]) | (name[1:] == 0)))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(name)) - 1
        size = last - first + 1
        out = name[first]
        long_ = size > 1
        out[long_] = mix(out[long_] * U(0xC2B2AE3D27D4EB4F) + size[long_].astype(U)) | U(1)
        # that a run ends here is known from both neighbours
        left, right = lo[np.maximum(first - 1, 0)], hi[np.minimum(last + 1, len(name) - 1)]
        keep = out == 0
        return out, np.where(keep, lo[first], left), np.where(keep, hi[last], right), np.add.reduceat(span, first)

    @staticmethod
    def _pairs(name, lo, hi, span, r):
        coin = (mix(name + U(r * 2 + 1)) >> U(17)) & U(1)
        real = name > 0
        merge = np.zeros(len(name), bool)
        merge[:-1] = real[:-1] & real[1:] & (coin[:-1] == 0) & (coin[1:] == 1)
        out = name.copy()
        out[:-1][merge[:-1]] = pair_name(name[:-1][merge[:-1]], name[1:][merge[:-1]], r) | U(1)
        taken = np.concatenate(([False], merge[:-1]))
        alone = real & ~merge & ~taken
        # a symbol alone is known from the neighbour that it could have joined
        right = np.append(hi[1:], FAR)
        left = np.concatenate(([-FAR], lo[:-1]))
        new_hi = np.where(merge | (alone & (coin == 0)), right, hi)
        new_lo = np.where(alone & (coin == 1), left, lo)
        span = span + np.where(merge, np.append(span[1:], 0), 0)
        keep = ~taken
        return out[keep], new_lo[keep], new_hi[keep], span[keep]

    def stable(self, window: int):
        """(name, text, lo, hi) of the symbols that some window can hold."""
        ok = (self.hi - self.lo <= window) & (self.span >= min(LEAST_SYMBOL, window // 8))
        lo = self.lo[ok]
        return self.name[ok], np.searchsorted(self.end, lo, "right"), lo, self.hi[ok]

    def candidates(self, lo: np.ndarray, hi: np.ndarray, window: int) -> np.ndarray:
        """Starts of windows that hold none of the given symbols."""
        n = int(self.end[-1]) if len(self.end) else 0
        free = np.zeros(n + 1, np.int64)
        np.add.at(free, np.maximum(hi - window, 0), 1)
        np.add.at(free, np.minimum(lo + 1, n), -1)
        free = np.cumsum(free)[:n] == 0
        for b, e in zip(self.begin.tolist(), self.end.tolist()):
            free[max(b, e - window + 1):e] = False
        return np.flatnonzero(free)


def window_hashes(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes (64 and 32 bits) of the ``window`` words from each position on."""
    out = []
    for salt in (11, 23):
        power, size, done, acc = mix(hashes + U(salt)), 1, 0, None
        left = window
        while left:
            if left & 1:
                part = power[done:]
                acc = part if acc is None else pair_name(acc[:len(part)], part, salt + done)
                done += size
            left >>= 1
            if left:
                power = pair_name(power[:-size] if size else power, power[size:], salt + size * 100)
                size *= 2
        out.append(acc[:len(hashes) - window + 1] if len(hashes) >= window else np.empty(0, U))
    return out[0], (out[1] >> U(32)).astype(np.uint32)


# -- what tasks send: (bucket, known, ids, a, b), binary columns of equal length
#    (ids ascending, as differences, which compress well)

SENT = "bucket int, known boolean, ids binary, a binary, b binary"


def _send(ids: np.ndarray, a: np.ndarray, b: np.ndarray | None, known: np.ndarray, buckets: int):
    """Record batch of the entries by bucket; ids, a (uint64), b (uint32)."""
    part = (a % U(buckets)).astype(np.int64)
    order = np.lexsort((ids, known, part))
    ids, a, part, known = ids[order], a[order], part[order], known[order]
    b = b[order] if b is not None else None
    cut = np.flatnonzero((part[1:] != part[:-1]) | (known[1:] != known[:-1])) + 1
    begin, end = np.concatenate(([0], cut)), np.concatenate((cut, [len(ids)]))
    if not len(ids):
        begin = end = np.empty(0, np.int64)
    spans = list(zip(begin.tolist(), end.tolist()))
    return pa.RecordBatch.from_arrays(
        [pa.array(part[begin], pa.int32()), pa.array(known[begin], pa.bool_()),
         pa.array([np.diff(ids[i:j], prepend=0).tobytes() for i, j in spans], pa.binary()),
         pa.array([a[i:j].tobytes() for i, j in spans], pa.binary()),
         pa.array([b[i:j].tobytes() if b is not None else b"" for i, j in spans], pa.binary())],
        ["bucket", "known", "ids", "a", "b"])


def _received(batches):
    """(ids, a, b, known) of all rows of a partition."""
    ids, a, b, known = [np.empty(0, np.int64)], [np.empty(0, U)], [np.empty(0, np.uint32)], [np.empty(0, bool)]
    for batch in batches:
        for k, i, x, y in zip(*(batch.column(c).to_pylist() for c in ("known", "ids", "a", "b"))):
            ids.append(np.cumsum(np.frombuffer(i, np.int64)))
            a.append(np.frombuffer(x, U))
            b.append(np.frombuffer(y, np.uint32) if y else np.zeros(len(ids[-1]), np.uint32))
            known.append(np.full(len(ids[-1]), k))
    return tuple(map(np.concatenate, (ids, a, b, known)))


def _groups(keys: tuple[np.ndarray, ...], ids: np.ndarray):
    """Entries in the order of (keys, id): order, least and greatest id of each entry's keys."""
    order = np.lexsort((ids, *keys))
    if not len(ids):
        return order, ids, ids
    new = np.ones(len(ids), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    group = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(ids)) - 1
    own = ids[order]
    return order, own[first][group], own[last][group]


def _to_ids(ids: np.ndarray, a: np.ndarray, buckets: int):
    """Entries on their way to the texts: by bucket of the id."""
    part = ids % buckets
    order = np.lexsort((ids, part))
    ids, a, part = ids[order], a[order], part[order]
    begin = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(ids) else np.empty(0, np.int64)
    spans = list(zip(begin.tolist(), np.append(begin[1:], len(ids)).tolist()))
    return pa.RecordBatch.from_arrays(
        [pa.array(part[begin], pa.int32()), pa.array(np.zeros(len(begin), bool)),
         pa.array([np.diff(ids[i:j], prepend=0).tobytes() for i, j in spans], pa.binary()),
         pa.array([a[i:j].tobytes() for i, j in spans], pa.binary()), pa.array([b""] * len(spans), pa.binary())],
        ["bucket", "known", "ids", "a", "b"])


def _by_id(batches):
    """One row (id, names) for each id of the partition."""
    ids, a, _, _ = _received(batches)
    order = np.argsort(ids, kind="stable")
    ids, a = ids[order], a[order]
    begin = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))) if len(ids) else np.empty(0, np.int64)
    end = np.append(begin[1:], len(ids)).tolist() if len(ids) else []
    for i in range(0, len(begin), 20_000):
        part = begin[i:i + 20_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[part], pa.int64()),
             pa.array([a[x:y].tobytes() for x, y in zip(part.tolist(), end[i:i + 20_000])], pa.binary())], ["id", "names"])


def _unique(ids: np.ndarray, a: np.ndarray, b: np.ndarray):
    order = np.lexsort((ids, b, a))
    ids, a, b = ids[order], a[order], b[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return ids[new], a[new], b[new]


def _symbols(batches, window: int, buckets: int):
    """Step 1: stable symbols, once a slice; those of two documents of the slice are known to be shared."""
    for keys, texts in text_slices(batches, "id", "body", SLICE):
        words = [t.split() for t in texts]
        counts = np.array([len(w) for w in words])
        parse = Parse(word_hashes([w for own in words for w in own]), counts)
        name, text, lo, hi = parse.stable(window)
        key = np.array(keys, np.int64)
        bare = np.unique(np.searchsorted(parse.end, parse.candidates(lo, hi, window), "right"))
        ids, name, _ = _unique(key[text], name, np.zeros(len(name), np.uint32))
        order, least, greatest = _groups((name,), ids)
        ids, name = ids[order], name[order]
        shared = least != greatest
        once = ids == least                # one entry tells the other slices
        marks = np.zeros(len(bare), U)     # the name 0: look at this document in any case
        yield _send(np.concatenate((ids[shared], ids[once], key[bare])), np.concatenate((name[shared], name[once], marks)),
                    None, np.concatenate((np.ones(shared.sum(), bool), np.zeros(once.sum(), bool), np.ones(len(bare), bool))),
                    buckets)


def _shared_symbols(batches, buckets: int):
    ids, name, _, known = _received(batches)
    order, least, greatest = _groups((name[~known],), ids[~known])
    own, found = ids[~known][order], name[~known][order]
    both = least != greatest
    yield _to_ids(np.concatenate((ids[known], own[both])), np.concatenate((name[known], found[both])), buckets)


def _joined(batches):
    """(id, body, names) rows in slices."""
    ids, texts, names, size = [], [], [], 0
    for batch in batches:
        text = batch.column("body").cast(pa.binary())
        for r in range(batch.num_rows):
            t = text[r].as_py() or b""
            if ids and size + len(t) > SLICE:
                yield ids, texts, names
                ids, texts, names, size = [], [], [], 0
            ids.append(batch.column("id")[r].as_py())
            texts.append(t)
            names.append(np.frombuffer(batch.column("names")[r].as_py() or b"", U))
            size += len(t)
    if ids:
        yield ids, texts, names


def _candidate_windows(batches, window: int, buckets: int):
    """Step 2: hashes of candidate windows, once a slice; above the least id of the slice they are known repeats."""
    for ids, texts, names in _joined(batches):
        words = [t.split() for t in texts]
        counts = np.array([len(w) for w in words])
        hashes = word_hashes([w for own in words for w in own])
        parse = Parse(hashes, counts)
        name, text, lo, hi = parse.stable(window)
        cut = np.searchsorted(text, np.arange(len(ids) + 1))
        own = np.zeros(len(name), bool)
        for d, shared in enumerate(names):
            own[cut[d]:cut[d + 1]] = ~np.isin(name[cut[d]:cut[d + 1]], shared)
        at = parse.candidates(lo[own], hi[own], window)
        a, b = window_hashes(hashes, window)
        key = np.array(ids, np.int64)[np.searchsorted(parse.end, at, "right")]
        key, a, b = _unique(key, a[at], b[at])
        order, least, _ = _groups((b, a), key)
        key, a, b = key[order], a[order], b[order]
        yield _send(key, a, b, key > least, buckets)


def _repeats(batches, buckets: int):
    ids, a, b, known = _received(batches)
    new = ~known
    order, least, _ = _groups((b[new], a[new]), ids[new])
    own, found = ids[new][order], a[new][order]
    above = own > least
    yield _to_ids(np.concatenate((ids[known], own[above])), np.concatenate((a[known], found[above])), buckets)


def _cut(batches, window: int):
    """Step 3: the texts without the words of their repeated windows."""
    for ids, texts, names in _joined(batches):
        n_words, n_removed, kept = [], [], []
        for text, repeated in zip(texts, names):
            words = text.split()
            n_words.append(len(words))
            if len(repeated):
                a, _ = window_hashes(word_hashes(words), window)
                cover = np.zeros(len(words) + 1, np.int64)
                at = np.flatnonzero(np.isin(a, repeated))
                cover[at] += 1
                cover[at + window] -= 1
                free = np.cumsum(cover)[:-1] == 0
                words = [words[i] for i in np.flatnonzero(free)]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(kept, pa.binary()).cast(pa.string())], ["id", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(key, n_words, n_removed, kept: the remaining words, joined by one space) of every row."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("body"))
    named = texts.where("id IS NOT NULL")
    dealt = named.repartition(buckets, "id")         # one exchange of the texts for both joins

    def gather(sent: DataFrame, judge) -> DataFrame:
        """(id, names): what the buckets of ``sent`` find, by id."""
        found = sent.repartition(buckets, "bucket").mapInArrow(lambda it: judge(it, buckets), SENT)
        return found.repartition(buckets, "bucket").mapInArrow(_by_id, "id long, names binary")

    shared = gather(named.mapInArrow(lambda it: _symbols(it, window, buckets), SENT), _shared_symbols)
    repeats = gather(dealt.join(shared, "id").mapInArrow(lambda it: _candidate_windows(it, window, buckets), SENT), _repeats)
    marked = dealt.join(repeats, "id", "left")
    rest = texts.where("id IS NULL").withColumn("names", F.lit(None).cast("binary"))
    return (marked.unionByName(rest)
            .mapInArrow(lambda it: _cut(it, window), "id long, n_words long, n_removed long, kept string")
            .withColumnRenamed("id", key))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP2_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
x AS (SELECT r, doc_id, i, sha256(array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ')) AS g
      FROM d, unnest(range(1, len(w) - {WINDOW - 2})) t(i)),
m AS (SELECT g, min(doc_id) AS least FROM x GROUP BY g),
k AS (SELECT DISTINCT r, i + o AS i FROM x JOIN m USING (g), unnest(range(0, {WINDOW})) t(o) WHERE doc_id > least),
c AS (SELECT r, list(i) AS cut FROM k GROUP BY r),
f AS (SELECT doc_id, len(w) AS n, CASE WHEN cut IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(cut, i)) END AS kept
      FROM d LEFT JOIN c USING (r))
SELECT doc_id, n::BIGINT AS n_words, (n - len(kept))::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM f
"""
