"""Periodic runs of words: a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q (words q apart are
equal) that no neighbouring word extends; those of max(LEAST, EXPONENT * q) words
or more are found, all of them and exactly.

The words of a stretch go into a suffix automaton. Its suffix links form a tree;
the states from a prefix's state up to the root stand for all suffixes of that
prefix. Appending word i is the access operation of a link-cut tree at its
prefix's state: the path to the root takes the colour i, the end of the last
occurrence, and the segments of one former colour that it crosses are what the
access cuts off. A segment of colour e whose deepest state has length m says: the
longest suffix ending at i whose last occurrence ended at e has m words. The ends
are q = i - e apart; with m >= q that is a square of period q ending at i, and the
words from e - m + 1 to i have period q. The last occurrence makes q the smallest
period and m the farthest start; the same start and period at the next word extend
the run. Once the automaton is built its tree is fixed, so the preferred paths are kept as
stacks over its heavy paths: an access crosses O(log n) of them and every segment
it cuts off was pushed before, O(n log n) in all.

Most texts have no run at all, and the automaton is built only over stretches that
can hold one. In a run of period q, with k <= q < 2k for a power of two k, the
k words before every position from the period's second end on have stood less
than 2k words before: a stretch of more than 2k such positions. The names of
k-word strings are doubled level by level over all texts of a slice, strings that
occur once are left out, and what lies outside these stretches is in no run. That
only leaves out; every run is found by the automaton.

Words are maximal strings of other characters than space and U+0009 to U+000D.
A null, empty or blank text has no words, no runs and an empty collapsed text.
Repeated rows give repeated results, null keys are kept, an empty table gives no
row, other columns are ignored. Whole texts are handled in a task, in slices of
bounded size or a longer text alone (some 500 bytes a word of its periodic
stretches); nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackwise.llm.batches import documents, small_batches, text_slices

#: a run has at least so many words, and its period at least so many times
LEAST, EXPONENT = 6, 4

RESULT = "key long, n_words long, runs array<struct<start:long, length:long, period:long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def possible_stretches(names: np.ndarray, text_of: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint (first, end) outside of which no run is. ``names`` are word numbers,
    equal only within a text; ``text_of`` is the text that a word belongs to."""
    n, k, found = len(names), 1, []
    begins = np.searchsorted(text_of, text_of[:1] if not n else np.arange(text_of[-1] + 1))
    name = _repeated(names, np.arange(n), n)
    while True:
        at = np.flatnonzero(name >= 0)
        if not len(at):
            break
        by_name = at[np.argsort(name[at], kind="stable")]
        again = (name[by_name[1:]] == name[by_name[:-1]]) & (np.diff(by_name) < 2 * k)
        near = np.sort(by_name[1:][again])
        if len(near):
            cut = np.flatnonzero((np.diff(near) != 1) | (np.diff(text_of[near]) != 0))
            first, last = near[np.concatenate(([0], cut + 1))], near[np.concatenate((cut, [len(near) - 1]))]
            long = last - first + 1 >= (LEAST - 1 if k == 1 else (EXPONENT - 2) * k + 1)
            first, last = first[long], last[long]
            found.append(np.stack((np.maximum(first - (3 * k - 2), begins[text_of[first]]), last + 1), axis=1))
        both = at[at >= k]
        both = both[name[both - k] >= 0]
        if not len(both):
            break
        name = _repeated(name[both - k] * (int(name.max()) + 1) + name[both], both, n)
        k *= 2
    spans = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    merged: list[tuple[int, int]] = []
    for a, b in spans[np.argsort(spans[:, 0], kind="stable")].tolist():
        if merged and a < merged[-1][1] and text_of[a] == text_of[merged[-1][0]]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _repeated(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the values at their places; -1 for those that occur once, and elsewhere."""
    _, number, count = np.unique(values, return_inverse=True, return_counts=True)
    name = np.full(n, -1, np.int64)
    twice = count[number] > 1
    name[at[twice]] = number[twice]
    return name


def suffix_automaton(word: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(length, link, state of every prefix) of the automaton of ``word``; state 0 is the root."""
    steps: list[dict[int, int]] = [{}]
    length, link, prefix = [0], [-1], []
    last = 0
    for w in word:
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        steps.append({})
        prefix.append(new)
        p = last
        while p >= 0 and w not in steps[p]:
            steps[p][w] = new
            p = link[p]
        if p >= 0:
            q = steps[p][w]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                steps.append(steps[q].copy())
                while p >= 0 and steps[p].get(w) == q:
                    steps[p][w] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return length, link, prefix


def heavy_paths(length: list[int], link: list[int]) -> tuple[list[int], list[int]]:
    """(path of every state, state above the path): a path goes on to the child with most states below."""
    n = len(length)
    inner = np.argsort(np.asarray(length), kind="stable").tolist()      # a link's state comes first
    size, heavy = [1] * n, [-1] * n
    for v in reversed(inner[1:]):
        up = link[v]
        size[up] += size[v]
        if heavy[up] < 0 or size[v] > size[heavy[up]]:
            heavy[up] = v
    path, above = [0] * n, [-1]
    for v in inner[1:]:
        up = link[v]
        if heavy[up] == v:
            path[v] = path[up]
        else:
            path[v] = len(above)
            above.append(up)
    return path, above


def runs_of(word: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of ``word``, by start and period."""
    length, link, prefix = suffix_automaton(word)
    path, above = heavy_paths(length, link)
    # of every path the coloured segments, the nearest to the root on top: (length of the deepest state, colour)
    segments: list[list[tuple[int, int]]] = [[] for _ in above]
    found: dict[tuple[int, int], int] = {}
    for i, state in enumerate(prefix):
        v, deeper = state, -1
        while v > 0:
            on, reach = segments[path[v]], length[v]
            shallowest, covered = -1, 0
            while on and covered < reach:
                m, e = on[-1]
                if m <= reach:
                    on.pop()
                else:
                    m = reach                       # the rest below keeps its colour
                covered = m
                if shallowest < 0:
                    shallowest = e
                q = i - e
                if e != deeper and m >= (EXPONENT - 1) * q and m + q >= LEAST:
                    found[(e - m + 1, q)] = i
            on.append((reach, i))
            deeper = shallowest if shallowest >= 0 else deeper
            v = above[path[v]]
    return sorted((start, end + 1 - start, q) for (start, q), end in found.items())


def _slice_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Runs of every text (a list of its words)."""
    number: dict[bytes, int] = {}
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ids = np.fromiter((number.setdefault(w, len(number)) for words in texts for w in words), np.int64, int(sizes.sum()))
    begins = np.concatenate(([0], np.cumsum(sizes)))
    text_of = np.repeat(np.arange(len(texts)), sizes)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if len(ids):
        for a, b in possible_stretches(text_of * len(number) + ids, text_of):
            t = int(text_of[a])
            shift = a - int(begins[t])
            out[t] += [(s + shift, n, q) for s, n, q in runs_of(ids[a:b].tolist())]
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run repeats, joined by one space: a run keeps its first period."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, n, q in runs:
        edge[start + q] += 1
        edge[start + n] -= 1
    kept = np.cumsum(edge[:-1]) == 0
    return b" ".join([w for w, k in zip(words, kept.tolist()) if k])


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text",
              prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(key, n_words, runs, collapsed) of every row; runs by start and period. ``prepare``
    may change a text's words, given its key, before they are searched."""
    def run(batches):
        for keys, texts in text_slices(batches, "key", "text"):
            words = [t.split() for t in texts]
            if prepare is not None:
                words = [prepare(k, ws) for k, ws in zip(keys, words)]
            runs = _slice_runs(words)
            yield pa.RecordBatch.from_arrays([
                pa.array(keys, pa.int64()), pa.array([len(ws) for ws in words], pa.int64()),
                pa.array([[{"start": s, "length": n, "period": q} for s, n, q in rs] for rs in runs], pa.list_(_RUN)),
                pa.array([collapse(ws, rs) for ws, rs in zip(words, runs)], pa.binary()).cast(pa.string()),
            ], ["key", "n_words", "runs", "collapsed"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, RESULT).withColumnRenamed("key", key)


def planted(key: int | None, words: list[bytes]) -> list[bytes]:
    """The words with the period that the query's contract plants in a tenth of the texts."""
    n, h = len(words), 1 if key is None else zlib.crc32(str(key).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


#: the run with the greatest exact length / period; the first of equal ones
_BEST = ("aggregate(runs, cast(null AS struct<start:bigint, length:bigint, period:bigint>), "
         "(b, x) -> IF(b IS NULL OR x.length * b.period > b.length * x.period, x, b))")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(documents(spark, sf_dir), prepare=planted).withColumn("best", F.expr(_BEST))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.expr("sha2(array_join(transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\\n')), ''), 256)").alias("runs_sha256"),
        F.expr("sha2(collapsed, 256)").alias("collapsed_sha256"))
