"""Periodic runs against a search of all periods, the automaton, edge cases."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trackwise.llm.periodic_runs import (_slice_runs, collapse, find_runs, op13_periodic_runs, planted, runs_of,
                                         suffix_automaton)
from trackwise.llm.registry import QUERIES


def brute(words):
    """All runs by trying every period: maximal stretches without a smaller period."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            part = words[start:j]
            if length >= max(6, 4 * q) and all(part[d:] != part[:-d] for d in range(1, q)):
                out.append((start, length, q))
            i = j
    return sorted(out)


def kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60))
def test_runs_of_small_alphabets(word):
    assert runs_of(word) == brute(word)
    assert _slice_runs([[str(w).encode() for w in word]]) == [brute(word)]


def text_with_runs(rng, n):
    out = []
    while len(out) < n:
        unit = [rng.choice("abcdefgh") for _ in range(rng.randint(1, 12))]
        part = (unit * rng.randint(1, 9))[:rng.randint(1, 60)]
        out += part
    return out


def test_random_texts_in_a_slice():
    rng = random.Random(5)
    texts = [text_with_runs(rng, rng.randint(0, 200)) for _ in range(200)] + [[], ["a"] * 500, list("ab") * 300, list("aab" * 100 + "b")]
    got = _slice_runs([[w.encode() for w in t] for t in texts])
    for t, runs in zip(texts, got):
        assert runs == brute(t)
        assert collapse([w.encode() for w in t], runs).decode() == kept(t, runs)


def test_long_periods_and_nested_runs():
    rng = random.Random(6)
    unit = [str(rng.randrange(50)) for _ in range(700)]
    nested = list("xy" * 5) + unit[:30]
    for t in (unit * 4, (unit * 6)[:4100], nested * 5, ["w"] + (unit * 4)[:2799], list("abaab" * 20) * 5):
        assert _slice_runs([[w.encode() for w in t]]) == [brute(t)]


def test_automaton_states():
    length, link, prefix = suffix_automaton([0, 1, 1, 0, 1, 1])
    assert [length[p] for p in prefix] == [1, 2, 3, 4, 5, 6] and link[0] == -1 and len(length) <= 12
    assert all(length[link[v]] < length[v] for v in range(1, len(length)))


def test_one_word_repeated():
    n = 200_000
    assert _slice_runs([[b"la"] * n]) == [[(0, n, 1)]]


def test_planted_period():
    ten = [k for k in range(400) if zlib.crc32(str(k).encode()) % 10 == 0]
    for k in ten:
        words = [str(i).encode() for i in range(37)]
        g = zlib.crc32(str(k).encode()) // 10
        a = g % 37
        p = 1 + (37 - a) // (3 + g % 8)
        assert planted(k, words) == [words[i] if i < a else words[a + (i - a) % p] for i in range(37)]
        assert planted(k, []) == []
    assert all(planted(k, words) is words for k in range(400) if k not in ten) and planted(None, words) is words


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r for r in op13_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(rows) == len(docs) and QUERIES["op13_periodic_runs"] is op13_periodic_runs
    some = 0
    for d in docs:
        words = planted(d["doc_id"], (d["text"] or "").encode().split())
        words = [w.decode() for w in words]
        if len(words) > 3000:
            continue
        runs, r = brute(words), rows[d["doc_id"]]
        some += bool(runs)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        assert r["n_runs"] == len(runs)
        assert (r["start"], r["length"], r["period"]) == (best or (None, None, None))
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(kept(words, runs).encode()).hexdigest()
    assert some > 5


def test_edges(spark):
    long = "x" * 100_000 + " " + "lo rem ip " * 20_000
    rows = [(1, "a b a b a b a b"), (1, "a b a b a b a b"), (2, None), (3, ""), (4, " \t\r\n\x0b\x0c"), (None, "no " * 6), (5, long),
            (6, "ü ü " * 6), (7, "a " * 5), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("key", "runs", "collapsed", "n_words", "best", "start", "length", "period"):
        df = df.selectExpr("*", f"'other' AS {c}")
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in find_runs(df).collect()]
    want = [(1, 8, [(0, 8, 2)], "a b"), (1, 8, [(0, 8, 2)], "a b"), (2, 0, [], ""), (3, 0, [], ""), (4, 0, [], ""),
            (None, 6, [(0, 6, 1)], "no"), (5, 60_001, [(1, 60_000, 3)], "x" * 100_000 + " lo rem ip"),
            (6, 6, [(0, 6, 1)], "ü ü"), (7, 5, [], "a a a a a"), (None, 0, [], "")]
    order = lambda rows: sorted(rows, key=lambda r: (str(r[0]), r[1]))
    assert order(got) == order(want)
    assert find_runs(df.limit(0)).collect() == []


@pytest.mark.parametrize("n", [4_000, 16_000])
def test_segments_cut_off_grow_with_the_words(n):
    """Fibonacci words have runs everywhere; their number stays below their length."""
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    assert len(runs_of(b[:n])) < n and np.all(np.diff([s for s, _, _ in runs_of(b[:n])]) >= 0)
