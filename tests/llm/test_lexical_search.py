"""Ranked search against scoring every document, the rounds of NRA, edge cases."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackwise.llm import lexical_search
from trackwise.llm.lexical_search import Lists, nra, search, search_slices

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text):
    return [re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), t) for t in TERM.findall(text or "")]


def brute(docs, items, top):
    """(item, rank, key, score) by scoring every document for every item."""
    rows = [(k, cut(t)) for k, t in docs]
    rows = [(k, ws) for k, ws in rows if ws]
    total, words = len(rows), sum(len(ws) for _, ws in rows)
    out = []
    for item, text in items:
        scored = []
        terms = {t: sum(t in ws for _, ws in rows) for t in set(cut(text))}
        for k, ws in rows:
            m = 100 - 50 + (50 * len(ws) * total) // words
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1))) * ((1000000000 * ws.count(t)) // (1000 * ws.count(t) + 20 * m))
                        for t, df in terms.items() if t in ws)
            if score > 0:
                scored.append((-score, k is None, k or 0))
        out += [(item, r, None if none else k, -s) for r, (s, none, k) in enumerate(sorted(scored)[:top], 1)]
    return out


def rows_of(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def corpus(rng, n, vocabulary=60):
    words = [f"w{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 40)))) for i in range(n)]
    docs += [(n + i, docs[0][1] or "w1 w2") for i in range(n // 3)]            # a third of copies: ties
    items = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 15)))) for i in range(12)]
    return docs, items


@pytest.mark.parametrize("top, block", [(5, 8_000_000), (50, 200)])
def test_against_all_scores(spark, monkeypatch, top, block):
    monkeypatch.setattr(lexical_search, "SLICE_DOCUMENTS", 37)
    monkeypatch.setattr(lexical_search, "SLICE_POSTINGS", 300)
    docs, items = corpus(random.Random(top), 150)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(search(d, q, top=top, block_bytes=block)) == sorted(brute(docs, items, top), key=str)


def lists_of(rng, n, terms):
    pairs = [(d, t, rng.randint(1, 9)) for d in range(n) for t in range(terms) if rng.random() < 1 / (t + 1)]
    doc, term, tf = (np.array(x, np.int64) for x in zip(*pairs))
    n_words = [max(1, int(tf[doc == d].sum())) + rng.randint(0, 20) for d in range(n)]
    return Lists(list(range(n)), n_words, doc, term, tf, n, sum(n_words))


def test_nra_finds_the_best_of_a_slice():
    rng = random.Random(2)
    for _ in range(60):
        lists = lists_of(rng, rng.randint(1, 60), 8)
        query = [(t, rng.choice([0, 1, 7, 300, 9000])) for t in rng.sample(range(9), rng.randint(1, 8))]
        score = np.zeros(len(lists.keys), np.int64)
        for t, w in query:
            d, part = lists.read(t)
            score[d] += w * part
        for top in (1, 3, 50):
            docs, scores = nra(lists, query, 1, [], top)
            assert (score[docs] == scores).all() and len(set(docs.tolist())) == len(docs)
            limit = max(1, sorted(score.tolist())[-top]) if len(score) >= top else 1
            assert set(docs.tolist()) == set(np.flatnonzero(score >= limit).tolist())
            want = sorted(((-s, d) for d, s in enumerate(score.tolist()) if s > 0))[:top]
            assert search_slices(iter([lists]), [query], top) == [[(-s, d) for s, d in want]]


def test_low_lists_are_not_read_for_documents_that_are_out():
    """A limit above what the open lists hold ends the reading."""
    lists = lists_of(random.Random(4), 200, 6)
    docs, _ = nra(lists, [(t, 5) for t in range(6)], 10 ** 12, [10 ** 12] * 3, 3)
    assert len(docs) == 0
    all_docs, scores = nra(lists, [(0, 5)], 1, [], 200)
    assert len(all_docs) == 200 and scores.min() > 0


def test_edges(spark):
    long = "the " * 60_000 + "z" * 100_000
    docs = [(1, "Red fox"), (1, "Red fox"), (2, None), (3, ""), (4, " .,; "), (None, "red fox"), (5, long), (6, "FÜR élan 42"), (7, "für @élan# 42")]
    items = [(1, "red FOX red"), (2, None), (3, ""), (4, "nothing here"), (None, "red"), (5, "the"), (6, "FÜR"), (7, "élan_42"), (7, "élan_42")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(items, "item_id long, text string")
    for c in ("key", "n", "terms", "item", "query", "rank", "score", "at", "part"):
        d, q = d.selectExpr("*", f"'other' AS {c}"), q.selectExpr("*", f"'other' AS {c}")
    assert rows_of(search(d, q)) == sorted(brute(docs, items, 50), key=str)
    assert search(d.limit(0), q).collect() == [] and search(d, q.limit(0)).collect() == []
    assert search(d, q.where("item_id IN (2, 3)")).collect() == []
    texts = search(d, q.where("item_id = 1").withColumn("item_id", F.lit("a/b")))
    assert texts.schema["item_id"].dataType.simpleString() == "string" and texts.count() == 3
