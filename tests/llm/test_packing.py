import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from trackwise.llm import packing as pk
from trackwise.llm.batches import documents


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 8), st.integers(0, 2)), min_size=1, max_size=12), st.integers(8, 20))
def test_cuts_are_the_cheapest(steps, window):
    pos, kind = np.cumsum([s for s, _ in steps]), np.array([k for _, k in steps])
    pen = (0, 3, 10)

    def cost(cuts):
        at = [0, *cuts]
        at_kind = dict(zip(pos.tolist(), kind.tolist()))
        return sum(window - (b - a) + (pen[at_kind[b]] if b != pos[-1] else 0) for a, b in zip(at, at[1:]))

    best = {0: (0, [])}
    for p in pos.tolist():
        best[p] = min(((cost(c + [p])), c + [p]) for q, (_, c) in best.items() if 0 < p - q <= window)
    cuts = pk.best_cuts(pos, kind, window, pen)
    assert cuts[-1] == pos[-1] and all(0 < b - a <= window for a, b in zip([0, *cuts], cuts))
    assert cost(cuts) == best[int(pos[-1])][0]


def test_round_trip(spark):
    from tokenizers import Tokenizer

    path = pk.default_tokenizer()
    plain = Tokenizer.from_file(path)
    extra = [(-1, "Don't <|endoftext|> <|ENDOFTEXT|> it's. (a),b.. c.,\u00a0d\u3000e \x1cf"), (-2, "\u00c9t\u00e9 \u0130stanbul \u03a3\u0391\u03a3 stra\u00dfe \u00f7 \u00ad 12,5 x\u0301 " * 40),
             (-3, "x" * 70_000), (-4, "word. " * 9_000), (-5, None)]
    docs = documents(spark, "/root/testdata/sf0.001").select("doc_id", "text").unionByName(
        spark.createDataFrame(extra, "doc_id long, text string")).repartition(3)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = pk.pack(docs, path).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for i, text in texts.items():
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert zlib.crc32(np.array(ids[r["start"]:at], "<u4").tobytes()) == r["ids_crc32"]
        assert at == len(ids)
    sizes = []
    for rs in by_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        sizes.append(at)
    assert max(sizes) <= 2048
    assert sum(2048 - s for s in sorted(sizes)[3:]) / (2048 * len(sizes)) < 0.02    # beside the last window of each partition


def test_a_full_cache_changes_no_ids(monkeypatch):
    texts = [" ".join(f"w{i % 50}x{i * 7 % 300}. abc" for i in range(k, k + 400)).encode() for k in range(0, 3000, 300)]
    whole = pk.WordTokenizer(pk.default_tokenizer())
    want = [[x.tolist() for x in whole.encode([t])] for t in texts]
    for stale in (0.0, 1.0):                  # always afresh; never afresh
        monkeypatch.setattr(pk, "CACHE_WORDS", 60)
        monkeypatch.setattr(pk, "STALE", stale)
        small = pk.WordTokenizer(pk.default_tokenizer())
        assert [[x.tolist() for x in small.encode([t])] for t in texts] == want
        assert len(small.index) <= 1000
