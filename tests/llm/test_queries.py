"""The registered queries without a SQL twin, on the smallest tables."""

import zlib

import numpy as np
from test_simhash import by_hand, groups
from tokenizers import Tokenizer

from trackwise.llm.packing import default_tokenizer
from trackwise.llm.registry import ORACLE, QUERIES
from trackwise.llm.toxicity import REJECT

SF = "/root/testdata/sf0.001"


def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_queries_are_those_of_the_operators():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14)) and set(ORACLE) < set(QUERIES)


def test_op1(spark):
    docs = texts(spark)
    rows = {r["doc_id"]: r for r in QUERIES["op1_simhash"](spark, SF).collect()}
    prints = {i: by_hand(t or "") for i, t in docs.items()}
    ids = sorted(docs)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if (prints[a] ^ prints[b]).bit_count() <= 3]
    label = groups(ids, links)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in rows.items()} == {i: (f"{prints[i]:016x}", label[i]) for i in ids}


def test_op5(spark):
    rows = QUERIES["op5_toxicity"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(texts(spark)) and len(rows) == len(texts(spark))
    assert all(0 <= r["severity"] <= 3 and r["grade"] == round(r["severity"]) and r["rejected"] == (r["severity"] >= REJECT) for r in rows)


def test_op7(spark):
    docs = texts(spark)
    rows = {r["doc_id"]: r for r in QUERIES["op7_pii_surrogates"](spark, SF).collect()}
    assert rows.keys() == docs.keys()
    assert all((rows[i]["text"] == docs[i]) == (rows[i]["n_entities"] == 0) for i in docs)
    assert sum(r["n_entities"] for r in rows.values()) > 5


def test_op9(spark):
    rows = QUERIES["op9_packing"](spark, SF).collect()
    tokenizer = Tokenizer.from_file(default_tokenizer())
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    docs = texts(spark)
    assert pieces.keys() == docs.keys()
    for i, t in docs.items():
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:at].tobytes())
        assert at == len(ids)
    for rs in sequences.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
