"""Nulls, empty and long texts, repeated rows, empty tables, clashing columns."""

import pytest

from trackwise.llm import (decontaminate, embeddings, html_text, licenses, packing, pii, simhash,
                           substring_dedup, toxicity, url_filter)

LONG = "word " * 30_000 + "x" * 100_000
ROWS = [(1, "a small text of some words"), (1, "a small text of some words"), (2, None), (3, ""), (4, "   \n"),
        (None, "a text without an id"), (5, LONG), (6, LONG), (None, None)]
#: names that the operators use inside
CLASH = ["key", "id", "names", "row", "fp", "bucket", "th", "form", "n_words", "kind", "n_entities", "host", "rule", "text_"]


def table(spark, rows, key="doc_id", text="text"):
    df = spark.createDataFrame(rows, f"{key} long, {text} string")
    for c in CLASH:
        df = df.selectExpr("*", f"'other' AS {c}")
    return df


BENCH = "item_id long, text string"
OPERATORS = {
    "simhash": lambda s, d: simhash.near_duplicates(d),
    "substring": lambda s, d: substring_dedup.remove_repeats(d),
    "decontamination": lambda s, d: decontaminate.find_contamination(
        d, s.createDataFrame([(1, "small text"), (2, None), (3, ""), (None, "word word word")], BENCH)),
    "toxicity": lambda s, d: toxicity.score(d, toxicity.train(d, s.createDataFrame([(1, 1), (3, 0), (None, 1), (9, None)], "doc_id long, toxic int"))),
    "pii": lambda s, d: pii.pseudonymise(d),
    "licenses": lambda s, d: licenses.scan(d),
    "url": lambda s, d: url_filter.filter_urls(d, url_filter.RULES, key="doc_id", url="text"),
    "html": lambda s, d: html_text.extract(d.withColumnRenamed("rule", "url"), key="doc_id", url="url", html="text"),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_result_per_row(spark, name):
    out = OPERATORS[name](spark, table(spark, ROWS)).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(i) for i, _ in ROWS)
    twice = [r for r in out if r["doc_id"] == 1]
    assert twice[0] == twice[1]


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, table(spark, [])).collect() == []


def test_packing_edges(spark):
    out = packing.pack(table(spark, ROWS), packing.default_tokenizer()).collect()
    assert {r["doc_id"] for r in out} == {1, 2, 3, 4, 5, 6, None}
    assert all(r["doc_tokens"] == 1 for r in out if r["doc_id"] in (2, 3, 4))
    assert packing.pack(table(spark, []), packing.default_tokenizer()).collect() == []


def test_empty_benchmark(spark):
    out = decontaminate.find_contamination(table(spark, ROWS), spark.createDataFrame([], BENCH)).collect()
    assert len(out) == len(ROWS) and all(r["windows"] == [] and r["items"] == [] for r in out)


def test_embeddings_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 0, [1.0, 0.0]), (2, 0, [2.0, 0.01]), (3, None, [1.0, 0.0]), (4, 0, None), (5, 0, []), (6, 0, [0.0, 0.0]),
            (7, 0, [nan, 1.0]), (8, 0, [inf, 1.0]), (9, 0, [None, 1.0]), (10, 0, [1.0, 0.0, 0.0]), (11, 1, [1.0, 0.0]),
            (None, 0, [1.0, 0.0]), (2, 0, [2.0, 0.01])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").selectExpr("*", "1 AS id", "2 AS v", "3 AS cell")
    out = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicates(df).collect()}
    assert out == {1: (1, 1, True), 2: (1, 1, False), None: (0, None, False), **{i: (0, i, True) for i in range(3, 12)}}
    assert embeddings.near_duplicates(df.limit(0)).collect() == []


def test_no_model_without_both_classes(spark):
    docs = table(spark, ROWS)
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert toxicity.train(docs, labels) is None
    assert {r["severity"] for r in toxicity.score(docs, None).collect()} == {0.0}
