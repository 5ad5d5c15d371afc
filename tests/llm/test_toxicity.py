import numpy as np

from trackwise.llm import toxicity as tx
from trackwise.llm.batches import documents


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = tx.train(documents(spark, sf).where("doc_id % 2 = 0"), labels)
    out = tx.score(documents(spark, sf).where("doc_id % 2 = 1"), model).join(labels, "doc_id")
    n = {(r["toxic"], r["rejected"]): r["count"] for r in out.groupBy("toxic", "rejected").count().collect()}
    assert n[1, True] / (n[1, True] + n[1, False]) > 0.85
    assert n[0, True] / (n[0, True] + n[0, False]) < 0.015


def test_fit_recovers_an_order():
    rng = np.random.default_rng(1)
    truth = np.array([3.0, 1.0, 0.0, -2.0])
    rows = []
    for _ in range(4000):
        x = np.flatnonzero(rng.random(4) < 0.5).tolist()
        rows.append((int((truth[x].sum() + rng.logistic() > np.array([0, 2, 4])).sum()), x))
    w, cuts = tx.fit(rows, 4)
    assert np.argsort(w).tolist() == [3, 2, 1, 0] and np.all(np.diff(cuts) > 0)


def test_severity_is_the_sum_of_the_thresholds():
    model = {"index": {b" bad": 0}, "weights": np.array([2.0]), "cuts": np.array([1.0, 2.0, 3.0])}
    assert tx.severity(model, b"Bad") == np.sum(1 / (1 + np.exp(np.array([1.0, 2.0, 3.0]) - 2.0)))
    assert tx.severity(model, b"") < tx.severity(model, b"a bad thing")
