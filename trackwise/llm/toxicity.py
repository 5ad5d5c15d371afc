"""Toxicity by cumulative-link ordinal regression.

Severity grades are 0 (not toxic) to 3. With sparse features x of a text,

    P(grade >= k) = 1 / (1 + exp(cut_k - w.x)),  k = 1, 2, 3,  cut_1 < cut_2 < cut_3,

the weights w (not negative: features only speak for severity) are shared by all
thresholds and only the cuts differ. The expected severity is the sum of the
three probabilities; a text is rejected if it reaches REJECT.

Features are the distinct words of a text and their beginnings of 4 to 7 bytes
(so compounds of a known word count too). The model is fitted on a sample of at
most SAMPLE labelled texts of either class (the least hashes of their ids), the
documented bound of everything the driver sees: of all features of the sample,
counted by Spark, the FEATURES with the highest chi-square that lean to toxic
texts are selected, and the texts' selected features are collected. The labels
are 0 or 1; the grade of a toxic text is read from how many of the selected
features' words it holds (GRADE_WORDS). Every text is scored whole.

Words are maximal runs of 0-9, a-z (A-Z lower-cased) and non-ASCII characters.
A null or empty text has no features and the severity of the cuts alone. Labels
that are null, or whose id is null or unknown, are not used; of an id with
several labels the greatest counts. Without a toxic and a clean label there is
no model and the severity is 0. Repeated rows give repeated results; an empty
table gives no row; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackwise.llm.batches import documents, small_batches, text_slices, through_table
from trackwise.llm.licenses import WORD_BYTES

SAMPLE = 8_000
FEATURES = 4_000
#: a feature is in so many toxic texts of the sample at least, with such a chi-square
LEAST_TEXTS, LEAST_CHI = 4, 20.0
PREFIXES = (4, 5, 6, 7)
#: matching words from which a toxic text has grade 2 and 3
GRADE_WORDS = (3, 6)
REJECT = 0.75
STEPS, RATE, DECAY = 400, 0.3, 3e-3


def features_of(word: bytes) -> list[bytes]:
    """The word (marked by a leading blank) and its beginnings."""
    return [b" " + word, *(word[:n] for n in PREFIXES if len(word) >= n)]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def sample_texts(docs: DataFrame, labels: DataFrame, key: str, text: str, label_key: str, label: str,
                 sample: int) -> DataFrame:
    """(toxic, text) of at most ``sample`` labelled texts of either class, in the
    shared folder; equal texts once, so that copies do not look like evidence."""
    known = (labels.select(F.col(label_key).alias("id"), F.col(label).alias("toxic"))
             .where("id IS NOT NULL AND toxic IN (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic")))
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("toxic") == value).orderBy(F.xxhash64("id"), "id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    return through_table(rows.join(F.broadcast(chosen), "id")   # 2 * sample rows
                         .select("toxic", "text")
                         .dropDuplicates(), "labelled")


def _count_features(batches):
    """(feature, texts it is in, toxic ones of them), summed per slice."""
    for toxic, texts in text_slices(batches, "toxic", "text", 1_000_000):
        seen, bad = Counter(), Counter()
        for t, x in zip(toxic, texts):
            own = {f for w in set(words_of(x)) for f in features_of(w)}
            seen.update(own)
            if t:
                bad.update(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64()),
             pa.array([bad[f] for f in seen], pa.int64())], ["feature", "n", "n_toxic"])


def select_features(sample: DataFrame, most: int) -> dict[bytes, int]:
    """Index of the features that tell toxic texts best."""
    total = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    good, bad = total.get(0, 0), total.get(1, 0)
    if not good or not bad:
        return {}
    counts = (sample.mapInArrow(_count_features, "feature binary, n long, n_toxic long").groupBy("feature")
              .agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("a")).where(F.col("a") >= LEAST_TEXTS))
    b = F.col("n") - F.col("a")
    share = good + bad
    chi = share * F.pow(F.col("a") * (good - b) - b * (bad - F.col("a")), 2) / (
        F.col("n").cast("double") * (share - F.col("n")) * bad * good + 1)
    lean = F.col("a") / bad > 4 * b / good          # at least four times as frequent in toxic texts
    rows = counts.where(lean & (chi >= LEAST_CHI)).orderBy(chi.desc(), "feature").limit(most).select("feature").collect()
    return {bytes(r["feature"]): i for i, r in enumerate(rows)}


def active_features(text: bytes, index: dict[bytes, int]) -> tuple[list[int], int]:
    """(selected features of a text, words of it that have any)."""
    get, found, hits = index.get, set(), set()
    words = words_of(text)
    for w in set(words):
        own = [i for f in features_of(w) if (i := get(f)) is not None]
        if own:
            found.update(own)
            hits.add(w)
    return sorted(found), sum(w in hits for w in words) if hits else 0


def fit(rows: list[tuple[int, list[int]]], n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, cuts) of the model; rows are (grade, features)."""
    return fit_arrays(np.array([g for g, _ in rows]), np.array([len(f) for _, f in rows]),
                      np.array([i for _, f in rows for i in f], np.int64), n_features)


def fit_arrays(grade: np.ndarray, size: np.ndarray, col: np.ndarray, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, cuts) by gradient descent on the mean log loss of the thresholds; of every row the
    grade and the number of its features, which follow each other in ``col``."""
    rows = range(len(grade))
    row = np.repeat(np.arange(len(rows)), size)
    target = (grade[:, None] >= np.arange(1, 4)).astype(float)
    share = np.clip(target.mean(0), 1e-4, 1 - 1e-4)
    cuts, w = -np.log(share / (1 - share)), np.zeros(n_features)
    scale = 1 / np.sqrt(1 + np.bincount(col, minlength=n_features) / len(rows) * 50)
    speed_w, speed_c = np.zeros_like(w), np.zeros_like(cuts)
    for _ in range(STEPS):
        score = np.bincount(row, w[col], len(rows))
        error = 1 / (1 + np.exp(np.clip(cuts - score[:, None], -30, 30))) - target
        step_w = np.bincount(col, error.sum(1)[row], n_features) / len(rows) * 50 * scale ** 2 + DECAY * w
        speed_w = 0.9 * speed_w - RATE * step_w
        speed_c = 0.9 * speed_c + RATE * error.mean(0)
        w, cuts = np.maximum(w + speed_w, 0.0), np.maximum.accumulate(cuts + speed_c)
    return w, cuts


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label_key: str = "doc_id",
          label: str = "toxic", sample: int = SAMPLE, features: int = FEATURES) -> dict | None:
    """The model: index of the features, their weights, and the cuts."""
    small_batches(docs.sparkSession)
    texts = sample_texts(docs, labels, key, text, label_key, label, sample)
    index = select_features(texts, features)
    if not index:
        return None
    sent = texts.sparkSession.sparkContext.broadcast(index)

    def active(batches):
        for toxic, rows in text_slices(batches, "toxic", "text"):
            found = [active_features(x, sent.value) for x in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(toxic, pa.int32()), pa.array([n for _, n in found], pa.int64()),
                 pa.array([f for f, _ in found], pa.list_(pa.int32()))], ["toxic", "n", "features"])

    # at most two samples of rows, as Arrow columns
    rows = texts.select(F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(
        active, "toxic int, n long, features array<int>").toArrow().combine_chunks()
    sent.destroy()
    toxic, hits = (rows.column(c).to_numpy() for c in ("toxic", "n"))
    grade = np.where(toxic > 0, toxic + sum((hits >= m).astype(int) for m in GRADE_WORDS), 0)
    size = pc.list_value_length(rows.column("features")).to_numpy()
    col = pc.list_flatten(rows.column("features")).to_numpy().astype(np.int64)
    # in one order, whatever that of the rows: by grade, then features
    starts = np.concatenate(([0], np.cumsum(size)[:-1]))
    order = sorted(range(len(grade)), key=lambda i: (grade[i], col[starts[i]:starts[i] + size[i]].tobytes()))
    col = np.concatenate([col[starts[i]:starts[i] + size[i]] for i in order])
    weights, cuts = fit_arrays(grade[order], size[order], col, len(index))
    return {"index": index, "weights": weights, "cuts": cuts}


def severity(model: dict | None, text: bytes) -> float:
    if model is None:
        return 0.0
    score = math.fsum(model["weights"][active_features(text, model["index"])[0]])
    return math.fsum(1 / (1 + math.exp(min(500.0, c - score))) for c in model["cuts"])


def severity_of(spark: SparkSession, model: dict | None):
    """Column function: the expected severity of a text column."""
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def expected(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([severity(sent.value, (t or "").encode()) for t in texts], dtype="float64")

    return expected


def score(docs: DataFrame, model: dict | None, key: str = "doc_id", text: str = "text", reject: float = REJECT) -> DataFrame:
    """(key, severity, grade: the nearest one, rejected) of every row."""
    scored = docs.select(F.col(key).alias("key"), severity_of(docs.sparkSession, model)(F.col(text)).alias("severity"))
    return scored.select(F.col("key").alias(key), "severity", F.round("severity").cast("int").alias("grade"),
                         (F.col("severity") >= reject).alias("rejected"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
