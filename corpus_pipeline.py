"""Corpus pipeline: toxicity, near-duplicates, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's docs; all but the last return the
columns of ``documents``. Rows are told apart by their id and 128 bits of the text's
SHA-256. Stage 2 groups rows by their texts, whether an id is null or repeated, and keeps
one row of each group: that of the smallest id (a null id comes after all others), in a
tie of the smallest hash; of rows with the same id and text that of the smallest JSON.
Null texts are kept until they are packed. Empty tables pass through; further columns of
any type and name are carried along (rows travel as one struct); long texts are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackwise.llm import decontaminate, packing, pii, simhash, toxicity
from trackwise.llm.batches import documents, through_table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity stays below the operator's limit."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.severity_of(spark, model)(F.col("text")) < toxicity.REJECT)


def _text_hash():
    """128 bits of the text's SHA-256; a null text has none."""
    return F.coalesce(F.substring(F.sha2(F.col("text").cast("binary"), 256), 1, 32), F.lit(""))


def _rows(docs: DataFrame) -> DataFrame:
    """(id, hash, row): whole rows beside what tells them apart."""
    return docs.select(F.col("doc_id").alias("id"), _text_hash().alias("hash"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))


def _unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*(F.col("row")[c].alias(c) for c in columns))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group (3-word shingles, at most 3 differing bits)."""
    own = docs.select(F.struct(F.col("doc_id").alias("id"), _text_hash().alias("hash")).alias("key"), "text")
    prints = through_table(simhash.fingerprints(own, "key", "text", simhash.SHINGLE), "fingerprints")
    groups = simhash.fingerprint_groups(through_table(prints.select("fp").distinct(), "leaves"), simhash.MAX_BITS)
    rows = prints.groupBy("key", "fp").agg(F.count("*").alias("n")).join(groups, "fp")
    first = rows.groupBy("group").agg(F.min(F.struct(F.col("key.id").isNull(), "key.id", "key.hash", "n")).alias("first"))
    chosen = through_table(first.select(F.col("first.id").alias("kept_id"), F.col("first.hash").alias("kept_hash"), F.col("first.n").alias("n")), "chosen")

    def of(keys: DataFrame) -> DataFrame:
        return _rows(docs).join(keys, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash")), "left_semi")

    repeated = chosen.where("n > 1")
    if repeated.isEmpty():
        return _unpacked(of(chosen), docs.columns)
    once = of(repeated).groupBy("id", "hash").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return _unpacked(of(chosen.where("n = 1")).select("row").unionByName(once.select("row")), docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    own = F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), _text_hash())
    keyed = docs.select(own.alias("key"), "text")
    found = decontaminate.find_contamination(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), key="key")
    bad = found.where(F.size("windows") > 0).select(F.col("key").alias("bad"))
    same = F.concat_ws("/", F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("hash")) == F.col("bad")
    return _unpacked(_rows(docs).join(bad, same, "left_anti"), docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates."""
    packed = docs.select("doc_id", "text", F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    clean = pii.pseudonymise(packed, count="n_entities")
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
    return clean.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash", simhash_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: a fitted model, hashes over joins and a tokenizer: not SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = through_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
