import corpus_pipeline as cp
from trackwise.llm import decontaminate, simhash, toxicity
from trackwise.llm.batches import documents, through_table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs, columns = documents(spark, SF), documents(spark, SF).columns
    tables = {"documents": docs}
    for name, stage in cp.STAGES:
        docs = tables[name] = through_table(stage(spark, docs, SF), name)
    assert [n for n, _ in cp.STAGES] == ["toxicity", "simhash", "decontamination", "pii", "packing"]
    ids = {n: {r[0] for r in t.select("doc_id").collect()} for n, t in tables.items()}
    assert all(tables[n].columns == columns for n in ("toxicity", "simhash", "decontamination", "pii"))
    model = toxicity.train(tables["documents"], spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids["toxicity"] == {r["doc_id"] for r in toxicity.score(tables["documents"], model).where("NOT rejected").collect()}
    groups = simhash.near_duplicates(tables["toxicity"]).collect()
    assert ids["simhash"] == {r["component_id"] for r in groups}
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    found = decontaminate.find_contamination(tables["simhash"], bench).collect()
    assert ids["decontamination"] == {r["doc_id"] for r in found if not r["windows"]}
    assert ids["pii"] == ids["packing"] == ids["decontamination"]
    assert tables["pii"].where("n_chars != length(text)").count() == 0


def test_null_ids_and_repeated_rows(spark):
    rows = [(1, "one two three four five", "en", "s", 3), (1, "one two three four five", "en", "s", 3), (None, "x", "en", "s", 1), (2, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = cp.simhash_stage(spark, df, SF).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "2", "None"]
    assert len(cp.decontamination_stage(spark, df, SF).collect()) == 4
    assert len(cp.pii_stage(spark, df, SF).collect()) == 4
    assert len(cp.toxicity_stage(spark, df, SF).collect()) == 4


def test_near_duplicates_with_null_and_repeated_ids(spark):
    a, b, c = "one two three four five", "a text that is quite another one", "what nobody else has said so far"
    rows = [(3, a), (1, a), (1, b), (None, a), (None, c), (None, c), (2, b)]
    df = spark.createDataFrame([(i, t, "en", "s", 3) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = cp.simhash_stage(spark, df, SF).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == sorted([("1", a), ("1", b), ("None", c)])


def test_further_columns_of_any_name_and_type(spark):
    """Names that the stages use inside, a name with a dot, and a map, which has no order."""
    a, b = "one two three four five", "a text that is quite another one"
    rows = [(1, a), (1, a), (2, a), (3, b), (None, b), (None, "what nobody else has said so far"), (None, "what nobody else has said so far")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("bad", "row key", "key", "row", "id", "hash", "fp", "group", "first", "n", "kept_id", "n_entities", "a.b"):
        df = df.selectExpr("*", f"'other' AS `{c}`")
    df = df.selectExpr("*", "map('k', 1) AS tags")
    kept = cp.simhash_stage(spark, df, SF)
    assert kept.columns == df.columns
    got = kept.collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted([("1", a), ("3", b), ("None", rows[-1][1])])
    assert all(r["bad"] == r["row key"] == r["a.b"] == "other" and r["tags"] == {"k": 1} for r in got)
    for stage in (cp.toxicity_stage, cp.decontamination_stage, cp.pii_stage):
        out = stage(spark, df, SF)
        assert out.columns == df.columns and out.count() == len(rows)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    mixed = df.unionByName(df.limit(1).selectExpr("99L AS doc_id", f"{bench!r} AS text", *[f"`{c}`" for c in df.columns if c not in ("doc_id", "text")]))
    assert 99 not in {r["doc_id"] for r in cp.decontamination_stage(spark, mixed, SF).collect()}
