import random
import re

from trackwise.llm import decontaminate as dc


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def by_hand(docs, items, window=10):
    grams = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            grams.setdefault(tuple(w[k:k + window]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for g, ids in grams.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit.update(range(k, k + len(g)))
                    found |= ids
        out.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=str)


def test_against_brute_force_in_one_and_many_blocks(spark):
    rng = random.Random(5)
    vocab = ["ab", "Cd", "é", "x1", "of", "the", "rare"]
    items = [(rng.choice([k, k, None]), " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 3, 9, 10, 25])))) for k in range(30)]
    docs = [(k, " , ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60))) + (" " + items[k % 30][1]) * (k % 3)) for k in range(60)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = by_hand(docs, items)
    for size in (1 << 20, 150):
        out = dc.find_contamination(d, b, block_bytes=size).selectExpr("doc_id", "n_words", dc.N_HIT + " AS hit", "items").collect()
        assert sorted((tuple(r) for r in out), key=str) == want


def test_repeated_rows_long_items_and_many_words(spark, monkeypatch):
    """A third of the benchmark is one row, one item is cut into pieces, a block is halved."""
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(300)]
    long = " ".join(rng.choice(vocab) for _ in range(2_000))
    items = [(k, " ".join(rng.choice(vocab) for _ in range(14))) for k in range(10)] + [(50 + k, items0) for k in range(8) for items0 in ["one and the same row"]]
    items += [(99, long), (None, long), (98, "w1")]
    part = long.split()
    docs = [(1, " ".join(part[95:107])), (2, " ".join(part[1_985:])), (3, " ".join(part[:9]) + " x"), (4, "it is one and the same row"),
            (5, items[3][1] + " " + items[4][1]), (6, " ".join(part[395:410])), (7, None)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = by_hand(docs, items)
    halved = []
    real = dc._block_matches
    monkeypatch.setattr(dc, "_block_matches", lambda *a: halved.append(1) or real(*a))
    for bits, pieces in ((21, 100), (8, 100)):
        monkeypatch.setattr(dc, "ID_BITS", bits)
        halved.clear()
        out = dc.find_contamination(d, b, piece_words=pieces).selectExpr("doc_id", "n_words", dc.N_HIT + " AS hit", "items").collect()
        assert sorted((tuple(r) for r in out), key=str) == want
    assert len(halved) > 1


def test_null_item_ids_as_in_sql(spark):
    import duckdb
    docs, items = [(1, "a b c d"), (2, "x")], [(None, "a b"), (7, "c d"), (None, "c d")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    want = {r[0]: r[2:4] for r in con.execute(dc.OP3_SQL).fetchall()}
    out = dc.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r["doc_id"]: (r["hit"], r["n"]) for r in out.selectExpr("doc_id", dc.N_HIT + " AS hit", "cast(size(items) AS long) AS n").collect()} == want
    assert want == {1: (4, 1), 2: (0, 0)}
