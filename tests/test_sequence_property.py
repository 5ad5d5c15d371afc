"""Run stencils against a brute-force run-length count on random sequences."""

import random

import pytest
from pyspark.sql import Window

from trackwise.operators.sequence import filtered_run_start, in_run_at_least, run_start_at_least


def runs(seq):
    """Maximal runs as (value, start, length); None is its own value (breaks runs)."""
    out, i = [], 0
    while i < len(seq):
        j = i
        while j + 1 < len(seq) and seq[j + 1] == seq[i] and seq[i] is not None:
            j += 1
        out.append((seq[i], i, j - i + 1))
        i = j + 1
    return out


def seqs(seed, groups=6, n=40):
    rnd = random.Random(seed)
    return {g: [rnd.choice(["R", "R", "L", "N", None]) for _ in range(rnd.randint(1, n))]
            for g in range(groups)}


@pytest.mark.parametrize("k", [1, 2, 3, 4])
def test_state_runs_match_brute_force(spark, k):
    data = seqs(k)
    df = spark.createDataFrame([(g, i, s) for g, ss in data.items() for i, s in enumerate(ss)],
                               "g int, t int, s string")
    w = Window.partitionBy("g").orderBy("t")
    got = df.select("g", "t", in_run_at_least("s", "R", k, w).alias("inr"),
                    run_start_at_least("s", "R", k, w).alias("st")).collect()
    got_in = {(r["g"], r["t"]) for r in got if r["inr"]}
    got_st = {(r["g"], r["t"]) for r in got if r["st"]}
    want_in, want_st = set(), set()
    for g, ss in data.items():
        for v, start, length in runs(ss):
            if v == "R" and length >= k:
                want_st.add((g, start))
                want_in.update((g, start + d) for d in range(length))
    assert got_in == want_in and got_st == want_st


@pytest.mark.parametrize("k", [1, 2, 3])
def test_filtered_runs_match_brute_force(spark, k):
    rnd = random.Random(100 + k)
    data = {g: [rnd.choice([None, None, 0, 0, 1, 2]) for _ in range(rnd.randint(1, 50))]
            for g in range(6)}
    df = spark.createDataFrame([(g, i, b) for g, bs in data.items() for i, b in enumerate(bs)],
                               "g int, t int, b int")
    w = Window.partitionBy("g").orderBy("t")
    rows = df.select("g", "b", filtered_run_start("b", k, w).alias("st")).where("st").collect()
    got = {}
    for r in rows:
        got[(r["g"], r["b"])] = got.get((r["g"], r["b"]), 0) + 1
    want = {}
    for g, bs in data.items():
        sub = [b for b in bs if b is not None]          # filter first, then run-length
        for v, _, length in runs(sub):
            if length >= k:
                want[(g, v)] = want.get((g, v), 0) + 1
    assert got == want
