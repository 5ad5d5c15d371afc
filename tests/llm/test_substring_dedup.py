import random

from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np

from trackwise.llm import substring_dedup as sd


def by_hand(rows, window):
    """(n_words, n_removed, kept) per row."""
    words = [(i, (t or "").split()) for i, t in rows]
    first = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - window + 1):
                g = tuple(w[k:k + window])
                first[g] = min(i, first.get(g, i))
    out = []
    for i, w in words:
        cut = {p for k in range(len(w) - window + 1) if i is not None and first[tuple(w[k:k + window])] < i for p in range(k, k + window)}
        out.append((i, len(w), len(cut), " ".join(x for p, x in enumerate(w) if p not in cut)))
    return sorted(out, key=str)


def made_up(seed, window):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(rng.choice([2, 5, 60]))]
    passages = [[rng.choice(vocab) for _ in range(rng.randint(window - 1, 4 * window))] for _ in range(5)]
    rows = []
    for i in range(40):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += rng.choice([rng.choice(passages), [rng.choice(vocab)] * rng.randint(1, 3 * window),
                                 [rng.choice(vocab) for _ in range(rng.randint(1, window))]])
        rows.append((rng.choice([i, i, 3, None]), rng.choice([" ".join(parts), None if not parts else " ".join(parts)])))
    return rows


def test_against_brute_force(spark):
    for seed, window in ((1, 5), (2, 12), (3, 50)):
        rows = made_up(seed, window)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = sorted((tuple(r) for r in sd.remove_repeats(df, window=window).collect()), key=str)
        assert got == by_hand(rows, window), (seed, window)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=12, max_size=60), st.integers(0, 20), st.integers(0, 20))
def test_equal_windows_hold_equal_stable_symbols(core, before, after):
    """A window between different contexts has the same stable symbols at the same places."""
    rng = random.Random(before * 31 + after)
    left, right = [rng.randint(1, 3) for _ in range(before)], [rng.randint(1, 3) for _ in range(after)]
    n = len(core)

    def inside(words, start):
        parse = sd.Parse(sd.mix(np.array(words, np.uint64)) | np.uint64(1), np.array([len(words)]))
        return {(int(a), int(lo) - start, int(hi) - start) for a, lo, hi in zip(parse.name, parse.lo, parse.hi)
                if lo >= start and hi <= start + n}

    a, b = inside(left + core + right, len(left)), inside(right + core + left, len(right))
    assert a == b
