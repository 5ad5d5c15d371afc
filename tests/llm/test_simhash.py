import random

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from trackwise.llm import simhash
from trackwise.llm.components import connected_components


def by_hand(text, n=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ").split(" ") if w]
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aBc \t\né", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) % (1 << 64) == by_hand(text)


def test_fingerprint_of_many_shingles():
    text = " ".join(random.Random(3).choice("ab cd ef gh ij".split()) for _ in range(900))
    assert simhash.fingerprint(text.encode()) % (1 << 64) == by_hand(text)


def groups(nodes, links):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize("bits,stride", [(3, 16), (1, 8), (4, 16)])
def test_trie_links_are_all_near_pairs(spark, bits, stride):
    rng = random.Random(bits)
    prints = set()
    for _ in range(40):                       # clusters, chains and strangers
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 6])):
            prints.add(x)
            for b in rng.sample(range(64), rng.randint(0, bits + 1)):
                x ^= 1 << b
    prints |= {0, (1 << 64) - 1, 1 << 63, (1 << 63) | 1}
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    leaves = spark.createDataFrame([(x, i) for i, x in enumerate(signed)], "fp long, id long")
    got = {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in simhash.trie_links(leaves, bits, stride).collect()}
    want = {(i, j) for i, x in enumerate(signed) for j, y in enumerate(signed) if i < j and ((x ^ y) & ((1 << 64) - 1)).bit_count() <= bits}
    assert got == want


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(300, 7), (5, 300), (9, 9)]
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    want = groups({x for e in links for x in e}, links)
    got = {r["node"]: r["component"] for r in connected_components(df, "a", "b").collect()}
    assert got == {n: c for n, c in want.items() if n != 9}


def test_empty_text_links_like_any_other(spark):
    docs = spark.createDataFrame([(3, None), (4, ""), (9, "one two three four")], "doc_id long, text string")
    out = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert out[3] == out[4] == ("0" * 16, 3) and out[9][1] == 9


def cluster(n, rng, dense):
    """Distinct fingerprints around one: within three bits of it, or each a bit or two from another."""
    found = [rng.getrandbits(64)]
    seen = set(found)
    while len(found) < n:
        x = found[0] if dense else rng.choice(found)
        for b in rng.sample(range(64), rng.randint(1, 3 if dense else 2)):
            x ^= 1 << b
        if x not in seen:
            seen.add(x)
            found.append(x)
    return [x - (1 << 64) if x >> 63 else x for x in found]


def test_node_pairs_of_a_cluster_grow_with_it(spark, monkeypatch):
    """Node pairs grow with the fingerprints and their links, not with all pairs of a cluster; groups are right."""
    made, lists, masks = [], simhash._by_lists, simhash._by_masks

    def counted(step):
        def run(*args):
            out = step(*args).cache()
            made.append(out.count())
            return out
        return run

    monkeypatch.setattr(simhash, "_by_lists", counted(lists))
    monkeypatch.setattr(simhash, "_by_masks", counted(masks))
    rows, sizes = [], []
    for n in (400, 1600):
        prints = cluster(n, random.Random(n), dense=True) + cluster(n, random.Random(n + 1), dense=False)
        prints = list(dict.fromkeys(prints))
        made.clear()
        got = {r["fp"]: r["group"] for r in simhash.fingerprint_groups(spark.createDataFrame([(x,) for x in prints], "fp long")).collect()}
        links = [(x, y) for i, x in enumerate(prints) for y in prints[i + 1:] if ((x ^ y) & ((1 << 64) - 1)).bit_count() <= 3]
        rows.append(sum(made))
        sizes.append((len(prints), len(links)))
        if n == 400:
            assert got == groups(prints, links)
    (n1, l1), (n2, l2) = sizes
    assert rows[1] <= 1.3 * rows[0] * max(n2 / n1, l2 / l1) and rows[1] < 0.05 * n2 * n2


def test_links_between_components_only(spark):
    leaves = spark.createDataFrame([(0, 0, 0), (1, 1, 0), (2, 2, 2), (4, 3, 3), (1 << 40, 4, 0)], "fp long, id long, component long")
    got = {frozenset((r["a"], r["b"])) for r in simhash.trie_links(leaves, 2).collect()}
    same = {frozenset((0, 1)), frozenset((0, 4)), frozenset((1, 4))}
    every = {frozenset((r["a"], r["b"])) for r in simhash.trie_links(leaves.drop("component"), 2).collect()}
    assert every - same == got and same <= every
