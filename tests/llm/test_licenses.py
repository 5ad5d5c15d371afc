from compare import diff, duck, run_oracle
from hypothesis import given, settings
from hypothesis import strategies as st

from trackwise.llm import licenses as li

A = st.lists(st.sampled_from("abc"), min_size=1, max_size=9).map(" ".join)


@settings(max_examples=120, deadline=None)
@given(st.lists(A, min_size=1, max_size=3), st.lists(A, min_size=1, max_size=2), st.lists(st.sampled_from("abcd"), max_size=30))
def test_places_and_maximal_matches(templates, phrases, words):
    auto = li.build_automaton([(str(i), t) for i, t in enumerate(templates)], [(p, p) for p in phrases])
    texts = [t.split() for t in (*templates, *phrases)]
    subs = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    places, matches = li.stream(auto, [w.encode() for w in words], min_match=1)
    want = sorted((i, p) for p in phrases for i in range(len(words)) if words[i:i + len(p.split())] == p.split())
    assert sorted(places) == want
    longest = [max((n for n in range(1, j + 1) if tuple(words[j - n:j]) in subs), default=0) for j in range(1, len(words) + 1)]
    ends = [(j, n) for j, n in enumerate(longest, 1) if n and (j == len(words) or longest[j] <= n)]
    assert [(j, n) for j, n, _ in matches] == ends


def test_spans_bridge_changed_words(spark):
    text = "Intro. Licensed under the Apache License, Version 2.0\n" + li.TEMPLATES[1][1].replace("copies of the Software", "COPIES of this Thing")
    rows = spark.createDataFrame([(1, text), (2, "no license at all"), (3, "General Public License")], "doc_id long, text string")
    out = {r["doc_id"]: r for r in li.scan(rows).collect()}
    spans = {s["label"]: max(x["coverage"] for x in out[1]["spans"] if x["label"] == s["label"]) for s in out[1]["spans"]}
    assert spans["apache"] == 1.0 and 0.9 < spans["mit"] < 1.0
    assert out[2]["spans"] == [] and [p["label"] for p in out[3]["places"]] == ["gpl"]


def test_a_run_that_stands_twice_in_a_template(spark):
    """Two of 24 words changed: one span of 22 / 24, whichever place of the repeated run comes first."""
    words = [f"w{i}" for i in range(24)]
    words[3:7] = words[15:19] = ["to", "do", "so", "as"]
    text = list(words)
    text[10] = text[21] = "other"
    rows = spark.createDataFrame([(1, " ".join(text)), (2, " ".join(words)), (3, " ".join(words[12:] + words[:12]))], "doc_id long, text string")
    out = {r["doc_id"]: [(s["word"], s["n_words"], round(s["coverage"], 4)) for s in r["spans"]]
           for r in li.scan(rows, templates=[("x", " ".join(words))], phrases=[]).collect()}
    assert out[1] == [(0, 21, round(20 / 24, 4))] or out[1] == [(0, 24, round(22 / 24, 4))]
    assert out[2] == [(0, 24, 1.0)] and sorted(out[3]) == [(0, 12, 0.5), (12, 12, 0.5)]


def plain_chain(templates, words, matches, min_match, max_gap):
    """Chains with the places of every match found by searching the templates."""
    spans = []
    for label, text in templates:
        t, c = text.split(), None
        for end, n, _ in matches:
            part = words[end - n:end]
            places = [i + n for i in range(len(t) - n + 1) if t[i:i + n] == part]
            if not places or n < min(min_match, len(t)):
                continue
            later = [p for p in places if c and p > c[2]]
            if later and end - n - c[1] <= max_gap and later[0] - n - c[2] <= max_gap:
                lap = max(0, c[1] - (end - n), c[2] - (later[0] - n))
                if lap < n:
                    c = (c[0], end, later[0], c[3] + n - lap)
                    continue
            if c:
                spans.append((label, c[0], c[1] - c[0], c[3] / len(t)))
            c = (end - n, end, places[0], n)
        if c:
            spans.append((label, c[0], c[1] - c[0], c[3] / len(t)))
    return sorted(spans)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=12).map(" ".join), min_size=1, max_size=3),
       st.lists(st.sampled_from("abcd"), max_size=30), st.integers(1, 4), st.integers(0, 3))
def test_chains_against_searched_places(templates, words, min_match, max_gap):
    named = [(f"{i}", t) for i, t in enumerate(templates)]
    auto = li.build_automaton(named, [])
    _, matches = li.stream(auto, [w.encode() for w in words], min_match)
    assert sorted(li.chain(auto, matches, min_match, max_gap)) == plain_chain(named, words, matches, min_match, max_gap)


def test_query(spark):
    """Base columns against SQL, the method's against the operator's spans."""
    sf = "/root/testdata/sf0.01"
    got = li.op8_license_scan(spark, sf).toPandas()
    assert diff(got[["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]], run_oracle(duck(sf), li.BASE_SQL)) == []
    assert got["n_base"].sum() > 5
    spans = {r["doc_id"]: r for r in li.scan(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    for r in got.itertuples():
        found = spans[r.doc_id]["spans"]
        assert r.score == max((s["coverage"] for s in found), default=0.0) and 0 <= r.score <= 1
        own = {s["label"] for s in found if s["coverage"] >= li.MIN_COVERAGE}
        assert r.labels == ",".join(sorted(own | set(filter(None, r.base_labels.split(",")))))
