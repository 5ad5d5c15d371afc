from trackwise.llm import url_filter as uf

RULES = [*uf.RULES, ("a.example.org", "", "allow"), ("example.org", "/en/12/", "allow"), ("org", "/x", "block"), ("org", "/x", "allow")]
URLS = ["http://EXAMPLE.org/es/1", "https://sub.example.org/en/1?q=/es/", "https://notexample.org/en/1", "ftp://example.com/fr/#x",
        "http://x.com/de/", "http://x.com/de", "no url", None, "", "://", "http://org", "http://org/", "http://a.example.org",
        "http://b.a.example.org/en/1", "http://example.org/en/12/3", "http://example.org/en/12", "http://q.org/xyz", "http://com/fr/a\nb",
        "http://x.org?/es/", "//x.org/", "http://a://b.org/x"]


def by_hand(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:cut].lower(), rest[cut:]
    path = tail[:min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
    fits = [(len(h), len(p), v == "block", h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


def test_trie_and_join_agree_with_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    want = {i: by_hand(u) for i, u in enumerate(URLS)}
    for bound in (uf.MAX_BROADCAST_RULES, 0):
        out = uf.filter_urls(df, RULES, broadcast_rules=bound).collect()
        assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out} == want
