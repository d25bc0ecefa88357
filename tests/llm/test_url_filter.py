from trestle.llm import url_filter
from trestle.llm.queries import ORACLE_SQL, QUERIES, URL_RULES

RULES = [*URL_RULES, ("a.example.net/", "block"), ("example.net/x/y", "allow"), ("example.net/x/y", "block"),
         ("net/é", "block"), (None, "block"), ("noslash", "block")]
URLS = [None, "", "nothing", "http://", "https://EXAMPLE.org/es/1", "http://www.example.org/en/12", "http://example.org/en/2",
        "http://badexample.org/es/1", "ftp://x.com/fr/", "ftp://x.com/de", "ftp://x.com/de/?q#f", "http://example.org?x=/es/",
        "http://a.example.net/x/y", "http://example.net/x/yz#t", "http://net/été", "http://com/de/://x.org/",
        "http://user@example.org:80/es/", "http://Éx.COM/de/", "http://org./es/", "http://x.org/" + "p" * 60_000]


def reference(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        k = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:k])
        path = rest[k:].split("?")[0].split("#")[0]
    fits = []
    for rule, verdict in rules:
        if rule and "/" in rule:
            h, p = rule.split("/", 1)
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fits.append((len(rule), rule, verdict))
    best = max(fits, key=lambda x: x[:2], default=None)
    if best is None:
        return host, path, None, "allow"
    return host, path, best[1], min(v for r, v in rules if r == best[1])


def judged(spark, limit):
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    pages = spark.createDataFrame([(i, u, "x", "y", None) for i, u in enumerate(URLS + URLS[4:5])],
                                  "page_id long, url string, rule string, host string, html string")
    got = url_filter.judge(pages, rules, max_index_bytes=limit)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    return sorted(map(tuple, got.collect()))


def test_both_paths_against_plain_python(code):
    want = sorted((i, *reference(u, RULES)) for i, u in enumerate(URLS + URLS[4:5]))
    assert judged(code, url_filter.MAX_INDEX_BYTES) == want
    assert judged(code, 0) == want


def test_many_rules_over_many_ranges(code):
    rules = [(f"h{i % 400}.example.{('org', 'com')[i % 2]}/{'p' * (i % 7)}{i}", ("allow", "block")[i % 3 == 0]) for i in range(3000)]
    urls = [f"http://www.{rule}/x" for rule, _ in rules[::3]] + ["http://h1.example.com/"] * 500
    pages = code.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_filter.judge(pages, code.createDataFrame(rules, "rule string, verdict string"), max_index_bytes=10_000)
    assert got.count() == len(urls)
    best = {r: v for r, v in rules}
    for r in got.collect():
        want = max((x for x in best if urls[r["page_id"]][11:].startswith(x)), key=len, default=None) \
            if r["page_id"] < 1000 else None
        assert (r["rule"], r["verdict"]) == (want, best.get(want, "allow"))


def test_no_rules_and_no_pages(code):
    none = code.createDataFrame([], "rule string, verdict string")
    pages = code.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [tuple(r) for r in url_filter.judge(pages, none).collect()] == [(1, "a.org", "/", None, "allow")]
    rules = code.createDataFrame(RULES, "rule string, verdict string")
    assert url_filter.judge(pages.filter("false"), rules).count() == 0


def test_equal_digests_are_told_apart_by_the_string(code):
    index = url_filter.build_index(code.createDataFrame(list(URL_RULES), "rule string, verdict string"))
    import numpy as np

    n = len(URL_RULES)
    same = np.full(n, np.frombuffer(index.digests, "<i8")[2])
    clash = url_filter.Index(same.tobytes(), index.strings, index.borders, index.verdicts, index.path_lengths)
    borders = np.frombuffer(index.borders, "<i8")
    third = index.strings[borders[2]:borders[3]]
    assert clash.find([third, b"other"]).tolist() == [2, -1]


def test_query_against_sql(code, duck):
    got = QUERIES["op5_url_filter"](code, "/root/testdata/sf0.001")
    want = duck.execute(ORACLE_SQL["op5_url_filter"])
    columns = [d[0] for d in want.description]
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, want.fetchall()))
