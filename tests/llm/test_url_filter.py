import pytest
from pyspark.sql import functions as F

from tracknet.llm import url_filter as U

RULES = [U.Rule("allow", "org/"), U.Rule("block", "example.org/es/"), U.Rule("block", "example.org/en/1"), U.Rule("allow", "com/fr/"), U.Rule("block", "com/de/")]
URLS = [
    "http://Sub.Example.ORG/en/12?x", "https://example.org/es/", "https://example.org/es", "http://notexample.org/es/1", "http://a.com/de/x#f",
    "http://a.com/DE/x", "http://com/fr/", "http://xcom/fr/", "http://a.com?/de/", None, "no scheme", "", "x://", "a://b://c/d", "http://listed.net/p/",
    "https://www.LISTED.net/p?utm_source=a&ref=b", "http://listed.net/p?b=2&a=1", "http://listed.net/p?a=1&b=2#z", "http://listed.net/other",
    "http://É.org/es/", "http://h.org\n/en/1",
]


def expected_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.partition("://")[2]
    ends = [rest.index(c) for c in "/?#" if c in rest]
    cut = min(ends, default=len(rest))
    path = rest[cut:]
    stop = min([path.index(c) for c in "?#" if c in path], default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), path[:stop]


def expected_rule(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


@pytest.mark.parametrize("broadcast_mb,bits", [(32, 16), (0, 16), (32, 1)])
def test_verdicts_match_brute_force(spark, broadcast_mb, bits):
    pages = spark.createDataFrame([(i, u, "<p>", "org/") for i, u in enumerate(URLS)], "page_id long, url string, html string, rule string")
    listed = spark.createDataFrame([("https://listed.net/p/",), ("http://listed.net/p?a=1&b=2",), (None,), ("junk",)] + [(f"http://many.net/{i}",) for i in range(400)], "url string")
    got = {r.page_id: r for r in U.judge_urls(pages, listed, RULES, broadcast_mb=broadcast_mb, bits_per_key=bits).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = expected_parts(url)
        rule = expected_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule.text if rule else None), url
        blocked = url is not None and "listed.net/p" in url.lower()
        assert got[i].verdict == (rule.verdict if rule else "block" if blocked else "allow"), url


def test_canonical_form(spark):
    rows = spark.createDataFrame([(u,) for u in URLS[14:18]], "url string").select(U.canonical_url(F.col("url")).alias("c")).collect()
    assert [r.c for r in rows] == ["listed.net/p", "listed.net/p", "listed.net/p?a=1&b=2", "listed.net/p?a=1&b=2"]


def test_empty_tables_repeated_rows_and_empty_list(spark):
    none = spark.createDataFrame([], "url string")
    empty = spark.createDataFrame([], "page_id long, url string")
    assert U.judge_urls(empty, none, RULES).collect() == []
    twice = spark.createDataFrame([(1, "http://listed.net/p"), (1, "http://listed.net/p"), (None, None)], "page_id long, url string")
    got = U.judge_urls(twice, none, RULES).collect()
    assert len(got) == 3 and {r.verdict for r in got} == {"allow"}


def test_filter_never_misses_a_listed_key(spark):
    keys = spark.range(3000).selectExpr("concat('k', id) AS k")
    blocks = 1 << 6
    hits = U.possible_hits(spark.range(9000).selectExpr("concat('k', id) AS k"), "k", U.bloom_blocks(keys, "k", blocks), blocks, True)
    found = {r.k for r in hits.collect()}
    assert {f"k{i}" for i in range(3000)} <= found


def test_too_many_rules_are_refused(spark):
    with pytest.raises(ValueError):
        U.matching_rule(None, None, [U.Rule("allow", f"h{i}/") for i in range(U.MAX_RULES + 1)])
