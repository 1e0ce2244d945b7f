"""URL rules through the token index against trying every rule."""

import random

import duckdb
import pytest

from strata.llm import queries, urls

RULES = [urls.host_path_rule(r, v) for r, v in queries.URL_RULES]
FALLBACK = [urls.host_word_rule(w) for w in urls.HOST_WORDS]


@pytest.mark.parametrize(
    "url, host, path",
    [
        (None, "", ""), ("", "", ""), ("no scheme/x", "", ""), ("http://", "", ""), ("http://A.Net", "a.net", ""),
        ("https://ÄB.com:80/P/q?x#y", "Äb.com:80", "/P/q"), ("x://h?q/p", "h", ""), ("x://h#f", "h", ""),
        ("a://b/c://d", "b", "/c://d"), ("://h/p", "h", "/p"),
    ],
)
def test_split(url, host, path):
    assert urls.split_url(url) == (host, path)


@pytest.mark.parametrize(
    "url, rule, verdict",
    [
        ("http://x.net/", "net/", "block"), ("http://net/a", "net/", "block"), ("http://x.net", None, "allow"),
        ("http://planet/", None, "allow"), ("http://a.example.net/en/1", "example.net/en/", "allow"),
        ("http://example.net/EN/1", "net/", "block"), ("http://example.net/en", "net/", "block"),
        ("http://example.com/de/9", "example.com/de/", "block"), ("http://notexample.com/de/9", None, "allow"),
        ("http://w.org/fr/", "org/fr/", "allow"), ("http://free-bets.org/fr/", "org/fr/", "allow"),
        ("http://m.free-bets.example.com/en/", None, "block"), ("http://cheap-pills-2.example.com/", None, "block"),
        ("http://alphabets.example.com/bets", None, "allow"), ("http://spam-links.com", None, "block"), ("http://casino.example.com/x", None, "block"), (None, None, "allow"), ("junk", None, "allow"),
    ],
)
def test_verdicts(spark, url, rule, verdict):
    row = urls.judge_urls(spark.createDataFrame([(1, url)], "page_id long, url string"), RULES, FALLBACK).first()
    assert (row.rule, row.verdict) == (rule, verdict)


def test_index_misses_no_rule():
    rng = random.Random(6)
    labels, words = ["a", "bb", "c1", "ad", "net", "x-y"], ["/", "/en/", "/en/b", "/q.", ""]

    def host():
        return ".".join(rng.choice(labels) for _ in range(rng.randint(1, 3)))

    rules = [urls.host_path_rule(host() + rng.choice(words), rng.choice(["allow", "block"])) for _ in range(200)]
    rules += [urls.host_word_rule("ad"), urls.Rule("any", "block", "b+"), urls.Rule("sub", "block", r"\bnet\b", ("net",))]
    index = urls.RuleIndex(rules)
    assert [r.name for r in index.always] == ["any"] or all(not r.tokens for r in index.always)
    for _ in range(3000):
        h, p = host(), rng.choice(words) + rng.choice(["", "b", "en/bb", "Z"])
        want = sorted(r.name for r in rules if r.compiled.search(h + p))
        assert sorted(r.name for r in index.fitting(h, p)) == want


@pytest.mark.parametrize(
    "line, fits, misses",
    [
        ("||ads.example.com^", ["ads.example.com", "x.ads.example.com/a", "ads.example.com:80/"], ["badads.example.com", "ads.example.com.evil.net", "x.net/ads.example.com"]),
        ("||example.com/banner/*/img^", ["example.com/banner/7/img", "a.example.com/BANNER/x/y/img?"], ["example.com/banner/img", "example.com/banner/7/images"]),
        ("/ad-frame/*", ["x.net/ad-frame/1", "x.net/ad-frame/"], ["x.net/ad-frame"]),
        ("|start.example", ["start.example/x"], ["a.start.example"]),
        ("swf|", ["x.net/a.swf"], ["x.net/a.swf/b"]),
        ("-track*pixel", ["x.net/-track/1pixel", "x.net/-trackpixels"], ["x.net/track-pixel"]),
        (r"/banner\\d+\\.gif/", ["x.net/banner12.gif"], ["x.net/banner.gif"]),
    ],
)
def test_filter_lines(line, fits, misses):
    line = line.replace("\\\\", "\\")
    for text, verdict in ((line, "block"), ("@@" + line, "allow")):
        rule = urls.filter_rule(text)
        index = urls.RuleIndex([rule])
        assert rule.verdict == verdict and rule.name == text
        for url in fits:
            host, slash, path = url.partition("/")
            assert index.fitting(host, slash + path) == [rule], url
        for url in misses:
            host, slash, path = url.partition("/")
            assert not index.fitting(host, slash + path), url


def test_lines_without_a_rule(spark):
    lines = ["", "! note", "[Adblock Plus 2.0]", "example.com##.ad", "||a.b^$third-party", "@@", "/[/", None, "||x.y^", "||x.y^"]
    rules = urls.read_rules(spark.createDataFrame([(x,) for x in lines], "line string"))
    assert [r.name for r in rules] == ["||x.y^"]
    with pytest.raises(ValueError, match="bytes of rules"):
        urls.read_rules(spark.createDataFrame([("||x.y^",)], "line string"), max_bytes=3)


def test_of_very_many_rules_only_candidates_run():
    rng = random.Random(10)
    name = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    hosts = [f"{name()}.{name()}.example" for _ in range(100_000)]
    index = urls.RuleIndex([urls.filter_rule(f"||{h}^") for h in hosts])
    assert not index.always
    tried = [len(index.candidates(f"www.{h}/some/example/path")) for h in hosts[:2000]]
    assert max(tried) <= 20 and sum(tried) <= 3 * len(tried)
    assert all(r.name == f"||{h}^" for h in hosts[:200] for r in index.fitting(f"www.{h}", "/x"))


def test_odd_tables(spark):
    schema = "url string, host string, verdict int, _url string"
    rows = [("http://x.net/", "old", 3, "z"), (None, None, None, None), ("http://x.net/", "old", 3, "z")]
    out = urls.judge_urls(spark.createDataFrame(rows, schema), RULES, FALLBACK)
    assert out.columns == ["url", "_url", "host", "path", "rule", "verdict"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [("http://x.net/", "z", "x.net", "/", "net/", "block")] * 2 + [(None, None, "", "", None, "allow")], key=str
    )
    assert urls.judge_urls(spark.createDataFrame([], schema), RULES, FALLBACK).count() == 0
    with pytest.raises(ValueError):
        urls.host_path_rule("net/", "maybe")


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
    names = ["page_id", "host", "path", "rule", "verdict"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({queries.ORACLES['op6_url_filters']})").fetchall()
    got = [tuple(r) for r in queries.op6_url_filters(spark, sf).select(*names).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and {v for *_, v in got} == {"allow", "block"}
