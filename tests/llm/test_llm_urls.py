"""URL rules and path templates."""

import re

from marquee.llm.url_templates import Rule, filter_urls

RULES = [Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"), Rule("allow", "com/fr/"), Rule("block", "com/de/")]


def plain(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.rule), default=None)
    return host, path, best and best.rule, best and best.verdict


def pages(spark, urls):
    rows = [(i, u, "x", "y", 1) for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, rule string, n int")


def test_rules_and_odd_urls(spark):
    urls = [
        None, "", "no host", "http://", "http:///path", "HTTP://A.ORG/x", "http://org", "http://org/", "http://notorg/", "http://a.org?q#f",
        "http://a.org#f/x", "https://www.Example.org/es/1", "http://example.org/es", "http://example.org/en/12?x=://y", "http://example.org/en/2",
        "ftp://É.com/fr/é", "http://x.com/de/", "http://x.com/DE/", "http://a://b/c", "http://u:p@h.com:80/fr/1", "http://h.org/" + "s/" * 3000,
        "http://line.org/a\nb?c\nd", "http://x.com/fr/1", "http://x.com/fr/1",
    ]
    found = {r.page_id: r for r in filter_urls(pages(spark, urls), RULES).collect()}
    assert len(found) == len(urls)
    for i, url in enumerate(urls):
        host, path, rule, verdict = plain(url, RULES)
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule), url
        assert found[i].verdict == verdict if verdict else found[i].verdict in ("allow", "block")


def test_templates_carry_labels_over(spark):
    urls = [f"http://s.test/bad/{i}" for i in range(60)] + [f"http://s.test/good/{i}" for i in range(60)]
    urls += [f"http://s.test/bad/new/{i}" for i in range(3)]
    rules = [Rule("block", f"s.test/bad/{i}") for i in range(1, 6)] + [Rule("allow", f"s.test/good/{i}") for i in range(1, 6)]
    rows = filter_urls(pages(spark, urls), rules).collect()
    verdicts = {r.page_id: r.verdict for r in rows}
    templates = {r.page_id: r.template for r in rows}
    assert templates[0] == "s.test/bad/*" and templates[60] == "s.test/good/*"
    assert verdicts[0] == "block" and verdicts[60] == "allow"
    assert len({t for t in templates.values()}) == 3


def test_branches_that_cannot_be_told_apart_are_merged(spark):
    urls = [f"http://s.test/{section}/{i}" for section in ("a", "b", "c") for i in range(40)]
    rules = [Rule("allow", f"s.test/{section}/{d}") for section in ("a", "b") for d in (1, 2)]
    rules += [Rule("block", f"s.test/{section}/3") for section in ("a", "b")]
    rows = filter_urls(pages(spark, urls), rules).collect()
    assert {r.template for r in rows} == {"s.test/*/*"}


def test_an_empty_table(spark):
    assert filter_urls(pages(spark, []), RULES).collect() == []
    (row,) = filter_urls(pages(spark, ["http://h/x"]), []).collect()
    assert (row.rule, row.verdict) == (None, "allow")


def test_query_against_plain_rules(spark):
    from marquee.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url").collect()}
    rows = QUERIES["op1_urls"](spark, folder).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path, rule, verdict = plain(urls[r.page_id], RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")


def test_a_literal_star_is_no_wildcard(spark):
    urls = [f"http://s.test/*/{i}" for i in range(40)] + [f"http://s.test/x{i}/{i}" for i in range(40)]
    rules = [Rule("block", f"s.test/*/{i}") for i in range(1, 6)] + [Rule("allow", f"s.test/x{i}/") for i in range(1, 6)]
    rows = filter_urls(pages(spark, urls), rules).collect()
    assert {(r.template, r.verdict) for r in rows if r.rule is None} == {("s.test/\\*/*", "block"), ("s.test/*/*", "allow")}


def test_deep_urls_are_told_apart(spark):
    deep = "/".join("abcdefghij")
    urls = [f"http://s.test/{deep}/{side}/{i}" for side in ("good", "bad") for i in range(30)] + ["http://s.test/" + "z/" * 40]
    rules = [Rule("block", f"s.test/{deep}/bad/{i}") for i in range(1, 5)] + [Rule("allow", f"s.test/{deep}/good/{i}") for i in range(1, 5)]
    rows = filter_urls(pages(spark, urls), rules).collect()
    for r in rows[:-1]:
        assert r.verdict == ("block" if "/bad/" in r.path else "allow")
    assert max(r.template.count("/") for r in rows) == 41
