"""URL verdicts against matching every rule on every URL."""

import re

from tallyloom.llm.url_filter import DEFAULT_VERDICT, PATTERN_RULES, SITE_RULES, Rule, judge_urls

URLS = [
    None,
    "",
    "no scheme",
    "http://example.net/en/1",
    "http://EXAMPLE.net/en/1?x#y",
    "http://example.net/EN/1",
    "http://notexample.net/en/",
    "https://a.b.example.com/de/x",
    "https://example.com/den",
    "https://example.com/de",
    "http://x.org/fr/page",
    "http://x.org",
    "http://x.net",
    "http://x.net/",
    "http://x.net:80/",
    "http://évilnet/",
    "http://net/login/",
    "http://x.io/login/now",
    "http://x.io/cart/1\n2/checkout/",
    "http://x.io/ads",
    "http://x.io/ads/",
    "a://b://example.net/en/",
    "http://x.net/\u00e9",
] * 2


def expected(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    raw = re.match(r"[^/?#]*", rest).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
    path = re.match(r"[^?#]*", rest[len(raw) :]).group()
    best = None
    for rule in SITE_RULES:
        name, _, tail = rule.pattern.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            if best is None or len(rule.pattern) > len(best.pattern):
                best = rule
    if best:
        return host, path, best.pattern, best.verdict
    for rule in PATTERN_RULES:
        if re.search(rule.regex(), host + path):
            return host, path, None, rule.verdict
    return host, path, None, DEFAULT_VERDICT


def test_against_all_rules(spark):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, rule string, target string")
    out = judge_urls(pages).collect()
    assert len(out) == len(URLS)
    for r in out:
        assert (r.host, r.path, r.rule, r.verdict) == expected(r.row.url), r


def test_empty_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://x.net/")], "page_id bigint, url string")
    assert judge_urls(pages.limit(0)).collect() == []
    assert judge_urls(pages, site_rules=(), pattern_rules=()).first().verdict == DEFAULT_VERDICT


def test_tokens_that_may_be_cut_do_not_index_a_rule():
    assert Rule("block", "shop.example/sale").tokens() == ["shop", "example"]
    assert Rule("block", "ad*/banner/*x", anchored=False).tokens() == ["banner"]
    assert Rule("block", "ads", anchored=False).tokens() == []


def test_rule_without_tokens_still_applies(spark):
    pages = spark.createDataFrame([(1, "http://x.io/superads")], "page_id bigint, url string")
    rules = (Rule("block", "ads", anchored=False),)
    assert judge_urls(pages, pattern_rules=rules).first().verdict == "block"


def test_thousands_of_rules(spark):
    site = [Rule("block" if i % 3 else "allow", f"site{i}.com/{'en/' if i % 2 else ''}") for i in range(4000)]
    patterns = [Rule("block", f"/x{i}/*/end{i % 7}/", anchored=False) for i in range(1000)]
    urls = [f"http://www.site{i * 13 % 5000}.com/{'en/' if i % 3 else ''}p{i}" for i in range(300)]
    urls += [f"https://other.org/x{i * 7}/mid/end{i * 7 % 7}/" for i in range(200)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")

    def plain(url):
        target = url.partition("://")[2]
        fits = [r for r in site if target.startswith(r.pattern) or target.startswith("www." + r.pattern)]
        if fits:
            best = max(fits, key=lambda r: len(r.pattern))
            return best.pattern, best.verdict
        return None, next((r.verdict for r in patterns if re.search(r.regex(), target)), DEFAULT_VERDICT)

    out = judge_urls(pages, site_rules=site, pattern_rules=patterns).collect()
    assert {r.row.url: (r.rule, r.verdict) for r in out} == {u: plain(u) for u in urls}
    assert {r.rule is None for r in out} == {True, False} and {r.verdict for r in out} == {"allow", "block"}
