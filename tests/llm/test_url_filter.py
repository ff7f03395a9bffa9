"""URL verdicts against a plain rule by rule check."""

import random
import string

import pytest

from palimpsest.llm import url_filter

from .test_native import lower


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    tail = rest[cut:]
    return lower(rest[:cut]), tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]


def brute(urls, rules):
    out = []
    for i, url in urls:
        host, path = parts(url)
        fits = [(len(h) + len(p), len(h), a == "block", h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        out.append((i, host, path, best and best[3], best[4] if best else "allow"))
    return sorted(out, key=repr)


def got(spark, urls, rules):
    df = spark.createDataFrame([(i, u, "x", 1) for i, u in urls], "page_id long, url string, rule string, host int")
    table = spark.createDataFrame(rules, "action string, host string, path string")
    out = url_filter.judge(df, table)
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


ODD = [
    None, "", "no scheme/at all", "://", "http://", "http:///fr/x", "HTTP://WWW.Example.NET/en/a?b#c", "http://example.net", "http://example.net/", "http://example.net/en", "http://example.net/en/", "http://net/",
    "http://xnet/", "http://a.b.c.d.e.f.g.org/fr/", "http://org/fr/?x=/de/", "http://ÀÉ.org/FR/", "http://example.com/de/#x://y.net/", "http://example.com?x/de/", "a://b://c.net/", "http://.net/", "http://net./", "http://example.com:80/de/",
    "http://" + "a." * 3000 + "net/" + "b/" * 3000, "http://org/fr/\n/x", "http://user@example.com/de/a", "http:// net/ ",
]


def test_contract_rules(spark):
    urls = [*enumerate(ODD), (0, ODD[6]), (None, ODD[7])]
    assert got(spark, urls, url_filter.RULES) == brute(urls, url_filter.RULES)
    assert got(spark, [], url_filter.RULES) == []
    assert got(spark, urls, []) == brute(urls, [])


@pytest.mark.parametrize("seed", range(3))
def test_random_rules(spark, seed, monkeypatch):
    """Rules of any depth, ending inside folders, with clashing actions; rules too many to broadcast take the shuffle."""
    rnd = random.Random(seed)
    if seed == 2:
        monkeypatch.setattr(url_filter, "BROADCAST_RULES", 0)
    name = lambda: "".join(rnd.choices("ab", k=rnd.randint(1, 2)))
    host = lambda: ".".join(name() for _ in range(rnd.randint(1, 4)))
    path = lambda: "".join("/" + name() for _ in range(rnd.randint(0, 3))) + rnd.choice(["", "/"])
    rules = [(rnd.choice(["allow", "block"]), host(), path()) for _ in range(60)] + [("allow", "", "/a")]
    urls = [(i, f"http{rnd.choice(['', 's'])}://{host()}{path()}{rnd.choice(['', '?q', '#f/a'])}") for i in range(1500)]
    assert got(spark, urls, rules) == brute(urls, rules)


def test_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    out = url_filter.judge(rows, url_filter.default_rules(spark))
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute([(r.page_id, r.url) for r in rows.collect()], url_filter.RULES)
    assert string.ascii_lowercase == lower(string.ascii_uppercase)
