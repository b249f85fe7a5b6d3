import itertools
import random

from vcat.llm import urlfilter


def plain(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host, rest = rest[:n], rest[n:]
        path = rest[:next((i for i, c in enumerate(rest) if c in "?#"), len(rest))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h), len(p), h + p, v) for (h, p), v in rules.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[2], max(fits)[3]) if fits else (host, path, None, "allow")


def test_against_plain_rules(spark):
    rng = random.Random(3)
    hosts = ["com", "a.com", "b.a.com", "a-b.com", "aa.com", "x.b.a.com", "org", "a.org", "", "A.Com", "a..com", "a.com:80", "a\x01b.com", "é.com"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/a/b/c", "/ab", "/é/", "/a/\U0010ffff", "/A"]
    rules = {(h.lower(), p): rng.choice(["allow", "block"]) for h in hosts[:9] for p in rng.sample(paths, 4)}
    urls = [f"http://{h}{p}{e}" for h, p in itertools.product(hosts, paths) for e in ("", "?q=/a", "#x", "/")] + [None, "", "a.com/a", "://", "x://a.com://b"]
    pages = spark.createDataFrame([(i, u, "c") for i, u in enumerate(urls + urls[:40])], "page_id long, url string, verdict string")
    table = spark.createDataFrame([(h, p, v) for (h, p), v in rules.items()] + [("a.com", None, "block"), (None, "/", "block")], "host string, path string, verdict string")
    out = urlfilter.filter_urls(pages, table).collect()
    assert len(out) == len(urls) + 40
    for r in out:
        assert (r.host, r.path, r.rule, r.verdict) == plain(r.url, rules), r.url


def test_duplicate_rules_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    rules = spark.createDataFrame([("a.com", "/", "allow"), ("a.com", "/", "block")], "host string, path string, verdict string")
    assert urlfilter.filter_urls(pages, rules).first().verdict == "block"
    assert urlfilter.filter_urls(pages, rules.limit(0)).first().verdict == "allow"
    assert urlfilter.filter_urls(pages.limit(0), rules).count() == 0
