import re

from strata.llm import url_filters as u

RULES = [("allow", "org", "/"), ("block", "Example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
         ("block", "com", "/de/"), ("allow", "a.com", "/de/"), ("block", "b.a.com", "/d"), ("block", "twin", "/x"), ("allow", "twin", "/x"),
         ("block", None, "/"), ("block", "", "/"), ("allow", "x", None)]
URLS = [None, "", "no scheme", "http://", "https://EXAMPLE.org/es/1?x#y", "http://sub.example.org/en/123", "http://example.org/en/2",
        "http://badexample.org/es/", "http://example.org", "http://example.org?q=/es/", "http://x.com/fr/", "http://x.com/fr", "ftp://b.a.com/de/",
        "a://b://c.com/de/", "http://twin/x", "http://ÄÖ.com/de/", "http://a..com/de/", "http://.com/de/", "http://x.org/#/es/", "://org/",
        "http://" + "a." * 3000 + "com/de/" + "p" * 5000, "http://u@x.com:80/de/", "http://x.com/de/\nnext"]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h) + len(p), len(h), v, h.lower() + p) for v, h, p in RULES if h and p is not None
            and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    best = max(fits, default=None)
    return (host, path, best and best[3], best[2] if best else "allow")


def test_against_all_rules(spark):
    pages = spark.createDataFrame([(i % 20, url, "mine", i) for i, url in enumerate(URLS * 2)], "page_id int, url string, rule string, text int")
    judged = u.judge_urls(pages, u.rule_table(spark, RULES))
    got = judged.collect()
    assert len(got) == 2 * len(URLS) and judged.columns == ["page_id", "url", "text", "host", "path", "rule", "verdict"]
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute(r.url), r.url


def test_without_rules_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://x.org/")], "page_id int, url string")
    assert [tuple(r) for r in u.judge_urls(pages, u.rule_table(spark, []), default="block").collect()] == [
        (1, "http://x.org/", "x.org", "/", None, "block")]
    assert u.judge_urls(pages.limit(0), u.rule_table(spark, RULES)).collect() == []


def test_names_of_other_columns(spark):
    names = ["host_of", "path_of", "head", "rule_of", "verdict_of", "__n", "digest", "suffix"]
    pages = spark.createDataFrame([(1, "http://x.org/a", *names)], "page_id int, url string, " + ", ".join(f"{n} string" for n in names))
    got = u.judge_urls(pages, u.rule_table(spark, RULES)).first()
    assert [got[n] for n in names] == names and (got.host, got.path, got.rule, got.verdict) == brute("http://x.org/a")
