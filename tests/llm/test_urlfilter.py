import re
from collections import Counter

import pytest

from ledgerstar.llm import urlfilter

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"), ("Host.net", "block"),
         ("a.b.c.d/x", "block"), ("d/x", "allow"), ("b.de/a", "allow"), ("de/a.b", "block"), ("de/a.b", "allow")]
URLS = [None, "", "no scheme", "http://", "://x.org", "HTTP://WWW.Example.ORG/es/1", "http://example.org/en/12?x#y", "http://example.org?/es/", "http://org", "http://myorg/es/",
        "http://a.com/fr/de/", "ftp://a.com/de/", "http://host.net", "http://sub.host.net/any", "http://z.a.b.c.d/xy", "http://b.c.d/xy", "http://b.de/a.b.c",
        "http://q.b.de/a", "a\nhttp://example.org/es/\nx#y", "http://u:p@example.org:80/es/", "http://x://example.org/es/", "http://a..org/", "http://É.org/é",
        "http://" + "a." * 20000 + "com/de/" + "p" * 50000]


def judge(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    fold = {c: c + 32 for c in range(65, 91)}
    host = host.translate(fold)
    fits = []
    for rule, verdict in rules:
        rhost, _, _ = rule.partition("/")
        rpath = rule[len(rhost):]
        rhost = rhost.translate(fold)
        if host and (host == rhost or host.endswith("." + rhost)) and path.startswith(rpath):
            fits.append((len(rule), len(rhost), verdict == "block", rule, verdict))
    return (host, path, *max(fits)[3:]) if fits else (host, path, None, "allow")


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_equals_brute_force(spark, broadcast_rows):
    rows = [(i, u, "h", "r") for i, u in enumerate(URLS)] + [(3, URLS[5], "h", "r")] * 3 + [(None, URLS[5], None, None)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, rule string")
    got = urlfilter.judge(pages, urlfilter.rule_table(spark, RULES + [(None, "block"), ("org/", None)]), broadcast_rows=broadcast_rows).collect()
    assert Counter(map(tuple, got)) == Counter((i, *judge(u, RULES)) for i, u, *_ in rows)


def test_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    none = spark.createDataFrame([], "rule string, verdict string")
    assert [tuple(r) for r in urlfilter.judge(pages, none).collect()] == [(1, "a.org", "/", None, "allow")]
    assert urlfilter.judge(pages.where("page_id = 2"), urlfilter.rule_table(spark, RULES)).count() == 0
