import pytest

from basketstream.llm import url_filter

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"),
         ("bad.net", "block"), ("com/de/ok", "allow"), ("com/de/", "block"), ("x.y.z/a", "allow"), ("x.y.z/a", "block")]
URLS = [None, "", "no scheme", "http://", "://", "http://example.org", "http://Example.ORG/es/1?x", "https://a.b.example.org/en/12#f",
        "http://org/", "http://notorg/", "http://xexample.org/es/", "http://m.com/de/", "http://m.com/de/okay", "http://m.com/fr",
        "ftp://bad.net?q=/x", "http://sub.bad.net/anything", "http://bad.net:80/", "http://x.y.z/ab", "http://x.y.z/", "http://a//b.org/c",
        "http://" + "a." * 20000 + "org/" + "p" * 30000, "http://org/\nx", "http://ÄB.org/é"]


def judge(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = {}
    for rule, verdict in rules:
        own, _, start = rule.partition("/")
        start = "/" + start if "/" in rule else ""
        if host and (host == own or host.endswith("." + own)) and path.startswith(start):
            best[rule] = max(verdict, best.get(rule, ""))
    rule = max(best, key=len) if best else None
    return host, path, rule, best.get(rule, "allow")


@pytest.mark.parametrize("max_blocks", [1 << 17, 1])
def test_judges_like_plain_rules(text_spark, max_blocks):
    rows = [(i, u, "h", "p", "r") for i, u in enumerate(URLS)] + [(None, URLS[6], "h", "p", "r"), (3, URLS[3], "h", "p", "r")]
    pages = text_spark.createDataFrame(rows, "page_id long, url string, host string, path string, rule string").repartition(2)
    rules = text_spark.createDataFrame(RULES, "rule string, verdict string")
    found = sorted(map(str, (tuple(r) for r in url_filter.judge(pages, rules, max_blocks=max_blocks).collect())))
    assert found == sorted(str((r[0], *judge(r[1], RULES))) for r in rows)


def test_empty_list_and_empty_table(text_spark):
    pages = text_spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    rules = text_spark.createDataFrame([], "rule string, verdict string")
    assert [tuple(r) for r in url_filter.judge(pages, rules).collect()] == [(1, "a.org", "/", None, "allow")]
    assert url_filter.judge(pages.where("1 = 0"), rules).count() == 0
