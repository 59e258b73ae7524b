import random

from riverload.llm.url_filters import judge_urls

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es", "block"), ("net", "/es/a", "allow"), ("a.b", "", "block")]


def judge(spark, urls, rules=RULES):
    pages = spark.createDataFrame([(i, u, "x") for i, u in urls], "page_id long, url string, rule string")
    listed = spark.createDataFrame([(*r, "clash") for r in rules], "host string, path string, action string, verdict string")
    return [tuple(r) for r in judge_urls(pages, listed).collect()]


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host):].split("?")[0].split("#")[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), len(h), a == "block", h + p, a) for h, p, a in rules
           if h and a and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
    return (host, path, max(fit)[3], max(fit)[4]) if fit else (host, path, None, "allow")


def test_against_brute_force(spark):
    pick = random.Random(1).choice
    urls = [(i, pick(["http", "HTTPS", ""]) + "://" + pick(["", "www.", "a.", "x.y.", "."]) + pick(["example.com", "EXAMPLE.Com", "net", "b", "a.b", "com", "örg"])
             + pick(["", "/", "/en/", "/en", "/es/a", "/esp", "/en/x/y", "//"]) + pick(["", "?q=/en/", "#/es", "?", "\n/"])) for i in range(400)]
    urls += [(None, None), (3, ""), (3, "no scheme"), (3, "no scheme"), (4, "http://"), (5, "http://" + "a." * 5000 + "com/" + "x" * 50000), (6, "a://b://c")]
    assert sorted(judge(spark, urls), key=str) == sorted(((i, *brute(u, RULES)) for i, u in urls), key=str)


def test_missing_rules(spark):
    assert judge(spark, [(1, "http://x.com/")], []) == [(1, "x.com", "/", None, "allow")]
    odd = [(None, "/", "block"), ("", "/", "block"), ("com", "/", None), ("com", None, "block")]
    assert judge(spark, [(1, "http://x.com/")], odd) == [(1, "x.com", "/", "com", "block")]
    assert judge(spark, [], RULES) == []


def test_equal_length_prefers_longer_host_then_block(spark):
    tie = [("b.com", "/xy", "allow"), ("a.b.com", "/", "block")]
    assert judge(spark, [(1, "http://a.b.com/xyz")], tie)[0][3:] == ("a.b.com/", "block")
    assert judge(spark, [(1, "http://b.com/")], [("b.com", "/", "allow"), ("b.com", "/", "block")])[0][4] == "block"
