from urllib.parse import urlsplit

from pyspark.sql import functions as F

from colloquy.llm import url_filter as u

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
URLS = [
    "http://WWW.Example.COM/en/1?x#y", "https://a.example.com/en/2", "https://example.com/EN/2", "http://x.com", "http://x.com/",
    "http://net/es/", "http://a.net/fr/x", "http://anet/fr/x", "no scheme/en/", "", None, "http://a.b//c://d/e?f", "://h/p", "http://h?q=/a",
    "http://ÄB.com/é/ü", "http://x.com#/en/",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.index(c) for c in "?#" if c in rest), default=len(rest))
    rest = rest[:end]
    at = rest.index("/") if "/" in rest else len(rest)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:at]), rest[at:]


def rule(host, path):
    best = None
    for says, text in RULES:
        own, rest = text[: text.index("/")], text[text.index("/") :]
        if (host == own or host.endswith("." + own)) and path.startswith(rest) and (best is None or len(text) > len(best[1])):
            best = says, text
    return best


def test_hosts_paths_and_rules_equal_brute_force(spark):
    df = spark.createDataFrame([(i, x, None) for i, x in enumerate(URLS)], "page_id bigint, url string, bad boolean")
    rows = u.filter_urls(df, RULES, F.col("bad")).collect()
    assert len(rows) == len(URLS) and urlsplit(URLS[0]).netloc
    for r in rows:
        host, path = parts(URLS[r["page_id"]])
        assert (r["host"], r["path"]) == (host, path)
        found = rule(host, path)
        assert r["rule"] == (found and found[1]) and r["verdict"] == (found[0] if found else "allow")


def test_templates_split_where_labels_do(spark):
    rows = []
    for i in range(300):
        rows += [(i, f"http://h.org/spam/{i}/x{i}", i % 10 != 0), (1000 + i, f"http://h.org/blog/{i}/x{i}", i % 10 == 0)]
        rows += [(3000 + i, f"http://good.org/{i}", False)]
        rows += [(2000 + i, f"http://h.org/user-name-{chr(97 + i % 26)}{chr(97 + i // 26)}", None)]
    rows += [(5000, "http://h.org/spam/77", None), (5001, "http://few.org/spam/1", True)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, bad boolean")
    got = {r["page_id"]: r for r in u.filter_urls(df, [], F.col("bad")).collect()}
    assert len(got) == len(rows)
    assert got[3]["template"].startswith("/spam/") and got[3]["verdict"] == "block"
    assert got[1003]["template"].startswith("/blog/") and got[1003]["verdict"] == "allow"
    assert got[2005]["template"] == "/*" and got[2005]["verdict"] == "allow"
    assert got[5001]["verdict"] == "allow"  # one label is not enough


def test_a_small_bad_section_among_many_stands_alone(spark):
    names = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(100)]
    rows = [(i * 100 + k, f"http://h.org/{name}/x{k}", name == "bc") for i, name in enumerate(names) for k in range(50)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, bad boolean")
    got = u.filter_urls(df, [], F.col("bad")).collect()
    assert {r["path"].split("/")[1] for r in got if r["verdict"] == "block"} == {"bc"}
    assert {r["template"].split("/")[1] for r in got} == {"bc", "*"} and len(got) == len(rows)


def test_alike_sections_are_merged_with_each_other(spark):
    rows, bad_of = [], {"ads": (400, 400), "x": (30, 150), "y": (31, 150), "new": (0, 0)} | {f"s{c}": (0, 50) for c in "abcdefgh"}
    for name, (bad, n) in bad_of.items():
        rows += [(len(rows) + k, f"http://h.org/{name}/p", k < bad if n else None) for k in range(n or 5)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, bad boolean")
    got = u.filter_urls(df, [], F.col("bad")).collect()
    of = {r["path"].split("/")[1]: r["template"] for r in got}
    assert of["ads"] == "/ads/*" and of["x"] == of["y"] == of["new"] == "/*/*"  # led by the most labels
    assert {of[f"s{c}"] for c in "abcdefgh"} == {"//sh/*"} and len(got) == len(rows)
    assert {r["path"].split("/")[1] for r in got if r["verdict"] == "block"} == {"ads"}


def test_odd_rows(spark):
    rows = [(1, "http://a/b", True, "x"), (1, "http://a/b", True, "x"), (None, None, None, None), (2, "http://a/" + "b/" * 5000, False, "y")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, bad boolean, host string")
    got = u.filter_urls(df, RULES, F.col("bad")).collect()
    assert len(got) == 4 and {r["host"] for r in got} == {"a", ""}
    assert u.filter_urls(df.limit(0), RULES, F.col("bad")).count() == 0
