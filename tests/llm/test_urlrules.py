import random

from findery.llm import urlrules
from tests.compare import same


def judge(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n])
        rest = rest[n:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    best = None
    for v, h, p in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or (len(h + p), len(h)) > best[0]):
            best = (len(h + p), len(h)), h + p, v
    return host, path, best and best[1], best[2] if best else default


URLS = [
    None, "", "no scheme", "://", "http://COM/", "http://example.com", "http://a.example.com/en/x?y#z", "https://www.example.com/en/", "https://WWW.Example.COM/en/a/b", "http://notexample.com/en/",
    "http://x.net/es/1", "http://net/fr/", "http://y.net/es", "ftp://a.b.com:80/en/", "http://É.com/é?", "http://example.com?/en/", "http://example.com#/en/", "a://b://c.com/", "http:///x", "http://www.example.com//en/",
]


def test_against_all_rules(spark):
    rng = random.Random(1)
    for rules in (urlrules.RULES, (), (("block", "a.com", ""), ("allow", "b.a.com", ""), ("block", "c.b.a.com", "/x"), ("allow", "a.com", "/x"), ("block", "a.com", "/x"), ("block", "com", "/x/y/z"))):
        urls = URLS + [f"http://{'.'.join(rng.choice(['a', 'b', 'c', 'com', 'example', 'www', 'net']) for _ in range(rng.randrange(1, 5)))}{rng.choice(['', '/', '/x', '/x/y/z', '/en/', '/es/q'])}" for _ in range(300)]
        df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] + [(0, urls[4], "clash")] * 2, "page_id long, url string, rule string")
        got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlrules.judge(df.filter("page_id > 0"), rules).collect()}
        assert got == {i: judge(u, rules) for i, u in enumerate(urls) if i}
        assert urlrules.judge(df, rules).count() == len(urls) + 2
        table = spark.createDataFrame([(*r, n) for n, r in enumerate(rules)] + [("block", None, "/", 0), (None, "com", "/", 0)], "verdict string, host string, path string, ord int")
        told = urlrules.judge_by_table(df, table).collect()
        assert len(told) == len(urls) + 2
        assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in told if r["page_id"]} == got


def test_many_rules_as_a_table(spark):
    rng = random.Random(2)
    labels = [f"l{i}" for i in range(6)]
    name = lambda: ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 5)))
    rules = [(rng.choice(["allow", "block"]), name(), rng.choice(["", "/", "/a", "/a/b"])) for _ in range(400)]
    urls = [f"http://{name()}{rng.choice(['', '/', '/a', '/a/b/c', '/b'])}" for _ in range(600)] + ["http://l0.l1/a"] * 300
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = urlrules.judge_by_table(pages, spark.createDataFrame([(*r, n) for n, r in enumerate(rules)], "verdict string, host string, path string, ord int").repartition(3))
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()} == {i: judge(u, rules) for i, u in enumerate(urls)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert urlrules.judge_by_table(pages.limit(0), spark.createDataFrame([], "verdict string, host string, path string, ord int")).count() == 0


def test_turning_points_are_a_stack():
    points = urlrules.turning_points((("a", "com", "/"), ("b", "x.com", "/"), ("c", "y.x.com", "/"), ("d", "net", "/")))
    assert [p[2] for p in points] == [0, 1, 2, 1, 0, -1, 3, -1]


def test_query(spark):
    same(urlrules.op9_url_filters(spark, "/root/testdata/sf0.01"), urlrules.ORACLE_SQL, "/root/testdata/sf0.01")


def test_empty_table(spark):
    assert urlrules.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
