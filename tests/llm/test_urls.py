from listloom.llm import urls

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def judged(spark, addresses, rules=RULES, outcomes=None):
    df = spark.createDataFrame([(i, u, 1) for i, u in enumerate(addresses)], "page_id bigint, url string, host int")
    return {r["page_id"]: tuple(r)[1:5] for r in urls.judge(df, rules, outcomes=outcomes).collect()}


def test_hosts_paths_and_rules(spark):
    cases = [
        ("http://A.Com/x?y#z", ("a.com", "/x", "com/", "allow")),
        ("http://example.com/en/1", ("example.com", "/en/1", "example.com/en/", "block")),
        ("https://m.example.com/en/", ("m.example.com", "/en/", "example.com/en/", "block")),
        ("https://www.example.com/en/a", ("www.example.com", "/en/a", "www.example.com/en/", "allow")),
        ("http://xexample.com/en/", ("xexample.com", "/en/", "com/", "allow")),
        ("ftp://a.net/es/", ("a.net", "/es/", "net/es/", "block")),
        ("http://a.com", ("a.com", "", None, "allow")),
        ("http://a.com?q=/", ("a.com", "", None, "allow")),
        ("a.com/x", ("", "", None, "allow")),
        (None, ("", "", None, "allow")),
        ("", ("", "", None, "allow")),
        ("http://a.com/b://c.net/es/", ("a.com", "/b://c.net/es/", "com/", "allow")),
        ("http://İa.org/\nx", ("İa.org", "/\nx", None, "allow")),
    ]
    got = judged(spark, [u for u, _ in cases])
    for i, (url, expected) in enumerate(cases):
        assert got[i] == expected, url


def test_shrinkage(spark):
    bad = [(f"http://bad.spam.org/{i}", 1) for i in range(200)] + [(f"http://worse.spam.org/{i}", 1) for i in range(200)]
    good = [(f"http://h{k}.fine.org/{i}", 0) for k in range(5) for i in range(60)] + [("http://once.fine.org/", 1)]
    outcomes = spark.createDataFrame(bad + good, "url string, bad int")
    ask = ["http://bad.spam.org/new", "http://new.spam.org/", "http://once.fine.org/x", "http://h1.fine.org/x", "http://elsewhere.net/"]
    got = judged(spark, ask, [], outcomes)
    assert [got[i][3] for i in range(5)][0] == "block"  # many labels of its own
    assert [got[i][3] for i in range(2, 5)] == ["allow", "allow", "allow"]  # one label, good labels, none
    table = {r["host"]: r for r in urls.reputation(outcomes.selectExpr("split(url, '/')[2] AS host", "bad")).collect()}
    assert table["once.fine.org"]["mean"] < 0.6 < table["bad.spam.org"]["mean"]  # shrunk towards its domain


def test_levels(spark):
    df = spark.createDataFrame([(h,) for h in ("a.b.example.co.uk", "example.co.uk", "co.uk", "a.example.com", "com", "", "x.y.uk")], "host string")
    got = [tuple(r) for r in df.select(*urls.levels()).collect()]
    assert got == [("example.co.uk", "co.uk"), ("example.co.uk", "co.uk"), ("co.uk", "uk"), ("example.com", "com"), ("com", "com"), ("", ""), ("y.uk", "uk")]


def test_cases(spark):
    assert judged(spark, []) == {}
    df = spark.createDataFrame([(None, "http://a.net/es/"), (1, "http://a.com/"), (1, "http://a.com/")], "page_id bigint, url string")
    assert sorted(r["verdict"] for r in urls.judge(df, RULES).collect()) == ["allow", "allow", "block"]
    kept = urls.keep_allowed(df, RULES)
    assert kept.columns == df.columns and kept.count() == 2
    plan = urls.judge(df, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan


def test_pages_without_a_rule_follow_their_hosts_evidence(spark):
    """Two hosts under one suffix whose rules block only some paths: many blocked pages or few decide for the rest."""
    ask = [f"http://worse.example.net/es/{i}" for i in range(300)] + ["http://worse.example.net/de/", "http://better.example.net/de/"]
    ask += [f"http://better.example.net/{'es' if i % 10 == 0 else 'en'}/{i}" for i in range(300)] + ["http://far.example.org/", "http://new.worse.example.net/x"]
    got = judged(spark, ask)
    assert got[300] == ("worse.example.net", "/de/", None, "block") and got[301][3] == "allow" and got[len(ask) - 2][3] == "allow"
    df = spark.createDataFrame([(i, u) for i, u in enumerate(ask)], "page_id bigint, url string")
    table = {r["host"]: r for r in urls.judge(df, RULES).select("host", "host_pages", "host_bad", "host_rate", "host_bound").distinct().collect()}
    worse, better, new = table["worse.example.net"], table["better.example.net"], table["new.worse.example.net"]
    assert (worse["host_pages"], worse["host_bad"], better["host_pages"], better["host_bad"]) == (301, 300, 301, 30)
    assert 1e6 * 300 / 301 > worse["host_rate"] > new["host_rate"] > better["host_rate"] > 1e6 * 30 / 301 and all(r["host_bound"] < r["host_rate"] for r in table.values())


def test_names_under_levels(spark):
    df = spark.createDataFrame([(h,) for h in ("10.1.2.3", "10.1.2.3:80", "a.com:8080", "me:secret@www.a.com", "[::1]:443", "x.github.io", "a.b.github.io", "github.io", "b.co.uk")], "host string")
    got = [tuple(r) for r in df.select(*urls.levels()).collect()]
    assert got[:5] == [("10.1.2.3", "10.1.2.3"), ("10.1.2.3", "10.1.2.3"), ("a.com", "com"), ("a.com", "com"), ("[::1]", "[::1]")]
    table = spark.createDataFrame([("github.io",), ("io",), ("co.uk",), ("uk",), ("com",)], "suffix string")
    found = {r["host"]: (r["domain"], r["suffix"]) for r in urls.with_levels(df, table).collect()}
    assert found["x.github.io"] == ("x.github.io", "github.io") and found["a.b.github.io"] == ("b.github.io", "github.io") and found["github.io"] == ("github.io", "github.io")
    assert found["b.co.uk"] == ("b.co.uk", "co.uk") and found["10.1.2.3:80"] == ("10.1.2.3", "10.1.2.3") and found["a.com:8080"] == ("a.com", "com")


def test_many_rules_are_the_same_as_few(spark, monkeypatch):
    ask = ["http://a.com/x", "http://example.com/en/1", "https://www.example.com/en/a", "ftp://q.net/es/", "http://b.net/de/", None, "", "http://x.org/"] * 3
    few = judged(spark, ask)
    monkeypatch.setattr(urls, "MOST_RULES", 2)
    assert judged(spark, ask) == few
    many = [("block", f"h{i}.org", f"/p{i}/") for i in range(3000)]
    got = judged(spark, ["http://a.h77.org/p77/x", "http://h77.org/p7", "http://h2999.org/p2999/"], many)
    assert [got[i][2] for i in range(3)] == ["h77.org/p77/", None, "h2999.org/p2999/"]
