import math

import duckdb
import pytest

import check
from admere.llm import reputation
from admere.llm.reputation import Rule, judge_pages, reputations, with_rule

PAGES = "page_id long, url string, host string, html string"
LABELS = "doc_id long, quality int, toxic int, host string"


def judged(spark, pages, labels, **more):
    rows = [(p, u, "clash", None) for p, u in pages]
    df = judge_pages(spark.createDataFrame(rows, PAGES), spark.createDataFrame([(*x, "clash") for x in labels], LABELS), **more)
    assert df.columns == ["page_id", "host", "path", "rule", "verdict"]
    return sorted(map(tuple, df.collect()), key=str)


def oracle(pages, labels):
    duck = duckdb.connect()
    duck.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    duck.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    duck.executemany("INSERT INTO pages VALUES (?, ?)", pages)
    for row in labels:
        duck.execute("INSERT INTO labels VALUES (?, ?, ?)", row)
    return sorted(duck.execute(reputation.ORACLE).fetchall(), key=str)


def test_rules_longest_wins_and_odd_urls(spark):
    pages = [
        (1, "https://a.example.org/es/1"), (2, "https://example.org/en/17"), (3, "https://A.Example.ORG/EN/1"), (4, "http://x.com/fr/2?q=/de/"),
        (5, "http://x.com/de/2"), (6, "http://x.com/en/3#/de/"), (7, None), (8, "no scheme/de/"), (9, ""), (10, "http://notexample.org/es/1"),
        (11, "ftp://com/de/"), (12, "x://y.com?z=://u/de/"), (13, "http://org"), (14, "http://org/"), (None, "http://u:p@h.com:80/fr/"), (15, "http://u@h.com/de/é\n"),
        (1, "https://a.example.org/es/1"),
    ]
    want = {
        1: ("a.example.org", "/es/1", "example.org/es/", "block"), 2: ("example.org", "/en/17", "example.org/en/1", "block"),
        3: ("a.example.org", "/EN/1", "org/", "allow"), 4: ("x.com", "/fr/2", "com/fr/", "allow"), 5: ("x.com", "/de/2", "com/de/", "block"),
        6: ("x.com", "/en/3", None, "allow"), 7: ("", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("", "", None, "allow"),
        10: ("notexample.org", "/es/1", "org/", "allow"), 11: ("com", "/de/", "com/de/", "block"), 12: ("y.com", "", None, "allow"),
        13: ("org", "", None, "allow"), 14: ("org", "/", "org/", "allow"), None: ("u:p@h.com:80", "/fr/", None, "allow"), 15: ("u@h.com", "/de/é\n", "com/de/", "block"),
    }
    got = judged(spark, pages, [])
    assert got == sorted([(p, *want[p]) for p, _ in pages], key=str) == oracle(pages, [])
    assert judged(spark, [], [(1, 1, 0)]) == []


def test_many_rules_are_joined_with_the_same_result(spark):
    rules = [*reputation.RULES, Rule("example.org", "/es/", "allow"), Rule("b.example.org", "", "block")]
    urls = [(h, p) for h in ("org", "a.example.org", "b.example.org", "x.com", "", "example.net") for p in ("", "/", "/es/", "/en/1", "/en/2", "/fr/", "/de/x")]
    df = spark.createDataFrame(urls * 2, "host string, path string")
    assert check.rows(with_rule(df, rules).collect(), ["h", "p", "r", "v"]) == check.rows(with_rule(df, rules, inline=0).collect(), ["h", "p", "r", "v"])
    assert with_rule(df, []).filter("rule IS NOT NULL OR rule_verdict IS NOT NULL").count() == 0


def brute(hosts):
    """Posteriors of (host, n, good) by plain loops; all names are of two or three labels."""

    def fit(rows):
        more = sum((g - n * m) ** 2 - n * m * (1 - m) for n, g, m in rows)
        most = sum(n * (n - 1) * m * (1 - m) for n, g, m in rows)
        return 10.0 if not most else 1000.0 if more <= 0 else min(max(most / more - 1, 2), 1000)

    def sums(key):
        out = {}
        for h, n, g in hosts:
            a = out.setdefault(key(h), [0, 0])
            a[0] += n
            a[1] += g
        return out

    def level(counts, parent, up):
        rows = {k: (*v, parent[up(k)]) for k, v in counts.items()}
        w = fit(list(rows.values()))
        return {k: (g + w * m, n - g + w * (1 - m)) for k, (n, g, m) in rows.items()}

    def means(x):
        return {k: a / (a + b) for k, (a, b) in x.items()}

    total = sums(lambda h: "")[""]
    last, two = lambda h: h.rsplit(".", 1)[-1], lambda h: ".".join(h.split(".")[-2:])
    s = means(level(sums(last), {"": (total[1] + 1) / (total[0] + 2)}, lambda k: ""))
    d = means(level(sums(two), s, last))
    return {h: (a / (a + b), math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))) for h, (a, b) in level(sums(lambda h: h), d, two).items()}


def test_posteriors_equal_plain_loops(spark):
    hosts = [(f"h{i}.d{i % 5}.{'com' if i % 2 else 'net'}", i % 13, (i % 13) * (i % 4) // 4) for i in range(60)]
    want = brute(hosts)
    for r in reputations(spark.createDataFrame(hosts, "host string, n long, good long")).collect():
        mean, sd = want[r["host"]]
        assert r["mean"] == pytest.approx(mean) and r["upper"] - r["lower"] == pytest.approx(2 * 1.645 * sd)


def test_bad_hosts_are_blocked_and_shrunk(spark):
    # 40 hosts with mostly good pages, one with 30 bad ones, one with a single bad page
    pages, labels, doc = [], [], 0
    for host, fine, bad in [(f"h{i}.good.example", 18, 2) for i in range(40)] + [("bad.good.example", 0, 30), ("one.good.example", 0, 1)]:
        for k in range(fine + bad):
            doc += 1
            pages.append((doc, f"http://{host}/en/{doc}.html"))
            labels += [(doc, int(k < fine), 0)] * (1 + doc % 2)
    pages.append((0, "http://bad.good.example/about"))
    labels += [(None, 0, 0), (5, None, 1)]
    got = judged(spark, pages, labels)
    assert {h for _, h, _, _, v in got if v == "block"} == {"bad.good.example"} and len(got) == len(pages)
    assert sum(v == "block" for *_, v in got) == 31
    assert got == oracle(pages, labels)


def test_registered_domains(spark):
    rows = [("a.b.co.uk", "b.co.uk", "co.uk"), ("b.com", "b.com", "com"), ("com", "com", "com"), ("", "", ""), ("u@x.y.org:8080", "y.org", "org")]
    name = reputation.host_name(reputation.F.col("h"))
    got = spark.createDataFrame([(r[0],) for r in rows], "h string").select("h", reputation.domain_of(name), reputation.suffix_of(name)).collect()
    assert [tuple(r) for r in got] == rows
