import random

import pytest

from brooklet.llm import urls
from brooklet.llm.urls import Rule

PAGES = "page_id bigint, url string"


def brute(url, rules, default="allow"):
    host, path = urls.split_url(url)
    best = None
    for r in rules:
        if (host == r.host.lower() or host.endswith("." + r.host.lower())) and path.startswith(r.path):
            rank = (len(r.host) + len(r.path), len(r.host), r.verdict == "block")
            if best is None or rank > best[0]:
                best = (rank, r)
    return (host, path, best[1].host + best[1].path, best[1].verdict) if best else (host, path, None, default)


def check(spark, rows, rules=urls.RULES):
    got = sorted((tuple(r) for r in urls.judge(spark.createDataFrame(rows, PAGES), rules).collect()), key=str)
    assert got == sorted(((i, *brute(u, rules)) for i, u in rows), key=str)


def test_edge_urls(spark):
    check(spark, list(enumerate([None, "", "no scheme", "://", "https://COM/en/1", "http://a.example.com/en/7x?y#z", "http://notexample.com/en/7", "http://net/de/", "http://x.example.net/de/85#t", "http://b.org/es", "http://b.org/es/", "a://b://c/en/", "http://com?x", "http://ÀB.com/en/", "http://com\x01x/en/1", "http://x\x00.com/en/", "http://com./en/", "http://.com/en/", "http://a..com/en/"])))
    assert urls.judge(spark.createDataFrame([], PAGES)).count() == 0


def test_random_rules(spark, monkeypatch):
    rng = random.Random(4)
    label = lambda: rng.choice("abc")
    host = lambda n: ".".join(label() for _ in range(rng.randrange(1, n)))
    path = lambda: "/" + "".join(rng.choice("xy/") for _ in range(rng.randrange(0, 4)))
    rules = [Rule(rng.choice(["allow", "block"]), host(4), rng.choice(["", path()])) for _ in range(60)]
    check(spark, [(k, f"http://{host(5)}{path()}") for k in range(300)], rules)
    monkeypatch.setattr(urls, "RULE_BLOCK", 7)  # by ranges
    odd = [None, "", "://", "http://c.B.a/xy?", "http://a./", "http://.a/x", "http://a\x00/x", "http://" + "a." * 2_000 + "b/" + "x" * 10_000]
    rows = [(k, f"http://{host(5)}{path()}") for k in range(300)] + list(enumerate(odd)) + [(None, "http://a/"), (1, "http://a/")]
    check(spark, rows, rules)
    monkeypatch.setattr(urls, "SAMPLED", 3)
    check(spark, rows, [*rules, Rule("block", "B.a", "/xy"), Rule("allow", "b.a", "/xy"), *[Rule("block", "a", "/" + "x" * k) for k in range(20)]])


def test_rules_as_a_table(spark, monkeypatch):
    table = spark.createDataFrame([*urls.RULES, Rule("block", "io", None)], "verdict string, host string, path string")
    rows = [(1, "http://x.io/y"), (2, "http://example.com/en/7"), (3, "http://net/de/"), (4, None)]
    wanted = [(1, "io", "block"), (2, "example.com/en/7", "allow"), (3, "net/de/", "allow"), (4, None, "allow")]
    for block in (urls.RULE_BLOCK, 2):
        monkeypatch.setattr(urls, "RULE_BLOCK", block)
        out = urls.judge(spark.createDataFrame(rows, PAGES), table).orderBy("page_id").collect()
        assert [(r.page_id, r.rule, r.verdict) for r in out] == wanted
        assert urls.judge(spark.createDataFrame([], PAGES), table).count() == 0
        for bad in [Rule("block", None, "/"), Rule("block", "", "/"), Rule(None, "io", "/")]:
            with pytest.raises(ValueError):
                urls.judge(spark.createDataFrame(rows, PAGES), spark.createDataFrame([bad], table.schema))
    assert {r.verdict for r in urls.judge(spark.createDataFrame(rows, PAGES), []).collect()} == {"allow"}


def test_many_rules_of_one_host(spark):
    rng = random.Random(7)
    word = lambda: rng.choice("abcdefgh") * rng.randrange(1, 4)
    paths = {"/" + "/".join(word() for _ in range(rng.randrange(1, 8))) for _ in range(260_000)}
    rules = [Rule("block" if len(p) % 3 else "allow", "com", p) for p in sorted(paths)]
    assert len(rules) > 150_000
    rows = [(k, f"http://h{k % 50}.com/" + "/".join(word() for _ in range(rng.randrange(1, 10)))) for k in range(2_000)]
    for r in urls.judge(spark.createDataFrame(rows, PAGES), rules).collect():
        fit = next((r.path[:n] for n in range(len(r.path), 0, -1) if r.path[:n] in paths), None)
        assert (r.rule, r.verdict) == (("com" + fit, "block" if len(fit) % 3 else "allow") if fit else (None, "allow"))


def test_paths_of_a_host_are_not_tried_one_by_one(monkeypatch):
    rules = urls.Paths([Rule("block", "com", f"/{k:05d}") for k in range(10_000)] + [Rule("allow", "com", "/")])
    assert rules.longest("/00777/x").path == "/00777" and rules.longest("/x").path == "/" and rules.longest("") is None
    assert max(rules.outer) == 0  # every path lies in "/" alone, so a search tries at most two


def test_control_bytes_are_part_of_a_label(spark):
    out = urls.judge(spark.createDataFrame([(1, "http://com\x01x/en/1"), (2, "http://x\x01.com/en/1")], PAGES)).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in out] == [(None, "allow"), ("com/en/", "block")]


def test_very_long_urls(spark):
    check(spark, [(1, "http://" + "a." * 50_000 + "com/en/" + "x" * 100_000), (2, "http://com/" + "en/" * 100_000)])


def test_repeated_rows_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "http://net/de/", "x"), (1, "http://net/de/", "y")], PAGES + ", host string")
    assert [r.rule for r in urls.judge(df).collect()] == ["net/de/"] * 2
