"""Mined rules of hosts that are few among many pages, and of pages that are mostly bad."""

import time

from newsloom.llm import url_rules


def _mined(spark, groups):
    """Rules from (number of pages, tokens, bad)."""
    rows = [(tokens, bad) for n, tokens, bad in groups for _ in range(n)]
    return {r["rule_id"] for r in url_rules.mined_rules(spark.createDataFrame(rows, "tokens array<string>, bad boolean")).collect()}


def test_a_small_host_among_many_pages_gives_a_rule(spark):
    groups = [(20, ["host=bad"], True), (19, ["host=few"], True), (10_000, ["host=good"], False), (50, ["host=good"], True)]
    assert _mined(spark, groups) == {"host=bad"}


def test_rules_are_in_reach_when_most_pages_are_bad(spark):
    groups = [(300, ["host=bad", "path=x"], True), (150, ["host=mixed", "path=x"], True), (50, ["host=mixed", "path=x"], False)]
    assert _mined(spark, groups) == {"host=bad"}
    assert _mined(spark, [(30, ["host=bad"], True)]) == {"host=bad"}
    assert _mined(spark, [(30, ["host=good"], False), (5, [], True)]) == set()


def test_many_shared_segments_end_in_seconds(spark):
    """25 bad pages share a path of 40 segments; half of the segments are on good pages, too."""
    long = "/".join(f"s{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(40))
    half = "/".join(long.split("/")[:20])
    urls = [(k, f"http://h{k % 7}.com/{long}/x{k}") for k in range(25)]
    urls += [(100 + k, f"http://h{k % 7}.com/{half}/y{k}") for k in range(200)]
    urls += [(1000, f"http://h1.com/{long}/new"), (1001, f"http://h1.com/{half}/new"), (1002, "http://h1.com/" + "a/" * 5000)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    marks = [(k, int(k >= 100), 0) for k, _ in urls if k < 1000]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    start = time.time()
    rows = {r["page_id"]: r for r in url_rules.judged(pages, labels).collect()}
    assert time.time() - start < 120
    assert {k for k, r in rows.items() if r["verdict"] == "block"} == {*range(25), 1000}
    assert all(" & " not in r["mined_rule"] for r in rows.values() if r["mined_rule"])


def test_a_rule_of_two_tokens(spark):
    """Neither the host nor the path is bad by itself."""
    urls = [(k, f"http://{'a' if k % 2 else 'b'}.com/{'x' if k % 4 < 2 else 'y'}/{k}") for k in range(400)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    marks = [(k, int(not (k % 2 and k % 4 < 2)), 0) for k in range(400)]
    rows = url_rules.judged(pages, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()
    assert {r["mined_rule"] for r in rows} == {None, "host=a & path=x"}
    assert all((r["verdict"] == "block") == (r["page_id"] % 4 == 1) for r in rows)
