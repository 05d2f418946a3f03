"""Robots rules and their differences, calendar days without changes, sections that return."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from crawldelta.functions.robots import path_allowed, rule_groups, rules_for
from crawldelta.operators import analytics as AN
from crawldelta.operators import policy as PO

TEXT = """# all
User-agent: A
user-AGENT : ignored
User-Agent: B # two
Disallow: /private
  ALLOW:/private/open # but
Disallow:
Crawl-delay: 5

User-agent: C
Sitemap: https://x/s.xml
User-agent: *
Disallow: /*.pdf$
Disallow: /a(b)+c
Allow: /
"""


def texts(spark, *rows):
    return spark.createDataFrame(list(rows), "domain string, content string")


def test_rules_of_grouped_agents(spark):
    rows = PO.rule_rows(texts(spark, ("d", TEXT), ("e", None), ("f", ""), ("g", "Disallow: /\nUser-agent:\nDisallow: /"))).collect()
    own = [("disallow", "/private"), ("allow", "/private/open"), ("crawl-delay", "5")]
    rest = [("disallow", "/*.pdf$"), ("disallow", "/a(b)+c"), ("allow", "/")]
    want = [("d", a, *r) for a in ("a", "b") for r in own] + [("d", a, *r) for a in ("c", "*") for r in rest]
    assert sorted(map(tuple, rows)) == sorted(want)


@pytest.mark.parametrize("agent,path,allowed", [
    ("A", "/private", False), ("A", "/private/open/x", True), ("a", "/other", True), ("B", "/privatex", False),
    ("Z", "/x.pdf", False), ("Z", "/x.pdf?y", True), ("Z", "/a(b)+c/d", False), ("Z", "/abbc", True), ("C", "/y.pdf", False), ("A", "/x.pdf", True),
])
def test_the_longest_rule_decides(spark, agent, path, allowed):
    row = texts(spark, ("d", TEXT)).select(path_allowed(rules_for(rule_groups(F.col("content")), agent), F.lit(path)).alias("x")).first()
    assert row.x is allowed


def test_equally_long_rules_allow_and_no_rules_allow(spark):
    both = "User-agent: *\nDisallow: /p\nAllow: /p\nDisallow: /q*\n"
    told = lambda t, p: path_allowed(rules_for(rule_groups(F.lit(t)), "x"), F.lit(p))
    row = spark.range(1).select(told(both, "/p1").alias("a"), told(both, "/q").alias("b"), told(None, "/").alias("c"), told("", "/").alias("d")).first()
    assert tuple(row) == (True, False, True, True)


def test_rule_diff(spark):
    old = texts(spark, ("d", TEXT), ("gone", "User-agent: *\nDisallow: /"), ("same", TEXT))
    new = texts(spark, ("d", TEXT.replace("delay: 5", "delay: 9").replace("/private\n", "/secret\n")), ("new", "User-agent: *\nCrawl-delay: 1"), ("same", TEXT))
    got = {(r.domain, r.agent, r.directive, r.value, r.value_before, r.change) for r in PO.rule_diff(old, new).collect()}
    per_agent = {("crawl-delay", "9", "5", "changed"), ("disallow", "/secret", None, "added"), ("disallow", "/private", None, "removed")}
    assert got == {("d", a, *x) for a in ("a", "b") for x in per_agent} | {
        ("gone", "*", "disallow", "/", None, "removed"), ("new", "*", "crawl-delay", "1", None, "added")}


def test_paths_that_change(spark):
    old, new = texts(spark, ("d", "User-agent: *\nDisallow: /a")), texts(spark, ("d", "User-agent: *\nDisallow: /b"), ("n", "User-agent: *\nDisallow: /"))
    paths = spark.createDataFrame([("d", "/a1"), ("d", "/b1"), ("d", "/c"), ("n", "/x"), ("other", "/"), ("d", None), (None, "/a")], "domain string, path string")
    got = {tuple(r) for r in PO.path_effects(old, new, paths, "bot").collect()}
    assert got == {("d", "/a1", False, True), ("d", "/b1", True, False), ("n", "/x", True, False)}


def log(spark, rows):
    return spark.createDataFrame([(d, "modified", dt.datetime.fromisoformat(t)) for d, t in rows], "domain string, change_type string, detected_at timestamp")


def test_a_domain_that_stops(spark):
    rows = [("a", f"2025-12-{d:02d} 10:00") for d in (1, 2, 3) for _ in range(4)] + [("weekly", f"2025-12-{d:02d} 01:00") for d in (1, 8)] + [(None, "2025-12-08 00:00")]
    got = {(r.domain, r.day.day): (r.changes, r.trailing_mean, r.ratio) for r in AN.cadence_shift_calendar(log(spark, rows), 3).collect()}
    assert got[("a", 1)] == (4, None, None) and got[("a", 3)] == (4, 4.0, 1.0)
    assert got[("a", 4)] == (0, 4.0, 0.0) and got[("a", 6)] == (0, 1.3333, 0.0) and got[("a", 7)] == (0, 0.0, None)
    assert got[("weekly", 2)] == (0, 1.0, 0.0) and got[("weekly", 8)] == (1, 0.0, None) and got[(None, 8)][0] == 1
    assert len(got) == 8 + 8 + 1


def test_calendar_until_a_day(spark):
    until = F.lit("2025-12-05").cast("date")
    got = AN.cadence_shift_calendar(log(spark, [("a", "2025-12-03 00:00"), ("b", "2025-12-09 00:00")]), until=until).collect()
    assert [(r.domain, r.day.day, r.changes) for r in sorted(got)] == [("a", 3, 1), ("a", 4, 0), ("a", 5, 0)]
    assert AN.cadence_shift_calendar(log(spark, []).limit(0)).count() == 0


def test_a_section_that_returns_is_not_new(spark):
    snap = lambda *s: spark.createDataFrame([("d", x) for x in s], "domain string, section string")
    at = lambda d: f"2025-12-{d:02d} 06:00:00"
    first = AN.sections_of(snap("news", "blog", None).withColumn("first_seen_at", F.lit(at(1)).cast("timestamp")))
    second = AN.fold_sections(first, snap("news", "shop", None), at(2))
    assert [r.section for r in AN.sections_first_seen(first, snap("news", "shop", None)).collect()] == ["shop"]
    assert AN.sections_first_seen(second, snap("news", "blog", "shop")).count() == 0
    third = AN.fold_sections(second, snap("blog"), at(3))
    assert {(r.section, r.first_seen_at.day) for r in third.collect()} == {("news", 1), ("blog", 1), ("shop", 2)}
