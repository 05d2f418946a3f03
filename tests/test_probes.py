"""Probe classification, candidates, breaker and schedule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from crawldelta.operators import candidates as CA
from crawldelta.operators import health as H
from crawldelta.operators import probes as PR
from crawldelta.operators import targets as TG


def test_fates(spark):
    codes = {0: "error", 200: "live", 404: "not_found", 410: "gone", 301: "redirect", 308: "redirect", 403: "forbidden",
             429: "rate_limited", 500: "server_error", 503: "server_error", 204: "other_204", 418: "other_418"}
    df = spark.createDataFrame([(c,) for c in codes], "status_code int")
    assert {r.status_code: r.fate for r in PR.with_fate(df).collect()} == codes


def raw(spark, **kw):
    base = dict(url="https://a/x", answered_url="https://a/x", hops=[], status_code=200, headers={}, exception_type=None,
                exception_message=None, started_at="2025-01-01 00:00:00", ended_at="2025-01-01 00:00:00.1234")
    base.update(kw)
    ddl = ("url string, answered_url string, hops array<string>, status_code int, headers map<string,string>, "
           "exception_type string, exception_message string, started_at string, ended_at string")
    df = spark.createDataFrame([tuple(base.values())], ddl)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ("started_at", "ended_at")})


def one(spark, **kw):
    return PR.classify_probes(raw(spark, **kw)).collect()[0]


def test_headers_are_found_in_any_case_and_twice(spark):
    r = one(spark, headers={"x-ROBOTS-tag": "NoIndex, NOFOLLOW", "etag": "1", "ETag": "2", "Link": '<https://c/>; rel="canonical"'})
    assert (r.has_noindex, r.has_nofollow, r.inferred_indexable_from_head) == (True, True, False)
    assert r.h_etag in ("1", "2") and r.h_canonical_url == "https://c/"
    assert one(spark, headers={"Link": "<https://c/>; rel=canonical"}).h_canonical_url is None


def test_missing_headers_mean_open(spark):
    for headers in ({}, None):
        r = one(spark, headers=headers)
        assert (r.has_noindex, r.has_nofollow, r.inferred_crawlable, r.inferred_indexable_from_head) == (False, False, True, True)
        assert r.response_time_ms == 123.0


def test_robots_none_is_a_substring_test(spark):
    assert one(spark, headers={"X-Robots-Tag": "max-image-preview:none"}).inferred_indexable_from_head is False


def test_redirects(spark):
    r = one(spark, answered_url="https://b/y", hops=["https://a/x", "https://a/z"])
    assert (r.is_redirect, r.final_url, r.redirect_count, r.fate) == (True, "https://b/y", 2, "live")
    r = one(spark)
    assert (r.is_redirect, r.final_url, r.redirect_count) == (False, None, 0)


@pytest.mark.parametrize("kind, error", [
    ("ReadTimeout", "timeout"), ("ConnectTimeout", "timeout"), ("SSLError", "connection_error"),
    ("TooManyRedirects", "too_many_redirects"), ("InvalidURL", "m" * 100),
])
def test_errors(spark, kind, error):
    r = one(spark, status_code=None, headers=None, answered_url=None, ended_at=None, exception_type=kind, exception_message="m" * 150)
    assert (r.error, r.status_code, r.fate, r.inferred_crawlable, r.inferred_indexable_from_head) == (error, 0, "error", False, False)


def test_redirect_map(spark):
    rows = [("https://a/1", "https://a/2", 301, "removed", "redirect", True), ("https://a/3", "http://b/4", 302, "modified", "redirect", True),
            ("https://a/5", None, 301, "removed", "redirect", False), ("https://a/6", "https://a/7", 200, "removed", "live", True)]
    df = spark.createDataFrame(rows, "url string, final_url string, status_code int, change_type string, fate string, is_redirect boolean")
    assert {(r.old_url, r.same_domain) for r in PR.redirect_map(df).collect()} == {("https://a/1", True), ("https://a/3", False)}
    assert PR.redirect_map(df, observed=True).count() == 3


def breaker(spark, runs, threshold=0.5, days=3, initial=None):
    df = spark.createDataFrame([("d", dt.date(2025, 1, day), t, f) for day, t, f in runs], "domain string, run date, total long, failures long")
    settings = spark.createDataFrame([("d", threshold, days)], "domain string, failure_threshold double, backoff_days int")
    return H.breaker_state(df, settings, initial).collect()[0]


def test_breaker_opens_on_the_second_bad_run(spark):
    assert breaker(spark, [(1, 10, 5)]).is_open is False
    r = breaker(spark, [(1, 10, 5), (2, 10, 9)])
    assert (r.is_open, r.consecutive_high_failures, str(r.backoff_until)) == (True, 2, "2025-01-05 00:00:00")
    assert (r.total_checks, r.total_failures, r.last_failure_rate) == (20, 14, 0.9)


def test_good_run_resets(spark):
    r = breaker(spark, [(1, 10, 9), (2, 10, 1), (3, 10, 9)])
    assert (r.is_open, r.consecutive_high_failures) == (False, 1)


def test_runs_in_backoff_do_not_happen_and_the_streak_survives_it(spark):
    runs = [(1, 10, 9), (2, 10, 9), (3, 10, 0), (4, 10, 0), (5, 10, 9)]
    r = breaker(spark, runs)
    # The fifth is the first run after the backoff; one bad run opens it again.
    assert (r.is_open, r.total_checks, r.consecutive_high_failures, str(r.backoff_until)) == (True, 30, 3, "2025-01-08 00:00:00")
    r = breaker(spark, runs[:4] + [(5, 10, 1)])
    assert (r.is_open, r.backoff_until, r.consecutive_high_failures) == (False, None, 0)


def test_empty_run_only_ends_a_backoff(spark):
    r = breaker(spark, [(1, 10, 9), (2, 0, 0), (3, 10, 9)])
    assert r.is_open is True and r.total_checks == 20
    r = breaker(spark, [(1, 10, 9), (2, 10, 9), (6, 0, 0)])
    assert (r.is_open, r.backoff_until, r.consecutive_high_failures, r.total_checks) == (False, None, 2, 20)


def test_runnable(spark):
    settings = spark.createDataFrame([("a", True), ("b", False), ("c", True), ("e", True), ("f", True)], "domain string, enabled boolean")
    state = spark.createDataFrame([("c", True, "2025-01-10"), ("e", True, "2025-01-01"), ("f", True, None)], "domain string, is_open boolean, u string")
    state = state.withColumn("backoff_until", F.col("u").cast("timestamp"))
    assert {r.domain for r in H.runnable(settings, state, "2025-01-05").collect()} == {"a", "e"}
    assert H.runnable(settings, state, "2025-01-05", force=True).count() == 5


def test_candidates(spark):
    rows = [("d", "u1", "removed", "2025-01-30"), ("d", "u1", "modified", "2025-01-31"), ("d", "u2", "discovered", "2025-01-29"),
            ("d", "u3", "modified", "2025-01-31"), ("d", "u4", "removed", "2025-01-01"), ("d", "u5", "removed", None),
            ("e", "u1", "removed", "2025-01-30"), ("e", "u2", "modified", "2025-01-30"), ("f", "u1", "removed", "2025-01-30")]
    log = spark.createDataFrame(rows, "domain string, loc string, change_type string, at string")
    log = log.select("domain", "loc", "change_type", F.col("at").cast("timestamp").alias("detected_at"))
    settings = spark.createDataFrame([("d", True, True, True, 2), ("e", False, True, True, 5)],
                                     "domain string, check_removed boolean, check_new boolean, check_updated boolean, max_per_run int")
    got = [(r.domain, r.loc, r.change_type, r["rank"]) for r in CA.probe_candidates(log, settings, "2025-02-01").orderBy("domain", "rank").collect()]
    # u1's latest change is the modification, though its removal would rank higher.
    assert got == [("d", "u2", "discovered", 1), ("d", "u1", "modified", 2), ("e", "u2", "modified", 1), ("f", "u1", "removed", 1)]
    assert CA.probe_candidates(log, settings, "2025-02-01", limit=1).count() == 3


def test_schedule_is_hit_once_per_interval(spark):
    t = spark.createDataFrame([("a", 7, None), ("b", 7, True), ("c", None, None), ("d", 1, False), ("e", 0, True)],
                              "domain string, interval_days int, enabled boolean")
    days = [dt.date(2025, 1, 1) + dt.timedelta(days=i) for i in range(7)]
    hits = [r.domain for day in days for r in TG.due_targets(t, day).collect()]
    assert sorted(hits) == ["a", "b"] + ["c"] * 7 + ["e"] * 7
