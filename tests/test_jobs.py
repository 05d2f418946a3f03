"""State on disk, the daily jobs end to end, and the streams over several batches."""

import json

import pytest
from pyspark.sql import functions as F

from crawldelta.operators import alltime as AT
from crawldelta.operators import health as H
from crawldelta.operators import probes as PR
from crawldelta.plans import daily
from crawldelta.schemas import ALL_TIME, BREAKER, SNAPSHOT, conform
from crawldelta.session import shared_dir
from crawldelta.sources import changelog, documents, history, snapshots, state
from crawldelta.streaming import changes as SC
from crawldelta.streaming import state as SS

T1, T2 = "2025-12-01 06:00:00", "2025-12-02 06:00:00"
NS = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


def docs(spark, urls):
    body = "".join(f"<url><loc>https://a.com/{u}</loc><lastmod>{m}</lastmod></url>" for u, m in urls)
    rows = [("a.com", "https://a.com/sitemap.xml", f"<urlset {NS}>{body}</urlset>"), ("b.com", "https://b.com/s.xml", "")]
    return spark.createDataFrame(rows, "domain string, sitemap_url string, xml string").withColumn("fetched_at", F.lit(T1).cast("timestamp"))


def targets(spark, base):
    path = f"{base}/config.json"
    with open(path, "w") as f:
        json.dump({"targets": [
            {"domain": "a.com", "sitemap_url": "https://a.com/sitemap.xml", "status_check": {"max_per_run": 2}},
            {"domain": "b.com", "sitemap_urls": ["https://b.com/s.xml"]}, {"domain": "c.com", "enabled": False, "sitemap_url": "x"}]}, f)
    return documents.read_targets(spark, path)


def test_daily_job_and_its_rerun(spark, base):
    t, out = targets(spark, base), f"{base}/state"
    summary = {r.domain: (r.status, r.urls) for r in daily.daily_inventory(spark, t, docs(spark, [("x/1", "2025"), ("x/2", "2025"), ("y", "2025")]), out, T1).collect()}
    assert summary == {"a.com": ("success", 3), "b.com": ("warning", 0)}
    second = docs(spark, [("x/1", "2025"), ("x/2", "2026"), ("z", "2025")])
    for _ in range(2):  # a rerun replaces its own output
        daily.daily_inventory(spark, t, second, out, T2)
        log = changelog.read_changes(spark, f"{out}/changes")
        got = sorted((str(r.detected_at), r.loc[14:], r.change_type) for r in log.collect())
        assert got == [(T1, "x/1", "discovered"), (T1, "x/2", "discovered"), (T1, "y", "discovered"),
                       (T2, "x/2", "modified"), (T2, "y", "removed"), (T2, "z", "discovered")]
        live = {r.loc[14:]: r.live_status for r in state.read_state(spark, f"{out}/all_time", ALL_TIME).collect()}
        assert live == {"x/1": "current_live", "x/2": "current_live", "y": "old_live", "z": "current_live"}
        snap = {r.loc[14:]: (r.change_type, r.section) for r in snapshots.read_snapshot(spark, f"{out}/snapshot").collect()}
        assert snap == {"x/1": ("present", "x"), "x/2": ("modified", "x"), "z": ("discovered", "z")}

    todo = [(r.loc[14:], r.change_type) for r in daily.plan_probes(spark, t, out, T2).orderBy("rank").collect()]
    assert todo == [("y", "removed"), ("z", "discovered")]


def test_bucketed_state_is_not_shuffled_and_gives_the_same(spark, sf_dir, base):
    from crawldelta.checks.bindings import bind
    from crawldelta.functions.urls import with_path_features

    n = 12
    cur = with_path_features(bind(spark, sf_dir, "l_cur"))
    plain = {"prev": conform(bind(spark, sf_dir, "l_prev"), SNAPSHOT), "old": conform(bind(spark, sf_dir, "l_all_time"), ALL_TIME)}
    kept = {}
    for name, df in plain.items():
        state.write_state(df.repartition(n, "domain", "loc"), f"{base}/{name}", "1", df.schema, n)
        kept[name] = state.read_state(spark, f"{base}/{name}", df.schema, buckets=n)
    fused = daily.fused_state(cur, kept["prev"], kept["old"], n)
    plan = fused._jdf.queryExecution().executedPlan().toString()
    # Both exchanges belong to the current side: one to deduplicate, one to reach its bucket.
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.index("Exchange hashpartitioning") > plan.index("Union")
    a = daily.run_inventory(cur, kept["prev"], kept["old"], T2, buckets=n)
    b = daily.run_inventory(cur, plain["prev"], plain["old"], T2)
    for got, want in zip(a, b):
        assert got.count() == want.count() and got.exceptAll(want).count() == 0


@pytest.mark.parametrize("buckets", [None, 4])
def test_two_days(spark, base, buckets):
    t, out = targets(spark, base), f"{base}/state"
    daily.daily_inventory(spark, t, docs(spark, [("x", "2025"), ("y", "2025")]), out, T1, buckets)
    daily.daily_inventory(spark, t, docs(spark, [("y", "2025"), ("z", "2025")]), out, T2, buckets)
    live = {r.loc[14:]: (r.live_status, str(r.first_seen_at)) for r in state.read_state(spark, f"{out}/all_time", ALL_TIME, buckets=buckets).collect()}
    assert live == {"x": ("old_live", T1), "y": ("current_live", T1), "z": ("current_live", T2)}


def test_probe_job_moves_the_breaker(spark, base):
    t, out = targets(spark, base), f"{base}/state"
    for day in (T1, T2):
        raw = spark.createDataFrame(
            [("a.com", "https://a.com/y", "removed", None, day, None, "https://a.com/y", [], day, day, {"ETag": "1"} if ok else None, None if ok else "Timeout", None)
             for ok in (True, False)],
            "domain string, url string, change_type string, section string, checked_at string, status_code int, answered_url string, "
            "hops array<string>, started_at string, ended_at string, headers map<string,string>, exception_type string, exception_message string")
        raw = raw.withColumns({c: F.col(c).cast("timestamp") for c in ("checked_at", "started_at", "ended_at")})
        raw = raw.withColumn("status_code", F.when(F.col("exception_type").isNull(), 200))
        for _ in range(2 if day == T2 else 1):
            daily.record_probes(spark, raw, t, out, day)
    # The run that was repeated has replaced its own rows.
    assert history.read_status_history(spark, f"{out}/status_history").count() == 4
    assert history.read_headers(spark, f"{out}/headers").count() == 2
    b = state.read_state(spark, f"{out}/breaker", BREAKER).collect()[0]
    assert (b.is_open, b.total_checks, b.consecutive_high_failures) == (True, 4, 2)
    assert daily.plan_probes.__doc__ and H.runnable(
        spark.createDataFrame([("a.com", True)], "domain string, enabled boolean"), state.read_state(spark, f"{out}/breaker", BREAKER), T2).count() == 0


def test_a_run_without_success_marker_is_not_read(spark, base):
    row = spark.createDataFrame([("a", "d")], "loc string, domain string")
    state.write_state(row, base, "1", SNAPSHOT)
    conform(row.union(row), SNAPSHOT).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{base}/run_id=2")
    assert state.read_state(spark, base, SNAPSHOT).count() == 1
    assert state.read_state(spark, base, SNAPSHOT, before="1").count() == 0


def test_old_runs_are_dropped_and_the_newest_stay(spark, base):
    row = spark.createDataFrame([("a", "d")], "loc string, domain string")
    for run in ("1", "2", "3"):
        state.write_state(row.withColumn("lastmod", F.lit(run)), base, run, SNAPSHOT)
    assert [p[-1] for p in state.drop_old_runs(spark, base, 2)] == ["1"]
    assert state.drop_old_runs(spark, base, 5) == []
    assert state.read_state(spark, base, SNAPSHOT).collect()[0].lastmod == "3"
    assert state.read_state(spark, base, SNAPSHOT, before="3").collect()[0].lastmod == "2"


def test_empty_snapshot_is_not_written(spark, base):
    assert snapshots.write_snapshot(spark.createDataFrame([], SNAPSHOT), base, "1") is None


def test_months_before_the_start_are_not_listed(spark, base):
    rows = spark.createDataFrame([("d", "u", "modified")], "domain string, loc string, change_type string")
    for ts in ("2025-10-01 00:00:00", T1):
        changelog.append_changes(rows.withColumn("detected_at", F.lit(ts).cast("timestamp")), base, ts)
    log = changelog.read_changes(spark, base, T1)
    assert log.count() == 1
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "change_month" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]


def test_checkpoint_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_legacy_csv_snapshot_is_typed(spark, base):
    spark.createDataFrame([("u", "2025", "3.0"), ("u", "2024", "x"), (None, "2025", "1")], "loc string, lastmod string, path_depth string") \
        .write.csv(f"{base}/s", header=True)
    got = snapshots.load_snapshot(snapshots.read_snapshot_files(spark, f"{base}/s")).collect()
    assert [(r.loc, r.lastmod, r.path_depth, r.domain) for r in got] == [("u", "2025", 3, None)]


def feed(df, path, parts):
    """Write a frame as several files, in an order of their own."""
    for i, cond in enumerate(parts):
        df.where(cond).coalesce(1).write.mode("append").parquet(path)


def test_streams_agree_with_batch_over_several_batches(spark, sf_dir, base):
    from crawldelta.checks.bindings import bind
    from crawldelta.operators import analytics as AN

    log = bind(spark, sf_dir, "c_changes")
    feed(log, f"{base}/in", ["day(detected_at) <= 10", "day(detected_at) between 11 and 20", "day(detected_at) > 20"])
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    SC.write_daily_counts(SC.daily_counts(stream, "60 days"), f"{base}/out", f"{base}/ck").awaitTermination()
    got = {(r.domain, r.day): r.changes for r in SC.read_daily_counts(spark, f"{base}/out").collect()}
    assert got == {(r.domain, r.period): r.changes for r in AN.cadence(log).collect()}

    probes = PR.with_fate(bind(spark, sf_dir, "o_probes"))
    settings = bind(spark, sf_dir, "o_settings")
    feed(probes, f"{base}/p", ["checked_at < '2024-01-11'", "checked_at >= '2024-01-11' and checked_at < '2024-01-21'", "checked_at >= '2024-01-21'"])
    stream = spark.readStream.schema(probes.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/p")
    SS.stream_breaker(stream, settings, f"{base}/b", f"{base}/ckb").awaitTermination()
    assert sorted(SS.read_breaker(spark, f"{base}/b").collect()) == sorted(
        conform(H.breaker_state(H.run_failures(probes), settings), BREAKER).collect())


def test_stream_of_snapshots_equals_upserts(spark, base):
    def snap(ts, urls):
        df = spark.createDataFrame([("d", u, m) for u, m in urls], "domain string, loc string, lastmod string")
        return conform(df.withColumn("detected_at", F.lit(ts).cast("timestamp")), SNAPSHOT)

    one, two = snap(T1, [("a", "1"), ("b", "1")]), snap(T2, [("b", "2"), ("c", "2")])
    batch = AT.upsert_all_time(AT.upsert_all_time(spark.createDataFrame([], ALL_TIME), one, T1), two, T2)
    for name, per_trigger in (("each", 1), ("both", 10)):
        src = f"{base}/{name}"
        for df in (one, two):
            df.coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(SNAPSHOT).option("maxFilesPerTrigger", per_trigger).parquet(src)
        SS.stream_all_time(stream, f"{base}/{name}-out", f"{base}/{name}-ck").awaitTermination()
        got = SS.read_all_time(spark, f"{base}/{name}-out")
        assert sorted(got.collect(), key=lambda r: r.loc) == sorted(batch.collect(), key=lambda r: r.loc)


def test_csv_export_reads_back(spark, base):
    from crawldelta.sources.export import export_csv

    df = spark.createDataFrame([("d", 'a "q", x', ["m"], "2025-01-01 00:00:00.000001")], "domain string, loc string, tags array<string>, at string")
    export_csv(df.withColumn("at", F.col("at").cast("timestamp")), f"{base}/csv", ["domain"])
    r = spark.read.csv(f"{base}/csv", header=True, escape='"').collect()[0]
    assert (r.domain, r.loc, r.tags, r["at"]) == ("d", 'a "q", x', '["m"]', "2025-01-01T00:00:00.000001Z")


@pytest.mark.parametrize("asked", [4, 8, 16])
def test_buckets_are_read_in_the_number_they_were_written_with(spark, base, asked):
    rows = conform(spark.range(1000).select(F.col("id").cast("string").alias("loc"), F.lit("d").alias("domain")), SNAPSHOT)
    state.write_state(rows, base, "1", SNAPSHOT, buckets=8)
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("crawldelta_")]:
        spark.sql(f"DROP TABLE {name}")  # as in a session that does not know the table
    got = state.read_state(spark, base, SNAPSHOT, buckets=asked)
    assert got.groupBy("domain", "loc").count().count() == 1000
    assert len([f for f in got.inputFiles()]) == 8
    state.write_state(rows, f"{base}/plain", "1", SNAPSHOT)
    assert state.read_state(spark, f"{base}/plain", SNAPSHOT, buckets=asked).groupBy("domain", "loc").count().count() == 1000


def test_an_empty_rerun_leaves_nothing(spark, base):
    rows = spark.createDataFrame([("d", "u", "modified")], "domain string, loc string, change_type string")
    changelog.append_changes(rows, base, T1)
    changelog.append_changes(rows.where("false"), base, T1)
    changelog.append_changes(rows, base, T2)
    assert changelog.read_changes(spark, base).count() == 1
    history.append_status_history(rows.withColumn("checked_at", F.lit(T1).cast("timestamp")), f"{base}/h", "1")
    history.append_status_history(rows.withColumn("checked_at", F.lit(T2).cast("timestamp")), f"{base}/h", "1")
    assert [str(r.checked_at) for r in history.read_status_history(spark, f"{base}/h").collect()] == [T2]


def test_no_scratch_table_is_left(spark, base):
    t, out = targets(spark, base), f"{base}/state"
    daily.daily_inventory(spark, t, docs(spark, [("x", "2025")]), out, T1, 4)
    assert not state._SCRATCH


def test_a_faulty_sitemap_removes_nothing(spark, base):
    t, out = targets(spark, base), f"{base}/state"
    daily.daily_inventory(spark, t, docs(spark, [("x", "2025"), ("y", "2025"), ("z", "2025")]), out, T1)
    cut = docs(spark, [("x", "2025"), ("y", "2025"), ("z", "2025")]).withColumn("xml", F.expr("substr(xml, 1, length(xml) - 40)"))
    daily.daily_inventory(spark, t, cut, out, T2)
    log = changelog.read_changes(spark, f"{out}/changes")
    assert {(r.loc[14:], r.change_type) for r in log.collect()} == {(u, "discovered") for u in "xyz"}
    live = {r.loc[14:]: r.is_current_live for r in state.read_state(spark, f"{out}/all_time", ALL_TIME).collect()}
    assert live == {"x": True, "y": True, "z": True}


def test_parts_of_runs_in_any_order_give_one_state(spark):
    def snap(ts, urls):
        df = spark.createDataFrame([("d", u) for u in urls], "domain string, loc string")
        return conform(df.withColumn("detected_at", F.lit(ts).cast("timestamp")), SNAPSHOT)

    parts = [snap(T2, ["b"]), snap(T1, ["a", "b"]), snap(T2, ["c"]), snap(T1, ["c"])]
    whole = SS.fold_snapshots(spark.createDataFrame([], ALL_TIME), parts[0].union(parts[1]).union(parts[2]).union(parts[3]))
    step = spark.createDataFrame([], ALL_TIME)
    for part in parts:
        step = spark.createDataFrame(SS.fold_snapshots(step, part).collect(), ALL_TIME)
    assert sorted(step.collect(), key=lambda r: r.loc) == sorted(whole.collect(), key=lambda r: r.loc)
    assert {r.loc: r.is_current_live for r in step.collect()} == {"a": False, "b": True, "c": True}


def test_forced_runs_count_during_a_backoff(spark):
    days = [("d", "2025-01-01", 10, 9, False), ("d", "2025-01-02", 10, 9, False), ("d", "2025-01-03", 10, 0, True)]
    runs = spark.createDataFrame(days, "domain string, run string, total bigint, failures bigint, forced boolean")
    settings = spark.createDataFrame([("d", 0.5, 3)], "domain string, failure_threshold double, backoff_days int")
    forced = H.breaker_state(runs, settings).first()
    assert (forced.is_open, forced.total_checks, forced.consecutive_high_failures) == (False, 30, 0)
    waiting = H.breaker_state(runs.withColumn("forced", F.lit(False)), settings).first()
    assert (waiting.is_open, waiting.total_checks) == (True, 20)
