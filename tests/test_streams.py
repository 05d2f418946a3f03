"""Streams write what they change: late rows, state by batch, folded batches, batches that are run again."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from crawldelta.operators import analytics as AN
from crawldelta.schemas import SNAPSHOT, conform
from crawldelta.streaming import changes as SC
from crawldelta.streaming import deltas
from crawldelta.streaming import state as SS


def snap(spark, ts, urls):
    df = spark.createDataFrame([("d" if u < "m" else "e", u, m) for u, m in urls], "domain string, loc string, lastmod string")
    return conform(df.withColumn("detected_at", F.lit(ts).cast("timestamp")), SNAPSHOT)


def days(n):
    return f"2025-12-{n:02d} 06:00:00"


RUNS = [(1, [(f"u{i}", "1") for i in range(200)] + [("a", "1")]), (2, [("a", "2")]), (3, [("b", "1"), ("u7", "3")]), (4, [("a", "4")])]


@pytest.fixture
def table(spark, tmp_path):
    """The table after each run, each a batch, and the folders."""
    base, got = str(tmp_path), []
    for n, urls in RUNS:
        snap(spark, days(n), urls).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(SNAPSHOT).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        SS.stream_all_time(stream, f"{base}/out", f"{base}/ck").awaitTermination()
        got.append(rows(SS.read_all_time(spark, f"{base}/out")))
    return base, got


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_batch_writes_the_rows_that_it_changes(spark, table):
    base, got = table
    written = [spark.read.parquet(f"{base}/out/seen/batch_id={n}").count() for n in range(4)]
    assert written == [201, 1, 2, 1]
    batch = None
    for (n, urls), state in zip(RUNS, got):
        run = snap(spark, days(n), urls)
        batch = run if batch is None else batch.unionByName(run)
        assert state == rows(SS.fold_snapshots(spark.createDataFrame([], SS.ALL_TIME), batch))


def test_folding_batches_changes_nothing(spark, table):
    base, got = table
    assert SS.compact_all_time(spark, f"{base}/out") == 3
    assert deltas.batch_ids(spark, f"{base}/out/seen") == [3] and rows(SS.read_all_time(spark, f"{base}/out")) == got[-1]
    assert SS.compact_all_time(spark, f"{base}/out") == 0
    # The last batch may come again, and the stream goes on.
    again = spark.read.schema(SS.SEEN).parquet(f"{base}/out/seen/batch_id=3").cache()
    again.count()
    deltas.write_batch(again, f"{base}/out/seen", 3)
    snap(spark, days(5), [("c", "5")]).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(SNAPSHOT).parquet(f"{base}/in")
    SS.stream_all_time(stream, f"{base}/out", f"{base}/ck").awaitTermination()
    assert SS.compact_all_time(spark, f"{base}/out") == 1
    now = {r.loc: r for r in SS.read_all_time(spark, f"{base}/out").collect()}
    assert len(now) == 203 and now["c"].is_current_live and not now["a"].is_current_live and now["a"].last_lastmod == "4"
    assert now["a"].first_seen_at == dt.datetime(2025, 12, 1, 6)


LOG = "domain string, change_type string, detected_at timestamp"


def changes(spark, *stamps):
    data = [("d", "modified" if i % 2 else "removed", dt.datetime.fromisoformat(s) if s else None) for i, s in enumerate(stamps)]
    return spark.createDataFrame(data, LOG)


def test_late_rows_are_counted_kept_and_read(spark, tmp_path):
    base = str(tmp_path)
    feeds = [["2025-12-10 10:00", "2025-12-09 10:00", None], ["2025-12-01 10:00", "2025-12-08 09:00", "2025-12-08 23:00"],
             ["2025-12-12 00:00", "2025-12-01 11:00"], ["2025-12-09 23:59", "2025-12-10 00:00"]]
    for feed in feeds:
        changes(spark, *feed).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    SC.stream_daily_counts(stream, f"{base}/out", f"{base}/ck", "2 days").awaitTermination()
    every = changes(spark, *sum(feeds, []))
    got = {r.day.isoformat(): (r.changes, r.late) for r in SC.read_counts(spark, f"{base}/out").collect()}
    assert {d: n for d, (n, _) in got.items()} == {r.period.isoformat(): r.changes for r in AN.cadence(every).collect()}
    # The third batch puts the watermark at the start of the 10th.
    assert {d: n for d, (_, n) in got.items() if n} == {"2025-12-01": 2, "2025-12-09": 1}
    late = sorted(r.detected_at.isoformat() for r in SC.read_late(spark, f"{base}/out", every).collect())
    assert late == ["2025-12-01T10:00:00", "2025-12-01T11:00:00", "2025-12-09T23:59:00"]
    assert SC.compact_counts(spark, f"{base}/out") == 3
    assert {r.day.isoformat(): (r.changes, r.late) for r in SC.read_counts(spark, f"{base}/out").collect()} == got


def test_nothing_read_nothing_told(spark, tmp_path):
    assert SC.read_counts(spark, f"{tmp_path}/no").count() == 0 and SS.read_all_time(spark, f"{tmp_path}/no").count() == 0
    assert SS.read_breaker(spark, f"{tmp_path}/no").count() == 0 and deltas.compact(spark, f"{tmp_path}/no", SS.SEEN, SS.merge_seen) == 0
    assert SC.read_late(spark, f"{tmp_path}/no", changes(spark)).count() == 0
