"""Plan shapes under skew, against plain computations."""

import random

import pytest
from pyspark.sql import functions as F

from crawldelta.operators import analytics as AN
from crawldelta.operators import health as H
from crawldelta.plans import keyed as K


def skewed(spark, n=3000, seed=7):
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < 0.5 else f"d{rng.randrange(30)}", f"u{i}", rng.randrange(1000)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "domain string, loc string, v int")


def test_hot_domains_are_few_and_right(spark):
    rows, df = skewed(spark)
    assert [r.domain for r in K.hot_domains(df).collect()] == ["hot"]


def test_join_domains_keeps_every_row(spark):
    rows, df = skewed(spark)
    df = df.unionByName(spark.createDataFrame([(None, "n1", 1), (None, "n2", 2)], df.schema))
    dim_rows = [("hot", 1)] + [(f"d{i}", i) for i in range(0, 30, 2)]
    dim = spark.createDataFrame(dim_rows, "domain string, k int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r.loc: (r.domain, r.k) for r in K.join_domains(df, dim, ["k"], K.hot_domains(df)).collect()}
        lookup = dict(dim_rows)
        assert got == {**{u: (d, lookup.get(d)) for d, u, _ in rows}, "n1": (None, None), "n2": (None, None)}
        absent = {r.loc for r in K.keep_domains(df, dim, present=False).collect()}
        assert absent == {u for d, u, _ in rows if d not in lookup} | {"n1", "n2"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("partitions", [8, 100])
def test_sliced_top_k_is_exact(spark, partitions):
    rows, df = skewed(spark)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    df = df.withColumn("k", F.when(F.col("domain") == "hot", 1200).otherwise(3))
    got = K.top_k_sliced(df, ["domain"], [F.col("v").desc(), F.col("loc")], F.col("k"), ["loc"], rank_as="rank")
    want = set()
    for d in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == d), key=lambda r: (-r[2], r[1]))
        want |= {(d, r[1], i + 1) for i, r in enumerate(mine[: 1200 if d == "hot" else 3])}
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert {(r.domain, r.loc, r["rank"]) for r in got.collect()} == want


def test_literal_top_k_is_cut_before_the_shuffle(spark):
    _, df = skewed(spark, 50)
    plan = K.top_k(df, ["domain"], [F.col("v"), F.col("loc")], 3)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below


def test_percentiles_are_exact(spark):
    rng = random.Random(3)
    rows = [("hot", round(rng.expovariate(0.01), 2)) for _ in range(2000)]
    rows += [("few", 5.0), ("few", 10.0), ("one", 3.25), ("none", 0.0), ("none", None), ("none", -1.0)]
    df = spark.createDataFrame(rows, "domain string, response_time_ms double")
    got = {r.domain: r for r in H.response_percentiles(df).collect()}
    want = {
        r.domain: r for r in df.where("response_time_ms > 0").groupBy("domain")
        .agg(F.count("*").alias("n"), F.expr("percentile(response_time_ms, array(0.5, 0.95))").alias("p")).collect()
    }
    assert set(got) == {"hot", "few", "one"} == set(want)
    for d, r in got.items():
        assert r.probes == want[d].n
        assert abs(r.median_ms - want[d].p[0]) < 1e-9 and abs(r.p95_ms - want[d].p[1]) < 1e-9


def test_lifecycle_of_a_hot_url(spark):
    rng = random.Random(5)
    rows = [("d", "hot", f"2025-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d} {rng.randrange(24):02d}:{i % 60:02d}:{i // 60:02d}", "modified") for i in range(600)]
    rows += [("d", "other", "2025-03-01 00:00:00", "discovered"), ("d", "other", None, "removed")]
    df = spark.createDataFrame(rows, "domain string, loc string, at string, change_type string")
    df = df.select("domain", "loc", "change_type", F.col("at").cast("timestamp").alias("detected_at"))
    out = AN.lifecycle(df, "month").collect()
    assert len(out) == len(rows)
    hot = sorted((r for r in out if r.loc == "hot"), key=lambda r: r.seq)
    assert [r.seq for r in hot] == list(range(1, 601))
    times = [r.detected_at for r in hot]
    assert times == sorted(times)
    assert [r.previous_at for r in hot] == [None, *times[:-1]]


def test_top_k_beyond_the_map_side_bound(spark):
    df = spark.range(3000).select(F.lit("d").alias("domain"), F.col("id").alias("v"))
    assert [r.v for r in K.top_k(df, ["domain"], [F.col("v").desc()], 2000).orderBy("v").collect()] == list(range(1000, 3000))
