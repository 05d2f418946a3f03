"""Blocks of changed pages, percentiles from stored day counts, candidates of some domains, and plans that read little."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from crawldelta.functions.blocks import content_blocks
from crawldelta.operators import analytics as AN
from crawldelta.operators import candidates as CA
from crawldelta.operators import health as H


def blocks_of(spark, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [[(b.hash, b.words) for b in r.b] for r in rows.select("i", content_blocks(F.col("t")).alias("b")).orderBy("i").collect()]


def test_an_edit_moves_the_blocks_around_it_only(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(500)}" for _ in range(2000)]
    edited = [*words[:700], "new", *words[701:1300], *words[1310:]]
    plain, spaced, other, empty, none, one = blocks_of(spark, " ".join(words), " \n".join(words) + " ", " ".join(edited), " ", None, "one")
    assert plain == spaced and sum(n for _, n in plain) == 2000 and 60 < len(plain) < 250
    assert len(set(plain) - set(other)) <= 6 and sum(n for _, n in other) == 1990
    assert empty == [] and none == [] and [n for _, n in one] == [1]


def page(*paragraphs):
    return "<html><script>x</script><body>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</body></html>"


def test_block_changes(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    a, b, c = text(300), text(300), text(300)
    old = [("same", page(a, b)), ("edit", page(a, b, c)), ("gone", page(a)), ("void", page()), ("null", None), (None, page(a))]
    new = [("same", page(a, b).replace("x", "y")), ("edit", page(a, text(300), c)), ("new", page(a)), ("void", page(b)), ("null", page(c)), (None, page(b))]
    frames = [spark.createDataFrame(x, "url string, html string") for x in (new, old)]
    got = {r.url: r for r in AN.block_changes(*frames).collect()}
    assert set(got) == {"edit", None}
    assert 300 <= got["edit"].added <= 400 and 300 <= got["edit"].removed <= 400 and 0.3 < got["edit"].changed_share < 0.45
    assert got[None].changed_share == 1 and got["edit"].words == got["edit"].words_before == 900


def history(spark, n=4000):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        v = rng.choice([None, 0.0, -1.0, round(rng.lognormvariate(4, 2), 3), 17.0, 1e-9, 3e9])
        rows.append((rng.choice(["hot", "hot", "hot", "b", "c", None]), dt.datetime(2025, 12, rng.randint(1, 20), rng.randint(0, 23)), v))
    return spark.createDataFrame(rows, "domain string, checked_at timestamp, response_time_ms double").repartition(3)


def test_percentiles_of_any_days(spark, tmp_path):
    rows = history(spark).cache()
    H.write_day_counts(rows, str(tmp_path))
    for first, last in (("2025-12-01", "2025-12-20"), ("2025-12-03", "2025-12-03"), ("2025-12-07", "2025-12-15"), ("2026-01-01", "2026-01-02")):
        want = H.response_percentiles(rows.where(F.to_date("checked_at").between(first, last)))
        got = H.percentiles_over_days(spark, str(tmp_path), first, last)
        flat = lambda df: sorted(((r.domain, r.probes, round(r.median_ms, 6), round(r.p95_ms, 6)) for r in df.collect()), key=str)
        assert flat(got) == flat(want)


def test_a_day_that_is_written_again_is_replaced(spark, tmp_path):
    one = lambda v: spark.createDataFrame([("d", dt.datetime(2025, 12, 1), v)], "domain string, checked_at timestamp, response_time_ms double")
    for v in (5000.0, 7.0):
        H.write_day_counts(one(v), str(tmp_path))
    (r,) = H.percentiles_over_days(spark, str(tmp_path), "2025-12-01", "2025-12-02").collect()
    assert (r.probes, r.median_ms, r.p95_ms) == (1, 7.0, 7.0)
    assert spark.read.parquet(f"{tmp_path}/values").count() == 1


def test_values_are_read_of_few_octaves(spark, tmp_path):
    H.write_day_counts(history(spark), str(tmp_path))
    plan = H.percentiles_over_days(spark, str(tmp_path), "2025-12-01", "2025-12-20")._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "/values]" in x)
    read = re.search(r"octave#[0-9]+ (?:INSET|IN) ([^,]*(?:,[^,\])]+)*)", scan)
    assert "PartitionFilters" in scan and read
    held = {r.octave for r in spark.read.parquet(f"{tmp_path}/values").select("octave").distinct().collect()}
    assert len(re.findall(r"-?[0-9]+", read[1])) <= 6 < len(held)


def test_candidates_of_some_domains(spark):
    log = spark.createDataFrame([(d, f"u{i}", "removed", dt.datetime(2025, 12, 1)) for d in ("a", "b", "c") for i in range(5)],
                                "domain string, loc string, change_type string, detected_at timestamp")
    settings = CA.status_settings(spark.createDataFrame([("a", None), ("b", None)], "domain string, sitemap_url string").withColumn(
        "status_check", F.lit(None).cast("struct<enabled:boolean,check_new:boolean,check_updated:boolean,check_removed:boolean,max_per_run:int,failure_threshold:double,backoff_days:int,timeout:int,user_agent:string>")))
    all_of = CA.probe_candidates(log, settings, "2025-12-02 00:00:00", limit=2)
    some = CA.probe_candidates(log, settings, "2025-12-02 00:00:00", limit=2, domains=settings.where("domain = 'b'").select("domain"))
    assert sorted({r.domain for r in all_of.collect()}) == ["a", "b", "c"]
    assert sorted((r.domain, r.loc) for r in some.collect()) == [("b", "u0"), ("b", "u1")]
