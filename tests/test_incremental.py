"""Sitemaps that did not change: texts are parsed once, subtrees of the same date are carried over."""

import json

from pyspark.sql import functions as F

from crawldelta.operators import sitemaps as S
from crawldelta.plans import daily
from crawldelta.sources import documents, parsed

DDL = "domain string, sitemap_url string, xml string"


def urlset(*locs):
    return "<urlset>" + "".join(f"<url><loc>{x}</loc></url>" for x in locs) + "</urlset>"


def index(*links):
    return "<sitemapindex>" + "".join(f"<sitemap><loc>{u}</loc>{f'<lastmod>{d}</lastmod>' if d else ''}</sitemap>" for u, d in links) + "</sitemapindex>"


def docs(spark, texts):
    rows = spark.createDataFrame([("d", u, x) for u, x in texts.items()], DDL)
    return rows.withColumn("fetched_at", F.lit("2025-12-02").cast("timestamp"))


def told(df):
    return sorted(map(str, df.select("domain", "sitemap_url", "sitemap_type", "fault", "content_hash", "content_length", "url", "sitemap").collect()))


def test_a_text_is_parsed_once(spark, tmp_path):
    day1 = {f"{i}.xml": urlset(f"https://x/{i}", "https://x/same") for i in range(100)} | {"copy.xml": urlset("https://x/0", "https://x/same"), "void.xml": "", "null.xml": None, "bad.xml": "<urlset><url><loc>https://x/b</loc></url><url>"}
    ledger = f"{tmp_path}/ledger"
    first = docs(spark, day1)
    assert parsed.parse_unseen(first, ledger) == 102 and parsed.parse_unseen(first, ledger) == 0
    plain = lambda d: S.parse_sitemaps(d.withColumn("xml", F.coalesce("xml", F.lit(""))))
    assert told(parsed.parse_by_hash(first, ledger)) == told(plain(first))
    day2 = docs(spark, day1 | {"7.xml": urlset("https://x/new")})
    assert parsed.parse_unseen(day2, ledger) == 1
    assert told(parsed.parse_by_hash(day2, ledger)) == told(plain(day2))
    # A text that two runs appended counts once.
    spark.read.parquet(ledger).limit(5).write.mode("append").parquet(f"{tmp_path}/more")
    spark.read.parquet(f"{tmp_path}/more").write.mode("append").parquet(ledger)
    assert parsed.parse_by_hash(day2, ledger).count() == 104
    parsed.prune_ledger(day2, ledger, f"{tmp_path}/pruned")
    assert spark.read.parquet(f"{tmp_path}/pruned").count() == 102 and parsed.parse_unseen(day2, f"{tmp_path}/pruned") == 0


def test_daily_job_with_a_ledger(spark, tmp_path):
    with open(f"{tmp_path}/c.json", "w") as f:
        json.dump({"targets": [{"domain": "d", "sitemap_url": "i.xml"}]}, f)
    targets = documents.read_targets(spark, f"{tmp_path}/c.json")
    texts = {"i.xml": index(("a.xml", None), ("b.xml", None)), "a.xml": urlset("https://d/1", "https://d/2"), "b.xml": urlset("https://d/3")}
    for day, change in ((1, {}), (2, {"b.xml": urlset("https://d/4")})):
        texts |= change
        for base, ledger in (("plain", None), ("ledger", f"{tmp_path}/parsed")):
            daily.daily_inventory(spark, targets, docs(spark, texts), f"{tmp_path}/{base}", f"2025-12-0{day} 06:00:00", parsed_ledger=ledger).collect()
    read = lambda base: sorted(map(str, spark.read.parquet(f"{tmp_path}/{base}/changes").collect()))
    assert read("plain") == read("ledger") and len(read("plain")) == 5
    assert spark.read.parquet(f"{tmp_path}/parsed").count() == 4


LAST = {
    "root": index(("i1", "1"), ("i2", "1"), ("flat", None)),
    "i1": index(("i11", "1"), ("u12", "1")), "i11": index(("u111", "1"), ("u112", "1")),
    "u111": urlset("https://d/111"), "u112": urlset("https://d/112"), "u12": urlset("https://d/12"),
    "i2": index(("u21", "1"), ("u22", None), ("shared", "1")), "u21": urlset("https://d/21"), "u22": urlset("https://d/22"),
    "flat": urlset("https://d/f"), "shared": urlset("https://d/s"), "x": urlset("https://d/unreached"),
}


def walk(spark, now, fetched):
    roots = spark.createDataFrame([("d", "root")], "domain string, sitemap_url string")
    last = S.reachable_parsed(roots, docs(spark, LAST))
    asked = docs(spark, {u: (x if u in fetched else None) for u, x in now.items()})
    entries, links = S.changed_entries(roots, asked, S.sitemap_links(last), S.url_entries(last))
    full = S.reachable_parsed(roots, docs(spark, now))
    pairs = lambda df: sorted((r.sitemap_source_url, r.loc) for r in df.collect())
    edges = lambda df: sorted((r.parent, r.child) for r in df.collect())
    assert pairs(entries) == pairs(S.url_entries(full)) and edges(links) == edges(S.sitemap_links(full))


def test_nothing_changed(spark):
    walk(spark, LAST, {"root", "flat"})


def test_a_leaf_three_levels_down_changed(spark):
    now = LAST | {"root": index(("i1", "2"), ("i2", "1"), ("flat", None)), "i1": index(("i11", "2"), ("u12", "1")),
                  "i11": index(("u111", "2"), ("u112", "1")), "u111": urlset("https://d/111", "https://d/more")}
    walk(spark, now, {"root", "flat", "i1", "i11", "u111"})


def test_a_sitemap_reached_as_changed_elsewhere_is_changed(spark):
    now = LAST | {"root": index(("i1", "2"), ("i2", "1"), ("flat", None)), "i1": index(("i11", "1"), ("shared", "2")),
                  "shared": urlset("https://d/s2")}
    walk(spark, now, {"root", "flat", "i1", "shared"})


def test_new_undated_and_cyclic_links(spark):
    now = LAST | {"root": index(("i1", "1"), ("i3", "1"), ("flat", "1")), "i3": index(("root", "1"), ("u31", "1"), ("i3", None)), "u31": urlset("https://d/31"),
                  "flat": urlset("https://d/f2")}
    walk(spark, now, {"root", "flat", "i3", "u31"})
