"""Sitemap documents: types, links, entries, traversal."""

import pytest
from pyspark.sql import functions as F

from crawldelta.operators import sitemaps as S

NS = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
INDEX = f"""<?xml version="1.0"?><!-- index --><sitemapindex {NS}>
 <sitemap><loc> a.xml
 </loc><lastmod>2025-01-01</lastmod></sitemap><sitemap><loc>missing.xml</loc></sitemap>
 <sitemap><loc>  </loc></sitemap><sitemap><lastmod>2025-01-02</lastmod></sitemap>
 <sitemap><loc>inner.xml</loc></sitemap></sitemapindex>"""
URLSET = f"""
 <?xml version="1.0" encoding="UTF-8"?><urlset {NS} xmlns:image="http://x"><url><loc>https://x/a?b=1&amp;c=2</loc>
 <lastmod>2025</lastmod><changefreq>daily</changefreq><priority>0.8</priority><image:image><image:loc>no</image:loc></image:image></url>
 <url><loc><![CDATA[https://x/b]]></loc></url><url><lastmod>2025-02-02</lastmod></url></urlset>"""
DOCS = [
    ("d", "index.xml", INDEX),
    ("d", "inner.xml", f"<sitemapindex {NS}><sitemap><loc>index.xml</loc></sitemap><sitemap><loc>b.xml</loc></sitemap></sitemapindex>"),
    ("d", "a.xml", URLSET),
    ("d", "b.xml", f"<urlset {NS}><url><loc>https://x/one</loc></url></urlset>"),
    ("d", "empty.xml", f"<urlset {NS}></urlset>"),
    ("d", "self.xml", f"<urlset {NS}/>"),
    ("d", "broken.xml", "<urlset><url><loc>https://x/c</loc></url><url>"),
    ("d", "void.xml", ""),
    ("d", "null.xml", None),
    ("d", "root.xml", '<root xmlns:sm="http://www.sitemaps.org/schemas/sitemap/0.9"><sm:url><sm:loc>https://x/q</sm:loc></sm:url></root>'),
    ("d", "rootindex.xml", "<r><sitemap><loc>z.xml</loc></sitemap></r>"),
    ("d", "other.xml", "<root><x/></root>"),
    ("d", "text.xml", "not found"),
    ("d", "prefixed.xml", '<sm:urlset xmlns:sm="http://www.sitemaps.org/schemas/sitemap/0.9"><sm:url><sm:loc>https://x/p</sm:loc></sm:url></sm:urlset>'),
    ("e", "index.xml", f"<sitemapindex {NS}><sitemap><loc>a.xml</loc></sitemap></sitemapindex>"),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(DOCS, "domain string, sitemap_url string, xml string")
    return df.withColumn("fetched_at", F.lit("2025-12-02").cast("timestamp"))


@pytest.fixture(scope="module")
def parsed(docs):
    return S.parse_sitemaps(docs)


def test_types(parsed):
    got = {r.sitemap_url: r.sitemap_type for r in parsed.where("domain = 'd'").collect()}
    assert got == {
        "index.xml": "sitemapindex", "inner.xml": "sitemapindex", "rootindex.xml": "sitemapindex",
        "a.xml": "urlset", "b.xml": "urlset", "empty.xml": "urlset", "self.xml": "urlset",
        "root.xml": "urlset", "prefixed.xml": "urlset", "broken.xml": "urlset",
        "void.xml": "error", "null.xml": "error", "other.xml": "error", "text.xml": "error",
    }


def test_links_are_stripped_and_blanks_dropped(parsed):
    got = {(r.child, r.child_lastmod) for r in S.sitemap_links(parsed).where("parent = 'index.xml' and domain = 'd'").collect()}
    assert got == {("a.xml", "2025-01-01"), ("missing.xml", None), ("inner.xml", None)}


def test_entries(parsed):
    rows = S.url_entries(parsed).where("sitemap_source_url = 'a.xml'").orderBy("pos").collect()
    assert [(r.pos, r.loc, r.lastmod, r.changefreq, r.priority) for r in rows] == [
        (0, "https://x/a?b=1&c=2", "2025", "daily", "0.8"),
        (1, "https://x/b", None, None, None),
    ]


def test_facts(parsed):
    got = {r.sitemap_url: (r.url_count, r.content_length) for r in S.sitemap_file_facts(parsed).where("domain = 'd'").collect()}
    assert got["a.xml"] == (2, len(URLSET)) and got["index.xml"][0] == 3
    assert got["broken.xml"][0] == 1 and "void.xml" not in got and "null.xml" not in got


def test_traversal_ends_on_cycles(spark, docs, parsed):
    roots = spark.createDataFrame([("d", "index.xml"), ("d", "index.xml")], "domain string, sitemap_url string")
    reached = {(r.domain, r.sitemap_url): r.depth for r in S.reach_sitemaps(roots, S.sitemap_links(parsed)).collect()}
    assert reached == {
        ("d", "index.xml"): 0, ("d", "a.xml"): 1, ("d", "missing.xml"): 1, ("d", "inner.xml"): 1, ("d", "b.xml"): 2,
    }
    entries = {(r.sitemap_source_url, r.loc) for r in S.reachable_entries(roots, docs).collect()}
    assert entries == {
        ("a.xml", "https://x/a?b=1&c=2"), ("a.xml", "https://x/b"), ("b.xml", "https://x/one"),
    }


def test_recovery_keeps_complete_elements(spark, docs):
    cut = f"<urlset {NS}><url><loc>https://x/a&amp;b</loc><lastmod>2025</lastmod></url><url><loc> <![CDATA[https://x/c]]> </loc></url><url><loc>https://x/tru"
    index = f"<sitemapindex {NS}><sitemap><loc>a.xml</loc></sitemap><sitemap><loc>b.x"
    more = spark.createDataFrame([("d", "cut", cut), ("d", "cutindex", index), ("d", "junk", "<urlset><p"),
                                  ("d", "amp", f"<urlset {NS}><url><loc>https://x/?a=1&b=2&amp;c</loc></url></urlset>")], "domain string, sitemap_url string, xml string")
    more = docs.unionByName(more.withColumn("fetched_at", F.lit("2025-12-02").cast("timestamp")))
    parsed = S.parse_sitemaps(more)
    faults = {r.sitemap_url: r.fault for r in parsed.where("domain = 'd'").collect()}
    assert {faults[k] for k in ("cut", "amp", "broken.xml")} == {"recovered"} and faults["a.xml"] is None
    assert {faults[k] for k in ("junk", "void.xml", "text.xml")} == {"unreadable"} and faults["empty.xml"] is None
    types = {r.sitemap_url: r.sitemap_type for r in parsed.collect()}
    assert (types["cut"], types["cutindex"], types["broken.xml"]) == ("urlset", "sitemapindex", "urlset")
    assert {types[k] for k in ("junk", "void.xml", "null.xml", "text.xml", "other.xml")} == {"error"}
    got = [(r.loc, r.lastmod) for r in S.url_entries(parsed).where("sitemap_source_url = 'cut'").orderBy("pos").collect()]
    assert got == [("https://x/a&b", "2025"), ("https://x/c", None)]
    assert [r.loc for r in S.url_entries(parsed).where("sitemap_source_url = 'amp'").collect()] == ["https://x/?a=1&b=2&c"]
    assert [r.child for r in S.sitemap_links(parsed).where("parent = 'cutindex'").collect()] == ["a.xml"]
    # Well-formed documents are read as without recovery.
    plain = S.url_entries(S.parse_sitemaps(docs)).where("sitemap_source_url <> 'broken.xml'")
    assert plain.exceptAll(S.url_entries(parsed)).count() == 0


def test_documents_are_parsed_once(parsed):
    for df in (S.url_entries(parsed), S.sitemap_links(parsed)):
        # Entries of faulty documents are read by patterns, not by a second parser.
        assert df._jdf.queryExecution().executedPlan().toString().count("from_xml(") == 1


def test_anything_may_stand_before_the_root(spark):
    blank = " \n" * 50_000
    sound = f"<urlset {NS}><url><loc>https://x/a</loc></url></urlset>"
    texts = [blank + sound, f'{blank}<?xml version="1.0"?>{blank}{sound}', f'<?xml version="1.0"?>{"<!-- c -->" * 20_000}{blank}{sound}',
             f"<!-- <r> {blank} -->{sound}", "\ufeff" + sound]
    docs = spark.createDataFrame([("d", f"{i}.xml", t) for i, t in enumerate(texts)], "domain string, sitemap_url string, xml string")
    parsed = S.parse_sitemaps(docs.withColumn("fetched_at", F.lit(None).cast("timestamp")))
    assert [r.sitemap_type for r in parsed.collect()] == ["urlset"] * len(texts)
    assert S.url_entries(parsed).count() == len(texts)


def test_entries_below_an_unknown_root(spark):
    xml = f"<feed><page><url {NS}><loc>https://x/deep</loc></url></page></feed>"
    docs = spark.createDataFrame([("d", "deep.xml", xml, None)], "domain string, sitemap_url string, xml string, fetched_at timestamp")
    assert [r.loc for r in S.url_entries(S.parse_sitemaps(docs)).collect()] == ["https://x/deep"]


def test_the_domain_is_the_targets_on_any_host(spark):
    index = f"<sitemapindex {NS}><sitemap><loc>https://cdn.b.net/s.xml</loc></sitemap></sitemapindex>"
    leaf = f"<urlset {NS}><url><loc>https://www.a.com/1</loc></url></urlset>"
    docs = spark.createDataFrame([("www.a.com", "https://www.a.com/sitemap.xml", index, None), ("cdn.b.net", "https://cdn.b.net/s.xml", leaf, None)],
                                 "domain string, sitemap_url string, xml string, fetched_at timestamp")
    roots = spark.createDataFrame([("a.com", "https://www.a.com/sitemap.xml"), ("c.com", "https://cdn.b.net/s.xml")], "domain string, sitemap_url string")
    got = {(r.domain, r.sitemap_source_url, r.loc) for r in S.reachable_entries(roots, docs).collect()}
    assert got == {(d, "https://cdn.b.net/s.xml", "https://www.a.com/1") for d in ("a.com", "c.com")}
