"""Entries of faulty sitemap documents, and addresses of stored files."""

import pytest
from pyspark.sql import functions as F

from crawldelta.checks import registry
from crawldelta.checks.bindings import bind
from crawldelta.functions import html, text, xml
from crawldelta.operators import sitemaps as S
from crawldelta.sources.documents import address_of, read_sitemap_docs, stored_name

OPEN, CLOSE = '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">', "</urlset>"


def entry(loc, more=""):
    return f"<url><loc>{loc}</loc>{more}</url>"


def parsed(spark, *bodies):
    docs = spark.createDataFrame([("d", str(i), b) for i, b in enumerate(bodies)], "domain string, sitemap_url string, xml string")
    return S.parse_sitemaps(docs.withColumn("fetched_at", F.lit("2025-12-02").cast("timestamp")))


def locs(spark, *bodies):
    found = S.url_entries(parsed(spark, *bodies)).orderBy("sitemap_source_url", "pos").collect()
    return [[r.loc for r in found if r.sitemap_source_url == str(i)] for i in range(len(bodies))]


A, B, C = entry("https://x/a?p=1&amp;q=2"), entry("https://x/b"), entry("https://x/c")


@pytest.mark.parametrize("fault,own", [
    (entry("https://x/1<2"), "https://x/1<2"),
    (entry("https://x/caf&eacute;"), "https://x/caf\u00e9"),
    (entry("https://x/con\x01trol"), "https://x/control"),
    (entry("https://x/?m=1&n=2&para#p&nosuch;"), "https://x/?m=1&n=2&para#p&nosuch;"),
    ("<!-- " + entry("https://x/gone") + " -->" + entry("https://x/&"), "https://x/&"),
    ("<!-- a -- b --><url><loc><![CDATA[https://x/?u=1&amp;v=<2>]]></loc></url>", "https://x/?u=1&amp;v=<2>"),
    (entry("https://x/i", "<image:image><image:loc>no</image:loc><image:loc>none</image:loc></image:image>"), "https://x/i"),
    ("<url><lastmod>2025</lastmod><!-- <loc>no</loc> --><x:y/><loc >\n https://x/s<![CDATA[?]]>t </loc ></url>", "https://x/s?t"),
])
def test_a_fault_costs_no_other_entry(spark, fault, own):
    broken = OPEN + A + fault + B + "<oops>" + C + CLOSE
    assert locs(spark, broken) == [["https://x/a?p=1&q=2", own, "https://x/b", "https://x/c"]]
    assert parsed(spark, broken).first().fault == "recovered"


@pytest.mark.parametrize("fault", [
    "<url><loc>https://x/half", "<url><loc>https://x/half</url>", "<url><loc>https://x/half<lastmod>2025</lastmod></url>",
    "<![CDATA[" + entry("https://x/no") + "]]>", "<?pi " + entry("https://x/no") + "?>", "<url><lastmod>2025</lastmod></url>", "<url/>", "<url />",
])
def test_what_is_not_whole_is_not_taken(spark, fault):
    assert locs(spark, OPEN + A + fault + B + "<oops>" + CLOSE) == [["https://x/a?p=1&q=2", "https://x/b"]]


def test_what_is_never_closed_hides_the_rest(spark):
    assert locs(spark, OPEN + A + "<!-- " + B, OPEN + A + "<![CDATA[ " + B) == [["https://x/a?p=1&q=2"]] * 2


def test_recovery_reads_sound_documents_as_the_parser_does(spark):
    sound = [
        OPEN + A + entry(" https://x/l&#228;&#x20AC;&lt;&quot;&apos; ", "<lastmod> 2025-01-01 </lastmod><priority>0.5</priority><changefreq/>") + CLOSE,
        "<s:urlset xmlns:s=\"u\" xmlns:v=\"w\"><s:url a='>'><v:v><v:loc>no</v:loc></v:v><s:loc>https://x/p</s:loc></s:url></s:urlset>",
        "<sitemapindex><sitemap><loc>https://x/1.xml</loc><lastmod>2025</lastmod></sitemap><!-- c --><sitemap>\n<loc><![CDATA[https://x/2.xml]]></loc></sitemap></sitemapindex>",
    ]
    rows = parsed(spark, *sound).collect()
    read = spark.createDataFrame([(str(i), s) for i, s in enumerate(sound)], "i string, xml string").select(
        "i", xml.read_entries(xml.entries(F.col("xml")), "url").alias("url"), xml.read_entries(xml.entries(F.col("xml")), "sitemap").alias("sitemap")
    )
    strip = lambda e: [[(v or "").strip() for v in x] for x in e or []]
    for a, b in zip(sorted(rows, key=lambda r: r.sitemap_url), sorted(read.collect(), key=lambda r: r.i)):
        assert a.fault is None and strip(a.url) == strip(b.url) and strip(a.sitemap) == strip(b.sitemap) and (a.url or a.sitemap)


def test_recovery_of_long_documents(spark):
    many = OPEN + "".join(entry(f"https://x/{i}?a&b") for i in range(20_000))
    bad = OPEN + "<url><loc>" + "<" * 200_000, OPEN + "<url>" * 50_000, OPEN + "<!--" * 50_000, OPEN + entry("https://x/" + "y" * 300_000 + "&")
    found = parsed(spark, many, *bad).selectExpr("sitemap_url", "size(url) AS n", "fault").collect()
    assert {r.sitemap_url: r.n for r in found if r.fault == "recovered"} == {"0": 20_000, "4": 1}


def test_index_links_are_rescued_too(spark):
    broken = "<sitemapindex><sitemap><loc>https://x/1.xml?a&b</loc><lastmod>2025</lastmod></sitemap><!-- <sitemap><loc>no</loc></sitemap> --><sitemap><loc>h"
    rows = parsed(spark, broken)
    assert [(r.child, r.child_lastmod) for r in S.sitemap_links(rows).collect()] == [("https://x/1.xml?a&b", "2025")]
    assert S.sitemap_file_facts(rows).first().url_count == 1


NAMES = ["a%20b.xml", "100%.xml", "caf%C3%A9.xml", "a+b.xml", "plain.xml", "\u00fc x.xml", "50%2.xml"]


def test_stored_names_stand_for_themselves(spark, tmp_path):
    host = tmp_path / "docs" / "www.example.com" / "deep"
    host.mkdir(parents=True)
    for n in NAMES:
        (host / n).write_text(f"<urlset>{n}</urlset>")
    got = {r.sitemap_url: (r.domain, r.xml) for r in read_sitemap_docs(spark, str(tmp_path / "docs")).collect()}
    assert got == {f"https://www.example.com/deep/{n}": ("www.example.com", f"<urlset>{n}</urlset>") for n in NAMES}


ADDRESSES = [f"h.example/{n}" for n in NAMES] + [
    "h.example/s.xml?u=/a/b&v=1#x", "h.example/%3Fno.xml", "h.example/%253F.xml", "h.example/%25.xml", "h.example/%%3f%2525", "h.example//x//", "h:80/a\x01b",
    "", "%", "%2", "%2F", "[{^|}]*\"'<>\\",
]


def test_stored_names_are_given_back(spark, tmp_path):
    rows = spark.createDataFrame([(a,) for a in ADDRESSES], "a string").select("a", stored_name(F.col("a")).alias("n"))
    told = rows.select("a", "n", address_of(F.col("n")).alias("back")).collect()
    assert [r.back for r in told] == ADDRESSES and len({r.n for r in told}) == len(ADDRESSES)
    assert not any(set(r.n) & set('/:?*"<>|\\') for r in told)
    folder = tmp_path / "flat"
    folder.mkdir()
    for r in told:
        if r.n:
            (folder / r.n).write_text(r.a)
    assert {r.sitemap_url: r.xml for r in read_sitemap_docs(spark, str(folder), "").collect()} == {a: a for a in ADDRESSES if a}


def test_a_written_crawl_has_one_file_for_each_document(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "scratch", lambda spark, name: f"file:{tmp_path}/a crawl")
    rows = registry.QUERIES["a3_sitemap_file_scan"](spark, sf_dir).count()
    below = list((tmp_path / "a crawl").rglob("*"))
    hosts = bind(spark, sf_dir, "x_docs").select("domain").distinct().count()
    assert len([p for p in below if p.is_file()]) == rows and len([p for p in below if p.is_dir()]) == hosts


REFERENCES = ["&nbsp;", "&nbsp", "&#32;", "&#x20;", "&#X9;", "&#10", "&#00013;x", "&#x0a0;", "&emsp;", "&Tab;", "&NewLine;", "&ThickSpace;", "&#8195;", "&#x2003", "&hairsp;",
              "&amp;", "&nbspx", "&nbsp=1", "&#320;", "&#32f", "&#x20f", "&emsp", "&zwj;", "&#8203;", "&", "&#;", "&eacute;", "&#0;", "&Nbsp;", "&nbsp;;"]


def test_words_are_parted_by_references_as_by_what_they_stand_for(spark):
    texts = [f"a{r}b" for r in REFERENCES] + [f"{r}" for r in REFERENCES] + [f"a {r} b{r}{r}c" for r in REFERENCES]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select("t", html.word_count(F.col("t")).alias("n"), text.count_words(text.decode_entities(F.col("t"))).alias("want")).collect()
    assert [(r.t, r.n) for r in got] == [(r.t, r.want) for r in got]
