"""Page metadata on hand-written pages."""

import json

import pytest

from pyspark.sql import functions as F

from crawldelta.functions.text import count_words, decode_entities, strip
from crawldelta.operators import pages as P

FULL = """<!DOCTYPE html><html><head><title> A &amp; B <!-- x --> </title>
<!-- <meta name="robots" content="none"> -->
<meta content='Some "desc" &#8217; &#x41;' NAME="Description"><meta name=robots content=NOINDEX,follow>
<link rel="alternate" href="/rss"><link href="https://x.com/a/" rel="canonical">
<meta property="og:title" content="OG > t"><meta property="og:description" content="">
<script type="application/ld+json">{"@context":"x","@type":"Article","author":{"@type":"Person"}}</script>
<script type='application/ld+json'>[{"@type":["A","B"]},{"@type":"C"},3,{"x":1}]</script>
<script type="application/ld+json">{bad</script>
<script>var t="<h1>no</h1></p><title>no</title>";</script><style>p{}</style></head>
<body><h1 class="x"> Hi <b>there&nbsp;</b> you </h1><h1>two</h1><p>one two&nbsp;three<br>four</p></body></html>"""


@pytest.fixture(scope="module")
def rows(spark):
    cases = [
        ("https://x.com/a", FULL, 200, None),
        ("https://x.com/404", FULL, 404, None),
        ("https://x.com/bare", "<html></html>", 200, None),
        ("https://x.com/moved", '<link rel="canonical" href="https://x.com/new/">', 200, "https://x.com/new"),
        ("https://x.com/long", f"<title>{'t' * 600}</title><h1>{'h' * 300}</h1>", 200, None),
        ("https://x.com/none", '<meta name="robots" content="max-image-preview:none">', 200, None),
    ]
    df = spark.createDataFrame(cases, "url string, html string, content_status_code int, final_url string")
    return {r.url: r for r in P.page_report(df).collect()}


def test_full_page(rows):
    r = rows["https://x.com/a"]
    assert (r.c_title, r.c_title_length) == ("A & B", 5)
    assert (r.c_meta_description, r.c_meta_description_length) == ('Some "desc" ’ A', 15)
    assert r.c_meta_robots == "noindex,follow"
    assert (r.c_canonical, r.c_canonical_is_self) == ("https://x.com/a/", True)
    assert (r.c_og_title, r.c_og_description) == ("OG > t", None)
    assert (r.c_h1, r.c_h1_count) == ("Hithereyou", 2)
    assert r.c_word_count == 11
    assert r.c_schema_types == "Article,A,B,C"
    assert r.inferred_indexable is False and r.content_error is None
    meta = json.loads(r.content_meta_json)
    assert meta["og_description"] is None and meta["schema_types"] == ["Article", "A", "B", "C"]


def test_failed_fetch_reads_no_body(rows):
    r = rows["https://x.com/404"]
    assert r.content_error == "status_404" and r.inferred_indexable is False
    assert r.c_title is None and r.c_h1_count == 0 and r.content_meta_json is None


def test_verdicts(rows):
    assert rows["https://x.com/bare"].inferred_indexable is True
    assert rows["https://x.com/moved"].c_canonical_is_self is True
    assert rows["https://x.com/none"].inferred_indexable is False


def test_caps(rows):
    r = rows["https://x.com/long"]
    assert r.c_title_length == 500 and len(r.c_h1) == 200


def test_text_helpers(spark):
    cases = ["a &amp; b", "&eacute;&#39;&#x2019;&apos;", "&unknown; & &amp", "&#99999999;", "", " \t x y z\r\n"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = [tuple(r) for r in df.select(decode_entities(df.s), strip(df.s), count_words(df.s)).collect()]
    assert [g[0] for g in got[:5]] == ["a & b", "é'’'", "&unknown; & &", "&#99999999;", ""]
    assert [g[1] for g in got] == [c.strip() for c in cases]
    assert [g[2] for g in got] == [len(c.split()) for c in cases]


def test_comments_and_scripts_whichever_comes_first(spark):
    html = ('<script>var a="<!--";</script><title>T&lbrack;1&#0000000093;</title><!-- <script> --><h1>H &copy 2</h1>'
            '<p>x&#8195;y&nbsp;z</p><script type="application/ld+json">{"@type":"A","x":"<!-- y -->"}</script>')
    meta = P.page_meta(spark.createDataFrame([("u", html)], "url string, html string")).first()
    assert (meta.c_title, meta.c_h1, meta.c_word_count, meta.c_schema_types) == ("T[1]", "H \u00a9 2", 7, "A")


def test_references_without_semicolon(spark):
    rows = [("a&ampb", "a&ampb"), ("a&amp b", "a& b"), ("?x=1&copy=2", "?x=1&copy=2"), ("&#65 &#x42;", "A B"), ("&nosuch; &", "&nosuch; &"), ("&Tab;x", "\tx")]
    df = spark.createDataFrame(rows, "raw string, want string").select(decode_entities(F.col("raw")).alias("got"), "want")
    assert [r.got for r in df.collect()] == [w for _, w in rows]


def test_checks_that_raised_or_have_no_status(spark):
    rows = [("a", None, 200, "ReadTimeout", None), ("b", None, None, None, None), ("c", None, 0, "ValueError", "odd"), ("d", "<p>x", 200, None, None)]
    df = spark.createDataFrame(rows, "url string, html string, content_status_code int, exception_type string, exception_message string")
    got = {r.url: (r.content_status_code, r.content_error, r.inferred_indexable, r.content_meta_json is None) for r in P.page_report(df).collect()}
    assert got == {"a": (0, "timeout", False, True), "b": (0, "status_0", False, True), "c": (0, "odd", False, True), "d": (200, None, True, False)}
