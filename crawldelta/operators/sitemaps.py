"""Sitemap documents: classification, links, URL entries, traversal and file facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, strip
from ..functions.xml import entries, read_entries
from ..session import cut_lineage, written

# Tag names of the sitemap protocol.
_INDEX_ROOT, _URL_ROOT = "sitemapindex", "urlset"

_DOC_SCHEMA = (
    "struct<sitemap: array<struct<loc: string, lastmod: string>>, "
    "url: array<struct<loc: string, lastmod: string, changefreq: string, priority: string>>, "
    "_corrupt: string>"
)

# Comments and processing instructions; lazy on one character class, so their length costs no stack.
_NOT_ELEMENTS = r"(?s)<!--.*?-->|<\?.*?\?>"


def root_name(xml: Column) -> Column:
    """Local name of the root element, whatever stands before it; empty if there is none."""
    elements = F.regexp_replace(xml, _NOT_ELEMENTS, "")
    return F.regexp_extract(elements, r"<(?:[^\s<>/:!?]++:)?([^\s<>/:!?]++)", 1)


def parse_sitemaps(docs: DataFrame, recover: bool = True) -> DataFrame:
    """Turn document texts into ``sitemap_type``, ``sitemap``, ``url``, ``fault`` and the text's facts.

    Each document is parsed once, in permissive mode. Of a document that is not
    well formed, or whose entries lie below an unknown root at any depth, every
    complete entry outside comments is read by itself, so that a fault costs no
    entry but its own. ``fault`` is ``recovered`` where entries may be missing,
    ``unreadable`` where there is none, and null for a sound document. Without
    ``recover``, a document that is not well formed is an error.
    """
    xml = F.regexp_replace(F.coalesce(F.col("xml"), F.lit("")), r"^[\s\x{FEFF}]++", "")
    parts = docs.withColumn("_xml", xml)
    parts = parts.withColumns({"_root": root_name(F.col("_xml")), "_doc": _parsed("_xml")})
    root = F.col("_root")
    unread = F.col("_doc").isNull() | F.col("_doc._corrupt").isNotNull()
    parts = parts.withColumn("_broken", (F.col("_xml") == "") | unread)
    sets = {"_sitemaps": F.col("_doc.sitemap"), "_urls": F.col("_doc.url")}
    if recover:
        nothing = F.col("_doc.sitemap").isNull() & F.col("_doc.url").isNull() & ~root.isin(_INDEX_ROOT, _URL_ROOT)
        found = F.when(F.col("_broken") | nothing, entries(F.col("_xml")))
        parts = parts.withColumn("_entries", F.when(F.size(found) > 0, found))
        rescued = F.col("_entries").isNotNull()
        sets = {
            "_sitemaps": F.when(rescued, read_entries(F.col("_entries"), "sitemap")).otherwise(F.col("_doc.sitemap")),
            "_urls": F.when(rescued, read_entries(F.col("_entries"), "url")).otherwise(F.col("_doc.url")),
        }
        unread = unread & ~rescued
    parts = parts.withColumn("_unread", unread).withColumns(sets)
    kind = (
        F.when((F.col("_xml") == "") | F.col("_unread"), "error")
        .when(root.isin(_INDEX_ROOT, _URL_ROOT), root)
        .when(F.col("_sitemaps").isNotNull(), _INDEX_ROOT)
        .when(F.col("_urls").isNotNull(), _URL_ROOT)
        .otherwise("error")
    )
    return (
        parts
        .withColumn("sitemap_type", kind)
        .withColumns(
            {
                "sitemap": F.when(F.col("sitemap_type") == _INDEX_ROOT, F.col("_sitemaps")),
                "url": F.when(F.col("sitemap_type") == _URL_ROOT, F.col("_urls")),
                "fault": F.when(F.col("sitemap_type") == "error", "unreadable").when(F.col("_broken"), "recovered"),
                "content_hash": F.sha2("xml", 256),
                "content_length": F.length("xml").cast("bigint"),
            }
        )
        .drop("_xml", "_root", "_doc", "_broken", "_entries", "_unread", "_sitemaps", "_urls", "xml")
    )


def _parsed(text: str) -> Column:
    return F.from_xml(
        F.col(text),
        F.lit(_DOC_SCHEMA),
        {
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": "_corrupt",
            "ignoreNamespace": "true",
            "attributePrefix": "_attr_",
        },
    )


def classify_sitemaps(docs: DataFrame) -> DataFrame:
    return parse_sitemaps(docs).select("domain", "sitemap_url", "sitemap_type")


def _domain(parsed: DataFrame) -> list[str]:
    return ["domain"] if "domain" in parsed.columns else []


def sitemap_links(parsed: DataFrame) -> DataFrame:
    """One row per child of an index document; blank locations are dropped."""
    # An outer explode: for the plain one Spark infers a filter on the array and
    # pushes it below the parser, which would then run twice per document.
    return (
        parsed.select(*_domain(parsed), F.col("sitemap_url").alias("parent"), F.explode_outer("sitemap").alias("c"))
        .select(
            *_domain(parsed),
            "parent",
            strip(F.col("c.loc")).alias("child"),
            blank_to_null(strip(F.col("c.lastmod"))).alias("child_lastmod"),
        )
        .where(F.col("child") != "")
    )


def url_entries(parsed: DataFrame) -> DataFrame:
    """One row per URL entry with its position; entries without location are skipped."""
    cols = ["lastmod", "changefreq", "priority"]
    return (
        parsed.select(
            "domain", F.col("sitemap_url").alias("sitemap_source_url"), F.posexplode_outer("url").alias("pos", "u")
        )
        .select(
            "domain",
            "sitemap_source_url",
            "pos",
            strip(F.col("u.loc")).alias("loc"),
            *[blank_to_null(strip(F.col(f"u.{c}"))).alias(c) for c in cols],
        )
        .where(F.col("loc") != "")
    )


def _located(array_col: str) -> Column:
    arr = F.col(array_col)
    return F.when(arr.isNotNull(), F.size(F.filter(arr, lambda e: strip(e["loc"]) != "")))


def sitemap_file_facts(parsed: DataFrame) -> DataFrame:
    """Type, content hash, length in characters and number of entries per document."""
    entries = F.coalesce(_located("url"), _located("sitemap"), F.lit(0))
    return parsed.where(F.col("content_length") > 0).select(
        "sitemap_url",
        "domain",
        "sitemap_type",
        entries.alias("url_count"),
        "content_hash",
        "content_length",
        "fetched_at",
    )


def reach_sitemaps(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(domain, sitemap_url, depth) of every sitemap reachable from the roots.

    The domain is the target's and is carried along: a root and its children may
    lie on any host. Breadth-first over the link table, one join per level of
    nesting. Every sitemap is visited once per domain, so cycles end. Each level
    is written to the shared folder: plans stay short and a lost executor costs
    one level.
    """
    edges = links.select(F.col("parent").alias("sitemap_url"), "child").repartition("sitemap_url").distinct()
    edges = cut_lineage(edges)
    visited = cut_lineage(
        roots.select("domain", "sitemap_url").distinct().withColumn("depth", F.lit(0))
    )
    frontier, depth = visited, 0
    while not frontier.isEmpty():
        depth += 1
        frontier = cut_lineage(
            frontier.join(edges, "sitemap_url")
            .select("domain", F.col("child").alias("sitemap_url"))
            .distinct()
            .join(visited, ["domain", "sitemap_url"], "left_anti")
            .withColumn("depth", F.lit(depth))
        )
        visited = visited.unionByName(frontier)
    return visited


def reachable_parsed(roots: DataFrame, docs: DataFrame, recover: bool = True) -> DataFrame:
    """The parsed documents reachable from the roots, under the domain of the target that reaches them.

    Every document is parsed once, where it is read; links and results are read
    from the parsed table, and what is joined has no texts.
    """
    return reachable_of(roots, written(parse_sitemaps(docs, recover), "parsed"))


def reachable_of(roots: DataFrame, parsed: DataFrame) -> DataFrame:
    """The rows of a stored parsed table reachable from the roots, under the domain of the target that reaches them."""
    reached = reach_sitemaps(roots, sitemap_links(parsed)).select("domain", "sitemap_url")
    return parsed.drop("domain").join(reached, "sitemap_url")


def reachable_entries(roots: DataFrame, docs: DataFrame, recover: bool = True) -> DataFrame:
    """URL entries of the sitemaps reachable from the roots, tagged with their source."""
    return url_entries(reachable_parsed(roots, docs, recover))


def _root_of_text() -> Column:
    return root_name(F.coalesce(F.col("xml"), F.lit("")))


def reach_changed(roots: DataFrame, links: DataFrame, last_links: DataFrame) -> DataFrame:
    """(domain, sitemap_url, carried): the sitemaps reachable from the roots; those carried are as in the last run.

    Both link tables are as `sitemap_links` gives them. A sitemap is carried if
    every index that leads to it names the same ``child_lastmod`` as in the last
    run, or is carried itself; its links are then those of the last run and its
    document need not be there. A link without a date carries nothing, and a
    sitemap that is reached as changed once is changed.
    """
    edge = [F.col("parent").alias("sitemap_url"), "child"]
    before = last_links.select(*edge, F.col("child_lastmod").alias("_before"))
    before = before.groupBy("sitemap_url", "child").agg(F.max("_before").alias("_before"))
    now = links.select(*edge, "child_lastmod").groupBy("sitemap_url", "child").agg(
        F.max("child_lastmod").alias("child_lastmod"), F.bool_or(F.col("child_lastmod").isNull()).alias("_undated")
    )
    same = ~F.col("_undated") & F.coalesce(F.col("child_lastmod") == F.col("_before"), F.lit(False))
    live = now.join(before, ["sitemap_url", "child"], "left").select("sitemap_url", "child", same.alias("same"), F.lit(False).alias("carried"))
    old = before.select("sitemap_url", "child", F.lit(True).alias("same"), F.lit(True).alias("carried"))
    edges = written(live.unionByName(old), "edges")
    frontier = written(roots.select("domain", "sitemap_url", F.lit(False).alias("carried")).distinct(), "reached")
    visited = frontier
    while not frontier.isEmpty():
        step = frontier.join(edges, ["sitemap_url", "carried"]).select("domain", F.col("child").alias("sitemap_url"), F.col("same").alias("carried"))
        step = step.groupBy("domain", "sitemap_url").agg(F.min("carried").alias("carried"))
        # A sitemap is gone through again only if it turns out changed after it was carried.
        known = visited.groupBy("domain", "sitemap_url").agg(F.min("carried").alias("_known"))
        fresh = step.join(known, ["domain", "sitemap_url"], "left")
        frontier = written(fresh.where(F.col("_known").isNull() | (F.col("_known") & ~F.col("carried"))).drop("_known"), "reached")
        visited = visited.unionByName(frontier)
    return visited.groupBy("domain", "sitemap_url").agg(F.min("carried").alias("carried"))


def changed_entries(roots: DataFrame, docs: DataFrame, last_links: DataFrame, last_entries: DataFrame,
                    recover: bool = True) -> tuple[DataFrame, DataFrame]:
    """(entries, links) of the sitemaps reachable from the roots, of which only those that changed are parsed.

    ``last_links`` and ``last_entries`` are what the last run gave: its links as
    `sitemap_links` and its entries as `url_entries` tell them. Where the dates
    of the indexes are true, the result is that of a full walk.
    """
    # Index documents say what changed; they are few and parsed for it, once.
    index = written(parse_sitemaps(docs.where(_root_of_text() != _URL_ROOT), recover), "index")
    links = sitemap_links(index)
    walked = written(reach_changed(roots, links, last_links), "walked")
    changed, carried = walked.where(~F.col("carried")).drop("carried"), walked.where("carried").drop("carried")
    wanted = changed.select("sitemap_url").distinct()
    sets = docs.where(_root_of_text() == _URL_ROOT).join(wanted, "sitemap_url", "left_semi")
    found = [url_entries(parsed.drop("domain").join(changed, "sitemap_url")) for parsed in (parse_sitemaps(sets, recover), index)]
    kept = last_entries.join(carried.withColumnRenamed("sitemap_url", "sitemap_source_url"), ["domain", "sitemap_source_url"], "left_semi")
    entries = found[0].unionByName(found[1]).unionByName(kept.select(found[0].columns))
    # The links of carried indexes are those of the last run.
    held = last_links.join(carried.select(F.col("sitemap_url").alias("parent")).distinct(), "parent", "left_semi")
    own = links.join(changed.select(F.col("sitemap_url").alias("parent")).distinct(), "parent", "left_semi")
    return entries, own.unionByName(held.select(own.columns))
