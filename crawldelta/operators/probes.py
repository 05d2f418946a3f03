"""Probe results: normalisation, classification and the redirect map.

All operators here are narrow: they add columns to the probe table and can be
chained into a single stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import netloc

# Response headers kept as their own columns.
HEADER_COLUMNS = {
    "h_etag": "ETag",
    "h_last_modified": "Last-Modified",
    "h_content_length": "Content-Length",
    "h_content_type": "Content-Type",
    "h_cache_control": "Cache-Control",
    "h_age": "Age",
    "h_vary": "Vary",
    "h_x_robots_tag": "X-Robots-Tag",
    "h_link": "Link",
    "h_x_cache": "X-Cache",
    "h_cf_cache_status": "CF-Cache-Status",
}

# Exception classes per error label; the first match counts.
ERROR_LABELS = {
    "timeout": ("Timeout", "ConnectTimeout", "ReadTimeout"),
    "connection_error": ("ConnectionError", "ProxyError", "SSLError"),
    "too_many_redirects": ("TooManyRedirects",),
}
ERROR_TEXT_CAP = 100


def with_error(probes: DataFrame) -> DataFrame:
    """Add ``error``; a probe that raised has status 0.

    Reads ``exception_type`` and ``exception_message``, both null for a probe
    that was answered.
    """
    kind = F.col("exception_type")
    label = F.lit(None).cast("string")
    for name, classes in reversed(list(ERROR_LABELS.items())):
        label = F.when(kind.isin(*classes), name).otherwise(label)
    text = F.substring(F.coalesce("exception_message", F.lit("")), 1, ERROR_TEXT_CAP)
    return probes.withColumns(
        {
            "error": F.when(kind.isNotNull(), F.coalesce(label, text)),
            "status_code": F.when(kind.isNotNull(), F.lit(0)).otherwise(F.col("status_code")),
        }
    )


def with_redirect_facts(probes: DataFrame) -> DataFrame:
    """Add ``is_redirect``, ``redirect_count`` and ``response_time_ms``; null an equal ``final_url``.

    Reads ``answered_url`` (the address that gave the answer), ``hops`` (the
    addresses passed on the way) and the start and end of the probe.
    """
    moved = F.coalesce(F.col("answered_url") != F.col("url"), F.lit(False))
    elapsed = (F.unix_micros("ended_at") - F.unix_micros("started_at")) / 1000
    return probes.withColumns(
        {
            "is_redirect": moved,
            "final_url": F.when(moved, F.col("answered_url")),
            "redirect_count": F.coalesce(F.size("hops"), F.lit(0)),
            "response_time_ms": F.bround(elapsed, 0),
        }
    )


def header(name: str, headers: str = "headers") -> Column:
    """A response header by case-insensitive name; the last one wins."""
    hits = F.filter(F.map_entries(F.col(headers)), lambda e: F.lower(e["key"]) == name.lower())
    return F.try_element_at(hits, F.lit(-1))["value"]


def flatten_headers(probes: DataFrame) -> DataFrame:
    return probes.withColumns({c: header(h) for c, h in HEADER_COLUMNS.items()})


def with_inferred(probes: DataFrame) -> DataFrame:
    """Add ``inferred_crawlable`` and ``inferred_indexable_from_head``."""
    ok = F.coalesce(F.col("status_code") == 200, F.lit(False))
    robots = F.lower(F.coalesce("h_x_robots_tag", F.lit("")))
    open_to_index = ~F.contains(robots, F.lit("noindex")) & ~F.contains(robots, F.lit("none"))
    return probes.withColumns(
        {"inferred_crawlable": ok, "inferred_indexable_from_head": ok & open_to_index}
    )


def link_canonical(link: Column) -> Column:
    """Canonical address of a Link header; null unless the relation is quoted."""
    quoted = F.contains(link, F.lit('rel="canonical"')) | F.contains(link, F.lit("rel='canonical'"))
    target = F.regexp_extract(link, r"""<([^>]+)>;\s*rel=["']?canonical""", 1)
    return F.when(quoted, F.nullif(target, F.lit("")))


def fate(status: Column) -> Column:
    """What became of the URL, by status code; null where there is no status."""
    return (
        F.when(status == 0, "error")
        .when(status == 200, "live")
        .when(status == 404, "not_found")
        .when(status == 410, "gone")
        .when((status >= 300) & (status < 400), "redirect")
        .when(status == 403, "forbidden")
        .when(status == 429, "rate_limited")
        .when(status >= 500, "server_error")
        .when(status.isNotNull(), F.concat(F.lit("other_"), status.cast("string")))
    )


def with_fate(probes: DataFrame) -> DataFrame:
    return probes.withColumn("fate", fate(F.col("status_code")))


def with_robots_flags(probes: DataFrame) -> DataFrame:
    tag = F.lower(F.coalesce("h_x_robots_tag", F.lit("")))
    return probes.withColumns(
        {
            "has_noindex": F.contains(tag, F.lit("noindex")),
            "has_nofollow": F.contains(tag, F.lit("nofollow")),
        }
    )


def classify_probes(raw: DataFrame) -> DataFrame:
    """Raw probe answers to the full status table, in one narrow stage."""
    out = with_inferred(flatten_headers(with_redirect_facts(with_error(raw))))
    out = out.withColumn("h_canonical_url", link_canonical(F.col("h_link")))
    return with_robots_flags(with_fate(out))


def redirect_map(history: DataFrame, observed: bool = False) -> DataFrame:
    """Old to new address of redirected URLs.

    By default only rows whose fate is ``redirect`` count. A prober that follows
    redirects reports the final status instead; ``observed`` then takes the rows
    whose answer came from another address.
    """
    hit = F.col("is_redirect") if observed else F.col("fate") == "redirect"
    return history.where(hit & F.col("final_url").isNotNull()).select(
        F.col("url").alias("old_url"),
        F.col("final_url").alias("new_url"),
        F.col("status_code").alias("redirect_code"),
        F.col("change_type").alias("original_change_type"),
        (netloc(F.col("url")) == netloc(F.col("final_url"))).alias("same_domain"),
    )
