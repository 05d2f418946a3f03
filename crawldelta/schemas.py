"""Explicit table schemas and a helper that brings any frame into one of them.

``lastmod`` stays a string everywhere: it is compared as text and parsed only
where an order is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    IntegralType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "timestamp": TimestampType(),
    "date": DateType(),
}


def _table(columns: str, **nested: DataType) -> StructType:
    """A schema of flat columns, with nested columns at the end (usable without a session)."""
    flat = [c.split() for c in columns.split(", ")]
    fields = [StructField(n, _TYPES[t]) for n, t in flat]
    return StructType(fields + [StructField(n, t) for n, t in nested.items()])


SNAPSHOT = _table(
    "loc string, domain string, lastmod string, detected_at timestamp, change_type string, "
    "sitemap_source_url string, section string, subsection string, path_depth int"
)

CHANGES = _table(
    "detected_at timestamp, domain string, loc string, change_type string, "
    "first_seen_at timestamp, last_seen_at timestamp, lastmod string, lastmod_prev string, "
    "sitemap_source_url string, section string, subsection string, path_depth int"
)

ALL_TIME = _table(
    "loc string, domain string, first_seen_at timestamp, last_seen_at timestamp, "
    "is_current_live boolean, live_status string, last_lastmod string, "
    "last_sitemap_source_url string, section string, subsection string, path_depth int"
)

SITEMAP_FILES = _table(
    "sitemap_url string, domain string, sitemap_type string, url_count int, "
    "content_hash string, content_length bigint, fetched_at timestamp"
)

STATUS_HISTORY = _table(
    "domain string, url string, change_type string, fate string, status_code int, "
    "is_redirect boolean, final_url string, redirect_count int, response_time_ms double, "
    "section string, checked_at timestamp, error string, has_noindex boolean, "
    "has_nofollow boolean, h_etag string, h_last_modified string, h_content_length string, "
    "h_content_type string, h_cache_control string, h_age string, h_vary string, "
    "h_x_robots_tag string, h_link string, h_x_cache string, h_cf_cache_status string"
)

HEADERS = _table(
    "url string, checked_at timestamp, status_code int",
    headers=MapType(StringType(), StringType()),
)

BREAKER = _table(
    "domain string, is_open boolean, last_check timestamp, last_failure_rate double, "
    "consecutive_high_failures int, backoff_until timestamp, total_checks bigint, "
    "total_failures bigint"
)

# Domains that have a change log.
LOGGED = _table("domain string")

# What a stream keeps of the probes of one domain and day.
BREAKER_DAYS = _table("domain string, run timestamp, total bigint, failures bigint, forced boolean")

ROBOTS = _table(
    "domain string, content string, fetched_at timestamp, status_code int"
)

ATTEMPTS = _table(
    "domain string, method string, success boolean, status_code int, attempted_at timestamp, "
    "url string"
)

TARGETS = _table(
    "domain string, sitemap_url string, enabled boolean, interval_days int, user_agent string, "
    "download_delay double, fetch_timeout int",
    sitemap_urls=ArrayType(StringType()),
    status_check=_table(
        "enabled boolean, check_new boolean, check_updated boolean, check_removed boolean, "
        "max_per_run int, failure_threshold double, backoff_days int, timeout int, user_agent string"
    ),
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select exactly the columns of ``schema``; absent ones become typed nulls.

    A string that does not parse as the declared type becomes null, so frames
    read from untyped CSV can be conformed as well. There, a column of whole
    numbers with gaps is written like ``3.0``, and that is 3.
    """
    have = dict(df.dtypes)

    def typed(f: StructField) -> Column:
        plain = F.col(f.name).try_cast(f.dataType)
        if have[f.name] != "string" or not isinstance(f.dataType, IntegralType):
            return plain
        number = F.regexp_replace(F.btrim(F.col(f.name)), r"\.0*$", "")
        return F.coalesce(plain, number.try_cast(f.dataType))

    return df.select(
        *[
            (
                typed(f)
                if f.name in have
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in schema.fields
        ]
    )
