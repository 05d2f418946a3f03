"""Targets: normalisation, validation, schedule and the summary of a run."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip


def normalize_targets(targets: DataFrame) -> DataFrame:
    """Bring one address or a list of them into ``sitemap_urls`` and check the row.

    Adds ``is_valid`` and ``invalid_reason``; a non-empty list wins over the
    single address.
    """
    single = F.col("sitemap_url")
    has_list = F.coalesce(F.size("sitemap_urls") > 0, F.lit(False))
    has_single = F.coalesce(strip(single) != "", F.lit(False))
    urls = F.when(has_list, F.col("sitemap_urls")).when(has_single, F.array(single))
    reason = (
        F.when(F.col("domain").isNull(), "domain missing")
        .when(strip(F.col("domain")) == "", "domain empty")
        .when(~has_list & ~has_single, "no sitemap")
    )
    return (
        targets.withColumns({"sitemap_urls": urls, "invalid_reason": reason})
        .withColumn("is_valid", F.col("invalid_reason").isNull())
        .drop("sitemap_url")
    )


def target_roots(targets: DataFrame) -> DataFrame:
    """(domain, sitemap_url) of every root sitemap of the valid targets."""
    return targets.where("is_valid").select("domain", F.explode("sitemap_urls").alias("sitemap_url"))


def start_offset(domain: Column, interval_days: Column) -> Column:
    """Start day of a domain's schedule, spread evenly and the same in every run."""
    return F.pmod(F.conv(F.substring(F.md5(domain), 1, 8), 16, 10).cast("bigint"), interval_days)


def due_targets(targets: DataFrame, run_date: date | str) -> DataFrame:
    """Targets to run on a day: not disabled, and on their interval if they have one."""
    interval = F.coalesce("interval_days", F.lit(1))
    # Guarded, so that an interval of 0 is not divided by.
    span = F.greatest(interval, F.lit(1))
    days = F.unix_date(F.lit(str(run_date)).cast("date"))
    on_schedule = F.pmod(days - start_offset(F.col("domain"), span), span) == 0
    enabled = F.coalesce(F.col("enabled"), F.lit(True))
    return targets.where(enabled & ((interval <= 1) | on_schedule))


def run_summary(targets: DataFrame, entries: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Outcome per target: success with its number of entries, warning or error."""
    counts = entries.groupBy("domain").agg(F.count("*").alias("urls"))
    joined = targets.select("domain").distinct().join(counts, "domain", "left")
    if errors is None:
        joined = joined.withColumn("_error", F.lit(None).cast("string"))
    else:
        joined = joined.join(errors.select("domain", F.col("message").alias("_error")), "domain", "left")
    found = F.coalesce("urls", F.lit(0))
    return joined.select(
        "domain",
        F.when(F.col("_error").isNotNull(), "error").when(found > 0, "success").otherwise("warning").alias("status"),
        F.when(F.col("_error").isNull(), found).alias("urls"),
        F.coalesce("_error", F.when(found == 0, "No URLs found")).alias("message"),
    )
