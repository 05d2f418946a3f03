"""The all-time URL table: every URL ever seen, with its live status."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.keyed import tag_known_domains
from ..schemas import ALL_TIME, conform
from .diff import KEY, as_timestamp


def live_status(is_live: Column) -> Column:
    return F.when(is_live, "current_live").otherwise("old_live")


def upsert_all_time(all_time: DataFrame, snapshot: DataFrame, run_ts: datetime | str) -> DataFrame:
    """Fold a new snapshot into the all-time table.

    Seen URLs are refreshed and live, new URLs are inserted, unseen URLs of the
    snapshot's domains stop being live and keep their other fields. Domains that
    are not in the snapshot did not run and stay as they were.
    """
    now = as_timestamp(run_ts)
    cur = snapshot.where(F.col("loc").isNotNull()).select(
        *KEY,
        F.struct("lastmod", "sitemap_source_url", "section", "subsection", "path_depth").alias("cur"),
    )
    old = tag_known_domains(conform(all_time, ALL_TIME), snapshot, "_ran")
    seen = F.col("cur").isNotNull()
    live = F.when(seen, True).when(F.col("_ran"), False).otherwise(F.col("is_current_live"))

    def pick(new: str, kept: str) -> Column:
        return F.when(seen, F.col(f"cur.{new}")).otherwise(F.col(kept)).alias(kept)

    merged = old.join(cur, KEY, "full_outer").select(
        *KEY,
        F.when(F.col("_ran").isNull(), now).otherwise(F.col("first_seen_at")).alias("first_seen_at"),
        F.when(seen, now).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
        live.alias("is_current_live"),
        pick("lastmod", "last_lastmod"),
        pick("sitemap_source_url", "last_sitemap_source_url"),
        pick("section", "section"),
        pick("subsection", "subsection"),
        pick("path_depth", "path_depth"),
    )
    return conform(merged.withColumn("live_status", live_status(F.col("is_current_live"))), ALL_TIME)


def live_counts(all_time: DataFrame) -> DataFrame:
    live = F.coalesce(F.col("is_current_live"), F.lit(False))
    return all_time.groupBy("domain").agg(
        F.count("*").alias("total"),
        F.count_if(live).alias("current_live"),
        F.count_if(~live).alias("old_live"),
    )
