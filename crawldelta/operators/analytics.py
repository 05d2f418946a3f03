"""Analyses over the change log and the inventories."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import content_blocks
from ..functions.html import visible_text
from ..plans.keyed import top_k
from .diff import KEY, as_timestamp


def cadence(changes: DataFrame, unit: str = "day", keys: Sequence[str] = ("domain",)) -> DataFrame:
    """Changes per key and calendar day, week or month."""
    period = F.to_date(F.date_trunc(unit, F.col("detected_at"))).alias("period")
    return changes.where(F.col("detected_at").isNotNull()).groupBy(*keys, period).agg(
        F.count("*").alias("changes"),
        F.count_if(F.col("change_type") == "discovered").alias("discovered"),
        F.count_if(F.col("change_type") == "modified").alias("modified"),
        F.count_if(F.col("change_type") == "removed").alias("removed"),
    )


def lifecycle(changes: DataFrame, slice_unit: str = "day") -> DataFrame:
    """Changes per URL in order, with the days since the change before.

    The history of one URL is cut into time slices, so a URL with a large part
    of all changes is spread over many tasks. What a slice must know of the
    earlier ones (how many changes there were and when the last one was) is
    aggregated per slice and carried forward over that small table.
    """
    undated = F.lit("1970-01-01").cast("timestamp")
    start = F.coalesce(F.date_trunc(slice_unit, F.col("detected_at")), undated)
    sliced = changes.withColumn("_slice", start)
    carried_over = Window.partitionBy(*KEY).orderBy("_slice")
    carry = (
        sliced.groupBy(*KEY, "_slice")
        .agg(F.count("*").alias("_n"), F.max("detected_at").alias("_last"))
        .select(
            *KEY,
            "_slice",
            (F.sum("_n").over(carried_over) - F.col("_n")).alias("_before"),
            F.lag("_last").over(carried_over).alias("_prev"),
        )
    )
    within = Window.partitionBy(*KEY, "_slice").orderBy("detected_at", "change_type")
    days = (F.unix_micros("detected_at") - F.unix_micros("previous_at")) / (86400 * 1000000)
    # Null-safe: a change without a domain is still a change of its URL.
    names = {c: f"_c_{c}" for c in (*KEY, "_slice")}
    carry = carry.withColumnsRenamed(names)
    same = F.lit(True)
    for c, other in names.items():
        same = same & F.col(c).eqNullSafe(F.col(other))
    return (
        sliced.join(carry, same)
        .drop(*names.values())
        .withColumns(
            {
                "seq": F.col("_before") + F.row_number().over(within),
                "previous_at": F.coalesce(F.lag("detected_at").over(within), F.col("_prev")),
            }
        )
        .withColumn("days_since_previous", F.round(days, 4))
        .drop("_slice", "_before", "_prev")
    )


def most_modified(changes: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most often modified URLs per domain."""
    counts = (
        changes.where(F.col("change_type") == "modified").groupBy(*KEY).agg(F.count("*").alias("modifications"))
    )
    return top_k(counts, ["domain"], [F.col("modifications").desc(), F.col("loc")], k, rank_as="rank")


def moved_or_removed(diff: DataFrame) -> DataFrame:
    """URLs that left their sitemap: moved to another one, or gone from all."""
    moved = F.col("change_type").isin("present", "modified") & ~F.col("sitemap_source_url").eqNullSafe(
        F.col("sitemap_source_url_prev")
    )
    what = F.when(F.col("change_type") == "removed", "removed").when(moved, "moved")
    return diff.withColumn("what", what).where(F.col("what").isNotNull()).select(
        *KEY, "what", F.col("sitemap_source_url_prev").alias("from_sitemap"),
        F.col("sitemap_source_url").alias("to_sitemap"),
    )


def cadence_shift(changes: DataFrame, days: int = 7) -> DataFrame:
    """Changes per domain and active day against the mean of the active days before."""
    daily = cadence(changes, "day").select("domain", F.col("period").alias("day"), "changes")
    before = Window.partitionBy("domain").orderBy("day").rowsBetween(-days, -1)
    mean, spread = F.avg("changes").over(before), F.stddev_pop("changes").over(before)
    return daily.withColumns({"trailing_mean": mean, "_spread": spread}).select(
        "domain",
        "day",
        "changes",
        F.round("trailing_mean", 4).alias("trailing_mean"),
        F.round(F.col("changes") / F.nullif("trailing_mean", F.lit(0.0)), 4).alias("ratio"),
        F.round((F.col("changes") - F.col("trailing_mean")) / F.nullif("_spread", F.lit(0.0)), 4).alias("z_score"),
    )


def calendar(daily: DataFrame, keys: Sequence[str], until: Column | None = None) -> DataFrame:
    """daily(keys, day, changes) with a row of no changes for every day on which a key had none.

    The days of a key run from its first one to ``until``, or to the last day of
    the whole table: a key that fell silent has rows too. A key has as many rows
    as days, whatever it has in changes.
    """
    if until is None:
        (last,) = daily.agg(F.max("day")).first()
        until = F.lit(last).cast("date")
    spans = daily.groupBy(*keys).agg(F.min("day").alias("_from"))
    spine = spans.where(F.col("_from") <= until).select(*keys, F.explode(F.sequence("_from", until)).alias("day"), F.lit(0).cast("bigint").alias("changes"))
    return daily.where(F.col("day") <= until).unionByName(spine).groupBy(*keys, "day").agg(F.sum("changes").alias("changes"))


def cadence_shift_calendar(changes: DataFrame, days: int = 7, keys: Sequence[str] = ("domain",), until: Column | None = None) -> DataFrame:
    """Changes per key and calendar day against the mean of the days before, silent days counted as none.

    A key that stops has a ratio of 0 from then on, until all days of the mean
    are silent; then the ratio is null, as there is nothing to compare with. The
    first day of a key has no mean.
    """
    daily = cadence(changes, "day", keys).select(*keys, F.col("period").alias("day"), "changes")
    before = Window.partitionBy(*keys).orderBy("day").rowsBetween(-days, -1)
    mean, spread = F.avg("changes").over(before), F.stddev_pop("changes").over(before)
    return calendar(daily, keys, until).withColumns({"trailing_mean": mean, "_spread": spread}).select(
        *keys,
        "day",
        "changes",
        F.round("trailing_mean", 4).alias("trailing_mean"),
        F.round(F.col("changes") / F.nullif("trailing_mean", F.lit(0.0)), 4).alias("ratio"),
        F.round((F.col("changes") - F.col("trailing_mean")) / F.nullif("_spread", F.lit(0.0)), 4).alias("z_score"),
    )


def sections_of(all_time: DataFrame) -> DataFrame:
    """(domain, section, first_seen_at) of every section that any known URL is or was in: the state to begin with."""
    held = all_time.where(F.col("section").isNotNull())
    return held.groupBy("domain", "section").agg(F.min("first_seen_at").alias("first_seen_at"))


def fold_sections(state: DataFrame, snapshot: DataFrame, run_ts: datetime | str) -> DataFrame:
    """The section state after a run: a section keeps the time of its first run, whether it is there now or not."""
    now = snapshot.where(F.col("section").isNotNull()).select("domain", "section").distinct()
    rows = state.select("domain", "section", "first_seen_at").unionByName(now.withColumn("first_seen_at", as_timestamp(run_ts)))
    return rows.groupBy("domain", "section").agg(F.min("first_seen_at").alias("first_seen_at"))


def sections_first_seen(state: DataFrame, snapshot: DataFrame) -> DataFrame:
    """(domain, section, urls) of the run's sections that the state before it never had."""
    return new_sections(snapshot, state)


def new_sections(cur: DataFrame, prev: DataFrame) -> DataFrame:
    """Sections of a domain that hold URLs now and held none before."""
    key = ["domain", "section"]
    counted = cur.where(F.col("section").isNotNull()).groupBy(*key).agg(F.count("*").alias("urls"))
    return counted.join(prev.select(*key).distinct(), key, "left_anti")


def content_changes(cur_pages: DataFrame, prev_pages: DataFrame) -> DataFrame:
    """Pages new, gone or changed in content, compared by hash.

    Only addresses and hashes are shuffled, never the page text.
    """

    def hashed(df: DataFrame, name: str) -> DataFrame:
        return df.select("url", F.sha2("html", 256).alias(name), F.lit(True).alias(f"in_{name}"))

    kind = (
        F.when(F.col("in_hash_prev").isNull(), "new")
        .when(F.col("in_hash").isNull(), "gone")
        .when(~F.col("hash").eqNullSafe(F.col("hash_prev")), "changed")
    )
    return (
        hashed(cur_pages, "hash")
        .join(hashed(prev_pages, "hash_prev"), "url", "full_outer")
        .withColumn("content_change", kind)
        .where(F.col("content_change").isNotNull())
        .drop("in_hash", "in_hash_prev")
    )


def page_blocks(pages: DataFrame) -> DataFrame:
    """(url, hash, words) of every content-defined block of the pages' visible text. Narrow; the text goes no further."""
    return pages.select("url", F.inline(content_blocks(visible_text(F.col("html")))))


def block_changes(cur_pages: DataFrame, prev_pages: DataFrame) -> DataFrame:
    """What pages that are in both crawls changed in: url, words, words_before, added, removed, blocks, blocks_before, changed_share.

    The blocks of both sides are compared as multisets, so text that moved
    within a page is no change, and an edit costs the block around it. added and
    removed are words in blocks that the other side lacks; changed_share is their
    part of the words of both sides. Pages without a changed block have no row.
    Addresses and block hashes are shuffled, never a text.
    """
    sides = [
        page_blocks(df).select("url", "hash", "words", F.lit(side).alias("side")) for df, side in ((cur_pages, 1), (prev_pages, -1))
    ]
    now = F.col("side") > 0
    held = sides[0].unionByName(sides[1]).groupBy("url", "hash").agg(
        F.max("words").alias("words"), F.count_if(now).alias("n"), F.count_if(~now).alias("n_before")
    )
    more = F.greatest(F.col("n") - F.col("n_before"), F.lit(0).cast("bigint"))
    fewer = F.greatest(F.col("n_before") - F.col("n"), F.lit(0).cast("bigint"))
    of_page = held.groupBy("url").agg(
        F.sum(F.col("words") * F.col("n")).alias("words"),
        F.sum(F.col("words") * F.col("n_before")).alias("words_before"),
        F.sum(F.col("words") * more).alias("added"),
        F.sum(F.col("words") * fewer).alias("removed"),
        F.sum("n").alias("blocks"),
        F.sum("n_before").alias("blocks_before"),
    )
    changed = of_page.where((F.col("blocks") > 0) & (F.col("blocks_before") > 0) & (F.col("added") + F.col("removed") > 0))
    both = F.col("words") + F.col("words_before")
    return changed.withColumn("changed_share", F.round((F.col("added") + F.col("removed")) / both, 6))
