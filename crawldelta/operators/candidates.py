"""Which changed URLs to probe next: settings, recency, priority and a limit per domain."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.keyed import hot_domains, join_domains, top_k_sliced
from ..session import written
from .diff import KEY, as_timestamp

# Settings used where a target does not override them.
STATUS_DEFAULTS = {
    "enabled": True,
    "check_new": True,
    "check_updated": True,
    "check_removed": True,
    "max_per_run": 100,
    "failure_threshold": 0.5,
    "backoff_days": 3,
    "timeout": 5,
    "user_agent": "",
}
# Probing order of the change types and the setting that allows each.
PRIORITY = {"removed": 0, "discovered": 1, "modified": 2}
ALLOWED_BY = {"removed": "check_removed", "discovered": "check_new", "modified": "check_updated"}
RECENT_DAYS = 7


def status_settings(targets: DataFrame, defaults: dict | None = None) -> DataFrame:
    """One row of probe settings per domain, defaults filled in key by key.

    Of several targets of one domain the first counts, by a ``position`` column
    if there is one, else in the order in which the targets are read.
    """
    values = {**STATUS_DEFAULTS, **(defaults or {})}
    position = F.col("position") if "position" in targets.columns else F.monotonically_increasing_id()
    settings = F.struct(
        position.alias("_position"),
        *[F.coalesce(F.col(f"status_check.{k}"), F.lit(v)).alias(k) for k, v in values.items()],
    )
    first = targets.select("domain", settings.alias("s")).groupBy("domain").agg(F.min("s").alias("s"))
    return first.select("domain", *[f"s.{k}" for k in values])


def recent_changes(log: DataFrame, run_ts: datetime | str, days: int = RECENT_DAYS) -> DataFrame:
    """Changes detected in the last days up to the run; prunes monthly partitions where there are any."""
    now = as_timestamp(run_ts)
    since = now - F.expr(f"interval {int(days)} days")
    recent = log.where(F.col("detected_at").between(since, now))
    if "change_month" in log.columns:
        recent = recent.where(F.col("change_month").between(F.date_format(since, "yyyy-MM"), F.date_format(now, "yyyy-MM")))
    return recent


def allowed_changes(log: DataFrame, settings: DataFrame) -> DataFrame:
    """Changes of the types a domain's settings ask for; default settings where it has none."""
    return _with_settings(log, settings, log).where(_type_allowed(F.col("change_type"))).select(log.columns)


def _with_settings(df: DataFrame, settings: DataFrame, log: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Add the settings of each row's domain, and other columns of them; the hot domains are counted on ``log``."""
    cols = ["check_removed", "check_new", "check_updated", "max_per_run"]
    joined = join_domains(df, settings, [*cols, *more], hot_domains(log))
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(STATUS_DEFAULTS[c])) for c in cols})


def _type_allowed(change_type: Column) -> Column:
    test = F.lit(False)
    for t, flag in ALLOWED_BY.items():
        test = test | ((change_type == t) & F.col(flag))
    return test


def latest_allowed_change(log: DataFrame, settings: DataFrame, domains: DataFrame | None = None) -> DataFrame:
    """Latest change per URL among the types its domain allows; with ``domains``, of these domains only.

    The latest change of each type is aggregated per URL first, with partial
    aggregation before the shuffle; the settings join then meets one row per
    URL, and the choice among the types is made within the row.
    """
    payload = [c for c in ("section", "sitemap_source_url", "lastmod") if c in log.columns]
    ranked = F.struct("detected_at", *payload)
    per_url = log.where(
        F.col("loc").isNotNull() & F.col("detected_at").isNotNull() & F.col("change_type").isin(*PRIORITY)
    ).groupBy(*KEY).agg(
        *[F.max(F.when(F.col("change_type") == t, ranked)).alias(f"_{t}") for t in PRIORITY]
    )
    options = [
        F.when(
            F.col(ALLOWED_BY[t]) & F.col(f"_{t}").isNotNull(),
            F.struct(
                F.col(f"_{t}.detected_at").alias("detected_at"),
                F.lit(-p).alias("_rank"),
                F.lit(t).alias("change_type"),
                *[F.col(f"_{t}.{c}").alias(c) for c in payload],
            ),
        )
        for t, p in PRIORITY.items()
    ]
    best = F.greatest(*options)
    # Written once: the hot domains are counted on it, and the choice is made from it.
    per_url = written(per_url, "per-url")
    if domains is None:
        asked = _with_settings(per_url, settings, per_url)
    else:
        listed = settings.join(domains.select("domain").distinct(), "domain", "right").withColumn("_listed", F.lit(True))
        asked = _with_settings(per_url, listed, per_url, ["_listed"]).where("_listed")
    return (
        asked
        .withColumn("_best", best)
        .where(F.col("_best").isNotNull())
        .select(*KEY, "max_per_run", "_best.detected_at", "_best.change_type",
                *[f"_best.{c}" for c in payload])
    )


def priority(change_type: Column) -> Column:
    out = F.lit(None).cast("int")
    for t, p in PRIORITY.items():
        out = F.when(change_type == t, p).otherwise(out)
    return out


def probe_candidates(log: DataFrame, settings: DataFrame, run_ts: datetime | str,
                     days: int = RECENT_DAYS, limit: int | None = None, domains: DataFrame | None = None) -> DataFrame:
    """URLs to probe: the first ``max_per_run`` per domain by priority, recency and address; of ``domains`` only, if given."""
    latest = latest_allowed_change(recent_changes(log, run_ts, days), settings, domains)
    latest = latest.withColumn("priority", priority(F.col("change_type")))
    bound = F.col("max_per_run") if limit is None else F.lit(int(limit))
    order = [F.col("priority"), F.col("detected_at").desc(), F.col("loc")]
    return top_k_sliced(latest, ["domain"], order, bound, ["loc"], rank_as="rank").drop("max_per_run")
