"""The daily inventory job and the probe job, from tables to tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import with_path_features
from ..operators import diff as D
from ..operators.alltime import live_status
from ..operators.candidates import probe_candidates, status_settings
from ..operators.health import (
    breaker_state,
    fate_by_change_type,
    fate_summary,
    response_percentiles,
    run_failures,
    runnable,
)
from ..operators.policy import allowed_agents, assign_agent, fresh_robots, policy_domain
from ..operators.probes import classify_probes, redirect_map
from ..operators.sitemaps import reachable_of, reachable_parsed, sitemap_file_facts, url_entries
from ..operators.targets import due_targets, normalize_targets, run_summary, target_roots
from ..schemas import ALL_TIME, BREAKER, CHANGES, LOGGED, SNAPSHOT, conform
from ..session import cut_lineage, written
from ..sources.changelog import append_changes, read_changes, run_id_of
from ..sources.history import append_status_history, write_headers
from ..sources.parsed import parse_by_hash
from ..sources.snapshots import write_sitemap_files
from ..sources.state import cut_lineage_bucketed, drop_scratch, latest_run, read_state, write_state
from .keyed import tag_known_domains


class Inventory(NamedTuple):
    """What one run over the inventories gives."""

    changes: DataFrame
    snapshot: DataFrame
    all_time: DataFrame


_CUR = ["lastmod", "sitemap_source_url", "section", "subsection", "path_depth"]
_OLD = [f for f in ALL_TIME.names if f not in D.KEY]


def _entry_rank(cur: DataFrame) -> Column:
    """Entry fields behind their order of preference: the least struct is the entry to keep.

    The greatest date wins, undated entries come last, ties go to the lesser
    source and position.
    """
    ts = F.try_to_timestamp("lastmod")
    ties = [c for c in ("sitemap_source_url", "pos") if c in cur.columns]
    return F.struct(
        ts.isNull().alias("undated"),
        (-F.coalesce(F.unix_micros(ts), F.lit(0))).alias("age"),
        *[F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")).alias(f"t_{c}") for c in ties],
        *[F.col(c).alias(c) for c in _CUR],
    )


def fused_state(cur: DataFrame, prev: DataFrame, all_time: DataFrame, buckets: int | None = None) -> DataFrame:
    """One row per URL with its current, previous and all-time sides.

    The three inputs are tagged, stacked and grouped once on (domain, loc):
    every input row is shuffled at most once for the diff, the first-seen lookup
    and the all-time update together. Duplicate entries of the current side are
    settled in the same aggregation, partly before the shuffle.

    With ``buckets``, the two state tables are bucketed that way on the key. The
    current side is then deduplicated and brought to the same buckets, and the
    state, by far the larger part, is not shuffled at all.
    """
    now = cur.where(F.col("loc").isNotNull()).select(*D.KEY, _entry_rank(cur).alias("cur"))
    if buckets:
        now = now.groupBy(*D.KEY).agg(F.min("cur").alias("cur")).repartition(buckets, *D.KEY)
    before = prev.select(
        *D.KEY,
        F.struct("lastmod", "sitemap_source_url", "change_type", "section", "subsection",
                 "path_depth", "detected_at").alias("prev"),
    )
    ever = all_time.select(*D.KEY, F.struct(*_OLD).alias("old"))
    stacked = now.unionByName(before, allowMissingColumns=True).unionByName(ever, allowMissingColumns=True)
    return stacked.groupBy(*D.KEY).agg(*[F.min(side).alias(side) for side in ("cur", "prev", "old")])


def _with_ran(state: DataFrame, cur: DataFrame, buckets: int | None, faulty: DataFrame | None,
              keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Add ``ran``: did the row's domain deliver any URL in this run, and was the URL's sitemap sound?

    A row with a current side answers itself, and a row that is long gone is not
    changed either way. Only the rest, URLs that were live and are missing now,
    is looked up by domain, and by sitemap where some were faulty: a URL that
    such a sitemap may still hold is not known to be gone. What was looked up is
    kept by ``keep``, so that readers of the result do not look it up again.
    """
    has_cur = F.col("cur").isNotNull()
    gone = F.col("prev").isNull() & ~F.coalesce(F.col("old.is_current_live"), F.lit(False))
    settled = state.where(has_cur | gone).withColumn("ran", has_cur)
    asked = tag_known_domains(state.where(~has_cur & ~gone), cur, "ran")
    if faulty is not None:
        bad = faulty.select(F.col("domain").alias("_d"), F.col("sitemap_url").alias("_s")).distinct().withColumn("_bad", F.lit(True))
        source = F.coalesce("prev.sitemap_source_url", "old.last_sitemap_source_url")
        same = (F.col("domain") == F.col("_d")) & (source == F.col("_s"))
        asked = asked.join(bad, same, "left").withColumn("ran", F.col("ran") & F.col("_bad").isNull()).drop("_d", "_s", "_bad")
    if buckets:
        asked = asked.repartition(buckets, *D.KEY)
    return settled.unionByName(keep(asked))


def run_inventory(cur: DataFrame, prev: DataFrame, all_time: DataFrame, run_ts: datetime | str,
                  materialize: bool = True, buckets: int | None = None,
                  faulty: DataFrame | None = None) -> Inventory:
    """Diff, change log, next snapshot and all-time table of one run.

    Domains without a current URL did not run: their snapshot rows and all-time
    rows are carried over as they are and nothing of theirs counts as removed.
    The same holds for URLs last seen in one of the ``faulty`` sitemaps (domain,
    sitemap_url), which could not be read, or not whole. The fused rows are written once to the shared folder, and the three results
    are narrow readings of them.
    """
    state = fused_state(cur, prev, all_time, buckets)
    keep = (lambda df: cut_lineage_bucketed(df, buckets) if buckets else written(df, "state")) if materialize else (lambda df: df)
    state = _with_ran(keep(state), cur, buckets, faulty, keep)
    now = D.as_timestamp(run_ts)
    has_cur, has_prev, known = (F.col(c).isNotNull() for c in ("cur", "prev", "old"))

    change = D.classify_change(has_cur, has_prev, F.col("cur.lastmod"), F.col("prev.lastmod"))
    once = ~((change == "removed") & F.col("prev.change_type").eqNullSafe("removed"))
    diff = state.where(F.col("ran") & (has_cur | has_prev) & once).select(
        *D.KEY,
        change.alias("change_type"),
        *[F.col(f"cur.{c}").alias(c) for c in _CUR],
        F.col("prev.lastmod").alias("lastmod_prev"),
        F.col("prev.sitemap_source_url").alias("sitemap_source_url_prev"),
        F.col("old.first_seen_at").alias("first_seen_known"),
        now.alias("detected_at"),
    )

    def carried(new: Column, name: str) -> Column:
        return F.when(has_cur, new).otherwise(F.col(f"prev.{name}")).alias(name)

    snapshot = state.where(has_cur | (~F.col("ran") & has_prev)).select(
        *D.KEY,
        *[carried(F.col(f"cur.{c}"), c) for c in _CUR],
        carried(now, "detected_at"),
        carried(change, "change_type"),
    )

    def pick(new: str, old: str) -> Column:
        return F.when(has_cur, F.col(f"cur.{new}")).otherwise(F.col(f"old.{old}")).alias(old)

    live = F.when(has_cur, True).when(F.col("ran"), False).otherwise(F.col("old.is_current_live"))
    everything = state.where(has_cur | known).select(
        *D.KEY,
        F.when(known, F.col("old.first_seen_at")).otherwise(now).alias("first_seen_at"),
        F.when(has_cur, now).otherwise(F.col("old.last_seen_at")).alias("last_seen_at"),
        live.alias("is_current_live"),
        live_status(live).alias("live_status"),
        pick("lastmod", "last_lastmod"),
        pick("sitemap_source_url", "last_sitemap_source_url"),
        pick("section", "section"),
        pick("subsection", "subsection"),
        pick("path_depth", "path_depth"),
    )
    return Inventory(
        D.to_change_rows(diff, run_ts), conform(snapshot, SNAPSHOT), conform(everything, ALL_TIME)
    )


def plan_fetch(targets: DataFrame, robots: DataFrame, agents: Sequence[str], fallback: str, run_ts: datetime | str,
               own_domains: Sequence[str] = (), own_agent: str | None = None) -> DataFrame:
    """Sitemaps to fetch now, each with the agent to fetch it with: domain, sitemap_url, agent, rule.

    The agents that a domain's fresh robots text does not block are the choice;
    a domain without a fresh text blocks nobody.
    """
    due = due_targets(normalize_targets(targets).where("is_valid"), str(run_ts)[:10])
    wanted = due.select(policy_domain(F.col("domain")).alias("domain")).distinct()
    allowed = allowed_agents(wanted, fresh_robots(robots, run_ts), agents)
    first = due.groupBy("domain").agg(F.min("user_agent").alias("user_agent"))
    chosen = assign_agent(first, allowed, fallback, own_domains, own_agent)
    return target_roots(due).select("domain", "sitemap_url").distinct().join(chosen, "domain")


def daily_inventory(spark: SparkSession, targets: DataFrame, docs: DataFrame, base: str,
                    run_ts: datetime | str, buckets: int | None = None,
                    errors: DataFrame | None = None, parsed_ledger: str | None = None) -> DataFrame:
    """Targets and sitemap documents to change log, snapshot, all-time table and summary.

    ``errors`` (domain, message) names the targets whose fetch failed; the
    summary reports them. With ``parsed_ledger``, a folder, a sitemap whose text
    came before is not parsed again.

    State lives under ``base``; a rerun with the same ``run_ts`` replaces its own
    output. With ``buckets`` the snapshot and the all-time table are kept
    bucketed on (domain, loc) and are joined without a shuffle; a run after a
    change of the number shuffles them once. Returns the run summary.
    """
    run_id = run_id_of(run_ts)
    due = due_targets(normalize_targets(targets).where("is_valid"), str(run_ts)[:10])
    # Parsed once and kept without the texts; facts and entries are read from it.
    if parsed_ledger:
        parsed = reachable_of(target_roots(due), written(parse_by_hash(docs, parsed_ledger), "parsed"))
    else:
        parsed = reachable_parsed(target_roots(due), docs)
    parsed = written(parsed, "reachable")
    entries = with_path_features(url_entries(parsed))
    write_sitemap_files(sitemap_file_facts(parsed), f"{base}/sitemaps", run_id)

    prev = read_state(spark, f"{base}/snapshot", SNAPSHOT, run_id, buckets)
    all_time = read_state(spark, f"{base}/all_time", ALL_TIME, run_id, buckets)
    logged = _logged_domains(spark, base, run_id)
    backfilled = D.backfill(D.guard_empty(entries, prev), logged, run_ts)
    faulty = parsed.where(F.col("fault").isNotNull()).select("domain", "sitemap_url")
    run = run_inventory(entries, prev, all_time, run_ts, buckets=buckets, faulty=faulty)
    changes = cut_lineage(run.changes.unionByName(backfilled))
    append_changes(changes, f"{base}/changes", run_ts)
    write_state(logged.unionByName(changes.select("domain")).distinct(), f"{base}/logged", run_id, LOGGED)
    if not run.snapshot.isEmpty():
        write_state(run.snapshot, f"{base}/snapshot", run_id, SNAPSHOT, buckets, placed=True)
    write_state(run.all_time, f"{base}/all_time", run_id, ALL_TIME, buckets, placed=True)
    drop_scratch(spark)
    return run_summary(due, entries, errors)


def _logged_domains(spark: SparkSession, base: str, run_id: str) -> DataFrame:
    """Domains with a change log before the run: a small state table, so that the log is not read every day."""
    if latest_run(spark, f"{base}/logged", run_id):
        return read_state(spark, f"{base}/logged", LOGGED, run_id)
    return _log_before(spark, f"{base}/changes", run_id).select("domain").distinct()


def _log_before(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return spark.createDataFrame([], CHANGES)
    return read_changes(spark, path).where(F.col("run_id") < run_id)


def plan_probes(spark: SparkSession, targets: DataFrame, base: str, run_ts: datetime | str,
                force: bool = False) -> DataFrame:
    """URLs to hand to the prober now, for every domain that may be probed."""
    settings = status_settings(targets)
    breaker = read_state(spark, f"{base}/breaker", BREAKER, before=run_id_of(run_ts))
    domains = runnable(settings, breaker, run_ts, force)
    return probe_candidates(read_changes(spark, f"{base}/changes"), settings, run_ts, domains=domains)


def record_probes(spark: SparkSession, raw: DataFrame, targets: DataFrame, base: str,
                  run_ts: datetime | str, forced: bool = False) -> DataFrame:
    """Store the prober's answers and move every breaker one run on.

    Beside the history the run's redirect map and rollups (fates, fates by
    change type, response percentiles) are written. ``forced`` tells that the
    probes were planned in spite of breakers, so that their run counts.
    Returns the classified probes of the run.
    """
    probes = cut_lineage(classify_probes(raw).withColumn("forced", F.lit(forced)))
    run_id = run_id_of(run_ts)
    append_status_history(probes, f"{base}/status_history", run_id)
    write_headers(probes, f"{base}/headers", run_id)
    reports = {
        "redirect_map": redirect_map(probes),
        "fates": fate_summary(probes),
        "fates_by_change_type": fate_by_change_type(probes),
        "response_percentiles": response_percentiles(probes),
    }
    for name, report in reports.items():
        report.write.mode("overwrite").parquet(f"{base}/{name}/run_id={run_id}")
    runs = run_failures(probes, D.as_timestamp(run_ts))
    before = read_state(spark, f"{base}/breaker", BREAKER, before=run_id)
    after = breaker_state(runs, status_settings(targets), before)
    write_state(after, f"{base}/breaker", run_id, BREAKER)
    return probes
