"""State tables kept up by a stream: the all-time URL table and the circuit breaker.

What a URL, or a domain and day, has come to is kept in Spark's state store by
an aggregation in update mode, so a micro-batch gives and writes the rows that
it changes and no others. The tables are read from what the batches left; both
kinds of row may be folded in any order and any number of times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from ..operators.alltime import live_status
from ..operators.diff import KEY
from ..operators.health import breaker_state, run_failures
from ..plans.keyed import hot_domains, join_domains, keep_domains
from ..schemas import ALL_TIME, BREAKER, BREAKER_DAYS, SNAPSHOT, conform
from ..sources.state import read_state
from .deltas import compact, read_batches, write_batch

_PAYLOAD = ("detected_at", "lastmod", "sitemap_source_url", "section", "subsection", "path_depth")

# What a stream keeps of a URL: when it was first seen, and how it was last seen.
SEEN = StructType(
    [
        *[f for f in SNAPSHOT.fields if f.name in KEY],
        StructField("_first", SNAPSHOT["detected_at"].dataType),
        StructField("cur", StructType([SNAPSHOT[c] for c in _PAYLOAD])),
    ]
)


def seen_urls(snapshots: DataFrame) -> DataFrame:
    """Per URL the first time and the last sight of it; of a table or of a stream."""
    return snapshots.where(F.col("loc").isNotNull()).groupBy(*KEY).agg(
        F.min("detected_at").alias("_first"), F.max(F.struct(*_PAYLOAD)).alias("cur")
    )


def merge_seen(rows: DataFrame) -> DataFrame:
    """Rows of seen_urls, of any batches, as one per URL."""
    return rows.groupBy(*KEY).agg(F.min("_first").alias("_first"), F.max("cur").alias("cur"))


def fold_snapshots(all_time: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Fold the snapshots of one or more runs into the all-time table.

    A run is told by ``detected_at``. A URL is live if it was seen in the last
    run of its domain, which is the later of the last run here and the last one
    that the table knows; domains without a run keep their rows as they are. So
    the result is the same however runs are split into batches, and in whatever
    order they arrive.
    """
    return fold_seen(all_time, seen_urls(snapshots), snapshots.select("domain", F.col("detected_at").alias("_at")))


def fold_seen(all_time: DataFrame, seen: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Fold rows of `merge_seen` into the all-time table; ``runs`` (domain, _at) are the runs they are from, theirs by default."""
    runs = seen.select("domain", F.col("cur.detected_at").alias("_at")) if runs is None else runs
    ran = runs.withColumn("_now", F.lit(True)).unionByName(
        all_time.select("domain", F.col("last_seen_at").alias("_at"), F.lit(False).alias("_now"))
    )
    ran = ran.groupBy("domain").agg(F.max("_at").alias("_ran_at"), F.bool_or("_now").alias("_now")).where("_now")
    newer = F.col("cur").isNotNull() & F.coalesce(F.col("cur.detected_at") >= F.col("last_seen_at"), F.lit(True))

    def pick(new: str, old: str):
        return F.when(newer, F.col(f"cur.{new}")).otherwise(F.col(old)).alias(old)

    seen_at = F.greatest("last_seen_at", "cur.detected_at")
    live = F.when(F.col("_ran_at").isNotNull(), F.coalesce(seen_at == F.col("_ran_at"), F.lit(False))).otherwise(
        F.col("is_current_live")
    )
    stacked = all_time.select("domain").unionByName(seen.select("domain"))
    joined = conform(all_time, ALL_TIME).join(seen, KEY, "full_outer")
    merged = join_domains(joined, ran, ["_ran_at"], hot_domains(stacked)).select(
        *KEY,
        F.least("first_seen_at", "_first").alias("first_seen_at"),
        seen_at.alias("last_seen_at"),
        live.alias("is_current_live"),
        live_status(live).alias("live_status"),
        pick("lastmod", "last_lastmod"),
        pick("sitemap_source_url", "last_sitemap_source_url"),
        pick("section", "section"),
        pick("subsection", "subsection"),
        pick("path_depth", "path_depth"),
    )
    return conform(merged, ALL_TIME)


def stream_all_time(snapshots: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Keep the all-time table under ``root`` up with a stream of snapshot rows; `read_all_time` reads it.

    A batch writes one row for each URL that it brings, however large the table
    is. On a cluster the state store should be the RocksDB one with changelogs.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(conform(batch, SEEN), f"{root}/seen", batch_id)

    return _run(seen_urls(snapshots), write, checkpoint)


def read_all_time(spark: SparkSession, root: str) -> DataFrame:
    """The all-time table: the state under ``root``, if there is one, and what the stream saw since."""
    seen = merge_seen(read_batches(spark, f"{root}/seen", SEEN))
    return fold_seen(read_state(spark, root, ALL_TIME), seen)


def compact_all_time(spark: SparkSession, root: str) -> int:
    """Fold the batches of `stream_all_time`; the table stays the same."""
    return compact(spark, f"{root}/seen", SEEN, merge_seen)


def _latest(rows: DataFrame, keys: list[str], schema: StructType) -> DataFrame:
    """The rows of the last batch that told of their key."""
    others = [c for c in schema.names if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch_id").alias("_last"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in schema.names])


def stream_breaker(probes: DataFrame, settings: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Keep the breaker states under ``root`` up with a stream of classified probes; `read_breaker` reads them.

    The state store holds the totals of each domain and day. A batch writes the
    totals that it changes and folds the breakers of their domains alone. So a
    day may arrive in any number of batches, and days in any order.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, days = batch.sparkSession, f"{root}/days"
        write_batch(conform(batch, BREAKER_DAYS), days, batch_id)
        changed = spark.read.schema(BREAKER_DAYS).parquet(f"{days}/batch_id={batch_id}").select("domain").distinct()
        known = _latest(read_batches(spark, days, BREAKER_DAYS), ["domain", "run"], BREAKER_DAYS)
        asked = keep_domains(known, changed, spread_on=("run",))
        write_batch(conform(breaker_state(asked, settings), BREAKER), f"{root}/breakers", batch_id)

    return _run(run_failures(probes), write, checkpoint)


def read_breaker(spark: SparkSession, root: str) -> DataFrame:
    """The breaker of every domain of a stream."""
    return _latest(read_batches(spark, f"{root}/breakers", BREAKER), ["domain"], BREAKER)


def compact_breaker(spark: SparkSession, root: str) -> int:
    """Fold the batches of `stream_breaker`; days and breakers stay the same."""
    compact(spark, f"{root}/breakers", BREAKER, lambda rows: _latest(rows, ["domain"], BREAKER))
    return compact(spark, f"{root}/days", BREAKER_DAYS, lambda rows: _latest(rows, ["domain", "run"], BREAKER_DAYS))


def _run(stream: DataFrame, write, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )
