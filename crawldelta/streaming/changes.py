"""Incremental change counts: watermarked daily windows over a stream of changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.keyed import first_per_key
from ..schemas import _table
from .deltas import batch_ids, compact, read_batches, write_batch

# Changes of one domain and day in one batch; ``last_at`` is the latest of them, ``late`` whether they came behind the watermark.
DAY_COUNTS = _table(
    "domain string, day date, late boolean, changes bigint, discovered bigint, modified bigint, removed bigint, last_at timestamp"
)


def daily_counts(changes: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Changes per domain and UTC day; state older than the lateness is let go.

    ``detected_at`` must be a timestamp with time zone semantics; a watermark
    on a plain local timestamp is not accepted by Spark.
    """
    day = F.window("detected_at", "1 day")
    return (
        changes.withWatermark("detected_at", lateness)
        .groupBy("domain", day)
        .agg(
            F.count("*").alias("changes"),
            F.count_if(F.col("change_type") == "discovered").alias("discovered"),
            F.count_if(F.col("change_type") == "modified").alias("modified"),
            F.count_if(F.col("change_type") == "removed").alias("removed"),
        )
        .withColumn("day", F.to_date("window.start"))
        .drop("window")
    )


def write_daily_counts(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run to the end of the available input; each batch writes its updated counts.

    A batch that is run again replaces its own folder.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write_batch)
        .trigger(availableNow=True)
        .start()
    )


def read_daily_counts(spark: SparkSession, path: str) -> DataFrame:
    """Latest counts per domain and day over all batches."""
    latest = first_per_key(spark.read.parquet(path), ["domain", "day"], [F.col("batch_id").desc()])
    return latest.drop("batch_id")


def stream_daily_counts(changes: DataFrame, path: str, checkpoint: str, lateness: str = "2 days") -> StreamingQuery:
    """Changes per domain and day of a stream, rows behind the watermark among them; `read_counts` adds them up.

    The watermark of a batch lies ``lateness`` before the latest change of the
    batches before it. Rows of a day that ended by then are late: they are
    counted as such, and kept under ``path``/late. A batch holds no state and
    writes its own counts only.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = read_batches(spark, f"{path}/counts", DAY_COUNTS, before=batch_id).agg(F.max("last_at").alias("at"))
        (mark,) = before.select((F.col("at") - F.expr(f"interval {lateness}")).alias("mark")).first()
        day = F.to_date("detected_at")
        late = F.coalesce(F.date_add(day, 1).cast("timestamp") <= F.lit(mark).cast("timestamp"), F.lit(False))
        dated = batch.where(F.col("detected_at").isNotNull()).withColumns({"day": day, "late": late})
        counts = dated.groupBy("domain", "day", "late").agg(
            F.count("*").alias("changes"),
            *[F.count_if(F.col("change_type") == c).alias(c) for c in ("discovered", "modified", "removed")],
            F.max("detected_at").alias("last_at"),
        )
        write_batch(counts, f"{path}/counts", batch_id)
        own = spark.read.schema(DAY_COUNTS).parquet(f"{path}/counts/batch_id={batch_id}")
        if not own.where("late").isEmpty():
            write_batch(dated.where("late").drop("day", "late"), f"{path}/late", batch_id)

    return (
        changes.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Changes per domain and day, late rows among them, and how many of them were late."""
    counted = ("changes", "discovered", "modified", "removed")
    return read_batches(spark, f"{path}/counts", DAY_COUNTS).groupBy("domain", "day").agg(
        *[F.sum(c).alias(c) for c in counted], F.sum(F.when(F.col("late"), F.col("changes")).otherwise(0)).alias("late")
    )


def read_late(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The late rows themselves, in the columns of ``like``."""
    folders = [f"{path}/late/batch_id={b}" for b in batch_ids(spark, f"{path}/late")]
    return spark.read.schema(like.schema).parquet(*folders) if folders else spark.createDataFrame([], like.schema)


def compact_counts(spark: SparkSession, path: str) -> int:
    """Fold the counts of all batches but the newest; what is read stays the same."""

    def fold(rows: DataFrame) -> DataFrame:
        sums = [F.sum(c).alias(c) for c in ("changes", "discovered", "modified", "removed")]
        return rows.groupBy("domain", "day", "late").agg(*sums, F.max("last_at").alias("last_at"))

    return compact(spark, f"{path}/counts", DAY_COUNTS, fold)
