"""The change log: one partition per month and run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.diff import as_timestamp
from ..schemas import CHANGES, conform

_PARTITION_COLUMNS = ("change_month", "run_id")


def run_id_of(run_ts: datetime | str) -> str:
    """Run ids are the digits of the run's time, so they sort by time."""
    return "".join(ch for ch in str(run_ts)[:19] if ch.isdigit())


def append_changes(changes: DataFrame, path: str, run_ts: datetime | str) -> None:
    """Add the changes of a run. Running it again replaces the run, it does not repeat it."""
    now = as_timestamp(run_ts)
    # Overwriting partitions replaces nothing where the run has no rows this time.
    spark = changes.sparkSession
    jvm, run_id = spark.sparkContext._jvm, run_id_of(run_ts)
    if changes.isEmpty():
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/change_month={run_id[:4]}-{run_id[4:6]}/run_id={run_id}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    (
        conform(changes, CHANGES)
        .withColumns({"change_month": F.date_format(now, "yyyy-MM"), "run_id": F.lit(run_id)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_PARTITION_COLUMNS)
        .parquet(path)
    )


def read_changes(spark: SparkSession, path: str, since: datetime | str | None = None) -> DataFrame:
    """The change log in its twelve columns and its partition columns.

    Partitions written before a column existed give nulls for it. With
    ``since``, months before it are not listed for reading.
    """
    schema = StructType(CHANGES.fields + [StructField(c, StringType()) for c in _PARTITION_COLUMNS])
    log = spark.read.schema(schema).parquet(path)
    if since is None:
        return log
    start = as_timestamp(since)
    return log.where(
        (F.col("change_month") >= F.date_format(start, "yyyy-MM")) & (F.col("detected_at") >= start)
    )


def read_changes_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """Monthly CSV logs, one path per header layout, in the twelve columns.

    Columns a layout lacks are null, and so are dates that do not parse.
    """
    logs = [conform(spark.read.csv(p, header=True, multiLine=True, escape='"'), CHANGES) for p in paths]
    out = logs[0]
    for log in logs[1:]:
        out = out.unionByName(log)
    return out
