"""Status history and full response headers, by UTC day of the probe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ..schemas import HEADERS, STATUS_HISTORY, conform


def append_status_history(probes: DataFrame, path: str, run_id: str,
                          partition_by: Sequence[str] = ("check_date",)) -> None:
    """Add a run's classified probes in the 25 history columns; running it again replaces the run.

    Rows are ranged by day, domain and address before the write: a day is a few
    well-filled files in domain order, readers skip files by domain, and a
    domain with many probes is cut into several files.
    """
    rows = conform(probes, STATUS_HISTORY).withColumns({"run_id": F.lit(run_id), "check_date": F.to_date("checked_at")})
    _clear_run(probes.sparkSession, path, run_id)
    (
        rows
        .repartitionByRange("check_date", "domain", "url")
        .sortWithinPartitions("check_date", "domain", "url")
        .write.mode("append")
        .partitionBy("run_id", *partition_by)
        .parquet(path)
    )


def _clear_run(spark: SparkSession, path: str, run_id: str) -> None:
    """Delete what an earlier attempt of the run has written; the run's rows may lie in other days now, or be none."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/run_id={run_id}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def read_status_history(spark: SparkSession, path: str) -> DataFrame:
    schema = StructType(STATUS_HISTORY.fields + [StructField("run_id", StringType()), StructField("check_date", DateType())])
    return spark.read.schema(schema).parquet(path)


def write_headers(probes: DataFrame, path: str, run_id: str) -> None:
    """Add a run's full headers as JSON lines, for the probes that have any; running it again replaces the run."""
    _clear_run(probes.sparkSession, path, run_id)
    headers = F.col("headers") if "headers" in probes.columns else F.from_json("headers_json", "map<string,string>")
    (
        probes.withColumn("headers", headers)
        .where(F.size("headers") > 0)
        .select(*HEADERS.names, F.lit(run_id).alias("run_id"), F.to_date("checked_at").alias("check_date"))
        .write.mode("append")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .partitionBy("run_id", "check_date")
        .json(path)
    )


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HEADERS).json(path)
