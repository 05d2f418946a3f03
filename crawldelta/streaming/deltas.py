"""What the batches of a stream leave: a folder for each, and a base that holds the older ones folded.

A batch writes its own rows only. A batch that is run again replaces its own
folder, and the base never holds the newest batch, which is the only one that
may be run again; so no row is lost or told twice, whatever fails.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.state import drop_old_runs, latest_run, read_state, write_state

_BATCH = "batch_id="


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write what one batch adds; writing it again replaces it."""
    rows.write.mode("overwrite").parquet(f"{path}/{_BATCH}{batch_id}")


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """Batches whose folder is complete, ascending."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    done = [n for n in names if n.startswith(_BATCH) and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return sorted(int(n.removeprefix(_BATCH)) for n in done)


def _base_id(spark: SparkSession, path: str) -> int:
    """The last batch that the base holds; -1 without one."""
    run = latest_run(spark, f"{path}/base")
    return int(run.rsplit("run_id=", 1)[1]) if run else -1


def read_batches(spark: SparkSession, path: str, schema: StructType, before: int | None = None) -> DataFrame:
    """Rows of the base and of all complete batches after it, with their ``batch_id``; ``before``: of earlier batches only."""
    held = _base_id(spark, path)
    base = read_state(spark, f"{path}/base", schema).withColumn("batch_id", F.lit(held).cast("bigint"))
    newer = [b for b in batch_ids(spark, path) if b > held and (before is None or b < before)]
    if not newer:
        return base
    folders = [f"{path}/{_BATCH}{b}" for b in newer]
    rows = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    number = F.regexp_extract("_metadata.file_path", rf"/{_BATCH}([0-9]+)/[^/]*$", 1).cast("bigint")
    return base.unionByName(rows.select(*schema.names, number.alias("batch_id")))


def compact(spark: SparkSession, path: str, schema: StructType, fold: Callable[[DataFrame], DataFrame]) -> int:
    """Fold all batches but the newest into the base and delete their folders; gives the number of batches folded.

    ``fold`` turns rows with their batch_id into the rows that say the same. To
    be run between batches, as often as reading many folders costs too much.
    """
    ids = batch_ids(spark, path)
    done = [b for b in ids[:-1] if b > _base_id(spark, path)]
    if done:
        rows = fold(read_batches(spark, path, schema, before=ids[-1]))
        write_state(rows, f"{path}/base", f"{done[-1]:012d}", schema)
        drop_old_runs(spark, f"{path}/base", 1)
    jvm = spark.sparkContext._jvm
    for b in batch_ids(spark, path):
        if b <= _base_id(spark, path):
            folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{_BATCH}{b}")
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return len(done)
