"""State tables kept as complete runs.

A run is written to its own ``run_id=`` folder and becomes visible when its
success marker is there; readers take the newest complete run. A table is never
overwritten while a job may read it, and a job that dies leaves the last
complete run in force.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..schemas import conform
from ..session import shared_dir


def latest_run(spark: SparkSession, root: str, before: str | None = None) -> str | None:
    """Folder of the newest complete run under ``root``, or None.

    With ``before``, only runs with a lesser id count, so a job that is run
    again starts from the same state as the first time.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    names = sorted(
        s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().startswith("run_id=")
    )
    for name in reversed(names):
        if before is not None and name >= f"run_id={before}":
            continue
        if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/_SUCCESS")):
            return f"{root}/{name}"
    return None


def drop_old_runs(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Delete all but the newest ``keep`` complete runs; returns the deleted folders.

    Only runs older than a kept complete run go, so the state in force stays.
    """
    if keep < 1:
        raise ValueError("at least one run must be kept")
    oldest, before = None, None
    for _ in range(keep):
        run = latest_run(spark, root, before)
        if run is None:
            return []
        oldest = run
        before = run.rsplit("run_id=", 1)[1]
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    gone = [f"{root}/{n}" for n in sorted(names) if n.startswith("run_id=") and f"{root}/{n}" < oldest]
    for folder in gone:
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(folder)}")
        fs.delete(jvm.org.apache.hadoop.fs.Path(folder), True)
    return gone


def read_state(spark: SparkSession, root: str, schema: StructType,
               before: str | None = None, buckets: int | None = None) -> DataFrame:
    """The newest complete run, or an empty table before the first one.

    With ``buckets``, a run that was written in buckets is read in the number it
    was written with, whatever the caller asks for: every row is seen, and where
    the numbers differ Spark shuffles.
    """
    run = latest_run(spark, root, before)
    if run is None:
        return spark.createDataFrame([], schema)
    written = _written_buckets(spark, run) if buckets else None
    if written:
        return _bucketed_table(spark, run, schema, written)
    return spark.read.schema(schema).parquet(run)


def write_state(df: DataFrame, root: str, run_id: str, schema: StructType,
                buckets: int | None = None, placed: bool = False) -> str:
    """Write a complete run; run ids sort by time. Writing a run again replaces it.

    With ``buckets``, rows are brought to their bucket first, so that each task
    writes one file, unless they are ``placed`` there already. The number of
    buckets is kept beside the files.
    """
    out = f"{root}/run_id={run_id}"
    rows = conform(df, schema)
    if buckets and not placed:
        rows = rows.repartition(buckets, *BUCKET_KEY)
    if not buckets:
        rows.write.mode("overwrite").parquet(out)
        return out
    name = _table_name(out)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    (
        rows.write.mode("overwrite")
        .bucketBy(buckets, *BUCKET_KEY)
        .sortBy(*BUCKET_KEY)
        .option("path", out)
        .saveAsTable(name)
    )
    jvm = df.sparkSession.sparkContext._jvm
    note = jvm.org.apache.hadoop.fs.Path(f"{out}/{_BUCKETS}{buckets}")
    note.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).create(note, True).close()
    return out


# A file that Spark's readers pass over; its name ends in the number of buckets.
_BUCKETS = "_buckets_"


def _written_buckets(spark: SparkSession, run: str) -> int | None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(run)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return next((int(n.removeprefix(_BUCKETS)) for n in names if n.startswith(_BUCKETS)), None)


def cut_lineage_bucketed(df: DataFrame, buckets: int) -> DataFrame:
    """Materialise rows that lie by bucket in the shared folder, keeping their buckets.

    ``drop_scratch`` deletes all such tables once their readers are done.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    name = _table_name(path)
    df.write.bucketBy(buckets, *BUCKET_KEY).sortBy(*BUCKET_KEY).option("path", path).saveAsTable(name)
    _SCRATCH[name] = path
    return spark.table(name)


_SCRATCH: dict[str, str] = {}


def drop_scratch(spark: SparkSession) -> None:
    """Delete the tables of this process that only cut lineage, with their catalog entries."""
    jvm = spark.sparkContext._jvm
    while _SCRATCH:
        name, path = _SCRATCH.popitem()
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


BUCKET_KEY = ("domain", "loc")


def _table_name(path: str) -> str:
    return "crawldelta_" + hashlib.md5(path.encode()).hexdigest()


def _bucketed_table(spark: SparkSession, run: str, schema: StructType, buckets: int) -> DataFrame:
    """A bucketed run as an external table, so that its partitioning is known to the planner.

    The catalog entry only repeats what the files are; it is declared anew in a
    session that does not have it.
    """
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    key = ", ".join(BUCKET_KEY)
    name = _table_name(run)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{run}'"
    )
    return spark.table(name)
