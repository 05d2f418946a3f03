"""Session settings for local runs and the one way this package cuts lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benches; clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("crawldelta")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", f"{tempfile.gettempdir()}/crawldelta-warehouse")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Only on a local master, where ``spark.checkpoint.dir`` is unset and no
    checkpoint folder was given to the context, is a temporary one used; on a
    cluster that is an error, as executors do not see each other's disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not re.match(r"local(\[|$)", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="crawldelta-ckpt-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: columns are read as they are needed, and a lost executor costs nothing."""
    path = f"{shared_dir(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folders(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete folders of any of Spark's file systems; those that are not there are passed over."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
