"""Snapshots: load from CSV or Parquet, quality report, and run-wise writing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.keyed import first_per_key
from ..schemas import SITEMAP_FILES, SNAPSHOT, conform
from .state import read_state, write_state

REQUIRED_COLUMNS = ("loc",)
NULL_LASTMOD_LIMIT_PCT = 50


def read_snapshot_files(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Snapshot files as they are: CSV with a header line, or legacy Parquet.

    Without a format, CSV files are read where the folder holds any, else Parquet.
    """
    if fmt is None:
        jvm = spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        fmt = "csv" if any(n.endswith((".csv", ".csv.gz")) for n in names) else "parquet"
    if fmt == "csv":
        return spark.read.csv(path, header=True, multiLine=True, escape='"')
    return spark.read.parquet(path)


def load_snapshot(raw: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """Typed snapshot, unique on (domain, loc) and without null addresses.

    Absent columns become nulls. Of several rows for one URL the first under
    ``order`` stays; by default the latest detected one.
    """
    typed = conform(raw, SNAPSHOT).where(F.col("loc").isNotNull())
    return first_per_key(typed, ["domain", "loc"], list(order or _default_order()))


def _default_order() -> list[Column]:
    return [
        F.col("detected_at").desc_nulls_last(),
        F.col("lastmod").desc_nulls_last(),
        F.col("sitemap_source_url").asc_nulls_last(),
        F.col("change_type").asc_nulls_last(),
    ]


def snapshot_quality(raw: DataFrame) -> DataFrame:
    """Per domain: rows, duplicate and null addresses, share of URLs without lastmod.

    The share is taken over the rows a load would keep. URLs are reduced per
    (domain, loc) first, so a domain's rows are spread over all tasks.
    """
    missing = [c for c in REQUIRED_COLUMNS if c not in raw.columns]
    typed = conform(raw, SNAPSHOT)
    kept = F.min(
        F.struct(
            (-F.coalesce(F.unix_micros("detected_at"), F.lit(-(2**62)))).alias("age"),
            F.col("lastmod").isNull().alias("unset"),
        )
    )["unset"]
    per_url = typed.groupBy("domain", "loc").agg(F.count("*").alias("n"), kept.alias("unset"))
    located = F.col("loc").isNotNull()
    pct = F.count_if(located & F.col("unset")) * 100 / F.nullif(F.count_if(located), F.lit(0))
    return per_url.groupBy("domain").agg(
        F.sum("n").alias("rows"),
        F.sum(F.col("n") - 1).alias("duplicate_locs"),
        F.sum(F.when(located, 0).otherwise(F.col("n"))).alias("null_locs"),
        F.round(pct, 2).alias("null_lastmod_pct"),
        F.coalesce(pct > NULL_LASTMOD_LIMIT_PCT, F.lit(False)).alias("mostly_without_lastmod"),
        F.lit(",".join(missing)).alias("missing_columns"),
    )


def read_snapshot(spark: SparkSession, root: str, before: str | None = None) -> DataFrame:
    return read_state(spark, root, SNAPSHOT, before)


def write_snapshot(df: DataFrame, root: str, run_id: str) -> str | None:
    """Write the snapshot of a run; an empty one is skipped and the last stays in force."""
    return None if df.isEmpty() else write_state(df, root, run_id, SNAPSHOT)


def write_sitemap_files(df: DataFrame, root: str, run_id: str) -> str | None:
    """Write the sitemap file facts of a run, in their seven columns."""
    return None if df.isEmpty() else write_state(df, root, run_id, SITEMAP_FILES)
