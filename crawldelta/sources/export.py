"""Plain CSV output of any result, for use outside Spark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def export_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write CSV with a header line; nested columns are written as JSON.

    Partitioned by domain this gives one folder per domain, which suits few
    domains; leave it out for many.
    """
    nested = [f.name for f in df.schema if isinstance(f.dataType, (ArrayType, MapType, StructType))]
    flat = df.withColumns({c: F.to_json(c) for c in nested}) if nested else df
    (
        flat.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .partitionBy(*partition_by)
        .csv(path)
    )
