"""Written intermediate tables in the folder that driver and executors share, and the code that tasks need."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawldelta.session import shared_dir

#: A key table of at most this many rows (a few tens of MB) may be broadcast;
#: a larger one is joined by a shuffle, with the same result.
BROADCAST_ROWS = 500_000


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not see the driver's folders. Once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="crawldelta-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the shared folder."""
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df once as Parquet and read it back: lineage ends here and a lost executor costs nothing."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keys_for_join(keys: DataFrame) -> DataFrame:
    """Mark a stored key table for broadcast only where its row count is checked to be small."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def matching(df: DataFrame, listed: DataFrame, keys: dict[str, Column], how: str) -> DataFrame:
    """The rows of df (left_semi), or all others (left_anti), whose keys are in the stored table listed; null equals null.

    The keys are expressions over df by the names they have in listed, so that df
    gets no column and may have any.
    """
    names = {c: f"__key_{i}" for i, c in enumerate(keys)}
    renamed = keys_for_join(listed.select(*[F.col(c).alias(n) for c, n in names.items()]).distinct())
    conditions = [keys[c].eqNullSafe(renamed[n]) for c, n in names.items()]
    return df.join(renamed, reduce(lambda a, b: a & b, conditions), how)


def without(df: DataFrame, dropped: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """The rows of df whose keys are not in the stored table dropped."""
    return matching(df, dropped, keys, "left_anti")
