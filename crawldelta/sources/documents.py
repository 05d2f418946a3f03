"""Fetched documents: sitemap files and target configuration."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from ..functions.urls import netloc
from ..schemas import TARGETS


# What some file system does not take in a name, and what Spark escapes in a folder's.
_UNSAFE = [*map(chr, range(1, 32)), *'"#%\'*/:<=>?[\\]^{|}', chr(127)]
_ESCAPE = f"%(?i:{'|'.join(f'{ord(c):02x}' for c in _UNSAFE)})"


#: Stored files are read in no more tasks than this, or 64 for each core where that is more.
READ_TASKS = 1_000


def stored_name(address: Column) -> Column:
    """The file name for an address without its scheme, in one folder; `address_of` gives it back.

    Signs that no file name takes become ``%`` and two digits. All others stay
    as written, the address's own escapes too; a ``%`` is escaped only where it
    would else begin such an escape.
    """
    name = F.regexp_replace(address, f"%(?={_ESCAPE[1:]})", "%25")
    for c in _UNSAFE:
        if c != "%":
            name = F.replace(name, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return name


def address_of(name: Column) -> Column:
    """The address that a stored name or path stands for: only the escapes that `stored_name` writes are undone."""
    parts = F.regexp_extract_all(name, F.lit(f"{_ESCAPE}|[^%]++|%"), F.lit(0))
    plain = lambda p: F.char(F.conv(F.substr(p, F.lit(2)), 16, 10).cast("int"))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(f"^{_ESCAPE}$"), plain(p)).otherwise(p)), "")


def read_sitemap_docs(spark: SparkSession, path: str, base: str = "https://") -> DataFrame:
    """Stored sitemap files, one row per file.

    Files lie under ``path`` as ``<host>/<rest of the address>``, or in one
    folder under `stored_name`, so the address is the file's path below the
    folder. Names that are no escapes of that rule are addresses as they stand.
    """
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    # Spark puts a few files in a task, however small they are; many small files are read one after another.
    files = files.withColumn("uri", F.col("_metadata.file_path")).withColumn("fetched_at", F.col("_metadata.file_modification_time"))
    files = files.coalesce(max(READ_TASKS, 64 * spark.sparkContext.defaultParallelism))
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    root = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(folder).toString().rstrip("/")
    # The file URI escapes what it must, once; a plus sign is a plus sign.
    uri = F.col("uri")
    place = F.coalesce(F.try_url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), uri)
    plain = F.regexp_replace(place, "^([a-z][a-z0-9+.-]*):/+", "$1:/")
    start = re.sub("^([a-z][a-z0-9+.-]*):/+", r"\1:/", root)
    below = F.substr(plain, F.lit(len(start) + 2))
    return files.select(
        F.concat(F.lit(base), address_of(below)).alias("sitemap_url"),
        F.col("value").alias("xml"),
        "fetched_at",
    ).select(netloc(F.col("sitemap_url")).alias("domain"), "sitemap_url", "xml", "fetched_at")


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """Targets from a configuration file with a ``targets`` list."""
    shape = StructType([StructField("targets", ArrayType(TARGETS))])
    config = spark.read.schema(shape).json(path, multiLine=True)
    return config.select(F.inline("targets"))
