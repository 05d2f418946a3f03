"""Parsed sitemaps kept by the hash of their text, so that a text is parsed once however often it comes.

The ledger is a Parquet table with a row for each distinct text. A run appends
the texts it sees for the first time, in one committed write; a text that two
runs appended counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.sitemaps import parse_sitemaps
from ..session import written

_PARSED = ["sitemap_type", "sitemap", "url", "fault", "content_hash", "content_length"]


def _shape(docs: DataFrame) -> StructType:
    """The ledger's columns, without reading anything."""
    return parse_sitemaps(docs.select("xml").limit(0)).select(*_PARSED).schema


def read_ledger(spark: SparkSession, ledger: str, schema: StructType) -> DataFrame:
    """The stored parses; empty before the first run."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(ledger)


def parse_unseen(docs: DataFrame, ledger: str) -> int:
    """Parse the texts of docs(xml, ...) that the ledger lacks and append them; gives their number.

    Hashes are made where the texts are read; only unseen texts are shuffled, a
    text of many documents once.
    """
    spark, schema = docs.sparkSession, _shape(docs)
    texts = docs.select(F.coalesce("xml", F.lit("")).alias("xml")).withColumn("content_hash", F.sha2("xml", 256))
    known = read_ledger(spark, ledger, schema).select("content_hash")
    unseen = written(texts.select("content_hash").distinct().join(known, "content_hash", "left_anti"), "unseen")
    n = unseen.count()
    if n:
        asked = texts.join(unseen, "content_hash", "left_semi").groupBy("content_hash").agg(F.first("xml").alias("xml"))
        parse_sitemaps(asked.select("xml")).select(*_PARSED).write.mode("append").parquet(ledger)
    return n


def parse_by_hash(docs: DataFrame, ledger: str) -> DataFrame:
    """What `parse_sitemaps` gives of docs, of which only unseen texts are parsed. A null text is read as an empty one."""
    parse_unseen(docs, ledger)
    schema = _shape(docs)
    stored = read_ledger(docs.sparkSession, ledger, schema).dropDuplicates(["content_hash"])
    keyed = docs.withColumn("content_hash", F.sha2(F.coalesce("xml", F.lit("")), 256)).drop("xml")
    return keyed.join(stored, "content_hash")


def prune_ledger(docs: DataFrame, ledger: str, target: str) -> None:
    """Write the ledger's rows for the texts of docs to another folder: a ledger without those that come no more."""
    schema = _shape(docs)
    held = docs.select(F.sha2(F.coalesce("xml", F.lit("")), 256).alias("content_hash")).distinct()
    rows = read_ledger(docs.sparkSession, ledger, schema).dropDuplicates(["content_hash"])
    rows.join(held, "content_hash", "left_semi").select(*_PARSED).write.parquet(target)
