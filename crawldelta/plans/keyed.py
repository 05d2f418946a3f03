"""Plan shapes for keyed work that must hold when one key has a third of all rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Spark prunes ranked windows on the map side only up to this rank bound
# (spark.sql.optimizer.windowGroupLimitThreshold).
_MAP_SIDE_RANK_BOUND = 1000


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
          rank_as: str | None = None) -> DataFrame:
    """First ``k`` rows per key under a total order.

    A literal bound lets Catalyst put a WindowGroupLimit below the exchange, so
    a map task ships at most ``k`` rows per key however hot the key is. Beyond
    the bound up to which Spark does so, rows are ranked in slices first.
    """
    if k > _MAP_SIDE_RANK_BOUND:
        return top_k_sliced(df, keys, order, F.lit(k), df.columns, rank_as)
    name = rank_as or "_rank"
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
    return out if rank_as else out.drop(name)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_k(df, keys, order, 1)


def top_k_sliced(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                 k: Column, slice_on: Sequence[str], rank_as: str | None = None) -> DataFrame:
    """First ``k`` rows per key where ``k`` is a column, exact under skew.

    Rows are first ranked inside hashed slices of their key, one slice per
    shuffle partition P, and only the first ``k`` of each slice go on. A second
    round over about sqrt(P) slices follows, so that no task ranks more than
    about sqrt(P) * k rows of one key before the last one. The
    explicit repartition keeps an earlier partitioning by the bare key from
    being reused, which would put a hot key into one task.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rounds = [partitions, math.isqrt(partitions)]
    name = rank_as or "_rank"
    out = df.withColumn("_hash", F.xxhash64(*slice_on))
    for slices in rounds:
        by_slice = Window.partitionBy(*keys, "_slice").orderBy(*order)
        out = (
            out.withColumn("_slice", F.pmod("_hash", F.lit(slices)))
            .repartition(*keys, "_slice")
            .withColumn("_slice_rank", F.row_number().over(by_slice))
            .where(F.col("_slice_rank") <= k)
        )
    by_key = Window.partitionBy(*keys).orderBy(*order)
    out = (
        out.drop("_hash", "_slice", "_slice_rank")
        .withColumn(name, F.row_number().over(by_key))
        .where(F.col(name) <= k)
    )
    return out if rank_as else out.drop(name)


def hot_domains(rows: DataFrame) -> DataFrame:
    """Domains with more than an even partition's share of the rows.

    With P shuffle partitions each of them has over 1/P of the rows, so there
    are fewer than P of them, whatever the data. Counting reads one column.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.groupBy("domain").agg(F.count("*").alias("_n"))
    total = counts.select(F.sum("_n")).scalar()
    return counts.where(F.col("_n") * partitions > total).select("domain")


def join_domains(facts: DataFrame, dim: DataFrame, columns: Sequence[str], hot: DataFrame,
                 spread_on: Sequence[str] = ("loc",)) -> DataFrame:
    """Left join a table with one row per domain to a table with many.

    The number of domains has no bound, so the dimension is not forced into a
    broadcast. Only its rows for the hot domains are, of which there are fewer
    than shuffle partitions; rows of hot domains take their match from there and
    go through the other join under a spread key that matches nothing. What is
    left for that join has no hot key. Spark still broadcasts the dimension by
    itself where it measures it below its threshold.
    """
    packed = F.struct(*columns)
    few = hot.join(dim.select("domain", packed.alias("_hot_row")), "domain", "left")
    few = few.select("domain", "_hot_row", F.lit(True).alias("_hot"))
    spread = F.concat(F.lit("\u0000"), F.xxhash64(*spread_on).cast("string"))
    key = F.when(F.col("_hot") | F.col("domain").isNull(), spread).otherwise(F.col("domain"))
    keyed = dim.select(F.col("domain").alias("_key"), packed.alias("_row"))
    return (
        facts.join(F.broadcast(few), "domain", "left")
        .withColumn("_key", key)
        .join(keyed, "_key", "left")
        .withColumn("_row", F.coalesce("_hot_row", "_row"))
        .select(*facts.columns, *[F.col(f"_row.{c}").alias(c) for c in columns])
    )


def tag_known_domains(df: DataFrame, domains: DataFrame, flag: str, hot: DataFrame | None = None,
                      spread_on: Sequence[str] = ("loc",)) -> DataFrame:
    """Add a boolean: does the row's domain occur in ``domains``?"""
    known = domains.select("domain").distinct().withColumn(flag, F.lit(True))
    tagged = join_domains(df, known, [flag], hot_domains(df) if hot is None else hot, spread_on)
    return tagged.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def keep_domains(df: DataFrame, domains: DataFrame, present: bool = True,
                 spread_on: Sequence[str] = ("loc",)) -> DataFrame:
    """Rows whose domain occurs in ``domains``, or with ``present`` false does not."""
    tagged = tag_known_domains(df, domains, "_known", spread_on=spread_on)
    return tagged.where(F.col("_known") == present).drop("_known")
