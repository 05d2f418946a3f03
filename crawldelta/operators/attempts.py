"""History of fetch attempts per domain and method."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RETAINED = 500


def attempt_outcomes(attempts: DataFrame) -> DataFrame:
    """Per domain and method: did it ever work, and did the latest attempt fail?"""
    latest = F.max(F.struct("attempted_at", "url", "success"))
    return attempts.groupBy("domain", "method").agg(
        F.bool_or("success").alias("working"),
        (~latest["success"]).alias("failed"),
        F.max(F.when(F.col("success"), F.col("attempted_at"))).alias("last_success"),
        F.max(F.when(~F.col("success"), F.col("attempted_at"))).alias("last_failure"),
    )


def attempt_status(attempts: DataFrame) -> DataFrame:
    """Per domain: last success, last failure and the working and failed methods.

    Built on the per-method outcomes, so the lists hold methods, not attempts.
    """

    def methods(flag: str):
        return F.array_sort(F.collect_set(F.when(F.col(flag), F.col("method"))))

    return attempt_outcomes(attempts).groupBy("domain").agg(
        methods("working").alias("working_methods"),
        methods("failed").alias("failed_methods"),
        F.max("last_success").alias("last_success"),
        F.max("last_failure").alias("last_failure"),
    )


def retain_recent(attempts: DataFrame, keep: int = RETAINED) -> DataFrame:
    """The newest attempts overall, a bounded history by definition."""
    order = [F.col("attempted_at").desc(), F.col("domain"), F.col("method"), F.col("url")]
    return attempts.orderBy(*order).limit(keep)
