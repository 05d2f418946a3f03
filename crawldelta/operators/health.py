"""Rollups of probe history: fates, response times, failure rates and the circuit breaker."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.keyed import top_k
from ..schemas import BREAKER
from ..session import drop_folders, written
from .candidates import PRIORITY, STATUS_DEFAULTS
from .diff import as_timestamp

# Fates that count as failed probes. A server error does not.
FAILURE_FATES = ("error", "forbidden", "rate_limited")
TRIP_AFTER = 2


def fate_summary(history: DataFrame) -> DataFrame:
    """Probes per domain and fate, with their share of the domain in percent."""
    counts = history.groupBy("domain", "fate").agg(F.count("*").alias("probes"))
    total = F.sum("probes").over(Window.partitionBy("domain"))
    return counts.withColumn("pct", F.round(F.col("probes") * 100 / total, 1))


def fate_by_change_type(history: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` most frequent fates per domain and change type."""
    counts = (
        history.where(F.col("change_type").isin(*PRIORITY))
        .groupBy("domain", "change_type", "fate")
        .agg(F.count("*").alias("probes"))
    )
    keys = ["domain", "change_type"]
    return top_k(counts, keys, [F.col("probes").desc(), F.col("fate")], k, rank_as="rank")


def response_percentiles(history: DataFrame, quantiles: dict[str, float] | None = None) -> DataFrame:
    """Exact interpolated response-time percentiles per domain, over positive times.

    The values of a domain never meet in one task. Times are counted per value
    with partial aggregation, the counts are summed per bin of like values,
    whatever their unit, and only the bins that hold a wanted rank are looked at
    value by value.
    """
    quantiles = quantiles or {"median_ms": 0.5, "p95_ms": 0.95}
    times = history.where(F.col("response_time_ms") > 0).select(
        "domain", F.col("response_time_ms").cast("double").alias("v")
    )
    values = times.groupBy("domain", _bin(F.col("v")).alias("bin"), "v").agg(F.count("*").alias("n"))
    bins = values.groupBy("domain", "bin").agg(F.sum("n").alias("bin_n"))
    return _at_ranks(values, _wanted_bins(bins, quantiles), quantiles)


def _wanted_bins(bins: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """Of bins(domain, bin, bin_n) those that hold a wanted rank, with the ranks, the values before them and the domain's total."""
    by_bin = Window.partitionBy("domain").orderBy("bin")
    located = bins.withColumns(
        {
            "before": F.sum("bin_n").over(by_bin) - F.col("bin_n"),
            "total": F.sum("bin_n").over(Window.partitionBy("domain")),
        }
    )
    ranks = F.array(
        *[
            F.struct(F.lit(n).alias("name"), side.alias("rank"), weight.alias("weight"))
            for n, q in quantiles.items()
            for side, weight in _rank_pair(q)
        ]
    )
    first, last = F.col("before"), F.col("before") + F.col("bin_n")
    return located.select(
        "domain", "bin", "before", "total",
        F.filter(ranks, lambda r: (r["rank"] >= first) & (r["rank"] < last)).alias("ranks"),
    ).where(F.size("ranks") > 0)


def _at_ranks(values: DataFrame, wanted: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """The percentiles of each domain from counted values(domain, bin, v, n) of the wanted bins at least."""
    in_bin = Window.partitionBy("domain", "bin").orderBy("v")
    placed = (
        _same_bin(values, wanted)
        .withColumn("hi", F.col("before") + F.sum("n").over(in_bin))
        .withColumn("lo", F.col("hi") - F.col("n"))
        .withColumn("r", F.explode("ranks"))
        .where((F.col("r.rank") >= F.col("lo")) & (F.col("r.rank") < F.col("hi")))
    )
    return placed.groupBy("domain").agg(
        F.max("total").alias("probes"),
        *[
            F.sum(F.when(F.col("r.name") == n, F.col("v") * F.col("r.weight"))).alias(n)
            for n in quantiles
        ],
    )


_BINS = 4096  # of one power of two


def _bin(v: Column) -> Column:
    """Number of a bin of values that differ by one part in 4,096 at most; it grows with the value."""
    power = F.floor(F.log2(v))
    return power * _BINS + F.floor((v / F.pow(F.lit(2.0), power) - 1) * _BINS)


def _same_bin(values: DataFrame, wanted: DataFrame) -> DataFrame:
    # Null-safe on purpose: no filter is then inferred for one side only, and both
    # readings of the counted values share one exchange.
    bins = wanted.select(
        F.col("domain").alias("_d"), F.col("bin").alias("_b"), "before", "total", "ranks"
    )
    same = values["domain"].eqNullSafe(bins["_d"]) & values["bin"].eqNullSafe(bins["_b"])
    return values.join(bins, same).drop("_d", "_b")


def _rank_pair(q: float) -> list[tuple[Column, Column]]:
    """The two 0-based ranks around a quantile, each with its interpolation weight."""
    at = (F.col("total") - 1) * F.lit(q)
    low = F.floor(at)
    share = at - low
    return [(low, 1 - share), (F.least(low + 1, F.col("total") - 1), share)]


def write_day_counts(history: DataFrame, path: str) -> None:
    """Add the response times of whole days to the stored counts under ``path``; a day that is written again is replaced.

    ``values`` holds (domain, v, n) by day and octave, the power of two below the
    value; ``bins`` holds (domain, bin, n) by day. Counts of any days add up.
    """
    v = F.col("response_time_ms").cast("double")
    times = history.where(v > 0).select("domain", F.to_date("checked_at").alias("day"), v.alias("v"))
    counted = written(times.groupBy("domain", "day", "v").agg(F.count("*").alias("n")).withColumn("bin", _bin(F.col("v"))), "day-values")
    octave = F.floor(F.col("bin") / _BINS).cast("int").alias("octave")
    bins = counted.groupBy("domain", "day", "bin").agg(F.sum("n").alias("n"))
    days = [r.day for r in bins.select("day").distinct().collect()]
    # A day's octaves go together: none of what it had before may be left. A job that dies here is run again.
    drop_folders(history.sparkSession, [f"{path}/{kind}/day={day}" for kind in ("values", "bins") for day in days])
    counted.select("domain", "v", "n", "day", octave).write.mode("append").partitionBy("day", "octave").parquet(f"{path}/values")
    bins.write.mode("append").partitionBy("day").parquet(f"{path}/bins")


def percentiles_over_days(spark: SparkSession, path: str, first: date | str, last: date | str,
                          quantiles: dict[str, float] | None = None) -> DataFrame:
    """The exact percentiles of `response_percentiles` over a range of days, both included, from the stored counts.

    The bins of the days are added up; values are read only of the octaves in
    which some domain's bin holds a wanted rank, and of these bins.
    """
    quantiles = quantiles or {"median_ms": 0.5, "p95_ms": 0.95}
    of_days = F.col("day").between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))
    bins = spark.read.schema("domain string, bin bigint, n bigint, day date").parquet(f"{path}/bins").where(of_days)
    wanted = written(_wanted_bins(bins.groupBy("domain", "bin").agg(F.sum("n").alias("bin_n")), quantiles), "wanted-bins")
    # As many octaves as a double has exponents, at most.
    octaves = [r.o for r in wanted.select(F.floor(F.col("bin") / _BINS).cast("int").alias("o")).distinct().collect()]
    values = spark.read.schema("domain string, v double, n bigint, octave int, day date").parquet(f"{path}/values")
    values = values.where(of_days & F.col("octave").isin(octaves)).withColumn("bin", _bin(F.col("v")))
    asked = wanted.select(F.col("domain").alias("_d"), F.col("bin").alias("_b"))
    opened = values.join(asked, F.col("domain").eqNullSafe(F.col("_d")) & (F.col("bin") == F.col("_b")), "left_semi")
    return _at_ranks(opened.groupBy("domain", "bin", "v").agg(F.sum("n").alias("n")), wanted, quantiles)


def run_failures(history: DataFrame, run: Column | None = None) -> DataFrame:
    """Probes, failures and failure rate per domain and run; a run is a UTC day by default."""
    run = F.to_date("checked_at") if run is None else run
    forced = F.coalesce(F.bool_or("forced"), F.lit(False)) if "forced" in history.columns else F.lit(False)
    return (
        history.groupBy("domain", run.alias("run"))
        .agg(
            F.count("*").alias("total"),
            F.count_if(F.col("fate").isin(*FAILURE_FATES)).alias("failures"),
            forced.alias("forced"),
        )
        .withColumn("failure_rate", F.col("failures") / F.col("total"))
    )


def breaker_state(runs: DataFrame, settings: DataFrame, initial: DataFrame | None = None) -> DataFrame:
    """Fold ordered runs into one breaker row per domain.

    A rate at or over the threshold counts as bad; the second bad run in a row
    opens the breaker for ``backoff_days``. Runs before the end of a backoff do
    not happen, but for those that were ``forced``, which count. The end of a backoff closes the breaker but keeps the count of
    bad runs, so one more bad run opens it again. Empty runs change nothing else.

    ``runs`` has one row per domain and run, so a fold holds days, not probes;
    with ``initial``, the stored state, it holds only the runs since then.
    """
    defaults = {k: F.lit(STATUS_DEFAULTS[k]) for k in ("failure_threshold", "backoff_days")}
    ordered = runs.groupBy("domain").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col("run").cast("timestamp").alias("run"),
                    F.col("total").cast("bigint").alias("total"),
                    F.col("failures").cast("bigint").alias("failures"),
                    (F.coalesce("forced", F.lit(False)) if "forced" in runs.columns else F.lit(False)).alias("forced"),
                )
            )
        ).alias("runs")
    )
    joined = ordered.join(settings.select("domain", *defaults), "domain", "left")
    joined = joined.withColumns({k: F.coalesce(F.col(k), d) for k, d in defaults.items()})
    empty = F.struct(
        *[_start_value(f.name).cast(f.dataType).alias(f.name) for f in BREAKER.fields[1:]]
    )
    if initial is None:
        joined = joined.withColumn("state", empty)
    else:
        stored = initial.select("domain", F.struct(*BREAKER.names[1:]).alias("state"))
        joined = joined.join(stored, "domain", "full_outer").withColumns(
            {
                "state": F.coalesce(F.col("state"), empty),
                "runs": F.coalesce(F.col("runs"), F.expr("array()").cast(joined.schema["runs"].dataType)),
            }
        )
    folded = F.aggregate(
        "runs",
        F.col("state"),
        lambda s, r: step_breaker(s, r, F.col("failure_threshold"), F.col("backoff_days")),
    )
    return joined.select("domain", folded.alias("s")).select("domain", "s.*")


def _start_value(name: str) -> Column:
    if name == "is_open":
        return F.lit(False)
    return F.lit(None) if name in ("last_check", "backoff_until") else F.lit(0)


def step_breaker(state: Column, run: Column, threshold: Column, backoff_days: Column) -> Column:
    """The breaker after one more run."""
    waiting = (state["backoff_until"] > run["run"]) & ~run["forced"]
    expired = state["backoff_until"] <= run["run"]
    rate = run["failures"] / run["total"]
    bad = rate >= threshold
    streak = F.when(bad, state["consecutive_high_failures"] + 1).otherwise(0)
    trips = bad & (streak >= TRIP_AFTER)
    still_open = F.when(expired, False).otherwise(state["is_open"])
    kept_until = F.when(expired, F.lit(None).cast("timestamp")).otherwise(state["backoff_until"])
    until = run["run"] + F.make_dt_interval(days=backoff_days.cast("int"))
    after = {
        "is_open": F.when(trips, True).when(~bad, False).otherwise(still_open),
        "last_check": run["run"],
        "last_failure_rate": rate,
        "consecutive_high_failures": streak,
        "backoff_until": F.when(trips, until).otherwise(kept_until),
        "total_checks": state["total_checks"] + run["total"],
        "total_failures": state["total_failures"] + run["failures"],
    }
    idle = {"is_open": still_open, "backoff_until": kept_until}

    def pack(values: dict[str, Column]) -> Column:
        return F.struct(
            *[values.get(f.name, state[f.name]).cast(f.dataType).alias(f.name) for f in BREAKER.fields[1:]]
        )

    return (
        F.when(F.coalesce(waiting, F.lit(False)), state)
        .when(run["total"] == 0, pack(idle))
        .otherwise(pack(after))
    )


def breaker_totals(breaker: DataFrame) -> DataFrame:
    return breaker.select("domain", "total_checks", "total_failures", "last_check", "last_failure_rate")


def runnable(settings: DataFrame, breaker: DataFrame, run_ts: datetime | str, force: bool = False) -> DataFrame:
    """Domains to probe now: enabled and not held back by their breaker, or all if forced."""
    if force:
        return settings.select("domain")
    now = as_timestamp(run_ts)
    joined = settings.select("domain", "enabled").join(
        breaker.select("domain", "is_open", "backoff_until"), "domain", "left"
    )
    held = F.when(F.col("backoff_until").isNotNull(), F.col("backoff_until") > now).otherwise(
        F.coalesce("is_open", F.lit(False))
    )
    return joined.where(F.col("enabled") & ~held).select("domain")
