"""Pipeline health from event tables: ingestion counters by window, alert rules, freshness."""

from __future__ import annotations

from datetime import datetime
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapelake.functions.timing import interval_seconds, ts_literal

# Alert rules on ingestion windows (window, measure, comparison, limit, severity).
INGEST_RULES = [
    ("BridgeThroughputZero", "5 minutes", "received_rate", "=", 0.0, "critical"),
    ("BridgeThroughputDrop", "10 minutes", "received_rate", "<", 0.1, "warning"),
    ("KafkaBridgeHighDLQ", "15 minutes", "dlq", ">", 10.0, "warning"),
    ("KafkaBridgeHighValidationFailures", "5 minutes", "rejected_rate", ">", 0.1, "warning"),
    ("KafkaBridgeHighLatency", "5 minutes", "latency_p95", ">", 1.0, "warning"),
]
# Layer freshness limits in seconds, and the default for assets.
FRESHNESS_LIMITS = [
    ("bronze", 120, "warning"),
    ("silver", 600, "warning"),
    ("gold", 7200, "warning"),
    ("bronze", 900, "critical"),
]
ASSET_SLA_HOURS = 24
# Upper bounds of the latency histogram, in seconds.
LATENCY_BUCKETS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0)


_BUCKETS = [f"latency_le_{i}" for i in range(len(LATENCY_BUCKETS))]


def _counters(latency: Column) -> list[Column]:
    """Everything a window is judged by, as counters that add up and one maximum."""
    status = F.col("status")
    return [
        F.count(F.lit(1)).alias("received"),
        F.count_if(status == "invalid").alias("rejected"),
        F.count_if(status.isin("invalid", "bad_json")).alias("dlq"),
        F.count(latency).alias("timed"),
        *[F.count_if(latency <= bound).alias(name) for bound, name in zip(LATENCY_BUCKETS, _BUCKETS)],
        F.max(latency).alias("slowest"),
    ]


def bucket_quantile(q: float, below: list[Column], total: Column, largest: Column) -> Column:
    """Quantile interpolated inside its bucket, given the counts at or below each bound. The bucket past the last
    bound ends at the largest value seen. NULL without values."""
    rank = F.lit(q) * total.cast("double")
    uppers = [F.lit(float(b)) for b in LATENCY_BUCKETS] + [largest]
    out, lower, before = None, F.lit(0.0), F.lit(0.0)
    for upper, count in zip(uppers, [*below, total]):
        cumulative = count.cast("double")
        estimate = lower + (upper - lower) * ((rank - before) / F.nullif(cumulative - before, F.lit(0.0)))
        out = F.when(cumulative >= rank, estimate) if out is None else out.when(cumulative >= rank, estimate)
        lower, before = upper, cumulative
    return F.when(total > 0, out)


def _measures(counted: DataFrame, seconds: Column) -> DataFrame:
    p95 = bucket_quantile(0.95, [F.col(name) for name in _BUCKETS], F.col("timed"), F.col("slowest"))
    return counted.withColumns(
        {
            "latency_p95": p95,
            "received_rate": F.col("received").cast("double") / seconds,
            "rejected_rate": F.col("rejected").cast("double") / seconds,
        }
    ).drop("timed", "slowest", *_BUCKETS)


def ingest_health(events: DataFrame, window: str = "5 minutes") -> DataFrame:
    """Received, rejected and dead-letter counts, rates and 95th-percentile latency per window.

    ``events``: timestamp, status (valid, invalid, bad_json or skipped) and latency_seconds. The percentile comes from
    a fixed set of latency buckets, so a window keeps a dozen numbers however many messages it has.
    """
    counted = events.groupBy(F.window("timestamp", window)["start"].alias("window_start")).agg(
        *_counters(F.col("latency_seconds"))
    )
    return _measures(counted, F.lit(float(interval_seconds(window))))


def topic_counts(events: DataFrame, window: str = "5 minutes") -> DataFrame:
    """Messages per window and topic."""
    return events.groupBy(F.window("timestamp", window)["start"].alias("window_start"), "topic").agg(
        F.count(F.lit(1)).alias("produced")
    )


def _breaks(measure: Column, comparison: str, limit: float) -> Column:
    return {"=": measure == limit, "<": measure < limit, ">": measure > limit}[comparison]


def ingest_alerts(events: DataFrame, rules: list[tuple] = INGEST_RULES) -> DataFrame:
    """Windows that break a rule, silent windows between the first and the last message included.

    The events are read once: they are counted in windows of the greatest length that divides every rule's, and these
    few rows are added up to the rules' own windows.
    """
    lengths = {window: interval_seconds(window) for _, window, *_ in rules}
    step = gcd(*lengths.values())
    counted = events.groupBy(F.window("timestamp", f"{step} seconds")["start"].alias("at")).agg(
        *_counters(F.col("latency_seconds"))
    )
    second = F.unix_seconds("at")
    starts = F.array(
        *[F.struct(F.lit(n).alias("seconds"), (second - F.pmod(second, F.lit(n))).alias("start")) for n in set(lengths.values())]
    )
    sums = [F.sum(c).alias(c) for c in ["received", "rejected", "dlq", "timed", *_BUCKETS]]
    windows = (
        counted.withColumn("w", F.explode(starts))
        .groupBy("w.seconds", "w.start")
        .agg(*sums, F.max("slowest").alias("slowest"))
    )
    judged = _measures(windows, F.col("seconds").cast("double"))
    # Each window also stands for the silent ones that follow it; a length has at most one row per window.
    judged = judged.withColumn("_next", F.lead("start").over(Window.partitionBy("seconds").orderBy("start")))
    following = F.col("_next")
    silent = F.when(
        following > F.col("start") + F.col("seconds"),
        F.sequence(F.col("start") + F.col("seconds"), following - F.col("seconds"), F.col("seconds").cast("bigint")),
    )
    own = F.array(F.struct(F.col("start").alias("start"), F.lit(False).alias("silent")))
    gaps = F.transform(silent, lambda s: F.struct(s.alias("start"), F.lit(True).alias("silent")))
    every = F.when(gaps.isNull(), own).otherwise(F.concat(own, gaps))
    filled = judged.withColumn("w", F.explode(every))
    verdicts = []
    for name, window, measure, comparison, limit, severity in rules:
        quiet = F.lit(None).cast("double") if measure == "latency_p95" else F.lit(0.0)
        value = F.when(F.col("w.silent"), quiet).otherwise(F.col(measure).cast("double"))
        fires = (F.col("seconds") == lengths[window]) & _breaks(value, comparison, limit)
        verdicts.append(
            F.when(fires, F.struct(F.lit(name).alias("alert"), F.lit(severity).alias("severity"), value.alias("measured")))
        )
    fired = filled.withColumn("v", F.explode(F.filter(F.array(*verdicts), lambda v: v.isNotNull())))
    return fired.select("v.alert", "v.severity", F.timestamp_seconds("w.start").alias("window_start"), "v.measured")


def latest(assets: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """The newest timestamp of each asset, NULL for an empty one."""
    out = None
    for name, (df, ts) in assets.items():
        row = df.agg(F.max(ts).alias("last_seen")).select(F.lit(name).alias("asset"), "last_seen")
        out = row if out is None else out.unionByName(row)
    return out


def freshness(last_seen: DataFrame, now: datetime | str, hours: int = ASSET_SLA_HOURS) -> DataFrame:
    """Age of each asset, and whether it breaches the SLA; an asset never written breaches."""
    age = (F.unix_micros(ts_literal(now)) - F.unix_micros("last_seen")).cast("double") / F.lit(3600e6)
    return last_seen.withColumn("lag_hours", age).withColumn("breached", F.coalesce(F.col("lag_hours") > hours, F.lit(True)))


def layer_freshness(spark: SparkSession, last_seen: DataFrame, now: datetime | str) -> DataFrame:
    """Layers (``asset``, ``last_seen``) older than their limits, one row per limit broken."""
    limits = spark.createDataFrame(FRESHNESS_LIMITS, "asset string, limit_seconds int, severity string")
    age = (F.unix_micros(ts_literal(now)) - F.unix_micros("last_seen")).cast("double") / F.lit(1e6)
    return (
        last_seen.join(limits, "asset")
        .withColumn("age_seconds", age)
        .filter(F.col("age_seconds").isNull() | (F.col("age_seconds") > F.col("limit_seconds")))
    )
