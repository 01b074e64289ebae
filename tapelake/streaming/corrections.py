"""Tumbling windows that close on time and are corrected when late trades come.

A batch is folded into one partial row per symbol and window, and these are added to the partial rows of the windows that
may still change. A window whose end the clock has passed is put out with version 1; trades for it that come later take its
row back and put out the sum with the next version. The clock is the newest event time seen less ``delay``.

The windows that may still change, those of the last ``lateness``, are the state. Each batch writes it whole into one of
two slots and reads the other, which the batch before it wrote, so a replayed batch starts from what it saw first, and
state grows with symbols and lateness, not with the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapelake.functions import fixedpoint as fp
from tapelake.functions.timing import SUBDAY_INTERVALS, interval_seconds
from tapelake.streaming.aggregates import WATERMARK
from tapelake.streaming.pipelines import CHECKPOINT_INTERVAL, _batch_folder, with_trigger

_SUMS = "n bigint, volume bigint, value decimal(38,0), high double, low double"
STATE = f"symbol string, start bigint, {_SUMS}, version int"
CHANGES = (
    "symbol string, window_start timestamp, window_end timestamp, window_size string, trade_count bigint, "
    "total_volume bigint, vwap double, high_price double, low_price double, version int, change string, batch_id bigint"
)


def _micros(interval: str) -> int:
    return interval_seconds(interval) * 1_000_000


def fold_batch(
    batch: DataFrame, batch_id: int, size: str, changes: str, too_late: str, state: str, delay: str, lateness: str
) -> None:
    """Fold one batch of ``(symbol, price, quantity, event_time)`` into the state and write what it changes.

    Batches must be numbered without gaps from 0. Rows without an event time take no part; rows of windows that ended over
    ``lateness`` before the clock go to ``too_late`` as they are. A null symbol is a symbol of its own.
    """
    spark = batch.sparkSession
    mine, other = batch_id % 2, (batch_id + 1) % 2
    width, slack = _micros(SUBDAY_INTERVALS[size]), _micros(lateness)
    batch.persist()
    try:
        seen, held = None, spark.createDataFrame([], STATE)
        if batch_id > 0:
            seen = spark.read.schema("newest bigint").parquet(f"{state}/newest/{other}").first().newest
            held = spark.read.schema(STATE).parquet(f"{state}/windows/{other}")
        own = batch.agg(F.max(F.unix_micros("event_time"))).first()[0]
        newest = max((t for t in (seen, own) if t is not None), default=None)
        if newest is None:  # nothing with a time so far
            fixed_before = clock = F.lit(None).cast("bigint")
        else:
            fixed_before = F.lit(None if seen is None else seen - _micros(delay) - slack).cast("bigint")
            clock = F.lit(newest - _micros(delay))

        start = F.unix_micros("event_time") - F.pmod(F.unix_micros("event_time"), F.lit(width))
        timed = batch.filter("event_time IS NOT NULL").withColumn("_start", start)
        fixed = F.coalesce(F.col("_start") + width <= fixed_before, F.lit(False))
        timed.filter(fixed).drop("_start").write.mode("overwrite").parquet(_batch_folder(too_late, batch_id))
        fresh = timed.filter(~fixed).groupBy("symbol", F.col("_start").alias("start")).agg(
            F.count(F.lit(1)).alias("n"),
            fp.quantity_sum().alias("volume"),
            fp.notional_total().cast("decimal(38,0)").alias("value"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
        )
        sums = F.struct("n", "volume", "value", "high", "low")
        both = held.withColumn("old", sums).unionByName(fresh.withColumn("version", F.lit(0)), allowMissingColumns=True)
        merged = (
            both.groupBy("symbol", "start")
            .agg(
                F.sum("n").alias("n"),
                F.sum("volume").alias("volume"),
                F.sum("value").cast("decimal(38,0)").alias("value"),
                F.max("high").alias("high"),
                F.min("low").alias("low"),
                F.max("version").alias("before"),
                F.max("old").alias("old"),
                F.max(F.col("old").isNull()).alias("touched"),
            )
            .withColumn("closed", F.coalesce(F.col("start") + width <= clock, F.lit(False)))
            .withColumn("out", F.col("closed") & (F.col("touched") | (F.col("before") == 0)))
            .withColumn("version", F.col("before") + F.col("out").cast("int"))
            .persist()
        )
        try:
            retracted = F.struct("old.*", F.col("before").alias("version"), F.lit("retract").alias("change"))
            added = F.struct("n", "volume", "value", "high", "low", "version", F.lit("add").alias("change"))
            rows = F.array(F.when(F.col("out") & (F.col("before") > 0), retracted), F.when(F.col("out"), added))
            put_out = merged.select("symbol", "start", F.explode(rows).alias("r")).filter("r IS NOT NULL")
            put_out.select(
                "symbol",
                F.timestamp_micros("start").alias("window_start"),
                F.timestamp_micros(F.col("start") + width).alias("window_end"),
                F.lit(size).alias("window_size"),
                F.col("r.n").alias("trade_count"),
                F.col("r.volume").alias("total_volume"),
                fp.vwap_from("r.value", "r.volume").alias("vwap"),
                F.col("r.high").alias("high_price"),
                F.col("r.low").alias("low_price"),
                "r.version",
                "r.change",
            ).write.mode("overwrite").parquet(_batch_folder(changes, batch_id))
            kept = merged.filter(~F.coalesce(F.col("start") + width <= clock - slack, F.lit(False)))
            names = [part.split()[0] for part in STATE.split(", ")]
            kept.select(*names).write.mode("overwrite").parquet(f"{state}/windows/{mine}")
        finally:
            merged.unpersist()
        known = spark.createDataFrame([(newest,)], "newest bigint")
        known.write.mode("overwrite").parquet(f"{state}/newest/{mine}")
    finally:
        batch.unpersist()


def corrected_windows(
    stream: DataFrame,
    size: str,
    changes: str,
    too_late: str,
    state: str,
    checkpoint: str,
    delay: str = WATERMARK,
    lateness: str = "1 day",
    interval: str | None = CHECKPOINT_INTERVAL,
) -> StreamingQuery:
    """Windows of ``size`` over a stream of ``(symbol, price, quantity, event_time)`` as a table of changes, each batch's
    in a folder of its own, which a replay replaces."""

    def write(batch: DataFrame, batch_id: int) -> None:
        fold_batch(batch, batch_id, size, changes, too_late, state, delay, lateness)

    return with_trigger(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), interval).start()


def latest(changes: DataFrame) -> DataFrame:
    """Each window as the changes leave it."""
    rows = changes.filter("change = 'add'")
    keys = ["symbol", "window_start", "window_size"]
    values = [c for c in rows.columns if c not in (*keys, "change", "batch_id")]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "version").alias("r"))
    return best.select(*keys, "r.*")
