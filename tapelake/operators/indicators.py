"""Recursive indicators over candles."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapelake.operators.running import Running, with_running

# The usual MACD periods.
FAST, SLOW, SIGNAL = 12, 26, 9


class SeededEma:
    """Exponential mean seeded by the simple mean of its first ``period`` values; None until then."""

    def __init__(self, period: int):
        self.period, self.weight = period, 2 / (period + 1)
        self.seen, self.total, self.value = 0, 0.0, None

    def add(self, x: float) -> float | None:
        if self.value is not None:
            self.value = (x - self.value) * self.weight + self.value
        else:
            self.seen += 1
            self.total += x
            if self.seen == self.period:
                self.value = self.total / self.period
        return self.value


#: A mean that forgets fastest keeps this share of its past over a block; what is left below the second is not looked up.
OVER_BLOCK, LEAST = 1e-8, 1e-32


def _composed(over: float) -> Callable[[Column, Column], Column]:
    """The mean after one more block: what it keeps over the block, and the block's own part."""
    return lambda mean, end: mean * over + end


def with_seeded_means(rows: DataFrame, n: str, value: str, periods: dict[str, int]) -> DataFrame:
    """Add exponential means of ``value``, each seeded by the simple mean of its first ``period`` values; NULL until then.

    ``n`` numbers the rows of a symbol from 1. Such a mean is a linear recurrence, so a block of rows is an affine map (a, b) of
    the mean it starts with, where a is what the mean keeps over the block. Blocks find their b by themselves, in a running
    sum of weighted values; maps of the blocks before compose into the mean a block starts with; and each row adds what is
    left of that, and of the seed. Blocks so far back that less than 1e-32 of them is left, far below what a double
    can hold, are not looked up. No task reads more of a symbol than its block ends.
    """
    kept = {name: 1 - 2 / (period + 1) for name, period in periods.items()}
    length = min((max(1, math.floor(math.log(OVER_BLOCK) / math.log(k))) for k in kept.values() if k > 0), default=1)
    at = F.col(n) - 1
    rows = rows.withColumn("_block", F.floor(at / F.lit(length))).withColumn("_place", F.pmod(at, F.lit(length)) + 1)
    here = Window.partitionBy("symbol", "_block").orderBy(n).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    along = Window.partitionBy("symbol").orderBy("_block")
    own, ends, starts, means = {}, [], [], {}
    for name, period in periods.items():
        if not kept[name]:
            means[name] = F.col(value)
            continue
        left = F.pow(F.lit(kept[name]), F.col("_place"))
        weighted = F.when(F.col(n) > period, F.col(value) * F.lit(1 - kept[name]) / left)
        own[f"_own_{name}"] = F.coalesce(F.sum(weighted).over(here), F.lit(0.0)) * left
        ends += [
            F.max_by(f"_own_{name}", "_place").alias(f"_end_{name}"),
            F.sum(F.when(F.col(n) <= period, F.col(value))).alias(f"_first_{name}"),
        ]
        over = kept[name] ** length
        back = math.ceil(math.log(LEAST) / math.log(over))
        before = F.collect_list(f"_end_{name}").over(along.rowsBetween(-back, -1))
        starts += [
            F.aggregate(before, F.lit(0.0), _composed(over)).alias(f"_start_{name}"),
            (F.sum(f"_first_{name}").over(Window.partitionBy("symbol")) / period).alias(f"_seed_{name}"),
        ]
        seeded = F.pow(F.lit(kept[name]), F.col(n) - period) * F.col(f"_seed_{name}")
        means[name] = F.when(F.col(n) >= period, left * F.col(f"_start_{name}") + F.col(f"_own_{name}") + seeded)
    if own:
        rows = rows.withColumns(own)
        lasts = rows.groupBy("symbol", "_block").agg(*ends).select("symbol", "_block", *starts)
        rows = rows.join(lasts, ["symbol", "_block"])
    helpers = [f"_{part}_{name}" for part in ("own", "start", "seed") for name in periods]
    return rows.withColumns(means).drop("_block", "_place", *helpers)


def macd(candles: DataFrame, fast: int = FAST, slow: int = SLOW, signal: int = SIGNAL, chunk: str = "month") -> DataFrame:
    """MACD, signal and histogram per symbol and candle, from the first candle at which the signal exists.

    Candles are numbered by counting them per ``chunk`` of the calendar, and the three means are scans over blocks,
    the first two in one pass.
    """
    rows = candles.select("symbol", "bucket_ts", "close_price")
    rows = with_running(rows, ["symbol"], F.date_trunc(chunk, "bucket_ts"), ["bucket_ts"], {"n": Running("count", F.lit(1))})
    rows = with_seeded_means(rows, "n", "close_price", {"fast": fast, "slow": slow})
    line = F.col("fast") - F.col("slow")
    rows = rows.filter("fast is not null and slow is not null").select(
        "symbol", "bucket_ts", (F.col("n") - max(fast, slow) + 1).alias("n"), line.alias("macd")
    )
    rows = with_seeded_means(rows, "n", "macd", {"signal": signal}).filter("signal is not null")
    return rows.select("symbol", "bucket_ts", "macd", "signal", (F.col("macd") - F.col("signal")).alias("histogram"))
