"""Running aggregates over groups too large for one task.

A window over a whole symbol would sort that symbol in one task. Here each group is cut into chunks along its order;
chunk totals are aggregated first, a small window carries them forward, and the running value inside a chunk is added
to what came before it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Running:
    """A running ``sum``, ``count``, ``max`` or ``min`` of a column, or the ``previous`` row's value of it."""

    kind: str
    column: Column


_AGGREGATE = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}


def with_running(
    df: DataFrame, keys: list[str], chunk: Column, order: list[Column | str], values: dict[str, Running]
) -> DataFrame:
    """Add running values along ``order`` within ``keys``.

    ``chunk`` must not decrease along ``order``, and neither keys nor chunk may be NULL. Rows meet their carried totals
    and the window on the same keys, so the rows are shuffled once.
    """
    rows = df.withColumn("_chunk", chunk)
    by_chunk = [*keys, "_chunk"]
    totals = []
    for name, value in values.items():
        if value.kind == "previous":
            totals.append(F.max_by(value.column, F.struct(*order)).alias(f"_total_{name}"))
        else:
            totals.append(_AGGREGATE[value.kind](value.column).alias(f"_total_{name}"))
    along = Window.partitionBy(*keys).orderBy("_chunk")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = []
    for name, value in values.items():
        total = F.col(f"_total_{name}")
        if value.kind == "previous":
            carry = F.lag(total).over(along)
        elif value.kind in ("sum", "count"):
            carry = F.sum(total).over(earlier)
        else:
            carry = _AGGREGATE[value.kind](total).over(earlier)
        carried.append(carry.alias(f"_carry_{name}"))
    carry = rows.groupBy(*by_chunk).agg(*totals).select(*by_chunk, *carried)
    inside = Window.partitionBy(*by_chunk).orderBy(*order)
    to_here = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = {}
    for name, value in values.items():
        before = F.col(f"_carry_{name}")
        if value.kind == "previous":
            out[name] = F.coalesce(F.lag(value.column).over(inside), before)
        elif value.kind in ("sum", "count"):
            out[name] = _AGGREGATE[value.kind](value.column).over(to_here) + F.coalesce(before, F.lit(0))
        elif value.kind == "max":
            out[name] = F.greatest(F.max(value.column).over(to_here), before)
        else:
            out[name] = F.least(F.min(value.column).over(to_here), before)
    return rows.join(carry, by_chunk).withColumns(out).drop("_chunk", *[f"_carry_{name}" for name in values])


def session_ticks(trades: DataFrame, chunk: str = "hour") -> DataFrame:
    """Per trade: running session high, low, volume and tick count, and the move against the previous trade."""
    rows = with_running(
        trades,
        ["symbol"],
        F.date_trunc(chunk, "timestamp"),
        ["timestamp", "trade_id"],
        {
            "session_high": Running("max", F.col("price")),
            "session_low": Running("min", F.col("price")),
            "session_volume": Running("sum", F.col("quantity").cast("bigint")),
            "tick_count": Running("count", F.lit(1)),
            "previous_price": Running("previous", F.col("price")),
        },
    )
    change = F.col("price") - F.col("previous_price")
    return rows.withColumns(
        {
            "price_change": change,
            "price_change_pct": change / F.nullif(F.col("previous_price"), F.lit(0.0)) * F.lit(100.0),
            "direction": F.when(change > 0, "up").when(change < 0, "down").otherwise("neutral"),
        }
    )


def cumulative_volume(per_bucket: DataFrame, bucket: str = "bucket_ts", volume: str = "volume") -> DataFrame:
    """Running volume over time buckets of the whole market, carried day by day."""
    return with_running(
        per_bucket,
        [],
        F.date_trunc("day", bucket),
        [bucket],
        {"cumulative_volume": Running("sum", F.col(volume))},
    )


def depth_curve(levels: DataFrame, keys: list[str], band: float = 1.0) -> DataFrame:
    """Cumulative quantity away from the touch: bids from the highest price down, asks from the lowest up.

    Prices are cut into bands, so a deep book is not sorted in one task. Equal prices follow their id.
    """
    away = F.when(F.col("side") == "BID", -F.col("price")).otherwise(F.col("price"))
    rows = levels.withColumn("_away", away)
    return with_running(
        rows,
        [*keys, "side"],
        F.floor(F.col("_away") / F.lit(band)),
        ["_away", "trade_id"],
        {"cumulative_quantity": Running("sum", F.col("quantity").cast("bigint"))},
    ).drop("_away")
