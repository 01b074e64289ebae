"""Market analytics: overview, movers, rotation, trader profiles, volume screens and alert queries."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapelake.functions import fixedpoint as fp
from tapelake.functions.rows import first_rows
from tapelake.functions.timing import as_date, on_days, ts_literal
from tapelake.operators.gold import aggregates, ohlcv
from tapelake.operators.selection import with_change

# Fixed values of the reports.
TOP_LIST = 5
SMA_DAYS = (20, 50)
RSI_DAYS = 14
LOOKBACK_DAYS = 20


def days_before(day: date | str, days: int) -> date:
    return as_date(day) - timedelta(days=days)


def market_totals(gold: DataFrame, day: date | str) -> DataFrame:
    """One row of totals and breadth; zeros when nothing traded. Unchanged symbols count on their own here."""
    change = F.col("close_price") - F.col("open_price")
    zero = F.lit(0)
    return gold.filter(F.col("trading_date") == as_date(day)).agg(
        F.lit(as_date(day)).alias("trading_date"),
        F.coalesce(F.sum(F.col("trade_count").cast("bigint")), zero).alias("total_trades"),
        F.coalesce(F.sum("total_volume"), zero).alias("total_volume"),
        F.coalesce(fp.money_sum(fp.ticks("total_value")), F.lit(0.0)).alias("total_value"),
        F.count_distinct("symbol").alias("unique_symbols"),
        F.count_if(change > 0).alias("advancing"),
        F.count_if(change < 0).alias("declining"),
        F.count_if(change == 0).alias("unchanged"),
    )


def top_lists(gold: DataFrame, n: int = TOP_LIST) -> DataFrame:
    """Top gainers, losers (worst first) and most active symbols of every day, ranked."""
    lists = {
        "top_gainers": F.desc("price_change_pct"),
        "top_losers": F.asc("price_change_pct"),
        "most_active": F.desc("total_volume"),
    }
    # One shuffle by day serves the three rankings; a day has as many rows as symbols.
    ranks = {f"_{name}": F.row_number().over(Window.partitionBy("trading_date").orderBy(order, "symbol"))
             for name, order in lists.items()}
    entries = F.array(*[F.struct(F.lit(name).alias("list_name"), F.col(f"_{name}").alias("rank")) for name in lists])
    return (
        with_change(gold)
        .withColumns(ranks)
        .withColumn("entry", F.explode(F.filter(entries, lambda e: e["rank"] <= n)))
        .select("trading_date", "entry.list_name", "entry.rank", "symbol", "price_change_pct", "total_volume")
    )


def market_overview(gold: DataFrame, day: date | str, n: int = TOP_LIST) -> DataFrame:
    """The day's totals with its three top lists as arrays of symbols."""
    on_day = gold.filter(F.col("trading_date") == as_date(day))

    def members(name: str) -> Column:
        # At most n members, already cut before this aggregate.
        rows = F.sort_array(F.collect_list(F.when(F.col("list_name") == name, F.struct("rank", "symbol"))))
        return F.transform(rows, lambda v: v["symbol"]).alias(name)

    lists = top_lists(on_day, n).agg(members("top_gainers"), members("top_losers"), members("most_active"))
    return market_totals(gold, day).crossJoin(lists)


def daily_market_summary(enriched: DataFrame, day: date | str, limit: int | None = None) -> DataFrame:
    """End-of-day report: each symbol's bar beside market totals. A close equal to the open counts as an advance."""
    bars = (
        enriched.filter(on_days("traded_at", day, day))
        .groupBy("symbol")
        .agg(*aggregates(ohlcv("traded_at")), fp.notional_total().alias("value_ticks"))
    )
    change = F.col("close_price") - F.col("open_price")
    bars = bars.withColumns(
        {
            "price_change": change,
            "pct_change": F.when(
                F.col("open_price") > 0, fp.round_half_up(change / F.nullif(F.col("open_price"), F.lit(0.0)) * F.lit(100.0), 2)
            ).otherwise(0.0),
            "direction": F.when(F.col("close_price") >= F.col("open_price"), "ADVANCE").otherwise("DECLINE"),
        }
    )
    advance = F.col("direction") == "ADVANCE"
    # One row, joined to every symbol.
    totals = bars.agg(
        F.count(F.lit(1)).alias("total_symbols"),
        F.sum("total_volume").alias("market_volume"),
        fp.round_half_up(fp.from_ticks(F.sum("value_ticks")), 2).alias("market_value"),
        F.sum("trade_count").alias("market_trades"),
        F.count_if(advance).alias("advances"),
        F.count_if(~advance).alias("declines"),
    )
    ratio = F.col("advances").cast("double") / F.nullif(F.col("declines"), F.lit(0)).cast("double")
    return (
        bars.crossJoin(totals)
        .orderBy(F.abs("pct_change").desc(), "symbol")
        .transform(first_rows, limit)
        .select(
            "symbol",
            "open_price",
            "close_price",
            F.col("low_price").alias("day_low"),
            F.col("high_price").alias("day_high"),
            "price_change",
            "pct_change",
            "direction",
            "total_volume",
            fp.round_half_up(fp.from_ticks(F.col("value_ticks")), 2).alias("total_value"),
            "trade_count",
            "total_symbols",
            "market_volume",
            "market_value",
            "market_trades",
            "advances",
            "declines",
            fp.round_half_up(ratio, 2).alias("advance_decline_ratio"),
        )
    )


def _by_symbol(preceding: int, following: int = 0):
    return Window.partitionBy("symbol").orderBy("trade_date").rowsBetween(preceding, following)


def with_sma(daily: DataFrame, days: tuple[int, ...] = SMA_DAYS) -> DataFrame:
    """Simple moving averages of the close; shorter histories average what they have."""
    return daily.withColumns({f"sma_{n}": fp.price_mean("close", over=_by_symbol(1 - n)) for n in days})


def with_change_lag(daily: DataFrame) -> DataFrame:
    """Change of the close against the day before; NULL on the first day."""
    along = Window.partitionBy("symbol").orderBy("trade_date")
    return daily.withColumn("price_change", F.col("close") - F.lag("close").over(along))


def with_rsi(daily: DataFrame, days: int = RSI_DAYS) -> DataFrame:
    """RSI from simple averages of gains and losses; NULL while there is no loss. The first change counts as zero."""
    along = Window.partitionBy("symbol").orderBy("trade_date")
    move = fp.ticks("close") - F.lag(fp.ticks("close")).over(along)
    rows = daily.withColumn("_move", F.coalesce(move, F.lit(0)))
    frame = _by_symbol(1 - days)
    gain = F.sum(F.greatest(F.col("_move"), F.lit(0))).over(frame).cast("double")
    loss = F.sum(F.greatest(-F.col("_move"), F.lit(0))).over(frame).cast("double")
    strength = gain / F.nullif(loss, F.lit(0.0))
    return rows.withColumn(f"rsi_{days}", F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + strength)).drop("_move")


def ohlcv_technicals(daily: DataFrame, as_of: date | str, symbol: str | None = None, days: int = 180) -> DataFrame:
    """Daily bars with SMA-20, SMA-50 and RSI-14, newest first."""
    if symbol is not None:
        daily = daily.filter(F.col("symbol") == symbol)
    rows = with_rsi(with_sma(daily.filter(F.col("trade_date") >= days_before(as_of, days))))
    return rows.select(
        "trade_date", "symbol", "open_price", "high", "low", "close", F.col("total_volume").alias("volume"), "vwap",
        fp.round_half_up("sma_20", 2).alias("sma_20"), fp.round_half_up("sma_50", 2).alias("sma_50"), fp.round_half_up("rsi_14", 2).alias("rsi_14"),
    ).orderBy(F.desc("trade_date"), "symbol")


def sector_rotation(daily: DataFrame, symbols: DataFrame, as_of: date | str, days: int = 90) -> DataFrame:
    """Weekly flows per sector: value of rising and falling symbol-days, signed count times mean volume, mean return."""
    rows = daily.filter(F.col("trade_date") >= days_before(as_of, days)).join(symbols.select("symbol", "sector"), "symbol")
    change = F.col("change_pct")
    value = fp.ticks("total_value_traded")
    sign = F.when(change > 0, 1).when(change < 0, -1).otherwise(0).cast("bigint")
    return (
        rows.groupBy(F.date_trunc("week", "trade_date").alias("week"), "sector")
        .agg(
            fp.money_sum(F.when(change > 0, value).otherwise(0)).alias("net_inflow"),
            fp.money_sum(F.when(change < 0, value).otherwise(0)).alias("net_outflow"),
            (F.sum(sign).cast("double") * F.avg("total_volume")).alias("net_volume_flow"),
            F.count_distinct("symbol").alias("active_symbols"),
            fp.round_half_up(fp.price_mean(change), 2).alias("avg_return_pct"),
        )
        .orderBy(F.desc("week"), F.desc("net_volume_flow"), "sector")
    )


def trader_profile(enriched: DataFrame, account_id: str, first: date | str, last: date | str) -> DataFrame:
    """One account's activity in a period: totals, spread, top symbol by value, busiest hour."""
    mine = enriched.filter(
        (F.col("account_id") == account_id) & F.col("trade_date").between(as_date(first), as_date(last))
    )
    # The trades are read once; everything else looks at one row per symbol, day and hour of the account.
    cells = mine.groupBy("symbol", "trade_date", "trade_hour").agg(
        F.count(F.lit(1)).alias("n"), fp.notional_total().alias("value")
    )
    by_symbol = F.sum("value").over(Window.partitionBy("symbol"))
    by_hour = F.sum("n").over(Window.partitionBy("trade_hour"))
    # Ties: the first symbol by name, the earliest hour.
    return cells.withColumns({"_symbol_value": by_symbol, "_hour_n": by_hour}).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_trades"),
        fp.from_ticks(F.sum("value")).alias("total_value"),
        F.count_distinct("symbol").alias("unique_symbols"),
        F.count_distinct("trade_date").alias("active_days"),
        F.min_by("symbol", F.struct(-F.col("_symbol_value"), F.col("symbol"))).alias("top_symbol"),
        F.min_by("trade_hour", F.struct(-F.col("_hour_n"), F.col("trade_hour"))).alias("most_active_hour"),
    )


def with_prior_volume(daily: DataFrame, days: int = LOOKBACK_DAYS, volume: str = "total_volume") -> DataFrame:
    """Mean and deviation of the volume of the ``days`` rows before each day, that day excluded."""
    frame = _by_symbol(-days, -1)
    return daily.withColumns(
        {"avg_volume": F.avg(volume).over(frame), "stddev_volume": fp.sample_stddev(volume, over=frame)}
    )


def unusual_volume(
    daily: DataFrame, symbols: DataFrame, factor: float = 2.0, days: int = 30, as_of: date | str | None = None
) -> DataFrame:
    """Symbols whose volume on the last day passed ``factor`` times their prior 20-day mean."""
    last_day = daily.agg(F.max("trade_date").alias("_last"))
    if as_of is not None:
        daily = daily.filter(F.col("trade_date") >= days_before(as_of, days))
    volume, mean = F.col("total_volume").cast("double"), F.col("avg_volume")
    return (
        with_prior_volume(daily)
        .crossJoin(last_day)
        .filter((F.col("trade_date") == F.col("_last")) & (volume > F.lit(factor) * mean))
        .join(symbols.select("symbol", "sector"), "symbol")
        .select(
            "symbol",
            "sector",
            "trade_date",
            F.col("total_volume").alias("volume"),
            fp.round_half_up(mean).alias("avg_vol_20d"),
            fp.round_half_up(volume / F.nullif(mean, F.lit(0.0)), 2).alias("volume_ratio"),
            fp.round_half_up((volume - mean) / F.nullif(F.col("stddev_volume"), F.lit(0.0)), 2).alias("z_score"),
        )
        .orderBy(F.desc("volume_ratio"), "symbol")
    )


def high_volume_alert(daily: DataFrame, day: date | str, factor: float = 3.0, limit: int | None = None) -> DataFrame:
    """Symbols trading over ``factor`` times their prior mean on ``day``; the mean is taken before the day is chosen."""
    volume, mean = F.col("total_volume").cast("double"), F.col("avg_volume")
    return (
        with_prior_volume(daily)
        .filter((F.col("trade_date") == as_date(day)) & (volume > F.lit(factor) * mean))
        .select(
            "symbol",
            F.col("total_volume").alias("volume"),
            mean.alias("avg_volume_20d"),
            fp.round_half_up(volume / F.nullif(mean, F.lit(0.0)), 2).alias("volume_ratio"),
        )
        .orderBy(F.desc("volume_ratio"), "symbol")
        .transform(first_rows, limit)
    )


def stale_gold_alert(daily: DataFrame, now: datetime | str, minutes: int = 30) -> DataFrame:
    """The latest day and its age when older than ``minutes``, otherwise no row."""
    lag = F.unix_micros(ts_literal(now)) - F.unix_micros(F.col("latest_date").cast("timestamp"))
    return (
        daily.agg(F.max("trade_date").alias("latest_date"))
        .withColumn("minutes_stale", lag.cast("double") / F.lit(60e6))
        .filter(F.col("minutes_stale") > minutes)
    )


def stale_symbols(enriched: DataFrame, cutoff: date | str) -> DataFrame:
    """Symbols whose latest trade is before the cutoff."""
    return enriched.groupBy("symbol").agg(F.max("trade_date").alias("latest")).filter(F.col("latest") < as_date(cutoff))


def volume_zscores(daily: DataFrame, days: int = 6, limit: int | None = None) -> DataFrame:
    """Largest volume z-scores against the prior ``days`` rows; no deviation gives 0."""
    frame = _by_symbol(-days, -1)
    rows = daily.withColumns(
        {"avg_vol": F.avg("total_volume").over(frame), "std_vol": fp.sample_stddev("total_volume", over=frame)}
    ).filter("avg_vol IS NOT NULL")
    deviation = F.col("total_volume").cast("double") - F.col("avg_vol")
    score = F.when(F.col("std_vol") > 0, deviation / F.nullif(F.col("std_vol"), F.lit(0.0))).otherwise(0.0)
    return (
        rows.select("symbol", "trade_date", F.col("total_volume").alias("daily_volume"), "avg_vol", score.alias("z_score"))
        .orderBy(F.desc_nulls_last("z_score"), "symbol", "trade_date")
        .transform(first_rows, limit)
    )


def market_kpi(gold: DataFrame) -> DataFrame:
    """Whole-table KPIs; ties count as advances."""
    return gold.agg(
        F.sum("total_volume").alias("market_volume"),
        fp.round_half_up(fp.money_sum(fp.ticks("total_value")), 2).alias("market_value"),
        F.sum(F.col("trade_count").cast("bigint")).alias("total_trades"),
        F.count_distinct("symbol").alias("active_symbols"),
        F.count_if(F.col("close_price") >= F.col("open_price")).alias("advances"),
        F.count_if(F.col("close_price") < F.col("open_price")).alias("declines"),
    )


def sector_flow(trades: DataFrame) -> DataFrame:
    """Value, volume, count, and buy- and sell-initiated quantity per sector."""
    quantity, buy = F.col("quantity").cast("bigint"), F.col("is_aggressive_buy")
    return trades.groupBy("sector").agg(
        fp.notional_sum().alias("total_value"),
        fp.quantity_sum().alias("total_volume"),
        F.count(F.lit(1)).alias("trade_count"),
        F.sum(F.when(buy, quantity).otherwise(0)).alias("buy_qty"),
        F.sum(F.when(~buy, quantity).otherwise(0)).alias("sell_qty"),
    )


def agent_profiles(trades: DataFrame, limit: int | None = None) -> DataFrame:
    """The busiest buyers with their totals and first and last day."""
    return (
        trades.groupBy(F.col("buyer_agent_id").alias("agent_id"))
        .agg(
            F.count(F.lit(1)).alias("trade_count"),
            fp.quantity_sum().alias("total_qty"),
            fp.notional_sum().alias("total_value"),
            F.count_distinct("symbol").alias("symbols_traded"),
            F.to_date(F.min("timestamp")).alias("first_trade"),
            F.to_date(F.max("timestamp")).alias("last_trade"),
        )
        .orderBy(F.desc("trade_count"), "agent_id")
        .transform(first_rows, limit)
    )


def vwap_by_symbol(trades: DataFrame) -> DataFrame:
    """VWAP (0 without volume), volume, count and price range per symbol."""
    return trades.groupBy("symbol").agg(
        F.coalesce(fp.vwap(), F.lit(0.0)).alias("vwap"),
        fp.quantity_sum().alias("total_volume"),
        F.count(F.lit(1)).alias("trade_count"),
        F.min("price").alias("low_price"),
        F.max("price").alias("high_price"),
    )


def ohlcv_by_symbol(trades: DataFrame) -> DataFrame:
    """One bar per symbol over all trades."""
    return trades.groupBy("symbol").agg(*aggregates(ohlcv()))


def sector_totals(trades: DataFrame) -> DataFrame:
    return trades.groupBy("sector").agg(
        F.count_distinct("symbol").alias("symbol_count"),
        fp.quantity_sum().alias("total_volume"),
        fp.notional_sum().alias("total_value"),
    )


def open_close_by_day(enriched: DataFrame) -> DataFrame:
    """First and last price of every symbol and day: one row each, without ranking the trades."""
    order = F.struct("traded_at", "trade_id")
    return enriched.groupBy("symbol", "trade_date").agg(
        F.min_by("price", order).alias("open_price"), F.max_by("price", order).alias("close_price")
    )


def sector_volume_stats(sector_daily: DataFrame) -> DataFrame:
    """Each sector-day beside its sector's mean and deviation of volume."""
    sector = Window.partitionBy("sector")
    return sector_daily.select(
        "trade_date",
        "sector",
        "total_volume",
        F.avg("total_volume").over(sector).alias("sector_avg"),
        fp.sample_stddev("total_volume", over=sector).alias("sector_std"),
    )


def reconcile(rollup: DataFrame, detail: DataFrame, keys: list[str], value: str, detail_value: str, tolerance: float) -> DataFrame:
    """Roll-up rows that differ from the sum of their detail by more than ``tolerance``."""
    expected = detail.groupBy(*keys).agg(fp.money_sum(fp.ticks(F.col(detail_value).cast("double"))).alias("expected"))
    gap = F.abs(F.col(value).cast("double") - F.col("expected"))
    return rollup.select(*keys, value).join(expected, keys).withColumn("gap", gap).filter(F.col("gap") > tolerance)
