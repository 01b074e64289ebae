"""Filters, lookups, derived columns, top lists and pages over trades, bars and books."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.functions.rows import first_rows
from tapelake.functions import fixedpoint as fp
from tapelake.functions.timing import as_date, on_days
from tapelake.operators.silver import first_per_key

# Fixed value of the block-trade filter; the lower size bounds are this repository's own.
BLOCK_SHARES = 500
MEDIUM_SHARES = 50
LARGE_SHARES = 200


@dataclass(frozen=True)
class TradeFilter:
    """Optional conditions on trades, all of which must hold."""

    symbol: str | None = None
    symbols: list[str] = field(default_factory=list)
    is_aggressive_buy: bool | None = None
    min_price: float | None = None
    max_price: float | None = None
    min_quantity: int | None = None
    max_quantity: int | None = None
    first_day: date | str | None = None
    last_day: date | str | None = None

    def predicates(self) -> list[Column]:
        price, quantity = F.col("price"), F.col("quantity")
        out = []
        if self.symbol:
            out.append(F.col("symbol") == self.symbol)
        if self.symbols:
            out.append(F.col("symbol").isin(*self.symbols))
        if self.is_aggressive_buy is not None:
            out.append(F.col("is_aggressive_buy") == self.is_aggressive_buy)
        if self.min_price is not None:
            out.append(price >= self.min_price)
        if self.max_price is not None:
            out.append(price <= self.max_price)
        if self.min_quantity is not None:
            out.append(quantity >= self.min_quantity)
        if self.max_quantity is not None:
            out.append(quantity <= self.max_quantity)
        if self.first_day is not None and self.last_day is not None:
            out.append(on_days("timestamp", self.first_day, self.last_day))
        return out


def filter_trades(trades: DataFrame, wanted: TradeFilter) -> DataFrame:
    return reduce(lambda df, predicate: df.filter(predicate), wanted.predicates(), trades)


def trade_by_id(trades: DataFrame, trade_id: str) -> DataFrame:
    return trades.filter(F.col("trade_id") == trade_id).limit(1)


def newest_trades(trades: DataFrame, symbol: str, limit: int | None = None) -> DataFrame:
    return first_rows(trades.filter(F.col("symbol") == symbol).orderBy(F.desc("timestamp"), F.desc("trade_id")), limit)


def filter_symbols(
    dim_symbol: DataFrame,
    is_current: bool = True,
    sector: str | None = None,
    market_cap_category: str | None = None,
    search: str | None = None,
) -> DataFrame:
    """Dimension rows by flag, sector, cap, and text found in symbol or company, whatever the case."""
    out = dim_symbol.filter(F.col("is_current") == is_current)
    if sector:
        out = out.filter(F.col("sector") == sector)
    if market_cap_category:
        out = out.filter(F.col("market_cap_category") == market_cap_category)
    if search:
        pattern = f"%{search}%"
        out = out.filter(F.col("symbol").ilike(pattern) | F.col("company_name").ilike(pattern))
    return out.select("symbol", "company_name", "sector", "market_cap_category", "is_current").orderBy("symbol")


def lookup_symbols(dim_symbol: DataFrame, keys: DataFrame) -> DataFrame:
    """Current rows for requested keys (``ordinal``, ``symbol``), NULL where unknown, in request order."""
    current = dim_symbol.filter("is_current").select("symbol", "company_name", "sector", "market_cap_category")
    return keys.join(current, "symbol", "left").orderBy("ordinal")


def watchlist(keys: DataFrame, daily: DataFrame, day: date | str) -> DataFrame:
    """Watched symbols (``ordinal``, ``symbol``) with the day's close and change, NULL when they did not trade."""
    bars = daily.filter(F.col("trade_date") == as_date(day)).select("symbol", "close", "change_pct")
    return keys.join(bars, "symbol", "left").orderBy("ordinal")


def daily_summary_range(gold: DataFrame, symbol: str, first: date | str, last: date | str) -> DataFrame:
    days = F.col("trading_date").between(as_date(first), as_date(last))
    return gold.filter((F.col("symbol") == symbol) & days).orderBy(F.desc("trading_date"))


def with_change(gold: DataFrame) -> DataFrame:
    """Adds range, change and percentage change; a zero open gives 0."""
    change = F.col("close_price") - F.col("open_price")
    return gold.withColumns(
        {
            "price_range": F.col("high_price") - F.col("low_price"),
            "price_change": change,
            "price_change_pct": F.when(F.col("open_price") == 0, F.lit(0.0)).otherwise(
                change / F.nullif(F.col("open_price"), F.lit(0.0)) * F.lit(100.0)
            ),
        }
    )


def change_pct_4dp(gold: DataFrame) -> DataFrame:
    change = (F.col("close_price") - F.col("open_price")) / F.nullif(F.col("open_price"), F.lit(0.0)) * F.lit(100.0)
    return gold.withColumn("change_pct", fp.round_half_up(change, 4))


def bid_ask_view(trades: DataFrame) -> DataFrame:
    """Trades with their side and size bucket."""
    quantity = F.col("quantity")
    size = (
        F.when(quantity < MEDIUM_SHARES, "small")
        .when(quantity < LARGE_SHARES, "medium")
        .when(quantity < BLOCK_SHARES, "large")
        .otherwise("block")
    )
    return trades.withColumns({"side": F.when(F.col("is_aggressive_buy"), "buy").otherwise("sell"), "size_bucket": size})


def block_trades(bid_ask: DataFrame, limit: int | None = None) -> DataFrame:
    """Block trades, largest first."""
    return (
        bid_ask.filter(F.col("quantity") >= BLOCK_SHARES)
        .orderBy(F.desc("quantity"), "timestamp", "trade_id")
        .transform(first_rows, limit)
        .select("timestamp", "symbol", "side", "price", "quantity")
    )


def latest_book(books: DataFrame, symbol: str | None = None) -> DataFrame:
    """The newest snapshot of one symbol, or of every symbol."""
    if symbol is not None:
        return books.filter(F.col("symbol") == symbol).orderBy(F.desc("timestamp")).limit(1)
    return first_per_key(books, ["symbol"], [F.desc("timestamp")])


def book_spreads(books: DataFrame, symbol: str, limit: int | None = None) -> DataFrame:
    columns = ["symbol", "timestamp", "best_bid_price", "best_ask_price", "spread", "mid_price", "bid_depth", "ask_depth"]
    return first_rows(books.filter(F.col("symbol") == symbol).orderBy(F.desc("timestamp")), limit).select(*columns)


def top_notional(trades: DataFrame, limit: int = 10) -> DataFrame:
    """The trades with the largest price * quantity."""
    notional = fp.from_ticks(fp.notional_ticks())
    return (
        trades.select("trade_id", "symbol", "price", "quantity", notional.alias("notional"))
        .orderBy(F.desc("notional"), "trade_id")
        .limit(limit)
    )


def top_movers(gold: DataFrame, day: date | str, limit: int = 5) -> DataFrame:
    """The day's symbols by size of their move, up or down."""
    change = (F.col("close_price") - F.col("open_price")) / F.nullif(F.col("open_price"), F.lit(0.0)) * F.lit(100.0)
    return (
        gold.filter(F.col("trading_date") == as_date(day))
        .withColumn("pct_change", change)
        .orderBy(F.abs("pct_change").desc_nulls_last(), "symbol")
        .limit(limit)
        .select(
            "symbol", "company_name", "sector", "open_price", "close_price", "high_price", "low_price", "pct_change",
            "total_volume", "trade_count",
        )
    )


def page(df: DataFrame, order: list[Column | str], first: int = 20, offset: int = 0) -> DataFrame:
    """One page with its position, the total, and whether pages exist on either side.

    The total is a separate count: a window over everything would pull all rows into one task to show twenty.
    """
    total = df.agg(F.count(F.lit(1)).alias("total_count"))
    rows = df.orderBy(*order).offset(offset).limit(first)
    return rows.crossJoin(total).withColumns(
        {"has_next_page": F.col("total_count") > offset + first, "has_previous_page": F.lit(offset > 0)}
    )
