"""Cross-account surveillance: opposite-side trades of similar size, and accounts that trade together."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapelake.functions import fixedpoint as fp
from tapelake.functions.rows import first_rows
from tapelake.operators.market import days_before

# Fixed values of the saved query.
SIZE_TOLERANCE = "0.05"
MIN_PAIRS = 3


def _wide(x: Column) -> Column:
    return x.cast("decimal(38,0)")


def _side_histograms(enriched: DataFrame) -> DataFrame:
    """Trades, and the sum of their prices in ticks, per symbol, day, side and quantity."""
    return enriched.groupBy("symbol", "trade_date", "trade_type", "quantity").agg(
        F.count(F.lit(1)).alias("n"), fp.exact_sum(fp.ticks("price")).alias("price_ticks")
    )


def _signed_matches(enriched: DataFrame, tolerance: str) -> DataFrame:
    """For every buy size two rows whose signed ``sells`` add up to the sells of similar size.

    A sell of q2 matches a buy of q1 when |q1 - q2| < tolerance * q1, an open interval around q1, so its count is a
    difference of two running counts over the sell sizes. No pair is ever formed: both sides are histograms by
    size, and each buy size asks the running count at its two bounds.
    """
    q = F.col("quantity").cast("decimal(20,0)")
    width = q * F.lit(Decimal(tolerance))
    none = F.lit(0).cast("bigint")

    def mark(at: Column, sold: Column, sign: int) -> Column:
        return F.struct(at.cast("bigint").alias("at"), sold.alias("sold"), F.lit(sign).alias("sign"))

    sell = F.array(mark(F.col("quantity"), F.col("n"), 0))
    bounds = F.array(mark(F.ceil(q + width) - 1, none, 1), mark(F.floor(q - width), none, -1))
    # Sells and bounds come from one pass over the histogram, so the trades are read once.
    marks = _side_histograms(enriched).select(
        "symbol",
        "trade_date",
        "quantity",
        F.col("n").alias("buys"),
        _wide(F.col("price_ticks")).alias("price_ticks"),
        F.explode(F.when(F.col("trade_type") == "SELL", sell).otherwise(bounds)).alias("mark"),
    )
    # RANGE to the current value: sells of exactly the bound's size are counted whatever order the rows come in.
    up_to = Window.partitionBy("symbol", "trade_date").orderBy("mark.at").rangeBetween(Window.unboundedPreceding, 0)
    running = marks.withColumn("running", F.sum("mark.sold").over(up_to))
    return running.filter("mark.sign <> 0").withColumn("sells", F.col("running") * F.col("mark.sign"))


def opposite_side_matches(enriched: DataFrame, tolerance: str = SIZE_TOLERANCE) -> DataFrame:
    """Per symbol, day and buy size: the buys, and how many sells of similar size each of them meets."""
    return (
        _signed_matches(enriched, tolerance)
        .groupBy("symbol", "trade_date", "quantity")
        .agg(F.max("buys").alias("buys"), F.sum("sells").alias("matching_sells"))
    )


def wash_trades(
    enriched: DataFrame,
    as_of: date | str,
    days: int = 7,
    tolerance: str = SIZE_TOLERANCE,
    min_pairs: int = MIN_PAIRS,
    limit: int | None = None,
) -> DataFrame:
    """Symbols with many same-day opposite-side pairs of similar size: pairs, mean buy price, and buy quantity over pairs."""
    recent = enriched.filter(F.col("trade_date") >= days_before(as_of, days))
    sells = _wide(F.col("sells"))
    pairs = F.sum(_wide(F.col("buys")) * sells)
    return (
        _signed_matches(recent, tolerance)
        .groupBy("symbol")
        .agg(
            pairs.alias("pairs"),
            F.sum(F.col("price_ticks") * sells).alias("price_ticks"),
            F.sum(_wide(F.col("quantity").cast("bigint") * F.col("buys")) * sells).alias("qty"),
        )
        .filter(F.col("pairs") >= min_pairs)
        .select(
            "symbol",
            F.col("pairs").cast("bigint").alias("paired_trades"),
            (fp.from_ticks(F.col("price_ticks")) / F.col("pairs").cast("double")).alias("avg_price"),
            F.col("qty").cast("bigint").alias("total_qty"),
        )
        .orderBy(F.desc("paired_trades"), "symbol")
        .transform(first_rows, limit)
    )


# Cells a time width is cut into, trades of one account that are folded into a row, and folds of a side that meet at once.
CELLS = 2
FOLD = 64
MEET = 256


def account_folds(trades: DataFrame, width: int, keys: list[str], cells: int = CELLS, fold: int = FOLD) -> DataFrame:
    """``trades(symbol, side, account, quantity, us)`` folded by ``keys`` and time cell: ``n``, and the sorted ``times``.

    Cells are ``width / cells`` wide. An account with more than ``fold`` trades in a cell gets several rows.
    """
    rows = trades.withColumn("cell", F.expr(f"(us - pmod(us, {width // cells})) div {width // cells}"))
    by = [*keys, "cell"]
    # Counts combine before the shuffle; only the few crowded keys go on to cut their trades.
    crowded = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("many")).filter(F.col("many") > fold)
    parts = F.coalesce(F.ceil(F.col("many") / F.lit(fold)), F.lit(1))
    rows = rows.join(crowded, by, "left").withColumn("part", F.pmod(F.xxhash64("us", "trade_id"), parts))
    return rows.groupBy(*by, "part").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("us")).alias("times"))


def dealt_to_meet(buys: DataFrame, sells: DataFrame, meeting: list[str], most: int = MEET) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``x`` and ``y`` added to the columns they join on.

    Where a meeting has more than ``most`` rows of a side, that side is dealt into parts, and the other goes to each of
    them, so that no group of a join holds more than about ``most`` rows of either side. Meetings with one side only go.
    """
    sizes = buys.groupBy(*meeting).agg(F.count(F.lit(1)).alias("b")).join(sells.groupBy(*meeting).agg(F.count(F.lit(1)).alias("s")), meeting)
    parts = [F.ceil(F.col(c) / F.lit(most)).alias(c) for c in "bs"]
    crowded = sizes.filter((F.col("b") > most) | (F.col("s") > most)).select(*meeting, *parts)

    def deal(side: DataFrame, own: str, other: str, own_name: str, other_name: str) -> DataFrame:
        rows = side.join(crowded, meeting, "left")
        mine = F.pmod(F.xxhash64("account", "quantity", "cell", "part"), F.coalesce(own, F.lit(1))).cast("bigint")
        every = F.sequence(F.lit(0).cast("bigint"), F.coalesce(other, F.lit(1)) - 1)
        return rows.withColumn(own_name, mine).withColumn(other_name, F.explode(every)).drop("b", "s")

    return deal(buys, "b", "s", "x", "y"), deal(sells, "s", "b", "y", "x")


def accounts_trading_together(
    enriched: DataFrame, seconds: int = 30, tolerance: str | None = None, cells: int = CELLS, fold: int = FOLD, meet: int = MEET
) -> DataFrame:
    """Pairs of accounts on opposite sides of a symbol within ``seconds``, optionally at similar size.

    An interval join over cells of time. Each account's trades of a cell are one row with their count and times, so the
    join sees accounts, not trades. Cells less than ``cells`` apart lie within the time altogether: their pairs are the
    product of two counts. Only pairs further apart, and the nearest pair inside a cell, look at the times. Crowded cells
    are dealt into parts of bounded size. With a tolerance, size bands join the key as well.
    """
    width = seconds * 1_000_000
    columns = ["symbol", F.col("trade_type").alias("side"), F.col("account_id").alias("account"), "trade_id"]
    size = F.col("quantity") if tolerance is not None else F.lit(0)
    trades = enriched.select(*columns, size.alias("quantity"), F.unix_micros("traded_at").alias("us"))
    keys = ["symbol", "side", "account", "quantity"]
    folds = account_folds(trades.filter("side in ('BUY', 'SELL') and symbol is not null and us is not null"), width, keys, cells, fold)
    far = F.lit(-(-width // (width // cells))).cast("bigint")
    buys = folds.filter("side = 'BUY'").withColumn("at", F.explode(F.sequence(F.col("cell") - far, F.col("cell") + far)))
    sells = folds.filter("side = 'SELL'").withColumn("at", F.col("cell"))
    meeting, close = ["symbol", "at"], F.lit(True)
    if tolerance is not None:
        # A band is wider than the tolerance on either side, so a match is at most one band away.
        step = F.lit(float(-2 * (Decimal(1) - Decimal(tolerance)).ln()))
        band = F.floor(F.log(F.col("quantity")) / step)
        buys = buys.withColumn("band", F.explode(F.sequence(band - 1, band + 1)))
        sells = sells.withColumn("band", band)
        meeting.append("band")
        q1, q2 = F.col("q1").cast("decimal(20,0)"), F.col("q2").cast("decimal(20,0)")
        close = F.abs(q1 - q2) < q1 * F.lit(Decimal(tolerance))
    buys, sells = dealt_to_meet(buys, sells, meeting, meet)
    names = [*meeting, "x", "y"]
    buys = buys.select(*names, F.col("account").alias("buyer"), F.col("quantity").alias("q1"), F.col("cell").alias("c1"), F.col("n").alias("n1"), F.col("times").alias("t1"))
    sells = sells.select(*names, F.col("account").alias("seller"), F.col("quantity").alias("q2"), F.col("n").alias("n2"), F.col("times").alias("t2"))
    pairs = buys.join(sells, names).filter(close & (F.col("buyer") != F.col("seller")))
    apart = F.col("at") - F.col("c1")
    first1, last1, first2, last2 = (F.element_at(t, k) for t in ("t1", "t2") for k in (1, -1))
    nearest = F.array_min(F.transform("t1", lambda a: F.array_min(F.transform("t2", lambda b: F.abs(a - b)))))
    within = F.aggregate(
        "t1", F.lit(0).cast("bigint"), lambda n, a: n + F.size(F.filter("t2", lambda b: F.abs(a - b) <= width)).cast("bigint")
    )
    single = (F.col("n1") == 1) & (F.col("n2") == 1)
    closest = F.when(apart > 0, first2 - last1).when(apart < 0, first1 - last2).when(single, F.abs(first1 - first2)).otherwise(nearest)
    counted = F.when((F.abs(apart) < cells) | single, F.col("n1") * F.col("n2")).otherwise(within)
    pairs = pairs.select("symbol", "buyer", "seller", counted.alias("n"), closest.alias("us")).filter(F.col("us") <= width)
    return pairs.groupBy("symbol", "buyer", "seller").agg(F.sum("n").alias("paired_trades"), F.min("us").alias("closest_us"))
