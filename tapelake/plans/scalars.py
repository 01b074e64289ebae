"""Scalar function families and user-function surfaces, each over the whole trades."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapelake.functions import fixedpoint as fp
from tapelake.functions import sql_functions
from tapelake.functions.book import parse_levels, top_of_book
from tapelake.functions.timing import epoch_seconds, parse_iso
from tapelake.operators import alerts, ingest, orderbook, quality
from tapelake.plans.charts import SLOW_RULES, _alert_sql
from tapelake.plans.market_sql import rounded
from tapelake.plans.registry import query
from tapelake.schemas import BOOK_EVENT


@query(
    "udf_macros",
    f"""SELECT trade_id, md5(account_id) AS hashed, substr(account_id, 1, 4) || repeat('*', length(account_id) - 4) AS part, {rounded("price", 1)} AS rounded,
       '***REDACTED***' AS redacted, 'DELETED-' || substr(sha256(account_id), 1, 16) AS pseudonym FROM account_trades""",
)
def udf_macros(m):
    sql_functions.register(m.spark)
    return m.spark.sql(
        """SELECT trade_id, mask_hash(account_id) AS hashed, mask_partial(account_id, 4) AS part, mask_round(price, 1) AS rounded,
        mask_redact() AS redacted, hash_account_id(account_id) AS pseudonym FROM {trades}""",
        trades=m.account_trades,
    )


@query(
    "udf_map",
    """SELECT symbol, snapshot_ts::TIMESTAMP AS timestamp, cast(count(*) FILTER (WHERE side = 'BID') AS int) AS bid_levels,
       cast(count(*) FILTER (WHERE side = 'ASK') AS int) AS ask_levels
FROM book_levels WHERE extract(day FROM snapshot_ts) % 3 <> 0 GROUP BY 1, 2""",
)
def udf_map(m):
    """One result per sound message; every third day's texts are broken and drop out."""
    broken = F.col("offset") / 86400 % 1 == 0
    day = F.dayofmonth(F.timestamp_seconds("offset"))
    value = F.when(broken & (day % 3 == 0), F.regexp_replace("value", '"bids":\\[.*$', '"bids":[{')).otherwise(F.col("value"))
    books = ingest.from_flat_json(m.book_messages.withColumn("value", value), BOOK_EVENT)
    metrics = orderbook.orderbook_metrics(books.withColumn("timestamp", parse_iso("timestamp")))
    return metrics.select("symbol", "timestamp", "bid_levels", "ask_levels")


@query("udf_flatmap", f"SELECT symbol, count(*) AS alerts FROM ({_alert_sql(21600, 3600)}) GROUP BY symbol")
def udf_flatmap(m):
    """None or one result per trade, counted."""
    return alerts.price_alerts(m.trades, SLOW_RULES).groupBy("symbol").agg(F.count(F.lit(1)).alias("alerts"))


@query(
    "udf_row_apply",
    """SELECT symbol, timestamp, best_bid_price, best_bid_qty, best_ask_price, best_ask_qty, bid_depth, ask_depth, spread, mid_price FROM silver_books""",
)
def udf_row_apply(m):
    """Top of book computed row by row, without Python."""
    first = m.bronze_orderbook.filter("_kafka_offset % 86400 = 0")
    top = top_of_book(parse_levels("bids_json"), parse_levels("asks_json"))
    return first.withColumns(top).select("symbol", "timestamp", *top)


@query(
    "udf_dq_metric",
    """SELECT symbol, trading_date, high_price >= open_price AND high_price >= close_price AND low_price <= open_price AND low_price <= close_price
       AND vwap >= low_price AND vwap <= high_price AS consistent FROM gold""",
)
def udf_dq_metric(m):
    return m.gold.select("symbol", "trading_date", (~quality.ohlcv_consistent().violated).alias("consistent"))


@query(
    "scalar_math",
    f"""SELECT trade_id, {rounded("price", 1)} AS rounded, abs(price - 245) AS distance, price / nullif(quantity % 30, 0) AS guarded, {rounded("pow(price, 2)", 4)} AS squared FROM trades""",
)
def scalar_math(m):
    price, quantity = F.col("price"), F.col("quantity")
    return m.trades.select(
        "trade_id",
        fp.round_half_up(price, 1).alias("rounded"),
        F.abs(price - 245.0).alias("distance"),
        (price / F.nullif(quantity % 30, F.lit(0)).cast("double")).alias("guarded"),
        fp.round_half_up(F.pow(price, F.lit(2.0)), 4).alias("squared"),
    )


@query(
    "scalar_string",
    """SELECT trade_id, symbol ILIKE '%nation_1%' AS hit, left(trade_id, 3) AS head, repeat('*', 3) AS stars, cast(length(symbol) AS int) AS len,
       concat(symbol, '-', sector) AS joined, substring(trade_id, 2, 4) AS middle FROM trades""",
)
def scalar_string(m):
    return m.trades.select(
        "trade_id",
        F.col("symbol").ilike("%nation_1%").alias("hit"),
        F.left("trade_id", F.lit(3)).alias("head"),
        F.repeat(F.lit("*"), 3).alias("stars"),
        F.length("symbol").alias("len"),
        F.concat("symbol", F.lit("-"), "sector").alias("joined"),
        F.substring("trade_id", 2, 4).alias("middle"),
    )


@query("scalar_hash", "SELECT trade_id, md5(trade_id) AS short_hash, substr(sha256(trade_id), 1, 16) AS row_hash FROM trades")
def scalar_hash(m):
    return m.trades.select(
        "trade_id", F.md5("trade_id").alias("short_hash"), F.substring(F.sha2("trade_id", 256), 1, 16).alias("row_hash")
    )


@query(
    "scalar_datetime",
    """SELECT trade_id, cast(date_trunc('week', timestamp) AS timestamp) AS week, cast(epoch_us(timestamp) AS double) / 1000000 AS epoch,
       cast(trading_date - INTERVAL 7 DAY AS date) AS week_before, timestamp AS parsed FROM trades""",
)
def scalar_datetime(m):
    text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return m.trades.select(
        "trade_id",
        F.date_trunc("week", "timestamp").alias("week"),
        epoch_seconds("timestamp").alias("epoch"),
        F.date_sub("trading_date", 7).alias("week_before"),
        parse_iso(text).alias("parsed"),
    )


@query(
    "scalar_cast",
    """SELECT trade_id, cast(quantity AS double) AS as_double, cast(is_aggressive_buy AS int) AS as_int, cast(timestamp AS date) AS as_date,
       TRY_CAST(substr(trade_id, CASE WHEN quantity % 20 = 0 THEN 1 ELSE 2 END) AS int) AS tried FROM trades""",
)
def scalar_cast(m):
    digits = F.substring("trade_id", F.when(F.col("quantity") % 20 == 0, 1).otherwise(2), F.lit(20))
    return m.trades.select(
        "trade_id",
        F.col("quantity").cast("double").alias("as_double"),
        F.col("is_aggressive_buy").cast("int").alias("as_int"),
        F.col("timestamp").cast("date").alias("as_date"),
        digits.try_cast("int").alias("tried"),
    )


@query(
    "scalar_conditional",
    """SELECT trade_id, coalesce(CASE WHEN quantity >= 500 THEN 'block' END, 'retail') AS kind, CASE WHEN price >= 300 THEN 'A' WHEN price >= 100 THEN 'B' ELSE 'C' END AS tier FROM trades""",
)
def scalar_conditional(m):
    return m.trades.select(
        "trade_id",
        F.coalesce(F.when(F.col("quantity") >= 500, "block"), F.lit("retail")).alias("kind"),
        F.when(F.col("price") >= 300, "A").when(F.col("price") >= 100, "B").otherwise("C").alias("tier"),
    )


@query(
    "scalar_json_array",
    """SELECT symbol, cast(snapshot_ts AS timestamp) AS timestamp, cast(count(*) AS int) AS levels, first(price ORDER BY trade_id) AS first_price,
       list_sum(list_slice(list(price ORDER BY price DESC), 1, 1)) AS best_price FROM book_levels WHERE side = 'BID' GROUP BY 1, 2""",
)
def scalar_json_array(m):
    levels = parse_levels(F.to_json("bids"))
    books = m.books.select("symbol", "timestamp", levels.alias("levels")).filter(F.size("levels") > 0)
    best = F.slice(F.sort_array(F.transform("levels", lambda v: v["price"]), asc=False), 1, 1)
    return books.select(
        "symbol",
        "timestamp",
        F.size("levels").alias("levels"),
        F.get(F.col("levels"), F.lit(0))["price"].alias("first_price"),
        F.aggregate(best, F.lit(0.0), lambda acc, x: acc + x).alias("best_price"),
    )


@query("scalar_pattern", "SELECT symbol, regexp_matches(lower(symbol), 'nation_(1|2)[0-9]') AS matched, count(*) AS trade_count FROM trades GROUP BY 1, 2")
def scalar_pattern(m):
    matched = F.col("symbol").rlike("(?i)nation_(1|2)[0-9]").alias("matched")
    return m.trades.groupBy("symbol", matched).agg(F.count(F.lit(1)).alias("trade_count"))
