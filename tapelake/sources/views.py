"""Market views over the base tables: the input every registered query starts from."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelake.functions.masking import row_hash
from tapelake.functions.timing import ts_literal
from tapelake.operators import bi_views, gold, ingest, silver
from tapelake.schemas import BASE_TABLES
from tapelake.session import configure
from tapelake.sources.messages import message_text

# A fixed "now" for the queries: the events cover January 2024, and a clock would make results drift.
AS_OF = "2024-01-30"
PROCESSED_AT = "2024-01-31 00:00:00"


class Market:
    """Lazy views; nothing runs until a query built on them does."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = configure(spark)
        self.path = path.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(BASE_TABLES[name]).parquet(f"{self.path}/{name}.parquet")

    @cached_property
    def symbols(self) -> DataFrame:
        """Instrument reference: one row per nation, its region as sector."""
        cap = (
            F.when(F.col("n_nationkey") % 3 == 0, "large").when(F.col("n_nationkey") % 3 == 1, "mid").otherwise("small")
        )
        return (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("n_nationkey").alias("symbol_key"),
                F.col("n_name").alias("symbol"),
                F.concat(F.lit("Company "), "n_name").alias("company_name"),
                F.col("r_name").alias("sector"),
                cap.alias("market_cap_category"),
            )
        )

    @cached_property
    def dim_symbol(self) -> DataFrame:
        """The reference as an SCD2 dimension with every row current since 2024-01-01."""
        return self.symbols.select(
            "symbol_key",
            "symbol",
            "company_name",
            "sector",
            "market_cap_category",
            F.lit("2024-01-01").cast("date").alias("effective_date"),
            F.lit("9999-12-31").cast("date").alias("expiry_date"),
            F.lit(True).alias("is_current"),
            row_hash("symbol", "company_name", "sector", "market_cap_category").alias("row_hash"),
            ts_literal("2024-01-01 00:00:00").alias("_updated_at"),
        )

    @cached_property
    def dim_symbol_history(self) -> DataFrame:
        """The dimension with an expired earlier version of every third symbol."""
        old = F.col("symbol_key") % 3 == 0
        expired = self.dim_symbol.filter(old).select(
            (F.col("symbol_key") + 100).alias("symbol_key"),
            "symbol",
            F.concat(F.lit("Old "), "company_name").alias("company_name"),
            "sector",
            F.lit("small").alias("market_cap_category"),
            F.lit("2024-01-01").cast("date").alias("effective_date"),
            F.lit("2024-01-14").cast("date").alias("expiry_date"),
            F.lit(False).alias("is_current"),
            row_hash(
                "symbol", F.concat(F.lit("Old "), "company_name"), "sector", F.lit("small")
            ).alias("row_hash"),
            "_updated_at",
        )
        current = self.dim_symbol.withColumn(
            "effective_date", F.when(old, F.lit("2024-01-15").cast("date")).otherwise(F.col("effective_date"))
        )
        return current.unionByName(expired)

    @cached_property
    def trades(self) -> DataFrame:
        """Clean intraday trades, one per base event."""
        events = self.table("events")
        account = F.col("user_id")
        # The hint is safe: the reference is the 25-row nation table at every scale, and without it Catalyst, which
        # takes a join's size for the product of its inputs, broadcasts the events of a small data set instead.
        return events.join(F.broadcast(self.symbols), F.col("symbol_key") == account % 25).select(
            F.concat(F.lit("T"), F.lpad(F.col("event_id").cast("string"), 10, "0")).alias("trade_id"),
            "symbol",
            F.col("value").alias("price"),
            ((F.regexp_extract("props", "[0-9]+", 0).cast("int") + 1) * 10).alias("quantity"),
            F.concat(F.lit("B"), F.col("event_id").cast("string")).alias("buy_order_id"),
            F.concat(F.lit("S"), F.col("event_id").cast("string")).alias("sell_order_id"),
            F.concat(F.lit("ACC-"), F.lpad(account.cast("string"), 6, "0")).alias("buyer_agent_id"),
            F.concat(F.lit("ACC-"), F.lpad(((account * 7 + 3) % 150).cast("string"), 6, "0")).alias("seller_agent_id"),
            (F.col("event_id") % 2 == 0).alias("is_aggressive_buy"),
            F.col("ts").alias("timestamp"),
            F.to_date("ts").alias("trading_date"),
            F.col("event_id").alias("_kafka_offset"),
            (F.col("event_id") % 3).cast("int").alias("_kafka_partition"),
            "company_name",
            "sector",
        )

    @cached_property
    def bronze_trades(self) -> DataFrame:
        """Trades as ingested: every tenth is replayed later, at a higher offset and a drifted price."""
        replays = self.trades.filter(F.col("_kafka_offset") % 10 == 0).withColumns(
            {"price": F.col("price") + 1.0, "_kafka_offset": F.col("_kafka_offset") + 100_000_000}
        )
        return (
            self.trades.unionByName(replays)
            .withColumns({"event_type": F.lit("TradeExecuted"), "_kafka_topic": F.lit("raw.trades")})
            .withColumn("_ingested_at", F.col("timestamp") + F.expr("INTERVAL 2 SECONDS"))
            .drop("company_name", "sector")
        )

    @cached_property
    def silver_trades(self) -> DataFrame:
        return silver.silver_trades(self.bronze_trades, self.dim_symbol, processed_at=PROCESSED_AT)

    @cached_property
    def enriched(self) -> DataFrame:
        return bi_views.trades_enriched(self.trades)

    @cached_property
    def daily(self) -> DataFrame:
        return bi_views.daily_bars(self.trades)

    @cached_property
    def gold(self) -> DataFrame:
        return gold.daily_ohlcv(self.trades, aggregated_at=PROCESSED_AT)

    @cached_property
    def account_trades(self) -> DataFrame:
        """The view governance works on: side, account and region beside each trade."""
        return self.trades.select(
            "trade_id",
            "symbol",
            "price",
            "quantity",
            F.when(F.col("is_aggressive_buy"), "BUY").otherwise("SELL").alias("side"),
            F.col("trading_date").alias("trade_date"),
            "timestamp",
            F.when(F.col("is_aggressive_buy"), F.col("buyer_agent_id"))
            .otherwise(F.col("seller_agent_id"))
            .alias("account_id"),
            F.col("sector").alias("region"),
        )

    @cached_property
    def book_levels(self) -> DataFrame:
        """Flat book levels: the trades of a symbol and day read as resting orders, asks 500 higher, summed by price.

        A side then has at most one level per price, however many trades there are.
        """
        bid = F.col("is_aggressive_buy")
        return (
            self.trades.groupBy(
                "symbol",
                F.date_trunc("day", "timestamp").alias("snapshot_ts"),
                F.when(bid, "BID").otherwise("ASK").alias("side"),
                F.when(bid, F.col("price")).otherwise(F.col("price") + 500.0).alias("price"),
            )
            .agg(
                F.sum(F.col("quantity").cast("bigint")).cast("int").alias("quantity"),
                F.count(F.lit(1)).cast("int").alias("order_count"),
                F.min("trade_id").alias("trade_id"),
            )
        )

    @cached_property
    def books(self) -> DataFrame:
        """Order-book snapshots with array sides in arrival order, one per symbol and day."""
        level = F.struct("trade_id", "price", "quantity", "order_count")

        def side(name: str):
            # As long as the price grid at most.
            rows = F.sort_array(F.collect_list(F.when(F.col("side") == name, level)))
            return F.transform(
                rows,
                lambda v: F.struct(
                    v["price"].alias("price"), v["quantity"].alias("quantity"), v["order_count"].alias("order_count")
                ),
            )

        return self.book_levels.groupBy("symbol", F.col("snapshot_ts").alias("timestamp")).agg(
            side("BID").alias("bids"),
            side("ASK").alias("asks"),
            F.dayofmonth(F.first("snapshot_ts")).alias("sequence_number"),
        )

    @cached_property
    def bronze_orderbook(self) -> DataFrame:
        """Snapshots as ingested: sides as JSON text, plus a later replay of every second day."""
        base = self.books.select(
            "symbol",
            F.to_json("bids").alias("bids_json"),
            F.to_json("asks").alias("asks_json"),
            "sequence_number",
            F.lit("OrderBookSnapshot").alias("event_type"),
            "timestamp",
            F.lit("raw.orderbook-snapshots").alias("_kafka_topic"),
            F.lit(0).alias("_kafka_partition"),
            F.unix_seconds("timestamp").alias("_kafka_offset"),
            (F.col("timestamp") + F.expr("INTERVAL 2 SECONDS")).alias("_ingested_at"),
        )
        replay = base.filter(F.col("sequence_number") % 2 == 0).withColumns(
            {"bids_json": F.lit("[]"), "_kafka_offset": F.col("_kafka_offset") + 1}
        )
        return base.unionByName(replay)

    @cached_property
    def messages(self) -> DataFrame:
        """Raw feed: one JSON text per base event, some of it malformed by rule."""
        return self.trades.select(
            message_text().alias("value"),
            F.lit("market.feed").alias("topic"),
            F.col("_kafka_partition").alias("partition"),
            F.col("_kafka_offset").alias("offset"),
            F.col("timestamp"),
        )

    @cached_property
    def decoded(self) -> DataFrame:
        return ingest.decode(self.messages)

    @cached_property
    def validated(self) -> DataFrame:
        return ingest.validate(self.decoded)

    @cached_property
    def trade_messages(self) -> DataFrame:
        """Flat trade JSON as it arrives on the trade topic."""
        return self.trades.select(
            F.to_json(
                F.struct(
                    F.lit("TradeExecuted").alias("event_type"),
                    F.concat(F.lit("E"), F.col("_kafka_offset").cast("string")).alias("event_id"),
                    F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
                    "trade_id",
                    "symbol",
                    "price",
                    "quantity",
                    "buy_order_id",
                    "sell_order_id",
                    "buyer_agent_id",
                    "seller_agent_id",
                    "is_aggressive_buy",
                )
            ).alias("value"),
            F.lit("raw.trades").alias("topic"),
            F.col("_kafka_partition").alias("partition"),
            F.col("_kafka_offset").alias("offset"),
        )

    @cached_property
    def book_messages(self) -> DataFrame:
        """Flat snapshot JSON; odd days carry no sequence number."""
        return self.books.select(
            F.to_json(
                F.struct(
                    F.lit("OrderBookSnapshot").alias("event_type"),
                    F.concat("symbol", F.lit("-"), F.col("sequence_number").cast("string")).alias("event_id"),
                    F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
                    "symbol",
                    "bids",
                    "asks",
                    F.when(F.col("sequence_number") % 2 == 0, F.col("sequence_number")).alias("sequence_number"),
                )
            ).alias("value"),
            F.lit("raw.orderbook-snapshots").alias("topic"),
            F.lit(0).alias("partition"),
            F.unix_seconds("timestamp").alias("offset"),
        )
