"""Silver: deduplicated, enriched trades and order-book snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapelake.functions.book import parse_levels, top_of_book
from tapelake.functions.timing import ts_literal
from tapelake.schemas import SILVER_ORDERBOOK, SILVER_TRADES, column_names
from tapelake.sources.files import read_or_empty, write_by_day


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of every key.

    Spark limits each key to one row before the shuffle as well as after it (WindowGroupLimit), so a key with
    millions of copies sends one row per map task.
    """
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def first_by_offset(df: DataFrame, keys: list[str]) -> DataFrame:
    """The copy ingested first: lowest offset, the partition breaking ties."""
    return first_per_key(df, keys, ["_kafka_offset", "_kafka_partition"])


def drop_existing(incoming: DataFrame, existing: DataFrame, keys: list[str], since: str | None = None) -> DataFrame:
    """Incoming rows whose key is not in ``existing``, looking only at rows processed after ``since`` when given."""
    if since is not None:
        existing = existing.filter(F.col("_processed_at") >= ts_literal(since))
    return incoming.join(existing.select(*keys), keys, "left_anti")


def enrich(df: DataFrame, dim_symbol: DataFrame) -> DataFrame:
    """Company and sector from the current dimension row; unknown symbols keep NULL.

    No hint: the dimension is broadcast only while its size is under the session's threshold.
    """
    current = dim_symbol.filter("is_current").select("symbol", "company_name", "sector")
    return df.join(current, "symbol", "left")


def enrich_or_unknown(df: DataFrame, reference: DataFrame) -> DataFrame:
    """The stream lookup: three attributes, ``Unknown`` where the symbol has no reference row."""
    attributes = ["company_name", "sector", "market_cap_category"]
    looked_up = df.drop(*attributes).join(reference.select("symbol", *attributes), "symbol", "left")
    return looked_up.withColumns({name: F.coalesce(name, F.lit("Unknown")) for name in attributes})


def silver_trades(
    bronze: DataFrame,
    dim_symbol: DataFrame,
    existing: DataFrame | None = None,
    since: str | None = None,
    processed_at: str | None = None,
) -> DataFrame:
    """Bronze trades to Silver; with ``since``, only rows ingested after it are read."""
    if since is not None:
        bronze = bronze.filter(F.col("_ingested_at") > ts_literal(since))
    rows = first_by_offset(bronze, ["trade_id"])
    if existing is not None:
        rows = drop_existing(rows, existing, ["trade_id"], since)
    stamp = ts_literal(processed_at) if processed_at else F.current_timestamp()
    return enrich(rows, dim_symbol).withColumn("_processed_at", stamp).select(*column_names(SILVER_TRADES))


def run_silver_job(
    bronze: DataFrame, dim_symbol: DataFrame, path: str, since: str | None = None, processed_at: str | None = None
) -> None:
    """Append to the day-partitioned table at ``path`` the trades it lacks; with ``since``, reading only rows ingested
    after it. Ids are compared with the whole table, of which that column alone is read, so a rerun or an old replay adds
    nothing."""
    if since is not None:
        bronze = bronze.filter(F.col("_ingested_at") > ts_literal(since))
    held = read_or_empty(bronze.sparkSession, path, f"{SILVER_TRADES}, day date")
    write_by_day(silver_trades(bronze, dim_symbol, held, processed_at=processed_at), path)


def silver_orderbook(
    bronze: DataFrame,
    dim_symbol: DataFrame,
    existing: DataFrame | None = None,
    since: str | None = None,
    processed_at: str | None = None,
) -> DataFrame:
    """Bronze snapshots to Silver, first per symbol and timestamp; passing ``existing`` makes reruns add nothing."""
    if since is not None:
        bronze = bronze.filter(F.col("_ingested_at") > ts_literal(since))
    rows = first_by_offset(bronze, ["symbol", "timestamp"])
    if existing is not None:
        rows = drop_existing(rows, existing, ["symbol", "timestamp"], since)
    stamp = ts_literal(processed_at) if processed_at else F.current_timestamp()
    return (
        enrich(rows, dim_symbol)
        .withColumns({"_bids": parse_levels("bids_json"), "_asks": parse_levels("asks_json")})
        .withColumns(top_of_book(F.col("_bids"), F.col("_asks")))
        .withColumn("_processed_at", stamp)
        .select(*column_names(SILVER_ORDERBOOK))
    )


def merge_records(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Append with dedup by key: existing rows win, and the first incoming row of a new key is added."""
    fresh = drop_existing(first_per_key(incoming, keys, order), existing, keys)
    return existing.unionByName(fresh)
