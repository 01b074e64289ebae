import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tapelake.functions.masking import row_hash
from tapelake.operators import dims, gold, scd, silver
from tapelake.schemas import DIM_SYMBOL, column_names
from tapelake.sources import files


def test_gold_bar_values(make_trades):
    trades = make_trades([("AAA", 0, 180, 100), ("AAA", 60, 185, 200), ("AAA", 120, 182, 150)])
    row = gold.daily_ohlcv(trades).collect()[0]
    assert (row.open_price, row.close_price, row.high_price, row.low_price) == (180.0, 182.0, 185.0, 180.0)
    assert row.vwap == (180 * 100 + 185 * 200 + 182 * 150) / 450
    assert (row.total_volume, row.trade_count, row.total_value) == (450, 3, 82300.0)


def test_gold_other_day_is_empty(make_trades):
    assert gold.daily_ohlcv(make_trades([("AAA", 0, 10, 1)]), day="2024-01-03").count() == 0


def test_gold_zero_volume_has_zero_vwap(make_trades):
    assert gold.daily_ohlcv(make_trades([("AAA", 0, 10, 0)])).collect()[0].vwap == 0.0


def test_gold_breaks_time_ties_by_trade_id(make_trades):
    row = gold.daily_ohlcv(make_trades([("AAA", 5, 1, 1), ("AAA", 5, 2, 1), ("AAA", 5, 3, 1)])).collect()[0]
    assert (row.open_price, row.close_price) == (1.0, 3.0)


def test_one_trade_vwap_equals_its_price(make_trades):
    """Within a day the VWAP may not leave the price range, not even by a rounding error."""
    items = [(f"S{i}", i, 0.01 + i * 0.37, 10 * (i % 97 + 1)) for i in range(500)]
    assert gold.daily_ohlcv(make_trades(items)).filter("vwap < low_price OR vwap > high_price").count() == 0


def test_gold_job_replaces_only_its_day(spark, make_trades, tmp_path):
    path = str(tmp_path / "gold")
    day1 = make_trades([("AAA", 0, 10, 1)])
    day2 = day1.withColumns({"timestamp": F.col("timestamp") + F.expr("INTERVAL 1 DAY"), "price": F.lit(20.0)})
    gold.run_gold_job(day1.unionByName(day2), path)
    gold.run_gold_job(day2.withColumn("price", F.lit(30.0)), path)
    gold.run_gold_job(day1.limit(0), path)
    got = {r.trading_date: r.close_price for r in spark.read.parquet(path).collect()}
    assert got == {date(2024, 1, 2): 10.0, date(2024, 1, 3): 30.0}


def test_unknown_interval(make_trades):
    with pytest.raises(ValueError, match="unknown interval"):
        gold.candles(make_trades([("AAA", 0, 10, 1)]), "2m")


def test_weeks_start_on_monday(make_trades):
    assert gold.candles(make_trades([("AAA", 0, 10, 1)]), "1w").collect()[0].bucket_ts.date() == date(2024, 1, 1)


def test_dedup_keeps_lowest_offset(market):
    extra = market.bronze_trades.filter("_kafka_offset >= 100000000")
    assert extra.count() > 0
    kept = market.silver_trades.join(market.trades.select("trade_id", F.col("price").alias("p0")), "trade_id")
    assert kept.filter("price <> p0").count() == 0
    assert market.silver_trades.count() == market.trades.count()


def test_dedup_limits_rows_before_the_shuffle(market):
    plan = market.silver_trades._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_silver_rerun_adds_nothing(market):
    again = silver.silver_trades(market.bronze_trades, market.dim_symbol, existing=market.silver_trades)
    assert again.count() == 0


def test_silver_since_reads_new_rows_only(market):
    since = "2024-01-20 00:00:00"
    rows = silver.silver_trades(market.bronze_trades, market.dim_symbol, since=since)
    assert rows.count() == market.trades.filter("timestamp + INTERVAL 2 SECONDS > timestamp'2024-01-20'").count()


def test_silver_columns(market):
    from tapelake.schemas import GOLD_DAILY, SILVER_ORDERBOOK, SILVER_TRADES

    assert market.silver_trades.columns == column_names(SILVER_TRADES)
    assert market.gold.columns == column_names(GOLD_DAILY)
    books = silver.silver_orderbook(market.bronze_orderbook, market.dim_symbol)
    assert books.columns == column_names(SILVER_ORDERBOOK)
    assert dict(market.silver_trades.dtypes)["is_aggressive_buy"] == "boolean"


def test_enrich_keeps_unknown_symbols(spark, market):
    df = spark.createDataFrame([("NOBODY",)], "symbol string")
    assert silver.enrich(df, market.dim_symbol).collect()[0].sector is None
    assert silver.enrich_or_unknown(df, market.symbols).collect()[0].sector == "Unknown"


def test_one_sided_book(spark, market):
    book = spark.createDataFrame(
        [("AAA", '[{"price": 10.0, "quantity": 5}, {"price": 12.0, "quantity": 1}]', "[]", 1, 0, 0)],
        "symbol string, bids_json string, asks_json string, sequence_number int, _kafka_offset bigint, _kafka_partition int",
    ).withColumn("timestamp", F.current_timestamp())
    row = silver.silver_orderbook(book, market.dim_symbol).collect()[0]
    assert (row.best_bid_price, row.best_bid_qty, row.bid_depth) == (10.0, 5, 2)
    assert (row.best_ask_price, row.ask_depth, row.spread, row.mid_price) == (None, 0, None, None)


REFERENCE = "symbol string, company_name string, sector string, market_cap_category string"


def reference(spark, *items):
    return spark.createDataFrame(list(items), REFERENCE)


def test_row_hash_is_stable_and_sensitive(spark):
    import hashlib

    df = reference(spark, ("A", "Alpha", "Tech", "large"))
    got = df.select(row_hash("symbol", "company_name", "sector", "market_cap_category").alias("h")).collect()[0].h
    assert got == hashlib.sha256(b"A|Alpha|Tech|large").hexdigest()[:16]


def test_scd2_life(spark, rows):
    day1 = reference(spark, ("A", "Alpha", "Tech", "large"), ("B", "Beta", "Tech", "mid"))
    dim = scd.seed(spark, day1, "2024-01-01", "2024-01-01 00:00:00")
    assert dim.columns == column_names(DIM_SYMBOL)
    day2 = reference(spark, ("A", "Alpha Corp", "Tech", "large"), ("C", "Gamma", "Energy", "small"))
    counts = scd.scd2_counts(dim, day2).collect()[0]
    assert (counts.expired, counts.inserted) == (1, 2)
    after = scd.apply_scd2(dim, day2, "2024-01-05")
    got = rows(after, "symbol", "company_name", "is_current", "effective_date", "expiry_date")
    assert got == [
        ("A", "Alpha", False, date(2024, 1, 1), date(2024, 1, 4)),
        ("A", "Alpha Corp", True, date(2024, 1, 5), date(9999, 12, 31)),
        ("B", "Beta", True, date(2024, 1, 1), date(9999, 12, 31)),
        ("C", "Gamma", True, date(2024, 1, 5), date(9999, 12, 31)),
    ]
    assert sorted(r.symbol_key for r in after.collect()) == [1, 2, 3, 4]
    again = scd.scd2_counts(after, day2).collect()[0]
    assert (again.expired, again.inserted) == (0, 0)


def test_surrogate_keys_are_dense_and_unique(spark):
    many = spark.range(5000).select(
        F.concat(F.lit("S"), "id").alias("symbol"), F.lit("c").alias("company_name"), F.lit("s").alias("sector"),
        F.lit("m").alias("market_cap_category"),
    )
    keys = scd.seed(spark, many, "2024-01-01").agg(F.min("symbol_key"), F.max("symbol_key"), F.count_distinct("symbol_key"))
    assert tuple(keys.collect()[0]) == (1, 5000, 5000)


def test_evolution_is_idempotent(market):
    changes = [scd.ColumnChange("quantity", "shares"), scd.ColumnChange("price", "level", "int")]
    once = scd.evolve(market.trades, changes)
    assert scd.evolve(once, changes).columns == once.columns
    assert scd.evolve(market.trades, changes, dry_run=True).columns == market.trades.columns
    assert [step for _, step in scd.evolution_plan(once.columns, changes)] == ["skip: already exists"] * 2
    assert once.filter("level IS NOT NULL").count() == 0


@pytest.mark.parametrize(
    "key,session",
    [(359, "closed"), (400, "pre-market"), (929, "pre-market"), (930, "regular"), (1559, "regular"), (1600, "after-hours"),
     (1959, "after-hours"), (2000, "closed")],
)
def test_sessions(spark, key, session):
    row = dims.dim_time(spark).filter(F.col("time_key") == key).collect()
    expected = [] if key % 100 >= 60 else [session]
    assert [r.trading_session for r in row] == expected
    assert all(r.is_market_hours == (session == "regular") for r in row)


def test_day_writer_prunes_and_filters(spark, market, tmp_path):
    path = str(tmp_path / "trades")
    files.write_by_day(market.trades.drop("trading_date"), path)
    plan = (
        spark.read.parquet(path).filter("day = date'2024-01-05' AND symbol = 'NATION_3'").select("price")
        ._jdf.queryExecution().executedPlan().toString()
    )
    assert "PartitionFilters: [isnotnull(day" in plan and "EqualTo(symbol,NATION_3)" in plan


@pytest.mark.parametrize("chunk,together", [("month", 100_000), ("day", 7), ("year", 50)])
def test_as_of_merge_equals_the_join(spark, chunk, together):
    rng = random.Random(8)
    start = date(2023, 11, 20)
    versions, facts = [], []
    for symbol in ("HOT", "OLD", "GAP", "NEW"):
        at = start + timedelta(days={"NEW": 60}.get(symbol, 0))
        for k in range({"HOT": 120, "OLD": 1}.get(symbol, 6)):
            until = at + timedelta(days=1 if symbol == "HOT" else rng.randrange(3, 20))
            versions.append((symbol, at, date(9999, 12, 31) if symbol == "OLD" else until - timedelta(days=1), f"{symbol}{k}" if k % 3 else None))
            at = until + timedelta(days=2 if symbol == "GAP" else 0)
    for k in range(900):
        symbol = rng.choice(["HOT", "HOT", "HOT", "OLD", "GAP", "NEW", "NONE", None])
        day = start + timedelta(days=40 if k % 3 == 0 else rng.randrange(-5, 150))
        facts.append((k, symbol, None if k % 50 == 0 else day))
    dim = spark.createDataFrame(versions, "symbol string, effective_date date, expiry_date date, name string")
    df = spark.createDataFrame(facts, "id int, symbol string, day date").repartition(5)
    got = scd.as_of_merge(df, dim, "day", ["name"], chunk, together)
    want = scd.as_of(df, dim, "day", ["name"]).select(*got.columns)
    assert got.count() > 200
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_as_of_merge_has_no_fan_out(spark):
    """A key with 10,000 versions and most facts: what is merged is facts and versions, in parts of about one size."""
    days = F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int"))
    dim = spark.range(10_000).select(F.lit("HOT").alias("symbol"), days.alias("effective_date"), days.alias("expiry_date"), F.col("id").alias("v"))
    day = F.date_add(F.lit("2000-01-01").cast("date"), F.when(F.col("id") % 2 == 0, 5000).otherwise(F.col("id") % 10_000).cast("int"))
    facts = spark.range(200_000).select("id", F.lit("HOT").alias("symbol"), day.alias("day"))
    parts = scd.as_of_parts(facts, dim, "day", ["v"], "month", 1000).groupBy("symbol", "_chunk", "_part").count()
    sizes = sorted(r["count"] for r in parts.collect())
    assert sum(sizes) < 225_000 and sizes[-1] <= 1500 and len(sizes) > 300
    got = scd.as_of_merge(facts, dim, "day", ["v"], together=1000)
    assert got.count() == 200_000
    assert got.filter("v <> case when id % 2 = 0 then 5000 else id % 10000 end").count() == 0
