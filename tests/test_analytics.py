import random

import pytest
from pyspark.sql import functions as F

from tapelake.functions import fixedpoint as fp
from tapelake.operators import charts, gold, indicators, running, selection, surveillance
from tapelake.operators import market as analytics
from tapelake.operators.bi_views import daily_bars, trades_enriched
from tapelake.operators.selection import TradeFilter


def random_trades(n, symbols=4, hot=0.4, days=1, seed=7):
    """Trades of which one symbol holds a large share."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        symbol = "HOT" if rng.random() < hot else f"S{rng.randrange(symbols)}"
        out.append((symbol, rng.randrange(days * 80000), round(rng.uniform(1, 300), 4), rng.randrange(1, 120), rng.random() < 0.5))
    return out


def brute(items):
    return sorted(enumerate(items), key=lambda t: (t[1][0], t[1][1], t[0]))


def test_sums_do_not_depend_on_order(spark):
    df = spark.range(20000).select((F.rand(3) * 1000).alias("price"), F.lit(7).alias("quantity"))
    df = spark.createDataFrame(df.toPandas())
    sums = {df.repartition(n).agg(fp.notional_sum().alias("s")).collect()[0].s for n in (1, 3, 16)}
    assert len(sums) == 1


def test_sum_passes_two_to_the_63(spark):
    df = spark.range(8).select(F.lit(2**62).alias("x"))
    assert int(df.agg(fp.exact_sum("x")).collect()[0][0]) == 2**65
    assert int(df.select(-F.col("x") - 1).toDF("x").agg(fp.exact_sum("x")).collect()[0][0]) == -(2**65) - 8


def test_small_prices_keep_their_value(make_trades):
    row = gold.daily_ohlcv(make_trades([("AAA", 0, 0.00001234, 1_000_000)])).collect()[0]
    assert row.total_value == pytest.approx(12.34)


def test_stddev_is_the_sample_one(spark):
    df = spark.createDataFrame([(2,), (4,), (4,), (4,), (5,), (5,), (7,), (9,)], "x bigint")
    got = df.agg(fp.sample_stddev("x").alias("a"), F.stddev("x").alias("b")).collect()[0]
    assert got.a == pytest.approx(got.b)
    assert df.limit(1).agg(fp.sample_stddev("x")).collect()[0][0] is None


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(38.394999999999996,), (2.675,), (-0.125,)], "x double")
    assert [r[0] for r in df.select(fp.round_half_up("x", 2)).collect()] == [38.4, 2.68, -0.13]


def test_session_ticks_against_brute_force(make_trades):
    items = random_trades(400, days=1)
    got = {r.trade_id: r for r in running.session_ticks(make_trades(items)).collect()}
    state = {}
    for i, (symbol, _, price, quantity, _) in brute(items):
        high, low, volume, count, last = state.get(symbol, (price, price, 0, 0, None))
        high, low, volume, count = max(high, price), min(low, price), volume + quantity, count + 1
        row = got[f"T{i:06d}"]
        assert (row.session_high, row.session_low, row.session_volume, row.tick_count) == (high, low, volume, count)
        assert row.previous_price == last
        expected = "neutral" if last is None or price == last else ("up" if price > last else "down")
        assert row.direction == expected
        state[symbol] = (high, low, volume, count, price)
    assert len(got) == len(items)


def test_depth_curve_against_brute_force(make_trades):
    items = random_trades(300)
    levels = make_trades(items).select("symbol", F.when(F.col("is_aggressive_buy"), "BID").otherwise("ASK").alias("side"),
                                       "price", "quantity", "trade_id")
    got = {r.trade_id: r.cumulative_quantity for r in running.depth_curve(levels, ["symbol"], band=10.0).collect()}
    totals = {}
    key = lambda t: ((-t[1][2]) if t[1][4] else t[1][2], t[0])
    for i, (symbol, _, _, quantity, buy) in sorted(enumerate(items), key=key):
        totals[symbol, buy] = totals.get((symbol, buy), 0) + quantity
        assert got[f"T{i:06d}"] == totals[symbol, buy]
    assert len(got) == len(items)


def test_wash_trades_against_brute_force(make_trades):
    items = random_trades(600, hot=0.5)
    enriched = trades_enriched(make_trades(items))
    got = {r.symbol: r for r in surveillance.wash_trades(enriched, "2024-01-04", min_pairs=1).collect()}
    day = lambda item: (36000 + item[1]) // 86400
    expected = {}
    for a in items:
        for b in items:
            if a[0] == b[0] and a[4] and not b[4] and day(a) == day(b) and 20 * abs(a[3] - b[3]) < a[3]:
                expected.setdefault(a[0], []).append(a)
    assert set(got) == set(expected)
    for symbol, pairs in expected.items():
        assert got[symbol].paired_trades == len(pairs)
        assert got[symbol].total_qty == sum(p[3] for p in pairs)
        assert got[symbol].avg_price == pytest.approx(sum(p[2] for p in pairs) / len(pairs))


def test_wash_trades_never_join(market):
    plan = surveillance.wash_trades(market.enriched, "2024-01-30")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2  # the market view's own reference joins: the trades are read once
    assert "Cartesian" not in plan


@pytest.mark.parametrize("tolerance", [None, "0.05", "0.3"])
def test_accounts_trading_together_against_brute_force(make_trades, tolerance):
    items = random_trades(500, hot=0.5)
    trades = make_trades(items)
    enriched = trades_enriched(trades)
    got = {
        (r.symbol, r.buyer, r.seller): r.paired_trades
        for r in surveillance.accounts_trading_together(enriched, seconds=120, tolerance=tolerance).collect()
    }
    expected = {}
    for i, a in enumerate(items):
        for j, b in enumerate(items):
            near = a[0] == b[0] and a[4] and not b[4] and abs(a[1] - b[1]) <= 120
            alike = tolerance is None or abs(a[3] - b[3]) * 100 < a[3] * round(float(tolerance) * 100)
            if near and alike:
                key = (a[0], f"B{i % 5}", f"S{j % 3}")
                expected[key] = expected.get(key, 0) + 1
    assert got == expected


@pytest.mark.parametrize("cells,fold,meet", [(1, 2, 3), (2, 3, 5), (4, 64, 2)])
def test_accounts_trading_together_whatever_the_cells(make_trades, cells, fold, meet):
    """Counts and nearest pairs do not depend on how cells, folds and parts are cut."""
    items = random_trades(400, hot=0.8) + [("HOT", 100, 1, 5, k % 2 == 0) for k in range(40)]
    enriched = trades_enriched(make_trades(items))
    got = surveillance.accounts_trading_together(enriched, 60, None, cells, fold, meet)
    got = {(r.symbol, r.buyer, r.seller): (r.paired_trades, r.closest_us) for r in got.collect()}
    expected = {}
    for i, a in enumerate(items):
        for j, b in enumerate(items):
            if a[0] == b[0] and a[4] and not b[4] and abs(a[1] - b[1]) <= 60:
                key, far = (a[0], f"B{i % 5}", f"S{j % 3}"), abs(a[1] - b[1]) * 1_000_000
                n, least = expected.get(key, (0, far))
                expected[key] = n + 1, min(least, far)
    assert got == expected


def test_a_crowded_cell_is_dealt_evenly(spark):
    """A symbol with a million trades a minute: no group of the join is far larger than the others."""
    from pyspark.sql import functions as F

    trades = spark.range(1_000_000).select(
        F.lit("HOT").alias("symbol"), F.when(F.col("id") % 2 == 0, "BUY").otherwise("SELL").alias("side"), F.col("id").alias("trade_id"),
        F.when(F.col("id") % 5 == 0, "WHALE").otherwise(F.concat(F.lit("A"), F.xxhash64("id") % 3000)).alias("account"),
        F.lit(0).alias("quantity"), (F.col("id") * 60).alias("us"),
    )
    folds = surveillance.account_folds(trades, 30_000_000, ["symbol", "side", "account", "quantity"])
    assert folds.agg(F.sum("n")).first()[0] == 1_000_000
    # An account whose trades are a fifth of all is cut into rows of a few times the bound at most.
    assert folds.agg(F.max("n")).first()[0] <= 2 * surveillance.FOLD
    buys, sells = (folds.filter(F.col("side") == s).withColumn("at", F.col("cell")) for s in ("BUY", "SELL"))
    for side in surveillance.dealt_to_meet(buys, sells, ["symbol", "at"]):
        sizes = [r["count"] for r in side.groupBy("symbol", "at", "x", "y").count().collect()]
        assert len(sizes) > 100 and max(sizes) <= 5 * sorted(sizes)[len(sizes) // 2]


def ema(values, period):
    if len(values) < period:
        return []
    out, k = [sum(values[:period]) / period], 2 / (period + 1)
    for v in values[period:]:
        out.append((v - out[-1]) * k + out[-1])
    return out


def test_seeded_ema():
    mean = indicators.SeededEma(3)
    assert [mean.add(x) for x in (1.0, 2.0, 3.0, 4.0)] == [None, None, 2.0, 3.0]


@pytest.mark.parametrize("n,expected", [(33, 0), (34, 1), (60, 27)])
def test_macd_warm_up(make_trades, n, expected):
    prices = [100 + (i * 37 % 11) for i in range(n)]
    candles = gold.candles(make_trades([("AAA", 60 * i, p, 1) for i, p in enumerate(prices)]), "1m")
    got = indicators.macd(candles).orderBy("bucket_ts").collect()
    assert len(got) == expected
    if got:
        fast, slow = ema(prices, 12), ema(prices, 26)
        line = [f - s for f, s in zip(fast[14:], slow)]
        signal = ema(line, 9)
        assert [r.signal for r in got] == pytest.approx(signal)
        assert [r.histogram for r in got] == pytest.approx([m - s for m, s in zip(line[8:], signal)])


@pytest.mark.parametrize("period", [1, 2, 9, 26])
def test_mean_over_blocks_equals_one_by_one(spark, period):
    """Many blocks, prices that jump by orders of magnitude, and symbols shorter than the warm-up."""
    import random

    from pyspark.sql import functions as F

    rng = random.Random(period)
    series = {f"S{k}": [rng.uniform(1, 2) * 10 ** rng.choice((0, 0, 3, -3)) for _ in range(n)] for k, n in enumerate((0, 1, period, period + 1, 700, 1500))}
    rows = [(s, k + 1, v) for s, values in series.items() for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "symbol string, n bigint, v double").repartition(5)
    both = indicators.with_seeded_means(df, "n", "v", {"mean": period, "slow": 100})
    got = {(r.symbol, r.n): (r.mean, r.slow) for r in both.collect()}
    assert len(got) == len(rows)
    for s, values in series.items():
        means = indicators.SeededEma(period), indicators.SeededEma(100)
        for k, v in enumerate(values):
            want = [m.add(v) for m in means]
            assert all((g is None) == (w is None) for g, w in zip(got[s, k + 1], want))
            assert [g for g in got[s, k + 1] if g is not None] == pytest.approx([w for w in want if w is not None], rel=1e-11)
    plan = both.agg(F.sum("mean"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_rsi_without_losses_is_null_and_balanced_is_fifty(spark):
    rows = [("UP", f"2024-01-{d:02d}", 10.0 + d) for d in range(1, 6)]
    rows += [("EVEN", f"2024-01-{d:02d}", 10.0 + d % 2) for d in range(1, 6)]
    daily = spark.createDataFrame(rows, "symbol string, trade_date string, close double")
    got = {(r.symbol, r.trade_date): r.rsi_14 for r in analytics.with_rsi(daily).collect()}
    assert got["UP", "2024-01-05"] is None
    assert got["EVEN", "2024-01-05"] == pytest.approx(50.0)


def test_sma_uses_partial_windows(spark):
    daily = spark.createDataFrame([("A", f"2024-01-{d:02d}", float(d)) for d in range(1, 26)], "symbol string, trade_date string, close double")
    got = {r.trade_date: r.sma_20 for r in analytics.with_sma(daily).collect()}
    assert got["2024-01-01"] == 1.0 and got["2024-01-25"] == sum(range(6, 26)) / 20


def test_filters_reach_the_scan(market):
    market.spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    wanted = TradeFilter(min_price=100, first_day="2024-01-05", last_day="2024-01-06")
    plan = selection.filter_trades(market.trades, wanted).select("price")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(value,100.0)" in plan and "GreaterThanOrEqual(ts,2024-01-05" in plan
    assert "event_type" not in plan


def test_empty_filter_keeps_everything(market):
    assert selection.filter_trades(market.trades, TradeFilter()).count() == market.trades.count()


def test_pages_tile_the_table(market):
    order = [F.desc("timestamp"), F.desc("trade_id")]
    trades = market.trades.select("trade_id", "timestamp").filter("trade_id < 'T0000000045'")
    seen = []
    for offset in (0, 20, 40):
        rows = selection.page(trades, order, 20, offset).collect()
        seen += [r.trade_id for r in rows]
        assert {r.total_count for r in rows} == {45}
        assert {r.has_next_page for r in rows} == {offset < 40}
        assert {r.has_previous_page for r in rows} == {offset > 0}
    assert len(set(seen)) == len(seen) == 45


def test_overview_of_an_empty_day_is_zero(market):
    row = analytics.market_totals(market.gold, "1999-01-01").collect()[0]
    assert (row.total_trades, row.total_value, row.unique_symbols, row.unchanged) == (0, 0.0, 0, 0)


def test_zero_open_changes(spark):
    schema = "symbol string, trading_date date, open_price double, close_price double, high_price double, low_price double"
    df = spark.sql("SELECT 'A', date'2024-01-01', 0D, 5D, 5D, 0D").toDF(*[c.split()[0] for c in schema.split(", ")])
    row = selection.with_change(df).collect()[0]
    assert (row.price_change_pct, row.price_range) == (0.0, 5.0)
    assert selection.change_pct_4dp(df).collect()[0].change_pct is None


def test_exposure_matrix(make_trades):
    enriched = trades_enriched(make_trades([("A", 0, 10, 5, True), ("B", 1, 10, 3, True), ("A", 2, 10, 2, False)]))
    rows = {r.account_id: (r.A, r.B) for r in charts.exposure_matrix(enriched, ["A", "B"]).collect()}
    assert rows == {"B0": (5, None), "B1": (None, 3), "S2": (-2, None)}


def test_high_volume_alert_fires(make_trades):
    items = [("A", 86400 * d, 10, 100) for d in range(20)] + [("A", 86400 * 20, 10, 301)]
    daily = daily_bars(make_trades(items))
    assert analytics.high_volume_alert(daily, "2024-01-22").collect()[0].volume_ratio == 3.01
    assert analytics.high_volume_alert(daily, "2024-01-21").count() == 0


def test_unhinted_dimension_joins(spark, make_trades):
    """A dimension past the broadcast threshold still joins, by shuffle."""
    from tapelake.operators.silver import enrich

    dim = spark.range(2000).select(F.concat(F.lit("S"), "id").alias("symbol"), F.lit("c").alias("company_name"),
                                   F.lit("t").alias("sector"), F.lit(True).alias("is_current"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = enrich(make_trades([("S1", 0, 1, 1), ("NONE", 1, 1, 1)]).drop("company_name", "sector"), dim)
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
        assert {r.symbol: r.sector for r in joined.collect()} == {"S1": "t", "NONE": None}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
