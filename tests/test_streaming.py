import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapelake.operators.alerts import LIVES, WARM, AlertRules, Baseline, _blocks, price_alerts, with_segments
from tapelake.operators.ingest import from_flat_json
from tapelake.schemas import TRADE_EVENT
from tapelake.sources import kafka
from tapelake.streaming import aggregates, feeds, pipelines
from tapelake.streaming.price_alerts import AlertProcessor, price_alert_stream

START = datetime(2024, 1, 2, 10)


def observe(prices, rules=AlertRules(), step=61):
    """Feed one symbol at a fixed pace and keep the answers."""
    state = Baseline()
    return [state.observe(p, i * step * 1_000_000, rules) for i, p in enumerate(prices)]


@pytest.mark.parametrize("price,severity", [(101.9, None), (102.0, "MEDIUM"), (105.0, "HIGH"), (110.0, "CRITICAL"), (89.0, "CRITICAL")])
def test_tiers(price, severity):
    got = observe([100.0, price])[1]
    assert (got and got[0]) == severity


def test_first_trade_only_sets_the_baseline():
    assert observe([100.0]) == [None]


def test_alert_moves_the_baseline():
    got = observe([100.0, 110.0, 111.0, 121.1])
    assert got[1][1] == 100.0 and got[2] is None and got[3][1] == 110.0


def test_cooldown_is_exclusive_at_sixty_seconds():
    assert observe([100.0, 110.0, 130.0], step=59)[2] is None
    assert observe([100.0, 110.0, 130.0], step=60)[2][0] == "CRITICAL"


def test_expired_baseline_resets_without_alert():
    assert observe([100.0, 150.0], step=301) == [None, None]
    assert observe([100.0, 150.0], step=300)[1][0] == "CRITICAL"


def test_zero_baseline_is_replaced():
    assert observe([0.0, 5.0, 5.5])[1:] == [None, ("CRITICAL", 5.0, 0.1)]


def walk(n, symbols=("AAA", "BBB", "HOT", "HOT", "HOT"), seed=5):
    rng = random.Random(seed)
    at, out, price = 0, [], {}
    for i in range(n):
        at += rng.choice((1, 5, 20, 400 if i % 17 == 0 else 3))
        s = rng.choice(symbols)
        price[s] = round(price.get(s, 100.0) * rng.uniform(0.96, 1.04), 4)
        out.append((s, at, price[s], 1))
    return out


def reference_alerts(items):
    states, out = {}, []
    for s, at, price, _ in items:
        got = states.setdefault(s, Baseline()).observe(price, at * 1_000_000, AlertRules())
        if got:
            out.append((s, got[0], "UP" if price > got[1] else "DOWN", price, got[1], START + timedelta(seconds=at)))
    return sorted(out)


def tuples(df):
    return sorted((r.symbol, r.severity, r.direction, r.price, r.baseline_price, r.timestamp) for r in df.collect())


def test_batch_alerts_equal_a_plain_replay(make_trades):
    items = walk(1500)
    expected = reference_alerts(items)
    assert len(expected) > 50
    assert tuples(price_alerts(make_trades(items).repartition(7))) == expected


@pytest.mark.parametrize("lives,warm", [(1, 0), (2, 1)])
def test_batch_alerts_do_not_depend_on_the_guess(make_trades, lives, warm):
    """Short blocks that start from nothing are mostly misjudged, and mended."""
    items = walk(500, symbols=("HOT", "HOT", "COLD"))
    assert tuples(price_alerts(make_trades(items), lives=lives, warm=warm)) == reference_alerts(items)


def test_a_symbol_without_pauses_is_replayed_in_many_blocks(spark, make_trades):
    """One symbol around the clock is one stretch, cut into blocks that are about even."""
    items = [("HOT", 20 * k, 100 + (k * 7 % 13), 1) for k in range(6000)]
    rows = make_trades(items).select("symbol", "trade_id", "price", F.unix_micros("timestamp").alias("us"))
    blocks = _blocks(with_segments(rows, 300), AlertRules(), LIVES, WARM).groupBy("segment", "block").count().collect()
    sizes = sorted(r["count"] for r in blocks)
    assert len({r.segment for r in blocks}) == 1 and len(blocks) >= 16 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert tuples(price_alerts(make_trades(items))) == reference_alerts(items)


def test_segments_cut_only_at_silence(make_trades):
    trades = make_trades([("A", 0, 1, 1), ("A", 3500, 1, 1), ("A", 3700, 1, 1), ("A", 8000, 1, 1), ("A", 8500, 1, 1), ("B", 0, 1, 1)])
    rows = trades.select("symbol", "trade_id", "price", F.unix_micros("timestamp").alias("us"))
    got = {r.trade_id: r.segment for r in with_segments(rows, 300).collect()}
    assert got == {"T000000": 1, "T000001": 1, "T000002": 1, "T000003": 2, "T000004": 2, "T000005": 1}


@pytest.mark.parametrize("seed", range(12))
def test_replay_equals_trade_by_trade(seed):
    rng = random.Random(seed)
    rules = AlertRules(baseline_seconds=rng.choice((30, 300)), cooldown_seconds=rng.choice((0, 10, 60, 500)))
    n, price, at = 3000, [], []
    p, t = 100.0, 0
    for _ in range(n):
        p = 0.0 if rng.random() < 0.002 else round(max(p, 1.0) * rng.uniform(0.985, 1.015), 4)
        t += rng.choice((0, 100_000, 1_000_000, 40_000_000 if rng.random() < 0.02 else 0, 400_000_000 if rng.random() < 0.005 else 0))
        price.append(p)
        at.append(t)
    one, expected = Baseline(), []
    for i in range(n):
        alert = one.observe(price[i], at[i], rules)
        if alert:
            expected.append((i, *alert))
    many, got = Baseline(), []
    for start in range(0, n, 700):
        part = many.replay(np.array(price[start : start + 700]), np.array(at[start : start + 700]), rules)
        got += [(start + i, *rest) for i, *rest in part]
    assert got == expected and expected
    assert many == one


def message(trades):
    return trades.select(
        F.to_json(
            F.struct(
                F.lit("TradeExecuted").alias("event_type"), "trade_id", "symbol", "price", "quantity",
                F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
            )
        ).alias("value"),
        F.lit("raw.trades").alias("topic"), F.lit(0).alias("partition"),
        F.substring("trade_id", 2, 9).cast("bigint").alias("offset"),
    )


def run(spark, stream, schema, base):
    with pipelines.state_partitions(spark, 2):
        query = pipelines.append_table(stream, f"{base}/out", f"{base}/checkpoint", interval=None)
    query.awaitTermination()
    return spark.read.schema(schema).parquet(f"{base}/out")


ALERTS = "symbol string, severity string, direction string, price double, baseline_price double, pct_change double, timestamp timestamp, alert_type string"


def test_stream_alerts_equal_batch_over_many_batches(spark, make_trades, tmp_path):
    """Three batches, out of order within the watermark; a distant last trade flushes the rest."""
    items = walk(240)
    shuffled = [(i, t) for i, t in enumerate(items)]
    rng = random.Random(1)
    for k in range(0, len(shuffled) - 4, 4):
        chunk = shuffled[k : k + 4]
        rng.shuffle(chunk)
        shuffled[k : k + 4] = chunk
    trades = make_trades(items)
    topic = str(tmp_path / "topic")
    ids = [f"T{i:06d}" for i, _ in shuffled]
    for part in (ids[:80], ids[80:160], ids[160:]):
        kafka.record(message(trades.filter(F.col("trade_id").isin(part))), str(tmp_path / f"p{part[0]}"))
        spark.read.schema(kafka.RECORDED).parquet(str(tmp_path / f"p{part[0]}")).coalesce(1).write.mode("append").parquet(topic)
    last = message(make_trades([("END", 10_000_000, 1, 1)]))
    kafka.record(last, str(tmp_path / "last"))
    spark.read.schema(kafka.RECORDED).parquet(str(tmp_path / "last")).write.mode("append").parquet(topic)
    pipelines.use_rocksdb_state(spark)
    source = kafka.read_recorded(spark, topic, max_files_per_trigger=1)
    timed = aggregates.with_event_time(from_flat_json(source, TRADE_EVENT), "30 minutes")
    got = run(spark, price_alert_stream(timed), ALERTS, tmp_path)
    expected = reference_alerts(items)
    assert expected and tuples(got) == expected


class State(dict):
    """Map state and value state that count what is read and written."""

    def __init__(self):
        self.touched = 0

    def touch(self):
        self.touched += 1

    def containsKey(self, key):
        self.touch()
        return key in self

    def getValue(self, key):
        self.touch()
        return self[key]

    def updateValue(self, key, value):
        self.touch()
        self[key] = value

    def removeKey(self, key):
        self.touch()
        del self[key]

    def exists(self):
        return None in self

    def get(self):
        return self[None]

    def update(self, value):
        self[None] = value


class Handle:
    def __init__(self):
        self.timers, self.states = [], {}

    def getMapState(self, name, *schemas):
        return self.states.setdefault(name, State())

    def getValueState(self, name, schema):
        return self.states.setdefault(name, State())

    def registerTimer(self, at):
        self.timers.append(at)

    def touched(self):
        return sum(s.touched for s in self.states.values())


def test_a_timer_reads_only_its_slot():
    """A day of backlog, arriving in pieces and out of order: every timer costs the same, and alerts are the replay's."""
    import pandas as pd

    rng = random.Random(4)
    trades = [(60_000_000 * (k // 5) + 7_000_000 * (k % 5), f"T{k:06d}", round(100 * rng.uniform(0.9, 1.1), 4)) for k in range(7200)]
    handle, processor = Handle(), AlertProcessor(AlertRules())
    processor.init(handle)
    for part in range(6):
        batch = pd.DataFrame(trades[part::6], columns=["us", "trade_id", "price"]).sample(frac=1, random_state=part)
        processor.handleInputRows(("S",), iter([batch]), None)
    assert len(handle.timers) == len(set(handle.timers)) == 1440
    costs, got = [], []
    for at in sorted(handle.timers):
        before = handle.touched()
        info = type("Info", (), {"getExpiryTimeInMs": lambda self, at=at: at})()
        for found in processor.handleExpiredTimer(("S",), None, info):
            got += found[["price", "baseline_price", "us"]].values.tolist()
        costs.append(handle.touched() - before)
    assert max(costs) <= 2 * 5 + 2 and not handle.states["waiting"] and not handle.states["pieces"]
    state, expected = Baseline(), []
    for us, _, price in trades:
        found = state.observe(price, us, AlertRules())
        if found:
            expected.append([price, found[1], us])
    assert expected and got == expected


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def expire(handle, processor, ms):
    """What the timers that the watermark has passed put out, each removed."""
    got = []
    for at in sorted(t for t in set(handle.timers) if t <= ms):
        info = type("Info", (), {"getExpiryTimeInMs": lambda self, at=at: at})()
        for found in processor.handleExpiredTimer(("S",), Clock(ms), info):
            got += found[["price", "baseline_price", "us"]].values.tolist()
    handle.timers = [t for t in handle.timers if t > ms]
    return got


def plain_alerts(trades):
    state, expected = Baseline(), []
    for us, _, price in sorted(trades):
        found = state.observe(price, us, AlertRules())
        if found:
            expected.append([price, found[1], us])
    return expected


def test_a_long_backlog_waits_in_few_slots():
    """A year of trades, one in four minutes, arriving at once: few timers and few pieces, not one for each minute."""
    import pandas as pd

    rng = random.Random(5)
    trades = [(240_000_000 * k, f"T{k:06d}", round(100 * rng.uniform(0.9, 1.1), 4)) for k in range(131_400)]
    handle, processor = Handle(), AlertProcessor(AlertRules())
    processor.init(handle)
    frame = pd.DataFrame(trades, columns=["us", "trade_id", "price"]).sample(frac=1, random_state=1)
    processor.handleInputRows(("S",), iter([frame[:70_000], frame[70_000:]]), Clock(0))
    assert len(handle.timers) <= 20
    assert expire(handle, processor, 10**12) == plain_alerts(trades)
    assert handle.touched() <= 100 and not handle.states["waiting"] and not handle.states["pieces"]


@pytest.mark.parametrize("seed,held_rows", [(1, 5), (2, 40), (3, 100_000), (4, 40)])
def test_alerts_come_as_the_watermark_passes(seed, held_rows):
    """Trades up to months ahead of a watermark that moves by seconds to weeks: each release ends at its minute, in order."""
    import pandas as pd

    rng = random.Random(seed)
    handle, processor = Handle(), AlertProcessor(AlertRules(), held_rows=held_rows)
    processor.init(handle)
    ms, n, trades, got = 1_704_067_170_000, 0, [], []
    for _ in range(150):
        batch = []
        for _ in range(rng.randrange(1, 60)):
            ahead = rng.choice((10, 100, 4000, 90_000, 9_000_000))
            us = ms * 1000 // 60_000_000 * 60_000_000 + rng.randrange(ahead) * 1_000_000
            batch.append((us, f"T{rng.randrange(10**6):06d}-{n}", round(100 * rng.uniform(0.9, 1.1), 4)))
            n += 1
        trades += batch
        processor.handleInputRows(("S",), iter([pd.DataFrame(batch, columns=["us", "trade_id", "price"])]), Clock(ms))
        ms += rng.choice((1, 20, 61, 3600, 100_000, 700_000)) * 1000
        got += expire(handle, processor, ms)
        limit = ms // 60_000 * 60_000_000
        assert got == plain_alerts(t for t in trades if t[0] < limit)
    got += expire(handle, processor, 10**14)
    assert got == plain_alerts(trades) and not handle.states["waiting"] and not handle.states["pieces"]


def test_the_registered_stream_passes_the_last_trades_of_any_year(spark, tmp_path):
    import shutil

    from tapelake.plans import all_queries
    from tests.conftest import SMALL

    for name in ("region", "nation"):
        shutil.copy(f"{SMALL}/{name}.parquet", tmp_path)
    rows = [(k, START.replace(year=2028) + timedelta(seconds=10 * k), 3, "buy", p, '{"k": 1}') for k, p in enumerate((100.0, 110.0))]
    schema = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    got = all_queries()["st_price_alert_stream"](spark, str(tmp_path))
    assert [(r.severity, r.price, r.timestamp.year) for r in got.collect()] == [("CRITICAL", 110.0, 2028)]


def test_stream_windows_equal_batch(spark, make_trades, tmp_path):
    trades = make_trades(walk(200))
    topic = str(tmp_path / "topic")
    closing = make_trades([("END", 10_000_000, 1, 1)]).withColumn("trade_id", F.lit("T999999"))
    kafka.record(message(trades.unionByName(closing)), topic)
    timed = aggregates.with_event_time(from_flat_json(kafka.read_recorded(spark, topic), TRADE_EVENT))
    schema = "symbol string, window_start timestamp, window_end timestamp, window_size string, trade_count bigint, total_volume bigint, vwap double, high_price double, low_price double"
    stream = run(spark, aggregates.tumbling_all(timed), schema, tmp_path)
    batch = aggregates.tumbling_all(trades.withColumnRenamed("timestamp", "event_time"))
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.select(*stream.columns).collect()))


def test_alert_feed_fields(spark):
    alert = spark.createDataFrame([("A", "HIGH", "UP", 105.0, 100.0, 5.0, START, "price_movement")], ALERTS)
    row = feeds.alert_feed(alert, ["A"]).collect()[0]
    assert (row.triggered_at, row.threshold, row.message) == (START, 5.0, "HIGH A UP 5.00%")
    assert feeds.alert_feed(alert, ["B"]).count() == 0


def test_live_candle_update_mode(spark, make_trades, tmp_path):
    topic = str(tmp_path / "topic")
    kafka.record(message(make_trades([("A", 0, 10, 1), ("A", 30, 12, 2), ("A", 70, 11, 3)])), topic)
    timed = aggregates.with_event_time(from_flat_json(kafka.read_recorded(spark, topic), TRADE_EVENT))
    seen = []
    query = (
        feeds.live_candles(timed).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "c"))
        .foreachBatch(lambda df, _: seen.extend(tuple(r)[2:] for r in df.collect())).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(seen) == [(10.0, 12.0, 10.0, 12.0, 3), (11.0, 11.0, 11.0, 11.0, 3)]


def test_kafka_source_names_its_format(spark):
    """Without the connector the reader fails at load, not before."""
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka.read_topic(spark, "localhost:1", "t")
