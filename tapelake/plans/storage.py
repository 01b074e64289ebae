"""Queries that write: tables, exports and streams. Each writes the trades and returns what a reader finds.

The streams read a topic recorded from the same trades and run until it is exhausted.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tapelake.functions.timing import event_time
from tapelake.operators import gold, ingest, orderbook, silver
from tapelake.plans.analytics import VOLUME, VWAP
from tapelake.plans.charts import SLOW_RULES, _alert_sql
from tapelake.plans.ingestion import ACCEPTED, ACCEPTED_SQL, odd_trade_messages
from tapelake.plans.registry import query
from tapelake.schemas import BOOK_EVENT, BRONZE_ORDERBOOK, BRONZE_TRADES, SILVER_TRADES, SYMBOL_REFERENCE, TRADE_EVENT
from tapelake.session import scratch_folder
from tapelake.sources import compaction, files, kafka
from tapelake.sources.views import PROCESSED_AT
from tapelake.streaming import aggregates, corrections, pipelines
from tapelake.streaming.price_alerts import price_alert_stream

TRADE = "trade_id, symbol, price, quantity"


@query("write_day_partitioned", f"SELECT {TRADE}, timestamp, trading_date AS day FROM trades")
def write_day_partitioned(m):
    path = scratch_folder(m.spark, "trades")
    files.write_by_day(m.trades.select("trade_id", "symbol", "price", "quantity", "timestamp"), f"{path}/t")
    return m.spark.read.parquet(f"{path}/t")


@query(
    "overwrite_partition",
    """SELECT symbol, trading_date, CASE WHEN trading_date = DATE '2024-01-15' THEN 0 ELSE total_volume END AS total_volume FROM gold""",
)
def overwrite_partition(m):
    """Gold written once; then one day replaced, and an empty day replaced by nothing."""
    path = f"{scratch_folder(m.spark, 'gold')}/t"
    bars = m.gold.select("symbol", "trading_date", "total_volume")
    files.overwrite_partitions(bars, path, "trading_date")
    redone = bars.filter("trading_date = date'2024-01-15'").withColumn("total_volume", F.lit(0).cast("bigint"))
    files.overwrite_partitions(redone, path, "trading_date")
    files.overwrite_partitions(bars.filter("trading_date = date'1999-01-01'"), path, "trading_date")
    return m.spark.read.schema("symbol string, total_volume bigint, trading_date date").parquet(path)


@query("gold_job_rerun", "SELECT symbol, trading_date, total_volume, trade_count FROM gold")
def gold_job_rerun(m):
    """All days, then one of them again: the table is the same."""
    path = f"{scratch_folder(m.spark, 'gold-job')}/t"
    gold.run_gold_job(m.trades, path)
    gold.run_gold_job(m.trades, path, day="2024-01-15")
    table = m.spark.read.schema("symbol string, total_volume bigint, trade_count int, trading_date date").parquet(path)
    return table.select("symbol", "trading_date", "total_volume", "trade_count")


@query("export_csv", "SELECT symbol, trading_date, open_price, close_price, total_volume FROM gold")
def export_csv(m):
    path = f"{scratch_folder(m.spark, 'csv')}/t"
    files.export_csv(m.gold.select("symbol", "trading_date", "open_price", "close_price", "total_volume"), path)
    schema = "symbol string, trading_date date, open_price double, close_price double, total_volume bigint"
    return m.spark.read.schema(schema).option("header", True).csv(path)


@query("scan_json_ref", "SELECT symbol, company_name, sector, market_cap_category FROM symbols")
def scan_json_ref(m):
    """The reference written as one JSON array per file, read back as a table."""
    path = f"{scratch_folder(m.spark, 'reference')}/t"
    row = F.struct("symbol", "company_name", "sector", "market_cap_category")
    # One list per sector of the symbol dimension, each in a file of its own.
    arrays = m.symbols.groupBy(F.col("sector").alias("part")).agg(F.to_json(F.collect_list(row)).alias("value"))
    arrays.write.partitionBy("part").text(path)
    return files.read_symbol_reference(m.spark, path).select(*[c.split()[0] for c in SYMBOL_REFERENCE.split(", ")])


def _many_files(m) -> str:
    path = f"{scratch_folder(m.spark, 'many')}/t"
    m.trades.select("trade_id", "symbol", "price", "quantity").repartition(60, "trade_id").write.parquet(path)
    return path


@query(
    "table_stats",
    "SELECT 'trades' AS table_name, 60::BIGINT AS file_count, count(*) AS record_count, true AS needs_compaction FROM trades",
)
def table_stats(m):
    return files.table_stats(m.spark, {"trades": _many_files(m)})


@query(
    "compaction_report",
    """SELECT 'trades' AS table_name, 60::BIGINT AS file_count, count(*) AS record_count, 'rewrite_data_files' AS action FROM trades""",
)
def compaction_report(m):
    """Before compaction the table is reported, after it no longer."""
    source = _many_files(m)
    target = f"{scratch_folder(m.spark, 'compact')}/t"
    files.compact(m.spark, source, target)
    return files.compaction_report(files.table_stats(m.spark, {"trades": source, "compacted": target}))


@query(
    "compaction_packed",
    """SELECT trading_date AS day, count(*) AS row_count, sum(quantity)::BIGINT AS total_quantity, count(DISTINCT trade_id) AS trades,
        true AS few_files FROM trades GROUP BY trading_date""",
)
def compaction_packed(m):
    """A table of many small files a day, packed in its place: the rows stay, the files become few."""
    path, work = f"{scratch_folder(m.spark, 'packed')}/t", scratch_folder(m.spark, "packing")
    trades = m.trades.select("trade_id", "symbol", "quantity", F.to_date("timestamp").alias("day"))
    trades.repartition(6, "trade_id").write.partitionBy("day").parquet(path)
    compaction.compact_in_place(m.spark, path, work, "day")
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    rows = m.spark.read.parquet(path).groupBy("day", name.alias("file")).agg(
        F.count("*").alias("n"), F.sum("quantity").cast("bigint").alias("q"), F.countDistinct("trade_id").alias("t")
    )
    return rows.groupBy("day").agg(
        F.sum("n").alias("row_count"), F.sum("q").alias("total_quantity"), F.sum("t").alias("trades"), (F.count("*") <= 2).alias("few_files")
    )


def recorded_trades(m, replays: bool = False) -> str:
    """The trade topic as files; with ``replays`` every tenth message is there twice."""
    path = f"{scratch_folder(m.spark, 'topic')}/t"
    messages = m.trade_messages
    if replays:
        messages = messages.unionByName(messages.filter("offset % 10 = 0").withColumn("offset", F.col("offset") + 100_000_000))
    kafka.record(messages, path)
    return path


def trade_stream(m, path: str, files_per_trigger: int | None = None):
    return ingest.from_flat_json(kafka.read_recorded(m.spark, path, files_per_trigger), TRADE_EVENT)


def drain(m, stream, schema: str, **options):
    """Append a stream to a table until its source is exhausted, and read the table."""
    base = scratch_folder(m.spark, "stream")
    with pipelines.state_partitions(m.spark):
        running = pipelines.append_table(stream, f"{base}/t", f"{base}/checkpoint", interval=None, **options)
    running.awaitTermination()
    return m.spark.read.schema(schema).parquet(f"{base}/t")


@query("src_kafka_json", f"SELECT {TRADE} FROM trades")
def src_kafka_json(m):
    rows = trade_stream(m, recorded_trades(m)).select("trade_id", "symbol", "price", "quantity")
    return drain(m, rows, "trade_id string, symbol string, price double, quantity int")


@query("sink_kafka_json", f"SELECT symbol AS key, {TRADE} FROM trades")
def sink_kafka_json(m):
    """Trades turned into keyed JSON messages by one stream and read back from them."""
    rows = trade_stream(m, recorded_trades(m)).select("trade_id", "symbol", "price", "quantity")
    sent = drain(m, kafka.to_messages(rows), "key string, value string")
    event = F.from_json("value", "trade_id string, symbol string, price double, quantity int")
    return sent.select("key", event.alias("e")).select("key", "e.*")


@query(
    "bronze_append",
    """SELECT trade_id, symbol, price, quantity, timestamp, trading_date AS day, _kafka_offset FROM trades
UNION ALL SELECT trade_id, symbol, price, quantity, timestamp, trading_date, _kafka_offset + 100000000 FROM trades WHERE _kafka_offset % 10 = 0""",
)
def bronze_append(m):
    """Bronze keeps replays: at least once, no deduplication."""
    base = scratch_folder(m.spark, "bronze")
    source = kafka.read_recorded(m.spark, recorded_trades(m, replays=True))
    pipelines.append_bronze_trades(source, f"{base}/t", f"{base}/checkpoint", interval=None).awaitTermination()
    table = m.spark.read.schema(f"{BRONZE_TRADES}, day date").parquet(f"{base}/t")
    return table.select("trade_id", "symbol", "price", "quantity", "timestamp", "day", "_kafka_offset")


@query("bronze_append_coerced", ACCEPTED_SQL)
def bronze_append_coerced(m):
    """Every readable form of numbers and times through the Bronze stream."""
    base = scratch_folder(m.spark, "bronze-forms")
    kafka.record(odd_trade_messages(m), f"{base}/topic")
    source = kafka.read_recorded(m.spark, f"{base}/topic")
    pipelines.append_bronze_trades(source, f"{base}/t", f"{base}/checkpoint", interval=None).awaitTermination()
    return m.spark.read.schema(f"{BRONZE_TRADES}, day date").parquet(f"{base}/t").select(*ACCEPTED)


@query(
    "bronze_append_orderbook",
    """SELECT symbol, cast(snapshot_ts AS timestamp) AS timestamp, cast(snapshot_ts AS date) AS day,
       cast(CASE WHEN extract(day FROM snapshot_ts) % 2 = 0 THEN extract(day FROM snapshot_ts) ELSE 0 END AS int) AS sequence_number
FROM book_levels GROUP BY symbol, snapshot_ts""",
)
def bronze_append_orderbook(m):
    base = scratch_folder(m.spark, "bronze-books")
    kafka.record(m.book_messages, f"{base}/topic")
    source = kafka.read_recorded(m.spark, f"{base}/topic")
    pipelines.append_bronze_orderbooks(source, f"{base}/t", f"{base}/checkpoint", interval=None).awaitTermination()
    table = m.spark.read.schema(f"{BRONZE_ORDERBOOK}, day date").parquet(f"{base}/t")
    return table.select("symbol", "timestamp", "day", "sequence_number")


SILVER_JOB_SQL = f"SELECT {TRADE}, timestamp, trading_date AS day FROM trades"
SILVER_JOB = ("trade_id", "symbol", "price", "quantity", "timestamp", "day")


@query("silver_job_rerun", SILVER_JOB_SQL)
def silver_job_rerun(m):
    """Part of Bronze, then all of it with its replays, then all of it again."""
    path = f"{scratch_folder(m.spark, 'silver-job')}/t"
    part = m.bronze_trades.filter("_kafka_offset < 100000000 AND _kafka_offset % 4 <> 1")
    for bronze in (part, m.bronze_trades, m.bronze_trades):
        silver.run_silver_job(bronze, m.dim_symbol, path, processed_at=PROCESSED_AT)
    return m.spark.read.schema(f"{SILVER_TRADES}, day date").parquet(path).select(*SILVER_JOB)


@query("st_silver_stream", SILVER_JOB_SQL)
def st_silver_stream(m):
    """Every tenth trade arrives once more when all days have passed, later than any watermark would remember."""
    base = scratch_folder(m.spark, "silver-stream")
    topic = f"{base}/topic"

    def run():
        source = kafka.read_recorded(m.spark, topic)
        pipelines.silver_stream(source, m.dim_symbol, f"{base}/t", f"{base}/checkpoint", interval=None).awaitTermination()

    kafka.record(m.trade_messages, topic)
    run()
    replays = m.trade_messages.filter("offset % 10 = 0").withColumn("offset", F.col("offset") + 100_000_000)
    kafka.record(replays, f"{base}/more")
    m.spark.read.schema(kafka.RECORDED).parquet(f"{base}/more").write.mode("append").parquet(topic)
    run()
    return m.spark.read.schema(f"{SILVER_TRADES}, day date").parquet(f"{base}/t").select(*SILVER_JOB)


@query("sample_hashed", f"SELECT {TRADE} FROM trades WHERE substr(md5(trade_id), 1, 8) < '40000000'")
def sample_hashed(m):
    return files.sample_hashed(m.trades, "trade_id", 0.25).select("trade_id", "symbol", "price", "quantity")


@query("st_event_time", "SELECT trade_id, date_trunc('millisecond', timestamp) AS event_time FROM trades")
def st_event_time(m):
    rows = aggregates.with_event_time(trade_stream(m, recorded_trades(m))).select("trade_id", "event_time")
    return drain(m, rows, "trade_id string, event_time timestamp")


@query(
    "st_tumble_stream",
    f"""WITH timed AS (SELECT *, date_trunc('millisecond', timestamp) AS et FROM trades)
SELECT symbol, time_bucket(INTERVAL '5 minutes', et) AS window_start, time_bucket(INTERVAL '5 minutes', et) + INTERVAL '5 minutes' AS window_end,
       '5m' AS window_size, count(*) AS trade_count, {VOLUME} AS total_volume, {VWAP} AS vwap,
       max(price) AS high_price, min(price) AS low_price
FROM timed GROUP BY 1, 2, 3 HAVING window_end <= (SELECT max(et) - INTERVAL 5 SECOND FROM timed)""",
)
def st_tumble_stream(m):
    """Windows the watermark has closed, each sent once."""
    windows = aggregates.tumbling(aggregates.with_event_time(trade_stream(m, recorded_trades(m))), "5m")
    schema = (
        "symbol string, window_start timestamp, window_end timestamp, window_size string, trade_count bigint, "
        "total_volume bigint, vwap double, high_price double, low_price double"
    )
    return drain(m, windows, schema)


@query(
    "st_enrich_stream",
    """SELECT t.trade_id, t.symbol, coalesce(d.sector, 'Unknown') AS sector, coalesce(d.market_cap_category, 'Unknown') AS market_cap_category
FROM trades t LEFT JOIN symbols d ON d.symbol = t.symbol AND d.symbol_key % 5 <> 0""",
)
def st_enrich_stream(m):
    rows = trade_stream(m, recorded_trades(m)).select("trade_id", "symbol")
    enriched = silver.enrich_or_unknown(rows, m.symbols.filter("symbol_key % 5 <> 0"))
    wanted = enriched.select("trade_id", "symbol", "sector", "market_cap_category")
    return drain(m, wanted, "trade_id string, symbol string, sector string, market_cap_category string")


@query("st_dedup", "SELECT DISTINCT trade_id, symbol, price FROM trades")
def st_dedup(m):
    """Replays removed within the watermark."""
    timed = aggregates.with_event_time(trade_stream(m, recorded_trades(m, replays=True)), "1 hour")
    rows = pipelines.deduplicate(timed).select("trade_id", "symbol", "price")
    return drain(m, rows, "trade_id string, symbol string, price double")


@query(
    "st_multi_output",
    """SELECT 'all' AS output, trade_id, price FROM trades UNION ALL SELECT 'blocks', trade_id, price FROM trades WHERE quantity >= 500""",
)
def st_multi_output(m):
    base = scratch_folder(m.spark, "fan")
    outputs = {
        "all": (lambda df: df, f"{base}/all"),
        "blocks": (lambda df: df.filter("quantity >= 500"), f"{base}/blocks"),
    }
    source = trade_stream(m, recorded_trades(m)).select("trade_id", "price", "quantity")
    pipelines.fan_out(source, outputs, f"{base}/checkpoint", interval=None).awaitTermination()
    schema = "trade_id string, price double, quantity int, batch_id bigint"
    read = [m.spark.read.schema(schema).parquet(path).withColumn("output", F.lit(name)) for name, (_, path) in outputs.items()]
    return read[0].unionByName(read[1]).select("output", "trade_id", "price")


@query(
    "st_late_data",
    """SELECT trade_id, CASE WHEN trading_date >= DATE '2024-01-20' OR _kafka_offset % 10 <> 0 THEN 'on_time' ELSE 'late' END AS arrival FROM trades""",
)
def st_late_data(m):
    """Every tenth trade before the 20th arrives in a second batch, after the rest."""
    base = scratch_folder(m.spark, "late")
    late = (F.col("offset") % 10 == 0) & (F.get_json_object("value", "$.timestamp") < "2024-01-20")
    topic = f"{base}/topic"
    kafka.record(m.trade_messages.filter(~late), topic)

    def run():
        rows = trade_stream(m, topic).select("trade_id", event_time("timestamp").alias("event_time"))
        pipelines.split_late(
            rows, f"{base}/on_time", f"{base}/late", f"{base}/progress", f"{base}/checkpoint", interval=None
        ).awaitTermination()

    run()
    more = f"{base}/more"
    kafka.record(m.trade_messages.filter(late), more)
    m.spark.read.schema(kafka.RECORDED).parquet(more).write.mode("append").parquet(topic)
    run()
    schema = "trade_id string, event_time timestamp, batch_id bigint"
    parts = [
        m.spark.read.schema(schema).parquet(f"{base}/{name}").select("trade_id", F.lit(name).alias("arrival"))
        for name in ("on_time", "late")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "st_late_corrections",
    f"""WITH told AS (SELECT *, _kafka_offset % 10 = 0 AND timestamp < TIMESTAMP '2024-01-20' AS late FROM trades)
SELECT symbol, time_bucket(INTERVAL '15 minutes', timestamp) AS window_start, count(*) AS trade_count, {VOLUME} AS total_volume,
       {VWAP} AS vwap, max(price) AS high_price, min(price) AS low_price, CASE WHEN bool_or(late) AND bool_or(NOT late) THEN 2 ELSE 1 END AS version
FROM told GROUP BY 1, 2
HAVING time_bucket(INTERVAL '15 minutes', min(timestamp)) + INTERVAL '15 minutes' <= (SELECT date_trunc('millisecond', max(timestamp)) FROM trades) - INTERVAL '5 seconds'""",
)
def st_late_corrections(m):
    """Every tenth trade before the 20th arrives in a second batch: its window, put out before, is put out again."""
    base = scratch_folder(m.spark, "corrections")
    late = (F.col("offset") % 10 == 0) & (F.get_json_object("value", "$.timestamp") < "2024-01-20")
    topic = f"{base}/topic"
    for k, part in enumerate((~late, late)):
        more = f"{base}/part{k}"
        kafka.record(m.trade_messages.filter(part), more)
        m.spark.read.schema(kafka.RECORDED).parquet(more).write.mode("append").parquet(topic)
        rows = trade_stream(m, topic).select("symbol", "price", "quantity", event_time("timestamp").alias("event_time"))
        corrections.corrected_windows(
            rows, "15m", f"{base}/changes", f"{base}/too_late", f"{base}/state", f"{base}/checkpoint", lateness="400 days", interval=None
        ).awaitTermination()
    found = corrections.latest(m.spark.read.schema(corrections.CHANGES).parquet(f"{base}/changes"))
    return found.select("symbol", "window_start", "trade_count", "total_volume", "vwap", "high_price", "low_price", "version")


@query("st_checkpoint", f"SELECT {TRADE} FROM trades")
def st_checkpoint(m):
    """The stream is stopped half way and started again; the checkpoint makes the second run take up the rest only."""
    base = scratch_folder(m.spark, "restart")
    topic = f"{base}/topic"
    for part in (F.col("offset") % 2 == 0, F.col("offset") % 2 == 1):
        half = f"{scratch_folder(m.spark, 'half')}/t"
        kafka.record(m.trade_messages.filter(part), half)
        m.spark.read.schema(kafka.RECORDED).parquet(half).write.mode("append").parquet(topic)
        rows = trade_stream(m, topic).select("trade_id", "symbol", "price", "quantity")
        pipelines.append_table(rows, f"{base}/t", f"{base}/checkpoint", interval=None).awaitTermination()
    return m.spark.read.schema("trade_id string, symbol string, price double, quantity int").parquet(f"{base}/t")


@query("st_price_alert_stream", _alert_sql(21600, 3600).replace("FROM trades),\nwalk", "FROM (SELECT trade_id, symbol, price, date_trunc('millisecond', timestamp) AS timestamp FROM trades)),\nwalk"))
def st_price_alert_stream(m):
    """The stateful detector; a last trade of a symbol nobody reads lets the watermark pass all others."""
    topic = recorded_trades(m)
    closing = (
        m.trade_messages.orderBy(F.desc("offset"))
        .limit(1)
        .withColumn("value", F.regexp_replace("value", '"timestamp":"[0-9]+', '"timestamp":"2260'))
        .withColumn("value", F.regexp_replace("value", '"symbol":"[^"]*"', '"symbol":"END"'))
    )
    more = f"{scratch_folder(m.spark, 'closing')}/t"
    kafka.record(closing, more)
    m.spark.read.schema(kafka.RECORDED).parquet(more).write.mode("append").parquet(topic)
    timed = aggregates.with_event_time(trade_stream(m, topic), "5 seconds")
    schema = (
        "symbol string, severity string, direction string, price double, baseline_price double, pct_change double, "
        "timestamp timestamp, alert_type string"
    )
    with pipelines.rocksdb_state(m.spark):
        return drain(m, price_alert_stream(timed, SLOW_RULES), schema)


@query(
    "st_orderbook_stream",
    """SELECT symbol, snapshot_ts::TIMESTAMP AS timestamp, cast(count(*) FILTER (WHERE side = 'BID') AS int) AS bid_levels,
       cast(count(*) FILTER (WHERE side = 'ASK') AS int) AS ask_levels FROM book_levels GROUP BY 1, 2""",
)
def st_orderbook_stream(m):
    """Snapshot messages through the stream form of the analyzer."""
    path = f"{scratch_folder(m.spark, 'books')}/t"
    kafka.record(m.book_messages, path)
    books = ingest.from_flat_json(kafka.read_recorded(m.spark, path), BOOK_EVENT)
    metrics = orderbook.orderbook_metrics(books.withColumn("timestamp", event_time("timestamp")))
    wanted = metrics.select("symbol", "timestamp", "bid_levels", "ask_levels")
    return drain(m, wanted, "symbol string, timestamp timestamp, bid_levels int, ask_levels int")
