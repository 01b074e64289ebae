"""Ingestion: decode, validate, route and flatten feed messages, and parse flat events into Bronze.

Messages arrive as ``value`` text holding ``{"event_type", "data"}``. Decoding parses the text once into a VARIANT, and
the payload once into a struct with a VARIANT per known field; every later step reads that struct.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.functions.timing import parse_iso, ts_literal
from tapelake.schemas import BRONZE_ORDERBOOK, BRONZE_TRADES, TRADE_EVENT, column_names

# Routing of event types.
ROUTES = {
    "OrderPlaced": ("raw.orders", "symbol"),
    "OrderCancelled": ("raw.orders", "symbol"),
    "TradeExecuted": ("raw.trades", "symbol"),
    "QuoteUpdate": ("raw.quotes", "symbol"),
    "OrderBookSnapshot": ("raw.orderbook-snapshots", "symbol"),
    "MarketStats": ("raw.market-stats", "symbol"),
    "TradingHalt": ("raw.trading-halts", "symbol"),
    "TradingResume": ("raw.trading-halts", "symbol"),
    "AgentAction": ("raw.agent-actions", "agent_id"),
}
DLQ_TOPIC = "dlq.raw.failed"
JSON_ERROR = "json_decode_error"
VALIDATION_ERROR = "validation_error"

# Enumerations of the event models.
SIDES = ("Buy", "Sell")
ORDER_TYPES = ("Market", "Limit")
AGENT_TYPES = ("RetailTrader", "InstitutionalInvestor", "MarketMaker", "HighFrequencyTrader")
HALT_LEVELS = (1, 2, 3)
BOOL_TEXT = ("0", "off", "f", "false", "n", "no", "1", "on", "t", "true", "y", "yes")
TRUE_TEXT = ("1", "on", "t", "true", "y", "yes")


@dataclass(frozen=True)
class Field:
    """One field of an event: its kind, and what else is allowed there."""

    name: str
    kind: str = "str"
    allowed: tuple = ()
    nullable: bool = False
    default: object = None

    @property
    def may_be_missing(self) -> bool:
        return self.nullable or self.default is not None


def _strings(*names: str) -> list[Field]:
    return [Field(name) for name in names]


def _numbers(kind: str, *names: str) -> list[Field]:
    return [Field(name, kind) for name in names]


_HEADER = _strings("event_id", "timestamp")

# The fields of the nine event types.
EVENTS: dict[str, list[Field]] = {
    "OrderPlaced": [
        *_HEADER, *_strings("order_id", "symbol"), Field("side", allowed=SIDES), Field("order_type", allowed=ORDER_TYPES),
        Field("price", "float", nullable=True), Field("quantity", "int"), Field("agent_id"),
        Field("agent_type", allowed=AGENT_TYPES),
    ],
    "OrderCancelled": [
        *_HEADER, *_strings("order_id", "symbol"), Field("side", allowed=SIDES), Field("price", "float"),
        Field("remaining_quantity", "int"), *_strings("agent_id", "reason"),
    ],
    "TradeExecuted": [
        *_HEADER, *_strings("trade_id", "symbol"), Field("price", "float"), Field("quantity", "int"),
        *_strings("buy_order_id", "sell_order_id", "buyer_agent_id", "seller_agent_id"), Field("is_aggressive_buy", "bool"),
    ],
    "QuoteUpdate": [
        *_HEADER, Field("symbol"), Field("best_bid", "float", nullable=True), Field("best_bid_size", "int", default=0),
        Field("best_ask", "float", nullable=True), Field("best_ask_size", "int", default=0),
        Field("spread", "float", nullable=True),
    ],
    "OrderBookSnapshot": [
        *_HEADER, Field("symbol"), Field("bids", "levels"), Field("asks", "levels"),
        Field("sequence_number", "int", nullable=True),
    ],
    "MarketStats": [
        *_HEADER, Field("symbol"), *_numbers("float", "open", "high", "low", "close"),
        *_numbers("long", "volume", "trade_count"), Field("vwap", "float"),
    ],
    "TradingHalt": [
        *_strings("symbol", "reason"), Field("level", "int", allowed=HALT_LEVELS),
        *_numbers("float", "trigger_price", "reference_price", "decline_pct"), Field("halt_duration_secs", "int"),
    ],
    "TradingResume": [
        *_strings("symbol", "halted_at"), Field("halt_duration_secs", "int"), Field("level", "int", allowed=HALT_LEVELS),
    ],
    "AgentAction": [
        *_HEADER, Field("agent_id"), Field("agent_type", allowed=AGENT_TYPES), *_strings("symbol", "action"),
        Field("decision_factors", "strings"),
    ],
}

_SQL_TYPE = {"str": "string", "float": "double", "bool": "boolean"}
#: Whole numbers must fit the columns they end in.
_WHOLE_TYPE = {"int": "int", "long": "bigint"}
NUMBER = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)\s*$|^(true|false)$"
DIGITS = r"^\s*[+-]?\d+\s*$"


def _get(v: Column, path: str, target: str) -> Column:
    return F.try_variant_get(v, path, target)


def _is_string(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def _is_number(v: Column) -> Column:
    """Numbers, numeric text and booleans, as lax validation takes them."""
    return _get(v, "$", "double").isNotNull() & _get(v, "$", "string").rlike(NUMBER)


def _whole(text: Column, number: Column, target: str) -> Column:
    """A whole number given as text and as a double; NULL if it isn't whole or does not fit. Digits are read as such, as
    a double holds no more than 15 of them."""
    return F.when(text.rlike(DIGITS), F.trim(text).try_cast(target)).when(
        text.rlike(NUMBER) & (number == F.floor(number)), number.try_cast(target)
    )


def _whole_value(v: Column, target: str) -> Column:
    return _whole(_get(v, "$", "string"), _get(v, "$", "double"), target)


def _all_present(items: Column, check) -> Column:
    return items.isNotNull() & F.coalesce(F.forall(items, check), F.lit(False))


def _level_ok(v: Column) -> Column:
    count = _get(v, "$.order_count", "variant")
    return (
        _is_number(_get(v, "$.price", "variant"))
        & _whole_value(_get(v, "$.quantity", "variant"), "int").isNotNull()
        & (count.isNull() | _whole_value(count, "int").isNotNull())
    )


def field_ok(data: Column, field: Field) -> Column:
    """Whether the field of a payload passes; never NULL."""
    v = data[field.name]
    if field.kind == "str":
        ok = _is_string(v)
        if field.allowed:
            ok = ok & _get(v, "$", "string").isin(*field.allowed)
    elif field.kind == "float":
        ok = _is_number(v)
    elif field.kind in _WHOLE_TYPE:
        ok = _whole_value(v, _WHOLE_TYPE[field.kind]).isNotNull()
        if field.allowed:
            ok = ok & _get(v, "$", "double").isin(*[float(x) for x in field.allowed])
    elif field.kind == "bool":
        ok = F.lower(_get(v, "$", "string")).isin(*BOOL_TEXT)
    elif field.kind == "levels":
        ok = _all_present(_get(v, "$", "array<variant>"), _level_ok)
    else:
        ok = _all_present(_get(v, "$", "array<variant>"), _is_string)
    ok = F.coalesce(ok, F.lit(False))
    if field.may_be_missing:
        ok = v.isNull() | ok
    if field.nullable:
        ok = F.coalesce(F.is_variant_null(v), F.lit(False)) | ok
    return ok


def field_value(data: Column, field: Field) -> Column:
    """The coerced value of a valid field."""
    v = data[field.name]
    if field.kind == "bool":
        value = F.lower(_get(v, "$", "string")).isin(*TRUE_TEXT)
    elif field.kind in _WHOLE_TYPE:
        value = _whole_value(v, _WHOLE_TYPE[field.kind])
    elif field.kind == "levels":
        value = F.transform(
            _get(v, "$", "array<variant>"),
            lambda level: F.struct(
                _get(level, "$.price", "double").alias("price"),
                _whole_value(_get(level, "$.quantity", "variant"), "int").alias("quantity"),
                F.coalesce(_whole_value(_get(level, "$.order_count", "variant"), "int"), F.lit(0)).alias("order_count"),
            ),
        )
    elif field.kind == "strings":
        value = _get(v, "$", "array<string>")
    else:
        value = _get(v, "$", _SQL_TYPE[field.kind])
    return value if field.default is None else F.coalesce(value, F.lit(field.default))


_PAYLOAD = "struct<" + ",".join(f"{name}:variant" for name in sorted({f.name for fs in EVENTS.values() for f in fs})) + ">"


def _computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters cannot be pushed below.

    A filter on something derived from the parsed text would otherwise be rewritten in terms of the text, and parse it
    again for every field it looks at. Filters do not move below a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def decode(messages: DataFrame) -> DataFrame:
    """Parse the text: ``status`` is ``bad_json``, ``skipped`` (no event type, like a greeting) or ``decoded``."""
    parsed = _computed_once(messages, "_doc", F.try_parse_json("value"))
    doc = F.col("_doc")
    kind = _get(doc, "$.event_type", "variant")
    status = F.when(doc.isNull(), "bad_json").when(kind.isNull(), "skipped").otherwise("decoded")
    head = F.struct(
        status.alias("status"),
        F.when(_is_string(kind), _get(doc, "$.event_type", "string")).alias("event_type"),
        _get(doc, "$.data", _PAYLOAD).alias("data"),
    )
    return _computed_once(parsed, "_head", head).select(*messages.columns, "_head.*")


def validate(decoded: DataFrame) -> DataFrame:
    """Add ``is_valid`` and ``error`` by the rules of each row's event type; skipped rows have neither error nor claim."""
    data = F.col("data")
    by_type = None
    for event_type, fields in EVENTS.items():
        ok = reduce(lambda a, b: a & b, [field_ok(data, f) for f in fields])
        is_type = F.col("event_type") == event_type
        by_type = F.when(is_type, ok) if by_type is None else by_type.when(is_type, ok)
    valid = (F.col("status") == "decoded") & F.coalesce(by_type.otherwise(False), F.lit(False))
    error = F.when(F.col("status") == "bad_json", JSON_ERROR).when(
        (F.col("status") == "decoded") & ~F.col("is_valid"), VALIDATION_ERROR
    )
    return decoded.withColumn("is_valid", valid).withColumn("error", error)


def route(events: DataFrame) -> DataFrame:
    """Add the topic and key of each event; unknown types go to the dead-letter topic without a key."""
    topics = F.create_map(*[F.lit(x) for kind, (topic, _) in ROUTES.items() for x in (kind, topic)])
    keyed_by_agent = [kind for kind, (_, key) in ROUTES.items() if key == "agent_id"]
    data = F.col("data")
    key = F.when(F.col("event_type").isin(*keyed_by_agent), _get(data["agent_id"], "$", "string")).when(
        F.col("event_type").isin(*ROUTES), _get(data["symbol"], "$", "string")
    )
    topic = F.coalesce(F.try_element_at(topics, F.coalesce("event_type", F.lit(""))), F.lit(DLQ_TOPIC))
    return events.withColumns({"topic": topic, "key": key})


def flatten(valid: DataFrame) -> DataFrame:
    """Add ``flat``: the event type and its coerced fields as one JSON object, NULL fields included."""
    data = F.col("data")
    flat = None
    for event_type, fields in EVENTS.items():
        body = F.struct(F.lit(event_type).alias("event_type"), *[field_value(data, f).alias(f.name) for f in fields])
        text = F.to_json(body, {"ignoreNullFields": "false"})
        is_type = F.col("event_type") == event_type
        flat = F.when(is_type, text) if flat is None else flat.when(is_type, text)
    return valid.withColumn("flat", flat)


def dead_letters(validated: DataFrame) -> DataFrame:
    """Envelopes for what failed to decode or validate."""
    return validated.filter(F.col("error").isNotNull()).withColumn(
        "envelope", F.to_json(F.struct("error", F.col("value").alias("original_message")))
    )


def bridge(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The whole bridge: routed flat events (topic, key, value), and dead letters (topic, key, value)."""
    validated = validate(decode(messages.drop("topic", "key")))
    good = flatten(route(validated.filter("is_valid"))).select("topic", "key", F.col("flat").alias("value"))
    bad = dead_letters(validated).select(
        F.lit(DLQ_TOPIC).alias("topic"), F.lit(None).cast("string").alias("key"), F.col("envelope").alias("value")
    )
    return good, bad


def from_flat_json(messages: DataFrame, schema: str) -> DataFrame:
    """Typed columns of flat events beside their source position; missing fields are NULL, broken text is dropped."""
    kept = [c for c in ("topic", "partition", "offset") if c in messages.columns]
    parsed = messages.select(*kept, F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("event"))
    return parsed.filter(F.col("event").isNotNull()).select(*kept, "event.*")


def _lineage(ingested_at: str | None) -> dict[str, Column]:
    return {
        "_kafka_topic": F.col("topic"),
        "_kafka_partition": F.col("partition"),
        "_kafka_offset": F.col("offset"),
        "_ingested_at": ts_literal(ingested_at) if ingested_at else F.current_timestamp(),
    }


_LEVELS = "array<struct<price:string,quantity:string,order_count:string>>"
TRADE_TEXT = ", ".join(f"{name} string" for name in column_names(TRADE_EVENT))
BOOK_TEXT = f"event_type string, event_id string, timestamp string, symbol string, bids {_LEVELS}, asks {_LEVELS}, sequence_number string"


def _number_of(text: Column) -> Column:
    """A finite number from text, as numbers and quoted numbers both arrive; NULL otherwise."""
    number = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.when(F.abs(number) < float("inf"), number)


def _whole_of(text: Column, target: str) -> Column:
    return _whole(text, _number_of(text), target)


def _flag_of(text: Column) -> Column:
    return F.when(F.lower(text).isin(*TRUE_TEXT), True).when(F.lower(text).isin(*BOOL_TEXT), False)


def _with_reason(messages: DataFrame, text_schema: str, values: dict[str, Column], needed: list[str]) -> DataFrame:
    """Fields as text, ``values`` over them under their own names, and ``reason``: why a message cannot enter Bronze, or
    NULL. ``needed`` values must be there; what is there must be readable."""
    kept = [c for c in ("topic", "partition", "offset") if c in messages.columns]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    parsed = messages.select(*kept, "value", F.from_json("value", f"{text_schema}, _broken string", options).alias("event"))
    rows = parsed.select(*kept, "value", F.col("event").isNull().alias("_none"), "event.*")
    reason = F.when(F.col("_none") | F.col("_broken").isNotNull(), F.lit("bad_json"))
    for name in needed:
        reason = reason.when(F.col(name).isNull(), F.lit(f"missing_{name}"))
    for name, value in values.items():
        reason = reason.when(F.col(name).isNotNull() & value.isNull(), F.lit(f"bad_{name}"))
    return rows.withColumns({**values, "reason": reason}).drop("_none", "_broken")


def read_trades(messages: DataFrame) -> DataFrame:
    """Every flat trade message with its coerced fields and ``reason``, NULL where it can enter Bronze."""
    values = {
        "price": _number_of(F.col("price")),
        "quantity": _whole_of(F.col("quantity"), "int"),
        "is_aggressive_buy": _flag_of(F.col("is_aggressive_buy")),
        "timestamp": parse_iso("timestamp"),
    }
    return _with_reason(messages, TRADE_TEXT, values, ["trade_id", "symbol", "price", "quantity", "timestamp"])


def read_orderbooks(messages: DataFrame) -> DataFrame:
    """Every flat snapshot message with its coerced fields and ``reason``, NULL where it can enter Bronze. A level with
    an unreadable number makes its snapshot unreadable."""

    def levels(name: str) -> Column:
        def readable(text: Column, value: Column) -> Column:
            return text.isNull() | value.isNotNull()

        whole = F.transform(
            F.col(name),
            lambda v: F.struct(
                _number_of(v["price"]).alias("price"),
                _whole_of(v["quantity"], "int").alias("quantity"),
                _whole_of(v["order_count"], "int").alias("order_count"),
            ),
        )
        fine = F.forall(
            F.arrays_zip(F.col(name).alias("text"), whole.alias("value")),
            lambda z: readable(z["text"]["price"], z["value"]["price"])
            & readable(z["text"]["quantity"], z["value"]["quantity"])
            & readable(z["text"]["order_count"], z["value"]["order_count"]),
        )
        return F.when(fine, whole)

    values = {
        "bids": levels("bids"),
        "asks": levels("asks"),
        "sequence_number": _whole_of(F.col("sequence_number"), "int"),
        "timestamp": parse_iso("timestamp"),
    }
    return _with_reason(messages, BOOK_TEXT, values, ["symbol", "timestamp"])


def rejects(read: DataFrame) -> DataFrame:
    """``(topic, partition, offset, value, reason)`` of the messages that cannot enter Bronze."""
    return read.filter(F.col("reason").isNotNull()).select("topic", "partition", "offset", "value", "reason")


def parse_trades(messages: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Flat trade JSON to the Bronze layout; ``rejects(read_trades(messages))`` are the messages left out."""
    rows = read_trades(messages).filter(F.col("reason").isNull())
    return rows.withColumns(_lineage(ingested_at)).select(*column_names(BRONZE_TRADES))


def parse_orderbooks(messages: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Flat snapshot JSON to the Bronze layout: sides as JSON text, a missing sequence number as 0;
    ``rejects(read_orderbooks(messages))`` are the messages left out."""
    empty = F.lit("[]")
    rows = read_orderbooks(messages).filter(F.col("reason").isNull()).withColumns(
        {
            **_lineage(ingested_at),
            "bids_json": F.coalesce(F.to_json("bids"), empty),
            "asks_json": F.coalesce(F.to_json("asks"), empty),
            "sequence_number": F.coalesce("sequence_number", F.lit(0)),
        }
    )
    return rows.select(*column_names(BRONZE_ORDERBOOK))
