"""Raw exchange messages to typed candles.

Each line is parsed once, by one ``from_json`` over a schema that keeps the
kline as a ``map<string,string>``: map keys are case-sensitive, so ``t`` and
``T`` stay apart, and every numeric field is then a ``try_cast`` of a map value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.functions.columns import epoch_ms, split_list, stream_name
from wickwork.schemas import (
    CANDLE_COLUMNS,
    DEFAULT_EXCHANGE,
    DEFAULT_INTERVAL,
    DEFAULT_SYMBOL,
    KLINE,
    KLINE_FIELDS,
    LINE_SCHEMA,
    MESSAGE_SCHEMA,
    POSITIONAL_FIELDS,
)

INTERVAL_MS = {"s": 1_000, "m": 60_000, "h": 3_600_000, "d": 86_400_000, "w": 604_800_000}
CLOSED, IN_PROGRESS, OTHER, REJECTED = "closed", "in_progress", "other", "rejected"
_PARSE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"}


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Newline-delimited text as one ``value`` column."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same as a stream over files as they arrive."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def parse_lines(lines: DataFrame) -> DataFrame:
    """One parse per line; other columns are carried along. ``readable`` says
    whether the line is one JSON object and nothing else.

    The line is parsed as the only element of an array inside an object with an
    end mark: text after the first object, or a second object, then breaks the
    parse, adds an element or hides the mark. ``inline`` of a one-element array
    keeps later filters above the parse, so the optimizer cannot copy the parse
    into the filter and run it twice.
    """
    carried = [c for c in lines.columns if c != "value"]
    closed_in = F.concat(F.lit('{"line":['), F.col("value"), F.lit('],"end":1}'))
    schema = f"line array<struct<{LINE_SCHEMA}>>, end int, malformed string"
    parsed = lines.select(*carried, "value", F.inline(F.array(F.from_json(closed_in, schema, _PARSE))))
    whole = F.col("malformed").isNull() & F.col("end").isNotNull() & (F.size("line") == 1)
    readable = F.coalesce(whole & F.get("line", F.lit(0)).isNotNull(), F.lit(False))
    return parsed.select(
        *carried, "value", readable.alias("readable"), F.inline_outer(F.slice("line", 1, 1))
    )


def split_malformed(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(parsed, quarantine)``: unreadable lines are kept, never raised on."""
    parsed = parse_lines(lines)
    good = parsed.where("readable").drop("readable")
    return good, parsed.where(~F.col("readable")).select(F.col("value").alias("line"))


def unwrap_envelope(lines: DataFrame) -> DataFrame:
    """``{stream, data}`` or bare message text to ``(stream, value)``."""
    stream = F.get_json_object("value", "$.stream")
    body = F.when(stream.isNotNull(), F.get_json_object("value", "$.data"))
    carried = [c for c in lines.columns if c != "value"]
    return lines.select(
        *carried, stream.alias("stream"), F.coalesce(body, F.col("value")).alias("value")
    )


def arrived(
    lines: DataFrame,
    exchange: str = DEFAULT_EXCHANGE,
    arrival: Column | None = None,
) -> DataFrame:
    """Every line as one row of ``LANDED_SCHEMA``, whatever it holds.

    ``kind`` is ``closed`` or ``in_progress`` for klines, ``other`` for other
    events and ``rejected`` for lines that are not one JSON object; these keep
    their text in ``line`` and have no message. Stored records keep their own
    arrival; else it is ``arrival``, by default the time of the query run.
    """
    arrival = F.current_timestamp() if arrival is None else arrival
    stored = F.col("event_type").isNotNull() & F.col("data").isNotNull()
    wrapped = F.col("stream").isNotNull() | stored
    event = F.coalesce("event_type", F.col("data.e"), "e")
    flag = F.coalesce(F.col("data.k"), F.col("k")).getItem("x").try_cast("boolean")
    kind = (
        F.when(~F.col("readable"), REJECTED)
        .when(F.coalesce(event != KLINE, F.lit(True)), OTHER)
        .when(F.coalesce(flag, F.lit(False)), CLOSED)
        .otherwise(IN_PROGRESS)
    )
    body = F.when(wrapped, F.get_json_object("value", "$.data")).otherwise(F.col("value"))
    message = {
        "event_type": event,
        "symbol": F.coalesce(F.col("data.s"), F.col("data.symbol"), "s", "symbol", F.lit("unknown")),
        "exchange": F.coalesce(F.when(stored, F.col("exchange")), F.lit(exchange)),
        "data": body,
        "received_at": F.coalesce(
            F.when(stored, F.col("received_at").try_cast("double")),
            F.unix_micros("arrival") / F.lit(1e6),
        ),
        "client_timestamp": F.coalesce(
            F.when(stored, F.col("client_timestamp")),
            F.date_format("arrival", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        ),
    }
    return parse_lines(lines.select("value", arrival.alias("arrival"))).select(
        kind.alias("kind"),
        *[F.when(F.col("readable"), c).alias(name) for name, c in message.items()],
        "arrival",
        F.when(~F.col("readable"), F.col("value")).alias("line"),
    )


def normalise(
    lines: DataFrame,
    exchange: str = DEFAULT_EXCHANGE,
    arrival: Column | None = None,
) -> DataFrame:
    """Socket messages, wrapped or bare, to the stored message shape."""
    rows = arrived(lines, exchange, arrival)
    return rows.where(F.col("kind") != REJECTED).select(*MESSAGE_SCHEMA.names)


def closed_messages(lines: DataFrame, exchange: str = DEFAULT_EXCHANGE) -> DataFrame:
    """Socket messages to normalised ones: klines whose candle is closed."""
    rows = arrived(lines, exchange)
    return rows.where(F.col("kind") == CLOSED).select(*MESSAGE_SCHEMA.names)


def message_lines(messages: DataFrame) -> DataFrame:
    """Normalised messages back to one JSON line each, payload inlined."""
    head = F.to_json(
        F.struct(
            "event_type", "symbol", "exchange", "received_at", "client_timestamp"
        )
    )
    open_head = F.expr("substring(head, 1, length(head) - 1)")
    return messages.withColumn("head", head).select(
        F.concat(open_head, F.lit(',"data":'), F.col("data"), F.lit("}")).alias("value")
    )


def klines(parsed: DataFrame) -> DataFrame:
    """Kline events only, flattened to typed fields; other events drop out.

    Accepts stored records (``event_type`` + ``data.k``), bare messages
    (``e`` + ``k``) and wrapped ones (``stream`` + ``data.k``).
    """
    return kline_fields(parsed.where(event_kind() == KLINE))


def event_kind() -> Column:
    """The event of a parsed line, wherever its shape has it."""
    return F.coalesce("event_type", F.col("data.e"), "e")


def kline_fields(parsed: DataFrame, keep: tuple[str, ...] = ("is_live", "source")) -> DataFrame:
    """The typed fields of every parsed line, NULL where it has none, and the columns
    in ``keep`` that there are."""
    body = F.coalesce(F.col("data.k"), F.col("k"))
    carried = [c for c in parsed.columns if c in keep]
    picked = parsed.select(
        *carried,
        "exchange",
        F.coalesce("symbol", F.col("data.s"), F.col("data.symbol"), "s").alias("root_symbol"),
        "stream",
        F.col("received_at").try_cast("double").alias("received_at"),
        "client_timestamp",
        body.alias("k"),
    )
    fields = [
        F.col("k").getItem(key).try_cast(kind_).alias(name)
        for key, (name, kind_) in KLINE_FIELDS.items()
    ]
    return picked.select(*[c for c in picked.columns if c != "k"], *fields)


def payload_fields(messages: DataFrame, payload: str) -> DataFrame:
    """The typed fields of stored kline messages whose text is the variant ``payload``.

    Only the paths named here are taken from it; what is of another type is NULL.
    """
    symbol = F.coalesce("symbol", F.try_variant_get(payload, "$.s", "string"))
    fields = [
        F.try_variant_get(payload, f"$.k.{key}", kind).alias(name) for key, (name, kind) in KLINE_FIELDS.items()
    ]
    return messages.select(
        "exchange", symbol.alias("root_symbol"), "received_at", "client_timestamp", *fields
    )


def closed_only(fields: DataFrame) -> DataFrame:
    """Live rule: keep finished candles; a missing flag counts as unfinished."""
    return fields.where(F.coalesce("is_closed", F.lit(False)))


def typed_candles(
    fields: DataFrame,
    defaults: str = "null",
    whole_seconds: bool = False,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Kline fields to candle columns.

    ``defaults="null"`` keeps missing numbers NULL, so a missing price cannot
    pass as zero. ``defaults="zero"`` fills numbers with 0. The symbol falls
    back from the kline to the record to a fixed name.
    """
    if defaults not in ("null", "zero"):
        raise ValueError("defaults must be 'null' or 'zero'")

    def number(name: str) -> Column:
        c = F.col(name)
        return F.coalesce(c, F.lit(0).cast("double")) if defaults == "zero" else c

    start = F.col("open_ms")
    count = F.col("number_of_trades")
    if defaults == "zero":
        start, count = F.coalesce(start, F.lit(0)), F.coalesce(count, F.lit(0))
    columns = {
        "timestamp": epoch_ms(start, whole_seconds),
        "symbol": F.coalesce("kline_symbol", "root_symbol", F.lit(DEFAULT_SYMBOL)),
        "interval": F.coalesce("interval", F.lit(DEFAULT_INTERVAL)),
        "exchange": F.coalesce("exchange", F.lit(DEFAULT_EXCHANGE)),
        "number_of_trades": count.cast("bigint"),
    }
    out = [columns.get(n, number(n)).alias(n) for n in CANDLE_COLUMNS]
    if "kline_close_time" in extra:
        out.append(epoch_ms(F.col("close_ms"), whole_seconds).alias("kline_close_time"))
    out += [F.col(n) for n in extra if n != "kline_close_time"]
    return fields.select(*out)


def load_candles(spark: SparkSession, path, live: bool = False, **options) -> DataFrame:
    """Newline-delimited kline records to typed candles."""
    good, _ = split_malformed(read_lines(spark, path))
    fields = klines(good)
    return typed_candles(closed_only(fields) if live else fields, **options)


def candles_from_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """In-memory messages to candles; the result stays a DataFrame."""
    import json

    lines = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
    good, _ = split_malformed(lines)
    return typed_candles(klines(good))


def positional_fields(
    arrays: DataFrame,
    symbol: Column,
    interval: str = DEFAULT_INTERVAL,
    exchange: str = DEFAULT_EXCHANGE,
) -> DataFrame:
    """History arrays (``value``: JSON array per row) to kline fields by position."""
    names = [
        {"open_time": "open_ms", "close_time": "close_ms"}.get(n, n) for n in POSITIONAL_FIELDS
    ]
    types = {name: kind for name, kind in KLINE_FIELDS.values()}
    items = arrays.select(
        symbol.alias("root_symbol"), F.from_json("value", "array<string>").alias("items")
    )
    return items.where(F.col("items").isNotNull()).select(
        F.lit(exchange).alias("exchange"),
        "root_symbol",
        F.col("root_symbol").alias("kline_symbol"),
        F.lit(interval).alias("interval"),
        *[
            F.get("items", F.lit(i)).try_cast(types[name]).alias(name)
            for i, name in enumerate(names)
            if name in types
        ],
        F.lit(None).cast("boolean").alias("is_closed"),
    )


def kline_json(end: Column, closed: Column | None = None) -> Column:
    """The ``k`` object of a candle as JSON text; ``end`` is its last millisecond."""
    def text(name: str) -> Column:
        return F.col(name).cast("string")

    pairs = {
        "t": F.unix_millis(F.col("timestamp").cast("timestamp")),
        "s": F.col("symbol"),
        "i": F.col("interval"),
        "o": text("open"),
        "c": text("close"),
        "h": text("high"),
        "l": text("low"),
        "v": text("volume"),
        "n": F.col("number_of_trades"),
        "q": text("quote_volume"),
    }
    upper = {
        "T": end,
        "V": text("taker_buy_volume"),
        "Q": text("taker_buy_quote_volume"),
    }
    if closed is not None:
        upper["x"] = closed
    return _merge_objects(
        F.to_json(F.struct(*[c.alias(k) for k, c in pairs.items()])),
        F.to_json(F.struct(*[c.alias(k) for k, c in upper.items()])),
    )


def _merge_objects(*objects: Column) -> Column:
    """JSON objects as one. Each is used once, so nested merges stay small."""
    inner = [F.regexp_replace(o, r"^\{|\}$", "") for o in objects]
    filled = F.filter(F.array(*inner), lambda text: text != "")
    return F.concat(F.lit("{"), F.concat_ws(",", filled), F.lit("}"))


def _close_ms(candles: DataFrame) -> Column:
    """The last millisecond of a candle: as given, else by its interval's length.

    An interval that is not a number and a unit counts as one minute.
    """
    moment = F.col("timestamp").cast("timestamp")
    count = F.regexp_extract("interval", r"^(\d+)[smhdwM]$", 1).try_cast("bigint")
    unit = F.regexp_extract("interval", r"^\d+([smhdwM])$", 1)
    units = F.create_map(*[F.lit(part) for pair in INTERVAL_MS.items() for part in pair])
    width = F.coalesce(count * F.try_element_at(units, unit), F.lit(60_000))
    by_month = F.unix_millis(moment + F.make_interval(months=count.cast("int")))
    end = F.when(unit == "M", by_month).otherwise(F.unix_millis(moment) + width) - 1
    if "kline_close_time" in candles.columns:
        end = F.coalesce(F.unix_millis(F.col("kline_close_time").cast("timestamp")), end)
    return end


def candle_messages(
    candles: DataFrame, closed: Column | None = None, received_at: Column | None = None
) -> DataFrame:
    """Candles as normalised kline messages, the payload being JSON text.

    A missing symbol or time leaves its fields out. The event time is the close.
    """
    head = F.to_json(F.struct(F.lit(KLINE).alias("e"), F.col("symbol").alias("s")))
    end = F.col("_end")
    event = F.to_json(F.struct(end.alias("E")))
    body = F.concat(F.lit('{"k":'), kline_json(end, closed), F.lit("}"))
    payload = _merge_objects(head, event, body)
    return candles.withColumn("_end", _close_ms(candles)).select(
        F.lit(KLINE).alias("event_type"),
        "symbol",
        "exchange",
        payload.alias("data"),
        (F.lit(None).cast("double") if received_at is None else received_at).alias("received_at"),
        F.lit(None).cast("string").alias("client_timestamp"),
    )


def subscriptions(symbols: DataFrame, streams: list[str]) -> DataFrame:
    """Every ``symbol@stream`` name. ``streams`` is a short configured list, so
    it is exploded per symbol; no join."""
    return symbols.select(
        F.upper(F.trim("symbol")).alias("symbol"),
        F.explode(F.array(*[F.lit(s.strip()) for s in streams if s.strip()])).alias("stream"),
    ).select("symbol", "stream", stream_name(F.col("symbol"), F.col("stream")).alias("name"))


def configured_symbols(spark: SparkSession, text: str) -> DataFrame:
    """A comma list such as ``"aaa, bbb"`` as an upper-cased ``symbol`` column."""
    return spark.range(1).select(F.explode(split_list(F.lit(text), upper=True)).alias("symbol"))


def subscribed(messages: DataFrame, names: list[str]) -> DataFrame:
    """Messages of the subscribed streams only."""
    return messages.where(F.col("stream").isin(names))
