"""Decoding of raw feed messages into ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ticks import (
    event_time,
    first_truthy,
    iso_utc,
    micros,
    mid_price,
    number,
    truthy,
)
from tidemark.schema import FEED_MESSAGE, TICK_JSON, TICKER_FIELDS

# Event and message types that carry a ticker.
TICKER_EVENTS = ["update", "ticker", "snapshot"]
TRADE_TYPES = ["match", "last_match"]
TRADE_FIELDS = ["product_id", "price", "size", "time"]
# Quantities and sizes that may stand beside the price.
TOP_LEVEL = ["best_bid_quantity", "best_ask_quantity", "size", "volume", "trade_size"]


def decode_feed(
    df: DataFrame,
    value: str = "value",
    ingest_time: Column | None = None,
    all_tickers: bool = False,
) -> DataFrame:
    """Feed messages as ticks with text numbers, the shape that lies on the tick topic.

    A message holds a ticker in its events, is one itself, or is a trade. Subscription
    notes, heartbeats, errors and broken text yield nothing. Only the first ticker of the
    first fitting event counts; ``all_tickers`` takes every one of them.
    """
    ingest = F.current_timestamp() if ingest_time is None else ingest_time
    others = [c for c in df.columns if c != value]
    # The generator makes each text be parsed once, however many fields are used below.
    m = df.select(*others, F.inline(F.array(F.from_json(value, FEED_MESSAGE)))).where(
        ~F.coalesce(F.col("type").isin("subscriptions", "error"), F.lit(False))
        & ~F.coalesce(F.col("channel") == "heartbeats", F.lit(False))
    )
    flat = F.struct(*TICKER_FIELDS)
    trade = F.struct(
        *[
            (F.col(f) if f in TRADE_FIELDS else F.lit(None).cast("string")).alias(f)
            for f in TICKER_FIELDS
        ]
    )
    fitting = F.filter(
        "events", lambda e: e["type"].isin(TICKER_EVENTS) & (F.size(e["tickers"]) > 0)
    )
    nested = (
        F.flatten(F.transform(fitting, lambda e: e["tickers"]))
        if all_tickers
        else F.slice(F.try_element_at(fitting, F.lit(1))["tickers"], 1, 1)
    )
    tickers = (
        F.when(F.col("events").isNotNull(), nested)
        .when(F.col("type") == "ticker", F.array(flat))
        .when(F.col("type").isin(TRADE_TYPES), F.array(trade))
    )
    t = m.select(*[m[c] for c in others], F.explode(tickers).alias("t")).where(
        F.col("t").isNotNull()
    )
    source_time = truthy(F.col("t.time"))
    return t.select(
        *others,
        F.coalesce(source_time, iso_utc(ingest)).alias("timestamp"),
        "t.product_id",
        "t.price",
        first_truthy(F.col("t.volume_24_h"), F.col("t.volume")).alias("volume_24h"),
        first_truthy(F.col("t.low_24_h"), F.col("t.low")).alias("low_24h"),
        first_truthy(F.col("t.high_24_h"), F.col("t.high")).alias("high_24h"),
        first_truthy(F.col("t.best_bid"), F.col("t.bid")).alias("best_bid"),
        first_truthy(F.col("t.best_ask"), F.col("t.ask")).alias("best_ask"),
        F.col("t").alias("raw"),
    )


def parse_ticks(df: DataFrame, has_price: Column | None = None, now: Column | None = None) -> DataFrame:
    """Text ticks as typed ticks.

    ``has_price`` tells whether the price key exists at all (default: it does, as in
    decoded messages); only without it the middle of the book is taken. Rows whose time
    does not parse get a NULL ``us``; ``drop_invalid_times`` removes and counts them. Book
    quantities lie in ``raw`` or beside the price, trade sizes beside the price or in ``raw``.
    """
    top = {c: F.col(c) if c in df.columns else F.lit(None).cast("string") for c in TOP_LEVEL}
    has_price = F.lit(True) if has_price is None else has_price
    bid, ask = number(F.col("best_bid")), number(F.col("best_ask"))
    bid_qty, ask_qty = (
        number(first_truthy(F.col(f"raw.{c}"), top[c]))
        for c in ("best_bid_quantity", "best_ask_quantity")
    )
    sizes = [top["size"], top["volume"], top["trade_size"], F.col("raw.size"), F.col("raw.volume")]
    both = bid_qty.isNotNull() & ask_qty.isNotNull()
    ts = event_time(F.col("timestamp"), now if now is not None else F.lit(None))
    other = [c for c in df.columns if c not in TICK_JSON.fieldNames()]
    return df.select(
        *other,
        ts.alias("ts"),
        micros(ts).alias("us"),
        "product_id",
        mid_price(number(F.col("price")), bid, ask, has_price).alias("price"),
        bid.alias("best_bid"),
        ask.alias("best_ask"),
        F.when(both, bid_qty).alias("bid_qty"),
        F.when(both, ask_qty).alias("ask_qty"),
        number(first_truthy(*sizes)).alias("trade_size"),
        number(F.col("volume_24h")).alias("volume_24h"),
        number(F.col("low_24h")).alias("low_24h"),
        number(F.col("high_24h")).alias("high_24h"),
        F.to_json("raw").alias("raw"),
    )


def ticks_from_json(df: DataFrame, value: str = "value") -> DataFrame:
    """Tick JSON text as typed ticks; an absent price key differs from an unusable one."""
    others = [c for c in df.columns if c != value]
    rows = df.select(
        *others,
        F.coalesce(F.array_contains(F.json_object_keys(value), "price"), F.lit(False)).alias("_p"),
        F.inline(F.array(F.from_json(value, TICK_JSON))),
    )
    return parse_ticks(rows, F.col("_p")).drop("_p")


def json_status(value: Column) -> Column:
    """``empty``, ``broken`` or ``ok`` for a text that should be a JSON object."""
    text = F.trim(value)
    broken = F.try_parse_json(text).isNull()
    return (
        F.when(value.isNull() | (text == ""), "empty").when(broken, "broken").otherwise("ok")
    )


def decode_utf8(value: Column) -> Column:
    """Bytes as text; NULL where they are not UTF-8."""
    return F.try_validate_utf8(value.cast("string"))


def json_quarantine(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Readable messages, and the others with the reason."""
    marked = df.withColumn("reason", json_status(F.col(value)))
    good = marked.where("reason = 'ok'").drop("reason")
    return good, marked.where("reason <> 'ok'")


def drop_invalid_times(df: DataFrame, observation=None, us: str = "us") -> DataFrame:
    """Rows with a valid time; the dropped ones are counted by ``observation`` if given."""
    if observation is not None:
        df = df.observe(observation, F.count_if(F.col(us).isNull()).alias("invalid_times"))
    return df.where(F.col(us).isNotNull())
