"""Views over the given tables that play the part of the tick, prediction and request tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.ticks import micros
from tidemark.operators.features import FrameSpec
from tidemark.operators.splits import split_ratio
from tidemark.session import prepare

# The table has about one event per type in 15 minutes, so seconds become quarter hours.
TAPE_FRAMES = FrameSpec(short=1800, mid=3600, long=18000, pair_min=450, pair_max=1350)
HORIZON = 3600
GAP = 6000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf}/{name}.parquet")


def tape(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as ticks of five products."""
    return as_tape(table(spark, sf, "events"))


def as_tape(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    value, i = F.col("value"), F.col("event_id")
    return events.select(
        F.col("event_type").alias("product_id"),
        micros(F.col("ts")).alias("us"),
        i.alias("seq"),
        value.alias("price"),
        k.alias("k"),
        F.when(k % 17 == 0, F.lit(0.0)).otherwise(value * (1 - (k % 7 + 1) * 1e-4)).alias("best_bid"),
        (value * (1 + (k % 5 + 1) * 1e-4)).alias("best_ask"),
        (k % 11).cast("double").alias("bid_qty"),
        ((k * 7) % 13).cast("double").alias("ask_qty"),
        (k % 9).cast("double").alias("trade_size"),
    )


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """A prediction log: shifted by up to two seconds against the ticks, scores in four places."""
    t = tape(spark, sf)
    score = F.round(1 / (1 + F.exp(-(F.col("price") - 50) / 40)), 4)
    return t.select(
        (F.col("us") + (F.col("seq") % 5 - 2) * 1_000_000).alias("us"),
        F.col("us").alias("event_us"),
        "product_id",
        "seq",
        "k",
        F.concat(F.lit("v"), (F.col("k") % 3).cast("string")).alias("model_version"),
        score.alias("score"),
        (score >= 0.7).cast("int").alias("prediction"),
        F.when((F.col("k") * 31 + F.col("seq")) % 10 < 3, 1).otherwise(0).alias("label"),
    )


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """A request log: errors are failed requests, the value is the latency."""
    events = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    failed = F.col("event_type") == "error"
    return events.select(
        micros(F.col("ts")).alias("us"),
        F.col("event_type").alias("endpoint"),
        F.lit("POST").alias("method"),
        F.when(failed, 500).otherwise(200).alias("status"),
        F.col("value").alias("latency_ms"),
        F.when(failed, F.concat(F.lit("code "), (k % 4).cast("string"))).alias("error"),
    )


def request_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Scoring requests with short names, gaps and a text column."""
    t, k, price = tape(spark, sf), F.col("k"), F.col("price")
    return t.select(
        "seq",
        (price / 1000).alias("ret_mean"),
        F.when(k % 5 != 0, price / 500).alias("ret_std"),
        k.alias("n"),
        F.when(k % 3 == 0, price / 900).alias("log_return_300s"),
        F.when(k % 7 != 0, k / 100).alias("order_book_imbalance_30s"),
        F.when(k % 11 == 0, "n/a").otherwise(k.cast("string")).alias("spread_mean_60s"),
    )


def broken_values(spark: SparkSession, sf: str) -> DataFrame:
    """A number column with NaN, infinities and nulls, a text column with gaps."""
    t, k = tape(spark, sf), F.col("k")
    x = (
        F.when(k % 10 == 0, F.lit(float("nan")))
        .when(k % 10 == 1, F.lit(float("inf")))
        .when(k % 10 == 2, F.lit(float("-inf")))
        .when(k % 10 != 3, F.col("price"))
    )
    s = F.when(k % 6 == 0, "").when(k % 6 != 1, F.col("product_id"))
    return t.select("seq", "product_id", x.alias("x"), s.alias("s"))


def envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """Feed messages in the three shapes, with heartbeats and broken text among them."""
    t, i = tape(spark, sf), F.col("seq")
    text = {c: F.col(c).cast("string") for c in ("price", "best_bid", "best_ask", "bid_qty", "ask_qty", "trade_size")}
    time = F.date_format(F.timestamp_micros("us"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    quoted = F.struct(
        "product_id",
        text["price"].alias("price"),
        text["trade_size"].alias("volume_24_h"),
        text["best_bid"].alias("best_bid"),
        text["best_ask"].alias("best_ask"),
        text["bid_qty"].alias("best_bid_quantity"),
        text["ask_qty"].alias("best_ask_quantity"),
        time.alias("time"),
    )
    nested = F.struct(
        F.lit("ticker").alias("channel"),
        F.array(F.struct(F.lit("update").alias("type"), F.array(quoted).alias("tickers"))).alias("events"),
    )
    flat = F.struct(
        F.lit("ticker").alias("type"),
        "product_id",
        text["price"].alias("price"),
        F.lit("").alias("volume_24_h"),
        text["trade_size"].alias("volume"),
        text["best_bid"].alias("bid"),
        text["best_ask"].alias("ask"),
        time.alias("time"),
    )
    trade = F.struct(
        F.lit("match").alias("type"),
        "product_id",
        text["price"].alias("price"),
        text["trade_size"].alias("size"),
        time.alias("time"),
    )
    beat = F.struct(F.lit("heartbeats").alias("channel"), time.alias("time"))
    value = (
        F.when(i % 97 == 0, '{"type": "ticker", "price"')
        .when(i % 50 == 0, F.to_json(beat))
        .when(i % 3 == 0, F.to_json(nested))
        .when(i % 3 == 1, F.to_json(flat))
        .otherwise(F.to_json(trade))
    )
    return t.select("seq", value.alias("value"))


def drift_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Early half as reference; late half, with dearer purchases, as current."""
    parts = split_ratio(tape(spark, sf))
    late = parts.where("split = 'current'")
    dearer = F.when(F.col("product_id") == "purchase", F.col("price") * 1.2).otherwise(F.col("price"))
    return parts.where("split = 'reference'"), late.withColumn("price", dearer)
