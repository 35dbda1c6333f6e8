"""Messages of the feature topic and the prediction log, in both directions.

``schema_version`` names the form of a prediction message. Messages without one are version 1;
version 2 adds ``product_id`` beside the score. Later versions are set aside, not guessed at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ticks import event_time, first_truthy, iso_utc, micros, number
from tidemark.schema import (
    FEATURE_ALIASES,
    FEATURE_MESSAGE,
    LOG_VERSION,
    MODEL_FEATURES,
    PREDICTION_MESSAGE,
)
from tidemark.sources.feed import json_status


def _parsed(df: DataFrame, value: str, schema) -> DataFrame:
    """Every message once as ``_m``, beside the other columns and its ``_status``."""
    others = [c for c in df.columns if c != value]
    text = df.select(*others, json_status(F.col(value)).alias("_status"), F.col(value).alias("_v"))
    # The generator makes each text be parsed once, however many fields are used below.
    parsed = F.inline(F.array(F.struct(F.from_json("_v", schema).alias("_m"))))
    return text.select(*others, "_status", parsed)


def _others(df: DataFrame, value: str, own: Sequence[str]) -> list[str]:
    """Columns to carry along; a clashing name gives way to the message's own."""
    return [c for c in df.columns if c != value and c not in own]


FEATURE_COLUMNS = ["ts", "us", "product_id", "price", "volatility_spike", *MODEL_FEATURES, "reason"]


def read_features(df: DataFrame, value: str = "value") -> DataFrame:
    """Feature messages as typed rows with a ``reason`` where one cannot be used.

    Reasons are ``empty``, ``broken`` (no JSON object) and ``time``. A feature that is missing
    or not a number is NULL. No input gives no rows; repeated messages stay repeated.
    """
    m = _parsed(df.select(*_others(df, value, FEATURE_COLUMNS), value), value, FEATURE_MESSAGE)
    ts = event_time(F.col("_m.timestamp"), F.lit(None))
    reason = F.when(F.col("_status") != "ok", F.col("_status")).when(ts.isNull(), "time")
    return m.select(
        *_others(df, value, FEATURE_COLUMNS),
        ts.alias("ts"),
        micros(ts).alias("us"),
        "_m.product_id",
        number(F.col("_m.price")).alias("price"),
        number(F.col("_m.volatility_spike")).cast("int").alias("volatility_spike"),
        *[number(F.col(f"_m.{f}")).alias(f) for f in MODEL_FEATURES],
        reason.alias("reason"),
    )


def decode_features(df: DataFrame, value: str = "value") -> DataFrame:
    """The usable feature messages."""
    return read_features(df, value).where("reason is null").drop("reason")


def score_requests(features: DataFrame) -> DataFrame:
    """Decoded features as score requests: every feature is there (0 where it was missing or
    unusable), and the three short names beside them."""
    filled = features.withColumns({f: F.coalesce(f, F.lit(0.0)) for f in MODEL_FEATURES})
    return filled.withColumns(
        {
            short: F.col(name).cast("bigint") if short == "n" else F.col(name)
            for short, name in FEATURE_ALIASES.items()
        }
    )


PREDICTION_COLUMNS = [
    "schema_version", "timestamp", "ts", "us", "product_id", "price", "model_variant",
    "model_version", "score", "prediction", "features", "reason",
]


def read_predictions(df: DataFrame, value: str = "value", newest: int = LOG_VERSION) -> DataFrame:
    """Prediction messages as typed rows with a ``reason`` where one cannot be used.

    Reasons are ``empty``, ``broken`` (no JSON object), ``version`` (newer than ``newest``),
    ``time`` and ``score`` (missing or not a number). A bare ``NaN`` is no JSON. No input gives no rows; repeated messages
    stay repeated.
    """
    m = _parsed(df.select(*_others(df, value, PREDICTION_COLUMNS), value), value, PREDICTION_MESSAGE)
    version = F.coalesce(number(F.col("_m.schema_version")).cast("int"), F.lit(1))
    ts = event_time(F.col("_m.timestamp"), F.lit(None))
    score = F.nanvl(number(F.col("_m.score")), F.lit(None))
    reason = (
        F.when(F.col("_status") != "ok", F.col("_status"))
        .when(version > newest, "version")
        .when(ts.isNull(), "time")
        .when(score.isNull(), "score")
    )
    return m.select(
        *_others(df, value, PREDICTION_COLUMNS),
        version.alias("schema_version"),
        F.col("_m.timestamp").alias("timestamp"),
        ts.alias("ts"),
        micros(ts).alias("us"),
        first_truthy(F.col("_m.product_id"), F.col("_m.features.product_id")).alias("product_id"),
        number(F.col("_m.features.price")).alias("price"),
        "_m.model_variant",
        "_m.model_version",
        score.alias("score"),
        number(F.col("_m.prediction")).cast("int").alias("prediction"),
        F.struct(*[number(F.col(f"_m.features.{f}")).alias(f) for f in MODEL_FEATURES]).alias("features"),
        reason.alias("reason"),
    )


def decode_predictions(df: DataFrame, value: str = "value", newest: int = LOG_VERSION) -> DataFrame:
    """The usable prediction messages."""
    return read_predictions(df, value, newest).where("reason is null").drop("reason")


def prediction_messages(scored: DataFrame, features: Sequence[str] = tuple(MODEL_FEATURES)) -> DataFrame:
    """Scored rows in the form that the log and its readers share: event time as ISO text, the
    features with their short names, product and price."""
    time = iso_utc(F.timestamp_micros("us"))
    price = F.col("price") if "price" in scored.columns else F.lit(None).cast("double")
    inner: list[Column] = [F.col(f) for f in features]
    inner += [time.alias("timestamp"), F.col("product_id"), price.alias("price")]
    for short, name in FEATURE_ALIASES.items():
        if name in features:
            inner.append((F.col(name).cast("bigint") if short == "n" else F.col(name)).alias(short))
    return scored.select(
        F.lit(LOG_VERSION).alias("schema_version"),
        time.alias("timestamp"),
        "product_id",
        "model_variant",
        "model_version",
        "score",
        "prediction",
        F.struct(*inner).alias("features"),
    )
