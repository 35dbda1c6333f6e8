"""Table schemas and the fixed names and values of the data model."""

from pyspark.sql import types as T

# The model's feature columns, in order.
MODEL_FEATURES = [
    "log_return_300s",
    "spread_mean_300s",
    "trade_intensity_300s",
    "order_book_imbalance_300s",
    "spread_mean_60s",
    "order_book_imbalance_60s",
    "price_velocity_300s",
    "realized_volatility_300s",
    "order_book_imbalance_30s",
    "realized_volatility_60s",
]

# Short request names and the feature each stands for.
FEATURE_ALIASES = {
    "ret_mean": "log_return_300s",
    "ret_std": "realized_volatility_300s",
    "n": "trade_intensity_300s",
}

# Latency histogram bucket bounds in seconds.
LATENCY_BUCKETS = [0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0]


def feature_default(name: str) -> float:
    """A balanced book is 0.5, everything else is 0."""
    return 0.5 if name.startswith("order_book_imbalance") else 0.0


_TICKER = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "product_id",
            "price",
            "volume_24_h",
            "volume",
            "low_24_h",
            "low",
            "high_24_h",
            "high",
            "best_bid",
            "bid",
            "best_ask",
            "ask",
            "best_bid_quantity",
            "best_ask_quantity",
            "size",
            "time",
        )
    ]
)

FEED_MESSAGE = T.StructType(
    [
        T.StructField("channel", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField(
            "events",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("type", T.StringType()),
                        T.StructField("tickers", T.ArrayType(_TICKER)),
                    ]
                )
            ),
        ),
        *_TICKER.fields,
    ]
)

# The names above, in order.
TICKER_FIELDS = _TICKER.fieldNames()

# A tick as it lies in NDJSON files and on the topic: numbers are quoted.
TICK_JSON = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("volume_24h", T.StringType()),
        T.StructField("low_24h", T.StringType()),
        T.StructField("high_24h", T.StringType()),
        T.StructField("best_bid", T.StringType()),
        T.StructField("best_ask", T.StringType()),
        T.StructField("best_bid_quantity", T.StringType()),
        T.StructField("best_ask_quantity", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("volume", T.StringType()),
        T.StructField("trade_size", T.StringType()),
        T.StructField("raw", _TICKER),
    ]
)

TICK = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("best_bid", T.DoubleType()),
        T.StructField("best_ask", T.DoubleType()),
        T.StructField("bid_qty", T.DoubleType()),
        T.StructField("ask_qty", T.DoubleType()),
        T.StructField("trade_size", T.DoubleType()),
    ]
)

# Messages of the feature topic and the prediction log. Every field is read as text first,
# so that a quoted or broken number does not lose its whole message.
LOG_VERSION = 2
_FEATURE_FIELDS = [T.StructField(f, T.StringType()) for f in MODEL_FEATURES]
FEATURE_MESSAGE = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("volatility_spike", T.StringType()),
        *_FEATURE_FIELDS,
    ]
)
PREDICTION_MESSAGE = T.StructType(
    [
        T.StructField("schema_version", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("model_variant", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("prediction", T.StringType()),
        T.StructField(
            "features",
            T.StructType(
                [
                    *_FEATURE_FIELDS,
                    *[
                        T.StructField(name, T.StringType())
                        for name in ("timestamp", "product_id", "price", "ret_mean", "ret_std", "n")
                    ],
                ]
            ),
        ),
    ]
)

LOAD_TEST = T.StructType(
    [
        T.StructField(
            "summary",
            T.StructType([T.StructField("total_time_seconds", T.DoubleType())]),
        ),
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("request_id", T.LongType()),
                        T.StructField("status_code", T.IntegerType()),
                        T.StructField("latency_ms", T.DoubleType()),
                        T.StructField("success", T.BooleanType()),
                        T.StructField("error", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)

# Most preferred first; a file without any of them falls back to 0.05.
THRESHOLD_FIELDS = ["threshold_used", "threshold_10pct", "optimal_threshold"]
DEFAULT_THRESHOLD = 0.05
THRESHOLD_METADATA = T.StructType(
    [T.StructField(f, T.DoubleType()) for f in THRESHOLD_FIELDS]
)
