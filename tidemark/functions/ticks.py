"""Per-tick column expressions: prices, spreads, book imbalance, clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schema import FEATURE_ALIASES, MODEL_FEATURES, feature_default


def number(text: Column) -> Column:
    """Quoted or plain number as DOUBLE; NULL when it does not parse."""
    return text.try_cast("double")


def truthy(text: Column) -> Column:
    """The value, or NULL where it is missing or an empty string."""
    return F.when(text != "", text)


def first_truthy(*columns: Column) -> Column:
    """First of the alternative names that holds a value."""
    return F.coalesce(*[truthy(c) for c in columns])


def mid_price(price: Column, bid: Column, ask: Column, has_price: Column | None = None) -> Column:
    """The quoted price when the key exists, else the middle of a two-sided book.

    A price that exists but does not parse stays NULL: there is no fallback for it.
    """
    has_price = price.isNotNull() if has_price is None else has_price
    both = (bid > 0) & (ask > 0)
    return F.when(has_price, price).when(both, (bid + ask) / 2)


def known(value: Column) -> Column:
    """The value, or NULL where it is NaN or infinite. (Spark orders NaN above infinity.)"""
    value = value.cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def spread(bid: Column, ask: Column) -> Column:
    """Spread of a two-sided book; NULL for a side that is missing, not positive or not finite."""
    bid, ask = known(bid), known(ask)
    return F.when((bid > 0) & (ask > 0), ask - bid)


def spread_bps(bid: Column, ask: Column) -> Column:
    """Spread in basis points of the middle, where the middle is positive."""
    bid, ask = known(bid), known(ask)
    mid = (bid + ask) / 2
    return F.when(mid > 0, (ask - bid) / mid * 10000)


def book_imbalance(bid_qty: Column, ask_qty: Column) -> Column:
    """Bid share of the quoted quantity; NULL for a missing or non-finite side or an empty book."""
    bid_qty, ask_qty = known(bid_qty), known(ask_qty)
    total = bid_qty + ask_qty
    return F.when(total > 0, bid_qty / total)


def log_return(price: Column, start: Column) -> Column:
    """ln(price / start), 0 when either is not positive."""
    return F.when((start > 0) & (price > 0), F.ln(price / start)).otherwise(F.lit(0.0))


def finite(value: Column) -> Column:
    """NaN and infinities become 0; NULL stays NULL. (Spark orders NaN above infinity.)"""
    value = value.cast("double")
    return F.when(F.abs(value) >= F.lit(float("inf")), F.lit(0.0)).otherwise(value)


def priced(price: Column) -> Column:
    """A usable price: 0, NaN and infinities count as missing."""
    price = known(price)
    return F.when(price != 0, price)


def micros(ts: Column) -> Column:
    """Event time as BIGINT microseconds, so that frame bounds are exact."""
    return F.unix_micros(ts.cast("timestamp"))


def event_time(source_time: Column, ingest_time: Column) -> Column:
    """Source time if it was sent, else the time of ingest; unparsable text is NULL."""
    return F.when(truthy(source_time).isNotNull(), F.try_to_timestamp(source_time)).otherwise(
        ingest_time.cast("timestamp")
    )


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text, always with microseconds and a Z."""
    return F.date_format(ts.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def sanitize(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace NaN and infinities of the floating-point columns by 0."""
    names = columns or [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({n: finite(F.col(n)) for n in names})


def _number(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def default_fill(df: DataFrame, features: list[str] = MODEL_FEATURES) -> DataFrame:
    """Cast the features and fill what is missing or NaN, whole columns included."""
    have = set(df.columns)
    return df.withColumns(
        {
            f: F.coalesce(_number(F.col(f).try_cast("double")), F.lit(feature_default(f)))
            if f in have
            else F.lit(feature_default(f))
            for f in features
        }
    )


def alias_map(df: DataFrame) -> DataFrame:
    """Short request names to feature names; a full name that is set wins."""
    have = set(df.columns)
    out = {}
    for short, full in FEATURE_ALIASES.items():
        if short not in have:
            continue
        value = F.col(short).cast("double")
        out[full] = F.coalesce(F.col(full).cast("double"), value) if full in have else value
    return df.withColumns(out)


def alias_back(df: DataFrame) -> DataFrame:
    """Feature names to the short request names (missing values count as 0)."""
    out = {
        short: F.coalesce(F.col(full).cast("double"), F.lit(0.0))
        for short, full in FEATURE_ALIASES.items()
    }
    out["n"] = out["n"].cast("bigint")
    return df.withColumns(out)


def select_features(
    df: DataFrame,
    features: list[str] = MODEL_FEATURES,
    keep: list[str] = (),
    target: str | None = None,
) -> DataFrame:
    """The listed features that exist, with missing values as 0.

    ``target`` (training) must exist. Raises when no feature exists at all.
    """
    present = [f for f in features if f in df.columns]
    if not present:
        raise ValueError(f"none of the features {features} is in {df.columns}")
    if target is not None and target not in df.columns:
        raise ValueError(f"training needs the column {target}")
    zero = F.lit(0.0)
    filled = [
        F.coalesce(F.nanvl(F.col(f).cast("double"), zero), zero).alias(f) for f in present
    ]
    return df.select(*keep, *filled, *([target] if target else []))


def missing_features(df: DataFrame, features: list[str] = MODEL_FEATURES) -> list[str]:
    """Names of the listed features the table lacks (schema only)."""
    return [f for f in features if f not in df.columns]


def common_columns(left: DataFrame, right: DataFrame, columns: list[str]) -> list[str]:
    """The listed columns both tables have, in the given order (schema only)."""
    return [c for c in columns if c in left.columns and c in right.columns]


def add_return_range(df: DataFrame) -> DataFrame:
    """Derived ``return_range_60s`` where both of its parts exist."""
    if {"return_max_60s", "return_min_60s"} <= set(df.columns):
        spread_60 = F.col("return_max_60s") - F.col("return_min_60s")
        return df.withColumn("return_range_60s", spread_60)
    return df


def analysis_columns(df: DataFrame, features: list[str] = MODEL_FEATURES) -> list[str]:
    """Columns to compare between two tables: the model's, else every numeric one."""
    names = [f for f in features if f in df.columns]
    if {"return_max_60s", "return_min_60s"} <= set(df.columns):
        names.append("return_range_60s")
    if names:
        return names
    # Columns that are never analysed.
    skip = {"timestamp", "label", "future_volatility", "volatility_spike"}
    return [n for n, t in df.dtypes if t in ("double", "bigint") and n not in skip]
