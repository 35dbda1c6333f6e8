"""Sessions on a stream: window state while they are open, one merge for what came too late."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranges import BEFORE, UPTO, settled, sweep


def sessions(
    stream: DataFrame, gap: float, by: Sequence[str] = ("product_id",), ts: str = "ts",
    delay: str = "10 minutes",
) -> DataFrame:
    """Sessions that a pause of more than ``gap`` seconds ends: n, first_us, last_us.

    A session is given out once the watermark (newest event less ``delay``) has passed its end, and
    rows that come within the delay join or connect sessions still open. Only open sessions are
    state, one row each. Rows without a time are left out.
    """
    # A window ends a microsecond past the gap, so that a pause of exactly the gap connects.
    length = F.lit(f"{int(round(gap * 1_000_000)) + 1} microseconds")
    us = F.unix_micros(ts)
    return (
        stream.where(F.col(ts).isNotNull())
        .withWatermark(ts, delay)
        .groupBy(*by, F.session_window(F.col(ts), length).alias("_window"))
        .agg(F.count("*").alias("n"), F.min(us).alias("first_us"), F.max(us).alias("last_us"))
        .drop("_window")
    )


def merge_sessions(parts: DataFrame, gap: float, by: Sequence[str] = ("product_id",)) -> DataFrame:
    """Sessions made of stretches (n, first_us, last_us) that overlap or lie within ``gap`` seconds.

    It puts late rows, as stretches of their own (``as_sessions``), to the sessions already given out.
    A key's stretches are scanned in ranges, so a busy key is not held in one task. Stretches without
    times are left out; no input gives no rows. The ``by`` columns must not be null.
    """
    reach = int(round(gap * 1_000_000))
    # Equal stretches become one first, so ties in the order cannot part.
    rows = (
        parts.where("first_us is not null and last_us is not null")
        .groupBy(*by, "first_us", "last_us")
        .agg(F.sum("n").alias("n"))
    )
    rows, points = settled(rows, "first_us")
    apart = F.col("first_us") > F.col("_until") + reach
    levels = [
        (None, {"_until": ("max", F.col("last_us"), BEFORE)}),
        (None, {"_session": ("sum", F.coalesce(apart, F.lit(True)).cast("bigint"), UPTO)}),
    ]
    numbered = sweep(rows, list(by), ["first_us", "last_us"], levels, points)
    return (
        numbered.groupBy(*by, "_session")
        .agg(F.sum("n").alias("n"), F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"))
        .drop("_session")
    )


def as_sessions(rows: DataFrame, by: Sequence[str] = ("product_id",), us: str = "us") -> DataFrame:
    """Single rows as stretches, equal times counted together."""
    return (
        rows.where(F.col(us).isNotNull())
        .groupBy(*by, F.col(us).alias("first_us"))
        .agg(F.count("*").alias("n"))
        .select(*by, "n", "first_us", F.col("first_us").alias("last_us"))
    )
