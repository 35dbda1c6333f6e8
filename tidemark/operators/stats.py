"""Counts, shares, ranges and exact distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.labels import gap_chunks
from tidemark.operators.ranges import quantiles


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and share of each class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    return counts.crossJoin(F.broadcast(total)).select(
        label, "n", (F.col("n") / F.col("_total")).alias("share")
    )


def chunk_sizes(chunked: DataFrame, by: Sequence[str] = ("product_id",)) -> DataFrame:
    """Rows and time span of each chunk."""
    return chunked.groupBy(*by, "chunk_id").agg(
        F.count("*").alias("n"), F.min("us").alias("first_us"), F.max("us").alias("last_us")
    )


def mode_value(df: DataFrame, column: str, name: str = "mode") -> DataFrame:
    """Most frequent value; the smallest one among equals."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    top = F.min_by(column, F.struct(-F.col("n"), F.col(column))).alias(name)
    return counts.agg(top, F.max("n").alias("n"))


def time_range(df: DataFrame, us: str = "us") -> DataFrame:
    return df.agg(
        F.min(us).alias("first_us"), F.max(us).alias("last_us"), F.count("*").alias("n")
    )


def range_overlap(left: DataFrame, right: DataFrame, us: str = "us") -> DataFrame:
    """Time ranges of two tables and how they lie to each other."""
    a = time_range(left, us).toDF("left_first", "left_last", "left_n")
    b = time_range(right, us).toDF("right_first", "right_last", "right_n")
    verdict = (
        F.when((F.col("left_n") == 0) | (F.col("right_n") == 0), "empty")
        .when(F.col("left_last") < F.col("right_first"), "before")
        .when(F.col("left_first") > F.col("right_last"), "after")
        .otherwise("overlap")
    )
    return a.crossJoin(F.broadcast(b)).withColumn("verdict", verdict)


def score_distribution(df: DataFrame, column: str = "score") -> DataFrame:
    """Count, max, mean, and exact median, p90, p95 and p99."""
    shares = {"median": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}
    found = quantiles(df, column, list(shares.values()))
    return df.agg(
        F.count(column).alias("n"), F.max(column).alias("max"), F.avg(column).alias("mean")
    ).withColumns({name: F.lit(found[p]).cast("double") for name, p in shares.items()})


def counts_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Event counters by their labels."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def message_rate(df: DataFrame, seconds: int, by: Sequence[str] = ()) -> DataFrame:
    """Messages per second in tumbling windows."""
    size = seconds * 1_000_000
    start = (F.floor(F.col("us") / size) * size).cast("bigint").alias("window_us")
    return df.groupBy(*by, start).agg(F.count("*").alias("n")).withColumn(
        "per_second", F.col("n") / seconds
    )


def session_summary(df: DataFrame, gap: int, by: Sequence[str] = ("product_id",)) -> DataFrame:
    """Sessions that a pause of more than ``gap`` seconds ends.

    A batch table goes through the gap chunks, which cut a busy key into ranges. On a stream
    (with a watermark on ``ts``) the built-in session window does the same per key.
    """
    if not df.isStreaming:
        return chunk_sizes(gap_chunks(df, gap, by), by).drop("chunk_id")
    window = F.session_window(F.col("ts"), f"{gap} seconds")
    return df.groupBy(*by, window).agg(
        F.count("*").alias("n"), F.min("us").alias("first_us"), F.max("us").alias("last_us")
    )
