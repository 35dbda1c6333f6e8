"""Kafka sources and the message form of rows. Needs Spark's Kafka connector on the classpath."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Unbounded scan of a topic; ``max_per_trigger`` caps the intake of one micro-batch."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return text_messages(reader.load())


def recent_options(servers: str, topic: str, partitions: int, since_ms: int) -> dict[str, str]:
    """Options of a bounded scan that starts at a time, on every partition."""
    offsets = {topic: {str(p): since_ms for p in range(partitions)}}
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsetsByTimestamp": json.dumps(offsets),
        "startingOffsetsByTimestampStrategy": "latest",
        "endingOffsets": "latest",
    }


def recent(
    spark: SparkSession, servers: str, topic: str, partitions: int, since_ms: int
) -> DataFrame:
    """Bounded scan of what arrived since a time: the broker finds the offsets."""
    options = recent_options(servers, topic, partitions, since_ms)
    return text_messages(spark.read.format("kafka").options(**options).load())


def text_messages(df: DataFrame) -> DataFrame:
    """Kafka rows with a text value; ``seq`` is the arrival number within the partition."""
    return df.select(
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        F.col("offset").alias("seq"),
        F.col("timestamp").alias("ingest_ts"),
    )


def to_messages(df: DataFrame, key: str = "product_id") -> DataFrame:
    """Rows as (key, JSON value), so that a product's messages keep their order."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"),
    )
