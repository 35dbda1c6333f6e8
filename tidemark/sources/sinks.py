"""Writers: append-only tables, NDJSON, messages, metric history, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidemark.operators.joins import new_rows
from tidemark.sources.kafka import to_messages
from tidemark.sources.messages import prediction_messages


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, or None when nothing was written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def append_features(df: DataFrame, path: str, keys: tuple[str, ...] = ("us", "product_id")) -> None:
    """Append the rows whose key is not stored; nothing that is stored is written again.

    The table is partitioned by day and only the days of the new rows are compared with.
    """
    dated = df.withColumn("dt", F.to_date(F.timestamp_micros("us")))
    have = stored(df.sparkSession, path)
    if have is not None:
        days = dated.agg(F.min("dt"), F.max("dt")).first()
        have = have.where(F.col("dt").between(*days))
        dated = new_rows(have, dated, keys)
    else:
        dated = new_rows(dated.limit(0), dated, keys)
    dated.write.mode("append").partitionBy("dt").parquet(path)


def write_ndjson(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def write_prediction_log(scored: DataFrame, path: str, files_per_day: int | None = None) -> None:
    """Append scored rows to the prediction log, one folder per day of event time.

    ``files.prediction_files`` reads it back. Rows without a time cannot be logged and are
    refused. ``files_per_day`` gathers each day's rows in that many files at most.
    """
    if not scored.where("us is null").isEmpty():
        raise ValueError("rows without a time cannot be logged")
    rows = prediction_messages(scored).withColumn("dt", F.substring("timestamp", 1, 10))
    if files_per_day:
        part = F.pmod(F.xxhash64("timestamp", "product_id"), F.lit(files_per_day))
        rows = rows.repartition(F.col("dt"), part)
    rows.write.mode("append").partitionBy("dt").json(path)


def write_messages(df: DataFrame, servers: str, topic: str, key: str = "product_id") -> None:
    (
        to_messages(df, key)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def append_history(history: DataFrame, path: str) -> None:
    history.write.mode("append").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """A drift report as JSON lines: a few rows, hence one file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_labeled(labeled: DataFrame, path: str) -> str:
    """A labelled copy beside a feature table."""
    target = path.removesuffix(".parquet") + "_labeled.parquet"
    labeled.write.mode("overwrite").parquet(target)
    return target
