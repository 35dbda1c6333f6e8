"""File sources: NDJSON ticks and prediction logs, parquet tables, load-test results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import (
    DEFAULT_THRESHOLD,
    LOAD_TEST,
    THRESHOLD_FIELDS,
    THRESHOLD_METADATA,
    TICK_JSON,
)
from tidemark.sources.messages import decode_predictions

# Files of the log: one that a single writer rolls, and those of a Spark writer.
LOG_FILES = "{predictions_*.ndjson,part-*.json*}"
DAY_FOLDER = "dt"


def ndjson(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None,
    stream: bool = False, **options,
) -> DataFrame:
    """NDJSON files; lines that do not parse are dropped."""
    reader = (spark.readStream if stream else spark.read).schema(schema)
    reader = reader.option("mode", "DROPMALFORMED").options(**options)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.json(path)


def tick_files(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    return ndjson(spark, path, TICK_JSON, "*.ndjson", stream, **options)


def prediction_files(
    spark: SparkSession, path: str, stream: bool = False, days: Sequence[str] | None = None, **options
) -> DataFrame:
    """The prediction log: files ``predictions_*.ndjson`` in the folder, and the day folders of
    ``sinks.write_prediction_log``. ``days`` (as ``2024-01-31``) reads those folders only.

    A line without a readable time, score or object is dropped (``messages.read_predictions``
    tells why); an empty log gives no rows.
    """
    reader = (spark.readStream if stream else spark.read).options(**options)
    reader = reader.option("pathGlobFilter", LOG_FILES).option("recursiveFileLookup", True)
    if days is None:
        lines = reader.text(path)
    else:
        lines = reader.text(f"{path}/{DAY_FOLDER}={{{','.join(days)}}}")
    return decode_predictions(lines)


def feature_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_test_results(spark: SparkSession, path: str) -> DataFrame:
    """One row per request of a load-test report."""
    report = spark.read.schema(LOAD_TEST).json(path, multiLine=True)
    return report.select(
        F.col("summary.total_time_seconds").alias("elapsed_seconds"), F.inline("results")
    )


def threshold(spark: SparkSession, path: str) -> DataFrame:
    """The decision threshold of a model's metadata file, as one row."""
    meta = spark.read.schema(THRESHOLD_METADATA).json(path, multiLine=True)
    chosen = F.coalesce(*THRESHOLD_FIELDS, F.lit(DEFAULT_THRESHOLD))
    return meta.select(chosen.alias("threshold"))
