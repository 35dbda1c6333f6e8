"""Progress of streaming queries as a table: lag per partition, rates, alerts on lasting lag."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.operators.slo import MINUTE, alert_islands

SCHEMA = (
    "query string, run string, us bigint, batch bigint, source int, topic string, "
    "partition int, committed bigint, newest bigint, lag bigint, rows bigint, rows_per_second double"
)


def _offsets(text) -> dict:
    """Offsets of a topic and partition source; nothing for sources of another kind."""
    try:
        value = json.loads(text) if isinstance(text, str) else text
    except ValueError:
        return {}
    if not isinstance(value, dict):
        return {}
    return {
        (topic, int(part)): int(at)
        for topic, parts in value.items() if isinstance(parts, dict)
        for part, at in parts.items()
    }


def progress_rows(progress: dict) -> Iterator[tuple]:
    """A progress report as rows of ``SCHEMA``: one per topic and partition, or one for a source
    that has none (its lag is unknown, hence NULL)."""
    for number, source in enumerate(progress.get("sources", [])):
        head = (
            progress.get("name") or progress.get("id"), progress.get("runId"),
            progress.get("timestamp"), progress.get("batchId"), number,
        )
        tail = (source.get("numInputRows"), source.get("processedRowsPerSecond"))
        done, newest = _offsets(source.get("endOffset")), _offsets(source.get("latestOffset"))
        if not newest:
            yield (*head, None, None, None, None, None, *tail)
        for (topic, part), end in sorted(newest.items()):
            at = done.get((topic, part), 0)
            yield (*head, topic, part, at, end, end - at, *tail)


def write_progress(spark: SparkSession, reports: list[dict], path: str) -> None:
    """Append progress reports to the table at ``path``."""
    rows = [row for report in reports for row in progress_rows(report)]
    if rows:
        texts = spark.createDataFrame(rows, SCHEMA.replace("us bigint", "us string"))
        us = F.unix_micros(F.to_timestamp("us"))
        texts.withColumn("us", us).coalesce(1).write.mode("append").parquet(path)


class ProgressTable(StreamingQueryListener):
    """Writes every query's progress to one table (``spark.streams.addListener``).

    Reports are gathered and written ``every`` so many, and what is left when a query ends.
    A report holds one row per partition, so a batch of them is small.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 20):
        self.spark, self.path, self.every = spark, path, every
        self.waiting: list[dict] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.waiting.append(json.loads(event.progress.json))
        if len(self.waiting) >= self.every:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        ready, self.waiting = self.waiting, []
        write_progress(self.spark, ready, self.path)


def latest_lag(progress: DataFrame) -> DataFrame:
    """Newest known lag of each query, topic and partition. A report written twice counts once."""
    at = F.struct("us", "batch")
    return progress.where("lag is not null").groupBy("query", "topic", "partition").agg(
        F.max_by("lag", at).alias("lag"), F.max("us").alias("us")
    )


def lag_alerts(progress: DataFrame, limit: int, hold_minutes: float = 5) -> DataFrame:
    """Stretches in which some partition of a query's topic lags by more than ``limit`` in every
    minute, for at least ``hold_minutes``. A minute without a report ends a stretch."""
    minute = (F.floor(F.col("us") / MINUTE) * MINUTE).cast("bigint").alias("window_us")
    series = progress.where("lag is not null").groupBy("query", "topic", minute).agg(
        F.max("lag").alias("lag")
    )
    return alert_islands(series, F.col("lag") > limit, hold_minutes, by=["query", "topic"])
