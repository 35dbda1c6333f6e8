"""Stateless and counting stream operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.scoring import Scorer, score_table
from tidemark.streaming.tables import newest_event, write_batch


def dedup(stream: DataFrame, ts: str = "ts", keys: Sequence[str] = ("product_id",),
          delay: str = "10 minutes") -> DataFrame:
    """Drop repeats of (time, key) that come within the watermark delay."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([ts, *keys])


def score_stream(stream: DataFrame, scorers: dict[str, Scorer], variant: str = "baseline",
                 threshold: float | Column = 0.05) -> DataFrame:
    """Scoring has no state: the batch operator as it is."""
    return score_table(stream, scorers, variant, threshold)


def counters(stream: DataFrame, *keys: str, ts: str = "ts", length: str = "5 minutes",
             slide: str | None = None, delay: str = "1 minute") -> DataFrame:
    """Event counts by label in tumbling or sliding windows."""
    window = F.window(F.col(ts), length, slide) if slide else F.window(F.col(ts), length)
    return (
        stream.withWatermark(ts, delay)
        .groupBy(window.alias("window"), *keys)
        .agg(F.count("*").alias("n"))
    )


def late_batch(
    on_time_path: str, late_path: str, progress_path: str, delay_us: int
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that puts rows older than the newest event of earlier
    batches less ``delay_us`` into a table of their own."""

    def run(batch: DataFrame, number: int) -> None:
        newest = batch.agg(F.max("us")).first()[0]
        mark, _ = newest_event(batch.sparkSession, progress_path, number, newest)
        late = F.lit(False) if mark is None else F.col("us") < mark - delay_us
        write_batch(batch.where(~late), on_time_path, number)
        write_batch(batch.where(late), late_path, number)

    return run


def lag_rows(query: StreamingQuery) -> list[dict]:
    """End less committed offset per topic and partition, from the last progress report."""
    progress = query.lastProgress
    out = []
    for source in (progress or {}).get("sources", []):
        newest, done = source.get("latestOffset"), source.get("endOffset")
        if not (isinstance(newest, dict) and isinstance(done, dict)):
            continue
        for topic, parts in newest.items():
            if not isinstance(parts, dict):
                continue
            for part, end in parts.items():
                at = (done.get(topic) or {}).get(part, 0)
                out.append({"topic": topic, "partition": int(part), "lag": int(end) - int(at)})
    return out


def rate_rows(query: StreamingQuery) -> list[dict]:
    """Rows per second of each finished micro-batch."""
    return [
        {
            "batch": p["batchId"],
            "rows": p["numInputRows"],
            "rows_per_second": p.get("processedRowsPerSecond"),
        }
        for p in query.recentProgress
    ]
