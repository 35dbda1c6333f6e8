"""Rolling features and delayed labels on a tick stream.

Row windows do not run on an unbounded table. Each micro-batch therefore takes the stored
ticks its frames reach back to, runs the batch operator on both, and keeps its own rows.
For ticks that come in order the result equals the batch result; a late tick gets its own
features and label but does not change what has been written before. However old a late tick
is, only the stored days around it are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.features import SECOND, FrameSpec, tick_features
from tidemark.operators.labels import spike_label
from tidemark.streaming.store import compact
from tidemark.streaming.tables import (
    DAY,
    joined_spans,
    newest_event,
    own_spans,
    read_before,
    read_own,
    write_batch,
)

TICK_COLUMNS = ["product_id", "us", "seq", "price", "best_bid", "best_ask", "bid_qty", "ask_qty"]


def enough_days(keep_days: int | None, reach: int) -> None:
    """A store must keep the days that a frame ending today can begin in."""
    if keep_days is not None and keep_days < 1 + math.ceil(reach / DAY):
        raise ValueError(f"keep_days {keep_days} is less than the frames reach back")


def upkeep(
    spark: SparkSession, path: str, schema: T.StructType, number: int, every: int | None, keep_days: int | None
) -> None:
    """Compact the store before every ``every``-th batch; those before it are finished for good."""
    if every and number and number % every == 0:
        compact(spark, path, schema, number - 1, keep_days)


def feature_batch(
    ticks_path: str, out_path: str, spec: FrameSpec = FrameSpec(),
    then: Callable[[DataFrame, int], None] | None = None,
    compact_every: int | None = None, keep_days: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each tick's features to ``out_path``.

    ``then`` receives the written features of the batch (to label, score or publish them).
    Every ``compact_every`` batches the tick store is compacted; ``keep_days`` then lets go of older
    days (a tick older than that finds no frame). Read such a store with ``store.stored``.
    """
    reach = max(spec.frames().values())
    enough_days(keep_days, reach)

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        ticks = batch.select(*TICK_COLUMNS)
        upkeep(spark, ticks_path, ticks.schema, number, compact_every, keep_days)
        write_batch(ticks, ticks_path, number)
        own = read_own(spark, ticks_path, ticks.schema, number)
        spans = own_spans(own, back=reach)
        if not spans:
            return
        past = read_before(spark, ticks_path, ticks.schema, number, spans)
        both = own.withColumn("_new", F.lit(True)).unionByName(past.withColumn("_new", F.lit(False)))
        out = tick_features(both, spec, keep=["_new"]).where("_new").drop("_new")
        write_batch(out, out_path, number)
        if then:
            then(read_own(spark, out_path, out.schema, number), number)

    return run


def label_batch(
    rows_path: str, out_path: str, progress_path: str, threshold: float,
    horizon: float = 60, gap: float = 300,
    compact_every: int | None = None, keep_days: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that labels rows once their horizon has passed.

    A row at t is labelled by the batch that first sees an event later than t + horizon; a row that
    arrives later than that is labelled by its own batch. The threshold is a stored one. ``progress_path`` keeps the newest event time per batch.
    """
    h = int(horizon * SECOND)
    enough_days(keep_days, h)

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.select("product_id", "us", "seq", "price")
        upkeep(spark, rows_path, rows.schema, number, compact_every, keep_days)
        write_batch(rows, rows_path, number)
        own = read_own(spark, rows_path, rows.schema, number)
        spans = own_spans(own, ahead=h)
        before, now = newest_event(spark, progress_path, number, own.agg(F.max("us")).first()[0])
        if now is None:
            return
        # Rows that waited for their horizon are at most that old; late ones come with this batch.
        waited = [] if before is None else [(before - h, before)]
        past = read_before(spark, rows_path, rows.schema, number, joined_spans(waited + spans))
        both = own.withColumn("_new", F.lit(True)).unionByName(past.withColumn("_new", F.lit(False)))
        labeled = spike_label(both, horizon, gap, threshold=threshold, keep=["_new"])
        due = F.lit(False) if before is None else F.col("us") >= before - h
        ready = (F.col("us") < now - h) & (F.col("_new") | due)
        write_batch(labeled.where(ready).drop("_new"), out_path, number)

    return run


def start(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str,
    available_now: bool = False, every: str | None = None,
) -> StreamingQuery:
    """Start a query that hands every micro-batch to ``each``."""
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()
