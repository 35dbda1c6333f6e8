"""Replay of recorded ticks under new times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.splits import first_n


def retime(
    df: DataFrame, start_us: int | Column, keep_ts: bool = False, limit: int | None = None,
    speed: float = 1.0, us: str = "us",
) -> DataFrame:
    """Shift the recording so that its first tick happens at ``start_us``.

    ``speed`` divides the distances (a stream then plays faster); ``limit`` takes the first
    rows in time only.
    """
    rows = first_n(df, limit, (us, "seq")) if limit else df
    if keep_ts:
        return rows
    start = F.lit(start_us) if isinstance(start_us, int) else start_us
    first = rows.agg(F.min(us).alias("_first"))
    shift = F.col(us) - F.col("_first")
    if speed != 1.0:
        shift = F.round(shift / speed).cast("bigint")
    return rows.crossJoin(F.broadcast(first)).withColumn(us, start + shift).drop("_first")
