"""Batch-numbered tables: what a micro-batch writes, a repeat of that batch writes over."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tidemark.streaming.store import remove, stored

DAY = 86_400_000_000


def with_day(df: DataFrame, batch: int, us: str = "us") -> DataFrame:
    """Add the partition columns ``day`` (number of the day) and ``batch``."""
    return df.withColumns(
        {"day": F.floor(F.col(us) / DAY).cast("int"), "batch": F.lit(batch).cast("bigint")}
    )


def write_batch(df: DataFrame, path: str, batch: int, us: str = "us") -> None:
    """Write one micro-batch. Only this batch's partitions are replaced, so a batch that
    Spark repeats after a failure leaves the table as if it had run once."""
    (
        with_day(df, batch, us)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day", "batch")
        .parquet(path)
    )


def read_own(spark: SparkSession, path: str, schema: T.StructType, batch: int) -> DataFrame:
    """What a micro-batch wrote."""
    try:
        return spark.read.schema(schema).parquet(f"{path}/*/batch={batch}")
    except AnalysisException:
        return spark.createDataFrame([], schema)


def own_spans(own: DataFrame, back: int = 0, ahead: int = 0) -> list[tuple[int, int]]:
    """The stretches of time around the rows of a batch, one for each day it has rows of."""
    day = F.floor(F.col("us") / DAY).alias("day")
    rows = own.where("us is not null").groupBy(day).agg(F.min("us"), F.max("us")).collect()
    return joined_spans([(r[1] - back, r[2] + ahead) for r in rows])


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches in order, overlapping ones put together."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def read_before(
    spark: SparkSession, path: str, schema: T.StructType, batch: int, spans: list[tuple[int, int]]
) -> DataFrame:
    """Rows of earlier batches within any of ``spans``. Only the folders of those days are read."""
    days = {d for begin, end in spans for d in range(begin // DAY, end // DAY + 1)}
    rows = stored(spark, path, schema, days)
    wanted = F.lit(False)
    for begin, end in spans:
        wanted = wanted | F.col("us").between(begin, end)
    return rows.where(wanted & (F.col("batch") < batch)).drop("day", "batch")


def newest_event(spark: SparkSession, path: str, batch: int, own: int | None) -> tuple:
    """Newest event time before and after this batch.

    Each batch leaves one row in a folder of its own and reads that of the batch before it;
    older ones are deleted, so neither cost nor files grow with the age of the stream.
    """
    schema = "us bigint"
    try:
        row = spark.read.schema(schema).parquet(f"{path}/batch={batch - 1}").first()
        before = row[0] if row else None
    except AnalysisException:
        before = None
    after = max((x for x in (before, own) if x is not None), default=None)
    one = spark.createDataFrame([(after,)], schema).coalesce(1)
    one.write.mode("overwrite").parquet(f"{path}/batch={batch}")
    remove(spark, f"{path}/batch={batch - 2}")
    return before, after
