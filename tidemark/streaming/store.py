"""Compaction and retention of batch-numbered tables.

Each micro-batch leaves a folder per day (see ``tables.write_batch``), so a long stream would leave
ever more small files. ``compact`` brings the rows of finished batches into one segment for each
day they touch, and then writes a manifest: the last batch that is in segments, the first day
still kept, and the segment of each day. A manifest counts from the moment its ``_SUCCESS`` mark
is there, so readers see either the old state or the new one. What neither the newest manifest nor
the one before it names is deleted, hence a reader that has just taken a manifest can finish.
A compaction that fails half-way leaves nothing that is read; the next one writes over it.
One writer at a time: a stream compacts between its own batches.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_DAY = "__HIVE_DEFAULT_PARTITION__"
ROWS_PER_FILE = 5_000_000
MANIFEST = "upto bigint, first_day int, segments array<struct<day: int, version: bigint>>"


@dataclass
class Manifest:
    """``upto``: the last batch in segments; ``segments``: day (None: rows without a time) -> version."""

    upto: int = -1
    first_day: int | None = None
    segments: dict[int | None, int] = field(default_factory=dict)

    def keeps(self, day: int | None) -> bool:
        return day is None or self.first_day is None or day >= self.first_day


def _files(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern."""
    where = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return [f.getPath().toString() for f in found or ()]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _number(path: str, name: str) -> int | None:
    """The value of a partition folder on a path, None for the folder of missing values."""
    value = next(p for p in path.split("/") if p.startswith(f"{name}="))[len(name) + 1 :]
    return None if value == NO_DAY else int(value)


def _name(day: int | None) -> str:
    return f"day={NO_DAY if day is None else day}"


def _versions(spark: SparkSession, path: str) -> list[int]:
    marks = _files(spark, f"{path}/_manifest/version=*/_SUCCESS")
    return sorted(_number(f.split("/")[-2], "version") for f in marks)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest:
    """The newest manifest, or a given one; an empty one for a table that was never compacted."""
    if version is None:
        version = max(_versions(spark, path), default=None)
    if version is None:
        return Manifest()
    row = spark.read.schema(MANIFEST).parquet(f"{path}/_manifest/version={version}").first()
    return Manifest(row["upto"], row["first_day"], {s["day"]: s["version"] for s in row["segments"]})


def _batches(spark: SparkSession, path: str) -> list[tuple[int | None, int, str]]:
    """(day, batch, path) of the folders that micro-batches left."""
    found = _files(spark, f"{path}/day=*/batch=*")
    return [(_number("/".join(f.split("/")[-2:]), "day"), _number(f.split("/")[-1], "batch"), f) for f in found]


def _rows(
    spark: SparkSession, path: str, schema: T.StructType, now: Manifest, days: set | None, upto: int | None = None
) -> DataFrame:
    """Rows with ``batch`` and ``day``, of segments and of the batches after them."""
    batch, day = T.StructField("batch", T.LongType()), T.StructField("day", T.IntegerType())

    def wanted(d):
        return now.keeps(d) and (days is None or d in days)

    out = spark.createDataFrame([], T.StructType([*schema.fields, day, batch]))
    for version in sorted({v for d, v in now.segments.items() if wanted(d)}):
        base = f"{path}/_segments/version={version}"
        paths = [f"{base}/{_name(d)}" for d, v in now.segments.items() if v == version and wanted(d)]
        full = T.StructType([*schema.fields, batch, day])
        out = out.unionByName(spark.read.schema(full).option("basePath", base).parquet(*paths))
    fresh = [p for d, n, p in _batches(spark, path) if n > now.upto and wanted(d) and (upto is None or n <= upto)]
    if fresh:
        full = T.StructType([*schema.fields, day, batch])
        out = out.unionByName(spark.read.schema(full).option("basePath", path).parquet(*fresh))
    return out


def stored(spark: SparkSession, path: str, schema: T.StructType, days: set | None = None) -> DataFrame:
    """The table with its ``day`` and ``batch``; only the folders of ``days`` are read."""
    return _rows(spark, path, schema, manifest(spark, path), days)


def compact(
    spark: SparkSession, path: str, schema: T.StructType, upto: int, keep_days: int | None = None,
    rows_per_file: int = ROWS_PER_FILE, today: int | None = None,
) -> Manifest:
    """Bring the batches up to ``upto``, which must not be repeated any more, into segments.

    Only days that got rows since the last time are written anew, in files of even row counts
    and in order of ``us``. With ``keep_days`` the days before the newest ones go; a day after
    ``today`` (by default that of the clock) is no newest day, so a wrong clock on one row
    expires nothing, and the first kept day never moves back. Rows without a time are kept.
    A table without new batches, or with all of them in segments, stays as it is.
    """
    now = manifest(spark, path)
    if now.upto < upto:
        touched = {d for d, n, _ in _batches(spark, path) if now.upto < n <= upto}
        later = Manifest(upto, now.first_day, {})
        if keep_days is not None:
            today = int(time.time() // 86_400) if today is None else today
            past = [d for d in {*touched, *now.segments} if d is not None and d <= today]
            first = [max(past) - keep_days + 1] if past else []
            later.first_day = max([*first, *([now.first_day] if now.first_day is not None else [])], default=None)
        later.segments = {d: v for d, v in now.segments.items() if later.keeps(d)}
        anew = {d for d in touched if later.keeps(d)}
        if anew:
            _write_segments(_rows(spark, path, schema, now, anew, upto), f"{path}/_segments/version={upto}", rows_per_file)
            later.segments |= dict.fromkeys(anew, upto)
        _commit(spark, path, later)
        now = later
    _sweep(spark, path, now)
    return now


def _write_segments(rows: DataFrame, path: str, rows_per_file: int) -> None:
    """One folder per day. Files are cut by time, and within one time by a hash of the row."""
    sizes = rows.groupBy("day").count().collect()
    files = max(1, sum(math.ceil(r["count"] / rows_per_file) for r in sizes))
    tie = F.xxhash64(*[c for c in rows.columns if c not in ("day", "us")])
    cut = rows.repartitionByRange(files, "day", "us", tie).sortWithinPartitions("day", "us")
    cut.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("day").parquet(path)


def _commit(spark: SparkSession, path: str, new: Manifest) -> None:
    row = (new.upto, new.first_day, list(new.segments.items()))
    one = spark.createDataFrame([row], MANIFEST).coalesce(1)
    one.write.mode("overwrite").parquet(f"{path}/_manifest/version={new.upto}")


def _sweep(spark: SparkSession, path: str, now: Manifest) -> None:
    """Delete what neither this manifest nor the one before it names."""
    earlier = [v for v in _versions(spark, path) if v < now.upto]
    before = manifest(spark, path, earlier[-1]) if earlier else Manifest()
    live = {*now.segments.items(), *before.segments.items()}
    for day, batch, folder in _batches(spark, path):
        if batch <= before.upto:
            remove(spark, folder)
    for folder in _files(spark, f"{path}/_segments/version=*/day=*"):
        version, day = folder.split("/")[-2:]
        version = _number(version, "version")
        if version <= now.upto and (_number(day, "day"), version) not in live:
            remove(spark, folder)
    for version in earlier[:-1]:
        remove(spark, f"{path}/_manifest/version={version}")
    kept = {v for _, v in live}
    for folder in _files(spark, f"{path}/_segments/version=*"):
        version = _number(folder.split("/")[-1], "version")
        if version <= now.upto and version not in kept:
            remove(spark, folder)
    used = {d for d, _, _ in _batches(spark, path)}
    for folder in _files(spark, f"{path}/day=*"):
        day = _number(folder.split("/")[-1], "day")
        if day not in used and not now.keeps(day):
            remove(spark, folder)
