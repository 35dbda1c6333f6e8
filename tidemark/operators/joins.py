"""As-of joins and key-based deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranges import RANGE, assign_range, running, settled


def asof_join(
    left: DataFrame,
    right: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    direction: str = "nearest",
    tolerance: int | None = None,
    on: str = "us",
    tie: str | None = "seq",
    distance: str | None = None,
) -> DataFrame:
    """Each left row with ``columns`` of the right row closest in time.

    ``direction`` is ``backward`` (at or before), ``forward`` (at or after) or ``nearest``;
    at equal distance nearest takes the earlier side. ``tolerance`` and ``on`` are integers
    of one unit (micros). Among right rows of one time, backward takes the last and forward
    the first in ``tie`` order. ``distance`` names an output column with right - left.

    Both sides are put on one time line and scanned once per direction, so no candidate
    pairs arise however dense the data is. The line is cut into ranges; the last and first
    right row of each range are handed to its neighbours. A time that holds many rows is a
    range of its own, whose left rows take their answer from that hand-over.
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(direction)
    by = list(by)
    hit = F.struct(
        F.col(on).alias("at"),
        *([F.col(tie).alias("tie")] if tie else []),
        *[F.col(c).alias(c) for c in columns],
    )
    own = [c for c in left.columns if c not in by]
    line = left.select(
        *by, F.col(on).alias("_t"), F.lit(1).alias("_side"), F.struct(*own).alias("_row"),
    ).unionByName(
        right.where(F.col(on).isNotNull()).select(
            *by, F.col(on).alias("_t"), F.lit(0).alias("_side"), hit.alias("_hit")
        ),
        allowMissingColumns=True,
    )
    line, points = settled(line, "_t")
    line = assign_range(line, "_t", points)
    keys = [*by, RANGE]
    rank = "_hit.tie" if tie else "_side"
    # All left rows of one time have one answer: a time that fills ranges needs no scan.
    heavy = F.col(RANGE).isin(points.heavy_ranges()) if points and points.heavy else F.lit(False)

    found = line.where(~heavy)
    if direction != "forward":
        found = found.withColumn("_back", _scan(keys, F.col("_t"), F.col("_side"), F.col(rank)))
    if direction != "backward":
        found = found.withColumn(
            "_fwd", _scan(keys, F.desc("_t"), F.col("_side"), F.desc(rank))
        )
    found = found.where("_side = 1")
    if points:
        edges = _edges(line, by, tie)
        found = _carry(found, edges, by, direction)
        if points.heavy:
            crowd = _crowd(line.where(heavy & (F.col("_side") == 1)), edges.where(heavy), by, direction, max(points.heavy.values()))
            found = found.unionByName(crowd)

    near = {
        "backward": lambda: F.col("_back"),
        "forward": lambda: F.col("_fwd"),
        "nearest": lambda: F.when(
            F.col("_fwd").isNull()
            | (F.col("_t") - F.col("_back.at") <= F.col("_fwd.at") - F.col("_t")),
            F.coalesce(F.col("_back"), F.col("_fwd")),
        ).otherwise(F.col("_fwd")),
    }[direction]()
    out = found.withColumn("_near", near)
    if tolerance is not None:
        close = F.abs(F.col("_near.at") - F.col("_t")) <= tolerance
        out = out.withColumn("_near", F.when(close, F.col("_near")))
    extra = [(F.col("_near.at") - F.col("_t")).alias(distance)] if distance else []
    return out.select(
        *by,
        *[F.col(f"_row.{c}").alias(c) for c in own],
        *[F.col(f"_near.{c}").alias(c) for c in columns],
        *extra,
    )


def _scan(keys: list[str], *order: Column) -> Column:
    """The latest right row seen while walking a range in ``order``."""
    walk = Window.partitionBy(*keys).orderBy(*order)
    return F.last("_hit", ignorenulls=True).over(walk.rowsBetween(Window.unboundedPreceding, 0))


def _edges(line: DataFrame, by: list[str], tie: str | None) -> DataFrame:
    """Last and first right row of each range, and those nearest before and after it."""
    place = F.struct("_t", "_hit.tie") if tie else F.col("_t")
    place = F.when(F.col("_side") == 0, place)
    edge = line.groupBy(*by, RANGE).agg(
        F.max_by("_hit", place).alias("_last"), F.min_by("_hit", place).alias("_first")
    )
    ranges = Window.partitionBy(*by)
    past = ranges.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    coming = ranges.orderBy(F.desc(RANGE)).rowsBetween(Window.unboundedPreceding, -1)
    return edge.select(
        *by,
        RANGE,
        "_last",
        "_first",
        F.last("_last", ignorenulls=True).over(past).alias("_past"),
        F.last("_first", ignorenulls=True).over(coming).alias("_coming"),
    )


def _carry(found: DataFrame, edges: DataFrame, by: list[str], direction: str) -> DataFrame:
    """Fill rows at a range's edge from the ranges before and after it."""
    found = found.join(edges.drop("_last", "_first"), [*by, RANGE], "left")
    if direction != "forward":
        found = found.withColumn("_back", F.coalesce("_back", "_past"))
    if direction != "backward":
        found = found.withColumn("_fwd", F.coalesce("_fwd", "_coming"))
    return found.drop("_past", "_coming")


def _crowd(rows: DataFrame, edges: DataFrame, by: list[str], direction: str, parts: int) -> DataFrame:
    """Left rows of the times that hold very many rows: dealt to ``parts`` tasks per time, each
    of which gets its copy of the time's last and first right row."""
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("_row"), F.lit(parts)).cast("int"))
    copies = edges.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    found = rows.join(copies, [*by, RANGE, "_part"], "left")
    if direction != "forward":
        found = found.withColumn("_back", F.coalesce("_last", "_past"))
    if direction != "backward":
        found = found.withColumn("_fwd", F.coalesce("_first", "_coming"))
    return found.drop("_part", "_last", "_first", "_past", "_coming")


def first_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key, the first in ``order``; rows without a value there come last.

    An aggregate with a map-side half, so a key with very many copies is thinned out
    before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.struct(F.col(order).isNull(), F.col(order))
    row = F.min_by(F.struct(*rest), first).alias("_row")
    return df.groupBy(*keys).agg(row).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def new_rows(
    stored: DataFrame, incoming: DataFrame, keys: Sequence[str] = ("us", "product_id"),
    order: str = "seq",
) -> DataFrame:
    """Incoming rows whose key is not stored yet, one per key."""
    fresh = incoming.join(stored.select(*keys), list(keys), "left_anti")
    return first_per_key(fresh, keys, order)


def dedup_append(
    stored: DataFrame, incoming: DataFrame, keys: Sequence[str] = ("us", "product_id"),
    order: str = "seq",
) -> DataFrame:
    """Stored rows and the new ones."""
    return stored.unionByName(new_rows(stored, incoming, keys, order), allowMissingColumns=True)


def duplicate_keys(
    stored: DataFrame, incoming: DataFrame, keys: Sequence[str] = ("us", "product_id")
) -> DataFrame:
    """Distinct keys of the incoming rows that are stored already."""
    return incoming.select(*keys).distinct().join(
        stored.select(*keys), list(keys), "left_semi"
    )


def consolidate(
    parts: Sequence[DataFrame], min_gap: int, keys: Sequence[str] = ("us", "product_id"),
    by: Sequence[str] = ("product_id",), order: str = "seq",
) -> DataFrame:
    """Several feature tables as one, without copies and without rows closer than ``min_gap``
    micros to the row before them."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    single, points = settled(first_per_key(merged, keys, order), "us", merged.count())
    spaced = running(
        single, by, ["us"], {"_prev": ("max", F.col("us"))}, points, inclusive=False
    )
    return spaced.where(
        F.col("_prev").isNull() | (F.col("us") - F.col("_prev") >= min_gap)
    ).drop("_prev")
