"""Filters, limits and time or stratified splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranges import cut_keys
from tidemark.session import materialize

# Two hash values per class; up to this many classes they are sent to every task.
BROADCAST_CLASSES = 100_000


def _minutes(minutes: float) -> Column:
    """An interval to the microsecond; fractions of a minute count."""
    return F.make_dt_interval(secs=F.lit(f"{minutes * 60:.6f}").cast("decimal(18,6)"))


def time_slice(
    df: DataFrame, now: Column, hours: float | None, buffer_minutes: float = 0, ts: str = "ts"
) -> DataFrame:
    """Rows with now - hours <= ts <= now - buffer; without ``hours`` all up to the buffer."""
    newest = now - _minutes(buffer_minutes)
    df = df.where(F.col(ts) <= newest)
    if hours is None:
        return df
    return df.where(F.col(ts) >= now - _minutes(hours * 60))


def pair_filter(df: DataFrame, pairs: Sequence[str]) -> DataFrame:
    return df.where(F.col("product_id").isin(list(pairs)))


def first_n(df: DataFrame, n: int, order: Sequence[str] = ("us", "seq")) -> DataFrame:
    """The first n rows in time (each task keeps n rows, no full sort)."""
    return df.orderBy(*order).limit(n)


def time_split(
    df: DataFrame,
    shares: Sequence[float],
    names: Sequence[str],
    order: tuple[str, str] = ("us", "seq"),
    column: str = "split",
) -> DataFrame:
    """Name each row by its place in time: the first ``int(n * share)`` rows, and so on.

    ``shares`` are cumulative. Only the order keys at the cuts are looked up, so the rows
    themselves are neither sorted nor shuffled.
    """
    time, tie = (F.col(c) for c in order)
    label = F.lit(names[-1])
    for key, name in reversed(list(zip(cut_keys(df, order, shares), names))):
        if key is None:
            label = F.lit(name)
            continue
        before = (time < key[0]) | ((time == key[0]) & (tie < key[1]))
        label = F.when(before, F.lit(name)).otherwise(label)
    return df.withColumn(column, label)


def split_ratio(df: DataFrame, ratio: float = 0.5, **kw) -> DataFrame:
    """Early rows as ``reference``, late ones as ``current``."""
    return time_split(df, [ratio], ["reference", "current"], **kw)


def split_train_test(df: DataFrame, val: float = 0.15, test: float = 0.15, **kw) -> DataFrame:
    return time_split(df, [1 - val - test, 1 - test], ["train", "val", "test"], **kw)


def split_stratified(
    df: DataFrame, label: str, key: Sequence[str], val: float = 0.15, test: float = 0.15,
    column: str = "split", spread: Column | None = None,
) -> DataFrame:
    """Train/val/test with the same label rate in each part.

    Within each label the rows are cut at two values of a hash of their key. The hash makes
    the parts the same on every run; rows are neither sorted nor shuffled, and all labels are
    narrowed in the same three passes over (label, hash). ``spread`` is a BIGINT to cut by
    instead of the hash. A NULL label is a class of its own; rows of one hash value stay in one part.
    """
    shares = (1 - val - test, 1 - test)
    hashed = df.withColumns(
        {"_y": F.struct(label), "_h": F.xxhash64(*key) if spread is None else spread}
    )
    cuts = materialize(_class_cuts(hashed.select("_y", "_h"), shares))
    if cuts.count() <= BROADCAST_CLASSES:
        cuts = F.broadcast(cuts)
    # No cut: the whole class lies before it.
    before = [F.coalesce(F.col("_h") < F.col(f"_cut{i}"), F.lit(True)) for i in range(2)]
    part = F.when(before[0], "train").when(before[1], "val").otherwise("test")
    rows = hashed.join(cuts, "_y", "left").withColumn(column, part)
    return rows.select(*[c for c in df.columns if c != column], column)


def _class_cuts(hashed: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Per class ``_y`` the hash value that follows the first ``ceil(n * share)`` rows.

    Counts by the top 16 bits name the value range that holds each cut, those of the next 16
    bits the range within it, and what is left of a class (its 2 ** -32nd part) is counted by
    value. No window sees more than 65,536 counts.
    """
    top, inner = F.shiftright("_h", 48), F.shiftright("_h", 32)
    counts = materialize(hashed.groupBy("_y", top.alias("_d")).agg(F.count("*").alias("_n")))
    ranks = F.array(
        *[
            F.struct(F.lit(i).alias("_i"), (F.ceil(F.col("_all") * s) + 1).alias("_rank"))
            for i, s in enumerate(shares)
        ]
    )
    wanted = counts.groupBy("_y").agg(F.sum("_n").alias("_all")).select("_y", F.inline(ranks))
    found = _holding(counts.join(wanted, "_y"))
    for prefix, digit in ((top, inner), (inner, F.col("_h"))):
        rows = hashed.withColumns({"_d": prefix, "_next": digit}).join(found, ["_y", "_d"])
        counts = rows.groupBy("_y", "_i", "_rank", F.col("_next").alias("_d")).agg(
            F.count("*").alias("_n")
        )
        found = materialize(_holding(counts))
    cut = [F.max(F.when(F.col("_i") == i, F.col("_d"))).alias(f"_cut{i}") for i in range(len(shares))]
    return found.groupBy("_y").agg(*cut)


def _holding(counts: DataFrame) -> DataFrame:
    """The value range that holds each wanted rank, and the rank within it."""
    upto = F.sum("_n").over(Window.partitionBy("_y", "_i").orderBy("_d"))
    placed = counts.withColumns({"_upto": upto, "_below": upto - F.col("_n")})
    return placed.where("_rank > _below and _rank <= _upto").select(
        "_y", "_i", "_d", (F.col("_rank") - F.col("_below")).alias("_rank")
    )
