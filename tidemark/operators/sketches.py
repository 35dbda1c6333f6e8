"""Drift from stored sketches: one quantile sketch per day and column, merged for any two periods.

A day's rows are read once, when the day is new. Whatever periods are compared later, only the small
sketches are read. The distances come with a bound of their error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.ticks import known
from tidemark.operators.drift import STD_FLOOR, WASSERSTEIN_CUT

SIZE = 2000
# Published accuracy of the sketch: the error of a rank, as a share of n, at 99 % confidence, is
# this constant over a power of the sketch's size.
RANK_ERROR, RANK_POWER = 2.296, 0.9021


def rank_error(size: int = SIZE) -> float:
    """Error of any one rank as a share of the values, at 99 % confidence."""
    return RANK_ERROR / size**RANK_POWER


def day_sketches(
    df: DataFrame, columns: Sequence[str], size: int = SIZE, us: str = "us"
) -> DataFrame:
    """One row per day and column: count, moments, extremes and the sketch of its values.

    Nulls, NaNs and infinities count as missing; rows without a time belong to no day. A column
    without any value on a day has no row. Sketches are built map-side, one shuffle carries them.
    """
    day = F.to_date(F.timestamp_micros(us)).alias("dt")
    wide = df.where(F.col(us).isNotNull()).select(
        day, *[F.col(c).cast("double").alias(c) for c in columns if c != "dt"]
    )
    long = wide.unpivot(["dt"], [c for c in columns if c != "dt"], "feature", "x")
    return (
        long.where(known(F.col("x")).isNotNull() & (F.abs("x") < float("inf")))
        .groupBy("dt", "feature")
        .agg(
            F.count("*").alias("n"),
            F.avg("x").alias("mean"),
            F.var_pop("x").alias("variance"),
            F.min("x").alias("low"),
            F.max("x").alias("high"),
            F.kll_sketch_agg_double("x", F.lit(size)).alias("sketch"),
        )
    )


def store_sketches(
    df: DataFrame, columns: Sequence[str], path: str, size: int = SIZE, us: str = "us"
) -> None:
    """Write the sketches of the days ``df`` holds; a day that is written again replaces itself."""
    (
        day_sketches(df, columns, size, us)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt")
        .parquet(path)
    )


def stored_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def period(sketches: DataFrame, first: str, last: str) -> DataFrame:
    """The sketches of the days from ``first`` to ``last`` (both included) as one per column."""
    days = sketches.where(F.col("dt").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return _merged(days.withColumn("side", F.lit("all"))).drop("side")


def _merged(days: DataFrame) -> DataFrame:
    total = days.groupBy("side", "feature").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("mean")).alias("_sum"),
        # Days are few, so their counts and moments may be carried to the total's mean.
        F.collect_list(F.struct("n", "mean", "variance")).alias("_days"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )
    total = total.withColumn("mean", F.col("_sum") / F.col("n"))
    squares = F.aggregate(
        "_days", F.lit(0.0),
        lambda acc, d: acc + d["n"] * (d["variance"] + (d["mean"] - F.col("mean")) * (d["mean"] - F.col("mean"))),
    )
    return total.withColumn("variance", squares / F.col("n")).drop("_sum", "_days")


def drift_from_sketches(
    reference: DataFrame, current: DataFrame, points: int = 1000, cut: float = WASSERSTEIN_CUT,
    size: int = SIZE,
) -> DataFrame:
    """Wasserstein distance (in reference deviations) and Kolmogorov-Smirnov statistic of two
    periods' sketches, each with a bound of its error.

    With ranks right to e on either side, the distribution functions differ by at most 2e more or less
    than they seem to: that bounds the statistic, and times the width of the values the distance.
    Reading the distance off ``points`` quantiles adds at most the width over ``points``; the
    statistic is read at both sides' quantiles and may miss 1 / points more. ``size`` is that of
    the stored sketches. A side without values has no distance: NULL, and no verdict of drift.
    """
    a = reference.select("feature", *[F.col(c).alias(f"_a_{c}") for c in _USED])
    b = current.select("feature", *[F.col(c).alias(f"_b_{c}") for c in _USED])
    grid = F.array(*[F.lit((i + 0.5) / points) for i in range(points)])
    quantiles = {
        f"_{side}_q": F.kll_sketch_get_quantile_double(f"_{side}_sketch", grid) for side in "ab"
    }
    rows = a.join(b, "feature", "full").withColumns(quantiles)
    area = _total(F.zip_with("_a_q", "_b_q", lambda x, y: F.abs(x - y))) / points
    width = F.greatest("_a_high", "_b_high") - F.least("_a_low", "_b_low")
    unit = F.greatest(F.sqrt("_a_variance"), F.lit(STD_FLOOR))
    both = F.col("_a_n").isNotNull() & F.col("_b_n").isNotNull()
    error = 2 * rank_error(size)
    score = F.when(both, area / unit)
    out = rows.join(_statistic(rows, points), "feature", "left")
    return out.select(
        "feature",
        F.coalesce("_a_n", F.lit(0)).alias("n_ref"),
        F.coalesce("_b_n", F.lit(0)).alias("n_cur"),
        score.alias("score"),
        F.when(both, width * (error + 1 / points) / unit).alias("score_error"),
        F.when(both, F.col("_statistic")).alias("statistic"),
        F.when(both, F.lit(error + 1 / points)).alias("statistic_error"),
        F.coalesce(score >= cut, F.lit(False)).alias("drifted"),
    )


def _statistic(rows: DataFrame, points: int) -> DataFrame:
    """Widest gap of the two distributions that each side's quantiles make up."""
    step = F.explode(
        F.concat(
            F.transform(F.coalesce("_a_q", F.array().cast("array<double>")), lambda x: F.struct(x.alias("x"), F.lit(1).alias("d"))),
            F.transform(F.coalesce("_b_q", F.array().cast("array<double>")), lambda x: F.struct(x.alias("x"), F.lit(-1).alias("d"))),
        )
    )
    # Equal values step together. A column has at most twice ``points`` of them.
    steps = rows.select("feature", step.alias("s")).groupBy("feature", "s.x").agg(F.sum("s.d").alias("d"))
    gap = F.abs(F.sum("d").over(Window.partitionBy("feature").orderBy("x")))
    return steps.withColumn("_gap", gap).groupBy("feature").agg((F.max("_gap") / points).alias("_statistic"))


_USED = ["n", "variance", "low", "high", "sketch"]


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
