"""The z-score baseline and table scoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ticks import alias_map, default_fill
from tidemark.schema import DEFAULT_THRESHOLD, MODEL_FEATURES

EPS = 1e-8
SPIKE_Z = 2.0


def fit_baseline(df: DataFrame, features: Sequence[str] = tuple(MODEL_FEATURES)) -> DataFrame:
    """One row of statistics: mean and deviation of each feature, and of the composite."""
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    value = {f: F.nanvl(F.col(f).cast("double"), F.lit(None)) for f in features}
    single = df.agg(
        *[F.coalesce(F.avg(v), F.lit(0.0)).alias(f"{f}_mean") for f, v in value.items()],
        *[_floor(F.stddev_samp(v)).alias(f"{f}_std") for f, v in value.items()],
    )
    composite = df.crossJoin(F.broadcast(single)).select(composite_score(features).alias("c"))
    whole = composite.agg(
        F.coalesce(F.avg("c"), F.lit(0.0)).alias("composite_mean"),
        _floor(F.stddev_samp("c")).alias("composite_std"),
    )
    return single.crossJoin(F.broadcast(whole))


def _floor(deviation: Column) -> Column:
    return F.greatest(F.coalesce(deviation, F.lit(0.0)), F.lit(EPS))


def composite_score(features: Sequence[str]) -> Column:
    """Mean over the features of their z-scores; a missing value counts as the mean."""
    parts = []
    for f in features:
        mean, std = F.col(f"{f}_mean"), F.col(f"{f}_std")
        value = F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(None)), mean)
        parts.append((value - mean) / (std + EPS))
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total / len(parts)


def baseline_score(
    df: DataFrame,
    stats: DataFrame,
    features: Sequence[str] = tuple(MODEL_FEATURES),
    threshold: float = SPIKE_Z,
) -> DataFrame:
    """Add ``z_score``, ``probability`` (its sigmoid) and ``prediction``."""
    scored = df.crossJoin(F.broadcast(stats)).withColumn("_c", composite_score(features))
    z = (F.col("_c") - F.col("composite_mean")) / (F.col("composite_std") + EPS)
    return (
        scored.withColumn("z_score", z)
        .withColumns(
            {
                "probability": 1 / (1 + F.exp(-F.col("z_score"))),
                "prediction": (F.col("z_score") >= threshold).cast("int"),
            }
        )
        .drop("_c", *stats.columns)
    )


Scorer = Callable[[DataFrame], DataFrame]


def baseline_scorer(stats: DataFrame) -> Scorer:
    """The baseline as a function that adds ``probability``."""
    return lambda df: baseline_score(df, stats).drop("z_score", "prediction")


def pipeline_scorer(model) -> Scorer:
    """A fitted ``pyspark.ml`` pipeline as a function that adds ``probability``."""
    from pyspark.ml.functions import vector_to_array

    def score(df: DataFrame) -> DataFrame:
        out = model.transform(df)
        value = vector_to_array(F.col("probability"))[1]
        return out.select(*df.columns, value.alias("probability"))

    return score


def python_scorer(predict: Callable, features: Sequence[str] = tuple(MODEL_FEATURES)) -> Scorer:
    """An external Python model, called with one pandas frame per Arrow batch."""
    @F.pandas_udf("double")
    def run(columns: pd.DataFrame) -> pd.Series:
        return pd.Series(predict(columns))

    return lambda df: df.withColumn("probability", run(F.struct(*features)))


def score_table(
    df: DataFrame,
    scorers: dict[str, Scorer],
    variant: str = "baseline",
    threshold: float | Column = DEFAULT_THRESHOLD,
    version: str | None = None,
) -> DataFrame:
    """Score a batch or streaming table with the chosen model variant.

    Short request names are mapped, missing features filled, and the score is rounded to
    four places before it is compared with the threshold. Switching ``variant`` is the
    rollback from a model to the baseline.
    """
    if variant not in scorers:
        raise ValueError(f"unknown variant {variant}; have {sorted(scorers)}")
    ready = default_fill(alias_map(df))
    raw = scorers[variant](ready)
    return (
        raw.withColumn("score", F.round("probability", 4))
        .withColumn("prediction", (F.col("score") >= threshold).cast("int"))
        .withColumns(
            {
                "alert": F.col("prediction") == 1,
                "model_variant": F.lit(variant),
                "model_version": F.lit(version or f"v1.2-{variant}"),
            }
        )
    )


def prediction_log(scored: DataFrame, features: Sequence[str] = tuple(MODEL_FEATURES)) -> DataFrame:
    """Scored rows in the shape of the prediction log."""
    return scored.select(
        "us", "product_id", "model_variant", "model_version", "score", "prediction",
        F.struct(*features).alias("features"),
    )
