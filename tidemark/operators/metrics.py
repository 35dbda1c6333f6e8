"""Quality of scores against labels: ranking, classification, thresholds, live performance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import asof_join
from tidemark.operators.ranges import quantiles, running
from tidemark.session import materialize


def _score(column: str, rounded: bool) -> Column:
    value = F.col(column).cast("double")
    return (F.round(value, 4) if rounded else value).alias("score")


def score_curve(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    by: Sequence[str] = (),
    rounded: bool = False,
) -> DataFrame:
    """Positives and rows of each distinct score, and running counts from the top score.

    ``rounded`` takes the scores in four places, as they are logged.
    """
    groups = df.groupBy(*by, _score(score, rounded)).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"), F.count("*").alias("n")
    )
    groups = groups.withColumn("_down", -F.col("score"))
    values = {"cum_pos": ("sum", F.col("pos")), "cum_n": ("sum", F.col("n"))}
    return running(groups, by, ["_down"], values).drop("_down")


def _average_precision() -> Column:
    # Counts are multiplied as DOUBLE: their products do not fit into BIGINT.
    part = F.sum(F.col("pos").cast("double") * F.col("cum_pos") / F.col("cum_n"))
    return F.coalesce(F.try_divide(part, F.sum("pos").cast("double")), F.lit(0.0))


def _roc_auc() -> Column:
    """Share of (positive, negative) pairs in the right order, ties half."""
    pos, neg = F.col("pos").cast("double"), (F.col("n") - F.col("pos")).cast("double")
    cum_neg = F.col("cum_n") - F.col("cum_pos")
    p, n = F.sum("pos").cast("double"), F.sum(F.col("n") - F.col("pos")).cast("double")
    above = F.sum(pos * (cum_neg - neg))
    equal = F.sum(pos * neg)
    return F.coalesce(1 - F.try_divide(above + equal / 2, p * n), F.lit(0.0))


def average_precision(df: DataFrame, by: Sequence[str] = (), **kw) -> DataFrame:
    """Sum over falling scores of the recall step times the precision."""
    return score_curve(df, by=by, **kw).groupBy(*by).agg(
        _average_precision().alias("average_precision")
    )


def roc_auc(df: DataFrame, by: Sequence[str] = (), **kw) -> DataFrame:
    return score_curve(df, by=by, **kw).groupBy(*by).agg(_roc_auc().alias("roc_auc"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def confusion(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """The four counts, right also when only one class is present."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.groupBy(*by).agg(
        F.count_if(y & p).alias("true_positives"),
        F.count_if(~y & p).alias("false_positives"),
        F.count_if(~y & ~p).alias("true_negatives"),
        F.count_if(y & ~p).alias("false_negatives"),
    )


def precision_recall(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 (0 where undefined) and sample counts from the confusion counts."""
    tp, fp = F.col("true_positives"), F.col("false_positives")
    tn, fn = F.col("true_negatives"), F.col("false_negatives")
    return counts.withColumns(
        {
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1_score": _ratio(2 * tp, 2 * tp + fp + fn),
            "total_samples": tp + fp + tn + fn,
            "positive_samples": tp + fn,
            "negative_samples": fp + tn,
            "spike_rate": _ratio(tp + fn, tp + fp + tn + fn),
        }
    )


def classification_metrics(
    df: DataFrame,
    by: Sequence[str] = (),
    label: str = "label",
    score: str = "score",
    prediction: str = "prediction",
    rounded: bool = False,
) -> DataFrame:
    """All metrics of each key from one grouping by score."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    groups = df.groupBy(*by, _score(score, rounded)).agg(
        F.count_if(y).alias("pos"),
        F.count("*").alias("n"),
        F.count_if(y & p).alias("tp"),
        F.count_if(p).alias("predicted"),
    ).withColumn("_down", -F.col("score"))
    values = {"cum_pos": ("sum", F.col("pos")), "cum_n": ("sum", F.col("n"))}
    curve = running(groups, by, ["_down"], values)
    tp, predicted, pos, n = (F.sum(c) for c in ("tp", "predicted", "pos", "n"))
    counts = curve.groupBy(*by).agg(
        _average_precision().alias("pr_auc"),
        _roc_auc().alias("roc_auc"),
        F.coalesce(tp, F.lit(0)).alias("true_positives"),
        F.coalesce(predicted - tp, F.lit(0)).alias("false_positives"),
        F.coalesce(n - pos - predicted + tp, F.lit(0)).alias("true_negatives"),
        F.coalesce(pos - tp, F.lit(0)).alias("false_negatives"),
    )
    return precision_recall(counts)


def metrics_by_window(df: DataFrame, seconds: int, **kw) -> DataFrame:
    """The metrics of every tumbling time window in one query."""
    size = seconds * 1_000_000
    start = (F.floor(F.col("us") / size) * size).cast("bigint")
    return classification_metrics(df.withColumn("window_us", start), by=["window_us"], **kw)


def best_f1(df: DataFrame, rounded: bool = True, **kw) -> DataFrame:
    """The threshold with the highest F1 (the lowest such threshold)."""
    curve = score_curve(df, rounded=rounded, **kw)
    total = curve.agg(F.sum("pos").alias("_p"))
    f1 = _ratio(2 * F.col("cum_pos"), F.col("cum_n") + F.col("_p"))
    scored = curve.crossJoin(F.broadcast(total)).withColumn("f1", F.round(f1, 12))
    return scored.agg(
        F.min_by(
            F.struct(
                F.col("score").alias("threshold"),
                (F.col("cum_pos") / F.col("cum_n")).alias("precision"),
                _ratio(F.col("cum_pos"), F.col("_p")).alias("recall"),
                F.col("f1").alias("f1_score"),
                F.col("cum_n").alias("predicted_positive"),
            ),
            F.struct(-F.col("f1"), F.col("score")),
        ).alias("best")
    ).select("best.*")


def rate_threshold(df: DataFrame, rate: float = 0.1, label: str = "label", score: str = "score") -> DataFrame:
    """The threshold that marks about ``rate`` of the rows, and the metrics at it."""
    threshold = quantiles(df, score, [1 - rate])[1 - rate]
    at = df.withColumn("prediction", (F.col(score) >= F.lit(threshold)).cast("int"))
    metrics = precision_recall(confusion(at, label))
    return metrics.select(
        F.lit(threshold).cast("double").alias("threshold"),
        "precision",
        "recall",
        "f1_score",
        _ratio(
            F.col("true_positives") + F.col("false_positives"), F.col("total_samples")
        ).alias("predicted_rate"),
    )


def metric_lift(metrics: DataFrame, baseline_ap: float) -> DataFrame:
    """Average precision against a random ranking (the positive rate) and a baseline."""
    ap = F.col("pr_auc")
    return metrics.select(
        ap.alias("pr_auc"),
        F.col("spike_rate").alias("random_ap"),
        _ratio(ap, F.col("spike_rate")).alias("lift_random"),
        (ap / F.lit(baseline_ap)).alias("lift_baseline"),
    )


def match_labels(
    predictions: DataFrame,
    labels: DataFrame,
    tolerance: float = 30,
    by: Sequence[str] = (),
    label: str = "volatility_spike",
) -> DataFrame:
    """Predictions with the label closest in time; those without a near label are dropped."""
    known = labels.where(F.col(label).isNotNull())
    matched = asof_join(
        predictions, known, [label], by=by, tolerance=int(tolerance * 1_000_000)
    )
    return matched.where(F.col(label).isNotNull())


def live_performance(
    predictions: DataFrame,
    labels: DataFrame,
    now_us: int | None = None,
    hours: float = 1,
    buffer_minutes: float = 5,
    tolerance: float = 30,
    by: Sequence[str] = (),
    label: str = "volatility_spike",
) -> DataFrame:
    """Metrics of the recent predictions that have a label by now, as one row with a status.

    Only labels within ``tolerance`` of the slice are matched; all of them are counted.
    """
    recent, near = predictions, labels
    if now_us is not None:
        begin, end = int(now_us - hours * 3.6e9), int(now_us - buffer_minutes * 6e7)
        reach = int(tolerance * 1_000_000)
        recent = predictions.where(F.col("us").between(begin, end))
        near = labels.where(F.col("us").between(begin - reach, end + reach))
    matched = match_labels(
        recent.select("us", *by, "score", "prediction", "model_version"), near, tolerance, by, label
    )
    matched = materialize(matched)
    metrics = classification_metrics(matched, label=label)
    versions = matched.groupBy("model_version").agg(F.count("*").alias("n"))
    version = versions.agg(
        F.min_by("model_version", F.struct(-F.col("n"), F.col("model_version"))).alias(
            "model_version"
        )
    )
    sizes = recent.agg(F.count("*").alias("predictions_count")).crossJoin(
        F.broadcast(
            labels.agg(F.count_if(F.col(label).isNotNull()).alias("features_count"))
        )
    )
    status = (
        F.when(F.col("predictions_count") == 0, "no_data")
        .when(F.col("features_count") == 0, "no_features")
        .when(F.col("total_samples") == 0, "no_matches")
        .otherwise("success")
    )
    return (
        metrics.crossJoin(F.broadcast(version))
        .crossJoin(F.broadcast(sizes))
        .withColumn("status", status)
    )


HISTORY = [
    "pr_auc", "precision", "recall", "f1_score", "true_positives", "false_positives",
    "true_negatives", "false_negatives", "total_samples", "positive_samples",
    "negative_samples",
]


def metric_history(metrics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Metrics as (keys, metric, value) rows for an append-only history table."""
    wide = metrics.select(*keys, *[F.col(m).cast("double").alias(m) for m in HISTORY])
    return wide.unpivot(list(keys), HISTORY, "metric", "value")
