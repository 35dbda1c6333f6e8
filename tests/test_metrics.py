import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics

SCHEMA = "label int, score double, prediction int"


def brute(rows):
    """Average precision and pairwise AUC by definition."""
    scores = sorted({s for _, s, _ in rows}, reverse=True)
    positives = sum(y for y, _, _ in rows)
    ap, last = 0.0, 0.0
    for t in scores:
        above = [y for y, s, _ in rows if s >= t]
        recall = sum(above) / positives
        ap += (recall - last) * sum(above) / len(above)
        last = recall
    pos = [s for y, s, _ in rows if y]
    neg = [s for y, s, _ in rows if not y]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    return ap, auc


@pytest.mark.parametrize("rows_per_range", [None, 5])
@pytest.mark.parametrize("places,rounded", [(1, True), (6, False)])
def test_ranking(spark, small_ranges, rows_per_range, places, rounded):
    if rows_per_range:
        small_ranges(rows_per_range)
    rng = np.random.default_rng(places)
    rows = [
        (int(rng.random() < 0.3), round(float(rng.random()), places), int(rng.random() < 0.5))
        for _ in range(200)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    ap, auc = brute(rows)
    out = metrics.classification_metrics(df, rounded=rounded).first()
    assert math.isclose(out["pr_auc"], ap) and math.isclose(out["roc_auc"], auc)
    assert math.isclose(metrics.average_precision(df, rounded=rounded).first()[0], ap)
    assert math.isclose(metrics.roc_auc(df, rounded=rounded).first()[0], auc)

    best = metrics.best_f1(df, rounded=rounded).first()
    tries = {}
    for t in {s for _, s, _ in rows}:
        tp = sum(y for y, s, _ in rows if s >= t)
        tries[t] = 2 * tp / (sum(s >= t for _, s, _ in rows) + sum(y for y, _, _ in rows))
    assert math.isclose(best["f1_score"], max(tries.values()), rel_tol=1e-9)
    assert math.isclose(tries[best["threshold"]], max(tries.values()), rel_tol=1e-9)


# Published confusion counts and the ratios that go with them.
GOLDEN = [
    ((2, 86, 983, 316), (0.0227, 0.0063, 0.0099)),
    ((191, 5, 1755, 5), (0.97449, 0.97449, 0.97449)),
    ((191, 3, 1757, 5), (0.98454, 0.97449, 0.97949)),
    ((403, 18, 3585, 27), (0.9572, 0.9372, 0.9471)),
]


@pytest.mark.parametrize("counts,want", GOLDEN)
def test_golden_ratios(spark, counts, want):
    tp, fp, tn, fn = counts
    rows = [(1, 0.9, 1)] * tp + [(0, 0.9, 1)] * fp + [(0, 0.1, 0)] * tn + [(1, 0.1, 0)] * fn
    out = metrics.precision_recall(metrics.confusion(spark.createDataFrame(rows, SCHEMA))).first()
    for name, value in zip(("precision", "recall", "f1_score"), want):
        assert abs(out[name] - value) < 6e-5
    assert out["total_samples"] == sum(counts) and out["positive_samples"] == tp + fn


@pytest.mark.parametrize("rows,want", [
    ([(0, 0.1, 0)] * 3, (0, 0, 3, 0)),
    ([(1, 0.9, 1)] * 3, (3, 0, 0, 0)),
    ([(0, 0.9, 1)] * 2, (0, 2, 0, 0)),
    ([(1, 0.1, 0)] * 2, (0, 0, 0, 2)),
    ([], (0, 0, 0, 0)),
])
def test_one_class(spark, rows, want):
    df = spark.createDataFrame(rows, SCHEMA)
    out = metrics.classification_metrics(df).first()
    names = ("true_positives", "false_positives", "true_negatives", "false_negatives")
    assert tuple(out[n] for n in names) == want
    assert tuple(metrics.confusion(df).first()[n] for n in names) == want


def test_rate_threshold(spark):
    rows = [(int(i >= 90), i / 100, 0) for i in range(101)]
    out = metrics.rate_threshold(spark.createDataFrame(rows, SCHEMA), 0.1).first()
    assert math.isclose(out["threshold"], 0.9) and out["precision"] == 1.0 and out["recall"] == 1.0


def live(spark, preds, labels, **kw):
    p = spark.createDataFrame(
        preds, "us bigint, seq bigint, model_version string, score double, prediction int"
    )
    f = spark.createDataFrame(labels, "us bigint, seq bigint, volatility_spike int")
    return metrics.live_performance(p, f, **kw).first()


def test_live_status(spark):
    s = 1_000_000
    preds = [(10 * s, 0, "v2", 0.9, 1), (25 * s, 1, "v1", 0.1, 0), (99999 * s, 2, "v1", 0.5, 1)]
    labels = [(12 * s, 0, 1), (30 * s, 1, 0), (40 * s, 2, None)]
    out = live(spark, preds, labels)
    assert out["status"] == "success" and out["total_samples"] == 2
    assert out["true_positives"] == 1 and out["true_negatives"] == 1
    assert out["model_version"] == "v1" and out["pr_auc"] == 1.0
    assert live(spark, [], labels)["status"] == "no_data"
    assert live(spark, preds, [])["status"] == "no_features"
    assert live(spark, preds[2:], labels)["status"] == "no_matches"
    sliced = live(spark, preds, labels, now_us=3600 * s, hours=1, buffer_minutes=59.75)
    assert sliced["predictions_count"] == 1


def test_history_and_windows(spark):
    rows = [(1, 0.9, 1, 5), (0, 0.2, 0, 6), (1, 0.3, 0, 70_000_000)]
    df = spark.createDataFrame(rows, SCHEMA + ", us bigint")
    by_minute = metrics.metrics_by_window(df, 60)
    assert [r["total_samples"] for r in by_minute.orderBy("window_us").collect()] == [2, 1]
    history = metrics.metric_history(by_minute, ["window_us"])
    assert history.count() == 22
    assert history.where("metric = 'recall'").agg(F.sum("value")).first()[0] == 1.0
