import math

import numpy as np
import pytest

from tidemark.operators import drift as dr

# Published drift scores of ten features: eight reach the cut of 0.1.
SCORES = {
    "spread_mean_300s": (4.482, "high"), "spread_mean_60s": (3.419, "high"),
    "price_velocity_300s": (2.432, "high"), "trade_intensity_300s": (1.614, "medium"),
    "order_book_imbalance_300s": (0.799, "medium"), "order_book_imbalance_60s": (0.381, "low"),
    "log_return_300s": (0.343, "low"), "order_book_imbalance_30s": (0.306, "low"),
    "realized_volatility_60s": (0.028, "none"), "realized_volatility_300s": (0.027, "none"),
}


def test_golden_dataset_drift(spark):
    df = spark.createDataFrame([(f, s) for f, (s, _) in SCORES.items()], "feature string, score double")
    df = df.selectExpr("*", "score >= 0.1 as drifted")
    out = dr.dataset_drift(df).first()
    assert (out["drifted_columns"], out["share"]) == (8, 0.8)
    assert out["drift_detected"] and out["action_required"]
    got = {r["feature"]: r["severity"] for r in dr.drift_severity(df).collect()}
    assert got == {f: s for f, (_, s) in SCORES.items()}
    assert [r["feature"] for r in dr.top_drift(df, 2).collect()] == ["spread_mean_300s", "spread_mean_60s"]
    trigger = dr.retrain_trigger(dr.dataset_drift(df), 0.8, 0.9, 3).first()
    assert trigger["by_share"] and trigger["by_quality"] and not trigger["by_duration"]


def tables(spark, seed=1, n=300, m=500):
    rng = np.random.default_rng(seed)
    a = {"x": rng.normal(0, 1, n), "y": rng.integers(0, 5, n).astype(float), "z": np.zeros(n)}
    b = {"x": rng.normal(0.5, 2, m), "y": rng.integers(0, 5, m).astype(float), "z": np.zeros(m)}
    frame = lambda t: spark.createDataFrame(
        list(zip(*[map(float, t[c]) for c in "xyz"])) + [(None, float("nan"), None)],
        "x double, y double, z double",
    )
    return a, b, frame(a), frame(b)


def wasserstein(a, b):
    points = np.sort(np.concatenate([a, b]))
    f = np.searchsorted(np.sort(a), points[:-1], "right") / len(a)
    g = np.searchsorted(np.sort(b), points[:-1], "right") / len(b)
    return float(np.sum(np.abs(f - g) * np.diff(points)))


@pytest.mark.parametrize("rows", [None, 40])
def test_distances(spark, small_ranges, rows):
    if rows:
        small_ranges(rows)
    a, b, ref, cur = tables(spark)
    got = {r["feature"]: r for r in dr.drift_wasserstein(ref, cur, ["x", "y", "z"]).collect()}
    approx = {r["feature"]: r["score"] for r in dr.drift_wasserstein_approx(ref, cur, ["x", "y", "z"]).collect()}
    ks = {r["feature"]: r for r in dr.drift_ks(ref, cur, ["x", "y", "z"]).collect()}
    for c in "xyz":
        want = wasserstein(a[c], b[c]) / max(np.std(a[c]), 0.001)
        assert math.isclose(got[c]["score"], want, rel_tol=1e-9, abs_tol=1e-12)
        assert got[c]["drifted"] == (want >= 0.1)
        assert abs(approx[c] - want) < 0.02
        points = np.concatenate([a[c], b[c]])
        f = np.searchsorted(np.sort(a[c]), points, "right") / len(a[c])
        g = np.searchsorted(np.sort(b[c]), points, "right") / len(b[c])
        assert math.isclose(ks[c]["statistic"], np.max(np.abs(f - g)), abs_tol=1e-12)
    assert ks["z"]["p_value"] == 1.0 and ks["z"]["band"] == "low"
    assert ks["x"]["band"] == "high" and ks["x"]["p_value"] < 1e-6


def test_kolmogorov_tail(spark):
    """A known point of the distribution: P(K > 1.3581) is 5 %."""
    p = spark.range(1).select(dr._kolmogorov(dr.F.lit(1.3581))).first()[0]
    assert abs(p - 0.05) < 1e-4


def test_categorical(spark):
    a = spark.createDataFrame([(0,), (0,), (1,), (None,)], "p int")
    b = spark.createDataFrame([(1,), (1,)], "p int")
    out = dr.drift_categorical(a, b, "p").first()
    assert math.isclose(out["total_variation"], 2 / 3)
    m = [1 / 3, 2 / 3]
    js = (2 / 3 * math.log(2 / 3 / m[0]) + 1 / 3 * math.log(1 / 3 / m[1]) + math.log(1 / m[1])) / 2
    assert math.isclose(out["js_distance"], math.sqrt(js))


def test_quality_summaries(spark):
    df = spark.createDataFrame(
        [(1.0, "a", 1), (1.0, "a", 1), (float("nan"), "", 1), (float("inf"), None, 1)],
        "x double, s string, k int",
    )
    out = dr.dataset_summary(df, ["x", "s", "k"]).first()
    assert (out["rows"], out["columns"], out["duplicate_rows"], out["constant_columns"]) == (4, 3, 1, 1)
    got = {r["column"]: r for r in dr.missing_values(df, ["x", "s", "k"]).collect()}
    assert (got["x"]["nans"], got["x"]["infinities"], got["s"]["nulls"], got["s"]["empty_strings"]) == (1, 1, 1, 1)
    assert got["x"]["missing_share"] == 0.5 and got["k"]["missing_share"] == 0


def test_reports(spark):
    _, _, ref, cur = tables(spark)
    report = dr.drift_report(ref, cur, ["x", "y"])
    assert report.columns == ["section", "feature", "metric", "value"]
    assert report.where("section = 'dataset_drift' and metric = 'columns'").first()["value"] == 2
    line = spark.range(100).selectExpr("id * 10 as us", "id as seq", "double(id) as price")
    for make, sizes in ((dr.early_late_report, (50, 50)), (dr.train_test_report, (70, 15))):
        out = {
            (r["section"], r["metric"]): r["value"]
            for r in make(line, columns=["price"]).where("metric = 'rows'").collect()
        }
        assert out == {("reference_summary", "rows"): sizes[0], ("current_summary", "rows"): sizes[1]}


def test_predictions_join_the_features(spark):
    f = spark.createDataFrame([(0,), (5_000_000,)], "us bigint")
    p = spark.createDataFrame([(400_000, 0, 0.7, 1)], "us bigint, seq bigint, score double, prediction int")
    out = dr.with_predictions(f, p).orderBy("us").collect()
    assert [r["prediction"] for r in out] == [1, None]
