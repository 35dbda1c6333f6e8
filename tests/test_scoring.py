import math

import numpy as np
import pandas as pd
import pytest

from tidemark.functions import ticks as tk
from tidemark.operators import models, scoring
from tidemark.schema import MODEL_FEATURES


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({f: rng.normal(i, 1 + i, 200) for i, f in enumerate(MODEL_FEATURES)})
    pdf["spread_mean_60s"] = 3.0
    pdf.loc[::9, "log_return_300s"] = np.nan
    pdf["volatility_spike"] = (pdf["price_velocity_300s"] > 10).astype(int)
    return pdf, spark.createDataFrame(pdf)


def brute(pdf):
    z = []
    for f in MODEL_FEATURES:
        mean, std = pdf[f].mean(), max(pdf[f].std(), 1e-8)
        z.append((pdf[f].fillna(mean) - mean) / (std + 1e-8))
    c = pd.concat(z, axis=1).mean(axis=1)
    return (c - c.mean()) / (max(c.std(), 1e-8) + 1e-8)


def test_baseline(table):
    pdf, df = table
    stats = scoring.fit_baseline(df)
    out = scoring.baseline_score(df, stats).toPandas()
    want = brute(pdf)
    assert np.allclose(np.sort(out["z_score"]), np.sort(want), atol=1e-9)
    assert np.allclose(np.sort(out["probability"]), np.sort(1 / (1 + np.exp(-want))))
    assert (out["prediction"] == (out["z_score"] >= 2)).all()
    with pytest.raises(ValueError):
        scoring.fit_baseline(df.drop("log_return_300s"))


def test_score_requests(spark, table):
    _, df = table
    scorers = {"baseline": scoring.baseline_scorer(scoring.fit_baseline(df))}
    rows = spark.createDataFrame([(0.05, 0.01, 50), (0.02, 0.005, 30)], "ret_mean double, ret_std double, n int")
    out = scoring.score_table(rows, scorers, threshold=0.5).collect()
    assert len(out) == 2
    for r in out:
        assert 0 <= r["score"] <= 1 and r["score"] == round(r["score"], 4)
        assert r["log_return_300s"] == r["ret_mean"] and r["order_book_imbalance_30s"] == 0.5
        assert r["model_variant"] == "baseline" and r["alert"] == (r["score"] >= 0.5)
    assert scoring.score_table(rows.limit(0), scorers).count() == 0
    with pytest.raises(ValueError):
        scoring.score_table(rows, scorers, "ml")


def test_models_and_rollback(table):
    _, df = table
    forest = models.train(df, trees=5, depth=4)
    scorers = {
        "ml": scoring.pipeline_scorer(forest),
        "baseline": scoring.baseline_scorer(scoring.fit_baseline(df)),
    }
    ml = scoring.score_table(df, scorers, "ml", 0.5)
    assert ml.where("prediction <> volatility_spike").count() < 20
    assert scoring.score_table(df, scorers, "baseline").first()["model_version"] == "v1.2-baseline"
    top = models.feature_importance(df, forest).first()
    assert top["feature"] == "price_velocity_300s"
    for kind in ("logistic", "boosted"):
        model = models.train(df, kind=kind, trees=3)
        assert scoring.pipeline_scorer(model)(tk.default_fill(df)).count() == 200
    with pytest.raises(ValueError):
        models.train(df, kind="other")


def test_forest_rows_are_spread_evenly(spark, table, monkeypatch):
    """One task held all rows of a lopsided table; every pass waited for it."""
    _, df = table
    lopsided = df.coalesce(1).union(df.limit(0))
    fitted = []
    fit = models.Pipeline.fit
    monkeypatch.setattr(models.Pipeline, "fit", lambda self, rows: fitted.append((self, rows)) or fit(self, rows))
    small = models.train(lopsided, trees=3, depth=3)
    monkeypatch.setattr(models, "EVEN_ABOVE", 100)
    large = models.train(lopsided, trees=3, depth=3)
    sizes = [[len(p) for p in rows.rdd.glom().collect()] for _, rows in fitted]
    assert max(sizes[0]) == 200
    assert len(sizes[1]) == 2 * spark.sparkContext.defaultParallelism and sum(sizes[1]) == 200
    assert max(sizes[1]) - min(sizes[1]) <= 1
    for model in (small, large):
        assert models.feature_importance(df, model).first()["feature"] == "price_velocity_300s"


def test_forest_keeps_node_ids(table, monkeypatch):
    """Node ids kept from pass to pass, and no pass with more than 64 MB of nodes; the trees stay the same."""
    _, df = table
    fitted = []
    fit = models.Pipeline.fit
    monkeypatch.setattr(models.Pipeline, "fit", lambda self, rows: fitted.append((self, rows)) or fit(self, rows))
    kept = models.train(df, trees=5, depth=4)
    pipeline, rows = fitted[0]
    forest = pipeline.getStages()[-1]
    assert forest.getCacheNodeIds() and forest.getMaxMemoryInMB() <= 64
    walked = fit(pipeline.copy({forest.cacheNodeIds: False, forest.maxMemoryInMB: 256}), rows)
    trees = lambda model: model.stages[-1].toDebugString.split("\n", 1)[1]
    assert not walked.stages[-1].getCacheNodeIds() and trees(kept) == trees(walked)


def test_importance_names_follow_the_model(table):
    _, df = table
    fewer = df.drop("log_return_300s", "spread_mean_60s")
    got = models.feature_importance(fewer, models.train(fewer, trees=5, depth=4)).collect()
    assert got[0]["feature"] == "price_velocity_300s" and len(got) == 8
    assert {r["feature"] for r in got} == set(MODEL_FEATURES) - {"log_return_300s", "spread_mean_60s"}


def test_python_model(table):
    _, df = table
    scorer = scoring.python_scorer(lambda pdf: 1 / (1 + np.exp(-pdf["price_velocity_300s"])))
    out = scoring.score_table(df, {"py": scorer}, "py", 0.5).first()
    assert math.isclose(out["probability"], 1 / (1 + math.exp(-out["price_velocity_300s"])))


def test_log_shape(table):
    _, df = table
    scored = scoring.score_table(
        df.selectExpr("*", "0L as us", "'A' as product_id"),
        {"baseline": scoring.baseline_scorer(scoring.fit_baseline(df))},
    )
    log = scoring.prediction_log(scored)
    assert log.schema["features"].dataType.fieldNames() == MODEL_FEATURES


def test_feature_selection(spark):
    df = spark.createDataFrame([(float("nan"), None, 1)], "log_return_300s double, spread_mean_60s double, volatility_spike int")
    row = tk.select_features(df, target="volatility_spike").first()
    assert tuple(row) == (0.0, 0.0, 1)
    assert len(tk.missing_features(df)) == 8
    with pytest.raises(ValueError):
        tk.select_features(df.select("volatility_spike"))
    with pytest.raises(ValueError):
        tk.select_features(df.drop("volatility_spike"), target="volatility_spike")


def test_column_choice(spark):
    df = spark.createDataFrame([(1.0, 2, "x", 0.0)], "a double, b bigint, c string, label double")
    assert tk.analysis_columns(df) == ["a", "b"]
    with_range = spark.createDataFrame([(3.0, 1.0, 0.0)], "return_max_60s double, return_min_60s double, spread_mean_60s double")
    assert tk.analysis_columns(with_range) == ["spread_mean_60s", "return_range_60s"]
    assert tk.add_return_range(with_range).first()["return_range_60s"] == 2.0
    assert tk.common_columns(df, with_range.selectExpr("1 as b"), ["a", "b"]) == ["b"]
