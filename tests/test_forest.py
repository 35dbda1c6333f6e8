import numpy as np
import pandas as pd
import pytest

from tidemark.functions import ticks as tk
from tidemark.operators import forest, models, scoring
from tidemark.schema import MODEL_FEATURES


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({f: rng.normal(i, 1 + i, 400) for i, f in enumerate(MODEL_FEATURES)})
    pdf["spread_mean_60s"] = 3.0
    pdf["trade_intensity_300s"] = rng.integers(0, 4, 400).astype(float)
    pdf.loc[::9, "log_return_300s"] = np.nan
    pdf["volatility_spike"] = (pdf["price_velocity_300s"] + rng.normal(0, 2, 400) > 12).astype(int)
    return pdf, spark.createDataFrame(pdf)


@pytest.fixture
def large(monkeypatch):
    """Tables of the tests count as large and fill several blocks."""
    monkeypatch.setattr(models, "BLOCKS_ABOVE", 100)
    monkeypatch.setattr(forest, "BLOCK_ROWS", 64)


def gini(n):
    return 1 - ((n / n.sum()) ** 2).sum() if n.sum() else 0.0


def best_by_hand(rows, y, times, weight, columns, bins):
    """Largest gain over all cuts of some columns, one cut at a time."""
    found = (0.0, None, None)
    every = np.bincount(y, times, 2) * weight
    for c in columns:
        for b in range(bins - 1):
            goes = rows[:, c] <= b
            if min(times[goes].sum(), times[~goes].sum()) < 2:
                continue
            sides = [np.bincount(y[s], times[s], 2) * weight for s in (goes, ~goes)]
            gain = gini(every) - sum(s.sum() / every.sum() * gini(s) for s in sides)
            if gain > found[0] + 1e-9:
                found = (gain, c, b)
    return found


def test_large_tables_grow_the_trees_of_a_plain_forest(table, large, monkeypatch):
    """Every node of every tree has the best cut among its features, over all drawn rows; blocks,
    tasks and groups of trees do not matter."""
    _, df = table
    monkeypatch.setattr(forest, "COUNT_BYTES", 2 * 4 * 4 * 64 * 4)  # one or two trees in a pass
    monkeypatch.setattr(forest, "CHUNK_NODES", 2)
    rows = models.balanced(tk.select_features(df, MODEL_FEATURES, target="volatility_spike"), "volatility_spike").coalesce(1)
    every, weight = forest.class_weights(rows, "volatility_spike")
    assert every.sum() == 400 and np.allclose(every * weight, 200)
    cuts = forest.all_cuts(rows, MODEL_FEATURES, "volatility_spike", every * weight, 32)
    assert len(cuts[MODEL_FEATURES.index("spread_mean_60s")]) == 0 and max(map(len, cuts)) == 31
    assert list(cuts[MODEL_FEATURES.index("trade_intensity_300s")]) == [0.5, 1.5, 2.5]
    blocks = forest.packed(rows, MODEL_FEATURES, "volatility_spike", cuts, 2, np.uint8).collect()
    assert len(blocks) == 7
    codes = [np.frombuffer(b["codes"], np.uint8).reshape(-1, 10) for b in blocks]
    whole = np.concatenate(codes)
    x, y = whole.astype(int) // 2, whole[:, 0].astype(int) % 2
    monkeypatch.setattr(forest, "merge_leaves", lambda f, v: None)
    model = forest.fit(rows, MODEL_FEATURES, "volatility_spike", trees=3, depth=3, seed=7)
    assert (model.feature >= 0).sum() > 12
    for t in range(3):
        times = np.concatenate([forest.bag(7, t, b["block"], len(c)) for b, c in zip(blocks, codes)]).astype(int)
        node = np.zeros(400, int)
        for n in range(7):
            level = (n + 1).bit_length() - 1
            here = node == n
            chosen = forest.choices(7, t, level, 10, 4)[n - 2**level + 1]
            assert len(set(chosen)) == 4
            f = model.feature[t, n]
            gain = best_by_hand(x[here], y[here], times[here], weight, chosen, 32)[0] if times[here].any() else 0
            assert (f >= 0) == (gain > 0)
            if f < 0:
                continue
            goes = x[here, f] <= np.searchsorted(cuts[f], model.threshold[t, n])
            both = [np.bincount(y[here][s], times[here][s], 2) * weight for s in (goes, ~goes)]
            every = both[0] + both[1]
            got = gini(every) - sum(s.sum() / every.sum() * gini(s) for s in both)
            assert f in chosen and np.isclose(got, gain) and np.allclose(model.votes[t, n], every)
            assert np.allclose(model.votes[t, 2 * n + 1 : 2 * n + 3], both)
            node[here] = 2 * n + 2 - goes


def test_leaves_of_one_mind_are_merged():
    feature = np.array([[3, 1, 2]])
    votes = np.array([[[5.0, 4], [4, 1], [1, 3], [3, 0], [1, 1], [0, 3], [1, 0]]])
    forest.merge_leaves(feature, votes)
    assert feature.tolist() == [[3, -1, 2]]


def test_scores_of_large_tables(table, large, monkeypatch):
    """A table above the limit is not passed over with all trees' nodes by ``pyspark.ml``."""
    pdf, df = table
    monkeypatch.setattr(models.Pipeline, "fit", lambda *a: pytest.fail("grown by pyspark.ml"))
    model = models.train(df, trees=20, depth=5)
    grown = model.stages[-1]
    x = pdf[MODEL_FEATURES].fillna(0).to_numpy()
    want = []
    for row in x:
        votes = np.zeros(2)
        for t in range(20):
            n = 0
            while n < 31 and grown.feature[t, n] >= 0:
                n = 2 * n + (1 if row[grown.feature[t, n]] <= grown.threshold[t, n] else 2)
            votes += grown.votes[t, n] / grown.votes[t, n].sum()
        want.append(votes[1] / 20)
    ready = df.fillna(0.0)
    got = scoring.pipeline_scorer(model)(ready).select("probability").toPandas()["probability"]
    assert np.allclose(sorted(got), sorted(want))
    out = model.transform(ready)
    assert out.where("prediction <> volatility_spike").count() < 60
    assert [f.name for f in out.schema][-3:] == ["rawPrediction", "probability", "prediction"]
    ranked = models.feature_importance(df, model).toPandas()
    assert ranked["feature"][0] == "price_velocity_300s" and np.isclose(ranked["importance"].sum(), 1)
    assert ranked.set_index("feature")["importance"]["spread_mean_60s"] == 0
    again = models.train(df, trees=20, depth=5).stages[-1]
    assert (again.feature == grown.feature).all() and (again.threshold == grown.threshold).all()


def test_odd_labels(table, large, spark):
    _, df = table
    three = df.withColumn("volatility_spike", (tk.F.col("trade_intensity_300s") % 3).cast("int"))
    out = models.train(three, trees=10, depth=4).transform(three.fillna(0.0))
    assert len(out.first()["probability"]) == 3 and out.where("prediction <> volatility_spike").count() < 80
    same = df.withColumn("volatility_spike", tk.F.lit(1))
    out = scoring.pipeline_scorer(models.train(same, trees=2, depth=2))(same.fillna(0.0))
    assert out.where("probability <> 1").count() == 0 and out.count() == 400
    with pytest.raises(ValueError):
        models.train(df.withColumn("volatility_spike", tk.F.lit(-1)))


def test_cuts_follow_the_weight():
    values = np.arange(1000.0)
    assert len(forest.cut_points(values, np.ones(1000), 32)) == 31
    heavy = np.where(values >= 900, 9.0, 1.0)
    assert (forest.cut_points(values, heavy, 32) > 899).sum() in (15, 16)
    assert list(forest.cut_points(np.array([1.0, 1.0, 3.0]), np.ones(3), 32)) == [2.0]
    assert len(forest.cut_points(np.ones(5), np.ones(5), 32)) == 0
    tied = np.concatenate([np.zeros(900), np.arange(1, 101.0)])
    assert 2 <= len(forest.cut_points(tied, np.ones(1000), 32)) <= 31


def test_draws_are_poisson():
    draws = forest.bag(1, 2, 3, 200_000)
    share = np.bincount(draws) / len(draws)
    assert abs(draws.mean() - 1) < 0.01 and abs(draws.var() - 1) < 0.02
    assert np.allclose(share[:3], [0.3679, 0.3679, 0.1839], atol=0.005)
    assert (draws != forest.bag(1, 3, 3, 200_000)).any()
