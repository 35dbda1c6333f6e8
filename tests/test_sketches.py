import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import drift as dr
from tidemark.operators import sketches as sk

DAY = 86_400_000_000


def ticks(spark, n=30_000, seed=5):
    rng = np.random.default_rng(seed)
    day = rng.integers(0, 6, n)
    x = rng.lognormal(0, 1, n) + (day >= 3) * 0.4
    rows = [(int(d) * DAY + i, float(v), float(i % 5), None if i % 3 else 1.0) for i, (d, v) in enumerate(zip(day, x))]
    rows += [(7, float("nan"), 1.0, 1.0), (8, float("inf"), 1.0, 1.0), (None, 5.0, 1.0, 1.0)]
    return spark.createDataFrame(rows, "us bigint, x double, y double, z double")


def test_sketches_stay_within_their_bound(spark, tmp_path):
    df, path = ticks(spark), str(tmp_path / "s")
    sk.store_sketches(df, ["x", "y", "z"], path)
    stored = sk.stored_sketches(spark, path)
    assert stored.count() == 18
    a, b = sk.period(stored, "1970-01-01", "1970-01-03"), sk.period(stored, "1970-01-04", "1970-01-06")
    near = {r.feature: r for r in sk.drift_from_sketches(a, b).collect()}
    good = df.where("us is not null").withColumn("x", F.expr("if(abs(x) < double('inf'), x, null)"))
    early, late = good.where(F.col("us") < 3 * DAY), good.where(F.col("us") >= 3 * DAY)
    for exact in dr.drift_wasserstein(early, late, ["x", "y", "z"]).collect():
        got = near[exact.feature]
        assert abs(got.score - exact.score) <= got.score_error
        # The bound holds at worst; in the middle of the values it is far smaller.
        assert abs(got.score - exact.score) <= got.score_error / 4 and got.drifted == exact.drifted
    for exact in dr.drift_ks(early, late, ["x", "y", "z"]).collect():
        got = near[exact.feature]
        assert abs(got.statistic - exact.statistic) <= got.statistic_error < 0.01
        assert (got.n_ref, got.n_cur) == (exact.n_ref, exact.n_cur)


def test_merged_moments(spark):
    df = ticks(spark, 2_000)
    whole = sk.period(sk.day_sketches(df, ["x"]), "1970-01-01", "1970-01-31").first()
    want = df.where("us is not null and abs(x) < double('inf')").agg(
        F.count("x"), F.avg("x"), F.var_pop("x"), F.min("x"), F.max("x")
    ).first()
    got = (whole.n, whole["mean"], whole.variance, whole.low, whole.high)
    assert np.allclose(got, tuple(want))


def test_a_day_replaces_itself(spark, tmp_path):
    df, path = ticks(spark, 600), str(tmp_path / "s")
    sk.store_sketches(df, ["x"], path)
    before = sorted((str(r.dt), r.n) for r in sk.stored_sketches(spark, path).collect())
    sk.store_sketches(df.where(f"us between {DAY} and {2 * DAY - 1}"), ["x"], path)
    assert sorted((str(r.dt), r.n) for r in sk.stored_sketches(spark, path).collect()) == before


def test_sides_without_values(spark):
    df = ticks(spark, 300)
    days = sk.day_sketches(df, ["x", "y"])
    none = sk.period(days, "2000-01-01", "2000-01-02")
    out = sk.drift_from_sketches(sk.period(days.where("feature = 'x'"), "1970-01-01", "1970-01-06"), none).collect()
    assert [(r.feature, r.n_cur, r.score, r.statistic, r.drifted) for r in out] == [("x", 0, None, None, False)]
    assert sk.drift_from_sketches(none, none).count() == 0
    assert sk.day_sketches(df.limit(0), ["x"]).count() == 0
