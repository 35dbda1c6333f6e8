import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality, slo

MINUTE = slo.MINUTE


def log(spark, latencies, ok=None):
    rows = [(float(x), True if ok is None else ok(i)) for i, x in enumerate(latencies)]
    return spark.createDataFrame(rows, "latency_ms double, success boolean")


@pytest.mark.parametrize("n", [1, 2, 19, 20, 99, 100, 257])
def test_latency_summary(spark, n):
    x = np.random.default_rng(n).gamma(2, 30, n)
    out = slo.latency_summary(log(spark, x, lambda i: i % 10 != 3), elapsed_seconds=2).first()
    assert math.isclose(out["median_ms"], statistics.median(x))
    p95 = statistics.quantiles(x, n=20)[18] if n >= 20 else max(x)
    p99 = statistics.quantiles(x, n=100)[98] if n >= 100 else max(x)
    assert math.isclose(out["p95_ms"], p95) and math.isclose(out["p99_ms"], p99)
    assert (out["total_requests"], out["per_second"]) == (n, n / 2)
    assert out["failed_requests"] == sum(i % 10 == 3 for i in range(n))


def test_empty_log(spark):
    out = slo.latency_summary(log(spark, [])).first()
    assert out["total_requests"] == 0 and out["success_rate"] == 0 and out["p95_ms"] is None


def test_verdict(spark):
    good = slo.slo_verdict(slo.latency_summary(log(spark, [800.0]))).first()
    assert good["latency_ok"] and good["success_ok"]
    bad = slo.slo_verdict(slo.latency_summary(log(spark, [801.0] * 60, lambda i: i > 0))).first()
    assert not bad["latency_ok"] and not bad["success_ok"]


def test_histogram_and_quantile(spark):
    df = spark.createDataFrame([(x,) for x in [0.0005, 0.03, 0.04, 0.2, 5.0]], "s double")
    hist = slo.latency_histogram(df, F.col("s"))
    assert [r["cumulative"] for r in hist.orderBy("le").collect()] == [1, 1, 1, 3, 3, 4, 4, 5]
    at = lambda p: slo.histogram_quantile(hist, p).first()["quantile"]
    assert math.isclose(at(0.5), 0.01 + 0.04 * (2.5 - 1) / 2)
    assert at(0.99) == 1.0
    assert math.isclose(at(0.1), 0.001 * 0.5)


def test_moving_rates(spark):
    rows = [(0, 200), (30_000_000, 500), (4 * MINUTE, 200), (5 * MINUTE, 404)]
    df = spark.createDataFrame(rows, "us bigint, status int")
    got = {r["window_us"] // MINUTE: r for r in slo.moving_rates(df, F.col("status")).collect()}
    assert got[0]["requests"] == 3 and math.isclose(got[0]["error_rate"], 1 / 3)
    assert got[1]["requests"] == 2 and got[1]["errors"] == 1
    assert set(got) == set(range(-4, 6))


@pytest.mark.parametrize("rows_per_range", [None, 3])
def test_alert_needs_an_unbroken_stretch(spark, small_ranges, rows_per_range):
    if rows_per_range:
        small_ranges(rows_per_range)
    on = {0, 1, 2, 3, 4, 5, 8, 9, 10, 12, 13, 14, 15, 16, 17, 18}
    series = [(m * MINUTE, 1.0 if m in on else 0.0) for m in range(20) if m != 15]
    df = spark.createDataFrame(series, "window_us bigint, rate double")
    out = slo.alert_islands(df, F.col("rate") > 0.5, hold_minutes=5).collect()
    assert [(r["first_us"] // MINUTE, r["last_us"] // MINUTE, r["steps"]) for r in out] == [(0, 5, 6)]


@pytest.mark.parametrize("rows_per_range", [None, 50])
def test_rolling_score(spark, small_ranges, rows_per_range):
    if rows_per_range:
        small_ranges(rows_per_range)
    x = np.random.default_rng(3).random(300)
    rows = [("ab"[i % 2], i * 10, i, float(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "model_variant string, us bigint, seq bigint, score double")
    got = {r["seq"]: r["rolling_score"] for r in slo.rolling_score(df, n=7).collect()}
    for i in range(300):
        assert math.isclose(got[i], np.mean(x[i % 2 : i + 1 : 2][-7:]))
    latest = {r["model_variant"]: r["latest_score"] for r in slo.latest_score(df).collect()}
    assert latest == {"a": x[298], "b": x[299]}


@pytest.mark.parametrize("age,level", [(1.9, "green"), (2, "yellow"), (10, "red")])
def test_freshness(spark, age, level):
    df = spark.createDataFrame([(0,), (1000,)], "us bigint")
    assert slo.freshness(df, int(1000 + age * 1e6)).first()["level"] == level


def test_expectations(spark):
    df = spark.createDataFrame(
        [(0.1, 1), (1.2, None), (float("nan"), 3), (None, 4)], "score double, n int"
    )
    rules = {**quality.score_rules(), "n_present": F.col("n").isNotNull()}
    got = {r["rule"]: (r["n_checked"], r["n_failed"]) for r in quality.expectations(df, rules).collect()}
    assert got == {"score_numeric": (4, 2), "score_in_unit_interval": (4, 3), "n_present": (4, 1)}


@pytest.mark.parametrize("failed,status", [(0, "PASSED"), (1, "PASSED WITH WARNINGS"), (2, "FAILED")])
def test_status(spark, failed, status):
    df = spark.createDataFrame([(f"r{i}", 1, int(i < failed)) for i in range(5)], "rule string, n_checked int, n_failed int")
    assert quality.validation_status(df).first()["status"] == status


def test_moving_quantile_and_lag(spark):
    df = spark.createDataFrame([(0, 0.03), (3 * MINUTE, 0.2)], "us bigint, s double")
    got = {r["window_us"] // MINUTE: r["quantile"] for r in slo.moving_quantile(df, F.col("s"), 0.5).collect()}
    assert set(got) == set(range(-4, 4))
    assert math.isclose(got[-4], 0.03) and math.isclose(got[0], 0.05) and math.isclose(got[3], 0.3)

    rows = [("t", m * MINUTE, p, 600 if m < 7 else 400) for m in range(10) for p in (0, 1)]
    lags = spark.createDataFrame(rows, "topic string, window_us bigint, partition int, lag bigint")
    out = slo.lag_alerts(lags).collect()
    assert [(r["first_us"], r["last_us"] // MINUTE) for r in out] == [(0, 6)]


def test_service_alerts(spark):
    rows = [(m * MINUTE, 500 if m < 12 else 200, 0.9) for m in range(30) for _ in range(4)]
    df = spark.createDataFrame(rows, "us bigint, status int, s double")
    out = {r["alert"]: r for r in slo.service_alerts(df, F.col("status"), F.col("s")).collect()}
    assert set(out) == {"server_errors", "latency"}
    assert out["latency"]["steps"] == 34
