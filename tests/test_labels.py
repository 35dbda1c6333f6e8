import math

import pytest
from helpers import SECOND, TICKS, brute_forward, random_ticks
from pyspark.sql import functions as F

from tidemark.operators import labels, stats


@pytest.mark.parametrize("horizon,gap", [(60, 300), (60, 20), (5, 1)])
@pytest.mark.parametrize("rows_per_range", [None, 10])
def test_forward_volatility(spark, small_ranges, horizon, gap, rows_per_range):
    rows = random_ticks(300, 7)
    if rows_per_range:
        small_ranges(rows_per_range)
    df = labels.forward_volatility(spark.createDataFrame(rows, TICKS), horizon, gap)
    got = {r["seq"]: r["future_volatility"] for r in df.collect()}
    want = brute_forward(rows, horizon, gap)
    assert got.keys() == want.keys()
    for seq, value in want.items():
        if value is None:
            assert got[seq] is None, seq
        else:
            assert math.isclose(got[seq], value, rel_tol=1e-6, abs_tol=1e-9), seq


@pytest.mark.parametrize("rows_per_range", [None, 7])
def test_gap_chunks(spark, small_ranges, rows_per_range):
    rows = random_ticks(200, 8)
    if rows_per_range:
        small_ranges(rows_per_range)
    got = {
        r["seq"]: r["chunk_id"]
        for r in labels.gap_chunks(spark.createDataFrame(rows, TICKS), 20).collect()
    }
    for product in "AB":
        chunk, last = 0, None
        for r in sorted((r for r in rows if r[0] == product), key=lambda r: (r[1], r[2])):
            chunk += last is not None and r[1] - last > 20 * SECOND
            last = r[1]
            assert got[r[2]] == chunk


def test_gap_is_strict(spark):
    rows = [("A", 0, 0, 1.0), ("A", 300 * SECOND, 1, 1.0), ("A", 600 * SECOND + 1, 2, 1.0)]
    df = spark.createDataFrame(rows, "product_id string, us bigint, seq bigint, price double")
    assert [r["chunk_id"] for r in labels.gap_chunks(df).orderBy("seq").collect()] == [0, 0, 1]


def test_spike_label_and_backfill(spark):
    df = spark.createDataFrame(random_ticks(300, 9, nulls=False), TICKS)
    out = labels.spike_label(df, percentile=80)
    dist = {
        r["volatility_spike"]: r["share"]
        for r in stats.label_distribution(
            out.where("volatility_spike is not null"), "volatility_spike"
        ).collect()
    }
    assert 0.15 < dist[1] < 0.25
    assert out.count() == 300
    assert labels.spike_label(out) is out
    cut = out.first()["label_threshold"]
    again = labels.spike_label(df, threshold=cut)
    keys = ["product_id", "us", "seq", "volatility_spike"]
    assert again.select(keys).exceptAll(out.select(keys)).count() == 0

    stored = out.withColumn(
        "volatility_spike", F.when(F.col("seq") % 2 == 0, F.lit(9)).otherwise(F.lit(None).cast("int"))
    )
    filled = labels.label_backfill(stored, out)
    assert filled.where("seq % 2 = 0 and volatility_spike <> 9").count() == 0
    assert filled.where("seq % 2 = 1").select(keys).exceptAll(out.select(keys)).count() == 0


def test_no_label_without_future(spark):
    df = spark.createDataFrame([("A", 0, 0, 1.0, 1.0, 1.0, 1.0, 1.0)], TICKS)
    row = labels.spike_label(df).first()
    assert row["volatility_spike"] is None and row["future_volatility"] is None


@pytest.mark.parametrize("rows_per_range", [None, 2])
def test_out_of_order(spark, small_ranges, rows_per_range):
    if rows_per_range:
        small_ranges(rows_per_range)
    times = [0, 10, 9.5, 8.4, 12, 3]
    df = spark.createDataFrame([(int(t * SECOND), i) for i, t in enumerate(times)], "us bigint, seq bigint")
    got = [r["out_of_order"] for r in labels.out_of_order(df).orderBy("seq").collect()]
    assert got == [False, False, False, True, False, True]
    got = [r["out_of_order"] for r in labels.out_of_order(df, against_max=True).orderBy("seq").collect()]
    assert got == [False, False, False, True, False, True]
