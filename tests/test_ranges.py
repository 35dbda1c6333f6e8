import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import ranges, splits


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(5)
    data = np.concatenate([rng.normal(0, 1, 2000), np.full(1500, 0.25), rng.exponential(1e6, 500)])
    return data, spark.createDataFrame([(float(x), i) for i, x in enumerate(data)], "v double, id bigint")


@pytest.mark.parametrize("limit", [10, 200, 1_000_000])
def test_order_statistics_are_exact(values, limit):
    data, df = values
    ranks = [1, 2, 500, 1700, 2500, 3999, 4000]
    n, got = ranges.order_statistics(df, "v", lambda n: ranks, limit=limit)
    ordered = np.sort(data)
    assert n == len(data)
    assert got == {r: ordered[r - 1] for r in ranks}


def test_quantiles_match_numpy(values):
    data, df = values
    got = ranges.quantiles(df, "v", [0, 0.1, 0.5, 0.9, 1])
    for p, x in got.items():
        assert np.isclose(x, np.percentile(data, p * 100), rtol=1e-12)


def test_quantiles_skip_missing(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    assert ranges.quantiles(df, "v", [0.5]) == {0.5: 2.0}
    assert ranges.quantiles(df.limit(0), "v", [0.5]) == {0.5: None}


@pytest.mark.parametrize("rows", [1_000_000, 37])
@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_running(spark, small_ranges, rows, reverse, inclusive):
    small_ranges(rows)
    rng = np.random.default_rng(6)
    data = [
        (int(k), int(t), i, float(x) if x > 0.3 else None)
        for i, (k, t, x) in enumerate(zip(rng.integers(0, 3, 400), rng.integers(0, 90, 400), rng.random(400)))
    ]
    df = spark.createDataFrame(data, "k int, t bigint, i bigint, x double")
    x = F.col("x")
    out = ranges.running(
        df, ["k"], ["t", "i"], {"s": ("sum", x), "m": ("max", x), "l": ("last", x)},
        inclusive=inclusive, reverse=reverse,
    )
    got = {r["i"]: r for r in out.collect()}
    assert len(got) == 400
    for k in range(3):
        seen = []
        for r in sorted((r for r in data if r[0] == k), key=lambda r: (r[1], r[2]), reverse=reverse):
            if inclusive and r[3] is not None:
                seen.append(r[3])
            row = got[r[2]]
            if seen:
                assert np.isclose(row["s"], sum(seen)) and row["m"] == max(seen) and row["l"] == seen[-1]
            else:
                assert row["s"] is None and row["m"] is None and row["l"] is None
            if not inclusive and r[3] is not None:
                seen.append(r[3])


def test_halo_rejects_long_frames(spark):
    with pytest.raises(ValueError):
        ranges.halo(spark.range(1).selectExpr("id as us"), 10, back=11)


def test_halo_before_epoch(spark):
    df = spark.createDataFrame([(-1,), (-10,), (0,), (9,)], "us bigint")
    got = {(r["us"], r["bucket"], r["home"]) for r in ranges.halo(df, 10, back=1, ahead=0).collect()}
    assert got == {(-1, -1, True), (-1, 0, False), (-10, -1, True), (0, 0, True), (9, 0, True), (9, 1, False)}


@pytest.mark.parametrize("times", [range(20), [0] * 20, [0] * 9 + [1] * 11])
def test_splits_are_exact(spark, times):
    df = spark.createDataFrame([(int(t), i) for i, t in enumerate(times)], "us bigint, seq bigint")
    got = [r["split"] for r in splits.split_train_test(df).orderBy("us", "seq").collect()]
    assert got == ["train"] * 14 + ["val"] * 3 + ["test"] * 3
    got = [r["split"] for r in splits.split_ratio(df, 0.33).orderBy("us", "seq").collect()]
    assert got == ["reference"] * 6 + ["current"] * 14
    assert {r["split"] for r in splits.split_ratio(df, 1.0).collect()} == {"reference"}


def test_stratified_keeps_the_rate(spark):
    df = spark.range(1000).selectExpr("id", "int(id % 10 = 0) as y")
    got = {
        (r["y"], r["split"]): r["count"]
        for r in splits.split_stratified(df, "y", ["id"]).groupBy("y", "split").count().collect()
    }
    assert got == {(0, "train"): 630, (0, "val"): 135, (0, "test"): 135,
                   (1, "train"): 70, (1, "val"): 15, (1, "test"): 15}


@pytest.mark.parametrize("reverse", [False, True])
def test_running_within_one_value(spark, small_ranges, reverse):
    """Nine rows of ten share one order value; the tie column cuts them into ranges."""
    small_ranges(25)
    rng = np.random.default_rng(7)
    data = [(int(i % 2), 50 if rng.random() < 0.9 else int(rng.integers(0, 100)), i, float(x)) for i, x in enumerate(rng.random(600))]
    data += [(0, 50, None, 1.0), (1, 50, 599, 2.0)]
    df = spark.createDataFrame(data, "k int, t bigint, i bigint, x double")
    points = ranges.range_points(df, "t", tie="i")
    sizes = [r["count"] for r in ranges.assign_range(df, "t", points, "i").groupBy("_range").count().collect()]
    assert max(sizes) < 75 and len(sizes) > 15
    out = ranges.running(df.where("i is not null"), ["k"], ["t", "i", "x"], {"s": ("sum", F.lit(1))}, reverse=reverse)
    for k in (0, 1):
        line = sorted((r for r in data if r[0] == k and r[2] is not None), key=lambda r: r[1:], reverse=reverse)
        got = {(r["t"], r["i"], r["x"]): r["s"] for r in out.where(F.col("k") == k).collect()}
        assert got == {r[1:]: n + 1 for n, r in enumerate(line)}


def test_many_ranges_in_two_steps(spark, small_ranges, monkeypatch):
    monkeypatch.setattr(ranges, "COARSE", 4)
    small_ranges(10)
    df = spark.range(1000).selectExpr("id * 3 as t")
    points = ranges.range_points(df, "t")
    sizes = [r["count"] for r in ranges.assign_range(df, "t", points).groupBy("_range").count().collect()]
    assert len(sizes) > 80 and max(sizes) <= 30


def test_nested_scans_read_the_input_twice(spark, small_ranges):
    """Two levels of running values at 50 rows a range: the input is derived for its count and its copy."""
    from tidemark.operators.labels import gap_chunks

    small_ranges(50)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    base = spark.range(1000).selectExpr("'A' as product_id", "id * 200000000 as us", "id as seq")
    out = gap_chunks(base.mapInArrow(counted, base.schema), gap=100).collect()
    assert sorted(r["chunk_id"] for r in out) == list(range(1000))
    assert read.value <= 2000


def test_select_with_heavy_ties(spark):
    """Ties at the end of many distinct values are split off before anything is gathered."""
    df = spark.range(40_000).selectExpr("if(id < 30000, 5.0D, 5.0D + id) as v")
    ordered = sorted([5.0] * 30_000 + [5.0 + i for i in range(30_000, 40_000)])
    wanted = [1, 29_999, 30_000, 30_001, 30_002, 39_999, 40_000]
    assert ranges.order_statistics(df, "v", lambda n: wanted, limit=20)[1] == {r: ordered[r - 1] for r in wanted}
