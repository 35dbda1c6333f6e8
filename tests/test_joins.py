import numpy as np
import pandas as pd
import pytest

from tidemark.operators import joins


def tables(seed, n=120, m=80, top=400):
    rng = np.random.default_rng(seed)
    left = pd.DataFrame({"us": rng.integers(0, top, n), "id": range(n), "p": rng.integers(0, 2, n)})
    right = pd.DataFrame({"us": rng.integers(0, top, m), "seq": range(m), "p": rng.integers(0, 2, m)})
    return left, right


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("tolerance", [None, 3])
@pytest.mark.parametrize("by", [[], ["p"]])
@pytest.mark.parametrize("rows", [None, 15])
def test_asof_matches_pandas(spark, small_ranges, direction, tolerance, by, rows):
    if rows:
        small_ranges(rows)
    left, right = tables(len(direction) + bool(by))
    want = pd.merge_asof(
        left.sort_values("us", kind="stable"),
        right.sort_values(["us", "seq"]),
        on="us", by=by or None, direction=direction, tolerance=tolerance,
    ).set_index("id")["seq"]
    right_df = spark.createDataFrame(right if by else right.drop(columns="p"))
    out = joins.asof_join(
        spark.createDataFrame(left), right_df, ["seq"], by=by, direction=direction, tolerance=tolerance
    )
    got = out.toPandas().set_index("id")["seq"]
    assert len(got) == len(want)
    for i, value in want.items():
        assert (pd.isna(value) and pd.isna(got[i])) or value == got[i], i


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("on_the_day", [True, False])
def test_asof_on_a_crowded_day(spark, small_ranges, direction, on_the_day):
    """95 % of the rows lie on one day: no task gets more than a few ranges' worth of them."""
    small_ranges(20)
    rng = np.random.default_rng(3)
    day = 86_400_000_000
    left = pd.DataFrame({"us": np.where(rng.random(400) < 0.95, 10, rng.integers(0, 20, 400)) * day, "id": range(400), "p": rng.integers(0, 2, 400)})
    right = pd.DataFrame({"us": rng.integers(0, 20, 60) * day + (0 if on_the_day else 5), "seq": range(60), "p": rng.integers(0, 2, 60)})
    want = pd.merge_asof(
        left.sort_values("us", kind="stable"), right.sort_values(["us", "seq"]), on="us", by="p", direction=direction
    ).set_index("id")["seq"]
    out = joins.asof_join(spark.createDataFrame(left), spark.createDataFrame(right), ["seq"], by=["p"], direction=direction)
    got = out.toPandas().set_index("id")["seq"]
    assert len(got) == 400
    for i, value in want.items():
        assert (pd.isna(value) and pd.isna(got[i])) or value == got[i], i


def test_asof_edges(spark):
    left = spark.createDataFrame([(5, 1)], "us bigint, id int")
    right = spark.createDataFrame([(3, 1), (7, 2)], "us bigint, seq bigint")
    assert joins.asof_join(left, right, ["seq"]).first()["seq"] == 1
    assert joins.asof_join(left, right.limit(0), ["seq"]).first()["seq"] is None
    assert joins.asof_join(left.limit(0), right, ["seq"]).count() == 0
    with pytest.raises(ValueError):
        joins.asof_join(left, right, ["seq"], direction="sideways")


def test_dedup(spark):
    stored = spark.createDataFrame([(1, "A", 0, 1.0)], "us bigint, product_id string, seq bigint, x double")
    new = spark.createDataFrame(
        [(1, "A", 5, 9.0), (2, "A", 7, 3.0), (2, "A", 6, 2.0), (1, "B", 8, 4.0)], stored.schema
    )
    out = sorted(tuple(r) for r in joins.dedup_append(stored, new).collect())
    assert out == [(1, "A", 0, 1.0), (1, "B", 8, 4.0), (2, "A", 6, 2.0)]
    assert [tuple(r) for r in joins.duplicate_keys(stored, new).collect()] == [(1, "A")]


def test_consolidate(spark):
    a = spark.createDataFrame([(0, "A", 0), (50, "A", 1), (200, "A", 2)], "us bigint, product_id string, seq bigint")
    b = spark.createDataFrame([(0, "A", 3), (10, "B", 4)], a.schema)
    out = sorted((r["product_id"], r["us"], r["seq"]) for r in joins.consolidate([a, b], 100).collect())
    assert out == [("A", 0, 0), ("A", 200, 2), ("B", 10, 4)]
