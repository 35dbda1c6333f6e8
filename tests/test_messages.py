import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import splits
from tidemark.schema import MODEL_FEATURES
from tidemark.sources import feed, files, messages, sinks

TIME, US = "2024-01-31T10:00:00.250000Z", 1_706_695_200_250_000


def frame(spark, *values, schema="value string, score string"):
    return spark.createDataFrame([(v, "own") for v in values], schema)


def test_read_predictions(spark):
    good = {"timestamp": TIME, "model_variant": "ml", "model_version": "v1", "score": 0.5, "prediction": 1,
            "features": {"log_return_300s": "0.25", "n": 7, "product_id": "A", "price": 9, "spread_mean_60s": "x"}}
    rows = frame(
        spark, json.dumps(good), json.dumps({**good, "score": "0.5", "schema_version": 2, "product_id": "B"}),
        json.dumps({**good, "schema_version": 3}), json.dumps({**good, "timestamp": "soon"}),
        json.dumps({**good, "score": None}), json.dumps({**good, "score": "NaN"}), "{", " ", None, "{}",
    )
    out = messages.read_predictions(rows).collect()
    assert [r.reason for r in out] == [
        None, None, "version", "time", "score", "score", "broken", "empty", "empty", "time"
    ]
    first, second = out[:2]
    assert (first.us, first.score, first.prediction, first.schema_version) == (US, 0.5, 1, 1)
    assert (first.product_id, first.price, second.product_id, second.schema_version) == ("A", 9.0, "B", 2)
    assert first.features["log_return_300s"] == 0.25 and first.features["spread_mean_60s"] is None
    assert messages.decode_predictions(rows).count() == 2
    assert messages.decode_predictions(rows.limit(0)).count() == 0
    assert messages.decode_predictions(rows.unionByName(rows)).count() == 4


def test_read_features(spark):
    good = {"timestamp": TIME, "product_id": "A", "price": "2.5", "log_return_300s": "1e-3", "trade_intensity_300s": 12,
            "spread_mean_60s": "n/a", "volatility_spike": 1}
    rows = frame(spark, json.dumps(good), json.dumps({**good, "timestamp": None}), "nope", "",
                 schema="value string, us string")
    out = messages.read_features(rows).collect()
    assert [r.reason for r in out] == [None, "time", "broken", "empty"]
    assert (out[0].us, out[0].price, out[0].log_return_300s, out[0].volatility_spike) == (US, 2.5, 0.001, 1)
    request = messages.score_requests(messages.decode_features(rows)).first()
    assert (request.ret_mean, request.n, request.spread_mean_60s) == (0.001, 12, 0.0)
    assert all(request[f] is not None for f in MODEL_FEATURES)


def scored(spark):
    rows = [(US + i * 43_200_000_000, f"p{i % 3}", 0.1 * i, int(i > 4), 1.5 * i) for i in range(9)]
    df = spark.createDataFrame(rows, "us bigint, product_id string, score double, prediction int, x double")
    values = {f: F.col("x") + i for i, f in enumerate(MODEL_FEATURES)}
    return df.withColumns({**values, "model_variant": F.lit("ml"), "model_version": F.lit("v2")})


def test_prediction_log_round_trip(spark, tmp_path):
    path = str(tmp_path / "log")
    df = scored(spark)
    sinks.write_prediction_log(df.where("prediction = 0"), path)
    sinks.write_prediction_log(df.where("prediction = 1"), path, files_per_day=1)
    wanted = sorted((r.us, r.product_id, r.score, r.prediction, r.log_return_300s, r.realized_volatility_60s) for r in df.collect())
    back = files.prediction_files(spark, path)
    got = sorted((r.us, r.product_id, r.score, r.prediction, r.features.log_return_300s, r.features.realized_volatility_60s) for r in back.collect())
    assert got == wanted
    assert files.prediction_files(spark, path, days=["2024-01-31", "2024-02-02"]).count() == 4
    # The file of another writer stands beside the day folders.
    line = {"timestamp": TIME, "score": 1.0, "features": {}}
    (tmp_path / "log" / "predictions_20240131.ndjson").write_text(json.dumps(line) + "\n{bad\n\n")
    assert files.prediction_files(spark, path).count() == 10
    with pytest.raises(ValueError):
        sinks.write_prediction_log(df.withColumn("us", F.lit(None).cast("bigint")), path)


@pytest.mark.parametrize("extra, want", [
    ({"best_bid_quantity": "1", "best_ask_quantity": "2", "trade_size": "3"}, (1.0, 2.0, 3.0)),
    ({"raw": {"best_bid_quantity": "5"}, "best_bid_quantity": "1", "best_ask_quantity": "2", "size": 4}, (5.0, 2.0, 4.0)),
    ({"raw": {"best_bid_quantity": "", "best_ask_quantity": "6", "size": "9"}, "best_bid_quantity": "1"}, (1.0, 6.0, 9.0)),
    ({"best_bid_quantity": "1", "volume": "", "trade_size": "x"}, (None, None, None)),
])
def test_top_level_quantities(spark, extra, want):
    text = json.dumps({"timestamp": TIME, "product_id": "A", "price": "1", **extra})
    tick = feed.ticks_from_json(spark.createDataFrame([(text,)], "value string")).first()
    assert (tick.bid_qty, tick.ask_qty, tick.trade_size) == want


def test_stratified_narrows_exactly(spark):
    """Ties, a NULL class, a class of one row, clashing names, and hashes that share their top bits."""
    import math

    import numpy as np

    rng = np.random.default_rng(3)
    data = [(i, [None, "a", "b"][int(rng.integers(3))], int(rng.integers(-50, 50)) if i % 3 else int(rng.integers(-2**63, 2**63 - 1)), i)
            for i in range(500)]
    data.append((500, "one", 5, 500))
    df = spark.createDataFrame(data, "id bigint, y string, h bigint, split bigint")
    out = splits.split_stratified(df, "y", ["id"], spread=F.col("h"))
    assert out.columns == ["id", "y", "h", "split"]
    got = {r.id: r.split for r in out.collect()}
    assert len(got) == 501
    for label in (None, "a", "b", "one"):
        mine = sorted((d for d in data if d[1] == label), key=lambda d: d[2])
        cuts = [math.ceil(len(mine) * s) for s in (1 - 0.15 - 0.15, 1 - 0.15)]
        limits = [mine[c][2] if c < len(mine) else math.inf for c in cuts]
        for row in mine:
            assert got[row[0]] == ("train" if row[2] < limits[0] else "val" if row[2] < limits[1] else "test")
    assert splits.split_stratified(df.limit(0), "y", ["id"]).count() == 0
