import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.functions import ticks as tk
from tidemark.sources import feed, files, kafka, replay, sinks

TIME = "2025-12-01T16:44:46.123456Z"
US = 1_764_607_486_123_456


def ticker(**kw):
    return {"product_id": "BTC-USD", "price": "100.5", "best_bid": "100", "best_ask": "101", "time": TIME, **kw}


def decode(spark, messages, **kw):
    rows = [(m if isinstance(m, str) or m is None else json.dumps(m), i) for i, m in enumerate(messages)]
    return feed.decode_feed(spark.createDataFrame(rows, "value string, i int"), **kw)


def test_shapes(spark):
    nested = {
        "channel": "ticker",
        "events": [
            {"type": "other", "tickers": [ticker(price="1")]},
            {"type": "update", "tickers": []},
            {"type": "snapshot", "tickers": [ticker(volume_24_h="7", best_bid_quantity="2", best_ask_quantity="3"), ticker(price="2")]},
            {"type": "ticker", "tickers": [ticker(price="3")]},
        ],
    }
    flat = {"type": "ticker", "product_id": "ETH-USD", "price": "5", "volume_24_h": "", "volume": "9", "bid": "4", "ask": 6}
    trade = {"type": "last_match", "product_id": "BTC-USD", "price": "8", "size": "0.5", "time": TIME, "best_bid": "1"}
    skip = [
        {"type": "subscriptions", "events": nested["events"]}, {"channel": "heartbeats", "events": nested["events"]},
        {"type": "error"}, {"events": [], "type": "ticker", "price": "1"}, {"type": "else"}, "", "  ", "{broken", None,
    ]
    ingest = F.lit("2025-12-02 00:00:00").cast("timestamp")
    out = {r["i"]: r for r in decode(spark, [nested, flat, trade, *skip], ingest_time=ingest).collect()}
    assert set(out) == {0, 1, 2}
    assert (out[0]["price"], out[0]["volume_24h"], out[0]["timestamp"]) == ("100.5", "7", TIME)
    assert (out[1]["volume_24h"], out[1]["best_bid"], out[1]["best_ask"]) == ("9", "4", "6")
    assert out[1]["timestamp"] == "2025-12-02T00:00:00.000000Z"
    assert out[2]["best_bid"] is None and out[2]["raw"]["size"] == "0.5"
    every = decode(spark, [nested], all_tickers=True)
    assert sorted(r["price"] for r in every.collect()) == ["100.5", "2", "3"]

    ticks = {r["i"]: r for r in feed.parse_ticks(decode(spark, [nested, flat, trade], ingest_time=ingest)).collect()}
    assert ticks[0]["us"] == US and ticks[0]["bid_qty"] == 2.0 and ticks[0]["ask_qty"] == 3.0
    assert ticks[1]["bid_qty"] is None and ticks[2]["trade_size"] == 0.5
    assert json.loads(ticks[2]["raw"])["size"] == "0.5"


@pytest.mark.parametrize("tick,price", [
    ({"price": "10"}, 10.0),
    ({"price": 10}, 10.0),
    ({"price": "x", "best_bid": "1", "best_ask": "3"}, None),
    ({"price": None, "best_bid": "1", "best_ask": "3"}, None),
    ({"best_bid": "1", "best_ask": "3"}, 2.0),
    ({"best_bid": "0", "best_ask": "3"}, None),
    ({"best_ask": "3"}, None),
])
def test_mid_price(spark, tick, price):
    df = spark.createDataFrame([(json.dumps({"timestamp": TIME, **tick}),)], "value string")
    assert feed.ticks_from_json(df).first()["price"] == price


def test_quarantine_and_bad_times(spark):
    df = spark.createDataFrame([("{}",), ('{"a": 1}',), (" ",), (None,), ("{",), ("nope",)], "value string")
    good, bad = feed.json_quarantine(df)
    assert good.count() == 2
    assert sorted(r["reason"] for r in bad.collect()) == ["broken", "broken", "empty", "empty"]
    raw = spark.createDataFrame([(bytearray(b"ok"),), (bytearray(b"\xff\xfe"),)], "b binary")
    assert [r[0] for r in raw.select(feed.decode_utf8(F.col("b"))).collect()] == ["ok", None]

    seen = Observation()
    rows = spark.createDataFrame([(1,), (None,)], "us bigint")
    assert feed.drop_invalid_times(rows, seen).count() == 1
    assert seen.get["invalid_times"] == 1


def test_iso_round_trip(spark):
    out = spark.range(1).select(
        tk.micros(tk.event_time(F.lit(TIME), F.lit(None))).alias("us"),
        tk.iso_utc(F.timestamp_micros(F.lit(US))).alias("iso"),
        tk.event_time(F.lit("soon"), F.current_timestamp()).alias("bad"),
        tk.event_time(F.lit(""), F.timestamp_micros(F.lit(5))).alias("ingest"),
    ).first()
    assert (out["us"], out["iso"], out["bad"]) == (US, TIME, None)
    assert out["ingest"] is not None


def test_ndjson_files(spark, tmp_path):
    ticks = tmp_path / "ticks.ndjson"
    ticks.write_text(json.dumps({"timestamp": TIME, "product_id": "A", "price": "1.5"}) + "\n{bad\n\n")
    (tmp_path / "other.txt").write_text("{}")
    rows = files.tick_files(spark, str(tmp_path)).where("product_id is not null")
    assert feed.parse_ticks(rows).first()["price"] == 1.5 and rows.count() == 1

    logs = tmp_path / "logs"
    logs.mkdir()
    line = {"timestamp": TIME, "model_version": "v1", "score": 0.25, "prediction": 0, "features": {"log_return_300s": 1.0}}
    (logs / "predictions_1.ndjson").write_text(json.dumps(line) + "\n")
    (logs / "else.ndjson").write_text(json.dumps(line) + "\n")
    log = files.prediction_files(spark, str(logs)).collect()
    assert len(log) == 1 and log[0]["us"] == US and log[0]["features"]["log_return_300s"] == 1.0


def test_reports_and_thresholds(spark, tmp_path):
    path = tmp_path / "load.json"
    path.write_text(json.dumps({
        "summary": {"total_time_seconds": 0.5},
        "results": [{"request_id": 0, "status_code": 200, "latency_ms": 12.5, "success": True, "error": None},
                    {"request_id": 1, "status_code": 500, "latency_ms": 3.0, "success": False, "error": "x"}],
    }))
    rows = files.load_test_results(spark, str(path)).orderBy("request_id").collect()
    assert [(r["latency_ms"], r["success"], r["elapsed_seconds"]) for r in rows] == [(12.5, True, 0.5), (3.0, False, 0.5)]
    for i, (meta, want) in enumerate([
        ({"optimal_threshold": 0.9, "threshold_10pct": 0.8, "threshold_used": 0.7}, 0.7),
        ({"optimal_threshold": 0.9, "threshold_10pct": 0.8}, 0.8),
        ({"optimal_threshold": 0.9}, 0.9), ({"note": "none"}, 0.05),
    ]):
        file = tmp_path / f"t{i}.json"
        file.write_text(json.dumps(meta, indent=2))
        assert files.threshold(spark, str(file)).first()["threshold"] == want


def test_kafka_forms(spark):
    options = kafka.recent_options("h:9092", "predictions.log", 3, 1700)
    assert json.loads(options["startingOffsetsByTimestamp"]) == {"predictions.log": {"0": 1700, "1": 1700, "2": 1700}}
    df = spark.createDataFrame([("A", 1.5)], "product_id string, price double")
    row = kafka.to_messages(df).first()
    assert row["key"] == "A" and json.loads(row["value"]) == {"product_id": "A", "price": 1.5}
    raw = spark.createDataFrame([(bytearray(b"{}"), "t", 0, 7, None)], "value binary, topic string, partition int, offset bigint, timestamp timestamp")
    assert kafka.text_messages(raw).first()["seq"] == 7


def test_replay(spark):
    df = spark.createDataFrame([(100, 0), (130, 1), (160, 2)], "us bigint, seq bigint")
    times = lambda d: sorted(r["us"] for r in d.collect())
    assert times(replay.retime(df, 1000)) == [1000, 1030, 1060]
    assert times(replay.retime(df, 1000, speed=10)) == [1000, 1003, 1006]
    assert times(replay.retime(df, 1000, limit=2)) == [1000, 1030]
    assert times(replay.retime(df, 1000, keep_ts=True)) == [100, 130, 160]


def test_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "features")
    day = 86_400_000_000
    a = spark.createDataFrame([(1, "A", 0, 1.0), (1, "A", 1, 2.0), (day + 1, "A", 2, 3.0)], "us bigint, product_id string, seq bigint, x double")
    b = spark.createDataFrame([(day + 1, "A", 8, 9.0), (day + 2, "B", 9, 4.0)], a.schema)
    for df in (a, a, b, b):
        sinks.append_features(df, path)
    got = sorted((r["us"], r["product_id"], r["x"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, "A", 1.0), (day + 1, "A", 3.0), (day + 2, "B", 4.0)]


def test_other_sinks(spark, tmp_path):
    df = spark.createDataFrame([("A", 1.5)], "product_id string, price double")
    sinks.write_ndjson(df, str(tmp_path / "nd"))
    sinks.write_ndjson(df, str(tmp_path / "nd"))
    assert spark.read.json(str(tmp_path / "nd")).count() == 2
    sinks.write_report(df, str(tmp_path / "report"))
    assert len(list((tmp_path / "report").glob("part-*"))) == 1
    target = sinks.write_labeled(df, str(tmp_path / "f.parquet"))
    assert target.endswith("f_labeled.parquet") and spark.read.parquet(target).count() == 1
    for _ in range(2):
        sinks.append_history(df, str(tmp_path / "history"))
    assert spark.read.parquet(str(tmp_path / "history")).count() == 2
