import pytest
from helpers import SECOND, TICKS, random_ticks
from pyspark.sql import functions as F

from tidemark.operators.features import tick_features
from tidemark.operators.labels import spike_label
from tidemark.operators.scoring import baseline_scorer, fit_baseline, score_table
from tidemark.schema import MODEL_FEATURES
from tidemark.streaming import features as sf
from tidemark.streaming import flows, tables


@pytest.fixture
def feed(spark, tmp_path):
    """Ticks in order of time, written as several files, and a stream over them."""
    rows = sorted(random_ticks(200, 11, nulls=False), key=lambda r: r[1])
    rows = [(r[0], r[1], i, *r[3:]) for i, r in enumerate(rows)]
    folder = str(tmp_path / "in")
    for part in range(4):
        chunk = rows[part * 50 : (part + 1) * 50]
        spark.createDataFrame(chunk, TICKS).coalesce(1).write.mode("append").parquet(folder)
    batch = spark.createDataFrame(rows, TICKS)

    def stream():
        return spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(folder)

    return batch, stream, str(tmp_path)


def run(stream, each, checkpoint):
    flow = sf.start(stream, each, checkpoint, available_now=True)
    flow.awaitTermination()
    return flow


def same(a, b, keys, columns):
    a = {tuple(r[k] for k in keys): r for r in a.collect()}
    b = {tuple(r[k] for k in keys): r for r in b.collect()}
    assert a.keys() == b.keys()
    for key, row in a.items():
        for c in columns:
            x, y = row[c], b[key][c]
            assert x == y or abs(x - y) < 1e-9, (key, c)


def test_features_equal_batch(spark, feed):
    batch, stream, base = feed
    published = []
    each = sf.feature_batch(
        f"{base}/ticks", f"{base}/features", then=lambda df, n: published.append(df.count())
    )
    run(stream(), each, f"{base}/c1")
    out = spark.read.parquet(f"{base}/features")
    same(tick_features(batch), out, ["product_id", "seq"], MODEL_FEATURES)
    assert published == [50] * 4

    # A batch that is run again changes nothing.
    last = out.where("batch = 3")
    each(batch.join(last.select("seq"), "seq", "left_semi"), 3)
    same(tick_features(batch), spark.read.parquet(f"{base}/features"), ["product_id", "seq"], MODEL_FEATURES)


def test_labels_equal_batch(spark, feed):
    batch, stream, base = feed
    full = spike_label(batch)
    cut = full.first()["label_threshold"]
    each = sf.label_batch(f"{base}/rows", f"{base}/labels", f"{base}/progress", cut)
    run(stream(), each, f"{base}/c2")
    newest = batch.agg(F.max("us")).first()[0]
    due = full.where(F.col("us") < newest - 60 * SECOND)
    same(due, spark.read.parquet(f"{base}/labels"), ["product_id", "seq"], ["volatility_spike"])


def test_score_stream(spark, feed):
    batch, _, base = feed
    table = tick_features(batch)
    table.write.parquet(f"{base}/table")
    scorers = {"baseline": baseline_scorer(fit_baseline(table))}
    stream = spark.readStream.schema(table.schema).parquet(f"{base}/table")
    flow = (
        flows.score_stream(stream, scorers, threshold=0.5).writeStream.format("parquet")
        .option("checkpointLocation", f"{base}/c3").trigger(availableNow=True).start(f"{base}/scores")
    )
    flow.awaitTermination()
    same(score_table(table, scorers, threshold=0.5), spark.read.parquet(f"{base}/scores"), ["product_id", "seq"], ["score", "prediction"])
    assert flows.rate_rows(flow)[0]["rows"] == 200
    assert flows.lag_rows(flow) == []


def test_lag_of_kafka_progress():
    class Query:
        lastProgress = {
            "sources": [{
                "latestOffset": {"t": {"0": 50, "1": 9}}, "endOffset": {"t": {"0": 20, "1": 9}},
            }]
        }

    assert flows.lag_rows(Query) == [
        {"topic": "t", "partition": 0, "lag": 30}, {"topic": "t", "partition": 1, "lag": 0},
    ]


def test_dedup_and_counters(spark, feed):
    batch, stream, base = feed
    ts = F.timestamp_micros("us")
    twice = stream().withColumn("ts", ts)
    twice = flows.dedup(twice.unionByName(twice))
    flow = (
        twice.writeStream.format("parquet").option("checkpointLocation", f"{base}/c4")
        .trigger(availableNow=True).start(f"{base}/once")
    )
    flow.awaitTermination()
    got = spark.read.parquet(f"{base}/once").select("us", "product_id")
    want = batch.select("us", "product_id").distinct()
    assert got.count() == want.count() and got.exceptAll(want).count() == 0

    counts = flows.counters(stream().withColumn("ts", ts), "product_id", length="20 seconds", slide="10 seconds", delay="0 seconds")
    flow = (
        counts.writeStream.format("memory").queryName("counted").outputMode("complete")
        .option("checkpointLocation", f"{base}/c5").trigger(availableNow=True).start()
    )
    flow.awaitTermination()
    assert spark.table("counted").agg(F.sum("n")).first()[0] == 400


def test_late_rows(spark, tmp_path):
    base = str(tmp_path)
    each = flows.late_batch(f"{base}/ok", f"{base}/late", f"{base}/p", 10)
    batch = lambda *us: spark.createDataFrame([(u,) for u in us], "us bigint")
    each(batch(100, 5), 0)
    each(batch(90, 89, 300), 1)
    each(batch(), 2)
    each(batch(289, 290), 3)
    late = sorted(r["us"] for r in spark.read.parquet(f"{base}/late").collect())
    assert late == [89, 289]
    assert spark.read.parquet(f"{base}/ok").count() == 5


def test_batch_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(5, 1.0), (tables.DAY + 5, 2.0)], "us bigint, x double")
    tables.write_batch(df, path, 0)
    tables.write_batch(df.where("x > 1"), path, 1)
    tables.write_batch(df.where("x > 1"), path, 1)
    assert tables.read_own(spark, path, df.schema, 1).count() == 1
    assert tables.read_before(spark, path, df.schema, 1, [(0, tables.DAY * 2)]).count() == 2
    assert tables.read_before(spark, path, df.schema, 2, [(tables.DAY, tables.DAY * 2)]).count() == 2
    assert tables.read_before(spark, path, df.schema, 2, [(tables.DAY * 5, tables.DAY * 6)]).count() == 0
    assert tables.joined_spans([(5, 9), (1, 3), (2, 6), (20, 21)]) == [(1, 9), (20, 21)]


def test_late_rows_get_labels(spark, tmp_path):
    """Rows that come later than their horizon are labelled by their own batch, once."""
    base, second = str(tmp_path), 1_000_000
    each = sf.label_batch(f"{base}/rows", f"{base}/labels", f"{base}/progress", 0.001, 60, 300)

    def batch(*seconds):
        rows = [("A", t * second, i + 1000 * len(seconds) + seconds[0], 100.0 + t % 7) for i, t in enumerate(seconds)]
        return spark.createDataFrame(rows, "product_id string, us bigint, seq bigint, price double")

    each(batch(*range(1000, 1200, 5)), 0)
    each(batch(1003, 1004, 20, 1201), 1)
    each(batch(*range(1300, 1500, 5)), 2)
    found = spark.read.parquet(f"{base}/labels")
    times = sorted(r.us // second for r in found.collect())
    assert times == sorted([*range(1000, 1200, 5), 1003, 1004, 20, 1201, *range(1300, 1435, 5)])
    assert found.where("us = 1003000000").first().volatility_spike == 1
