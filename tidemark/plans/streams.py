"""Streaming operators as queries: the events table is read as a file stream."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import stats
from tidemark.operators.labels import forward_volatility, volatility_threshold
from tidemark.operators.scoring import baseline_scorer, fit_baseline
from tidemark.plans import sql as q
from tidemark.plans import tape as v
from tidemark.plans.queries import KEY, SPIKE, features, rounded_features
from tidemark.plans.registry import query
from tidemark.session import materialize, scratch_path
from tidemark.streaming import features as sf_features
from tidemark.streaming import flows, progress, sessions, store, tables


def tick_stream(spark: SparkSession, sf: str, pattern: str = "events.parquet") -> DataFrame:
    """The tape over a stream of event files."""
    schema = v.table(spark, sf, "events").schema
    stream = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", 1)
        .parquet(sf)
    )
    return v.as_tape(stream)


@query("stream_features", f"WITH {q.FEATURES} SELECT {q.feature_columns()} FROM features")
def stream_features(spark, sf):
    base = scratch_path(spark, "stream-features")
    each = sf_features.feature_batch(f"{base}/ticks", f"{base}/features", v.TAPE_FRAMES)
    flow = sf_features.start(tick_stream(spark, sf), each, f"{base}/checkpoint", available_now=True)
    flow.awaitTermination()
    return rounded_features(spark.read.parquet(f"{base}/features").drop("day", "batch", "price"))


def tape_files(spark: SparkSession, sf: str, folder: str, parts: int) -> DataFrame:
    """The tape as files in order of time, and a stream that takes one of them at a time."""
    t = v.tape(spark, sf).select(*sf_features.TICK_COLUMNS)
    span = t.agg(F.min("us").alias("_from"), F.max("us").alias("_to"))
    part = F.floor((F.col("us") - F.col("_from")) * parts / (F.col("_to") - F.col("_from") + 1))
    rows = materialize(t.crossJoin(F.broadcast(span)).withColumn("part", part.cast("int")))
    for number in range(parts):
        rows.where(F.col("part") == number).select(*t.columns).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(folder)


@query("stream_features_compacted", f"WITH {q.FEATURES} SELECT {q.feature_columns()} FROM features")
def stream_features_compacted(spark, sf):
    """Features over five files, with the tick store compacted before every other one and old days let go."""
    base = scratch_path(spark, "stream-compacted")
    each = sf_features.feature_batch(f"{base}/ticks", f"{base}/features", v.TAPE_FRAMES, compact_every=2, keep_days=3)
    flow = sf_features.start(tape_files(spark, sf, f"{base}/in", 5), each, f"{base}/checkpoint", available_now=True)
    flow.awaitTermination()
    return rounded_features(spark.read.parquet(f"{base}/features").drop("day", "batch", "price"))


@query(
    "tick_store",
    f"""WITH {q.TAPE}, days AS (SELECT us // 86400000000 AS day, * FROM tape)
    SELECT CAST(day AS INTEGER) AS day, product_id, count(*) AS n, sum(seq) AS seqs, count(DISTINCT seq % 6) AS batches
    FROM days WHERE day > (SELECT max(day) FROM days) - 7 GROUP BY 1, 2""",
)
def tick_store(spark, sf):
    """The last seven days of a store of six batches that each hold rows of every day."""
    path = scratch_path(spark, "tick-store")
    t = v.tape(spark, sf).select(*sf_features.TICK_COLUMNS)
    for number in range(6):
        tables.write_batch(t.where(F.col("seq") % 6 == number), path, number)
        if number % 2:
            store.compact(spark, path, t.schema, number, keep_days=7)
    rows = store.stored(spark, path, t.schema)
    return rows.groupBy("day", "product_id").agg(
        F.count("*").alias("n"), F.sum("seq").alias("seqs"), F.countDistinct("batch").alias("batches")
    )


@query(
    "stream_labels",
    f"""WITH {q.LABELS}, newest AS (SELECT max(us) AS us FROM tape)
    SELECT l.product_id, l.us, l.seq, CAST(volatility_spike AS DOUBLE) AS volatility_spike FROM labeled AS l CROSS JOIN newest AS n
    WHERE l.us < n.us - 3600000000""",
)
def stream_labels(spark, sf):
    base = scratch_path(spark, "stream-labels")
    vol = materialize(
        forward_volatility(v.tape(spark, sf), v.HORIZON, v.GAP).select("future_volatility")
    )
    each = sf_features.label_batch(
        f"{base}/rows", f"{base}/labels", f"{base}/progress", volatility_threshold(vol),
        v.HORIZON, v.GAP,
    )
    flow = sf_features.start(tick_stream(spark, sf), each, f"{base}/checkpoint", available_now=True)
    flow.awaitTermination()
    return spark.read.parquet(f"{base}/labels").selectExpr(*KEY, SPIKE)


@query("stream_score", None)
def stream_score(spark, sf):
    base = scratch_path(spark, "stream-score")
    table = materialize(features(spark, sf))
    table.write.parquet(f"{base}/features")
    stream = spark.readStream.schema(table.schema).parquet(f"{base}/features")
    scored = flows.score_stream(stream, {"baseline": baseline_scorer(fit_baseline(table))}, threshold=0.7)
    flow = (
        scored.select(*KEY, "score", "prediction")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{base}/scores")
    )
    flow.awaitTermination()
    return spark.read.parquet(f"{base}/scores")


@query(
    "stream_counters",
    f"""WITH {q.TAPE}, w AS (
      SELECT us // 3600000000 * 3600000000 AS window_us, product_id, count(*) AS n FROM tape GROUP BY 1, 2
    ), newest AS (SELECT max(us) AS us FROM tape)
    SELECT window_us, product_id, w.n FROM w CROSS JOIN newest
    WHERE window_us + 3600000000 <= newest.us - 60000000""",
)
def stream_counters(spark, sf):
    """Windows that the watermark has closed."""
    base = scratch_path(spark, "stream-counters")
    ticks = tick_stream(spark, sf).withColumn("ts", F.timestamp_micros("us"))
    flow = (
        flows.counters(ticks, "product_id", length="1 hour")
        .writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{base}/counts")
    )
    flow.awaitTermination()
    start = F.unix_micros("window.start").alias("window_us")
    return spark.read.parquet(f"{base}/counts").select(start, "product_id", "n")


@query(
    "stream_sessions",
    f"""WITH {q.CHUNKS}, newest AS (SELECT max(us) AS us FROM tape), s AS (
      SELECT product_id, count(*) AS n, min(us) AS first_us, max(us) AS last_us FROM chunks GROUP BY product_id, chunk_id)
    SELECT product_id, n, first_us, last_us FROM s CROSS JOIN newest
    WHERE last_us + {v.GAP * 1_000_000} < newest.us - 864000000000""",
)
def stream_sessions(spark, sf):
    """Sessions of a stream of four files; one row of five comes a file later than its time."""
    base = scratch_path(spark, "stream-sessions")
    t = v.tape(spark, sf).select("product_id", "us", "seq", "k")
    span = t.agg(F.min("us").alias("_from"), F.max("us").alias("_to"))
    quarter = F.floor((F.col("us") - F.col("_from")) * 4 / (F.col("_to") - F.col("_from") + 1))
    late = F.when(F.col("k") % 5 == 0, 1).otherwise(0)
    parts = materialize(
        t.crossJoin(F.broadcast(span)).withColumn("file", F.least(quarter + late, F.lit(3)).cast("int"))
    )
    for number in range(4):
        rows = parts.where(F.col("file") == number).select("product_id", "us")
        rows.coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = (
        spark.readStream.schema("product_id string, us bigint").option("maxFilesPerTrigger", 1)
        .parquet(f"{base}/in").withColumn("ts", F.timestamp_micros("us"))
    )
    flow = (
        sessions.sessions(stream, v.GAP, delay="10 days")
        .writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True).start(f"{base}/sessions")
    )
    flow.awaitTermination()
    return spark.read.parquet(f"{base}/sessions")


@query(
    "merge_sessions",
    f"""WITH {q.CHUNKS} SELECT product_id, count(*) AS n, min(us) AS first_us, max(us) AS last_us
    FROM chunks GROUP BY product_id, chunk_id""",
)
def merge_sessions(spark, sf):
    """Sessions of the rows in time, with a seventh of all rows put to them later."""
    t, late = v.tape(spark, sf), F.col("k") % 7 == 0
    first = stats.session_summary(t.where(~late), v.GAP)
    parts = first.unionByName(sessions.as_sessions(t.where(late)))
    return sessions.merge_sessions(parts, v.GAP)


@query(
    "stream_progress",
    f"WITH {q.TAPE} SELECT count(*) AS n, 1 AS batches, 0 AS known_lags FROM tape",
)
def stream_progress(spark, sf):
    """What the progress table says of a query over the events."""
    base = scratch_path(spark, "stream-progress")
    listener = progress.ProgressTable(spark, f"{base}/progress")
    flow = (
        tick_stream(spark, sf).writeStream.format("noop").queryName("ticks")
        .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    )
    flow.awaitTermination()
    # The reports of a finished query stay with it; a listener gets the same ones as they come.
    listener.waiting = [json.loads(p.json) if hasattr(p, "json") else p for p in flow.recentProgress]
    listener.flush()
    table = spark.read.parquet(f"{base}/progress")
    return table.where("rows > 0").agg(
        F.sum("rows").alias("n"), F.countDistinct("batch").cast("int").alias("batches"),
        F.count("lag").cast("int").alias("known_lags"),
    )
