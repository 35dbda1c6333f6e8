import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.streaming import progress, sessions

SECOND = 1_000_000


def brute(points, gap):
    out = []
    for us in sorted(points):
        if out and us - out[-1][1] <= gap * SECOND:
            out[-1] = [out[-1][0], us, out[-1][2] + 1]
        else:
            out.append([us, us, 1])
    return sorted(map(tuple, out))


def rows(df):
    return sorted((r.product_id, r.first_us, r.last_us, r.n) for r in df.collect())


@pytest.mark.parametrize("limit", [7, 100_000])
def test_merge_equals_sessions_of_all_rows(spark, small_ranges, limit):
    small_ranges(limit)
    rng = np.random.default_rng(2)
    data = [(p, int(u) * SECOND // 2) for p in "AB" for u in rng.integers(0, 4_000, 150)]
    data += data[:20] + [("A", None)]
    df = spark.createDataFrame(data, "product_id string, us bigint")
    late = F.xxhash64("us") % 3 == 0
    first = sessions.merge_sessions(sessions.as_sessions(df.where(~late)), 10)
    both = first.unionByName(sessions.as_sessions(df.where(late)))
    want = sorted((p, *s) for p in "AB" for s in brute([u for q, u in data if q == p and u is not None], 10))
    assert rows(sessions.merge_sessions(both, 10)) == want
    assert sessions.merge_sessions(both.limit(0), 10).count() == 0


def test_long_stretch_covers_later_ones(spark):
    parts = [("A", 3, 0, 100 * SECOND), ("A", 1, 5 * SECOND, 6 * SECOND), ("A", 2, 105 * SECOND, 107 * SECOND), ("A", 1, 118 * SECOND, 118 * SECOND)]
    df = spark.createDataFrame(parts, "product_id string, n bigint, first_us bigint, last_us bigint")
    assert rows(sessions.merge_sessions(df, 10)) == [("A", 0, 107 * SECOND, 6), ("A", 118 * SECOND, 118 * SECOND, 1)]


def test_stream_of_files(spark, tmp_path):
    """A gap of exactly the limit connects; a late row joins two sessions that are still open."""
    files = [[0, 10, 25, 100], [17, 36, None, 200], [400], [900]]
    folder = str(tmp_path / "in")
    for times in files:
        part = [("A", None if t is None else t * SECOND) for t in times]
        spark.createDataFrame(part, "product_id string, us bigint").coalesce(1).write.mode("append").parquet(folder)
    stream = (
        spark.readStream.schema("product_id string, us bigint").option("maxFilesPerTrigger", 1).parquet(folder)
        .withColumn("ts", F.timestamp_micros("us"))
    )
    flow = (
        sessions.sessions(stream, 10, delay="120 seconds").writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    flow.awaitTermination()
    got = rows(spark.read.parquet(str(tmp_path / "out")))
    assert got == [("A", 0, 25 * SECOND, 4), ("A", 36 * SECOND, 36 * SECOND, 1), *[("A", t * SECOND, t * SECOND, 1) for t in (100, 200, 400)]]


def report(batch, second, done, newest, name="q"):
    return {
        "id": "1", "runId": "r", "name": name, "batchId": batch,
        "timestamp": f"2024-01-31T10:{second // 60:02d}:{second % 60:02d}.000Z",
        "sources": [
            {"numInputRows": 5, "processedRowsPerSecond": 2.5, "endOffset": f'{{"t": {{"0": {done}}}}}',
             "latestOffset": f'{{"t": {{"0": {newest}, "1": 9}}}}'},
            {"numInputRows": 1, "endOffset": '{"logOffset": 3}', "latestOffset": None},
        ],
    }


def test_progress_table_and_lag_alerts(spark, tmp_path):
    path = str(tmp_path / "p")
    listener = progress.ProgressTable(spark, path, every=4)

    class Event:
        def __init__(self, value):
            import json

            self.progress = type("P", (), {"json": json.dumps(value)})

    for batch in range(10):
        listener.onQueryProgress(Event(report(batch, batch * 60, 100, 100 + (500 if 2 <= batch <= 7 else 3))))
    assert len(listener.waiting) == 2
    listener.onQueryTerminated(None)
    table = spark.read.parquet(path)
    assert table.count() == 30 and table.where("lag is null").count() == 10
    last = {r.partition: r.lag for r in progress.latest_lag(table).collect()}
    assert last == {0: 3, 1: 9}
    alerts = progress.lag_alerts(table, 100, hold_minutes=5).collect()
    assert [(r["query"], r.topic, r.steps, r.last_us - r.first_us) for r in alerts] == [("q", "t", 6, 300 * SECOND)]
    assert progress.lag_alerts(table, 1000).count() == 0
    progress.write_progress(spark, [], str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
