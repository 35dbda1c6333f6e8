"""Compaction and retention of batch-numbered tables."""

import os

import pytest
from helpers import TICKS, random_ticks

from pyspark.sql import functions as F
from tidemark.operators.features import tick_features
from tidemark.schema import MODEL_FEATURES
from tidemark.streaming import features as sf
from tidemark.streaming import store, tables

SCHEMA = "us bigint, x bigint"
TODAY = 20_000


def rows(spark, values):
    return spark.createDataFrame(values, SCHEMA)


def us(day, second=0):
    return day * tables.DAY + second * 1_000_000


def files(path):
    return sum(f.endswith(".parquet") for _, _, names in os.walk(path) for f in names)


def content(spark, path, **kw):
    df = store.stored(spark, path, rows(spark, []).schema, **kw)
    return sorted((r["x"], r["batch"]) for r in df.collect())


def test_files_stay_bounded(spark, tmp_path):
    """Three batches a day, some rows a day late: files do not grow with the number of batches."""
    path, schema, most, expected = str(tmp_path / "t"), rows(spark, []).schema, [], []
    for n in range(45):
        day = 100 + n // 3
        new = [(us(day, n), 2 * n), (us(day - n % 2, n), 2 * n + 1)]
        expected += [(d // tables.DAY, x, n) for d, x in new]
        if n and n % 5 == 0:
            store.compact(spark, path, schema, n - 1, keep_days=4, today=TODAY)
            most.append(files(path))
        tables.write_batch(rows(spark, new).coalesce(1), path, n)
    store.compact(spark, path, schema, 44, keep_days=4, today=TODAY)
    # Two generations of four days, the batches of two rounds with two days each, two manifests:
    # nothing of this depends on how many batches there were.
    assert max(most) <= 2 * 4 + 2 * 5 * 2 + 2
    newest = max(d for d, _, _ in expected)
    assert content(spark, path) == sorted((x, n) for d, x, n in expected if d > newest - 4)
    assert len([f for f in os.listdir(path + "/_manifest") if f.startswith("version=")]) == 2


def test_repeat_of_a_batch(spark, tmp_path):
    path, schema = str(tmp_path / "t"), rows(spark, []).schema
    for n in range(4):
        tables.write_batch(rows(spark, [(us(5, n), n)]), path, n)
    store.compact(spark, path, schema, 3)
    tables.write_batch(rows(spark, [(us(5, 9), 9)]), path, 4)
    for _ in range(2):  # batch 4 is repeated, with the compaction before it
        store.compact(spark, path, schema, 3)
        tables.write_batch(rows(spark, [(us(5, 9), 9)]), path, 4)
    assert content(spark, path) == [(0, 0), (1, 1), (2, 2), (3, 3), (9, 4)]
    before = tables.read_before(spark, path, schema, 4, [(us(5), us(6))])
    assert sorted(r["x"] for r in before.collect()) == [0, 1, 2, 3]
    assert [r["x"] for r in tables.read_before(spark, path, schema, 2, [(us(5), us(6))]).orderBy("x").collect()] == [0, 1]


@pytest.mark.parametrize("fails", ["_write_segments", "_commit", "_sweep"])
def test_failure_half_way(spark, tmp_path, monkeypatch, fails):
    path, schema = str(tmp_path / "t"), rows(spark, []).schema
    for n in range(6):
        tables.write_batch(rows(spark, [(us(5 + n % 2, n), n)]), path, n)
        if n == 2:
            store.compact(spark, path, schema, 2)
    whole = [(n, n) for n in range(6)]

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(store, fails, broken)
        with pytest.raises(OSError):
            store.compact(spark, path, schema, 5)
    assert content(spark, path) == whole
    # Segments without the mark of their manifest do not count, whatever is in the folder.
    os.makedirs(path + "/_manifest/version=77")
    assert content(spark, path) == whole
    assert store.compact(spark, path, schema, 5).upto == 5
    assert content(spark, path) == whole


def test_readers_of_the_old_manifest(spark, tmp_path):
    path, schema = str(tmp_path / "t"), rows(spark, []).schema
    for n in range(3):
        tables.write_batch(rows(spark, [(us(5, n), n)]), path, n)
    store.compact(spark, path, schema, 0)
    old = store.stored(spark, path, schema)
    store.compact(spark, path, schema, 2)
    assert sorted(r["x"] for r in old.collect()) == [0, 1, 2]


def test_odd_times(spark, tmp_path):
    """A row far ahead expires nothing, a row without a time stays, a row before the kept days goes."""
    path, schema = str(tmp_path / "t"), rows(spark, []).schema
    tables.write_batch(rows(spark, [(us(100), 1), (us(90_000), 2), (None, 3), (us(97), 4)]), path, 0)
    assert store.compact(spark, path, schema, 0, keep_days=2, today=TODAY).first_day == 99
    assert content(spark, path) == [(1, 0), (2, 0), (3, 0)]
    tables.write_batch(rows(spark, [(us(50), 5), (None, 6)]), path, 1)
    assert content(spark, path) == [(1, 0), (2, 0), (3, 0), (6, 1)]
    assert store.compact(spark, path, schema, 1, keep_days=60, today=TODAY).first_day == 99
    assert content(spark, path) == [(1, 0), (2, 0), (3, 0), (6, 1)]
    assert content(spark, path, days={100}) == [(1, 0)]
    empty = str(tmp_path / "empty")
    assert store.compact(spark, empty, schema, 3).segments == {} and content(spark, empty) == []


def test_large_days_have_several_files(spark, tmp_path):
    """A day is cut by time, and one time that holds most rows by a hash of its rows."""
    path, schema = str(tmp_path / "t"), rows(spark, []).schema
    tables.write_batch(rows(spark, [(us(5), n) for n in range(900)] + [(us(5, n), n) for n in range(100)]), path, 0)
    store.compact(spark, path, schema, 0, rows_per_file=100)
    sizes = spark.read.parquet(f"{path}/_segments/version=0").groupBy(F.input_file_name()).count()
    sizes = [r["count"] for r in sizes.collect()]
    assert len(sizes) >= 8 and max(sizes) < 300 and sum(sizes) == 1000


def test_stream_over_a_compacted_store(spark, tmp_path):
    ticks = sorted(random_ticks(180, 5, nulls=False), key=lambda r: r[1])
    ticks = [(r[0], r[1], i, *r[3:]) for i, r in enumerate(ticks)]
    base = str(tmp_path)
    each = sf.feature_batch(f"{base}/ticks", f"{base}/out", compact_every=2, keep_days=2)
    for n in range(6):
        each(spark.createDataFrame(ticks[30 * n : 30 * n + 30], TICKS), n)
    each(spark.createDataFrame(ticks[150:], TICKS), 5)
    got = {r["seq"]: r for r in spark.read.parquet(f"{base}/out").collect()}
    want = {r["seq"]: r for r in tick_features(spark.createDataFrame(ticks, TICKS)).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[s][c] - want[s][c]) < 1e-9 for s in want for c in MODEL_FEATURES)
    assert store.manifest(spark, f"{base}/ticks").upto == 3
    with pytest.raises(ValueError):
        sf.feature_batch(f"{base}/ticks", f"{base}/out", keep_days=1)


def test_progress_keeps_two_batches(spark, tmp_path):
    path = str(tmp_path / "p")
    for n in range(5):
        assert tables.newest_event(spark, path, n, n * 10) == (None if n == 0 else n * 10 - 10, n * 10)
    assert sorted(os.listdir(path)) == ["batch=3", "batch=4"]
