"""Benchmark decontamination by winnowing, in DataFrame functions only.

An item's windows are its runs of ``WINDOW`` words (a shorter item is one window). Of every
window the smallest hash of its k-grams is kept; a document that holds the window keeps the
same hash, so joining the fingerprints of both sides finds every shared window. Only the
documents with a common fingerprint are looked at again: their windows around the common
k-grams are joined with the items' windows word for word, and the hits are merged to spans.

Words: A-Z in lower case, split at ASCII characters other than letters and digits. NULL or
empty text has no words and no hit; an item without words has no window. Rows that repeat get
the same answer each; an item with a NULL id marks words but is not listed. Extra columns are
ignored. Nothing is broadcast but what Spark itself finds to be under its broadcast threshold.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh
from tidemark.session import materialize

WINDOW = 10
GRAM = 5
SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text; NULL gives an empty array."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(low, SPLIT), lambda w: w != "")


def _grams(hashes: str, size: str, k: int) -> str:
    """SQL of the hashes of all k-grams, given the array of word hashes and its length."""
    parts = ", ".join(f"element_at({hashes}, i + {j})" for j in range(k))
    return f"transform(if({size} >= {k}, sequence(1, {size} - {k - 1}), array()), i -> xxhash64({parts}))"


def _with_grams(df: DataFrame, lengths: list[int]) -> DataFrame:
    """``w`` to its length ``n`` and the k-gram hashes ``g<k>`` that the window lengths need."""
    df = df.withColumn("wh", F.expr("transform(w, x -> xxhash64(x))")).withColumn("n", F.size("w"))
    return df.withColumns({f"g{k}": F.expr(_grams("wh", "n", k)) for k in {min(GRAM, x) for x in lengths}})


def _winnow(length: int) -> str:
    """SQL of the distinct minima over the windows of ``length`` words, marked by the length."""
    k = min(GRAM, length)
    w = length - k + 1
    grams = f"g{k}"
    if w > 1:
        grams = f"transform(if(n >= {length}, sequence(1, n - {length - 1}), array()), i -> array_min(slice({grams}, i, {w})))"
    return f"transform(array_distinct({grams}), x -> struct({length} as length, x as fp))"


def _fingerprints(df: DataFrame, lengths: list[int], keys: list[str]) -> DataFrame:
    arrays = [_winnow(x) for x in lengths]
    all_ = f"concat({', '.join(arrays)})" if len(arrays) > 1 else arrays[0]
    return _with_grams(df, lengths).select(*keys, F.expr(f"inline({all_})"))


def _window_text(at: str, length: str) -> str:
    return f"array_join(slice(w, {at}, {length}), ' ')"


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Hits per distinct (doc_id, text): doc_id, h, spans, items.

    ``spans`` are the sorted (start, length) of the windows that occur, from 1; ``items`` the
    sorted ids of their items as strings.
    """
    own = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w"))
    own = materialize(own.where(F.size("w") > 0).withColumn("n", F.size("w")))
    # At most ``window`` different lengths, whatever the number of items.
    lengths = sorted(r[0] for r in own.select(F.least("n", F.lit(window))).distinct().collect())
    lengths = lengths or [window]
    marks = materialize(
        _fingerprints(own.withColumn("l", F.least("n", F.lit(window))), lengths, ["l"])
        .where("l = length").select("length", "fp").distinct()
    )
    windows = materialize(
        own.select("item_id", "w", F.least("n", F.lit(window)).alias("length"), F.expr(f"explode(sequence(1, greatest(n - {window - 1}, 1))) as at"))
        .select("item_id", "length", F.expr(_window_text("at", "length")).alias("words"))
        .distinct()
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), words(F.col("text")).alias("w"))
    found = (
        _fingerprints(rows, lengths, ["doc_id", "h"])
        .join(marks, ["length", "fp"])
        .groupBy("doc_id", "h")
        .agg(F.collect_set(F.struct("length", "fp")).alias("marks"))
        .select(F.col("doc_id").alias("id_"), F.col("h").alias("h_"), "marks")
    )
    near = rows.join(found, F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("h") == F.col("h_")), "inner")
    near = _with_grams(near, lengths)
    spots = []
    for length in lengths:
        k = min(GRAM, length)
        fps = f"transform(filter(marks, m -> m.length = {length}), m -> m.fp)"
        starts = f"if(n >= {length} and size(f{length}) > 0, sequence(1, n - {length - 1}), array())"
        near = near.withColumn(f"f{length}", F.expr(fps))
        spots.append(
            f"transform(filter({starts}, i -> arrays_overlap(slice(g{k}, i, {length - k + 1}), f{length})), "
            f"i -> struct(i as start, {length} as length, {_window_text('i', str(length))} as words))"
        )
    all_ = f"concat({', '.join(spots)})" if len(spots) > 1 else spots[0]
    hits = near.select("doc_id", "h", F.expr(f"inline({all_})")).join(windows, ["length", "words"])
    return hits.groupBy("doc_id", "h").agg(
        F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"),
        F.array_sort(F.collect_set("item_id")).alias("items"),
    )


def covered(spans: str = "spans") -> Column:
    """Number of positions in the union of sorted (start, length) spans."""
    return F.expr(
        f"aggregate({spans}, struct(0L as n, 0L as end), (a, s) -> struct("
        "a.n + greatest(0L, s.start + s.length - greatest(a.end, cast(s.start as bigint))) as n, "
        "greatest(a.end, cast(s.start + s.length as bigint)) as end), a -> a.n)"
    )


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row."""
    hits = find(docs, items).select(
        F.col("doc_id").alias("id_"), F.col("h").alias("h_"), covered().alias("hit"),
        F.size("items").cast("long").alias("listed"), F.array_join("items", ",").alias("ids"),
    )
    rows = docs.select(
        "doc_id", F.xxhash64("text").alias("h"), F.size(words(F.col("text"))).cast("long").alias("n_words")
    )
    on = F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("h") == F.col("h_"))
    return rows.join(hits, on, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("listed", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")).cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a hit, all columns unchanged."""
    id_, h = fresh(docs, "hit_id", "hit_text")
    hits = find(docs, items).select(F.col("doc_id").alias(id_), F.col("h").alias(h))
    on = docs["doc_id"].eqNullSafe(hits[id_]) & (F.xxhash64(docs["text"]) == hits[h])
    return docs.join(hits, on, "left_anti")
