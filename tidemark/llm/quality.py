"""Quality classifier over supervised subword embeddings.

A document is the mean of learned vectors: one for each of its words, for each character
n-gram of a word (with its ends marked) and for each word that repeats the one before it. The
vectors sit in a hashed table; a softmax over the mean gives the class. Table and output are
trained together by stochastic gradient descent in numpy, on a bounded sample of the labelled
rows. The margin is linear in the vectors, so each distinct word's share of it is worked out once
per task and the texts are scored whole by adding shares.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, fold

BUCKETS = 1 << 17
WIDTH = 12
GRAMS = (2, 3, 4)
SAMPLE_ROWS = 3_000  # labelled rows that are trained on, at most
SAMPLE_CHARS = 12_000_000  # and their characters
EPOCHS = 6
RATE = 0.4
CACHE = 300_000
REPEAT = "\x00same"


def features(word: str) -> list[int]:
    """Buckets of a word: itself and its character n-grams."""
    if word is REPEAT:
        return [zlib.crc32(REPEAT.encode()) % BUCKETS]
    marked = f"<{word}>"
    grams = [marked, *(marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1))]
    return [zlib.crc32(g.encode("utf-8", "replace")) % BUCKETS for g in grams]


def words(text: str | None) -> Counter:
    """Counts of the white-space words, and of those that repeat their predecessor."""
    found = (text or "").split()
    counts = Counter(found)
    same = sum(map(str.__eq__, found, found[1:]))
    if same:
        counts[REPEAT] = same
    return counts


class Model:
    def __init__(self, vectors: np.ndarray, output: np.ndarray, bias: np.ndarray):
        self.share = (vectors @ (output[1] - output[0])).astype("float32")
        self.bias = float(bias[1] - bias[0])
        self.cache: dict[str, tuple[float, int]] = {}

    def score(self, text: str | None) -> float:
        """Probability of class 1; an empty or NULL text has the bias only."""
        total, n, cache = 0.0, 0, self.cache
        for word, count in words(text).items():
            known = cache.get(word)
            if known is None:
                if len(cache) >= CACHE:
                    cache.clear()
                at = features(word)
                known = cache[word] = (float(self.share[at].sum()), len(at))
            total += count * known[0]
            n += count * known[1]
        margin = self.bias + (total / n if n else 0.0)
        return float(1 / (1 + np.exp(-np.clip(margin, -60, 60))))


def train(texts: list[str | None], labels: list[int], seed: int = 0) -> Model:
    """Gradient descent over the rows, one document a step. No rows give even odds."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype("float32")
    output, bias = np.zeros((2, WIDTH), "float32"), np.zeros(2, "float32")
    known: dict[str, bytes] = {}
    rows = []
    for text in texts:
        counts = words(text)
        for word in counts.keys() - known.keys():
            known[word] = array("i", features(word)).tobytes()
        parts = [known[word] for word in counts]
        times = np.repeat(list(counts.values()), [len(x) // 4 for x in parts]) if parts else []
        ids, at = np.unique(np.frombuffer(b"".join(parts), "int32"), return_inverse=True)
        weights = np.bincount(at, times, len(ids)).astype("float32")
        rows.append((ids, weights / max(1.0, weights.sum())))
    known.clear()
    steps, total = 0, max(1, EPOCHS * len(rows))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            ids, weights = rows[i]
            rate = RATE * (1 - steps / total)
            steps += 1
            mean = weights @ vectors[ids]
            z = output @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = output.T @ p
            output -= rate * np.outer(p, mean)
            bias -= rate * 0.1 * p
            # A document's step is spread over its features; rare ones move as common ones do.
            vectors[ids] -= (rate * len(ids) ** 0.5) * np.outer(weights, back)
    return Model(vectors, output, bias)


def stretch(text: Column, length: Column, *place: Column) -> Column:
    """At most ``length`` characters of ``text``, from a place that a hash of ``place`` picks."""
    start = F.pmod(F.xxhash64(*place), F.greatest(F.lit(1), F.length(text) - length + 1).cast("long"))
    return F.substring(text, (start + 1).cast("int"), length.cast("int"))


def sample(docs: DataFrame, known: DataFrame, limit: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> list:
    """(doc_id, text, label) of at most ``limit`` labelled rows and ``chars`` characters.

    ``known`` has doc_id and label. The rows come first, by a hash of their id: at most ``limit`` ids are
    picked, so they are broadcast and no text is shuffled. Of a text longer than its even share of
    ``chars`` a stretch is taken, so a very long one costs no other its place.
    """
    by = F.xxhash64("doc_id")
    picked = known.orderBy(by, "doc_id", "label").limit(limit)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    share = F.lit(max(1, chars // max(1, min(limit, picked.count()))))
    part = stretch(F.coalesce("text", F.lit("")), share, F.col("doc_id"), F.col("text"))
    rows = rows.select("doc_id", part.alias("text"), "label").orderBy(by, "doc_id", "text", "label").limit(limit)
    found = [(r[0], r[1], r[2]) for r in rows.collect()]
    return sorted(found, key=lambda r: (str(r[0]), r[1], r[2]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", mod: int = 5, held: int = 0) -> Model:
    """Train on the labelled rows outside the held-out fold. NULL labels and ids teach nothing.

    At most ``SAMPLE_ROWS`` documents reach the driver. A document that is labelled twice
    counts twice.
    """
    known = labels.where(F.col(label).isin(0, 1) & (fold("doc_id", mod) != held)).select(
        "doc_id", F.col(label).cast("int").alias("label")
    )
    rows = sample(docs, known)
    return train([r[1] for r in rows], [r[2] for r in rows])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row, in one map over whole texts."""

    def run(batch: pa.RecordBatch):
        scores = [model.score(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"]
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), f"doc_id {kind}, score double", run)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; NULL ids are not held out."""
    scored = score(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns unchanged."""
    at, schema = docs.columns.index("text"), docs.schema

    def run(batch: pa.RecordBatch):
        yield batch.filter(
            pa.array([model.score(t) >= threshold for t in batch.column(at).to_pylist()], pa.bool_())
        )

    return docs.mapInArrow(lambda batches: (x for b in batches for x in run(b)), schema)
