"""Language identification by prediction by partial matching over bytes.

For each language a tree of byte contexts of up to ``ORDER`` bytes is counted on a bounded
sample and then frozen. A byte's code length comes from the longest context that has been seen;
where that context has not seen the byte, an escape (its number of distinct bytes against that
plus its count) leads to the next shorter one, down to 1/256. Texts are coded as lower-case words of
letters between spaces, and a context never reaches back past its word, so a word's exact code
length is worked out once per task. The language of the shortest code wins.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, fold
from tidemark.llm.quality import stretch

ORDER = 4
LANGUAGES = 500
SAMPLE_ROWS = 1_000  # rows of each language that are counted
SAMPLE_CHARS = 1_500_000  # and their characters
CACHE = 200_000
_LETTERS = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> Counter:
    """Runs of letters with their counts. Digits of other kinds ("²", "Ⅷ") are word characters to the
    pattern but no letters, so the few words that hold them are split there."""
    found = Counter(_LETTERS.findall((text or "").lower()))
    for word in [w for w in found if not w.isalpha()]:
        n = found.pop(word)
        for part in "".join(c if c.isalpha() else " " for c in word).split():
            found[part] += n
    return found


class Tree:
    """Counts of the bytes after each context of one language."""

    def __init__(self, counts: Counter):
        follow: dict[bytes, Counter] = defaultdict(Counter)
        for word, n in counts.items():
            raw = b" " + word.encode() + b" "
            for i in range(1, len(raw)):
                for k in range(min(ORDER, i) + 1):
                    follow[raw[i - k : i]][raw[i]] += n
        # Per context: the cost in bits of each seen byte, and of the escape.
        self.bits: dict[bytes, tuple[dict[int, float], float]] = {}
        for context, seen in follow.items():
            total = seen.total() + len(seen)
            self.bits[context] = (
                {s: -math.log2(c / total) for s, c in seen.items()},
                -math.log2(len(seen) / total),
            )

    def cost(self, context: bytes, symbol: int) -> float:
        bits = 0.0
        for k in range(len(context) + 1):
            node = self.bits.get(context[k:])
            if node is not None:
                found = node[0].get(symbol)
                if found is not None:
                    return bits + found
                bits += node[1]
        return bits + 8.0


class Model:
    def __init__(self, counts: dict[str, Counter]):
        self.names = sorted(counts)
        self.trees = [Tree(counts[n]) for n in self.names]
        self.steps: dict[bytes, tuple[float, ...]] = {}
        self.cache: dict[str, tuple[float, ...]] = {}

    def lengths(self, word: str) -> tuple[float, ...]:
        """Bits of a word and its closing space, for each language."""
        raw = b" " + word.encode("utf-8", "replace") + b" "
        rows = []
        for i in range(1, len(raw)):
            key = raw[max(0, i - ORDER) : i + 1]
            step = self.steps.get(key)
            if step is None:
                if len(self.steps) >= 4 * CACHE:
                    self.steps.clear()
                step = self.steps[key] = tuple(t.cost(key[:-1], key[-1]) for t in self.trees)
            rows.append(step)
        return tuple(map(math.fsum, zip(*rows, strict=True)))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its share of the likelihood; ('und', 0) without a letter."""
        counts = words(text)
        if not counts or not self.names:
            return "und", 0.0
        total, cache = [0.0] * len(self.names), self.cache
        for word, n in counts.items():
            bits = cache.get(word)
            if bits is None:
                if len(cache) >= CACHE:
                    cache.clear()
                bits = cache[word] = self.lengths(word)
            for i, b in enumerate(bits):
                total[i] += n * b
        least = min(total)
        share = 1 / sum(2.0 ** max(-1000.0, least - t) for t in total)
        return self.names[total.index(least)], share


def _shares(spark: SparkSession, sizes: dict[str, int], chars: int) -> DataFrame:
    """lang, share: characters that each picked row of a language may give."""
    rows = [(lang, max(1, chars // min(SAMPLE_ROWS, n))) for lang, n in sizes.items()]
    return spark.createDataFrame(rows, "lang string, share int")


def fit(docs: DataFrame, mod: int = 4, held: int = 2, chars: int = SAMPLE_CHARS) -> Model:
    """Count the trees on rows with text and language outside the held-out fold.

    Learned are the ``LANGUAGES`` languages with the most rows. Of each, at most ``SAMPLE_ROWS`` rows come
    first, by a hash of their id, and of a text longer than its even share of ``chars`` a stretch
    is counted: a language of a few very long texts keeps them all.
    """
    rows = docs.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", mod) != held)
    ).select("doc_id", "lang", "text")
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    sizes = {r[0]: r[1] for r in sizes.collect()}
    part = _shares(rows.sparkSession, sizes, chars)
    rows = rows.join(F.broadcast(part), "lang")
    text = stretch(F.col("text"), F.col("share"), F.col("doc_id"), F.col("text"))
    rows = rows.select("lang", F.xxhash64("doc_id").alias("at"), "doc_id", text.alias("text"))
    first = Window.partitionBy("lang").orderBy("at", "doc_id", "text")
    picked = rows.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= SAMPLE_ROWS)
    counts: dict[str, Counter] = {lang: Counter() for lang in sorted(sizes)}
    for row in picked.select("lang", "text").collect():
        counts[row[0]].update(words(row[1]))
    return Model(counts)


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, in one map over whole texts.

    NULL text or text without a letter gives 'und' and 0; equal code lengths go to the
    name that sorts first; NULL ids are not held out.
    """
    model = model or fit(docs)

    def run(batch: pa.RecordBatch):
        found = [model.predict(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
            names=["doc_id", "lang_pred", "score"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = arrow_map(docs.select("doc_id", "text"), f"doc_id {kind}, lang_pred string, score double", run)
    held = F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return out.select("doc_id", held, "lang_pred", "score")
