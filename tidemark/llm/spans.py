"""Removal of repeated long spans through a compacted de Bruijn graph.

An edge is a window of ``WINDOW`` words, leading from its first words to its last. Windows that can
repeat are found first: of each window the least hash of its 6-grams is kept (winnowing), and only
windows with a 6-gram that two documents kept become edges. Edges that occur in one document only
are dropped. An edge runs on into the next one without branching if every occurrence of it is
followed by that one and by nothing else, and that one occurs nowhere else. Such runs are compacted:
their edges sit at consecutive places of the first document that holds them, so each edge is
compared with its neighbour in those source coordinates. Every document that enters a compacted path walks
the whole of it, so joining the occurrences with the paths' first edges gives all repeated spans as
(document, start, length, source document, source start). Spans whose source is an earlier document
are cut.

Hashes have 64 bits. Everything is one plan: the exchange of the 6-grams, of the edges and of the
texts is each made once and read twice. A document's own windows are all that is ever gathered.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh
from tidemark.llm.shingles import WordHashes, runs

WINDOW = 13
GRAM = 6


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _minima(grams: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width``."""
    out, have = grams, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _minimum(hashes: np.ndarray, window: int, gram: int) -> np.ndarray:
    """The least gram hash of each window."""
    if len(hashes) < window:
        return np.zeros(0, "uint64")
    return _minima(runs(hashes, gram), window - gram + 1)


def _marks(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """fp, doc_id, th: the winnowed grams of each text."""
    known = WordHashes()

    def run(batches):
        for batch in batches:
            for begin in range(0, len(batch), 256):
                part = batch.slice(begin, 256)
                found = [np.unique(_minimum(known.of(_words(t.as_py())), window, gram)) for t in part.column(2)]
                rows = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view("int64")), part.column(0).take(rows), part.column(1).take(rows)],
                    names=["fp", "doc_id", "th"],
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"fp long, doc_id {kind}, th long")


def _edges(marked: DataFrame, window: int, gram: int) -> DataFrame:
    """h, doc_id, at: windows whose least gram is marked. ``at`` is the place, after th << 32."""
    known = WordHashes()

    def run(batches):
        for batch in batches:
            for begin in range(0, len(batch), 64):
                part = batch.slice(begin, 64)
                out, places = [], []
                for text, th, marks in zip(*(part.column(c) for c in ("text", "th", "fps")), strict=True):
                    hashes = known.of(_words(text.as_py()))
                    wanted = marks.values.to_numpy(zero_copy_only=False).view("uint64")
                    at = np.flatnonzero(np.isin(_minimum(hashes, window, gram), wanted))
                    out.append(runs(hashes, window)[at].view("int64"))
                    places.append(at + (th.as_py() << 32))
                rows = pa.array(np.repeat(np.arange(len(out)), [len(x) for x in out]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out)), part.column("doc_id").take(rows), pa.array(np.concatenate(places))],
                    names=["h", "doc_id", "at"],
                )

    kind = marked.schema["doc_id"].dataType.simpleString()
    return marked.mapInArrow(run, f"h long, doc_id {kind}, at long")


def texts_of(docs: DataFrame, *others: str) -> DataFrame:
    """doc_id, th (31 bits of the text's hash, which tell rows of one id apart), text, and others."""
    th = F.pmod(F.xxhash64("text"), F.lit(1 << 31)).alias("th")
    rest = F.struct(*[F.col(f"`{c}`") for c in others]).alias("rest") if others else None
    rows = docs.where("doc_id is not null").select("doc_id", th, "text", *([rest] if others else []))
    return rows.where("th is not null")


def repeated(texts: DataFrame, window: int = WINDOW, gram: int = GRAM, sources: bool = True) -> DataFrame:
    """doc_id, th, spans of the ``texts`` that hold spans which start in an earlier document too.

    A span is (at, n, source, source_at): place, windows, and source coordinates, counted in words
    from 0. Paths are found by comparing, for neighbours in the source, the sets of all places of
    both edges: they must be the same, one word apart. A set is held as the sum of its places'
    hashes (32 bits, as only neighbours in one source are compared). Without ``sources`` a span is
    (at, n) only.
    """
    # Both readers of an exchange ask for the same columns, not null, so that it is made once.
    marks = _marks(texts, window, gram).where("fp is not null and doc_id is not null and th is not null").repartition("fp")
    ends = F.struct("doc_id", "th")
    twice = marks.groupBy("fp").agg(F.min(ends).alias("lo"), F.max(ends).alias("hi")).where("lo.doc_id < hi.doc_id").select("fp")
    of = marks.join(twice.hint("shuffle_hash"), "fp").groupBy("doc_id", "th").agg(F.collect_list("fp").alias("fps"))
    edges = _edges(texts.join(of, ["doc_id", "th"]), window, gram)
    edges = edges.where("h is not null and doc_id is not null and shiftright(at, 32) is not null").repartition("h")
    low = F.lit((1 << 32) - 1)

    def together(at):
        return F.sum(F.xxhash64("doc_id", at).bitwiseAND(low)).bitwiseAND(low)

    graph = (
        edges.groupBy("h")
        .agg(
            F.max("doc_id").alias("hi"), F.min(F.struct("doc_id", "at")).alias("first"),
            F.shiftleft(together(F.col("at")), 32).bitwiseOR(together(F.col("at") + 1)).alias("places"),
        )
        .where("first.doc_id < hi")
        .select("h", F.col("first.doc_id").alias("source"), F.col("first.at").alias("source_at"), "places")
    )
    along = Window.partitionBy("source").orderBy("source_at")
    runs_on = (
        (F.lag("source_at").over(along) == F.col("source_at") - 1)
        & (F.lag("places").over(along).bitwiseAND(low) == F.shiftrightunsigned("places", 32))
    )
    paths = (
        graph.withColumn("path", F.coalesce((~runs_on).cast("int"), F.lit(1)))
        .withColumn("path", F.sum("path").over(along))
        .groupBy("source", "path")
        .agg(F.min(F.struct("source_at", "h")).alias("head"), F.count("*").alias("n"))
        .select("source", "n", F.col("head.source_at").alias("source_at"), F.col("head.h").alias("h"))
    )
    found = edges.join(paths.hint("shuffle_hash"), "h").where("source < doc_id")
    span = [F.col("at").bitwiseAND(low).alias("at"), F.col("n")]
    if sources:
        span += [F.col("source"), F.col("source_at").bitwiseAND(low).alias("source_at")]
    return found.groupBy("doc_id", F.shiftright("at", 32).alias("th")).agg(F.collect_list(F.struct(*span)).alias("spans"))


def _cut(text: str | None, spans: list | None, window: int) -> tuple[int, list[bytes]]:
    words = _words(text)
    gone = np.zeros(len(words) + 1, "int64")
    for span in spans or ():
        gone[span["at"]] += 1
        gone[min(len(words), span["at"] + span["n"] + window - 1)] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    return len(words), [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def removal(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row.

    NULL or empty text has no words. Only a smaller doc_id counts: rows that share an id do not cut
    each other, and a row with a NULL id neither cuts nor is cut. Extra columns are ignored.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                n, kept = _cut(text.as_py(), spans.as_py(), window)
                rows.append((n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string())))],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string"
    texts = texts_of(docs)
    spans = repeated(texts, window, gram, sources=False)
    rows = texts.join(spans, ["doc_id", "th"], "left").select("doc_id", "text", "spans")
    alone = docs.where("doc_id is null").select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    return rows.mapInArrow(run, schema).unionByName(alone.mapInArrow(run, schema))


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeated words cut from the text, all other columns unchanged.

    A text without repeats stays as it is; in others the kept words are joined by one space.
    """
    names = docs.columns
    others = [c for c in names if c not in ("doc_id", "text")]
    texts = texts_of(docs, *others)
    (cut,) = fresh(docs, "cut_spans")
    joined = texts.join(repeated(texts, window, gram, sources=False).withColumnRenamed("spans", cut), ["doc_id", "th"], "left")
    own = [F.col(c) if c in ("doc_id", "text") else F.col(f"rest.`{c}`") for c in names]
    at = names.index("text")

    def run(batches):
        for batch in batches:
            column = [
                b" ".join(_cut(t.as_py(), s.as_py(), window)[1]).decode("utf-8", "surrogatepass") if s.is_valid else t.as_py()
                for t, s in zip(batch.column(at), batch.column(len(names)), strict=True)
            ]
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(column, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    alone = docs.where("doc_id is null")
    return joined.select(*own, cut).mapInArrow(run, docs.schema).unionByName(alone)
