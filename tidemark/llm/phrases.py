"""Phrases whose words go together, from a weighted de Bruijn graph per language.

Texts are cut into pieces at punctuation and line ends, pieces into words. The longest grams, of
three words, are edges between their overlapping word pairs. Each task counts the edges of a
stretch of words and derives the shorter counts from them: a pair occurs as often as flows out of
its node, plus the pieces that end with it; a word as often as flows out of the pairs it starts,
plus the pieces that end with it. Stretches are added up bucket by bucket. A bucket is a hash class
of edges, pairs or words, so neither a frequent word nor a frequent pair meets in one task, and the
number of buckets follows the number of characters, so that a bucket's size does not.

Edges and nodes that are frequent enough form the graph of candidates. Paths on which every inner
node has one edge in and one out are compacted by pointer doubling in Spark joins (cycles of such
nodes fall into single edges). A path's words, weights and node flows then give its candidates.

Words are known by 64-bit hashes. If two words of a language share one, or two frequent pairs a node
id, the work is done again with another seed. An edge is known by its node's id and the hash of
its last word, 128 bits.

NULL or empty text has no words; NULL lang is ``und``. Ids are not looked at, extra columns are ignored,
repeated rows count as often as they occur. A text is held whole by one task, its words are counted
in stretches. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

MIN_COUNT = 10
PERCENT = 50
TOP = 2000
STRETCH = 1_500_000  # words counted at a time; their ids take 21 bits each
BLOCK = 4096  # edges of a path that are held in one row
CHARS_PER_BUCKET = 8_000_000
ENDS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b"." * 9)
EDGE, NODE, WORD, TOTAL, CLASH = range(5)


class _Ids(dict):
    """Numbers the words of a stretch; 0 stands for the end of a piece."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _tokens(text: str | None) -> list[bytes]:
    """Words, and ``.`` after each piece."""
    low = (text or "").encode("utf-8", "replace").lower().translate(ENDS)
    return low.replace(b".", b" . ").split()


def mixed(first, second):
    """Node of two words: the first hash turned by 21 bits, xor the second."""
    if isinstance(first, Column):
        turned = F.shiftleft(first, 21).bitwiseOR(F.shiftrightunsigned(first, 43))
        return turned.bitwiseXOR(second)
    u = first.view("uint64")
    return ((u << np.uint64(21)) | (u >> np.uint64(43))).view("int64") ^ second


class Stretch:
    """Words of one language that a task has read and not yet counted."""

    def __init__(self):
        self.ids, self.parts, self.live = _Ids(), [], []

    def add(self, tokens: list[bytes], ahead: int) -> None:
        """The last ``ahead`` words are only looked at: they are counted with the next stretch."""
        n = len(tokens)
        self.parts += [np.fromiter(map(self.ids.__getitem__, tokens), "int64", n), np.zeros(1, "int64")]
        self.live += [np.arange(n + 1) < n - ahead]

    def counted(self, seed: int):
        """Edges (h1, h2, h3, n), nodes (h1, h2, n), words (h, n, bytes)."""
        t = np.concatenate([*self.parts, np.zeros(2, "int64")])
        words = list(self.ids)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed=seed) for w in words), "uint64", len(words)).view("int64")
        # The gram of up to three words at each place; a piece's last ones are shorter.
        a = np.where(np.concatenate(self.live), t[:-2], 0)
        b = np.where(a == 0, 0, t[1:-1])
        c = np.where(b == 0, 0, t[2:])
        grams, n = np.unique((a << 42) | (b << 21) | c, return_counts=True)
        grams, n = grams[grams > 0], n[grams > 0]
        # Flow out of a node and pieces that end with it; the same for words.
        pairs, flow = _added(grams >> 21, n)
        single, often = _added(pairs >> 21, flow)
        mask = (1 << 21) - 1
        long, two = (grams & mask) > 0, (pairs & mask) > 0
        grams, n, pairs, flow = grams[long], n[long], pairs[two], flow[two]
        edges = (hashes[grams >> 42], hashes[(grams >> 21) & mask], hashes[grams & mask], n)
        nodes = (hashes[pairs >> 21], hashes[pairs & mask], flow)
        return edges, nodes, (hashes[single], often, [words[i] for i in single])


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``n`` over equal neighbours of the sorted ``keys``."""
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.add.reduceat(n, starts) if len(n) else n


def _stretches(docs: DataFrame, seed: int, buckets: int) -> DataFrame:
    """Counts of each stretch: kind, lang, bucket, and arrays p, q, n, words."""

    def packed(kind: int, lang: str, p: np.ndarray, q: np.ndarray, n: np.ndarray, words: list[bytes]):
        if not len(p):
            return
        at = ((p ^ (q * 31)).view("uint64") >> np.uint64(20)) % np.uint64(buckets)
        order = np.argsort(at, kind="stable")
        first = np.flatnonzero(np.diff(at[order].astype("int64"), prepend=-1))
        ends = pa.array(np.append(first, len(order)), pa.int32())
        text = pa.array([words[i] for i in order] if words else [b""] * 0, pa.binary())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(first), kind, "int32")),
                pa.array([lang] * len(first), pa.string()),
                pa.array(at[order][first].astype("int64")),
                *(pa.ListArray.from_arrays(ends, pa.array(x[order].astype("int64"))) for x in (p, q, n)),
                pa.ListArray.from_arrays(ends if words else pa.array([0] * (len(first) + 1), pa.int32()), text),
            ],
            names=["kind", "lang", "bucket", "p", "q", "n", "words"],
        )

    def count(open_: dict[str, Stretch]):
        for lang, stretch in open_.items():
            (a, b, c, n), (first, second, flow), (h, often, words) = stretch.counted(seed)
            yield from packed(EDGE, lang, mixed(a, b), c, n, [])
            yield from packed(NODE, lang, first, second, flow, [])
            yield from packed(WORD, lang, h, h, often, words)

    def run(batches):
        open_: dict[str, Stretch] = {}
        size = 0
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                tokens = _tokens(text.as_py())
                for begin in range(0, len(tokens), STRETCH):
                    part = tokens[begin : begin + STRETCH + 2]
                    if size + len(part) > STRETCH:
                        yield from count(open_)
                        open_, size = {}, 0
                    open_.setdefault(lang.as_py(), Stretch()).add(part, max(0, len(part) - STRETCH))
                    size += len(part)
        yield from count(open_)

    rows = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    schema = "kind int, lang string, bucket long, p array<long>, q array<long>, n array<long>, words array<binary>"
    return rows.mapInArrow(run, schema)


def _sum_bucket(table: pa.Table, least: int) -> pa.Table:
    """Totals of one bucket that reach ``least``; of words also their overall total and clashes."""
    kind, lang = table.column("kind")[0].as_py(), table.column("lang")[0].as_py()
    flat = [table.column(c).combine_chunks().flatten() for c in ("p", "q", "n", "words")]
    p, q, n = (x.to_numpy(zero_copy_only=False) for x in flat[:3])
    order = np.lexsort((q, p))
    p, q, n = p[order], q[order], n[order]
    starts = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (q[1:] != q[:-1])])
    sums = np.add.reduceat(n, starts)
    keep = sums >= least
    rows = [np.full(keep.sum(), kind), p[starts][keep], q[starts][keep], sums[keep]]
    text = pa.nulls(int(keep.sum()), pa.binary())
    if kind == WORD:
        words = flat[3].take(pa.array(order))
        text = words.take(pa.array(starts[keep]))
        same = np.setdiff1d(np.arange(1, len(p)), starts)
        differ = pc.not_equal(words.take(pa.array(same)), words.take(pa.array(same - 1)))
        clash = int(pc.sum(differ).as_py() or 0)
        rows = [np.append(r, x) for r, x in zip(rows, ([TOTAL, CLASH], [0, 0], [0, 0], [n.sum(), clash]))]
        text = pa.concat_arrays([text, pa.nulls(2, pa.binary())])
    return pa.table(
        {
            "kind": pa.array(rows[0].astype("int32")), "lang": pa.array([lang] * len(rows[0]), pa.string()),
            **{c: pa.array(r.astype("int64")) for c, r in zip("pqn", rows[1:], strict=True)}, "word": text,
        }
    )


def _frequent(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Frequent edges (lang, v, h3, a), nodes (lang, h1, h2, f, v), words (lang, h, n, word); lang, n."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = 1 + chars // CHARS_PER_BUCKET
    seed = 0
    while True:
        found = materialize(
            _stretches(docs, seed, buckets)
            .groupBy("kind", "lang", "bucket")
            .applyInArrow(lambda t: _sum_bucket(t, least), "kind int, lang string, p long, q long, n long, word binary")
        )
        nodes = found.where(F.col("kind") == NODE).select("lang", F.col("p").alias("h1"), F.col("q").alias("h2"), F.col("n").alias("f"))
        nodes = nodes.withColumn("v", mixed(F.col("h1"), F.col("h2")))
        clash = found.where((F.col("kind") == CLASH) & (F.col("n") > 0)).select("lang")
        clash = clash.union(nodes.groupBy("lang", "v").count().where("count > 1").select("lang"))
        if clash.limit(1).count() == 0:
            break
        seed += 1
    edges = found.where(F.col("kind") == EDGE).select("lang", F.col("p").alias("v"), F.col("q").alias("h3"), F.col("n").alias("a"))
    words = found.where(F.col("kind") == WORD).select("lang", F.col("p").alias("h"), "n", F.col("word").cast("string").alias("word"))
    totals = found.where(F.col("kind") == TOTAL).groupBy("lang").agg(F.sum("n").alias("n"))
    return edges, nodes, words, totals


def compacted(edges: DataFrame) -> DataFrame:
    """Unary paths of ``edges`` (lang, h1, h2, h3 and others): lang, steps, the path's edges in order.

    Paths of more than ``BLOCK`` edges come in parts, each with the edge before it as its first step (its
    place is then one less than a multiple of ``BLOCK``).
    """
    out = edges.groupBy("lang", "h1", "h2").agg(F.count("*").alias("c"), F.min("h3").alias("h3")).where("c = 1")
    into = edges.groupBy("lang", "h2", "h3").agg(F.count("*").alias("c"), F.min("h1").alias("h0")).where("c = 1")
    into = into.select("lang", F.col("h2").alias("h1"), F.col("h3").alias("h2"), "h0")
    link = out.drop("c").join(into, ["lang", "h1", "h2"])  # at node (h1, h2): from (h0, h1, h2) to (h1, h2, h3)
    # Each edge points to the one before it (the first to itself), then twice as far each round.
    state = edges.select("lang", "h1", "h2", "h3").join(link, ["lang", "h1", "h2", "h3"], "left").select(
        "lang", "h1", "h2", "h3",
        F.coalesce("h0", "h1").alias("a1"), F.when(F.col("h0").isNull(), F.col("h2")).otherwise(F.col("h1")).alias("a2"),
        F.when(F.col("h0").isNull(), F.col("h3")).otherwise(F.col("h2")).alias("a3"),
        F.col("h0").isNotNull().cast("long").alias("d"), F.col("h0").isNull().alias("done"),
    )
    state, before = materialize(state), -1
    own = ["lang", "h1", "h2", "h3"]
    while (left := state.where("not done").count()) and left != before:
        before = left
        jump = state.select(
            "lang", F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("h3").alias("a3"),
            F.col("a1").alias("b1"), F.col("a2").alias("b2"), F.col("a3").alias("b3"), F.col("d").alias("e"), F.col("done").alias("ended"),
        )
        moved = state.where("not done").drop("done").join(jump, ["lang", "a1", "a2", "a3"])
        moved = moved.select(
            *own, F.col("b1").alias("a1"), F.col("b2").alias("a2"), F.col("b3").alias("a3"),
            (F.col("d") + F.col("e")).alias("d"), F.col("ended").alias("done"),
        )
        state = materialize(state.where("done").unionByName(moved))
    # What is left lies on cycles: single edges.
    head = [F.when(F.col("done"), F.col(f"a{i}")).otherwise(F.col(f"h{i}")).alias(f"a{i}") for i in (1, 2, 3)]
    placed = state.select(*own, *head, F.when(F.col("done"), F.col("d")).otherwise(0).alias("d"))
    rest = [c for c in edges.columns if c != "lang"]
    steps = placed.join(edges, own).withColumn("step", F.struct("d", *rest))
    part = F.col("d").cast("long")
    twice = F.array_distinct(F.array(F.floor(part / BLOCK), F.floor((part + 1) / BLOCK)))
    steps = steps.withColumn("part", F.explode(twice))
    paths = steps.groupBy("lang", "a1", "a2", "a3", "part").agg(F.sort_array(F.collect_list("step")).alias("steps"), F.max("d").alias("last"))
    # A part that holds nothing but the edge before it does not exist.
    return paths.where(F.col("last") >= F.col("part") * BLOCK).select("lang", "steps")


def _score(left: str, right: str) -> Column:
    square = "cast(a as decimal(18, 0)) * cast(a as decimal(18, 0)) * cast(1000000 as decimal(7, 0))"
    return F.expr(f"({square}) div (cast({left} as decimal(18, 0)) * cast({right} as decimal(18, 0)))")


def phrases(docs: DataFrame, least: int = MIN_COUNT, percent: int = PERCENT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of two and three words."""
    edges, nodes, words, totals = _frequent(docs, least)
    of = edges.join(nodes, ["lang", "v"]).select("lang", "h1", "h2", "h3", "a", F.col("f").alias("f1"))
    to = nodes.select("lang", F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("f").alias("f2"))
    paths = materialize(compacted(materialize(of.join(to, ["lang", "h2", "h3"]))))
    triples = paths.select("lang", F.explode("steps").alias("s")).select("lang", "s.h1", "s.h2", "s.h3", "s.a", "s.f1", "s.f2").distinct()
    # The strongest edge at each node of a path: the one before or after it.
    stronger = "greatest(s.a, if(i > 0, steps[i - 1].a, 0L))"
    at = F.expr(f"transform(steps, (s, i) -> struct(s.h1 as h1, s.h2 as h2, {stronger} as most))")
    end = F.expr("array(struct(element_at(steps, -1).h2 as h1, element_at(steps, -1).h3 as h2, element_at(steps, -1).a as most))")
    most = paths.select("lang", F.inline(F.concat(at, end))).groupBy("lang", "h1", "h2").agg(F.max("most").alias("most"))
    pairs = nodes.join(most, ["lang", "h1", "h2"], "left").where(
        F.col("most").isNull() | (100 * F.col("most") < percent * F.col("f"))
    )
    none = F.lit(None).cast("long")
    every = pairs.select("lang", "h1", none.alias("h2"), F.col("h2").alias("h3"), F.col("f").alias("a"), none.alias("f1"), none.alias("f2"))
    every = every.unionByName(triples)
    for i, how in ((1, "inner"), (3, "inner"), (2, "left")):
        every = every.join(words.select("lang", F.col("h").alias(f"h{i}"), F.col("n").alias(f"n{i}"), F.col("word").alias(f"w{i}")), ["lang", f"h{i}"], how)
    # Cuts after the first and, of three words, after the second.
    one, two = _score("n1", "coalesce(f2, n3)"), F.when(F.col("f1").isNotNull(), _score("f1", "n3"))
    scored = every.withColumn("s1", one).withColumn("s2", two)
    second = F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))
    scored = scored.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
        F.when(second, F.col("f1")).otherwise(F.col("n1")).alias("l"),
        F.when(second, F.col("n3")).otherwise(F.coalesce("f2", "n3")).alias("r"),
        F.when(second, F.col("s2")).otherwise(F.col("s1")).alias("score"),
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
