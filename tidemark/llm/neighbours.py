"""Approximate nearest neighbours by multiprobe p-stable hashing.

A hash is ``floor((a.x + b) / W)`` with normal ``a``; ``m`` of them name a bucket of a table. A
query visits its own bucket and then perturbed ones, in the order of how likely they are to hold
near vectors (the distance of its projections to the borders they cross). Rows of a bucket travel
in blocks, blocks of rows meet blocks of queries in one join on (table, bucket), and each meeting
yields the nearest few per query by exact double-precision distance. Tables, hashes, width and
probes are fitted: the true neighbours of a bounded sample of queries are found by one pass over all
rows, and the cheapest setting that finds ``GOAL`` of them is taken. All rows are indexed. Queries that found
fewer than ``k`` although there are more are searched exactly.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

K = 10
GOAL = 0.97  # share of the sample's neighbours that must be found
SAMPLE_QUERIES = 64
SAMPLE_ROWS = 4_000  # rows that the cost of a setting is estimated on
BLOCK = 2_048
HELD = 500_000  # findings that a task holds before it passes them on
TABLES, HASHES, PROBES = (1, 2, 4, 8), (1, 2, 3, 4, 6, 8, 10, 12), (1, 2, 4, 8, 16, 32, 64, 128)
WIDTHS = (0.5, 1.0, 2.0)


def usable(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, v (doubles) of the vectors that take part.

    NULL, empty and zero vectors, those with a NULL or non-finite part, with a NULL id, and those whose
    length is not the most frequent one (of equal ones the smaller) take no part. Of equal vectors
    the K + 1 smallest ids are kept; no answer can hold more of them.
    """
    rows = vectors.select(F.col(id_).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(
        F.col("id").isNotNull() & (F.size("v") > 0)
        & F.expr("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x <> 0)")
    )
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (size[0] if size else 0))


def _few(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("v").orderBy("id")
    return rows.dropDuplicates(["id", "v"]).withColumn("r", F.row_number().over(order)).where(f"r <= {K + 1}").drop("r")


class Hashes:
    """``tables`` x ``m`` hashes of width ``w``; the same seed gives the same hashes anywhere."""

    def __init__(self, dim: int, tables: int, m: int, w: float, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.a = rng.normal(size=(max(TABLES), dim, max(HASHES)))[:tables, :, :m]
        self.b = rng.uniform(0, 1, (max(TABLES), max(HASHES)))[:tables, :m]
        self.w, self.m, self.tables = w, m, tables
        self.mix = np.random.default_rng(seed + 1).integers(1, 2**62, max(HASHES), dtype="int64")[:m] | 1

    def places(self, x: np.ndarray, table: int) -> np.ndarray:
        return x @ self.a[table] / self.w + self.b[table]

    def keys(self, buckets: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (buckets.astype("int64") * self.mix).sum(1)

    def probes(self, place: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` likeliest buckets of one query, the own one first."""
        own = np.floor(place)
        part = place - own
        moves = sorted([(p * p, j, -1) for j, p in enumerate(part)] + [((1 - p) ** 2, j, 1) for j, p in enumerate(part)])
        out = [own]
        heap = [(moves[0][0], (0,))]
        while heap and len(out) < n:
            cost, chosen = heapq.heappop(heap)
            axes = [moves[i][1] for i in chosen]
            if len(set(axes)) == len(axes):
                bucket = own.copy()
                for i in chosen:
                    bucket[moves[i][1]] += moves[i][2]
                out.append(bucket)
            last = chosen[-1]
            if last + 1 < len(moves):
                gap = moves[last + 1][0]
                heapq.heappush(heap, (cost + gap, (*chosen, last + 1)))
                heapq.heappush(heap, (cost - moves[last][0] + gap, (*chosen[:-1], last + 1)))
        return np.array(out)


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _distances(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.sqrt(((rows - query) ** 2).sum(1))


def _nearest(query: np.ndarray, own: int, ids: np.ndarray, rows: np.ndarray, k: int):
    """The k nearest of ``rows`` but the query itself, ties to the smaller id."""
    far = _distances(query, rows)
    far[ids == own] = np.inf
    if len(ids) > 4 * k:
        near = np.flatnonzero(far <= np.partition(far, k)[k])
    else:
        near = np.arange(len(ids))
    near = near[np.lexsort((ids[near], far[near]))][:k]
    near = near[np.isfinite(far[near])]
    return ids[near], far[near]


def fit(rows: DataFrame, queries: DataFrame, k: int = K) -> tuple[Hashes, int] | None:
    """Hashes and probes; None if there is nothing to search."""
    n = rows.count()
    asked = queries.orderBy(F.xxhash64("id")).limit(SAMPLE_QUERIES).collect()
    if n < 2 or not asked:
        return None
    qs = np.array([r["v"] for r in asked])
    q_ids = [r["id"] for r in asked]

    def best(batches):
        for batch in batches:
            ids, own = batch.column(0).to_numpy(), _vectors(batch.column(1))
            out = []
            for i, q in enumerate(qs):
                for id_, d in zip(*_nearest(q, q_ids[i], ids, own, k), strict=True):
                    out.append((i, int(id_), float(d), own[np.flatnonzero(ids == id_)[0]].tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[j] for o in out], t) for j, t in enumerate((pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.float64())))],
                names=["q", "id", "d", "v"],
            )

    order = Window.partitionBy("q").orderBy("d", "id")
    near = rows.select("id", "v").mapInArrow(best, "q int, id long, d double, v array<double>")
    near = near.withColumn("r", F.row_number().over(order)).where(f"r <= {k}").select("q", "d", "v").collect()
    share = min(1.0, SAMPLE_ROWS / n)
    some = rows.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 30)) < share * (1 << 30)).select("v").collect()
    some = np.array([r[0] for r in some]) if some else qs
    width = float(np.median([r["d"] for r in near])) or 1.0
    true, of = np.array([r["v"] for r in near]), np.array([r["q"] for r in near])
    best_cost, chosen = np.inf, None
    for factor in WIDTHS:
        for m in HASHES:
            hashes = Hashes(qs.shape[1], max(TABLES), m, width * factor)
            hit, cost = np.zeros((len(PROBES), len(true)), bool), np.zeros(len(PROBES))
            for t in range(max(TABLES)):
                at_true = hashes.keys(np.floor(hashes.places(true, t)))
                at_some = hashes.keys(np.floor(hashes.places(some, t)))
                for i, place in enumerate(hashes.places(qs, t)):
                    keys = hashes.keys(hashes.probes(place, max(PROBES)))
                    mine = np.flatnonzero(of == i)
                    for j, p in enumerate(PROBES):
                        hit[j, mine] |= np.isin(at_true[mine], keys[:p])
                        cost[j] += np.isin(at_some, keys[:p]).mean() / len(qs)
                if t + 1 in TABLES:
                    for j, p in enumerate(PROBES):
                        price = cost[j] + (t + 1) * (0.02 + p / n)
                        if hit[j].mean() >= GOAL and price < best_cost:
                            best_cost, chosen = price, (t + 1, m, width * factor, p)
    if chosen is None:
        return Hashes(qs.shape[1], 1, 1, np.inf), 1
    return Hashes(qs.shape[1], *chosen[:3]), chosen[3]


def _blocks(rows: DataFrame, hashes: Hashes, probes: int, names: str) -> DataFrame:
    """(t, key, ids, vs) for each bucket of each Arrow batch, at most BLOCK rows each."""

    def run(batches):
        for batch in batches:
            ids, own = batch.column(0).to_numpy(), _vectors(batch.column(1))
            out = []
            for t in range(hashes.tables if len(ids) else 0):
                places = hashes.places(own, t)
                if probes:
                    found = [hashes.keys(hashes.probes(p, probes)) for p in places]
                    keys, at = np.concatenate(found), np.repeat(np.arange(len(ids)), [len(f) for f in found])
                else:
                    keys, at = hashes.keys(np.floor(places)), np.arange(len(ids))
                order = np.argsort(keys, kind="stable")
                keys, at = keys[order], at[order]
                cuts = np.flatnonzero(np.diff(keys)) + 1
                for lot in np.split(at, cuts):
                    key = int(keys[0])
                    keys = keys[len(lot):]
                    for i in range(0, len(lot), BLOCK):
                        part = lot[i : i + BLOCK]
                        out.append((t, key, ids[part].tobytes(), own[part].tobytes()))
                        if len(out) >= 64:
                            yield _batch(out, names)
                            out = []
            if out:
                yield _batch(out, names)

    return rows.select("id", "v").mapInArrow(run, f"t int, key long, {names}_ids binary, {names}_vs binary")


def _batch(out: list, names: str) -> pa.RecordBatch:
    types = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([o[j] for o in out], t) for j, t in enumerate(types)], names=["t", "key", f"{names}_ids", f"{names}_vs"]
    )


def _none() -> tuple:
    return np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0)


def _found(best: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in best], names=["query_id", "vec_id", "score"])


def _best(found: list[tuple], k: int) -> tuple:
    """The k nearest of each query among what several meetings found, each pair once."""
    asked, ids, far = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((ids, far, asked))
    asked, ids, far = asked[order], ids[order], far[order]
    new = np.ones(len(asked), bool)
    new[1:] = (asked[1:] != asked[:-1]) | (ids[1:] != ids[:-1]) | (far[1:] != far[:-1])
    asked, ids, far = asked[new], ids[new], far[new]
    first = np.arange(len(asked)) - np.searchsorted(asked, asked) < k
    return asked[first], ids[first], far[first]


def _meet(queries: DataFrame, rows: DataFrame, hashes: Hashes, probes: int, k: int) -> DataFrame:
    """The k nearest of each query; a task thins out its findings before they are shuffled."""

    def run(batches):
        found, held = [_none()], 0
        for batch in batches:
            for q_ids, q_vs, r_ids, r_vs in zip(*(batch.column(i) for i in range(4)), strict=True):
                asked, ids = np.frombuffer(q_ids.as_py(), "int64"), np.frombuffer(r_ids.as_py(), "int64")
                qs, own = (np.frombuffer(x.as_py()).reshape(n, -1) for x, n in ((q_vs, len(asked)), (r_vs, len(ids))))
                for q, a in zip(qs, asked, strict=True):
                    near, far = _nearest(q, a, ids, own, k)
                    found.append((np.full(len(near), a), near, far))
                    held += len(near)
                if held > HELD:
                    best = _best(found, k)
                    found, held = [best], len(best[0])
                    if held > HELD // 2:
                        yield _found(best)
                        found, held = [_none()], 0
        yield _found(_best(found, k))

    pairs = _blocks(queries, hashes, probes, "q").join(_blocks(rows, hashes, 0, "r"), ["t", "key"])
    found = pairs.select("q_ids", "q_vs", "r_ids", "r_vs").mapInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = found.dropDuplicates(["query_id", "vec_id"])
    return found.withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}")


def search(vectors: DataFrame, every: int = 100, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of each vector whose id ``every`` divides.

    An id that occurs with several vectors asks once for each of them and never finds itself; rows that repeat
    count once. An empty table gives no rows.
    """
    own = materialize(usable(vectors))
    rows = materialize(_few(own))
    queries = own.where(f"pmod(id, {every}) = 0").distinct()
    fitted = fit(rows, queries, k)
    columns = ["query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"]
    if fitted is None:
        return own.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = materialize(_meet(queries, rows, *fitted, k).select(*columns))
    enough = min(k, rows.select("id").distinct().count() - 1)
    full = found.groupBy("query_id").agg(F.max("rank").alias("n")).where(f"n >= {enough}")
    rest = queries.join(full, queries["id"] == full["query_id"], "left_anti")
    if rest.limit(1).count() == 0:
        return found
    every_row = Hashes(len(rest.first()["v"]), 1, 1, np.inf)
    exact = _meet(rest, rows, every_row, 1, k).select(*columns)
    return found.join(full.select("query_id"), "query_id").select("query_id", "rank", "vec_id", "score").unionByName(exact)
