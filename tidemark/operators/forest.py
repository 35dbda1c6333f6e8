"""A random forest on large tables, grown level by level from counts.

The values of every feature are put into at most 32 bins once, and the rows are packed into
blocks of bytes. One level of all trees is one pass: tasks count rows by node, bin and class,
a shuffle adds the counts up, and the best cut of every node is chosen where they meet. Only
the cuts reach the driver, as many as the trees have nodes. A row's draws depend on the seed,
the tree and the row's place in its block alone, so no pass has to keep anything per row.

Rules and defaults are those of ``pyspark.ml``: Poisson bags, the root of the number of
features at each node, Gini gain, leaves of equal prediction merged, normalized votes.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

# Tasks carry these functions along: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 65_536
TASK_BLOCKS = 64
# Counts of one task, and nodes whose counts travel in one row.
COUNT_BYTES = 2**26
CHUNK_NODES = 64
GRID = 1_000
# Poisson draws of mean 1, each as often as its chance among 2^16.
DRAWS = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(i) for i in range(9)]), (np.arange(2**16) + 0.5) / 2**16).astype(np.uint8)


def cut_points(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins`` - 1 cuts between neighbouring values, at even steps of the weight."""
    values, place = np.unique(values, return_inverse=True)
    middles = (values[1:] + values[:-1]) / 2
    if len(values) > bins:
        total = np.cumsum(np.bincount(place, weights))
        step = total[-1] / bins
        chosen, target = [], step
        for i in range(1, len(values)):
            if abs(total[i - 1] - target) < abs(total[i] - target):
                chosen.append(i - 1)
                target += step
        middles = middles[chosen]
    return np.unique(middles[np.isfinite(middles)])


def stacked(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """A task's rows as blocks, the class in the last column."""
    held, n = [], 0
    for batch in batches:
        held.append(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
        n += batch.num_rows
        while n >= BLOCK_ROWS:
            whole = np.concatenate(held)
            yield whole[:BLOCK_ROWS]
            held, n = [whole[BLOCK_ROWS:]], n - BLOCK_ROWS
    if n:
        yield np.concatenate(held)


def even_values(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Values at ``GRID`` even steps of the weight."""
    order = values.argsort()
    reach = weights[order].cumsum()
    steps = (np.arange(GRID) + 0.5) / GRID * reach[-1]
    return values[order][np.searchsorted(reach, steps).clip(max=len(values) - 1)]


def class_weights(rows: DataFrame, label: str) -> tuple[np.ndarray, np.ndarray]:
    """Rows of every class, and the weight of one of them."""
    found = rows.groupBy(F.col(label).cast("double").alias("_class")).agg(
        F.count("*").alias("_n"), F.first("weight").alias("_weight")
    ).collect()
    if any(c["_class"] < 0 or c["_class"] != int(c["_class"]) for c in found):
        raise ValueError(f"{label} must hold classes counted from 0")
    n, weight = np.zeros((2, max(2, 1 + max(int(c["_class"]) for c in found))))
    for c in found:
        n[int(c["_class"])], weight[int(c["_class"])] = c["_n"], c["_weight"]
    return n, weight


def all_cuts(rows: DataFrame, features: Sequence[str], label: str, mass: np.ndarray, bins: int) -> list[np.ndarray]:
    """The cuts of every feature. A class counts with its ``mass``, spread over a grid of its values.

    Each block of rows gives such a grid, and a class's grids meet by feature; both steps
    move a value's rank by less than 1 in ``GRID``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in stacked(batches):
            out = []
            for c in np.unique(whole[:, -1]):
                own = whole[whole[:, -1] == c]
                for i in range(len(features)):
                    out.append((i, int(c), len(own), even_values(own[:, i], np.ones(len(own))).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["feature", "class", "n", "grid"])

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        values = np.concatenate([np.frombuffer(g) for g in frame["grid"]])
        grid = even_values(values, np.repeat(frame["n"].to_numpy(float), GRID))
        return frame[["feature", "class"]].head(1).assign(grid=[grid.tobytes()])

    grids = rows.select(*features, F.col(label).cast("double")).mapInArrow(run, "feature long, class long, n long, grid binary")
    found = grids.groupBy("feature", "class").applyInPandas(meet, "feature long, class long, grid binary").collect()
    values, shares = [[] for _ in features], [[] for _ in features]
    for r in found:
        values[r["feature"]].append(np.frombuffer(r["grid"]))
        shares[r["feature"]].append(np.full(GRID, mass[r["class"]] / GRID))
    return [cut_points(np.concatenate(v), np.concatenate(w), bins) for v, w in zip(values, shares)]


def packed(rows: DataFrame, features: Sequence[str], label: str, cuts: list[np.ndarray], classes: int, kind) -> DataFrame:
    """Blocks of rows: of every feature one number, bin x classes + class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for made, whole in enumerate(stacked(batches)):
            codes = np.empty((len(whole), len(cuts)), kind)
            for i, c in enumerate(cuts):
                codes[:, i] = np.searchsorted(c, whole[:, i]) * classes + whole[:, -1].astype(int)
            columns = [pa.array([first + made], pa.int64()), pa.array([codes.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "codes"])

    return rows.select(*features, F.col(label).cast("double")).mapInArrow(run, "block long, codes binary")


def bag(seed: int, tree: int, block: int, n: int) -> np.ndarray:
    """How often a tree draws each row of a block: Poisson, its chances in steps of 2^-16."""
    return DRAWS.take(np.random.default_rng([seed, tree, block]).integers(0, 2**16, n, np.uint16))


def choices(seed: int, tree: int, level: int, features: int, k: int) -> np.ndarray:
    """The ``k`` features that each node of a level may cut."""
    order = np.random.default_rng([seed, tree, level, 1]).random((2**level, features)).argsort(axis=1)
    return np.ascontiguousarray(order[:, :k])


def reached(flat, width, feature, cut, level, drawn) -> tuple[np.ndarray, np.ndarray]:
    """The drawn rows that reach a level, and their nodes there (as in a heap, the root is 0).

    ``flat`` holds ``width`` numbers a row. Rows walk on below a leaf and are dropped at the end.
    """
    node = np.zeros(len(drawn), np.intp)
    if not level:
        return drawn, node
    base = drawn * width
    by = np.maximum(feature, 0)
    for _ in range(level):
        right = flat.take(base + by.take(node)) >= cut.take(node)
        node += node
        node += 1
        node += right
    parents = feature[2 ** (level - 1) - 1 : 2**level - 1]
    if (parents < 0).any():
        goes = np.flatnonzero(np.repeat(parents >= 0, 2).take(node - (2**level - 1)))
        drawn, node = drawn.take(goes), node.take(goes)
    return drawn, node


def counted(blocks: DataFrame, state: dict, level: int, trees: list[int], seed: int, k: int, bins: int) -> DataFrame:
    """Counts by node, chosen feature, bin and class of some trees' nodes at a level."""
    feature, cut, classes, kind, width = (state[x] for x in ("feature", "cut", "classes", "kind", "width"))
    cells = bins * classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(trees), k, 2**level * cells), np.uint32)
        chosen = [choices(seed, t, level, width, k).T.copy() for t in trees]
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                flat = np.frombuffer(data.as_buffer(), kind)
                for i, t in enumerate(trees):
                    times = bag(seed, t, block, len(flat) // width)
                    at, node = reached(flat, width, feature[t], cut[t], level, np.flatnonzero(times))
                    times = times.take(at).astype(float)
                    at *= width
                    node -= 2**level - 1
                    place = node * cells
                    for slot in range(k):
                        key = chosen[i][slot].take(node)
                        key += at
                        key = place + flat.take(key)
                        found = np.bincount(key, times, 2**level * cells)
                        np.add(total[i, slot], found, out=total[i, slot], casting="unsafe")
        for i, t in enumerate(trees):
            chunks = total[i].reshape(k, -1, min(2**level, CHUNK_NODES) * cells).swapaxes(0, 1)
            full = np.flatnonzero(chunks.any(axis=(1, 2)))
            if len(full):
                columns = [
                    pa.array([t] * len(full), pa.int32()), pa.array(full, pa.int32()),
                    pa.array([chunks[c].tobytes() for c in full], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["tree", "chunk", "counts"])

    return blocks.mapInArrow(run, "tree int, chunk int, counts binary")


def best_cuts(counts: np.ndarray, weight: np.ndarray, min_rows: int):
    """The best cut of every node from its counts (node, feature, bin, class).

    Gives slot, bin and gain (slot -1: none), and the weight of every class left and right.
    """
    left = counts.cumsum(axis=2)
    every = left[:, :, -1:, :]
    left = left[:, :, :-1, :]
    right = every - left
    bear = (left.sum(axis=3) >= min_rows) & (right.sum(axis=3) >= min_rows)

    def spread(n):
        w = n * weight
        size = w.sum(axis=3)
        return size - (w * w).sum(axis=3) / np.where(size > 0, size, 1), size

    (l, _), (r, _), (both, size) = spread(left), spread(right), spread(every)
    gain = np.where(bear, (both - l - r) / np.where(size > 0, size, 1), -1.0)
    flat = gain.reshape(len(gain), -1)
    place = flat.argmax(axis=1)
    nodes = np.arange(len(gain))
    slot, bin_ = np.divmod(place, gain.shape[2])
    most = flat[nodes, place]
    slot = np.where(most > 1e-12, slot, -1)
    return slot, bin_, most, left[nodes, slot, bin_] * weight, right[nodes, slot, bin_] * weight


def chosen_cuts(counts: DataFrame, weight: np.ndarray, level: int, seed: int, width: int, k: int, bins: int, min_rows: int) -> pd.DataFrame:
    """One row for every node of a level that has rows."""
    schema = "tree int, node int, feature int, bin int, gain double, left array<double>, right array<double>"

    def run(key: tuple[int, ...], frame: pd.DataFrame) -> pd.DataFrame:
        tree, chunk = (int(x) for x in key)
        total = sum(np.frombuffer(c, np.uint32).astype(np.int64) for c in frame["counts"])
        total = total.reshape(k, -1, bins, len(weight)).swapaxes(0, 1)
        nodes = chunk * CHUNK_NODES + np.arange(len(total))
        slot, bin_, gain, left, right = best_cuts(total, weight, min_rows)
        feature = choices(seed, tree, level, width, k)[nodes, slot]
        out = pd.DataFrame({
            "tree": tree, "node": nodes + 2**level - 1, "feature": np.where(slot < 0, -1, feature), "bin": bin_,
            "gain": gain, "left": list(left), "right": list(right),
        })
        return out[total[:, 0].any(axis=(1, 2))]

    return counts.groupBy("tree", "chunk").applyInPandas(run, schema).toPandas()


def fit(
    rows: DataFrame,
    features: Sequence[str],
    label: str,
    trees: int = 100,
    depth: int = 10,
    seed: int = 42,
    min_rows: int = 2,
    bins: int = 32,
) -> ForestModel:
    """A forest on all ``rows``, whose ``weight`` is the same for all rows of a class."""
    context = rows.sparkSession.sparkContext
    every, weight = class_weights(rows, label)
    cuts = all_cuts(rows, features, label, every * weight, bins)
    classes, width = len(weight), len(features)
    k = width if trees == 1 else int(np.ceil(np.sqrt(width)))
    kind = np.uint8 if bins * classes <= 256 else np.uint16
    blocks = materialize(packed(rows, features, label, cuts, classes, kind))
    tasks = max(context.defaultParallelism, int(every.sum()) // (TASK_BLOCKS * BLOCK_ROWS))
    blocks = blocks.repartition(tasks).persist()
    inner = 2**depth - 1
    feature = np.full((trees, inner), -1, np.intp)
    cut = np.zeros((trees, inner), kind)
    bin_of = np.zeros((trees, inner), np.intp)
    gain = np.zeros((trees, inner))
    votes = np.zeros((trees, 2 * inner + 1, classes))
    state = {"feature": feature, "cut": cut, "classes": classes, "kind": kind, "width": width}
    for level in range(depth):
        above = slice(2 ** (level - 1) - 1, 2**level - 1) if level else None
        still = [t for t in range(trees) if above is None or (feature[t, above] >= 0).any()]
        group = max(1, COUNT_BYTES // (2**level * k * bins * classes * 4))
        for start in range(0, len(still), group):
            counts = counted(blocks, state, level, still[start : start + group], seed, k, bins)
            got = chosen_cuts(counts, weight, level, seed, width, k, bins, min_rows)
            t, node = got["tree"].to_numpy(), got["node"].to_numpy()
            feature[t, node], bin_of[t, node], gain[t, node] = got["feature"], got["bin"], got["gain"]
            cut[t, node] = (got["bin"].to_numpy() + 1) * classes
            split = got[got["feature"] >= 0]
            if len(split):
                t, node = split["tree"].to_numpy(), split["node"].to_numpy()
                votes[t, 2 * node + 1], votes[t, 2 * node + 2] = np.stack(split["left"]), np.stack(split["right"])
                votes[t, node] = votes[t, 2 * node + 1] + votes[t, 2 * node + 2]
    blocks.unpersist()
    votes[votes[:, 0].sum(axis=1) == 0, 0] = every * weight
    merge_leaves(feature, votes)
    return ForestModel(list(features), feature, bin_of, cuts, votes, gain)


def merge_leaves(feature: np.ndarray, votes: np.ndarray) -> None:
    """Two leaves that predict the same become one, from the bottom up."""
    inner = feature.shape[1]
    leaf = np.concatenate([feature < 0, np.ones((len(feature), inner + 1), bool)], axis=1)
    says = votes.argmax(axis=2)
    for node in range(inner - 1, -1, -1):
        a, b = 2 * node + 1, 2 * node + 2
        same = leaf[:, a] & leaf[:, b] & (says[:, a] == says[:, b])
        leaf[:, node] |= same
        feature[same, node] = -1


class ForestModel(Model):
    """Grown trees; adds the columns of a ``pyspark.ml`` forest."""

    def __init__(self, features, feature, bin_of, cuts, votes, gain):
        super().__init__()
        self.features = features
        self.feature = feature
        self.votes = votes
        inner = feature.shape[1]
        self.threshold = np.full(feature.shape, np.inf)
        for f, points in enumerate(cuts):
            at = feature == f
            self.threshold[at] = points[bin_of[at]] if at.any() else 0
        worth = np.where(feature >= 0, gain * votes[:, :inner].sum(axis=2), 0)
        each = np.stack([np.where(feature == f, worth, 0).sum(axis=1) for f in range(len(features))], axis=1)
        each = each / np.maximum(each.sum(axis=1, keepdims=True), np.finfo(float).tiny)
        self._importances = each.sum(axis=0) / max(each.sum(), np.finfo(float).tiny)

    @property
    def featureImportances(self) -> DenseVector:
        return Vectors.dense(self._importances)

    @property
    def totalNumNodes(self) -> int:
        """Nodes of all trees: one root each and two for every cut."""
        return int(len(self.feature) + 2 * (self.feature >= 0).sum())

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, inner = self.feature.shape
        depth = (inner + 1).bit_length() - 1
        # What a leaf says is handed down, so that every row walks the same number of steps.
        size = np.maximum(self.votes.sum(axis=2, keepdims=True), np.finfo(float).tiny)
        share = self.votes / size
        for node in range(inner):
            ends = self.feature[:, node] < 0
            share[ends, 2 * node + 1] = share[ends, 2 * node + 2] = share[ends, node]
        feature, threshold, bottom = np.maximum(self.feature, 0), self.threshold, share[:, inner:].copy()

        @F.pandas_udf("array<double>")
        def votes(frame: pd.DataFrame) -> pd.Series:
            x = frame.to_numpy(float)
            flat, base = x.ravel(), np.arange(len(x)) * x.shape[1]
            total = np.zeros((len(x), bottom.shape[2]))
            for t in range(trees):
                node = np.zeros(len(x), np.intp)
                for _ in range(depth):
                    stays = flat.take(base + feature[t].take(node)) <= threshold[t].take(node)
                    node = 2 * node + 2 - stays
                total += bottom[t].take(node - inner, axis=0)
            return pd.Series(list(total))

        raw = F.col("_votes")
        out = dataset.withColumn("_votes", votes(F.struct(*(F.col(f).cast("double") for f in self.features))))
        return (
            out.withColumn("rawPrediction", array_to_vector(raw))
            .withColumn("probability", array_to_vector(F.transform(raw, lambda v: v / F.lit(float(trees)))))
            .withColumn("prediction", (F.array_position(raw, F.array_max(raw)) - 1).cast("double"))
            .drop("_votes")
        )
