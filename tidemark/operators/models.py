"""Tree and linear models on the feature table, with ``pyspark.ml``; a large table's forest with ``forest``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ticks import select_features
from tidemark.operators import forest
from tidemark.schema import MODEL_FEATURES

# Above so many rows a forest gets its rows in tasks of even size, two a core.
EVEN_ABOVE = 1_000_000
# Above so many it is grown from packed blocks of rows (``forest``).
BLOCKS_ABOVE = 2_000_000


def balanced(df: DataFrame, label: str) -> DataFrame:
    """Add ``weight`` so that every class weighs the same in total."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_rows"), F.count("*").alias("_classes"))
    weights = counts.crossJoin(F.broadcast(total)).select(
        label, (F.col("_rows") / (F.col("_classes") * F.col("_n"))).alias("weight")
    )
    return df.join(F.broadcast(weights), label)


def evened(df: DataFrame, above: int | None = None) -> DataFrame:
    """A large table in tasks of even row counts, a multiple of the cores.

    A forest passes over its rows once a level, and each pass waits for the largest task. A
    forest draws its rows per task, so smaller tables stay as they are cut and draw the same.
    """
    if df.count() <= (EVEN_ABOVE if above is None else above):
        return df
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def train(
    df: DataFrame,
    label: str = "volatility_spike",
    kind: str = "forest",
    features: Sequence[str] = tuple(MODEL_FEATURES),
    trees: int = 100,
    depth: int = 10,
    seed: int = 42,
) -> PipelineModel:
    """Fit a forest, a logistic regression or boosted trees on the labelled rows.

    The forest keeps each row's node of every tree from pass to pass instead of walking down
    all trees again, and totals at most 64 MB of nodes in a pass, which a task's cache and heap
    bear; a wider level takes more passes. On tables of over ``BLOCKS_ABOVE`` rows the same kind
    of forest, on all rows, is grown by ``forest.fit``.
    """
    rows = select_features(df.where(F.col(label).isNotNull()), list(features), target=label)
    rows = balanced(rows, label)
    used = [f for f in features if f in rows.columns]
    assemble = VectorAssembler(inputCols=used, outputCol="_vector", handleInvalid="keep")
    common = {"labelCol": label, "weightCol": "weight"}
    if kind == "forest":
        if rows.count() > BLOCKS_ABOVE:
            return PipelineModel([assemble, forest.fit(rows, used, label, trees, depth, seed)])
        rows = evened(rows)
        stages = [
            assemble,
            RandomForestClassifier(
                featuresCol="_vector", numTrees=trees, maxDepth=depth, minInstancesPerNode=2,
                seed=seed, cacheNodeIds=True, checkpointInterval=-1, maxMemoryInMB=64, **common,
            ),
        ]
    elif kind == "logistic":
        stages = [
            assemble,
            StandardScaler(inputCol="_vector", outputCol="_scaled", withMean=True),
            LogisticRegression(featuresCol="_scaled", **common),
        ]
    elif kind == "boosted":
        stages = [
            assemble, GBTClassifier(featuresCol="_vector", maxIter=trees, seed=seed, **common)
        ]
    else:
        raise ValueError(kind)
    return Pipeline(stages=stages).fit(rows)


def feature_importance(
    df: DataFrame, model: PipelineModel, features: Sequence[str] | None = None
) -> DataFrame:
    """The features ranked by the model's importance (as many rows as features).

    The names are those the model was fitted on, unless ``features`` gives as many others.
    """
    features = model.stages[0].getInputCols() if features is None else features
    values = model.stages[-1].featureImportances.toArray()
    return df.sparkSession.createDataFrame(
        [(f, float(v)) for f, v in zip(features, values, strict=True)], "feature string, importance double"
    ).orderBy(F.desc("importance"))
