"""Helpers that the operators share: tables, folds, Arrow maps, components of a graph."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialize


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fold(column: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; NULL ids are in no fold."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % mod


def arrow_map(
    df: DataFrame,
    schema: str,
    function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]],
) -> DataFrame:
    """``function`` over each Arrow batch of ``df``; state it needs lives as long as a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)

    return df.mapInArrow(run, schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with those of ``df`` (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): columns node, root (the smallest node).

    Alternating large-star and small-star steps; every step is an aggregate and a join, and
    no group is ever gathered in one task. Each round is written to the shared folder, and
    rounds end when the edges are stars that no longer change. An empty table gives one.
    """
    edges = materialize(_orient(edges))
    while True:
        after = materialize(_small_star(_large_star(edges)))
        changed = after.exceptAll(edges).limit(1).count() or edges.exceptAll(after).limit(1).count()
        edges = after
        if not changed:
            break
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root")).distinct()


def _orient(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    return (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.union(edges.select("b", "a"))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (
        both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    ).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours, and the node, are linked to the smallest of them."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    rest = edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _orient(rest.union(low.select("a", F.col("m").alias("b"))))
