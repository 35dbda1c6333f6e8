"""The tables under names that plain SQL can use."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.plans import queries, tape


def register(spark: SparkSession, sf: str) -> list[str]:
    """Temporary views ``ticks``, ``features``, ``labels`` and ``predictions``."""
    views = {
        "ticks": tape.tape(spark, sf),
        "features": queries.features(spark, sf),
        "labels": queries.labelled(spark, sf),
        "predictions": tape.predictions(spark, sf),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
