"""Contract checks on rows, and their roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def request_rules() -> dict[str, Column]:
    """A scoring request row needs the three short features."""
    return {f"{c}_present": F.col(c).isNotNull() for c in ("ret_mean", "ret_std", "n")}


def score_rules(score: str = "score") -> dict[str, Column]:
    value = F.col(score)
    return {
        "score_numeric": value.isNotNull() & ~F.isnan(value),
        "score_in_unit_interval": value.between(0, 1),
    }


def expectations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, n_checked, n_failed) from one pass; an unknown outcome counts as failed."""
    rows = [
        F.struct(
            F.lit(name).alias("rule"),
            F.count("*").alias("n_checked"),
            F.count_if(~F.coalesce(rule, F.lit(False))).alias("n_failed"),
        )
        for name, rule in rules.items()
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def count_match(scored: DataFrame, requested: DataFrame) -> DataFrame:
    """Check that there are as many scores as rows."""
    a = scored.agg(F.count("*").alias("a"))
    b = requested.agg(F.count("*").alias("b"))
    return a.crossJoin(F.broadcast(b)).select(
        F.lit("score_count").alias("rule"),
        F.col("b").alias("n_checked"),
        F.abs(F.col("a") - F.col("b")).alias("n_failed"),
    )


def validation_status(checks: DataFrame) -> DataFrame:
    """PASSED, PASSED WITH WARNINGS (80 % or more of the rules hold) or FAILED."""
    sums = checks.agg(
        F.count("*").alias("total"), F.count_if(F.col("n_failed") == 0).alias("passed")
    )
    status = (
        F.when(F.col("passed") == F.col("total"), "PASSED")
        .when(F.col("passed") >= F.col("total") * 0.8, "PASSED WITH WARNINGS")
        .otherwise("FAILED")
    )
    return sums.withColumn("status", status)
