"""The corpus pipeline: five stages over ``documents``, each on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. ``ORACLE_SQL`` is None: a trained classifier takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, jaccard, pieces, quality, spans
from tidemark.llm.common import table
from tidemark.session import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for poor go."""
    return quality.keep(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: shingles of five words, similarity of 0.8 or more."""
    return jaccard.keep_one(docs, 5, 80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in spans that an earlier document holds too are cut."""
    return spans.without_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_codes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text, with digests of the ids and of the text decoded from them."""
    return pieces.round_trip(docs, with_ids=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece_codes", sentencepiece_codes),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what each kept is written once to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
