"""The corpus pipeline: stages that each take what the one before kept, and the queries of the llm subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.llm import decontaminate, jaccard, langid, lines, mixing
from reviewlens.llm.common import stored, table
from reviewlens.llm.queries import ORACLE, QUERIES

__all__ = ["ORACLE", "ORACLE_SQL", "QUERIES", "STAGES", "run"]


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told (no letters) go."""
    return langid.keep_identified(spark, docs, sf_dir)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that documents share stay in the first only; texts and their lengths change, no document goes."""
    kept = lines.dedup_lines(docs).select(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def join_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays."""
    return jaccard.keep_one(spark, docs, sf_dir)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontaminate.drop_contaminated(spark, docs, sf_dir)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes each document."""
    return mixing.mix(spark, docs, sf_dir)


STAGES = [
    ("language_id", identify_languages),
    ("line_dedup", dedup_lines),
    ("jaccard_join", join_similar),
    ("decontamination", remove_benchmark),
    ("source_mix", mix_to_weights),
]

# Cross-parsing and similarity components have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES["pipeline"] = run
