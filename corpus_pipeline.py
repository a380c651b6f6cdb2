"""Documents to a training mix: language, near duplicates, repeated passages, benchmark passages, mixing.

Every stage reads what the stage before wrote.  All but the last return the
columns of ``documents``; the last adds how often each document is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripweave.llm import contamination, jaccard, language, mixing, substrings
from tripweave.llm.common import table
from tripweave.session import delete_folder, ship_package, work_folder, work_scope


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not rejected (no letters, or unlike all languages learned)."""
    ship_package(spark)
    return language.known(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of documents linked as in op4 (3-word shingles, 90 %), the one of smallest id."""
    ship_package(spark)
    return jaccard.keep_one(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that earlier documents hold; texts that lose nothing stay as they are."""
    ship_package(spark)
    return substrings.drop_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text, each judged by its own text."""
    ship_package(spark)
    return contamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with copies and words taken."""
    ship_package(spark)
    return mixing.mix_documents(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("decontamination", drop_contaminated),
    ("mixing", mix_to_targets),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; a stage's own steps go when its output is written, its input after it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = work_folder(spark, f"pipeline-{name}")
        with work_scope(spark, f"pipeline-{name}-steps"):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_folder(spark, before)
        before = path
    return docs


# Character models have no SQL form: the pipeline is tested against a brute-force version.
ORACLE_SQL = None
