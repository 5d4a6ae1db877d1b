"""A corpus pipeline: five stages, each calling one operator of bourselake.llm on all that the stage before kept.

Each function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourselake.llm import decontaminate, language, mixing, simhash, surrogates
from bourselake.llm.queries import PII_KEY
from bourselake.llm.shared import checkpoint, table

#: SQL has no fingerprints, keyed surrogates or trained likelihoods; the stages are tested against brute force instead.
ORACLE_SQL: str | None = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard similarity 0.8)."""
    return simhash.drop_near_duplicates(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of ten words of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with surrogates for personal data; n_chars follows the text."""
    return surrogates.pseudonymise(docs, PII_KEY).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with the number of copies of each and the words these make."""
    return mixing.mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("personal_data", replace_personal_data),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; what each keeps is cut by a checkpoint."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpoint(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
