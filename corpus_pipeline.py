"""Corpus preparation: language ID, quality rules, near-duplicates, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept;
``run`` writes each result as Parquet to the shared folder and hands the reread table on.
The first three return rows of ``documents`` with its columns, the last one the packs.
Null or empty texts go in the first stage (no letter, no language), as do texts in no learned language.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesengine.llm import langid, packing, quality, simhash
from salesengine.llm.tables import cut, table

#: A text goes if no language reaches this score (no text with a letter is as low) or if it is unlike the
#: labelled texts of its best language (``langid.Model.floors``).
MIN_LANGUAGE_SCORE = 0.2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is recognised; learns from their own labels."""
    return langid.predict(docs, langid.fit(docs), keep_from=MIN_LANGUAGE_SCORE)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that pass the base rule and are more likely good than bad."""
    return quality.score(docs, quality.fit(docs), keep_only=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, that with the smallest doc_id (nulls last).

    Of rows of the group that repeat this doc_id, one of the smallest text stays. Groups are told
    apart by their fingerprints, so documents without an id, or under a repeated one, stay if
    their texts differ.
    """
    return simhash.first_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents; one row per span."""
    return packing.best_fit(packing.word_counts(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("best_fit_packing", pack),
]

#: No stage can be put in SQL; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
