"""A corpus from raw documents: toxic ones go, then those without a known language, then near-duplicates; the rest is packed.

Each stage is a function of (spark, docs, sf_dir); its rows are written as Parquet and reread as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from oslogs.llm import language_id, order_minhash, packing, toxicity
from oslogs.llm.common import table, written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted to the labelled ones among them, scores below 0.5.

    A null or empty text is scored as one without words and stays unless the model says otherwise; repeated rows score alike
    and go or stay together; an empty table gives an empty one. All columns are kept.
    """
    model = toxicity.fit(toxicity.labelled(docs, table(spark, sf_dir, "labels")))
    return toxicity.clean(docs, model)


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one of those that the documents name.

    A null text, and one without a letter, has no language and goes; rows are judged by their text alone, so repeated rows go or
    stay together; where no document names a language all stay; an empty table gives an empty one. All columns are kept.
    """
    return language_id.recognised(docs, language_id.fit(docs))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest id.

    Empty texts, and texts without words, are near only to equal texts; a null text is near to none; rows without an id all
    stay; of rows that share an id one stays. All columns are kept.
    """
    return order_minhash.one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 2048 tokens.

    A null or empty text is its end token alone; each row is packed by itself, repeated or not; an empty table gives no piece.
    """
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic), ("language_id", with_language), ("near_duplicates", without_near_duplicates), ("packing", packed),
]

#: SQL expresses none of the stages; tests/llm holds them against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
