"""From documents to packed sequences, in five stages.

Each stage is a function of (spark, docs, sf_dir); what it returns is written
as a table and read again as the next one's ``docs``. All but the last return
the columns of ``docs``. Stages see every row their predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopover.llm import language, mixing, packing, pii, queries, simhash
from stopover.llm.common import documents
from stopover.session import staged


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; rejected ones go, the rest stay as they are."""
    model = language.fit(docs, queries.learns_language())
    return language.recognised(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return simhash.one_of_each(docs, queries.SHINGLE, queries.HASH_SEED, queries.BITS)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by the kind; ``n_chars`` follows."""
    found = pii.found(docs, pii.fit(docs), docs.columns)
    changed = {"text": F.col("masked"), "n_chars": F.length("masked").cast("long")}
    return found.select(*[
        changed.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, from no to two copies.

    Of each id and text ``near_dedup`` left one row, so rows are not numbered: that
    would shuffle all texts. Texts without an id that masking has made alike share
    a draw, which is right on average.
    """
    return mixing.mixed(docs, queries.SHARE, queries.WEIGHTS, queries.SEED, alike=False)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences; copies are each placed."""
    return packing.best_fit_packing(
        docs, queries.tokenizer_path(queries.WORD_TOKENIZER), queries.SIZE, queries.END)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("mask_pii", mask_pii),
    ("mix", mix),
    ("pack", pack),
]

# Hashes, training and tokenizing are beyond SQL; the tests hold stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
