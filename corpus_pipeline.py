"""Documents to packed training sequences, in five stages.

Low quality goes, toxic documents go, of exact copies one stays, of near
duplicates one stays, and what is left is packed. Each stage reads what the one
before wrote.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import exact_dedup, ngram_join, packing, quality, toxicity
from gridloom.llm.common import table
from gridloom.session import materialise


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.5."""
    return quality.good_only(docs, table(spark, sf_dir, "labels"))


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold of their language."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest ``doc_id``."""
    return exact_dedup.without_exact_duplicates(docs)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the smallest ``doc_id``."""
    return ngram_join.without_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, with their ids."""
    return packing.packed_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("toxicity", keep_civil),
    ("exact dedup", keep_one_copy),
    ("n-gram jaccard join", keep_one_of_near),
    ("packing", pack),
]

ORACLE_SQL = None  # trained networks are no SQL; the tests check each stage by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table, each one's rows written and read again.

    Null and empty texts are scored like any other, count as equal texts, link
    with nothing and are packed as a closing id alone. Rows with a null key are
    kept unless their text is a copy; of rows that repeat key and text one
    stays. All stages but the last keep every column, whatever its name. An
    empty table gives no pieces; without labels no document is rejected.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs


QUERIES = {"pipeline": run}
SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
