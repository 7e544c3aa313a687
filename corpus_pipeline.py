"""Corpus pipeline: quality, exact dedup, near dedup, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and works on all rows the stage before kept.  ``run`` applies them to the
documents, writing each stage's rows as Parquet under the cluster's shared
folder and reading them back as the next one's docs.  All stages but the last
return the columns of documents; the last returns packed pieces.

An empty table passes through all stages; nulls, repeated rows and extra
columns are treated as the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.llm import exact_dedup, mixing, packing, quality, simhash_dedup
from quire.llm.common import shared_table
from quire.llm.queries import WORD_VOCABULARY, table

#: Token volume of the mixture, as a share of the tokens the mixing stage gets:
#: it repeats the short documents of rare cells, and stages are not to add rows.
MIXED_VOLUME = 0.9


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.drop_poor(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash_dedup.drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights, rare cells repeated."""
    return mixing.sample_mixture(docs, volume=MIXED_VOLUME)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packing.pack(docs, WORD_VOCABULARY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: A fitted classifier, XXH64 and a vocabulary file are beyond SQL; the stages
#: are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
