"""Documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from locusweave.llm import common, exact_dedup, mixing, near_dedup, packing, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.7 or more go."""
    return toxicity.keep_clean(docs, common.table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near texts the least doc_id stays."""
    return near_dedup.keep_one(docs)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of rare languages are repeated; with a least rate of 1 every document stays."""
    return mixing.resampled(docs, mixing.labelled_domains(docs, common.table(spark, sf_dir, "labels")), pinned=("poor",), min_rate=1.0)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_to_weights),
    ("packing", pack_sequences),
]

#: The learned stages can't be expressed in SQL; tests/llm compare the pipeline with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
