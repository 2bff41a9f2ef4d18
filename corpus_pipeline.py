"""From raw documents to packed sequences, in stages that read what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from altigrid.llm import jaccard_join, mixing, packing, suffix_dedup, toxicity
from altigrid.llm.common import saved, stored_place, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject, whole and unchanged."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that hangs together by shingle similarity."""
    return jaccard_join.keep_one(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that also start earlier are cut out of the texts."""
    return suffix_dedup.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same rows in the order of the mix."""
    return mixing.in_order(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in as few sequences as bin completion finds, numbered in the order of the mix.

    The order is that of the rows in the files of the stage before.
    """
    return packing.pack(stored_place(docs, "doc_id", "text", name="at"), in_order=True)


STAGES = [
    ("toxicity", reject_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("suffix-array dedup", drop_repeats),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

# Trained weights, sampled paths and tokenizer ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
