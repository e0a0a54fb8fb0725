"""The corpus pipeline: toxicity, exact copies, near copies, mixing, packing, over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tremorlake.llm import exact, minhash, mixing, packing, toxicity
from tremorlake.llm.common import keep, small_batches, table


def clean(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents scored as toxic go."""
    return toxicity.drop_toxic(docs, table(spark, folder, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minhash.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each row as often as the mix of the sources takes it."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    return packing.pack(docs, special=True)


STAGES = [
    ("toxicity", clean),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("mixing", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages in order over ``documents``; each stage's result is a table in the shared folder.

    A NULL text counts as empty: such rows are scored like others, all but one go as exact copies, and the one that stays packs to
    its end token. Rows without doc_id are never near copies of others. Of repeated rows one stays. An empty table gives an empty
    result. Other columns go through all stages but the last, whatever their names.
    """
    docs = table(spark, folder, "documents")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(small_batches(spark), docs, folder))
    return STAGES[-1][1](spark, docs, folder)


ORACLE_SQL = None  # balanced sampling and token ids are beyond SQL
