"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tremorlake.llm import exact, langid, minhash, mixing, packing, periodic, pii, quality, simhash, spelling, suffix, topk, toxicity
from tremorlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document packed into sequences of 1024 tokens."""
    return packing.pack(table(spark, folder, "documents"), special=True)


@_query
def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of equal texts over all documents."""
    return exact.exact_groups(table(spark, folder, "documents"))


ORACLES["op6_exact_dedup"] = exact.ORACLE


@_query
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to the target weights of their sources."""
    return mixing.mix(table(spark, folder, "documents")).drop("copies")


@_query
def op7_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Components of near-duplicate documents over all documents."""
    return minhash.near_groups(table(spark, folder, "documents"))


@_query
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document."""
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@_query
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of every document."""
    return quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@_query
def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the passages that repeat anywhere in the corpus."""
    return suffix.without_repeats(table(spark, folder, "documents"))


@_query
def op3_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best inner products of every twentieth vector with all others."""
    return topk.search(table(spark, folder, "embeddings"))


ORACLES["op3_topk_search"] = topk.ORACLE


@_query
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every page, with text models of all documents."""
    return langid.identify(table(spark, folder, "pages"), table(spark, folder, "documents"))


@_query
def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    return pii.find(table(spark, folder, "documents"))


@_query
def op11_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents with near fingerprints over all documents."""
    return simhash.fingerprint_groups(table(spark, folder, "documents"))


@_query
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The periodic runs of every document."""
    return periodic.periodic_runs(table(spark, folder, "documents"), planted=True)


@_query
def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return spelling.spelling_variants(table(spark, folder, "documents"), planted=True)
