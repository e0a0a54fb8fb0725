"""Language identification of web pages by Bayesian evidence fusion.

Four pieces of evidence: the likelihood of the visible text under byte-trigram models counted over all
documents; the language that the markup declares; the address suffix; and the host's prior, smoothed
towards its domain, the domain's towards all pages. The tables of the last three are grouped counts of
pages by the language of their text; a page's own count is left out of its host's prior.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tremorlake.llm.common import drop, keep, text_or_empty

BUCKETS = 1 << 14
SIGNS = 200  # a text's likelihood counts as if it had at most this many independent trigrams
PULL = 5.0  # pages that a host's or domain's prior borrows from the level above


def _codes(text: str) -> np.ndarray:
    data = np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8).astype(np.int64)
    return ((data[:-2] * 31 + data[1:-1]) * 131 + data[2:]) * 40503 % 65521 % BUCKETS


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
            own += np.bincount(_codes(text.as_py()), minlength=BUCKETS)
    for lang, counts in total.items():
        seen = np.flatnonzero(counts)
        columns = [pa.array([lang] * len(seen), pa.string()), pa.array(seen), pa.array(counts[seen])]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])


def text_models(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, by code point, and their log probabilities of trigram buckets, from all documents.

    A bounded number of counts per language comes to the driver; rows without a language are left out.
    """
    rows = docs.select("lang", text_or_empty().alias("text")).filter("lang is not null").mapInArrow(_counted, "lang string, bucket long, n long")
    counts = keep(rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())
    table = np.ones((len(langs), BUCKETS))
    for row in counts.toLocalIterator():
        table[langs.index(row["lang"]), row["bucket"]] += row["n"]
    drop(counts)
    return langs, np.log(table / table.sum(1, keepdims=True))


def visible(html: Column) -> Column:
    """The text that a page shows."""
    bare = F.regexp_replace(F.coalesce(html.cast("string"), F.lit("")), r"(?is)<(script|style|nav|head)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """The language of each page of ``pages`` (page_id, url, html), with text models from ``docs`` (text, lang).

    Returns page_id, lang, score (the posterior of lang), text_lang (by the text alone), declared. A
    page without visible text has no text evidence (text_lang NULL), without url or declaration none of
    these; without any evidence the prior of all pages decides, then the first language by code point.
    Repeated rows are pages of their own. Without documents that name a language, lang and score are
    NULL. An empty table gives an empty one. Other columns are not read.
    """
    langs, model = text_models(docs)
    if not langs:
        null = F.lit(None).cast("string")
        return pages.select("page_id", null.alias("lang"), F.lit(None).cast("double").alias("score"), null.alias("text_lang"), null.alias("declared"))
    shared = pages.sparkSession.sparkContext.broadcast(model.astype(np.float32))
    url, html = F.lower(F.coalesce(F.col("url").cast("string"), F.lit(""))), F.coalesce(F.col("html").cast("string"), F.lit(""))
    host = F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)
    domain = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    rows = pages.select(
        "page_id", host.alias("host"), domain.alias("domain"), F.regexp_extract(host, r"\.([^.]+)$", 1).alias("suffix"),
        F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1)).alias("declared"), visible(F.col("html")).alias("text"),
    )

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            out, best = [], []
            for text in batch.column("text"):
                text = text.as_py()
                codes = _codes(text) if text else np.empty(0, np.int64)
                mean = model[:, codes].mean(1) if len(codes) else np.zeros(len(model))
                out.append((mean * min(SIGNS, len(codes))).astype(float).tolist())
                best.append(int(mean.argmax()) if len(codes) else None)
            keep_ = batch.select(["page_id", "host", "domain", "suffix", "declared"])
            yield pa.RecordBatch.from_arrays([*keep_.columns, pa.array(out, pa.list_(pa.float64())), pa.array(best, pa.int64())], names=[*keep_.schema.names, "text_ll", "best"])

    types = "page_id long, host string, domain string, suffix string, declared string, text_ll array<double>, best long"
    told = keep(rows.withColumn("page_id", F.col("page_id").cast("long")).mapInArrow(weighed, types))

    def counts(key: str) -> DataFrame:
        """One row per value of ``key``: pages per language of their text."""
        each = [F.count(F.when(F.col("best") == k, 1)) for k in range(len(langs))]
        grouped = told.filter(F.col("best").isNotNull() & (F.col(key) != "")).groupBy(key)
        return keep(grouped.agg(F.array(*each).cast("array<double>").alias(f"n_{key}")).withColumnRenamed(key, f"{key}_"))

    zero = F.array(*[F.lit(0.0)] * len(langs))
    every = told.filter("best is not null").agg(*[F.count(F.when(F.col("best") == k, 1)) for k in range(len(langs))]).first()
    base = F.array(*[F.lit((n + 1.0) / (sum(every) + len(langs))) for n in every])
    total = F.array(*[F.lit(float(n)) for n in every])
    own = F.transform(F.sequence(F.lit(0), F.lit(len(langs) - 1)), lambda k: F.when(F.col("best") == k, 1.0).otherwise(0.0))
    joined = told
    for key in ("host", "domain", "suffix", "declared"):
        joined = joined.join(counts(key), F.col(key) == F.col(f"{key}_"), "left").withColumn(f"n_{key}", F.coalesce(f"n_{key}", zero))

    def added(a: Column) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    def pulled(number: str, above: Column) -> Column:
        """The prior of a host or domain: its pages but this one, and ``PULL`` pages of the level above."""
        others = F.zip_with(F.col(number), own, lambda n, o: F.greatest(n - o, F.lit(0.0)))
        whole = added(others) + PULL
        return F.zip_with(others, above, lambda n, p: (n + PULL * p) / whole)

    def evidence(number: str, present: Column) -> Column:
        """Log of how often a language's pages show this declaration or suffix."""
        others = F.zip_with(F.col(number), own, lambda n, o: F.greatest(n - o, F.lit(0.0)))
        logs = F.zip_with(others, total, lambda n, t: F.log((n + 0.5) / (t + 1.0)))
        return F.when(present & (added(F.col(number)) > 0), logs).otherwise(zero)

    joined = joined.withColumn("p_domain", pulled("n_domain", base)).withColumn("p_host", pulled("n_host", F.col("p_domain")))
    parts = [
        F.col("text_ll"),
        F.transform("p_host", lambda p: F.log(p)),
        evidence("n_declared", F.col("declared") != ""),
        evidence("n_suffix", F.col("suffix") != ""),
    ]
    fused = parts[0]
    for part in parts[1:]:
        fused = F.zip_with(fused, part, lambda a, b: a + b)
    joined = joined.withColumn("fused", fused).withColumn("top", F.array_max("fused"))
    score = 1.0 / added(F.transform("fused", lambda x: F.exp(x - F.col("top"))))
    names = F.array(*[F.lit(x) for x in langs])
    at = F.array_position("fused", F.col("top")).cast("int")
    return joined.select(
        "page_id", F.element_at(names, at).alias("lang"), score.alias("score"),
        F.when(F.col("best").isNotNull(), F.element_at(names, (F.col("best") + 1).cast("int"))).alias("text_lang"),
        F.when(F.col("declared") != "", F.col("declared")).alias("declared"),
    )
