"""Exact deduplication by a tree merge of sorted digest runs.

Every input partition is a leaf run: the digests of its documents. A round merges ``FAN`` neighbouring
runs (one exchange stands for log2(FAN) binomial rounds) and keeps, per digest, the smallest identifier
and the size of the group so far. One digest is at most one row of a run, so a text that a third of all
rows share meets at most ``FAN`` rows a task and round. The decisions walk the same tree down again to
the leaves, where each meets no more rows than its input partition held.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tremorlake.llm.common import BLANKS, drop, fresh, keep, text_or_empty

FAN = 16
_KEY = ["sha", "xx", "chars"]  # SHA-256, verified by a second hash and the length


def _merged(runs: DataFrame) -> DataFrame:
    """One row per run and digest, sorted within the partitions."""
    merged = runs.groupBy("run", *_KEY).agg(F.min("first").alias("first"), F.sum("n").alias("n"))
    return keep(merged.sortWithinPartitions("run", "sha"))


def exact_groups(docs: DataFrame, row_id: str | None = None) -> DataFrame:
    """Groups of equal texts of ``docs`` (doc_id, text), equal after blanks are normalised.

    Returns one row per input row: doc_id, keep_id, group_size, kept, text_sha256 (and ``row_id``).
    The row with the smallest doc_id stays; a NULL doc_id comes after all others; of rows that repeat
    the same doc_id and text one stays. A NULL text counts as empty. An empty table gives an empty
    one. Other columns, whatever their names, are not read.
    """
    normal = F.regexp_replace(text_or_empty(), f"[{BLANKS}]+", " ")
    row = F.monotonically_increasing_id() if row_id is None else F.col(row_id)
    texts = docs.select(F.col("doc_id").alias("id"), row.alias("row"), normal.alias("t"))
    leaves = keep(
        texts.select(
            "id", "row", F.unhex(F.sha2("t", 256)).alias("sha"), F.xxhash64("t").alias("xx"),
            F.length("t").alias("chars"), F.spark_partition_id().alias("run"),
        )
    )
    first = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    levels = [_merged(leaves.select("run", *_KEY, first.alias("first"), F.lit(1).cast("long").alias("n")))]
    last = leaves.agg(F.max("run")).first()[0] or 0
    while last > 0:
        last //= FAN
        levels.append(_merged(levels[-1].withColumn("run", F.floor(F.col("run") / FAN).cast("int"))))
    told = levels.pop()
    while levels:
        below = levels.pop()
        up = told.select(F.col("run").alias("run_up"), *_KEY, F.col("first").alias("f"), F.col("n").alias("m"))
        joined = below.withColumn("run_up", F.floor(F.col("run") / FAN).cast("int")).join(up, ["run_up", *_KEY])
        told, old = keep(joined.select("run", *_KEY, F.col("f").alias("first"), F.col("m").alias("n"))), (told, below)
        drop(*old)
    out = leaves.join(told, ["run", *_KEY])
    return out.select(
        F.col("id").alias("doc_id"),
        F.col("first.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        *([F.col("row").alias(row_id)] if row_id else []),
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    row = fresh(docs, "row_number")
    numbered = keep(docs.withColumn(row, F.monotonically_increasing_id()))
    stays = exact_groups(numbered, row).filter("kept").select(row)
    return numbered.join(stays, row, "left_semi").drop(row)


ORACLE = f"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[{BLANKS}]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM t
"""
