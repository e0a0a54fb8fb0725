"""Mixing sources to target weights by cube-method balanced sampling.

A source's target divided by its size is the expected number of copies of each of its documents. The
whole part is taken as it is; the fractional part is an inclusion probability, decided by the cube
method: a flight phase moves the probabilities of three documents at a time along the null space of
the token total and the document total, until one of them is 0 or 1. Blocks of a source fly side by
side; the two undecided documents of each block meet in the blocks of the next round. The last two of
a source are the landing problem, rounded and then mended by single flips in the last block. Only identifiers and sizes travel, never texts.
"""

from __future__ import annotations

import random
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from tremorlake.llm.common import BLANKS, drop, fresh, keep, text_or_empty
from tremorlake.scale import number_rows

BLOCK = 2048  # documents that fly together
MOST = 3.0  # no source and no document is taken more often than this


def fly(sizes: list[float], chances: list[float], rng: random.Random) -> list[float]:
    """Flight phase over one block: all but at most two chances become 0 or 1, both totals unchanged.

    Large documents come first, so that what stays undecided is small.
    """
    p = list(chances)
    waiting = sorted((i for i in range(len(p)) if 0.0 < p[i] < 1.0), key=lambda i: sizes[i])
    active: list[int] = []
    while True:
        while len(active) < 3 and waiting:
            active.append(waiting.pop())
        if len(active) < 2:
            return p
        equal = next(((i, j) for i in active for j in active if i < j and sizes[i] == sizes[j]), None)
        if equal:
            way = [(equal[0], 1.0), (equal[1], -1.0)]
        elif len(active) == 3:
            a, b, c = active
            way = [(a, sizes[b] - sizes[c]), (b, sizes[c] - sizes[a]), (c, sizes[a] - sizes[b])]
        else:
            return p
        ahead = min((1.0 - p[i]) / u if u > 0 else -p[i] / u for i, u in way)
        back = min(p[i] / u if u > 0 else (p[i] - 1.0) / u for i, u in way)
        step = ahead if rng.random() * (ahead + back) < back else -back
        for i, u in way:
            p[i] += step * u
            if p[i] < 1e-9:
                p[i] = 0.0
            elif p[i] > 1.0 - 1e-9:
                p[i] = 1.0
        active = [i for i in active if 0.0 < p[i] < 1.0]


def land(sizes: list[float], start: list[float], flown: list[float], flips: int = 32) -> list[float]:
    """The landing: 0/1 for the at most two open chances, then flips while one brings the token total nearer.

    The totals to meet are those of ``start``; of equal misses in tokens the smaller in documents wins.
    """
    p = list(flown)
    inner = [i for i, x in enumerate(start) if 0.0 < x < 1.0]
    goal, number = sum(sizes[i] * start[i] for i in inner), sum(start[i] for i in inner)
    for i in inner:
        if 0.0 < p[i] < 1.0:
            p[i] = float(p[i] >= 0.5)
    tokens, taken = sum(sizes[i] * p[i] for i in inner), sum(p[i] for i in inner)
    for _ in range(flips):
        ways = [(abs(tokens + sizes[i] * (1 - 2 * p[i]) - goal), abs(taken + 1 - 2 * p[i] - number), i) for i in inner]
        best = min(ways, default=None)
        if best is None or best[:2] >= (abs(tokens - goal), abs(taken - number)):
            break
        i = best[2]
        tokens, taken, p[i] = tokens + sizes[i] * (1 - 2 * p[i]), taken + 1 - 2 * p[i], 1.0 - p[i]
    return p


def _round(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["place", "size", "row"], kind="stable")
    sizes, chances = frame["size"].astype(float).tolist(), frame["chance"].tolist()
    first = frame.iloc[0]
    rng = random.Random(f"{first['level']}/{first['block']}/{first['place']}/{len(frame)}")
    p = fly(sizes, chances, rng)
    if first["blocks"] == 1:
        p = land(sizes, chances, p)
    return frame.assign(chance=p)


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, source_docs, target) of ``sizes`` (source, size): weights 1, 2, 3, repeating.

    Sources come by code point, NULL last. A target stops at three times its source's size; what is
    over goes to the others by weight. The common factor is found by one aggregate per step.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    ranked = number_rows(sources, [], [F.col("source").asc_nulls_last()], "rank")
    ranked = keep(ranked.select("source", "source_size", "source_docs", ((F.col("rank") - 1) % 3 + 1).alias("weight")))
    whole, weights = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    factor = (whole or 0) / (weights or 1)
    top = F.col("source_size") * MOST
    while True:
        over = F.col("weight") * F.lit(factor) > top
        capped, free = ranked.agg(F.sum(F.when(over, top).otherwise(0.0)), F.sum(F.when(over, 0).otherwise(F.col("weight")))).first()
        if not free or (new := max(factor, (whole - capped) / free)) == factor:
            break
        factor = new
    return ranked.select("source", "source_size", "source_docs", F.least(F.col("weight") * F.lit(factor), top).alias("target"))


def mix(docs: DataFrame, row_id: str | None = None) -> DataFrame:
    """How often each document of ``docs`` (doc_id, text, source) is taken so that sources meet their targets.

    Returns doc_id, size (words), source_size, target, copies (0 to 3) and taken = copies * size (and
    ``row_id``). A NULL text has size 0; documents of size 0 are taken 0 times; a NULL source is a
    source of its own, the last. Repeated rows are documents of their own. The choice depends on
    doc_id, size and source only, so reruns agree. An empty table gives an empty one. Other columns
    are not read.
    """
    words = F.regexp_count(text_or_empty(), F.lit(f"[^{BLANKS}]+")).cast("long")
    row = F.lit(0).cast("long") if row_id is None else F.col(row_id)
    sizes = keep(docs.select("doc_id", F.col("source").cast("string").alias("source"), words.alias("size"), row.alias("row")))
    aims = keep(targets(sizes))
    named = aims.withColumnRenamed("source", "source_")
    ratio = F.least(F.lit(MOST), F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    rows = (
        sizes.join(named, F.col("source").eqNullSafe(F.col("source_")))
        .withColumn("whole", F.floor(ratio).cast("long"))
        .withColumn("chance", F.when(F.col("size") > 0, ratio - F.floor(ratio)).otherwise(0.0))
        .withColumn("place", F.xxhash64("doc_id"))
        .select("doc_id", "row", "source", "size", "source_size", "target", "whole", "chance", "place", F.col("source_docs").alias("open"))
    )
    shape = T.StructType([*rows.schema.fields, T.StructField("blocks", T.LongType()), T.StructField("level", T.IntegerType()), T.StructField("block", T.LongType())])
    undecided = (F.col("chance") > 0) & (F.col("chance") < 1)
    settled, level, stays = [rows.filter(~undecided)], 0, []
    moving = rows.filter(undecided)
    while True:
        blocks = F.ceil(F.col("open") / BLOCK).cast("long")
        dealt = moving.withColumn("blocks", blocks).withColumn("level", F.lit(level))
        dealt = dealt.withColumn("block", F.pmod(F.xxhash64("place", F.lit(level)), F.col("blocks")))
        flown = keep(dealt.groupBy("source", "block").applyInPandas(_round, shape))
        stays.append(flown)
        settled.append(flown.filter(~undecided).select(*rows.columns))
        left = flown.filter(undecided)
        counts = left.groupBy(F.col("source").alias("source_")).agg(F.count(F.lit(1)).alias("now"))
        if not left.limit(1).count():
            break
        moving = left.drop("open").join(counts, F.col("source").eqNullSafe(F.col("source_"))).withColumn("open", F.col("now")).select(*rows.columns)
        level += 1
    whole = settled[0]
    for part in settled[1:]:
        whole = whole.unionByName(part)
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("chance").cast("long")).otherwise(0).cast("long")
    return whole.select(
        "doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"),
        *([F.col("row").alias(row_id)] if row_id else []),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it is taken, all columns as they were."""
    row = fresh(docs, "row_number")
    numbered = keep(docs.withColumn(row, F.monotonically_increasing_id()))
    taken = mix(numbered, row).filter(F.col("copies") > 0).select(row, "copies")
    copy = fresh(docs, "copies_taken")
    joined = numbered.join(taken.withColumnRenamed("copies", copy), row)
    again = joined.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copy))))
    return again.select(*[F.col(f"`{c}`") for c in docs.columns])
