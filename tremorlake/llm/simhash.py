"""Near duplicates by SimHash fingerprints, found by deletion variants of few segments.

A fingerprint has 64 bits; two link if at most three differ. Cut into two segments of 32 bits, one of them
differs by at most one bit. So each distinct fingerprint is listed, for each segment, under the segment
itself and under its 32 variants with one bit deleted; members of a list meet by an equality join, whose
condition verifies all 64 bits, so what leaves the join is links only. Under a deleted bit only members with
a 0 there meet those with a 1: the others share the undeleted segment.

A list of more than ``MANY`` members is not joined as it is. Its members agree on a segment but for one
bit, so the other segment, with at most three differing bits, is cut in two again, to 16 bits and at last to
8; a list that is crowded at 16 goes on to 8. There a list has at most 1,024 distinct fingerprints by construction.
Copies never meet: everything works on distinct fingerprints, counted from all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tremorlake.llm.common import components, drop, keep, sent, text_or_empty

WORDS = 3
SEED = 42
DIFFER = 3
MANY = 2000  # members of a list that is joined as it is
BLOCK = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: str) -> int:
    """The unsigned fingerprint of a text: a bit is 1 if over half of the shingles' hashes have it."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    width = min(WORDS, len(words))
    line, count = b" ".join(words), len(words) - width + 1
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    digest, set_bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for low in range(0, count, BLOCK):
        high = min(low + BLOCK, count)
        hashes = np.array([digest(line[s : e - 1], SEED) for s, e in zip(starts[low:high], starts[low + width : high + width])], "<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * set_bits > count).astype(np.uint8), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["doc_id", "fp"])


def _part(low: Column, width: int) -> Column:
    """``width`` bits of the fingerprint from bit ``low`` on."""
    return F.call_function("shiftrightunsigned", F.col("fp"), low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def listed(members: DataFrame, width: int) -> DataFrame:
    """(list, side, fp, low) from ``members`` (g, fp, low), whose bits from ``low`` on, 2 * ``width`` many,
    are cut in two: a list per segment (side NULL) and per variant with one bit deleted (side: that bit).
    The new ``low`` is that of the other segment, which the list says nothing about."""
    low, other = F.col("low") + F.lit(width) * F.col("half"), F.col("low") + F.lit(width) * (1 - F.col("half"))
    cut = members.withColumn("half", F.explode(F.array(F.lit(0), F.lit(1)))).select("g", "fp", "half", other.alias("other"), _part(low, width).alias("segment"))
    bits = cut.select("g", "fp", "half", F.col("other").alias("low"), "segment", F.explode(F.sequence(F.lit(-1), F.lit(width - 1))).alias("bit"))
    mask = F.when(F.col("bit") < 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest("bit", F.lit(0))))
    side = F.when(F.col("bit") >= 0, F.col("segment").bitwiseAND(mask) != 0)
    rest = F.col("segment").bitwiseAND(F.bitwise_not(mask))
    return bits.select(F.xxhash64("g", "half", "bit", rest).alias("list"), side.alias("side"), "fp", "low")


def _met(lists: DataFrame) -> DataFrame:
    """Links (a, b) among the members of each list. The join is told to shuffle: Spark sizes an exploded table as the one
    before it, 66 times too low here, and would broadcast it."""
    left = lists.filter("side is null or not side").select(F.col("list").alias("list_a"), F.col("side").alias("side_a"), F.col("fp").alias("fp_a"))
    right = lists.filter("side is null or side").select(F.col("list").alias("list_b"), F.col("side").alias("side_b"), F.col("fp").alias("fp_b"))
    close = F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= DIFFER
    once = F.col("side_a").isNotNull() | (F.col("fp_a") < F.col("fp_b"))
    return left.join(right.hint("merge"), (F.col("list_a") == F.col("list_b")) & F.col("side_a").isNull().eqNullSafe(F.col("side_b").isNull()) & once & close).select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b"))


def links(distinct: DataFrame) -> DataFrame:
    """All pairs (a, b) of the distinct fingerprints (fp) that differ by 1 to 3 bits; a pair may come several times."""
    members, found = distinct.select(F.lit(0).cast("long").alias("g"), "fp", F.lit(0).alias("low")), []
    for width in (32, 16, 8):
        lists = listed(members, width)
        crowded = None
        if width > 8:
            crowded = keep(lists.groupBy(F.col("list").alias("many")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > MANY).select("many"))
            if crowded.limit(1).count() == 0:
                drop(crowded)
                crowded = None
        if crowded is None:
            return keep(_union([*found, _met(lists)]))
        send = sent(crowded)
        found.append(_met(lists.join(send(crowded), F.col("list") == F.col("many"), "left_anti")))
        members = lists.join(send(crowded), F.col("list") == F.col("many")).select(F.col("list").alias("g"), "fp", "low")
    return keep(_union([*found, _met(lists)]))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def fingerprint_groups(docs: DataFrame) -> DataFrame:
    """Components of documents whose fingerprints differ by at most three bits.

    Returns one row per row of ``docs`` (doc_id, text): doc_id, fingerprint (16 hexadecimal digits),
    component_id (the smallest doc_id reachable). A text that is NULL, empty or blank has the fingerprint
    zero, which links like any other. Rows that repeat a doc_id are one document: they join the components
    of all their texts. A NULL doc_id stands for no document: such a row has the component of its
    fingerprint, NULL if no document is in it. An empty table gives an empty one. Other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = keep(texts.mapInArrow(_fingerprints, "doc_id long, fp long"))
    distinct = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("id")))
    near = links(distinct.select("fp"))
    several = keep(rows.filter("doc_id is not null").groupBy(F.col("doc_id").alias("same")).agg(F.min("fp").alias("a"), F.max("fp").alias("z")).filter("a <> z"))
    shared = rows.join(sent(several)(several), F.col("doc_id") == F.col("same")).filter("fp <> a").select("a", F.col("fp").alias("b")).distinct()
    roots = components(near.unionByName(shared))
    send = sent(roots)
    rooted = keep(distinct.join(send(roots), F.col("fp") == F.col("node"), "left").select(F.col("fp").alias("fp_"), "id", F.coalesce("root", "fp").alias("root")))
    least = keep(rooted.groupBy(F.col("root").alias("root_")).agg(F.min("id").alias("component_id")))
    told = keep(rooted.join(sent(least)(least), F.col("root") == F.col("root_")).select("fp_", "component_id"))
    drop(distinct, near, several, rooted, least)
    out = rows.join(sent(told)(told), F.col("fp") == F.col("fp_"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
