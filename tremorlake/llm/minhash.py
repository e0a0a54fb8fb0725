"""Near duplicates by a signature-coordinate inverted join.

A document's set of five-word shingles gets a MinHash signature of 32 coordinates; texts of equal sets
are one class. Every class is posted under its coordinate-value pairs. Two classes are candidates if at
least 12 of the 32 coordinates agree: at a similarity of 0.75 a pair misses that less than once in
100,000 times. Therefore (prefix) a class needs posting only under its 21 rarest pairs, and (skip) its
11 longest lists are never merged; pairs that occur once are no lists at all.

Lists are not expanded into pairs. In each list the member whose pairs are the most common (a template,
if there is one) leads and is compared with all others; a second leader follows among those that are not
in the first one's component. After that only members of different components matter. They pass an exact
bound inside the join: every document carries the parity of its shingles in 512 buckets, and as many
shingles differ as buckets do, at least; a link allows one seventh of both sizes to differ. So the pairs
that leave the join are nearly all links between components. Lists of very many open members are first
posted again under a second coordinate, with the same prefix rule. Links are confirmed on the full
shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tremorlake.llm.common import components, drop, fresh, keep, sent, text_or_empty

COORDINATES = 32
MATCHES = 12
WORDS = 5
ROUNDS = 2  # leaders of a list before what is open is compared by the bound
MANY = 2000  # members of an open list, from which it is posted under a second coordinate
BUCKETS = 8  # of 64 bits each, in the parity bitmap
BITMAP_WORDS = 1 << 20  # of 64 bits, in a bitmap of identifiers
CACHE = 300_000  # words a worker remembers
BLOCK = 1024  # shingles hashed at once under all coordinates

_RNG = np.random.default_rng(7)
_SEEDS = _RNG.integers(0, 2**63, COORDINATES, dtype=np.uint64)
_FACTORS = _RNG.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _RNG.integers(0, 2**63, WORDS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str, words: _Words) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's five-word shingles; of fewer words, one for them all."""
    parts = text.encode().lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    if len(words) > CACHE:
        words.clear()
    hashed = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    width = min(WORDS, len(parts))
    mixed = np.full(len(parts) - width + 1, width, np.uint64) * _PLACES[WORDS]
    for k in range(width):
        mixed += hashed[k : len(parts) - width + 1 + k] * _PLACES[k]
    mixed ^= mixed >> np.uint64(31)
    mixed *= _PLACES[WORDS]
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def signature(found: np.ndarray) -> np.ndarray:
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(found), BLOCK):
        values = (found[start : start + BLOCK, None] ^ _SEEDS) * _FACTORS
        values ^= values >> np.uint64(32)
        values *= _FACTORS
        np.minimum(low, values.min(axis=0), out=low)
    return low.view(np.int64)


def parities(found: np.ndarray) -> np.ndarray:
    """One bit a bucket: whether an odd number of the shingles fall into it."""
    odd = np.bincount((found >> np.uint64(17)) % np.uint64(64 * BUCKETS), minlength=64 * BUCKETS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    words = _Words()
    for batch in batches:
        sizes, keys, signatures, bits = [], [], [], []
        for text in batch.column(1):
            found = shingles(text.as_py(), words)
            sizes.append(len(found))
            keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            signatures.append(signature(found) if len(found) else None)
            bits.append(parities(found) if len(found) else None)
        columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "key", "sig", "bits"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    words = _Words()
    for batch in batches:
        found = [shingles(text.as_py(), words).tobytes() for text in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(f) for f in found], pa.binary()), pa.array(found, pa.binary())], names=["key", "found"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose full sets have a similarity of 0.75 or more."""
    for batch in batches:
        linked = []
        for left, right in zip(batch.column(2), batch.column(3)):
            a, b = (np.frombuffer(x.as_py(), np.uint64) for x in (left, right))
            common = len(np.intersect1d(a, b, assume_unique=True))
            linked.append(100 * common >= 75 * (len(a) + len(b) - common))
        out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"])
        yield out.filter(pa.array(linked, pa.bool_()))


def posted(members: DataFrame, need: int) -> DataFrame:
    """Lists (g, id, weight) from ``members`` (g, id, sig): within a list of ``members`` two that agree on
    ``need`` coordinates share at least one of the new lists. ``weight`` is the commonness of a member's pairs."""
    pairs = members.select("g", "id", F.posexplode("sig").alias("k", "v")).select(F.xxhash64("g", "k", "v").alias("h"), "g", "id")
    common = keep(pairs.groupBy("h").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"))
    own = pairs.join(common, "h").groupBy("g", "id").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("own"))
    own = own.filter(F.size("own") >= need)
    weight = F.aggregate("own", F.lit(0).cast("long"), lambda s, x: s + x["df"])
    lists = keep(own.select("id", weight.alias("weight"), F.explode(F.slice("own", 1, F.size("own") - (need - 1))).alias("x")).select(F.col("x.h").alias("g"), "id", "weight"))
    drop(common)
    return lists


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def within_bound(a: str, b: str) -> Column:
    """Whether the sizes and bitmaps of two classes (columns n, bits with these endings) allow a link."""
    n, m = F.col(f"n{a}"), F.col(f"n{b}")
    differ = sum((F.bit_count(F.get(f"bits{a}", F.lit(k)).bitwiseXOR(F.get(f"bits{b}", F.lit(k)))) for k in range(BUCKETS)), F.lit(0))
    return (4 * F.least(n, m) >= 3 * F.greatest(n, m)) & (7 * differ <= n + m)


def of_some(texts: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of ``texts`` (doc_id, text) whose doc_id is in ``docs`` (doc_id, a written table).

    Many identifiers are first sent as a bitmap of their hashes, of a fixed size, so that the texts of others need no shuffle.
    """
    send = sent(docs)
    exact = docs.select(F.col("doc_id").alias("wanted_id"))
    if send is not F.broadcast:
        place = F.pmod(F.xxhash64("doc_id"), F.lit(64 * BITMAP_WORDS))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
        marks = F.broadcast(docs.groupBy(F.floor(place / 64).alias("word")).agg(F.bit_or(bit).alias("marks")))
        texts = texts.join(marks, (F.floor(place / 64) == F.col("word")) & (F.col("marks").bitwiseAND(bit) != 0)).select(*texts.columns)
    return texts.join(send(exact), F.col("doc_id") == F.col("wanted_id"), "left_semi")


class _Links:
    """Candidate pairs of classes compared on the full sets, and the components of all links so far."""

    def __init__(self, texts: DataFrame, classes: DataFrame, shared: DataFrame):
        """``shared``: classes (a, b) with a document in common, linked from the start."""
        self.texts, self.classes = texts, classes
        self.roots = keep(components(shared))
        self.send = sent(self.roots)

    def compare(self, pairs: DataFrame) -> None:
        """Bring the components up to date with the links among ``pairs`` (a, b)."""
        side = self.classes.select("id", "n", "sig", "bits")
        left, right = (side.select(*[F.col(c).alias(f"{c}_{s}") for c in side.columns]) for s in "ab")
        same = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda x, y: x == y), lambda x: x))
        some = pairs.distinct().join(left, F.col("a") == F.col("id_a")).join(right, F.col("b") == F.col("id_b"))
        some = keep(some.filter(within_bound("_a", "_b") & (same >= MATCHES)).select("a", "b"))
        wanted = some.select(F.col("a").alias("id")).unionByName(some.select(F.col("b").alias("id"))).distinct()
        wanted = keep(wanted.join(self.classes.select("id", "key", "doc"), "id"))
        docs = keep(wanted.select(F.col("doc").alias("doc_id")).distinct())
        sets = of_some(self.texts, docs).select("text").mapInArrow(_sets, "key binary, found binary").dropDuplicates(["key"])  # a document may have other texts
        sets = keep(wanted.select("id", F.col("key").alias("key_")).join(sets, F.col("key_") == F.col("key")).select("id", "found"))
        full = some.join(sets.select(F.col("id").alias("a"), F.col("found").alias("fa")), "a").join(sets.select(F.col("id").alias("b"), F.col("found").alias("fb")), "b")
        links = keep(full.select("a", "b", "fa", "fb").mapInArrow(_linked, "a long, b long"))
        self.merge(links)
        drop(some, wanted, docs, sets, links)

    def merge(self, links: DataFrame) -> None:
        """Bring the components up to date: only links between different components are worked on."""
        known = self.roots
        left, right = (self.send(known.select(F.col("node").alias(f"n{s}"), F.col("root").alias(f"r{s}"))) for s in "ab")
        joined = links.join(left, F.col("a") == F.col("na"), "left").join(right, F.col("b") == F.col("nb"), "left")
        joined = joined.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).filter("a <> b")
        new = keep(joined.distinct())
        if _some(new):
            merged = keep(components(new))
            moved = sent(merged)(merged.select(F.col("node").alias("old"), F.col("root").alias("new")))
            old = known.join(moved, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root"))
            self.roots = keep(old.unionByName(merged.join(self.send(known.select("node")), "node", "left_anti").select("node", "root")))
            self.send = sent(self.roots)
            drop(known, merged)
        drop(new)

    def lead(self, lists: DataFrame) -> DataFrame:
        """One round: the leader of each list against its ``left`` members. Returns the lists that are still
        open, where members in the leader's component are no longer ``left``."""
        top = F.max(F.when(F.col("left"), F.struct("weight", F.negative("id").alias("minus"))))
        led = keep(lists.join(lists.groupBy(F.col("g").alias("g_")).agg(F.negative(top["minus"]).alias("lead")), F.col("g") == F.col("g_")).drop("g_"))
        self.compare(led.filter("left and id <> lead").select(*_ordered(F.col("id"), F.col("lead"))))
        rooted = self.rooted(led)
        its = self.send(self.roots.select(F.col("node").alias("lead"), F.col("root").alias("lead_root")))
        left = F.col("left") & (F.col("root") != F.coalesce("lead_root", "lead"))
        still = self.open(rooted.join(its, "lead", "left").select("g", "id", "weight", left.alias("left"), "root"))
        drop(led)
        return still

    def rooted(self, lists: DataFrame) -> DataFrame:
        """``lists`` with the component of each member so far."""
        known = self.send(self.roots.select(F.col("node").alias("id"), "root"))
        return lists.drop("root").join(known, "id", "left").withColumn("root", F.coalesce("root", "id"))

    def open(self, rooted: DataFrame) -> DataFrame:
        """The lists whose members lie in several components, with the number of their members."""
        rooted = keep(rooted)
        several = rooted.groupBy(F.col("g").alias("g_")).agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("members")).filter("lo < hi")
        still = keep(rooted.drop("members").join(several.select("g_", "members"), F.col("g") == F.col("g_")).drop("g_"))
        drop(rooted)
        return still


def _some(df: DataFrame) -> bool:
    return df.limit(1).count() > 0


def near_groups(docs: DataFrame) -> DataFrame:
    """Components of documents linked by a shingle similarity of 0.75 or more.

    Returns one row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept. A text
    without words, or NULL, has an empty set, is linked with nothing and stays. A NULL doc_id stands
    for no other row: such a row takes the component of an equal set that has an identifier, else
    NULL, and is not kept. Rows that repeat a doc_id are one node, linked through any of their texts. An empty table gives an empty one.
    Other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = keep(texts.mapInArrow(_features, "doc_id long, n long, key binary, sig array<long>, bits array<long>"))
    some = rows.filter("n > 0 and doc_id is not null")
    found = some.groupBy("key").agg(F.min(F.struct(F.col("doc_id").alias("doc"), "n", "sig", "bits")).alias("x"))
    classes = keep(found.select("key", "x.*", F.monotonically_increasing_id().alias("id")))  # numbered as written
    several = some.groupBy(F.col("doc_id").alias("same")).agg(F.min("key").alias("lo"), F.max("key").alias("hi")).filter("lo <> hi")
    numbers = classes.select(F.col("key").alias("key_"), "id")
    texts_of = keep(some.join(several, F.col("doc_id") == F.col("same")).select("same", "key").distinct().join(numbers, F.col("key") == F.col("key_")).select("same", "id"))
    first = texts_of.groupBy(F.col("same").alias("same_")).agg(F.min("id").alias("a"))
    shared = texts_of.join(first, F.col("same") == F.col("same_")).filter("id <> a").select("a", F.col("id").alias("b"))
    links = _Links(texts.filter("doc_id is not null"), classes, shared)
    posts = posted(classes.select(F.lit(0).cast("long").alias("g"), "id", "sig"), MATCHES)
    lists = posts.withColumn("left", F.lit(True))
    for _ in range(ROUNDS):
        still = links.lead(lists)
        drop(posts)
        lists = posts = still
    crowded = lists.filter(F.col("members") > MANY).select("g", "id")
    if _some(crowded):
        again = posted(crowded.join(classes.select("id", "sig"), "id").select("g", "id", "sig"), MATCHES)  # the list's own coordinate is one of them
        lists = links.open(links.rooted(again.select("g", "id").unionByName(lists.filter(F.col("members") <= MANY).select("g", "id"))))
        drop(again, posts)
    side = lists.select("g", "id", "root").join(classes.select("id", "n", "bits"), "id")
    one, two = (side.select(*[F.col(c).alias(f"{c}_{s}") for c in side.columns]) for s in "xy")
    pairs = one.join(two, (F.col("g_x") == F.col("g_y")) & (F.col("id_x") < F.col("id_y")) & (F.col("root_x") != F.col("root_y")) & within_bound("_x", "_y"))
    last = keep(pairs.select(F.col("id_x").alias("a"), F.col("id_y").alias("b")).distinct())
    if _some(last):
        links.compare(last)
    roots = links.send(links.roots.select(F.col("node").alias("id"), "root"))
    rooted = keep(classes.select("key", "id", "doc").join(roots, "id", "left").select("key", "doc", F.coalesce("root", "id").alias("root")))
    least = rooted.groupBy(F.col("root").alias("root_")).agg(F.min("doc").alias("component"))
    told = keep(rooted.join(least, F.col("root") == F.col("root_")).select(F.col("key").alias("key_"), "component"))
    drop(lists, last, texts_of, classes, links.roots, rooted)
    out = rows.select("doc_id", "n", "key").join(told, F.col("key") == F.col("key_"), "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, all columns as they were.

    The smallest doc_id of a component stays; rows that repeat a doc_id stay or go together, and rows
    without one stay.
    """
    goes = near_groups(docs).filter("not kept and doc_id is not null").select("doc_id").distinct()
    name = fresh(docs, "dropped_id")
    return docs.join(goes.withColumnRenamed("doc_id", name), F.col("doc_id") == F.col(name), "left_anti")
