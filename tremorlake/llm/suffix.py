"""Removal of repeated passages by prefix doubling over sampled positions.

A passage is a 400-byte window that starts at two places at least. Ranking every position at every
doubling would move the corpus many times over, so the ranks start from sampled positions: of the 337
64-byte prefixes inside a window the one with the smallest hash is its anchor, a choice that equal
windows share. Every window belongs to exactly one anchor, and an anchor's windows are one run of starts.
Spark then ranks at growing lengths, and what is unique leaves:

* 64 bytes: anchors whose rank is unique have no repeated window;
* the anchor's whole run: if the text from its first window's start to its last window's end is there
  twice, all its windows repeat, and occurrences with equal runs go on as one;
* runs that differ: blocks of 16 starts, by the 385 bytes that all windows of a block share, and again
  by the block's whole run;
* 400 bytes: each window of the blocks that are left.

Ranks are content digests, equal for equal bytes wherever they are computed, so no rank needs a numbering of all
positions, and groups of any size are only counted, in two steps. What decides that bytes go, the rank of a whole run
or of a window, is a 128-bit BLAKE2b digest of these very bytes. Running-sum hashes modulo 2**64, which built
texts can make collide, choose anchors and gather what is worth a comparison; there a collision costs work, not text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tremorlake.llm.common import drop, keep, text_or_empty

PASSAGE = 400
FIRST = 64
BLOCK = 16
SEGMENT = 1 << 20  # window starts that are hashed together

_RNG = np.random.default_rng(11)
_SIGNS = _RNG.integers(0, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = [int(x) | 1 for x in _RNG.integers(2**40, 2**62, 2, dtype=np.uint64) * np.uint64(4) + np.uint64(5)]


class _Powers:
    """Powers of a base modulo 2**64, grown as needed."""

    def __init__(self, base: int):
        self.base, self.values = np.uint64(base), np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            steps = np.full(max(n, 4096), self.base, np.uint64)
            steps[0] = 1
            self.values = np.cumprod(steps, dtype=np.uint64)
        return self.values[:n]


_POWERS = [(_Powers(base), _Powers(pow(base, -1, 2**64))) for base in _BASES]


class Hashes:
    """Hashes of any stretch of some bytes, from running sums modulo 2**64."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums, self.back = [], []
        for signs, (powers, back) in zip(_SIGNS, _POWERS):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(signs[data] * powers.upto(n), dtype=np.uint64, out=sums[1:])
            self.sums.append(sums)
            self.back.append(back.upto(n + 1))

    def of(self, start, end, k: int) -> np.ndarray:
        """The k-th hash (0 or 1) of the stretches from ``start`` to ``end``, mixed."""
        value = (self.sums[k][end] - self.sums[k][start]) * self.back[k][start]
        value ^= value >> np.uint64(29)
        value *= np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(32)
        return value



def digests(raw: bytes, starts: np.ndarray, ends: np.ndarray, marks: np.ndarray) -> list[bytes]:
    """Digests of the stretches of ``raw``, each with a mark of what it stands for."""
    make = hashlib.blake2b
    return [make(raw[s:e] + m.to_bytes(4, "little"), digest_size=16).digest() for s, e, m in zip(starts.tolist(), ends.tolist(), marks.tolist())]


def anchors(hashes: Hashes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor positions with the first and last start of their windows."""
    starts = n - PASSAGE + 1
    if starts <= 0:
        return (np.empty(0, np.int64),) * 3
    at = np.arange(n - FIRST + 1)
    first = hashes.of(at, at + FIRST, 0)
    width = PASSAGE - FIRST + 1
    # leftmost smallest of each stretch of ``width``: pairs (hash, place) as the hash's top bits and a place
    blocks = -(-len(first) // width)
    padded = np.full(blocks * width, np.uint64(2**64 - 1))
    padded[: len(first)] = first
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    small = np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts])
    # the place: the first position at or after the start whose hash is that minimum
    hits = np.flatnonzero(_is_minimum(first, small, starts, width))
    chosen = _leftmost(first, small, hits, starts)
    edge = np.flatnonzero(np.diff(chosen)) + 1
    low = np.concatenate([[0], edge])
    high = np.concatenate([edge - 1, [starts - 1]])
    return chosen[low], low, high


def _is_minimum(first: np.ndarray, small: np.ndarray, starts: int, width: int) -> np.ndarray:
    """Whether a position is the smallest of any of the windows that hold it: of the minima over these the largest."""
    reach = np.full(len(first), 0, np.uint64)
    reach[:starts] = small
    blocks = -(-(len(first) + width - 1) // width)
    padded = np.zeros(blocks * width, np.uint64)
    padded[width - 1 : width - 1 + len(first)] = reach
    grid = padded.reshape(blocks, width)
    ahead = np.maximum.accumulate(grid, axis=1).reshape(-1)
    behind = np.maximum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    at = np.arange(len(first))
    return first <= np.maximum(behind[at], ahead[at + width - 1])


def _leftmost(first: np.ndarray, small: np.ndarray, hits: np.ndarray, starts: int) -> np.ndarray:
    """For each window start the leftmost position with the window's smallest hash."""
    order = np.lexsort((hits, first[hits]))
    values, places = first[hits][order], hits[order]
    names, begin = np.unique(values, return_index=True)
    group = np.searchsorted(names, small)
    size = np.append(begin, len(values))
    # positions of one value are sorted: search the window's start among them by one combined key
    rank = np.searchsorted(names, values)
    span = np.int64(len(first) + 1)
    key = rank * span + places
    return places[np.searchsorted(key, group * span + np.arange(starts))]


def _rows(names: list[str], rows: list[list]) -> pa.RecordBatch:
    """Columns from lists of arrays (those of bytes: of lists)."""
    columns = [pa.array([k for part in c for k in part], pa.binary()) if c and isinstance(c[0], list) else pa.array(np.concatenate(c)) for c in rows]
    return pa.RecordBatch.from_arrays(columns, names=names)


_RUNS = ["id", "none", "text_key", "pos", "lo", "hi", "a", "r"]
_RUN_TYPES = "id long, none boolean, text_key binary, pos int, lo int, hi int, a long, r binary"


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors of each text (id, none, text_key, text): rank ``a`` of their 64 bytes, rank ``r`` of their whole run."""
    for batch in batches:
        rows: list[list] = [[] for _ in _RUNS]
        for name, none, key, text in zip(*(batch.column(c).to_pylist() for c in range(3)), batch.column(3)):
            raw = text.as_py().encode()
            data = np.frombuffer(raw, np.uint8)
            if len(data) < PASSAGE:
                continue
            for base in range(0, len(data) - PASSAGE + 1, SEGMENT):
                part = data[base : base + SEGMENT + PASSAGE - 1]
                hashes = Hashes(part)
                pos, lo, hi = anchors(hashes, len(part))
                run = digests(raw, lo + base, hi + base + PASSAGE, pos - lo)  # another anchor place is another run
                first = hashes.of(pos, pos + FIRST, 0).view(np.int64)
                places = [(x + base).astype(np.int32) for x in (pos, lo, hi)]
                many = len(pos)
                for column, values in zip(rows, (np.full(many, name, np.int64), np.full(many, none), [key] * many, *places, first, run)):
                    column.append(values)
        if rows[0]:
            yield _rows(_RUNS, rows)


def _nodes_of(batch: pa.RecordBatch) -> Iterator[tuple[int, bool, bytes, bytes, np.ndarray]]:
    """(id, none, text_key, bytes, nodes) of the rows."""
    for name, none, key, text, nodes in zip(*(batch.column(c) for c in ("id", "none", "text_key", "text", "nodes"))):
        table = nodes.values.flatten()
        yield name.as_py(), none.as_py(), key.as_py(), text.as_py().encode(), np.column_stack([c.to_numpy(zero_copy_only=False) for c in table]).astype(np.int64)


def _segments(data: np.ndarray, nodes: np.ndarray, first: int) -> Iterator[tuple[int, Hashes, np.ndarray]]:
    """Hashes of stretches of bounded length, with the nodes whose column ``first``, their first start, is there."""
    for base in np.unique(nodes[:, first] // SEGMENT) * SEGMENT:
        own = nodes[nodes[:, first] // SEGMENT * SEGMENT == base]
        yield int(base), Hashes(data[base : base + SEGMENT + 3 * PASSAGE]), own


_BLOCKS = ["id", "none", "text_key", "lo", "hi", "a", "r", "open"]
_BLOCK_TYPES = "id long, none boolean, text_key binary, lo int, hi int, a long, r binary, open boolean"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per block of starts of each node (pos, lo, hi, open): ranks of the bytes that all windows share, and of its run."""
    for batch in batches:
        rows: list[list] = [[] for _ in _BLOCKS]
        for name, none, key, raw, nodes in _nodes_of(batch):
            for base, hashes, own in _segments(np.frombuffer(raw, np.uint8), nodes, 1):
                near, far = (own[:, 0] - own[:, 2]) // BLOCK, (own[:, 0] - own[:, 1]) // BLOCK  # blocks count distances before the anchor
                many = far - near + 1
                node = np.repeat(np.arange(len(own)), many)
                block = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + near[node]
                pos = own[node, 0]
                core = pos - block * BLOCK - base
                lo, hi = np.maximum(own[node, 1], pos - block * BLOCK - BLOCK + 1), np.minimum(own[node, 2], pos - block * BLOCK)
                a = hashes.of(core, core + PASSAGE - BLOCK + 1, 0).view(np.int64)
                r = digests(raw, lo, hi + PASSAGE, (pos - lo) * BLOCK * 64 + block)
                many = len(node)
                parts = (np.full(many, name, np.int64), np.full(many, none), [key] * many, lo.astype(np.int32), hi.astype(np.int32), a ^ (block * 0x9E3779B1), r, own[node, 3] > 0)
                for column, values in zip(rows, parts):
                    column.append(values)
        if rows[0]:
            yield _rows(_BLOCKS, rows)


_WINDOWS = ["text_key", "lo", "w", "open"]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per window of each node (lo, hi, open)."""
    for batch in batches:
        rows: list[list] = [[] for _ in _WINDOWS]
        for _, _, key, raw, nodes in _nodes_of(batch):
            many = nodes[:, 1] - nodes[:, 0] + 1
            node = np.repeat(np.arange(len(nodes)), many)
            start = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + nodes[node, 0]
            w = digests(raw, start, start + PASSAGE, np.zeros(len(start), np.int64))
            for column, values in zip(rows, ([key] * len(start), start.astype(np.int32), w, nodes[node, 2] > 0)):
                column.append(values)
        if rows[0]:
            yield _rows(_WINDOWS, rows)


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    for batch in batches:
        rows: list[list] = [[] for _ in names]
        for doc_id, text, runs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            data = text.as_py().encode()
            runs = sorted((run["lo"], run["hi"] + PASSAGE) for run in runs.as_py() or [])
            kept, removed, spans, end = [], 0, 0, -1
            for low, high in runs:
                if low > end:
                    kept.append(data[max(end, 0) : low])
                    spans, removed, end = spans + 1, removed + high - low, high
                elif high > end:
                    removed, end = removed + high - end, high
            kept.append(data[max(end, 0) :])
            for column, value in zip(rows, (doc_id, len(data), removed, spans, hashlib.sha256(b"".join(kept)).hexdigest())):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=names)


def _level(found: DataFrame, shared: list[str], run: list[str], node: list[str], open_) -> tuple[DataFrame, DataFrame]:
    """Runs that are there twice, and the distinct runs to look into (id, none, text_key, nodes).

    ``shared`` ranks what all windows of a run have in common, ``run`` all of it. To look into are the
    runs of a shared rank that has several runs, one of them there once and ``open``.
    """
    one = F.struct("none", "id", "text_key", *node)
    runs = keep(found.groupBy(*shared, *run).agg(F.count(F.lit(1)).alias("n"), F.min(one).alias("one"), F.max(open_).alias("any")))
    twice = keep(runs.filter("n > 1").select(*shared, *run))
    whole = found.filter(open_).join(twice, [*shared, *run]).select("text_key", "lo", "hi")
    alone = (F.col("n") == 1) & F.col("any")
    mixed = runs.groupBy(*shared).agg(F.count(F.lit(1)).alias("kinds"), F.max(alone).alias("alone")).filter("kinds > 1 and alone").select(*shared)
    nodes = runs.join(keep(mixed), shared).select("one.*", alone.cast("int").alias("look"))
    listed = nodes.groupBy("id", "none", "text_key").agg(F.collect_list(F.struct(*node, "look")).alias("nodes"))
    out = keep(whole.distinct()), keep(listed)
    drop(runs, twice)
    return out


_OWN = ["id", "none", "text_key"]


def repeated_starts(texts: DataFrame) -> DataFrame:
    """Runs (text_key, lo, hi) of window starts whose 400 bytes also start elsewhere; ``texts``: doc_id, text, text_key.

    A row is told by its doc_id, whether it has one, and its text; rows that are equal in all of these
    are one where their text is looked into again.
    """
    named = texts.select(F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"), F.col("doc_id").isNull().alias("none"), "text_key", "text")
    found = keep(named.mapInArrow(_anchored, _RUN_TYPES))
    whole, listed = _level(found, ["a"], ["r"], ["pos", "lo", "hi"], F.lit(True))
    drop(found)
    once = named.dropDuplicates(_OWN)
    blocks = keep(once.join(listed, _OWN).select(*_OWN, "text", "nodes").mapInArrow(_blocks, _BLOCK_TYPES))
    drop(listed)
    parts, listed = _level(blocks, ["a"], ["r"], ["lo", "hi"], F.col("open"))
    drop(blocks)
    windows = keep(once.join(listed, _OWN).select(*_OWN, "text", "nodes").mapInArrow(_windows, "text_key binary, lo int, w binary, open boolean"))
    again = keep(windows.groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w"))
    single = windows.filter("open").join(again, "w").select("text_key", "lo", F.col("lo").alias("hi"))
    return whole.unionByName(parts).unionByName(single)


def without_repeats(docs: DataFrame) -> DataFrame:
    """What stays of each text when every byte of a repeated 400-byte passage is removed.

    ``docs`` (doc_id, text) are judged as UTF-8 bytes, overlaps count, and the same passage twice in one
    text is a repeat. Returns per row doc_id, n_bytes, n_removed, n_spans, kept_sha256. A NULL text is
    empty; texts below 400 bytes stay; repeated rows are copies of each other, so all their passages go;
    a NULL doc_id is kept as it is. An empty table gives an empty one. Other columns are not read.
    """
    key = F.unhex(F.substring(F.sha2("text", 256), 1, 32)).alias("text_key")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).select("doc_id", "text", key)
    runs = keep(repeated_starts(texts).groupBy(F.col("text_key").alias("key")).agg(F.collect_set(F.struct("lo", "hi")).alias("runs")))
    marked = texts.join(runs, F.col("text_key") == F.col("key"), "left")
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return marked.select("doc_id", "text", "runs").mapInArrow(_removed, out)
