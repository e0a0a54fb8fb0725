"""Packing token sequences: length patterns by non-negative least squares, residuals by greedy packing.

Documents are cut into pieces of 1024 tokens and a rest. The histogram of rests (at most 1023 numbers,
whatever the corpus) is all that the plan needs: patterns of up to three lengths that fill a window
exactly are enumerated, their repeat counts solved by non-negative least squares, rounded down, and the
lengths left over packed greedily. The plan is a table of intervals, "pieces i to j of length n go to
slot s of the sequences from q on"; pieces are numbered within their length and look their slot up.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tremorlake.llm.common import drop, fresh, keep, shuffle_partitions, text_or_empty

WINDOW = 1024
END, END_ID = "<|endoftext|>", 50256  # the added special token of the vocabulary
SALT_ROWS = 200_000  # pieces numbered together
PARTNERS = 24  # frequent lengths that patterns of three are built on

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def encoder(special: bool = False):
    """Text to token ids: the ranks of the byte-level vocabulary ``byte_bpe_50k``.

    With ``special`` the literal ``<|endoftext|>`` in a text is the vocabulary's added token, as ``tokenizers``
    reads it by default; without it, it is text like any other (``encode_special_tokens``). The tests compare
    both with the ``tokenizers`` file; this library is five times faster.
    """
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    added = {END: END_ID}
    encoding = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return partial(encoding.encode, allowed_special=set(added)) if special else encoding.encode_ordinary


def _tokenised(batches: Iterator[pa.RecordBatch], special: bool = False) -> Iterator[pa.RecordBatch]:
    encode = encoder(special)
    for batch in batches:
        rows: tuple[list, ...] = ([], [], [], [], [])
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = np.array([*encode(text.as_py()), 0], dtype="<u4").tobytes()
            total = len(data) // 4
            for start in range(0, total, WINDOW):
                piece = data[start * 4 : (start + WINDOW) * 4]
                for column, value in zip(rows, (doc_id, start, len(piece) // 4, zlib.crc32(piece), total)):
                    column.append(value)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=names)


def patterns(lengths: np.ndarray, counts: np.ndarray, window: int) -> np.ndarray:
    """Combinations of one to three present lengths that fill the window exactly, as index triples (-1: none)."""
    place = np.full(window + 1, -1)
    place[lengths] = np.arange(len(lengths))
    found = {(int(place[window]), -1, -1)} if place[window] >= 0 else set()
    for i, a in enumerate(lengths):
        if a < window and place[window - a] >= i:
            found.add((i, int(place[window - a]), -1))
    for j in np.argsort(-counts, kind="stable")[:PARTNERS]:
        for i, a in enumerate(lengths):
            rest = window - a - lengths[j]
            if rest > 0 and place[rest] >= 0:
                found.add(tuple(sorted((i, int(j), int(place[rest])))))
    return np.array(sorted(found), dtype=int).reshape(-1, 3)


def solve(shape: np.ndarray, counts: np.ndarray, steps: int = 300) -> np.ndarray:
    """Repeats x >= 0 of the patterns with least squared miss of the counts, by multiplicative steps."""
    size = len(counts)
    slots = [(np.flatnonzero(shape[:, k] >= 0), shape[shape[:, k] >= 0, k]) for k in range(shape.shape[1])]

    def down(v):  # transposed: what each pattern collects from the lengths
        out = np.zeros(len(shape))
        for rows, cols in slots:
            out[rows] += v[cols]
        return out

    def up(x):  # lengths that the repeats use
        out = np.zeros(size)
        for rows, cols in slots:
            out += np.bincount(cols, x[rows], size)
        return out

    goal = down(counts.astype(float))
    x = goal / max(1, len(shape))
    for _ in range(steps):
        x *= goal / np.maximum(down(up(x)), 1e-12)
    return x


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[list[int], int]]:
    """(lengths of a sequence, repeats) so that all pieces of the histogram are used exactly once."""
    left = {n: c for n, c in histogram.items() if c > 0}
    chosen: list[tuple[list[int], int]] = []

    def use(lengths: list[int], repeats: int) -> None:
        if repeats > 0:
            chosen.append((lengths, repeats))
            for n in lengths:
                left[n] -= repeats

    lengths = np.array(sorted(left), dtype=int)
    if len(lengths):
        counts = np.array([left[n] for n in lengths])
        shape = patterns(lengths, counts, window)
        if len(shape):
            x = solve(shape, counts)
            for k in np.argsort(-x, kind="stable"):
                own = [int(lengths[i]) for i in shape[k] if i >= 0]
                use(own, min(int(x[k]), *(left[n] // own.count(n) for n in own)))
    order = sorted((n for n in left if left[n]), reverse=True)
    while order:
        own: list[int] = []
        space = window
        for n in order:
            fit = min(space // n, left[n])
            own += [n] * fit
            space -= n * fit
        use(own, min(left[n] // own.count(n) for n in set(own)))
        order = [n for n in order if left[n]]
    return chosen


def slots(chosen: list[tuple[list[int], int]]) -> np.ndarray:
    """Rows (length, first piece, first sequence, offset), sorted by length and first piece."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, repeats in chosen:
        offset = 0
        for n in lengths:
            rows.append((n, used.get(n, 0), sequence, offset))
            used[n] = used.get(n, 0) + repeats
            offset += n
        sequence += repeats
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def pack(docs: DataFrame, special: bool = False) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most 1024 tokens.

    Returns per piece doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A NULL or empty
    text is one piece with the closing id 0 alone. Repeated rows are packed each; a NULL doc_id stays
    NULL. An empty table gives an empty one. Other columns are not read. With ``special`` the literal
    ``<|endoftext|>`` in a text is one id, 50256.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    pieces = keep(texts.mapInArrow(partial(_tokenised, special=special), _PIECES))
    rows = pieces.count()
    salts = max(shuffle_partitions(docs.sparkSession), -(-rows // SALT_ROWS))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)))
    sizes = keep(salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")))
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    where = slots(plan(histogram))
    keys = where[:, 0] << 44 | where[:, 1]

    def seated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            at = np.searchsorted(keys, length << 44 | number, side="right") - 1
            columns = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            columns += [pa.array(where[at, 2] + number - where[at, 1]), pa.array(where[at, 3])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    earlier = W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    before = keep(sizes.select("length", "salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    inside = F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")) - 1
    numbered = salted.withColumn("inside", inside).join(before, ["length", "salt"])
    numbered = numbered.withColumn("number", (F.col("inside") + F.col("before")).cast("long"))
    numbered = numbered.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "number")
    return numbered.mapInArrow(seated, _PIECES + ", sequence_id long, offset long")
