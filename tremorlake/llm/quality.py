"""Quality classifier: supervised subword embeddings.

A word is the mean of the learned vectors of its hashed spelling and character n-grams, a document the
mean of its words (and of the word pairs that repeat a word), its label the softmax of a linear layer.
Training is plain stochastic gradient descent in numpy over a bounded sample of labelled documents.
Because the layers are linear, a trained word is one number; documents are scored word by word. Words
end at white space only and count whole, however long: also a text in a script without blanks.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tremorlake.llm.common import text_or_empty
from tremorlake.llm.toxicity import labelled, remainder

BUCKETS = 1 << 14
DIMENSIONS = 8
SAMPLE = 2500  # labelled documents of each class that the model is fitted on, at most
EPOCHS = 8
RATE = 2.0
THRESHOLD = 0.3
CACHE = 300_000  # words a worker remembers
REMEMBERED = 40  # signs of a word that is remembered; longer ones are hashed each time
PIECE = 1 << 16  # bytes hashed at once


def grams(spellings: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word number, hash bucket) of each word's spelling and its character n-grams of two to four signs.

    Whole words, in steps of about ``PIECE`` bytes: a longer word goes in pieces that overlap by three
    bytes, and each n-gram counts in the piece where it begins.
    """
    numbers, parts, whole, size = [], [], [], 0
    for number, w in enumerate(spellings):
        data = f"<{w}>".encode()
        whole.append((number, zlib.crc32(data) % BUCKETS))
        for start in range(0, len(data) - 1, PIECE):
            numbers.append(number)
            parts.append(data[start : start + PIECE + 3])
            size += len(parts[-1])
            if size >= PIECE:
                yield _hashed(numbers, parts, whole)
                numbers, parts, whole, size = [], [], [], 0
    if parts:
        yield _hashed(numbers, parts, whole)


def _hashed(numbers: list[int], parts: list[bytes], whole: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
    owner = np.repeat(np.array(numbers, np.int64), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))  # signs from here to the part's end
    own = left > np.repeat(sizes - PIECE, sizes)  # the rest begins in the next piece
    spelt = np.array(whole, np.int64).reshape(-1, 2)
    owners, found = [spelt[:, 0]], [spelt[:, 1]]
    for n in (2, 3, 4):
        value = np.full(max(0, len(data) - n + 1), n, np.uint64)
        for k in range(n):
            value = value * np.uint64(0x100000001B3) + data[k : k + len(value)]
        inside = own[: len(value)] & (left[: len(value)] >= n)
        value = (value[inside] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        owners.append(owner[: len(inside)][inside])
        found.append((value % np.uint64(BUCKETS)).astype(np.int64))
    return np.concatenate(owners), np.concatenate(found)


def gram_counts(spellings: list[str]) -> np.ndarray:
    """How many buckets ``grams`` gives for each word: of m bytes with its marks, 1 + (m - 1) + (m - 2) + (m - 3)."""
    return np.fromiter((3 * len(w.encode()) + 1 for w in spellings), np.int64, len(spellings))


def worth(spellings: list[str], odds: np.ndarray) -> np.ndarray:
    """The mean of the odds of each word's buckets."""
    total = np.zeros(len(spellings))
    for owner, bucket in grams(spellings):
        first, last = owner.min(), owner.max() + 1
        total[first:last] += np.bincount(owner - first, odds[bucket], last - first)
    return total / gram_counts(spellings)


def words(text: str) -> list[str]:
    """The words of a text; a word that repeats the one before it also gives a pair of its own."""
    found = text.split()
    return found + ["<again>"] * sum(a == b for a, b in zip(found, found[1:]))


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their weights, which sum to 1 (none for a text without words)."""
    counts = Counter(words(text))
    if not counts:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    share = np.fromiter(counts.values(), float, len(counts)) / (sum(counts.values()) * gram_counts(list(counts)))
    weight = np.zeros(BUCKETS)
    for owner, bucket in grams(list(counts)):
        weight += np.bincount(bucket, share[owner], BUCKETS)
    at = np.flatnonzero(weight)
    return at.astype(np.int32), weight[at].astype(np.float32)


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], prior: float, seed: int = 1) -> tuple[np.ndarray, float]:
    """Each bucket's part of the log odds of label 1, and the bias. Without both labels only the prior."""
    rng = np.random.default_rng(seed)
    prior_odds = float(np.log(prior / (1 - prior)))
    sizes = np.bincount([y for y, _, _ in rows], minlength=2)
    if not sizes.all():
        return np.zeros(BUCKETS), prior_odds
    vectors = rng.uniform(-0.5, 0.5, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    output, bias = rng.normal(0, 0.5, (DIMENSIONS, 2)), np.zeros(2)
    share = len(rows) / 2 / sizes  # both classes weigh the same; the prior comes in below
    steps, step = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            y, at, weight = rows[k]
            rate = RATE * (1 - step / steps) * min(2.0, share[y])
            step += 1
            mean = weight @ vectors[at]
            logits = mean @ output + bias
            chance = np.exp(logits - logits.max())
            chance /= chance.sum()
            chance[y] -= 1.0
            back = output @ chance
            output -= 0.1 * rate * np.outer(mean, chance)
            bias -= 0.02 * rate * chance
            vectors[at] -= rate * 20 * np.outer(weight, back)
    odds = vectors @ (output[:, 1] - output[:, 0])
    return odds, float(bias[1] - bias[0])


def train(docs: DataFrame, labels: DataFrame, may_learn) -> tuple[np.ndarray, float]:
    rows, prior = labelled(docs, labels, "quality", may_learn, SAMPLE)

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bag(t.as_py()) for t in batch.column(2)]
            parts = [pa.array([x[k].tobytes() for x in found], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *parts], names=["doc_id", "y", "at", "weight"])

    got = rows.mapInArrow(bags, "doc_id long, y int, at binary, weight binary").collect()
    got.sort(key=lambda r: (r["doc_id"], bytes(r["at"])))
    return fit([(r["y"], np.frombuffer(r["at"], np.int32), np.frombuffer(r["weight"], np.float32)) for r in got], prior)


def scores(docs: DataFrame, model: tuple[np.ndarray, float], name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``: 0 to 1, higher where label 1 is likelier."""
    shared = docs.sparkSession.sparkContext.broadcast((model[0].astype(np.float32), model[1]))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        odds, bias = shared.value
        known: dict[str, float] = {}
        for texts in batches:
            if len(known) > CACHE:
                known.clear()
            found = [words(text) for text in texts]
            new = list(set().union(*found).difference(known))
            values = dict(zip(new, worth(new, odds).tolist()))
            long = {w: values.pop(w) for w in new if len(w) > REMEMBERED}
            known.update(values)
            value = (lambda w: long[w] if w in long else known[w]) if long else known.__getitem__
            z = [bias + (sum(map(value, ws)) / len(ws) if ws else 0.0) for ws in found]
            out = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pd.Series(out, dtype="float64")

    return docs.withColumn(name, score(text_or_empty()))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Quality of each document of ``docs`` (doc_id, text), learnt from ``labels`` (doc_id, quality).

    Labels are learnt only where crc32(doc_id as text) mod 5 is not 0. Returns doc_id, held_out, score,
    predicted (score >= 0.3). A NULL or empty text is scored by the bias alone; a NULL doc_id is never
    held out; repeated rows are scored each; of conflicting labels the higher counts. Without labels of
    both kinds the score is the smoothed share of label 1. An empty table gives an empty one. Other
    columns are not read.
    """
    rest = remainder(5)
    scored = scores(docs.select("doc_id", "text"), train(docs, labels, rest != 0))
    return scored.select(
        "doc_id", F.coalesce(rest == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
