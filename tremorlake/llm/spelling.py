"""Groups of spelling variants by blocked Gram matrices of letter counts.

One inserted, deleted or replaced letter moves a word's vector of letter counts by a squared distance of at
most two. So NumPy products of blocks of such vectors, |a|^2 + |b|^2 - 2 a.b, leave the pairs that can be near, and their
edits are verified. Blocks are cut so that a product is only made where it can find something: letters fall into five
classes, and a word's cell is its number of letters of each class (their sum is its length, so a cell lies in
one length block). An edit leaves the cell, or moves one letter in or out of a class, or from a class to another: a word
visits the cells with one more letter of a class (the next length block), and those with a letter of one
class exchanged for one of a later class. So every pair of words that may be near meets in exactly one cell. Of a cell with
many words every block meets every block, each pair of blocks as a task of bounded size.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tremorlake.llm.common import drop, keep, sent, text_or_empty

LETTERS = 6  # of a word, at least
TIMES = 5  # a word occurs, at least; and its form that many times as often
ONE_IN = 199  # planted slips
CLASSES = 5
BLOCK = 1024  # words on each side of a product
FLUSH = 200_000  # distinct words that a task counts before it hands them on

_RUN = re.compile("[a-z\u00C0-\u00FF]+")
_ALPHABET = 26 + 0x40  # a to z, U+00C0 to U+00FF


def _counted(planted: bool):
    """Partial counts (word, n) of the words of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        counts: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                lowered = text.as_py().encode().lower().decode()  # bytes: only A-Z
                slips = planted and doc_id is not None
                begin = zlib.crc32(f"{doc_id}:".encode())
                for word, n in Counter(_RUN.findall(lowered)).items():
                    if slips and (h := zlib.crc32(word.encode(), begin)) % ONE_IN == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= LETTERS:
                        counts[word] += n
                if len(counts) > FLUSH:
                    yield out()
                    counts.clear()
        yield out()

    return run


def word_counts(docs: DataFrame, planted: bool = False) -> DataFrame:
    """(word, n) of the words of at least six letters that occur five times at least in ``docs`` (doc_id, text).

    ``planted``: first drop a letter of one run in 199, told by crc32 of '<doc_id>:<run>'; rows without doc_id stay as they are.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    counts = texts.mapInArrow(_counted(planted), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= TIMES)


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all words one after another, as numbers below ``_ALPHABET``, and the word of each."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    return np.where(letters < 0xC0, letters - ord("a"), letters - 0xC0 + 26), np.repeat(np.arange(len(words)), sizes)


def letter_counts(words: list[str], columns: int = _ALPHABET) -> np.ndarray:
    letters, owner = code_points(words)
    return np.bincount(owner * columns + letters % columns, minlength=len(words) * columns).reshape(-1, columns)


def _visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word at home in its cell and as a visitor in the cells that it may have a near word in."""
    names = ["cell", "home", "word", "n"]
    for batch in batches:
        words = batch.column(0).to_pylist()
        if not words:
            continue
        own = letter_counts(words, CLASSES)
        moves = [np.zeros(CLASSES, np.int64)]
        eye = np.eye(CLASSES, dtype=np.int64)
        moves += [eye[k] for k in range(CLASSES)] + [eye[k] - eye[m] for k in range(CLASSES) for m in range(k)]
        cells, kept = [], []
        for move in moves:
            cell = own + move
            valid = (cell >= 0).all(axis=1)
            cells += [",".join(map(str, row)) for row in cell[valid].tolist()]
            kept.append(np.flatnonzero(valid))
        index = pa.array(np.concatenate(kept))
        home = np.arange(len(index)) < len(words)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.string()), pa.array(home), batch.column(0).take(index), batch.column(1).take(index)], names=names)


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one letter is inserted, deleted or replaced between two different words."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


_NEAR = "word string, n long, n_near long, best_n long, best string"


def _near(table: pa.Table) -> pa.Table:
    """The near pairs between the words at home in a block and the words of another block of the same cell or its
    visitors, as partial results of each word: how many near words, and the most frequent of them."""
    homes = table.filter(table.column("home_side"))
    others = table.filter(pa.compute.invert(table.column("home_side")))
    a, b = homes.column("word").to_pylist(), others.column("word").to_pylist()
    an, bn = homes.column("n").to_pylist(), others.column("n").to_pylist()
    same_cell = others.column("home").to_pylist()
    near: dict[str, list] = {}

    def add(word: str, n: int, other: str, m: int) -> None:
        got = near.setdefault(word, [n, 0, m, other])
        got[1] += 1
        if (-m, other) < (-got[2], got[3]):
            got[2:] = m, other

    if a and b:
        left, right = letter_counts(a).astype(float), letter_counts(b).astype(float)
        apart = (left**2).sum(axis=1)[:, None] + (right**2).sum(axis=1)[None, :] - 2 * (left @ right.T)
        for i, k in zip(*(x.tolist() for x in np.nonzero(apart <= 2))):
            if (not same_cell[k] or a[i] < b[k]) and a[i] != b[k] and one_edit(a[i], b[k]):
                add(a[i], an[i], b[k], bn[k])
                add(b[k], bn[k], a[i], an[i])
    columns = zip(*((w, *v) for w, v in near.items())) if near else [[]] * 5
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["word", "n", "n_near", "best_n", "best"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n) with a near word; ``words`` is a written table."""
    visits = keep(words.select("word", "n").mapInArrow(_visits, "cell string, home boolean, word string, n long"))
    sizes = keep(visits.groupBy(F.col("cell").alias("cell_")).agg(F.count_if("home").alias("homes"), F.count(F.lit(1)).alias("all")).filter("homes > 0"))
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("long")
    dealt = visits.join(sent(sizes)(sizes), F.col("cell") == F.col("cell_")).select("cell", "home", "word", "n", blocks("homes").alias("ha"), blocks("all").alias("hb"))
    own = lambda c: F.pmod(F.xxhash64("word"), F.col(c))
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    at_home = dealt.filter("home").select("cell", own("ha").alias("x"), every("hb").alias("y"), F.lit(True).alias("home_side"), "home", "word", "n")
    other = dealt.select("cell", every("ha").alias("x"), own("hb").alias("y"), F.lit(False).alias("home_side"), "home", "word", "n")
    met = at_home.unionByName(other).groupBy("cell", "x", "y").applyInArrow(_near, _NEAR)
    best = F.min_by(F.struct("best_n", "best"), F.struct(F.negative("best_n"), "best"))
    found = keep(met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top")).select("word", "n_near", "top.best_n", "top.best"))
    drop(visits, sizes)
    return found


def spelling_variants(docs: DataFrame, planted: bool = False) -> DataFrame:
    """The words of ``docs`` (doc_id, text) with their most frequent near word.

    Words are runs of Latin letters of at least six code points that occur five times at least, A-Z lower-cased.
    Returns word, form (the near word of largest n, ties the smallest, if it is five times as frequent; else
    NULL), root (following forms to the last), n, n_near, form_n. A NULL text has no words; repeated rows
    count as often as they are there; rows without doc_id count, and are never changed by ``planted``. An empty
    table gives an empty one. Other columns are not read.
    """
    words = keep(word_counts(docs, planted))
    near = near_words(words)
    close = F.col("best_n") >= TIMES * F.col("n")
    told = words.join(near.withColumnRenamed("word", "word_"), F.col("word") == F.col("word_"), "left")
    formed = keep(told.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(close, F.col("best")).alias("form"), F.when(close, F.col("best_n")).alias("form_n")))
    drop(near)
    up = keep(formed.filter("form is not null").select("word", F.col("form").alias("root")))
    while True:  # each form is five times as frequent, so chains are short, and every round doubles the way
        step = sent(up)(up.select(F.col("word").alias("at"), F.col("root").alias("next")))
        further = keep(up.join(step, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        drop(up)
        up = further
        if up.filter("moved").limit(1).count() == 0:
            break
    roots = up.select(F.col("word").alias("word_"), "root")
    out = formed.join(sent(up)(roots), F.col("word") == F.col("word_"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
