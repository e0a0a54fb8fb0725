"""Periodic runs of words by an online sparse diagonal table.

The table has a diagonal per lag: its entry at word i is the length of the match between the text and
itself shifted by the lag, ending there. Only diagonals with a match exist. Were every earlier occurrence
of a word to increment its lag, a common word of a long text would meet all its occurrences, so an
occurrence counts only with its left context, and the lags are dealt with by class:

* lags from 2**j up to 2**(j+1) - 1 look at grams of K = 2**(j+1) words, named by doubling;
* in a run of smallest period q and length L >= 4 * q, every gram of K > q words that ends at least
  K + q words after the run's start has its nearest earlier occurrence exactly q words before: a nearer
  one would give the run a smaller period. So the nearest occurrence is the only one that can increment
  a lag which matters, and there is one active lag a class: it grows by one while the next word has the same
  lag, and at the first word with another lag it ends and emits its run, if the run is long enough;
* the other way round a lag that was active to a run's end is its smallest period, for the same reason.

So each run comes out once, in the class of its period; the work is a sort of the repeated grams a class,
whatever the words: n log n for a text of one word a million times, too. Texts of a batch are worked on together, with a
word of its own between two of them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tremorlake.llm.common import text_or_empty

LEAST = 6  # words of a run
TIMES = 4  # periods of a run
TOGETHER = 1 << 18  # words of texts that are worked on together; a longer text is alone


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each key that is there more than once, else -1; and the distance in ``keys`` order to the
    place of the key before, as (place, place before) pairs."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    again = np.zeros(len(keys), bool)
    again[1:] |= same
    again[:-1] |= same
    group = np.cumsum(np.concatenate([[False], ~same])) if len(keys) else np.zeros(0, np.int64)
    names = np.empty(len(keys), np.int64)
    names[order] = np.where(again, group, -1)
    before = np.full(len(keys), -1, np.int64)
    before[order[1:][same]] = order[:-1][same]
    return names, before


def find_runs(words: np.ndarray, longest: int) -> np.ndarray:
    """All runs (start, length, period) of ``words``, numbers, sorted by start and period.

    ``longest``: no text among them has more words; between two texts stands a number that occurs nowhere else.
    """
    n = len(words)
    names, _ = _repeated(words)
    found: list[tuple[int, int, int]] = []
    half = 1
    while TIMES * half <= longest:
        ends = half + np.flatnonzero((names[half:] >= 0) & (names[:-half] >= 0))  # grams of twice the length, by their last word
        fresh, before = _repeated(names[ends - half] * np.int64(n + 1) + names[ends])
        at, earlier = ends[before >= 0], ends[before[before >= 0]]
        lag = at - earlier
        inside = (lag >= half) & (lag < 2 * half)
        at, lag = at[inside], lag[inside]
        if len(at):
            cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(lag) != 0)) + 1  # here an active lag ends
            first, last = np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(at) - 1]])
            q = lag[first]
            enough = last - first + 1 >= np.maximum(LEAST, TIMES * q) - 2 * half - q
            for low, end, period in zip(at[first][enough].tolist(), at[last][enough].tolist(), q[enough].tolist()):
                start = low - 2 * half + 1 - period
                while start > 0 and words[start - 1] == words[start - 1 + period]:
                    start -= 1
                if end - start + 1 >= max(LEAST, TIMES * period):
                    found.append((start, end - start + 1, period))
        names = np.full(n, -1, np.int64)
        names[ends] = fresh
        if not (fresh >= 0).any():
            break
        half *= 2
    return np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def source_of(doc_id: int | None, n: int) -> np.ndarray | None:
    """The word of the text that stands at each place, where the tail of a text is made periodic; None: all stay.

    With h = crc32(decimal doc_id) this is one text in ten (h % 10 = 0); a text without doc_id stays.
    """
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    return np.where(place >= a, a + (place - a) % p, place)


_NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
_TYPES = [pa.int64()] * 6 + [pa.string()] * 2
SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _row(doc_id: int | None, parts: list[bytes], runs: np.ndarray) -> tuple:
    listed = "".join(f"{s},{k},{q}\n" for s, k, q in runs.tolist())
    best: tuple = (None,) * 4
    if len(runs):
        s, k, q = min(runs.tolist(), key=lambda r: (-r[1], r[0], r[2]))
        best = (s, k, q, 1000 * k // q)
        stays = np.ones(len(parts), bool)
        for s, k, q in runs.tolist():
            stays[s + q : s + k] = False
        parts = [parts[x] for x in np.flatnonzero(stays).tolist()]
    return (doc_id, len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(parts)).hexdigest())


def _together(texts: list[tuple[int | None, list[bytes]]]) -> Iterator[tuple]:
    """The rows of some texts, given as doc_id and words."""
    known: dict[bytes, int] = {}
    numbers, begins, at = [], [], 0
    for k, (_, parts) in enumerate(texts):
        numbers += [known.setdefault(w, len(known)) for w in parts]
        numbers.append(-1 - k)  # between two texts
        begins.append(at)
        at += len(parts) + 1
    runs = find_runs(np.array(numbers, np.int64), max(len(parts) for _, parts in texts))
    cuts = np.searchsorted(runs[:, 0], [*begins, at])
    for k, (doc_id, parts) in enumerate(texts):
        yield _row(doc_id, parts, runs[cuts[k] : cuts[k + 1]] - [begins[k], 0, 0])


def _periodic(planted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            waiting: list[tuple[int | None, list[bytes]]] = []
            words = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                parts = text.as_py().encode().split()
                source = source_of(doc_id, len(parts)) if planted else None
                if source is not None:
                    parts = [parts[x] for x in source.tolist()]
                if waiting and words + len(parts) > TOGETHER:
                    rows += _together(waiting)
                    waiting, words = [], 0
                waiting.append((doc_id, parts))
                words += len(parts)
            if waiting:
                rows += _together(waiting)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)] if rows else [pa.array([], t) for t in _TYPES], names=_NAMES)

    return run


def periodic_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """The periodic runs of each text of ``docs`` (doc_id, text), words parted by ASCII blanks.

    A run is a stretch with smallest period q of at least six words and four periods that no neighbouring
    word extends. Returns per row doc_id, n_runs, the longest run (ties: smallest start, then period) as
    start, length, period, exponent_milli, and runs_sha256 (all runs) and collapsed_sha256 (the text with
    one period left of each run). A text that is NULL, empty or blank has no runs, NULLs for the longest,
    and hashes of the empty text. Rows are worked on one by one, so repeated rows give equal rows, and a
    NULL doc_id stays NULL. An empty table gives an empty one. Other columns are not read.
    ``planted``: first make the tails of some texts periodic, see ``source_of``.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return texts.mapInArrow(_periodic(planted), SCHEMA)
