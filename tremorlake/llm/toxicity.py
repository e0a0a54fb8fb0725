"""Toxicity by noisy-channel deobfuscation.

A character trigram model is counted over all documents. Words that look disguised (look-alike signs
inside words or at their edges, letters spaced apart, letters repeated) become a lattice of readings, and
the reading that is the likeliest under the model, less the cost of each edit, replaces them (Viterbi).
Edits read a sign as a letter, drop an edge sign or a repeat, and take a parting sign as nothing or as a
blank between words; a token may be of any length. The restored text is scored: words and word beginnings carry the log odds, lower-bounded, with which they occur in toxic
and other labelled documents, and a logistic function of its three highest occurrences is a document's score.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tremorlake.llm.common import fresh, text_or_empty

SAMPLE = 2000  # labelled documents of each class that a model is fitted on, at most
REMEMBERED = 64  # signs of a token whose reading is remembered; longer ones are read each time
THRESHOLD = 0.7

# fixed values: signs that stand for letters, and signs that only part letters
LOOKALIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
PARTING = ".-_*~'·"

_OTHER = 27  # symbols of the model: 0 blank, 1 to 26 letters, 27 any other letter or sign
_SYMBOLS = 28
_EDGE = ".,;:!?\"'()[]{}<>*#%&$-_~|"
_SOFT_EDGE = ".,;:?\"')[]{}<>*#%&-_~"  # edges that can't be letters
_COST = {"same": 0.0, "read": 1.0, "part": 0.7, "split": 1.0, "join": 0.0, "again": 0.5, "double": 3.0}
# split: a blank between two single signs, join: one beside a longer piece; again: a repeat of three or more, double: of two
_DROP = ({"$": 5.0, "!": 5.0, "|": 1.0, "(": 1.0}, {"$": 5.0, "!": 0.0, "|": 1.0, "(": 3.0})  # edge signs before and after a word; others are free
_DISGUISED = re.compile(r"[^\W\d_][^\W_]*[0-9@$!|+(€£.\-_*~'·]+[^\W_]*|[0-9@$!|(€£]+[^\W\d_]|([^\W\d_])\1")
_SPACED = re.compile(r"(?<!\S)[^\w\s]*\S(?: \S){2,}[^\w\s]*(?!\S)")
_LETTER = re.compile(r"[^\W\d_]")


def _table() -> np.ndarray:
    """Symbol of each byte of a lower-cased text; bytes beyond ASCII are 'other'."""
    out = np.full(256, _OTHER, np.int64)
    for sign in b" \t\n\r\x0b\x0c.,;:!?\"()":
        out[sign] = 0
    for k in range(26):
        out[97 + k] = out[65 + k] = k + 1
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, symbol = np.zeros(_SYMBOLS**3, np.int64), _table()
    for batch in batches:
        for text in batch.column(0):
            codes = symbol[np.frombuffer(b"  " + text.as_py().encode() + b" ", np.uint8)]
            total += np.bincount((codes[:-2] * _SYMBOLS + codes[1:-1]) * _SYMBOLS + codes[2:], minlength=_SYMBOLS**3)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["code", "n"])


def language_model(docs: DataFrame) -> np.ndarray:
    """Log probability of a symbol after two others, from all documents; at most 28 cubed counts are collected."""
    counts = docs.select(text_or_empty().alias("text")).mapInArrow(_counted, "code long, n long")
    total = np.zeros(_SYMBOLS**3)
    for row in counts.groupBy("code").agg(F.sum("n").alias("n")).collect():
        total[row["code"]] = row["n"]
    cube = total.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS)
    pairs = cube.sum(0) + 0.5
    back = pairs / pairs.sum(1, keepdims=True)
    return np.log((cube + 5.0 * back[None]) / (cube.sum(2, keepdims=True) + 5.0))


class Restorer:
    """Restores disguised words of a text; remembers the readings of words."""

    def __init__(self, model: np.ndarray):
        self.model, self.readings = model.tolist(), {}

    def word(self, token: str) -> str:
        """The likeliest reading of one token, by Viterbi over (last two symbols); blanks part its words.

        What all readings have in common is put aside on the way, so a long token takes linear time.
        """
        model, states, done = self.model, {(0, 0): (0.0, "")}, []
        first, end = len(token) - len(token.lstrip(_EDGE)), len(token.rstrip(_EDGE))
        last = ""

        def single(at: int) -> bool:  # a lone sign ends before or after this place
            return not first <= at < end or token[at] in PARTING or token[at] == " "

        for at, sign in enumerate(token):
            ways = []
            if sign.isalpha():
                ways.append((sign, _COST["same"]))
            for letter in LOOKALIKE.get(sign, ""):
                ways.append((letter, _COST["read"]))
            again = _COST["again" if token[at - 2 : at] == sign * 2 or token[at + 1 : at + 2] == sign else "double"]
            if at < first or at >= end:
                drop = _DROP[at >= end].get(sign, 0.0)
                ways.append(("", min(drop, again) if sign == last else drop))
            elif sign in PARTING or sign == " ":
                ways += [("", _COST["part"]), (" ", _COST["split" if single(at - 2) and single(at + 2) else "join"])]
            elif sign == last:
                ways.append(("", again))
            if not ways:
                ways.append((sign, _COST["same"]))
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (score, text) in states.items():
                for letter, cost in ways:
                    if letter == " " and not b:
                        continue  # no empty words
                    c = 0 if letter == " " else ord(letter) - 96 if "a" <= letter <= "z" else _OTHER
                    key = (b, c) if letter else (a, b)
                    value = score - cost + (model[a][b][c] if letter else 0.0)
                    if key not in after or value > after[key][0]:
                        after[key] = (value, text + letter)
            states, last = after, sign
            if at % 64 == 63:
                common = commonprefix([text for _, text in states.values()])
                done.append(common)
                states = {key: (score, text[len(common) :]) for key, (score, text) in states.items()}
        return "".join(done) + max((score + (model[a][b][0] if b else 0.0), text) for (a, b), (score, text) in states.items())[1]

    def reading(self, token: str) -> str:
        """The word or words that a lower-cased token stands for; empty if it has none."""
        word = token.strip(_EDGE)
        if not word:
            return word
        soft = token.strip(_SOFT_EDGE)
        if not word.isalpha():
            disguised = _DISGUISED.search(token)
        else:
            disguised = soft.strip(_EDGE) != soft or len(word) > 2 and _DISGUISED.search(word)
        return self.word(soft) if disguised else word

    def read(self, token: str) -> list[str]:
        words = self.readings.get(token)
        if words is None:
            words = self.reading(token).split()
            if len(token) <= REMEMBERED:
                self.readings[token] = words
        return words

    def words(self, text: str) -> list[str]:
        """The lower-cased words of the text, disguised ones restored."""
        low = text.lower()
        if len(self.readings) > 300_000:
            self.readings.clear()
        out, start = [], 0
        for run in _SPACED.finditer(low):
            if _LETTER.search(run[0]):  # else numbers
                for token in low[start : run.start()].split():
                    out += self.read(token)
                out += self.word(run[0]).split()
                start = run.end()
        for token in low[start:].split():
            out += self.read(token)
        return out


def beginnings(word: str) -> list[str]:
    """The features of a word: itself and its beginnings of three to six letters."""
    return [word, *[f"{word[:n]}~" for n in range(3, 7) if len(word) > n]]


def fit(rows: list[tuple[int, list[str]]], prior: float) -> dict:
    """Log odds of features, and the logistic function of a document's three highest.

    ``rows`` are (label, words). The logistic function is fitted on odds counted without the
    document itself. Without both labels the score is the prior.
    """
    counts = [Counter(), Counter()]
    sizes = [0, 0]
    distinct = [(label, {f for w in set(words) for f in beginnings(w)}, words) for label, words in rows]
    for label, found, _ in distinct:
        counts[label].update(found)
        sizes[label] += 1
    if not sizes[0] or not sizes[1]:
        return {"odds": {}, "weights": [math.log(prior / (1 - prior)), 0.0, 0.0, 0.0]}

    def bound(t: int, c: int) -> float:
        if t < 2:
            return 0.0
        odds = math.log((t + 0.3) / (sizes[1] + 1)) - math.log((c + 0.3) / (sizes[0] + 1))
        return max(0.0, odds - 1.5 * math.sqrt(1 / (t + 0.3) + 1 / (c + 3.0)))

    odds = {f: x for f, t in counts[1].items() if (x := bound(t, counts[0][f])) > 0.0}
    x, best = np.ones((len(rows), 4)), {}
    for row, (label, _, words) in zip(x, distinct):
        for w in words:
            if w not in best:
                best[w] = max(odds.get(f, 0.0) for f in beginnings(w))
        high = heapq.nlargest(8, words, key=best.__getitem__)
        row[1:] = top(high, {f: bound(counts[1][f] - label, counts[0][f] - (1 - label)) for w in high for f in beginnings(w)})
    y = np.array([label for label, _ in rows], float)
    share = np.where(y == 1, prior / sizes[1], (1 - prior) / sizes[0]) * len(rows)
    weights = np.zeros(4)
    for _ in range(60):  # Newton steps with a ridge
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (share * (y - p)) - 0.5 * weights
        weights += np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(4), slope)
    return {"odds": odds, "weights": weights.tolist()}


def top(words: list[str], odds: dict[str, float]) -> list[float]:
    best = sorted((max((odds.get(f, 0.0) for f in beginnings(w)), default=0.0) for w in words), reverse=True)[:3]
    return best + [0.0] * (3 - len(best))


def labelled(docs: DataFrame, labels: DataFrame, label: str, train, sample: int) -> tuple[DataFrame, float]:
    """Texts (label, text) of at most ``sample`` training rows of each class, and the share of class 1.

    ``train`` tells from doc_id whether a row may be learnt from. Rows are taken in order of a hash.
    """
    rows = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull())
    rows = rows.filter(train).groupBy("doc_id").agg(F.max("y").alias("y"))
    counts = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = rows.filter("y = 0").orderBy(*order).limit(sample).unionByName(rows.filter("y = 1").orderBy(*order).limit(sample))
    prior = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1.0)
    texts = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(some), "doc_id")
    return texts.select("doc_id", "y", "text"), prior


def remainder(modulus: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def train(docs: DataFrame, labels: DataFrame, may_learn) -> tuple[np.ndarray, dict]:
    """The language model of all documents and the scorer of a bounded sample of labelled rows."""
    model = language_model(docs)
    rows, prior = labelled(docs, labels, "toxic", may_learn, SAMPLE)

    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in batches:
            counts = [Counter(restorer.words(t.as_py())) for t in batch.column(2)]
            found = ["\n".join(w for w in sorted(c) for _ in range(min(3, c[w]))) for c in counts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], names=["doc_id", "y", "words"])

    got = rows.mapInArrow(restored, "doc_id long, y int, words string").collect()
    return model, fit([(r["y"], r["words"].split("\n")) for r in sorted(got, key=lambda r: (r["doc_id"], r["words"]))], prior)


def scores(docs: DataFrame, model: np.ndarray, scorer: dict, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``: 0 to 1, higher where the restored text is likelier toxic."""
    shared = docs.sparkSession.sparkContext.broadcast((model, scorer))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, scorer = shared.value
        restorer, odds, weights = Restorer(model), scorer["odds"], scorer["weights"]
        best: dict[str, float] = {}
        for texts in batches:
            out = []
            for text in texts:
                if len(best) > 300_000:
                    best.clear()
                high = [0.0, 0.0, 0.0]
                for word in restorer.words(text):
                    value = best.get(word)
                    if value is None:
                        value = max(odds.get(f, 0.0) for f in beginnings(word))
                        if len(word) <= REMEMBERED:
                            best[word] = value
                    if value > high[2]:
                        high = sorted([*high[:2], value], reverse=True)
                z = weights[0] + sum(w * h for w, h in zip(weights[1:], high))
                out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            yield pd.Series(out, dtype="float64")

    return docs.withColumn(name, score(text_or_empty()))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Toxicity of each document of ``docs`` (doc_id, text), learnt from ``labels`` (doc_id, toxic).

    Labels are learnt only where crc32(doc_id as text) mod 3 is not 1. Returns doc_id, held_out, score,
    predicted (score >= 0.7). A NULL or empty text has the score of a text without toxic words; a NULL
    doc_id is never held out; repeated rows are scored each; of conflicting labels the higher counts.
    Without labels of both kinds the score is the smoothed share of label 1. An empty table gives an
    empty one. Other columns are not read.
    """
    rest = remainder(3)
    model, scorer = train(docs, labels, rest != 1)
    scored = scores(docs.select("doc_id", "text"), model, scorer)
    return scored.select(
        "doc_id", F.coalesce(rest == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows scored as toxic, all columns as they were."""
    model, scorer = train(docs, labels, remainder(3) != 1)
    name = fresh(docs, "toxicity")
    return scores(docs, model, scorer, name).filter(F.col(name) < THRESHOLD).drop(name)
