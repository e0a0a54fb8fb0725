"""Personal data by boosted trees over candidate spans.

The base rules of each kind are patterns with a check (parts, check digit, number of digits). Generators
of high recall propose more spans, which may overlap: other spellings of addresses, numbers without a
plus, loose groups of digits. Each candidate is described by its format and its surroundings. Boosted
trees learn per kind which candidates are base finds; a threshold is calibrated on candidates that the
trees have not seen, and candidates above it that overlap no base span are added, the best first.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tremorlake.llm.common import drop, keep, text_or_empty
from tremorlake.scale import running_totals

KINDS = ("email", "ip", "card", "phone")
CELLS = 50_000  # cells that are learnt from in one place
UNIT = 2.0**24  # slopes are summed in whole numbers of its inverse
PRECISION = 0.95  # share of base finds that the calibrated threshold asks for
ROUNDS, RATE, CUTS = 40, 0.3, 12
FEATURES = 17  # of ``describe``

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOOSE = {
    "email": re.compile(r"[\w.%+-]{1,64} ?(?:@|[\[(] ?at ?[\])]| at ) ?[\w-]{1,64}(?: ?(?:\.|[\[(] ?dot ?[\])]| dot ) ?[\w-]{2,24}){1,4}", re.I),
    "ip": re.compile(r"(?<![0-9])[0-9]{1,3}(?: ?[.,] ?[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[ .-]{0,2}[0-9]{2,7}){2,5}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])(?:\+|00)?(?:\(?[0-9]{1,5}\)?[ ./-]{0,2}){2,6}[0-9]{2,}(?![0-9])"),
}
# fixed values: words that announce a kind
_CUES = {"email": ("mail", "write", "contact"), "ip": ("ip", "host", "server"), "card": ("card", "visa", "pay"), "phone": ("tel", "call", "phone", "fax")}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping: a run of local signs always ends at its @, so the signs @ are visited in order."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            end = match.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the base rules, by kind and start."""
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15] if "+" in text else []
    return out


def describe(text: str, start: int, end: int, kind: str) -> list[float]:
    """Format and surroundings of a candidate."""
    span, before, after = text[start:end], text[max(0, start - 24) : start].lower(), text[end : end + 8]
    groups = [len(g) for g in re.findall(r"[0-9]+", span)] or [0]
    return [
        len(span), sum(groups), len(groups), groups[0], groups[-1], max(groups), span.count(" "), span.count("-"), span.count("."),
        span.count("(") + span.count("["), float(span[0] == "+"), float("@" in span), float(before[-1:].isalnum()), float(after[:1].isalnum()),
        float(before[-1:] in ("+", "@", ".", "-", "/")), float(any(c in before for c in _CUES[kind])), float(after[:1] in (".", ",", "-") and after[1:2].isdigit()),
    ]


def _slopes(model: dict, bins: np.ndarray, n: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slope and bend of the loss of each cell under the trees so far, as whole numbers: their sums are the same in any order."""
    p = 1 / (1 + np.exp(-_binned_margins(model, bins)))
    return np.rint((pos - n * p) * UNIT), np.rint(n * (p * (1 - p) + 1e-6) * UNIT)


def _binned_margins(model: dict, bins: np.ndarray) -> np.ndarray:
    z, slots = np.full(len(bins), model["base"]), model["slots"]
    test = lambda k: bins[:, slots[k][0]] <= slots[k][1]
    for top, left, a, b, right, c, d in model["trees"]:
        z += np.where(test(top), np.where(test(left), a, b), np.where(test(right), c, d))
    return z


def _sums(model: dict, top: int | None, bins: np.ndarray, n: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Sums of slope and bend by side of the split ``top`` (one side without), feature and bin, flat."""
    slope, bend = _slopes(model, bins, n, pos)
    if top is None:
        sides = [np.ones(len(bins), bool)]
    else:
        left = bins[:, model["slots"][top][0]] <= model["slots"][top][1]
        sides = [left, ~left]
    parts = [np.bincount(bins[side, f], weights=w[side], minlength=CUTS + 1) for side in sides for w in (slope, bend) for f in range(bins.shape[1])]
    return np.concatenate(parts).astype(np.int64)


def _best(model: dict, sums: np.ndarray) -> tuple[int, float, float, float, float]:
    """The best split by the sums of one side: (split, slope left, bend left, slope right, bend right)."""
    total = sums[:, 0].sum(axis=-1) / UNIT  # any feature's bins hold all rows
    upto = np.cumsum(sums, axis=-1) / UNIT
    gl, hl = (np.array([upto[w, f, c] for f, c in model["slots"]]) for w in (0, 1))
    k = int((gl**2 / (hl + 1) + (total[0] - gl) ** 2 / (total[1] - hl + 1)).argmax())
    return k, gl[k], hl[k], total[0] - gl[k], total[1] - hl[k]


def _started(count: int, seen: int, seen_base: int, quantiles: list[np.ndarray]) -> dict | None:
    """A model without trees; None if there are few candidates or a class is missing."""
    if count < 20 or not 0 < seen_base < seen:
        return None
    cuts = [np.unique(np.array(q, dtype=float)) for q in quantiles]
    slots = [(f, c) for f, cut in enumerate(cuts) for c in range(len(cut))]
    rate = seen_base / seen
    return {"base": float(np.log((rate + 1e-3) / (1 - rate + 1e-3))), "cuts": cuts, "slots": slots, "splits": [(f, float(cuts[f][c])) for f, c in slots], "trees": []}


def _grow(models: dict[int, dict], sums_of: Callable[[dict[int, dict], dict[int, int] | None], dict[int, np.ndarray]], rounds: int = ROUNDS) -> None:
    """Gradient boosting of trees with two levels on the logistic loss, splits at quantiles, all kinds side by side.

    ``sums_of`` gives the sums over all cells of a kind, whose number is fixed: two passes a round, whatever the rows.
    """
    for _ in range(rounds):
        shaped = lambda sums: sums.reshape(-1, 2, FEATURES, CUTS + 1)
        tops = {k: _best(models[k], shaped(s)[0])[0] for k, s in sums_of(models, None).items()}
        for k, s in sums_of(models, tops).items():
            tree = [tops[k]]
            for side in shaped(s):
                low, gl, hl, gr, hr = _best(models[k], side)
                tree += [low, RATE * gl / (hl + 1), RATE * gr / (hr + 1)]
            models[k]["trees"].append(tree)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, FEATURES)


def learn(each: DataFrame, cells_in_one: int = CELLS) -> list[dict | None]:
    """A model per kind from all candidates (doc_id, kind, start, is_base, x): trees on seven tenths, drawn by a hash, the threshold on the rest.

    Candidates of equal bins are one cell with counts. A few cells are learnt from at once, more by sums over a table of them;
    both give the same trees.
    """
    seen = F.pmod(F.xxhash64("doc_id", "start"), F.lit(10)) < 7
    rows = each.select(F.col("kind").cast("int").alias("kind"), seen.alias("seen"), "is_base", "x")
    marks = F.array(*[F.lit(float(p)) for p in np.linspace(0, 1, CUTS + 2)[1:-1]])
    quantiles = [F.percentile(F.when(F.col("seen"), F.col("x")[f]), marks).alias(f"q{f}") for f in range(FEATURES)]
    stats = rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_if("seen").alias("s"), F.count_if(F.col("seen") & F.col("is_base")).alias("b"), *quantiles)
    found = {r["kind"]: _started(r["n"], r["s"], r["b"], [r[f"q{f}"] for f in range(FEATURES)]) for r in stats.collect()}
    models = {k: m for k, m in found.items() if m}
    if not models:
        return [None] * len(KINDS)
    cuts = {k: m["cuts"] for k, m in models.items()}

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.is_in(batch.column("kind"), pa.array(list(cuts), pa.int32())))
            x, kind = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES), batch.column("kind").to_numpy(zero_copy_only=False)
            bins = np.zeros(x.shape, np.uint8)
            for k, cut in cuts.items():
                own = kind == k
                for f in range(FEATURES):
                    bins[own, f] = np.searchsorted(cut[f], x[own, f], side="left")
            columns = [batch.column("kind"), batch.column("seen"), batch.column("is_base"), pa.array([b.tobytes() for b in bins], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "seen", "is_base", "bins"])

    cells = keep(
        rows.mapInArrow(binned, "kind int, seen boolean, is_base boolean, bins binary")
        .groupBy("kind", "seen", "bins")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("is_base").alias("pos"))
    )
    fitted, few = cells.filter("seen"), cells.limit(cells_in_one + 1).toArrow()

    def local(table: pa.Table | pa.RecordBatch, k: int, which: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = table.filter(pc.and_(pc.equal(table["kind"], k), pc.equal(table["seen"], which)))
        return _matrix(own["bins"]), own["n"].to_numpy().astype(float), own["pos"].to_numpy().astype(float)

    if few.num_rows <= cells_in_one:
        data = {k: local(few, k) for k in models}
        _grow(models, lambda ms, tops: {k: _sums(m, tops and tops[k], *data[k]) for k, m in ms.items()})
        rest = {k: local(few, k, False) for k in models}
        for k, m in models.items():
            bins, n, pos = rest[k]
            z, at = np.unique(-_binned_margins(m, bins), return_inverse=True)  # the best score first, equal scores together
            right = np.cumsum(np.bincount(at, weights=pos, minlength=len(z))) / np.cumsum(np.bincount(at, weights=n, minlength=len(z)))
            good = np.flatnonzero(right >= PRECISION)
            m["threshold"] = float(-z[good[-1]]) if len(good) else float("inf")
        drop(cells)
        return [found.get(k) for k in range(len(KINDS))]

    def sums_of(ms: dict[int, dict], tops: dict[int, int] | None) -> dict[int, np.ndarray]:
        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for k in ms:
                    data = local(pa.Table.from_batches([batch]), k)
                    if len(data[0]):
                        total[k] = total.get(k, 0) + _sums(ms[k], tops and tops[k], *data)
            for k, s in total.items():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([s.tolist()], pa.list_(pa.int64()))], names=["kind", "sums"])

        parts = fitted.mapInArrow(summed, "kind int, sums array<bigint>").select("kind", F.posexplode("sums").alias("i", "v"))
        out: dict[int, list] = {}
        for r in parts.groupBy("kind", "i").agg(F.sum("v").alias("v")).orderBy("kind", "i").collect():
            out.setdefault(r["kind"], []).append(r["v"])
        return {k: np.array(v, np.int64) for k, v in out.items()}

    _grow(models, sums_of)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in models:
                bins, n, pos = local(pa.Table.from_batches([batch]), k, False)
                columns = [pa.array(np.full(len(bins), k, np.int32)), pa.array(_binned_margins(models[k], bins)), pa.array(n.astype(np.int64)), pa.array(pos.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["kind", "z", "n", "pos"])

    scores = keep(cells.filter("NOT seen").mapInArrow(scored, "kind int, z double, n long, pos long").groupBy("kind", "z").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")))
    ranked = running_totals(scores, [F.col("z").desc()], {"upto": "n", "right": "pos"}, keys=["kind"])
    lines = {r["kind"]: r["z"] for r in ranked.filter(F.col("right") / F.col("upto") >= PRECISION).groupBy("kind").agg(F.min("z").alias("z")).collect()}
    for k, m in models.items():
        m["threshold"] = lines.get(k, float("inf"))
    drop(cells, scores)
    return [found.get(k) for k in range(len(KINDS))]


def margins(model: dict, x: np.ndarray) -> np.ndarray:
    z, splits = np.full(len(x), model["base"]), model["splits"]
    test = lambda k: x[:, splits[k][0]] <= splits[k][1]
    for top, left, a, b, right, c, d in model["trees"]:
        z += np.where(test(top), np.where(test(left), a, b), np.where(test(right), c, d))
    return z


def _proposed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "base", "kind", "start", "end", "is_base", "x"]
    for batch in batches:
        rows: list[list] = [[] for _ in names]
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            base = base_spans(text)
            found = []
            for number, kind in enumerate(KINDS):
                own = {(a, b) for k, a, b in base if k == number}
                if kind == "email" and "@" not in text and " at " not in text and "at" not in text:
                    continue
                more = {m.span() for m in _LOOSE[kind].finditer(text)}
                found += [(number, a, b, (a, b) in own, describe(text, a, b, kind)) for a, b in sorted(own | more)]
            values = (doc_id, [n for s in base for n in s], *([f[k] for f in found] for k in range(5)))
            for column, value in zip(rows, values):
                column.append(value)
        longs = pa.list_(pa.int64())
        types = [pa.int64(), longs, longs, longs, longs, pa.list_(pa.bool_()), pa.list_(pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=names)


def _text_of(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find(docs: DataFrame) -> DataFrame:
    """Personal data in each text of ``docs`` (doc_id, text).

    Returns doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added: counts and digest of
    the base spans, and all spans with those that the trees add. Places are code points, ends exclusive.
    A NULL or empty text has none; repeated rows are searched each; a kind of which there are
    only base finds, or none, gets no additions. An empty table gives an empty one. Other columns are
    not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    longs = "array<bigint>"
    shape = f"doc_id long, base {longs}, kind {longs}, start {longs}, `end` {longs}, is_base array<boolean>, x array<array<double>>"
    proposed = keep(texts.mapInArrow(_proposed, shape))
    each = proposed.select("doc_id", F.explode(F.arrays_zip("kind", "start", "is_base", "x")).alias("c")).select("doc_id", "c.*")
    models = learn(each)
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
        types = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            data = batch.to_pydict()
            for doc_id, flat, kind, start, end, is_base, x in zip(*(data[c] for c in ("doc_id", "base", "kind", "start", "end", "is_base", "x"))):
                base = [tuple(flat[i : i + 3]) for i in range(0, len(flat), 3)]
                spans, open_ = list(base), [i for i, b in enumerate(is_base) if not b and models[kind[i]]]
                ranked = []
                for number, model in enumerate(models):
                    own = [i for i in open_ if kind[i] == number]
                    if own:
                        z = margins(model, np.array([x[i] for i in own]))
                        ranked += [(float(v - model["threshold"]), i) for v, i in zip(z, own) if v >= model["threshold"]]
                for _, i in sorted(ranked, key=lambda r: (-r[0], r[1])):
                    if all(end[i] <= a or b <= start[i] for _, a, b in spans):
                        spans.append((kind[i], start[i], end[i]))
                counts = [sum(k == number for k, _, _ in base) for number in range(len(KINDS))]
                digest = hashlib.sha256(_text_of(base).encode()).hexdigest()
                for column, value in zip(rows, (doc_id, *counts, digest, _text_of(spans), len(spans) - len(base))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=names)

    out = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return proposed.mapInArrow(chosen, out)


def redact(text: str, spans: str) -> str:
    """The text with each span of ``spans`` (as ``find`` writes them) replaced by its kind in brackets."""
    out, at = [], 0
    for kind, start, end in sorted((p.split(":") for p in spans.split(",") if p), key=lambda p: (int(p[1]), -int(p[2]))):
        if int(start) >= at:
            out += [text[at : int(start)], f"[{kind}]"]
        at = max(at, int(end))
    return "".join(out) + text[at:]
