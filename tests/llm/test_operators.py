"""The corpus operators against brute force on small tables, with NULLs, empty and long texts, ties and repeated rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tremorlake.llm import common, exact, langid, minhash, mixing, packing, pii, quality, suffix, topk, toxicity
from tremorlake.llm.common import components

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[k] + str(rng.integers(0, 60)) for k in rng.integers(0, len(WORDS), n))


ODD = [
    (1, None, "s1"), (2, "", None), (3, " \t\n ", "s1"), (4, "a  b\tc", "s2"), (5, "a b c", "s2"), (5, "a b c", "s2"),
    (None, "a b c", "s3"), (7, "été " * 400, "s1"), (8, prose(1, 6000), "s1"), (9, prose(1, 6000) + " end", None), (10, prose(2, 300), "s3"),
]


def frame(spark, rows=ODD):
    """With extra columns whose names clash with inner ones."""
    wide = [(i, t, s, 1, "x", 2) for i, t, s in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, source string, row int, run string, n int")


def test_exact_groups(spark):
    got = exact.exact_groups(frame(spark)).collect()
    assert len(got) == len(ODD)
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, _ in ODD]
    sizes = Counter(normal)
    for r in got:
        same = [k for k, (i, _, _) in enumerate(ODD) if i == r.doc_id]
        text = normal[same[0]]
        assert r.group_size == sizes[text] and r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.keep_id == min(i for (i, _, _), t in zip(ODD, normal) if t == text and i is not None)
    assert sum(r.kept for r in got) == len(sizes)
    assert exact.exact_groups(frame(spark, [])).collect() == []


def test_exact_tree_has_levels(spark, monkeypatch):
    monkeypatch.setattr(exact, "FAN", 2)
    docs = spark.range(400, numPartitions=7).selectExpr("id as doc_id", "concat('t', id % 3 * int(id % 2)) as text")
    kept = exact.drop_exact_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 5]


@pytest.mark.parametrize("rows", [0, 500_000])
def test_components(spark, monkeypatch, rows):
    monkeypatch.setattr(common, "SMALL_ROWS", rows)  # shuffled, broadcast
    edges = [(5, 4), (4, 3), (3, 2), (9, 8), (2, 1), (20, 9), (6, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8, 20: 8, 6: 6, 7: 6}


def brute_components(rows):
    sets, parent = {}, {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        parent[i] = i

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_rows():
    rng = np.random.default_rng(3)
    rows = [(1, None), (2, ""), (3, "One two"), (4, "one  TWO"), (5, prose(50, 4))]
    for family in range(6):  # copies with edits: chains, stars and texts that only share a passage
        base = prose(100 + family, 120).split()
        for k in range(25):
            words = list(base)
            for at in rng.integers(0, len(words), rng.integers(0, 9)):
                words[at] = f"new{family}x{k}x{at}"
            rows.append((1000 * family + 10 + k, " ".join(words)))
    passage = prose(999, 60)
    rows += [(9000 + k, passage + " " + prose(2000 + k, 25)) for k in range(60)]
    return rows


def test_near_groups(spark, monkeypatch):
    monkeypatch.setattr(minhash, "MANY", 3)
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as g", "3 as root")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_groups(docs).collect()}
    assert got == brute_components(rows)
    kept = minhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, root) in brute_components(rows).items() if i == root}


def test_near_groups_odd(spark):
    got = minhash.near_groups(frame(spark)).collect()
    assert len(got) == len(ODD)
    assert {(r.doc_id, r.component_id, r.kept) for r in got if r.doc_id is None} == {(None, 4, False)}
    assert minhash.near_groups(frame(spark, [])).collect() == []


@pytest.mark.parametrize("rows", [0, 500_000])
def test_two_texts_of_one_id(spark, monkeypatch, rows):
    monkeypatch.setattr(common, "SMALL_ROWS", rows)  # a bitmap of identifiers, and shuffles; or broadcast
    base = prose(30, 100).split()
    near = " ".join([*base[:50], "new", *base[51:]])
    texts = [(5, prose(31, 90)), (5, " ".join(base)), (7, near), (6, prose(32, 80)), (9, prose(31, 90) + " end")]
    for order in (texts, texts[::-1], [*texts[1:], texts[0]]):
        got = minhash.near_groups(spark.createDataFrame(order, "doc_id long, text string")).collect()
        assert {(r.doc_id, r.component_id) for r in got} == {(5, 5), (7, 5), (6, 6), (9, 5)}


def brute_repeats(rows):
    count = Counter(b[s : s + 400] for _, t in rows for b in [(t or "").encode()] for s in range(len(b) - 399))
    out = []
    for i, t in rows:
        data = (t or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for s in range(len(data) - 399):
            if count[data[s : s + 400]] > 1:
                gone[s : s + 400] = True
        gone = gone[: len(data)]
        spans = int((gone[1:] & ~gone[:-1]).sum()) + int(len(gone) > 0 and gone[0])
        rest = bytes(np.frombuffer(data, np.uint8)[~gone])
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return out


@pytest.mark.parametrize("segment", [1 << 20, 700])
def test_repeated_passages(spark, monkeypatch, segment):
    monkeypatch.setattr(suffix, "SEGMENT", segment)
    base = prose(5, 600)
    rows = [
        (1, base[:1500]), (2, "Z" + base[300:2500] + "é"), (3, base[100:500] + "!" + base[2000:2405]), (4, base[1999:2404]), (5, "a" * 1000),
        (6, "ab" * 600), (7, "y" * 400), (8, "x" * 399), (9, None), (10, ""), (11, prose(6, 900)), (11, prose(6, 900)), (None, prose(7, 200)), (13, base[:300]),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as lo", "2 as nodes")
    got = [tuple(r) for r in suffix.without_repeats(docs).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(brute_repeats(rows), key=key)
    assert suffix.without_repeats(docs.limit(0)).collect() == []


def test_built_collisions_and_rows_without_id(spark):
    """Alternating patterns, on which sums modulo 2**64 vanish, and several rows without an id."""

    def morse(n, zero, one):
        return "".join(one if bin(k).count("1") & 1 else zero for k in range(n))

    base = prose(70, 200)
    rows = [
        (1, base[:300] + morse(64, "a", "b") + base[300:672]), (2, prose(71, 100)[:300] + morse(64, "a", "b") + prose(72, 100)[:372]), (3, morse(1024, "c", "d")), (4, morse(1024, "d", "c")),
        (None, base[:700]), (None, base[:700]), (None, prose(73, 200)[:800]), (None, "x" + base[100:600]), (-1, base[50:650]), (0, "y" + base[50:650]),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted((tuple(r) for r in suffix.without_repeats(docs).collect()), key=key) == sorted(brute_repeats(rows), key=key)


def test_packing(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = ODD + [(100 + k, prose(300 + k, 20 + 7 * k), "s") for k in range(60)] + [(300, "a²b ½\x1c x  y<|endoftext|>", "s")]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = Counter()
    for i, t, _ in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for s in range(0, len(ids), 1024):
            want[i, s, len(ids[s : s + 1024]), zlib.crc32(ids[s : s + 1024].tobytes()), len(ids)] += 1
    got = packing.pack(frame(spark, rows)).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(frame(spark, [])).collect() == []


def test_packing_reads_the_special_token(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    from tremorlake.llm.queries import op1_packing

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["y<|endoftext|>z", "a  <|endoftext|>  b<|endoftext|><|endoftext|>\n", "<|endoftext|", "plain " * 1500 + "<|endoftext|>"]
    assert tokenizer.encode(texts[0], add_special_tokens=False).ids == [88, 50256, 89]
    want = Counter()
    for i, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4")
        for s in range(0, len(ids), 1024):
            want[i, s, len(ids[s : s + 1024]), zlib.crc32(ids[s : s + 1024].tobytes()), len(ids)] += 1
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert Counter(tuple(r)[:5] for r in op1_packing(spark, str(tmp_path)).collect()) == want


def test_packing_plan():
    rng = np.random.default_rng(2)
    histogram = dict(Counter(rng.integers(1, 1025, 40_000).tolist()))
    chosen = packing.plan(histogram)
    used = Counter()
    for lengths, repeats in chosen:
        assert sum(lengths) <= 1024
        for n in lengths:
            used[n] += repeats
    assert used == histogram
    assert sum(r for _, r in chosen) * 1024 < 1.01 * sum(n * c for n, c in histogram.items())


def test_mixing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    rng = np.random.default_rng(4)
    rows = [(k, prose(k, int(rng.integers(1, 200))), f"s{k % 4}" if k % 11 else None) for k in range(400)] + [(900, prose(5, 5), "t"), (901, None, "t"), (902, "", "u")]
    got = mixing.mix(frame(spark, rows)).collect()
    again = mixing.mix(frame(spark, rows[::-1]).repartition(5)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    sizes, source = defaultdict(int), {i: s for i, _, s in rows}
    for i, t, s in rows:
        sizes[s] += len((t or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    target, free, rest = {}, set(names), sum(sizes.values())
    while True:
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3 * sizes[s]
            rest -= target[s]
            free.remove(s)
    taken = defaultdict(int)
    for r in got:
        assert r.target == pytest.approx(target[source[r.doc_id]]) and r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        taken[source[r.doc_id]] += r.taken
    for s in names:
        assert abs(taken[s] - target[s]) <= max(3, 0.002 * target[s])
    copies = mixing.mixed_documents(frame(spark, rows))
    assert copies.columns == frame(spark, rows).columns and copies.count() == sum(r.copies for r in got)
    assert mixing.mix(frame(spark, [])).collect() == []


def test_base_spans():
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]

    def good(k, s):
        digits = re.sub("[^0-9]", "", s)
        return [True, k == 1 and all(int(p) <= 255 for p in s.split(".")), 13 <= len(digits) <= 19 and pii.luhn(digits), 9 <= len(digits) <= 15][k]

    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("a1.@+- 9(%_0)b4"), 50)) for _ in range(4000)] + ["card 4111 1111-1111 1111, a@b.com_x@y.org 1.2.3.4.5.6.7.8 00255.1.1.1 é +1 (555) 010-9999"]
    for x in texts:
        assert pii.base_spans(x) == [(k, m.start(), m.end()) for k, p in enumerate(patterns) for m in re.finditer(p, x) if good(k, m[0])]


def test_personal_data(spark):
    rows = [(1000 + k, f"{prose(k, 9)} mail me{k}@host{k}.org or call +1 555 010 {1000 + k} from {'12.5.7.1' if k % 2 else '300.1.2.3'} x", "s") for k in range(120)] + ODD
    got = {r.doc_id: r for r in pii.find(frame(spark, rows)).collect()}
    assert (got[1000].n_email, got[1000].n_ip, got[1000].n_phone) == (1, 0, 1) and got[1011].n_ip == 1
    assert got[7].spans == "" and got[7].base_sha256 == hashlib.sha256(b"").hexdigest()
    text = rows[3][1]
    assert "@" not in pii.redact(text, got[1003].spans) and "[phone]" in pii.redact(text, got[1003].spans)
    base = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in pii.base_spans(text))
    assert got[1003].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and set(base.split(",")) <= set(got[1003].spans.split(","))
    assert pii.find(frame(spark, [])).collect() == []


def test_search(spark):
    rng = np.random.default_rng(8)
    near = rng.normal(size=(6, 16))
    vectors = [(k, [float(x) for x in near[k % 6] + rng.normal(size=16) * (0.02 if k % 3 else 1.0)]) for k in range(700)]
    vectors[40] = (40, None)
    vectors[41] = (41, [1.0, None, *[0.0] * 14])
    vectors[42] = (42, [float("nan")] * 16)
    vectors += [(None, [1.0] * 16), (1000, vectors[0][1]), (1001, vectors[0][1]), (1001, vectors[0][1]), (1020, [])]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").selectExpr("*", "1 as cell", "2 as part", "3 as v")
    ints = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            ints[i] = [int(np.floor(64.0 * float(np.float32(x)))) for x in v] + [0] * (16 - len(v))
    want = set()
    for q in ints:
        if q % 20 == 0:
            best = sorted((-int(np.dot(ints[q], ints[c])), c) for c in ints if c != q)[:20]
            want |= {(q, k + 1, c, -s) for k, (s, c) in enumerate(best)}
    assert {tuple(r) for r in topk.search(table).collect()} == want
    assert topk.search(table.limit(0)).collect() == []


def labelled(spark, column, bad):
    rows, labels = [], []
    for k in range(240):
        y = int(k % 4 == 0)
        rows.append((k, prose(k, 40) + (bad(k) if y else ""), "s"))
        labels.append((k, y))
    return frame(spark, rows + [(i + 1000 if i else None, t, s) for i, t, s in ODD]), spark.createDataFrame(labels, f"doc_id long, {column} int")


def test_toxicity(spark):
    docs, labels = labelled(spark, "toxic", lambda k: " grobnik zutter" if k % 8 else " z.u.t.t.e.r and gr0bnik " + prose(k, 8))
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert all(r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [r for i, r in got.items() if r.held_out and i < 240]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    none = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert len(none) == docs.count() and all(r.predicted == 0 for r in none)
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns


def test_restorer(spark):
    docs = spark.createDataFrame([(1, "the moron and the idiot are stupid losers with clowns " * 50)], "doc_id long, text string")
    restorer = toxicity.Restorer(toxicity.language_model(docs))
    assert restorer.words("The M0r0n, id!ot s.t.u.p.i.d l o s e r s stuuupid!! cl0wns") == ["the", "moron", "idiot", "stupid", "losers", "stupid", "clowns"]


LIVELY = "the moron and the idiot are stupid losers with clowns you are a moron you idiot an ass as all of us too good the book is stupid "


@pytest.mark.parametrize(
    "text, want",
    [
        ("$tupid !diot as$ a$$ the!! \"$tupid!\" (the idiot)", "stupid idiot ass ass the stupid the idiot"),
        ("stuupid idioot all too good book", "stupid idiot all too good book"),
        ("st" + "u" * 80 + "pid", "stupid"),
        ("a s s", "ass"),
        ("you are a m o r o n", "you are a moron"),
        ("y o u i d i o t", "you idiot"),
        ("1 2 3 4", "1 2 3 4"),
        (".".join(["you.are.a.moron.and.the.idiot.is.stupid"] * 3), " ".join(["you are a moron and the idiot is stupid"] * 3)),
        ("stupid." * 2000, " ".join(["stupid"] * 2000)),
    ],
)
def test_restorer_reads_every_disguise(spark, text, want):
    docs = spark.createDataFrame([(1, LIVELY * 50)], "doc_id long, text string")
    assert toxicity.Restorer(toxicity.language_model(docs)).words(text) == want.split()


def test_quality(spark):
    docs, labels = labelled(spark, "quality", lambda k: "")
    junk = docs.selectExpr("doc_id", "if(doc_id % 4 = 0, regexp_replace(upper(text), ' ', '!! '), text) as text", "source")
    got = {r.doc_id: r for r in quality.quality(junk, labels.selectExpr("doc_id", "1 - quality as quality")).collect()}
    assert all(r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [r for i, r in got.items() if r.held_out and i < 240]
    assert sum(r.predicted == (r.doc_id % 4 != 0) for r in held) >= 0.95 * len(held)
    assert quality.quality(junk.limit(0), labels).collect() == []
    assert len(quality.quality(junk, labels.limit(0)).collect()) == junk.count()


def test_quality_reads_long_words_whole(monkeypatch):
    head = "長い文章" * 10
    first, second = head + "ABCD" * 20, head + "wxyz" * 20
    odds = np.random.default_rng(5).normal(size=quality.BUCKETS)
    values = quality.worth([first, second, "short"], odds)
    assert values[0] != values[1] and not np.array_equal(quality.bag(first)[0], quality.bag(second)[0])
    want = {}
    for w in (first, second, "short", "a"):
        at, weight = quality.bag(w)
        want[w] = (at.tolist(), weight, quality.worth([w], odds)[0])
        assert sum(len(b) for _, b in quality.grams([w])) == quality.gram_counts([w])[0] == 3 * len(w.encode()) + 1
    for piece in (1, 2, 7, 50):  # pieces of a word count as the whole
        monkeypatch.setattr(quality, "PIECE", piece)
        assert np.allclose(quality.worth(list(want), odds), [x for _, _, x in want.values()])
        for w, (at, weight, _) in want.items():
            got = quality.bag(w)
            assert got[0].tolist() == at and np.allclose(got[1], weight)


def test_language(spark):
    texts = {"en": "the house and the garden with the tree of the king ", "de": "das haus und der garten mit dem baum des königs "}
    docs = spark.createDataFrame([(t * 20, l) for l, t in texts.items()] + [(None, "en"), ("x", None)], "text string, lang string")
    page = lambda lang, text, declared: f"<html lang='{declared}'><head><title>no</title></head><body><p>{text}</p></body></html>"
    rows = [(k, f"https://www.{l}{k % 3}.example.{'de' if l == 'de' else 'com'}/a", page(l, texts[l] * 2, l)) for k in range(30) for l in ("en", "de")]
    rows += [(100, "https://www.de1.example.de/empty", "<html></html>"), (101, None, None), (102, "https://www.en0.example.com/b", page("de", texts["de"] * 3, "en"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as best")
    got = langid.identify(pages, docs).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got if r.page_id >= 100}
    assert by[100].lang == "de" and by[100].text_lang is None and by[101].lang in texts and by[102].lang == "de"
    assert all(r.lang == r.text_lang for r in got if r.page_id < 100) and all(0 < r.score <= 1 for r in got)
    assert langid.identify(pages.limit(0), docs).collect() == []
    assert all(r.lang is None for r in langid.identify(pages, docs.limit(0)).collect())


def test_pipeline(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns, name
        docs = corpus_pipeline.keep(after)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_pii_learns_from_every_candidate_and_alike_at_any_size(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tremorlake.llm import pii

    assert not hasattr(pii, "SAMPLE") and len(pii.describe("call +39 081 555", 5, 12, "phone")) == pii.FEATURES
    x = F.array(*[(F.pmod(F.xxhash64("id", F.lit(f)), F.lit(9 + f)) * 1.0) for f in range(pii.FEATURES)])
    rows = spark.range(60_000).select("id", x.alias("x")).select(
        F.col("id").alias("doc_id"), F.lit(1).alias("kind"), F.lit(0).alias("start"), ((F.col("x")[0] > 4) & (F.col("x")[1] > 3)).alias("is_base"), "x"
    )
    asked = []
    grow = pii._grow
    monkeypatch.setattr(pii, "_grow", lambda models, sums_of: asked.append(sums_of(models, None)) or grow(models, sums_of, 3))
    one = pii.learn(rows, 10**6)
    many = pii.learn(rows.repartition(7), 10)
    assert one[1]["trees"] == many[1]["trees"] and len(one[1]["trees"]) == 3
    assert one[1]["threshold"] == many[1]["threshold"] and one[1]["splits"] == many[1]["splits"] and one[0] is None and one[2:] == [None, None]
    seen = rows.filter(F.pmod(F.xxhash64("doc_id", "start"), F.lit(10)) < 7).count()  # the bend at the start is the same for each row
    p = 1 / (1 + 2.718281828459045 ** -one[1]["base"])
    for sums in asked:
        bend = sums[1].reshape(2, pii.FEATURES, -1)[1, 0].sum() / pii.UNIT
        assert seen > 20_000 and abs(bend / (seen * (p * (1 - p) + 1e-6)) - 1) < 1e-3
