"""SimHash, periodic runs and spelling variants against brute force, with NULLs, empty and long texts, ties and repeated rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.test_operators import ODD, frame, prose
from tremorlake.llm import periodic, simhash, spelling

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    if not words:
        return 0
    parts = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest(nodes, edges):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def brute_groups(rows):
    prints = defaultdict(set)
    for i, t in rows:
        prints[i].add(brute_fingerprint(t))
    ids = sorted(prints)
    near = [(a, b) for a in ids for b in ids if a < b and any(bin(x ^ y).count("1") <= 3 for x in prints[a] for y in prints[b])]
    roots = smallest(ids, near)
    return sorted((i, f"{brute_fingerprint(t):016x}", roots[i]) for i, t in rows)


def edited(seed, n=150):
    rng = np.random.default_rng(seed)
    rows = []
    for family in range(6):
        base = prose(300 + family, n).split()
        for k in range(20):
            words = list(base)
            for at in rng.integers(0, n, rng.integers(0, 4)):
                words[at] = f"other{rng.integers(0, 5)}"
            rows.append((family * 100 + k, " ".join(words)))
    return rows


@pytest.mark.parametrize("many", [2000, 2])
def test_fingerprint_groups(spark, monkeypatch, many):
    monkeypatch.setattr(simhash, "MANY", many)
    rows = [*edited(1), (700, None), (701, ""), (702, "Ä one"), (703, "ä ONE"), (704, "Ä  ONE"), (5, prose(9, 50)), (5, prose(9, 50))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "2 as root", "3 as list")
    want = brute_groups(rows)
    assert len({c for _, _, c in want}) < len({i for i, _ in rows})
    assert sorted(tuple(r) for r in simhash.fingerprint_groups(docs).collect()) == want


@pytest.mark.parametrize("many", [2000, 10])
def test_links_of_dense_fingerprints(spark, monkeypatch, many):
    monkeypatch.setattr(simhash, "MANY", many)
    rng = np.random.default_rng(4)
    prints = {-1, 0, 1, -(2**63), 2**63 - 1}
    for center in rng.integers(-(2**63), 2**63 - 1, 3, dtype=np.int64).tolist():
        for _ in range(60):
            flips = int(sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(1, 5)).tolist())))
            prints.add(int(np.uint64((center ^ flips) & (2**64 - 1)).astype(np.int64)))
    prints = sorted(prints)
    want = {(a, b) for a in prints for b in prints if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    got = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long")).collect()
    assert {tuple(sorted(r)) for r in got} == want


def test_exploded_lists_are_never_broadcast(spark, tmp_path):
    spark.range(1000).selectExpr("xxhash64(id) as fp").write.parquet(str(tmp_path / "fp"))  # some kilobytes, so far below Spark's threshold
    members = spark.read.parquet(str(tmp_path / "fp")).selectExpr("0L as g", "fp", "0 as low")
    plan = simhash._met(simhash.listed(members, 32))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_many_rows_are_sent_by_a_shuffle(spark, tmp_path, monkeypatch):
    from tremorlake.llm import common

    spark.range(100).write.parquet(str(tmp_path / "ids"))
    ids = spark.read.parquet(str(tmp_path / "ids"))
    for limit, join in ((100, "BroadcastHashJoin"), (99, "SortMergeJoin")):
        monkeypatch.setattr(common, "SMALL_ROWS", limit)
        joined = ids.join(common.sent(ids)(ids.withColumnRenamed("id", "other")), F.col("id") == F.col("other"))
        assert join in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 100


def test_fingerprint_odd(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 100)
    rows = simhash.fingerprint_groups(frame(spark)).collect()
    assert len(rows) == len(ODD)
    texts = Counter(f"{brute_fingerprint(t):016x}" for _, t, _ in ODD)
    assert Counter(r.fingerprint for r in rows) == texts
    assert {r.component_id for r in rows if r.doc_id is None} == {4}
    assert simhash.fingerprint_groups(frame(spark, [])).collect() == []
    twins = spark.createDataFrame([(9, prose(1, 80)), (9, prose(2, 80)), (3, prose(1, 80)), (4, prose(2, 80)), (None, "q")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in simhash.fingerprint_groups(twins).collect()} == {(9, 3), (3, 3), (4, 3), (None, None)}


def brute_runs(words):
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = q
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(6, 4 * q) and not any(words[start + d : j] == words[start : j - d] for d in range(1, q)):
                found.append((start, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_periodic(doc_id, text, planted):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if planted and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


@pytest.mark.parametrize("planted", [False, True])
def test_periodic_runs(spark, monkeypatch, planted):
    monkeypatch.setattr(periodic, "TOGETHER", 500)
    rng = np.random.default_rng(6)
    rows = [(i, t) for i, t, _ in ODD if not t or len(t) < 5000]
    for k in range(250):
        words = rng.integers(0, rng.integers(1, 5), rng.integers(0, 120)).tolist()
        if words and k % 2:
            a, p = int(rng.integers(0, len(words))), int(rng.integers(1, 12))
            words = [words[i] if i < a else words[min(a + (i - a) % p, len(words) - 1)] for i in range(len(words))]
        rows.append((1000 + k, " ".join(f"w{w}" for w in words)))
    rows += [(3000, "a " * 2000), (3001, "a b " * 900 + "a a a c"), (3002, "a b " * 8), (3003, "x"), (3003, "x x x x x x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start", "2 as n_runs")
    got = [tuple(r) for r in periodic.periodic_runs(docs, planted).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1:2], r[-1])
    assert sorted(got, key=order) == sorted((brute_periodic(i, t, planted) for i, t in rows), key=order)
    assert periodic.periodic_runs(docs.limit(0)).collect() == []


def test_runs_of_long_texts():
    ones = periodic.find_runs(np.zeros(300_000, np.int64), 300_000)
    assert ones.tolist() == [[0, 300_000, 1]]
    assert periodic.find_runs(np.arange(200_000) % 50_000, 200_000).tolist() == [[0, 200_000, 50_000]]
    assert periodic.find_runs(np.arange(200_000), 200_000).tolist() == []


def brute_spelling(rows, planted):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(ASCII_LOWER)
            h = zlib.crc32(f"{i}:{run}".encode())
            if planted and i is not None and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 6 and k >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    out, form = {}, {}
    for w in n:
        close = [v for v in n if v != w and near(w, v)]
        best = min(close, key=lambda v: (-n[v], v)) if close else None
        form[w] = best if best and n[best] >= 5 * n[w] else None
        out[w] = (n[w], len(close), n[form[w]] if form[w] else None)
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, form[w], root, *out[w])
    return sorted(out.values())


def spelt():
    rng = np.random.default_rng(12)
    words = ["wonderful", "étudiant", "Étudiant", "syllable", "aaaaaa", "aaaaaaa", "abcdef", "abcdfe", "bacdef", "abcde÷", "short", "x" * 3000, "x" * 3001, "Wonderful"]
    texts = []
    for word in words:
        for _ in range(12):
            texts += [word] * int(rng.integers(1, 40))
            letters = list(word[:40])
            for _ in range(rng.integers(0, 3)):
                at = int(rng.integers(0, len(letters)))
                letters[at] = rng.choice(list("abcdefxyé÷"))
            texts += ["".join(letters)] * int(rng.integers(1, 12))
    rng.shuffle(texts)
    return [(k, ", ".join(texts[k * 40 : k * 40 + 40])) for k in range(len(texts) // 40 + 1)]


@pytest.mark.parametrize("block,flush,planted", [(1024, 200_000, True), (2, 3, False)])
def test_spelling_variants(spark, monkeypatch, block, flush, planted):
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "FLUSH", flush)
    rows = [*spelt(), (None, "wonderful wonderfull"), (1, None), (2, ""), (3, "1234 œuvre"), (3, "wonderful"), (3, "wonderful")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as word", "2 as n", "3 as cell")
    want = brute_spelling(rows, planted)
    assert any(r[1] for r in want) and any(r[1] is None and r[4] for r in want)
    assert sorted(tuple(r) for r in spelling.spelling_variants(docs, planted).collect()) == want


def test_spelling_chains_and_ties(spark):
    texts = ["aaaaaaaa " * 5, "aaaaaaab " * 25, "aaaaaabb " * 125, "aaaaabbb " * 625, "cccccc " * 5, "cccccd " * 25, "ccccce " * 25]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.word: (r.form, r.root) for r in spelling.spelling_variants(docs).collect()}
    assert got["aaaaaaaa"] == ("aaaaaaab", "aaaaabbb") and got["aaaaabbb"] == (None, "aaaaabbb")
    assert got["cccccc"] == ("cccccd", "cccccd")
    assert spelling.spelling_variants(docs.limit(0)).collect() == []


def test_tables_against_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert sorted(tuple(r) for r in simhash.fingerprint_groups(docs).collect()) == brute_groups(rows)
    assert sorted(tuple(r) for r in periodic.periodic_runs(docs, True).collect()) == sorted(brute_periodic(i, t, True) for i, t in rows)


def test_pipeline_stages_on_odd_rows(spark, folder):
    """Each stage against brute force on what it is given: NULLs, repeated rows, clashing columns, and an empty table."""
    import corpus_pipeline
    from tests.llm.test_operators import brute_components

    given = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(i, t, "en", s, 1, 2, "x") for i, t, s in ODD] + [(1000 + r[0], *tuple(r)[1:], 3, "y") for r in given.limit(60).collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row int, run string")
    normal = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    stages = dict(corpus_pipeline.STAGES)
    empty = docs.limit(0)
    for name in list(stages)[:-1]:
        assert stages[name](spark, empty, folder).collect() == [] and stages[name](spark, empty, folder).columns == docs.columns, name
    assert stages["packing"](spark, empty, folder).collect() == []
    clean = corpus_pipeline.keep(stages["toxicity"](spark, docs, folder))
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} >= {1, 2, 3, 4, 5, 7}
    single = corpus_pipeline.keep(stages["exact dedup"](spark, clean, folder))
    assert Counter(normal(r.text) for r in single.collect()) == Counter({normal(r.text) for r in clean.collect()})
    near = corpus_pipeline.keep(stages["near dedup"](spark, single, folder))
    before = [(r.doc_id, r.text) for r in single.collect() if r.doc_id is not None]
    assert len({i for i, _ in before}) == len(before)
    assert {r.doc_id for r in near.collect() if r.doc_id is not None} == {i for i, (_, root) in brute_components(before).items() if root == i}
    mixed = corpus_pipeline.keep(stages["mixing"](spark, near, folder))
    times = Counter((r.doc_id, r.text) for r in mixed.collect())
    assert set(times) <= {(r.doc_id, r.text) for r in near.collect()} and max(times.values()) <= 3
    packed = stages["packing"](spark, mixed, folder).collect()
    assert Counter(r.doc_id for r in packed if r.start == 0) == Counter(r.doc_id for r in mixed.collect())
