"""The distributed paths give the same results as the plain ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tremorlake import scale
from tremorlake.operators import aggregates as A, joins as J, neighbours as N
from tremorlake.operators.chains import greedy_anchors
from tremorlake.operators.quality import filter_iqr, first_per_key


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows of which station A holds two thirds, with repeated values."""
    rng = np.random.default_rng(5)
    rows = [("A" if i % 3 else f"S{i % 7}", int(i), float(np.round(rng.normal(), 2))) for i in range(3000)]
    return spark.createDataFrame(rows, "station_code STRING, id LONG, v DOUBLE").repartition(6).cache()


def test_quantiles_of_hot_groups(skewed):
    probs = {"p05": 0.05, "median": 0.5, "p95": 0.95, "top": 1.0}
    pdf = skewed.toPandas()
    want = pdf.groupby("station_code")["v"].quantile(list(probs.values())).unstack()
    for hot_rows in (10**9, 500, 1):
        got = scale.exact_quantiles(skewed, ["station_code"], "v", probs, hot_rows).toPandas().set_index("station_code")
        assert len(got) == len(want)
        for name, p in probs.items():
            assert np.allclose(got[name].sort_index(), want[p].sort_index(), atol=1e-12), (hot_rows, name)


def test_quantiles_of_the_whole_table(skewed):
    values = skewed.toPandas()["v"]
    for hot_rows in (10**9, 10):
        got = scale.exact_quantiles(skewed, [], "v", {"a": 0.25, "b": 0.75}, hot_rows).first()
        assert np.allclose(got, [values.quantile(0.25), values.quantile(0.75)], atol=1e-12)


def test_quantiles_bracket_is_narrow_but_exact(spark):
    """More distinct values than the sketch keeps: the bracket must still hold the exact quantile."""
    df = spark.range(200_000).select(F.lit("k").alias("k"), (F.xxhash64("id") / 1e12).alias("v"))
    values = np.sort([r[0] for r in df.select("v").collect()])
    got = scale.exact_quantiles(df, ["k"], "v", {"a": 0.1, "m": 0.5, "z": 0.999}, 1000).first()
    assert np.allclose([got["a"], got["m"], got["z"]], np.quantile(values, [0.1, 0.5, 0.999]), rtol=1e-12)


def test_row_numbers(skewed):
    order = [F.col("v").desc(), F.col("id")]
    plain = scale.number_rows(skewed, ["station_code"], order, "rn", 10**9)
    for hot_rows in (500, 1):
        spread = scale.number_rows(skewed, ["station_code"], order, "rn", hot_rows, parts=5)
        assert sorted(plain.collect()) == sorted(spread.select(plain.columns).collect())
    whole = scale.number_rows(skewed, [], order, "rn", 10, parts=5)
    assert [r["rn"] for r in whole.orderBy(*order).select("rn").collect()] == list(range(1, 3001))


def test_running_totals(skewed):
    order = [F.col("v"), F.col("id")]
    plain = scale.running_totals(skewed, order, {"total": "id"}, 10**9).collect()
    spread = scale.running_totals(skewed, order, {"total": "id"}, 10, parts=5).collect()
    assert sorted(plain) == sorted(spread)


def test_running_totals_per_group(skewed):
    order, args = [F.col("v"), F.col("id")], {"keys": ["station_code"]}
    plain = scale.running_totals(skewed, order, {"total": "id"}, 10**9, **args).collect()
    spread = scale.running_totals(skewed, order, {"total": "id"}, 10, parts=7, **args).collect()
    assert sorted(plain) == sorted(spread)


def test_ranges_grow_with_rows(spark, monkeypatch):
    assert [scale.range_count(n, 8) for n in (0, 1, 16_000_000, 16_000_001, 10**12)] == [8, 8, 8, 9, 500_000]
    monkeypatch.setattr(scale, "RANGE_ROWS", 500)
    for rows in (4_000, 16_000):
        df = spark.range(rows).select(F.xxhash64("id").alias("v"), "id")
        numbered = scale.number_rows(df, [], [F.col("v")], "rn", hot_rows=10)
        want = [r["id"] for r in df.orderBy("v").collect()]
        assert [r["id"] for r in numbered.orderBy("rn").collect()] == want
        sizes = [r["count"] for r in scale._ranges(df, [], [F.col("v")], rows, None).groupBy("_range").count().collect()]
        assert len(sizes) >= 0.9 * rows / 500 and max(sizes) <= 2 * 500  # split points come from a sample


def test_quantiles_whose_bracket_is_cut_into_ranges(spark):
    """All rows lie in the bracket of a small group, and its totals go by ranges."""
    df = spark.range(3_000).select((F.col("id") % 2).cast("string").alias("k"), (F.xxhash64("id") / 1e12).alias("v"))
    want = {r["k"]: r["q"] for r in df.groupBy("k").agg(F.percentile("v", 0.3).alias("q")).collect()}
    got = {r["k"]: r["q"] for r in scale.exact_quantiles(df, ["k"], "v", {"q": 0.3}, 4).collect()}
    assert got == pytest.approx(want, rel=1e-12)


def test_fill_in_order(skewed):
    holed = skewed.select("id", F.when(F.col("id") % 400 == 399, F.col("v")).alias("v"), F.when(F.col("id") > 2900, F.col("station_code")).alias("s"))
    for both_ways in (True, False):
        plain = scale.fill_in_order(holed, ["id"], ["v", "s"], both_ways, 10**9).orderBy("id").collect()
        spread = scale.fill_in_order(holed, ["id"], ["v", "s"], both_ways, 10, parts=6).orderBy("id").collect()
        assert plain == spread


def test_bounded_switches_off_above_its_limit(skewed):
    small = scale.bounded(skewed.limit(5), 10)
    assert "broadcast" in small._jdf.queryExecution().logical().toString().lower()
    assert scale.bounded(skewed, 10) is skewed


def chain(times, window):
    out, last = [], None
    for t in sorted(set(times)):
        if last is None or t - last > window:
            out.append(t)
            last = t
    return out


@pytest.mark.parametrize("seed,window,blocks", [(1, 10, 3), (2, 50, 2), (3, 7, 4), (4, 1000, 2)])
def test_anchor_chains_in_blocks(spark, seed, window, blocks):
    rng = np.random.default_rng(seed)
    rows = [("dense", int(t)) for t in rng.integers(-3000, 20_000, 4000)]
    rows += [("sparse", int(t)) for t in rng.integers(0, 60_000, 60)] + [("lone", -5)]
    df = spark.createDataFrame(rows, "k STRING, t LONG")
    for hot_rows in (10**9, 100, 1):
        got = {}
        for r in greedy_anchors(df, ["k"], "t", window, blocks, hot_rows).collect():
            got.setdefault(r["k"], []).append(r["anchor"])
        for k in ("dense", "sparse", "lone"):
            assert sorted(got[k]) == chain([t for key, t in rows if key == k], window), (k, hot_rows)


def test_operators_on_their_hot_paths(skewed):
    picks = skewed.withColumnRenamed("v", "delta_seconds")
    plain = A.station_stats(picks, hot_rows=10**9).orderBy("station_code").toPandas()
    spread = A.station_stats(picks, hot_rows=100).orderBy("station_code").toPandas()
    assert np.allclose(plain.iloc[:, 1:].astype(float), spread.iloc[:, 1:].astype(float), atol=1e-12)
    assert filter_iqr(skewed, ["v"], 10**9).count() == filter_iqr(skewed, ["v"], 10).count()
    catalog = skewed.withColumnRenamed("v", "magnitude")
    assert sorted(A.magnitude_counts(catalog, hot_rows=10**9).collect()) == sorted(A.magnitude_counts(catalog, hot_rows=10).collect())


def test_first_per_key_combines_before_the_shuffle(skewed):
    plan = first_per_key(skewed, ["station_code"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan


def brute_nearest(points, k):
    out = {}
    for i, (a, x, y) in enumerate(points):
        ranked = sorted(((x2 - x) ** 2 + (y2 - y) ** 2, b) for b, x2, y2 in points if b != a)
        out[a] = [b for _, b in ranked[:k]]
    return out


def test_nearest_with_crowded_and_lonely_points(spark):
    rng = np.random.default_rng(3)
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(0, 0.001, (300, 2)))]
    points += [(300 + i, 5.0, 5.0) for i in range(150)]  # coincident
    points += [(450 + i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-100, 100, (50, 2)))]
    df = spark.createDataFrame(points, "id LONG, x DOUBLE, y DOUBLE")
    got = {}
    for r in J.nearest(df, df, 4, "id", "id", skip_same=True).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["id_2"]))
    want = brute_nearest(points, 4)
    assert {a: [b for _, b in sorted(v)] for a, v in got.items()} == want


def test_nearest_meets_a_constant_number_of_pairs(spark):
    """A crowded place, a far point, a line of points and far queries: no point meets a whole cluster."""
    rng = np.random.default_rng(31)
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(0, 1e-6, (3000, 2)))]
    points += [(3000 + i, float(x), 0.5) for i, x in enumerate(rng.uniform(0, 1, 1000))]
    points += [(4000, 1e6, 1e6), (4001, -1e6, 3.0), (4002, float("nan"), 1.0), (4003, None, 1.0)]
    df = spark.createDataFrame(points, "id LONG, x DOUBLE, y DOUBLE")
    pairs = N.candidate_pairs(df, df, 5, "id", "id", ["x", "y"], skip_same=True).cache()
    counts = dict(pairs.groupBy("_query").count().collect())
    assert len(counts) == 4002 and sum(counts.values()) < 120 * 4002 and max(counts.values()) < 4000 // 4
    queries = spark.createDataFrame([(f"q{i}", 1e5 + i, -1e5) for i in range(300)] + [("in", 0.0, 0.0)], "q STRING, x DOUBLE, y DOUBLE")
    met = N.candidate_pairs(queries, df, 1, "q", "id", ["x", "y"])
    assert met.count() < 301 * 100
    best = {r["q"]: r["id"] for r in N.nearest(queries, df, 1, "q", "id").collect()}
    sound = [p for p in points if p[1] is not None and p[1] == p[1]]
    for name, x, y in [(f"q{i}", 1e5 + i, -1e5) for i in range(0, 300, 60)] + [("in", 0.0, 0.0)]:
        assert best[name] == min(sound, key=lambda p: ((p[1] - x) ** 2 + (p[2] - y) ** 2, p[0]))[0]


def test_nearest_in_three_dimensions_and_few_points(spark):
    rng = np.random.default_rng(5)
    points = [(i, *map(float, p)) for i, p in enumerate(rng.integers(0, 12, (400, 3)))]
    df = spark.createDataFrame(points, "id LONG, x DOUBLE, y DOUBLE, z DOUBLE")
    got = {}
    for r in N.nearest(df, df, 3, "id", "id", more=["z"], keep=["z"], skip_same=True).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["id_2"]))
    for a, *p in points:
        want = sorted((sum((u - v) ** 2 for u, v in zip(p, q)), b) for b, *q in points if b != a)[:3]
        assert [b for _, b in sorted(got[a])] == [b for _, b in want]
    three = df.filter("id < 3")
    assert N.nearest(three, three, 5, "id", "id", more=["z"], skip_same=True).count() == 6
    with pytest.raises(ValueError):
        N.nearest(three, three.limit(0), 1, "id", "id")


def test_a_crowded_cell_is_cut_into_blocks(spark):
    rng = np.random.default_rng(6)
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(0, 0.01, (500, 2)))] + [(500, 5.0, 5.0)]
    df = spark.createDataFrame(points, "id LONG, x DOUBLE, y DOUBLE")
    cut = J.cell_pairs(df, df, "x", "y", 1.0, 1.0, block=40)
    plain = J.cell_pairs(df, df, "x", "y", 1.0, 1.0)
    assert sorted(map(tuple, cut.select("id", "id_2").collect())) == sorted(map(tuple, plain.select("id", "id_2").collect()))
    assert cut.count() == 500 * 500 + 1
    joined = cut.groupBy(F.spark_partition_id()).count()  # the join's keys decide the tasks
    assert "_a" in cut._jdf.queryExecution().optimizedPlan().toString() and joined.agg(F.sum("count")).first()[0] == 500 * 500 + 1


def test_within_distance_near_the_pole(spark):
    rng = np.random.default_rng(8)
    rows = [(f"P{i}", float(a), float(o)) for i, (a, o) in enumerate(zip(rng.uniform(69, 70, 120), rng.uniform(10, 12, 120)))]
    df = spark.createDataFrame(rows, "station_code STRING, latitude DOUBLE, longitude DOUBLE")

    def km(p, q):
        a1, o1, a2, o2 = map(np.radians, (p[1], p[2], q[1], q[2]))
        h = np.sin((a2 - a1) / 2) ** 2 + np.cos(a1) * np.cos(a2) * np.sin((o2 - o1) / 2) ** 2
        return 2 * 6371 * np.arcsin(np.sqrt(h))

    want = {(p[0], q[0]) for p in rows for q in rows if p != q and km(p, q) < 10}
    assert {(r["source"], r["target"]) for r in J.join_within_distance(df).collect()} == want


@pytest.mark.parametrize("keys", [["k"], []])
def test_quantiles_of_infinite_values(spark, keys):
    inf, nan = float("inf"), float("nan")
    cases = {
        "low": [-inf] * 60 + [float(i) for i in range(40)], "high": [float(i) for i in range(40)] + [inf] * 60, "both": [-inf] * 50 + [1.0] * 3 + [inf] * 50,
        "nan": [nan] * 30 + [float(i % 7) for i in range(70)], "null": [None] * 30 + [2.0] * 50 + [-inf], "ties": [1.0] * 50 + [2.0] * 50, "edge": [-inf, 3.0],
    }
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.597, "e": 0.9, "f": 1.0}
    shown = lambda rows: sorted(str([None if x is None else x if isinstance(x, str) else round(x, 9) for x in r]) for r in rows)
    for group in [list(cases)] if keys else [[name] for name in cases]:
        df = spark.createDataFrame([(name, v) for name in group for v in cases[name]], "k STRING, v DOUBLE")
        large, plain = (scale.exact_quantiles(df, keys, "v", probs, n).collect() for n in (1, 10_000))
        assert shown(large) == shown(plain)


def test_tasks_grow_with_the_rows(spark):
    from tremorlake.scale import dealt

    rows = spark.range(1000).selectExpr("id", "id % 50 AS k", "CAST(NULL AS LONG) AS n")
    sizes = lambda df: [len(part) for part in df.rdd.glom().collect()]
    assert len(sizes(dealt(rows, ["k"], 1000, task_rows=20))) == 50
    assert max(sizes(dealt(rows, [], 1000, task_rows=20))) <= 30
    assert dealt(rows, ["k"], 1000) is rows


def test_windows_and_numbers_sort_a_quota_of_rows_a_task(spark, monkeypatch):
    from tremorlake import scale
    from tremorlake.operators import detection as D

    monkeypatch.setattr(scale, "TASK_ROWS", 100)
    rows = spark.range(3000).selectExpr("CONCAT('S', id % 30) AS s", "id DIV 30 AS n", "CAST(id % 7 AS DOUBLE) AS x")
    chunks = D.chunk_windows(rows, ["s"], 1.0, 2.0, 80.0)
    assert chunks.rdd.getNumPartitions() >= 30
    ratios = D.sta_lta_ratio(rows, ["s"], 2, 5, "n", block_rows=10)
    assert ratios.rdd.getNumPartitions() >= 30 and ratios.count() == 3000
    numbered = scale.number_rows(rows, ["s"], [F.col("n")], "k")
    assert numbered.rdd.getNumPartitions() >= 30 and numbered.filter("k = n + 1").count() == 3000
