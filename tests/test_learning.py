"""Training, scoring, exact metrics, thresholds and resampling."""

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tremorlake.operators import learning as L
from tremorlake.operators.quality import CheckFailed, split_features_target


def scores(spark, labels, probabilities):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(labels, probabilities)], "label INT, p DOUBLE").repartition(3)


@pytest.fixture(scope="module")
def binary(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2))
    raw = 0.8 * x[:, 0] - 0.6 * x[:, 1]
    label = (raw > np.quantile(raw, 0.7)).astype(int)
    return spark.createDataFrame([(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, label))], "t INT, f1 DOUBLE, f2 DOUBLE, label INT").cache()


def test_regressors_find_a_plane(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(a), float(b), float(2 * a + b)) for i, (a, b) in enumerate(rng.uniform(-1, 1, (400, 2)))]
    df = spark.createDataFrame(rows, "k INT, x1 DOUBLE, x2 DOUBLE, target DOUBLE")
    _, metrics = L.train_regressors(df, ["x1", "x2"], "target", "k", {"random_forest": {"numTrees": 20, "maxDepth": 8}, "xgboost": {"maxIter": 30}})
    got = {r["model"]: r for r in metrics.collect()}
    assert got["random_forest"]["r2"] > 0.9 and got["xgboost"]["r2"] > 0.9
    assert got["xgboost"]["max_error"] >= got["xgboost"]["rmse"] >= got["xgboost"]["mae"]
    assert {r["model"] for r in L.deploy_gate(metrics, 0.85).collect()} == {"random_forest", "xgboost"}
    folds = L.cross_validate_r2(df, ["x1", "x2"], "target", "k", folds=3, numTrees=10, maxDepth=6).collect()
    assert len(folds) == 3 and min(r["r2"] for r in folds) > 0.7
    assert abs(folds[0]["mean_r2"] - np.mean([r["r2"] for r in folds])) < 1e-12


def test_split_by_key_is_fixed_and_whole(spark):
    df = spark.range(10_000)
    train, test = L.seeded_split(df, "id")
    assert train.count() + test.count() == 10_000 and 1800 < test.count() < 2200
    assert test.collect() == L.seeded_split(df.repartition(7), "id")[1].orderBy("id").collect()


def test_classifiers_learn(spark, binary):
    forest = L.train_random_forest(binary, ["f1", "f2"], "label", trees=20, depth=5)
    scored = L.score_table(L.Scorer(forest, ["f1", "f2"]), binary, ["t"])
    assert L.confusion_metrics(scored, "label", "probability").first()["f1_score"] > 0.9
    assert abs(sum(r["importance"] for r in L.importances(forest, ["f1", "f2"], spark).collect()) - 1) < 1e-9
    boosted = L.train_gbt(binary, ["f1", "f2"], "label", ["t"], rounds=10, depth=3)
    scored = L.score_table(L.Scorer(boosted, ["f1", "f2"]), binary, ["t"])
    assert L.roc_pr_auc(scored, "label", "probability").first()["roc_auc"] > 0.95
    with pytest.raises(CheckFailed):
        L.train_random_forest(binary.filter("label = 0"), ["f1", "f2"], "label")


def test_scoring_repeats_the_preparation(spark, binary):
    scorer = L.fit_scorer(binary, ["f1", "f2"], "label", ["t"], trees=10, depth=4)
    first = binary.orderBy("t").limit(170).agg(F.avg("f1"), F.stddev_pop("f1")).first()
    np.testing.assert_allclose(scorer.scaler["f1"], first)
    holed = binary.withColumn("f1", F.when(F.col("t") != 5, F.col("f1")))
    got = {r["t"]: r["probability"] for r in scorer.score(holed, ["t"]).collect()}
    filled = binary.withColumn("f1", F.when(F.col("t") == 5, F.lit(binary.filter("t = 4").first()["f1"])).otherwise(F.col("f1")))
    assert got == {r["t"]: r["probability"] for r in scorer.score(filled, ["t"]).collect()}
    with pytest.raises(CheckFailed, match="f2"):
        scorer.score(binary.drop("f2"), ["t"])


@pytest.mark.parametrize("label", [0, 1])
def test_training_rows_of_one_class_score_with_it(spark, binary, label):
    scorer = L.fit_scorer(binary.filter(F.col("label") == label), ["f1", "f2"], "label", ["t"], trees=3, depth=2)
    scored = scorer.score(binary, ["t"])
    assert scored.columns == [*binary.columns, "probability", "alarm"] and scored.count() == binary.count()
    assert {(r["probability"], r["alarm"]) for r in scored.collect()} == {(float(label), label)}
    with pytest.raises(CheckFailed, match="f2"):
        scorer.score(binary.drop("f2"), ["t"])


def test_training_rows_come_in_pieces_of_bounded_size(spark, monkeypatch):
    from tremorlake import scale

    monkeypatch.setattr(scale, "TASK_ROWS", 100)
    monkeypatch.setattr(L, "TASK_ROWS", 100)
    rows = spark.range(2000).selectExpr("id", "CAST(NULL AS LONG) AS k", "id % 2 AS y").coalesce(1)
    pieces = L.trainable(rows).rdd.glom().map(len).collect()
    assert sum(pieces) == 2000 and max(pieces) <= 150
    seen = []
    monkeypatch.setattr(L, "trainable", lambda df: seen.append(df.count()) or df)
    options = {"random_forest": {"numTrees": 1, "maxDepth": 1}, "xgboost": {"maxIter": 1, "maxDepth": 1}}
    L.train_regressors(rows.withColumn("y", F.col("y").cast("double")), ["id"], "y", "id", options)
    assert seen and 1400 < seen[0] < 1800


@pytest.fixture(scope="module")
def graded(spark):
    """Rows with features of few values, one of a single value, and a label that says more than they do."""
    made = spark.range(4000).selectExpr("id AS k", "CAST(id % 17 AS DOUBLE) AS a", "CAST(pmod(xxhash64(id), 23) AS INT) - 11 AS b", "3.5 AS c")
    return made.withColumn("y", F.col("a") * F.col("a") + F.abs("b") * 3.0 + F.pmod(F.xxhash64("k", "a"), F.lit(100)) / 50.0).cache()


def test_boosting_on_cells_equals_boosting_on_rows(spark, graded):
    features = ["a", "b", "c"]
    rows = L.assembled(graded, features)
    estimator = L.regressor("xgboost", "y", maxIter=6)
    bins = L.bins_of(rows, features, "y", estimator.getMaxBins())
    assert [len(b) for b in bins] == [17, 23, 1]
    plain, summed = estimator.fit(rows), L.fit_cells(estimator, rows, features, "y", bins)
    both = plain.transform(rows).select("k", "prediction").join(summed.transform(rows).select("k", F.col("prediction").alias("p")), "k")
    assert both.filter(F.abs(F.col("prediction") - F.col("p")) > 1e-8).count() == 0
    assert len(summed.trees) == 6 and summed.trees[0].toDebugString.count("If") == plain.trees[0].toDebugString.count("If")


def test_cells_hold_every_row_and_a_bag_for_each_tree(spark, graded):
    bins = L.bins_of(graded, ["a", "b", "c"], "y", 8)  # fewer bins than values
    assert [len(b) for b in bins] == [8, 8, 1]
    cells = L.cells_of(graded, ["a", "b", "c"], "y", bins, [], 1.0, 0)
    rows, total = graded.agg(F.count("*"), F.sum("y")).first()
    n, y, count = cells.agg(F.sum("_n"), F.sum("_y"), F.count("*")).first()
    assert (n, count) == (rows, 64) and abs(y - total) < 1e-6
    bags = L.cells_of(graded, ["a", "b", "c"], "y", bins, [0, 1], 1.0, 7).agg(F.sum("_n0"), F.sum("_n1"), F.sum("_y0"), F.sum("_y1")).first()
    assert all(abs(b - rows) < 300 and abs(s / b - total / rows) < 3 for b, s in zip(bags[:2], bags[2:])) and bags[0] != bags[1]
    steps = np.array(L.poisson_steps(1.0))
    assert np.allclose(np.diff(steps)[:4], np.exp(-1.0) / np.array([1, 1, 2, 6])) and 1 - steps[-1] < 1e-11


def test_regressors_of_many_rows_are_fitted_on_cells(spark, graded, monkeypatch):
    from pyspark.ml.base import Estimator
    from tremorlake import scale

    seen, fit = [], Estimator.fit
    monkeypatch.setattr(Estimator, "fit", lambda self, df, *params: seen.append(df.count()) or fit(self, df, *params))
    kinds = {"random_forest": {"numTrees": 8, "maxDepth": 8, "featureSubsetStrategy": "all"}, "xgboost": {"maxIter": 12}}
    plain = {r["model"]: r for r in L.train_regressors(graded, ["a", "b", "c"], "y", "k", kinds)[1].collect()}
    assert min(seen) > 3000
    seen.clear()
    for module in (scale, L):
        monkeypatch.setattr(module, "TASK_ROWS", 1000)
    models, made = L.train_regressors(graded, ["a", "b", "c"], "y", "k", kinds)
    summed = {r["model"]: r for r in made.collect()}
    assert max(seen) <= 17 * 23 and len(models["random_forest"].trees) == models["random_forest"].getNumTrees == 8
    assert summed["xgboost"]["n_rows"] == plain["xgboost"]["n_rows"] and abs(summed["xgboost"]["rmse"] - plain["xgboost"]["rmse"]) < 1e-6
    assert abs(summed["random_forest"]["r2"] - plain["random_forest"]["r2"]) < 0.05 and summed["random_forest"]["r2"] > 0.85


def test_rows_that_cannot_be_summed_up_are_fitted_as_they_are(spark, graded, monkeypatch):
    from tremorlake import scale

    for module in (scale, L):
        monkeypatch.setattr(module, "TASK_ROWS", 1000)
    one = {"xgboost": {"maxIter": 2}}
    with pytest.raises(Exception, match="null|NULL"):
        L.train_regressors(graded.withColumn("a", F.when(F.col("k") != 77, F.col("a"))), ["a", "b"], "y", "k", one)[1].collect()
    monkeypatch.setattr(L, "fit_cells", lambda *_: pytest.fail("summed up"))
    L.train_regressors(graded, ["a", "b"], "y", "k", {"xgboost": {"maxIter": 2, "subsamplingRate": 0.5}})
    monkeypatch.setattr(L, "CELLS", 17 * 23 - 1)
    L.train_regressors(graded, ["a", "b"], "y", "k", one)


def test_constant_feature_scales_by_one(spark):
    df = spark.createDataFrame([(i, 5.0, float(i)) for i in range(20)], "t INT, c DOUBLE, v DOUBLE")
    got = L.scale_causal(df, ["c", "v"], ["t"]).orderBy("t").collect()
    assert {r["c"] for r in got} == {0.0}
    head = np.arange(17)
    np.testing.assert_allclose([r["v"] for r in got], (np.arange(20) - head.mean()) / head.std())


def test_areas_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    y, p = rng.integers(0, 2, 300), np.round(rng.random(300), 2)
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    ap, recall = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        r = (y[hit] == 1).sum() / (y == 1).sum()
        ap += (r - recall) * (y[hit] == 1).mean()
        recall = r
    for hot_rows in (10**9, 10):
        got = L.roc_pr_auc(scores(spark, y, p), "label", "p", hot_rows).first()
        np.testing.assert_allclose(got, [auc, ap], rtol=1e-12)
    assert tuple(L.roc_pr_auc(scores(spark, [1, 1], [0.2, 0.3]), "label", "p").first()) == (0.5, 0.5)


def test_threshold_choice(spark):
    rng = np.random.default_rng(2)
    y = np.r_[np.zeros(50), np.ones(50)]
    p = np.r_[rng.uniform(0, 0.4, 50), rng.uniform(0.6, 1, 50)]
    best = L.threshold_sweep_mcc(scores(spark, y, p), "label", "p").first()
    assert 0.35 <= best["threshold"] <= 0.65 and best["mcc"] > 0.9
    assert tuple(L.threshold_sweep_mcc(scores(spark, [0, 1], [0.99, 0.99]), "label", "p").first()) == (0.5, 0.0)
    assert tuple(L.threshold_sweep_mcc(scores(spark, [1, 1], [0.2, 0.8]), "label", "p").first()) == (0.5, 0.0)
    assert tuple(L.threshold_sweep_f1(scores(spark, [0, 0], [0.2, 0.8]), "label", "p").first()) == (0.5, 0.0)


def test_threshold_counts_equal_direct_counts(spark):
    rng = np.random.default_rng(5)
    grid = L.MCC_THRESHOLDS
    values = np.linspace(*grid)
    p = np.r_[rng.random(300), values[::7], np.nextafter(values[::9], 0), np.nextafter(values[::11], 1), [0.0, 1.0, 0.01, 0.95]]
    y = rng.integers(0, 2, len(p))
    got = L.threshold_counts(scores(spark, y, p), "label", "p", grid).orderBy("k").collect()
    assert len(got) == grid[2]
    for r, t in zip(got, values):
        hit = p >= t
        assert (r["tn"], r["fp"], r["fn"], r["tp"]) == tuple(int(((y == a) & (hit == b)).sum()) for a, b in ((0, 0), (0, 1), (1, 0), (1, 1)))


def test_metrics_at_thresholds(spark):
    df = scores(spark, [0, 1, 0, 1], [0.4, 0.6, 0.4, 0.6])
    assert [L.confusion_metrics(df, "label", "p", t).first()["accuracy"] for t in (0.5, 0.9, 0.1)] == [1.0, 0.5, 0.5]
    row = L.confusion_metrics(df, "label", "p", 0.9).first()
    assert (row["precision"], row["recall"], row["f1_score"], row["mcc"], row["cohen_kappa"]) == (0, 0, 0, 0, 0)


def test_best_model_ties(spark):
    schema = "model STRING, average_precision DOUBLE, mcc DOUBLE"

    def best(rows):
        return L.select_best_model(spark.createDataFrame(rows, schema)).first()["model"]

    assert best([("xgboost", 0.2, 0.9), ("transformer", 0.9, 0.1)]) == "transformer"
    assert best([("xgboost", 0.5, float("nan")), ("random_forest", 0.5, None), ("transformer", 0.5, 0.1)]) == "transformer"
    assert best([("xgboost", 0.0, 0.0), ("random_forest", 0.0, 0.0)]) == "random_forest"
    assert best([("other", 0.0, 0.0), ("xgboost", None, None)]) == "xgboost"


def test_retraining_reasons(spark):
    schema = "model STRING, trained_at TIMESTAMP, n_rows LONG, r2 DOUBLE"
    runs = spark.createDataFrame([("a", datetime(2024, 1, 1), 500, 0.2), ("a", datetime(2024, 1, 9), 900, 0.9)], schema)
    call = lambda rows, day: L.retrain_triggers(runs, rows, datetime(2024, 1, day), ["a", "b"], 5 * 86400).collect()
    assert call(1000, 10) == []
    assert [(r["model"], r["rows_due"], r["time_due"]) for r in call(1900, 10)] == [("a", True, False), ("b", True, False)]
    assert all(r["time_due"] for r in call(900, 14)) and len(call(900, 14)) == 2
    assert len(L.retrain_triggers(runs.limit(0), 0, datetime(2024, 1, 1), ["a"]).collect()) == 1


def test_oversampling_lies_between_neighbours(spark):
    rng = np.random.default_rng(6)
    rows = [(i, float(a), float(b), 7.0, 0) for i, (a, b) in enumerate(rng.normal(5, 1, (60, 2)))]
    rare = [(100 + i, float(a), float(b), 7.0, 1) for i, (a, b) in enumerate(rng.normal(0, 1, (13, 2)))]
    df = spark.createDataFrame(rows + rare, "k INT, a DOUBLE, b DOUBLE, c DOUBLE, label INT")
    made = L.oversample_minority(df, ["a", "b", "c"], "label", "k", k=3)
    got = made.collect()
    assert sorted(r["label"] for r in got) == [0] * 60 + [1] * 60
    assert sorted(map(tuple, made.collect()), key=str) == sorted(map(tuple, got), key=str)  # seeded
    points = np.array([[r[1], r[2]] for r in rare])
    near = {i: np.argsort(((points - points[i]) ** 2).sum(axis=1), kind="stable")[1:4] for i in range(13)}
    for r in got:
        if r["k"] is None:
            x = np.array([r["a"], r["b"]])
            gaps = [abs(np.cross(np.r_[points[j] - points[i], 0], np.r_[x - points[i], 0])[2]) for i in near for j in near[i]]
            assert min(gaps) < 1e-9 and r["c"] == 7.0
    with pytest.raises(CheckFailed):
        L.oversample_minority(df.filter("label = 0"), ["a"], "label", "k")


def test_features_and_target(spark):
    df = spark.createDataFrame([(1, 2, None), (3, 4, 5)], "a INT, b INT, y INT")
    rows, features, target = split_features_target(df)
    assert (rows.count(), features, target) == (1, ["a", "b"], "y")
    assert L.assembled(rows, features).first()["features"].toArray().tolist() == [3.0, 4.0]


def test_class_weights(spark):
    got = {r["label"]: (r["weight"], r["neg_over_pos"]) for r in L.class_weights(scores(spark, [0, 0, 0, 1], [0] * 4), "label").collect()}
    assert got == {0: (4 / 6, 3.0), 1: (2.0, 3.0)}


def test_boosting_is_cut_at_its_best_round(spark):
    rng = np.random.default_rng(9)
    x = rng.uniform(0, 1, (400, 2))
    steady = (x[:, 0] + x[:, 1] > 1).astype(int)
    for turned, rounds in ((False, None), (True, 1)):
        y = np.where(np.arange(400) >= 340, 1 - steady, steady) if turned else steady  # a tail with the opposite labels gains from no round
        rows = [(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y))]
        df = spark.createDataFrame(rows, "t INT, a DOUBLE, b DOUBLE, label INT")
        model, curve = L.fit_boosting(df, ["a", "b"], "label", ["t"], rounds=6, depth=2)
        losses = [r["loss"] for r in curve.orderBy("round").collect()]
        best = losses.index(min(losses)) + 1
        assert len(losses) == 6 and len(model.treeWeights) == best == curve.filter("kept").count() and best == (rounds or best)
        assert turned or best > 1
        assert L.score_table(L.Scorer(model, ["a", "b"]), df, ["t"]).count() == 400
    assert L.best_round([5, 4, 3, 3.5, 3.4, 3.3, 1], 3) == 3 and L.best_round([5, 4, 3, 3.5, 3.4, 3.3, 1], 4) == 7 and L.best_round([1, 2], 10) == 1
