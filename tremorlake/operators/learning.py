"""Scaling, training, scoring, metrics, thresholds, model choice and retraining, on Spark ML and plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tremorlake.operators.joins import nearest
from tremorlake.operators.quality import CheckFailed
from tremorlake.scale import TASK_ROWS, bounded, dealt, fill_in_order, number_rows, running_totals
from tremorlake.session import durable, release

# Training and selection settings.
FIT_SHARE, TEST_SHARE, SEED = 0.85, 0.2, 42
TREES, DEPTH = 200, 10
BOOST_ROUNDS, BOOST_DEPTH, BOOST_PATIENCE = 100, 5, 10
F1_THRESHOLDS, MCC_THRESHOLDS = (0.0, 1.0, 100), (0.01, 0.95, 181)
MODEL_PRIORITY = ["transformer", "random_forest", "xgboost"]
DEPLOY_R2, DEFAULT_DEPLOY_R2 = 0.70, 0.85
RETRAIN_SECONDS, MIN_NEW_ROWS = 2_592_000, 1000
# Trees: a level's nodes in one pass over the rows, and each row's node kept instead of walked to.
FEWER_PASSES = {"maxMemoryInMB": 1024, "cacheNodeIds": True}
CELLS, TREES_AT_ONCE = 2_000_000, 20  # combinations of bins that training rows are summed up by; trees whose bags are drawn in one pass
COMPARED = ["f1_score", "roc_auc", "average_precision", "mcc", "cohen_kappa", "brier_score"]


# --- preparation -------------------------------------------------------------------------------


def scaler_of(df: DataFrame, features: Sequence[str], order: Sequence[str], share: float = FIT_SHARE, hot_rows: int | None = None) -> dict[str, tuple[float, float]]:
    """Mean and population std of each feature over the first ``share`` of the rows in order.

    A constant feature gets scale 1. The result is two numbers a feature.
    """
    given = durable(df.select(*order, *[c for c in features if c not in order]))
    rows = number_rows(given, [], [F.col(c) for c in order], "_pos", hot_rows)
    cut = max(1, int(given.count() * share))
    sums = [f(c).alias(f"{n}_{c}") for c in features for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    found = rows.filter(F.col("_pos") <= cut).agg(*sums).first()
    release(given)
    return {c: (float(found[f"m_{c}"]), float(found[f"s_{c}"]) or 1.0) for c in features}


def scale(df: DataFrame, scaler: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(mean)) / F.lit(std) for c, (mean, std) in scaler.items()})


def scale_causal(df: DataFrame, features: Sequence[str], order: Sequence[str], share: float = FIT_SHARE, hot_rows: int | None = None) -> DataFrame:
    """Standardised features; what comes after the first ``share`` of the rows has no influence."""
    return scale(df, scaler_of(df, features, order, share, hot_rows))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: rows, balanced weight n / (classes x rows), and negatives over positives."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.agg(F.struct(F.sum("n_rows").alias("n"), F.count(F.lit(1)).alias("k")).alias("t")).scalar()
    split = counts.agg(
        F.try_divide(
            F.sum(F.when(F.col(label) == 0, F.col("n_rows"))).cast("double"), F.sum(F.when(F.col(label) == 1, F.col("n_rows")))
        ).alias("ratio")
    ).scalar()
    return counts.select(
        label, "n_rows", (total["n"] / (total["k"] * F.col("n_rows"))).alias("weight"), F.coalesce(split, F.lit(1.0)).alias("neg_over_pos")
    )


def with_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Each row with its class weight; the class table is joined by broadcast after a size check."""
    return df.join(bounded(class_weights(df, label).select(label, F.col("weight").alias(name))), label)


def oversample_minority(
    df: DataFrame, features: Sequence[str], label: str, key: str, k: int = 5, seed: int = SEED, hot_rows: int | None = None
) -> DataFrame:
    """Rows plus synthetic rows of the rarer class, until both classes are equal.

    A synthetic row lies at a seeded random place between a row and one of its k nearest rows of the
    class. The count is exact: row number r of the class gives need div n rows, plus one if
    r <= need mod n.
    """
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) != 2:
        raise CheckFailed(f"{label} must have two classes, not {len(counts)}")
    rare = min(counts, key=lambda c: (counts[c], c))
    have, need = counts[rare], max(counts.values()) - counts[rare]
    plain = df.select(key, *features, label)
    if have < 2 or need == 0:
        return plain
    minority = durable(df.filter(F.col(label) == rare).select(F.col(key).alias("_id"), *[F.col(c).cast("double").alias(c) for c in features]))
    spread = minority.agg(*[F.approx_count_distinct(c).alias(c) for c in features]).first().asDict()
    axes = sorted(features, key=lambda c: -spread[c])  # the two with most distinct values make the cells
    points = minority if len(axes) > 1 else minority.withColumn("_flat", F.lit(0.0))
    axes = axes if len(axes) > 1 else [axes[0], "_flat"]
    ids = points.withColumn("_other", F.col("_id"))
    near = nearest(ids, ids, min(k, have - 1), "_id", "_id", (axes[0], axes[1]), axes[2:], skip_same=True)
    numbered = number_rows(minority, [], [F.col("_id")], "_r", hot_rows)
    copies = F.lit(need // have) + F.when(F.col("_r") <= need % have, 1).otherwise(0)
    made = numbered.filter(copies > 0).select("*", F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("_copy"))
    neighbours = min(k, have - 1)
    made = made.withColumns(
        {
            "rank": (F.pmod(F.xxhash64(F.lit(seed), "_id", "_copy"), F.lit(neighbours)) + 1).cast("int"),
            "_u": F.pmod(F.xxhash64(F.lit(seed + 1), "_id", "_copy"), F.lit(2**52)) / float(2**52),
        }
    )
    other = minority.select(F.col("_id").alias("_id_2"), *[F.col(c).alias(f"_o_{c}") for c in features])
    pairs = made.join(near.select("_id", F.col("rank").cast("int").alias("rank"), "_id_2"), ["_id", "rank"]).join(other, "_id_2")
    synthetic = pairs.select(
        F.lit(None).cast(df.schema[key].dataType).alias(key),
        *[(F.col(c) + F.col("_u") * (F.col(f"_o_{c}") - F.col(c))).alias(c) for c in features],
        F.lit(rare).cast(df.schema[label].dataType).alias(label),
    )
    typed = plain.select(key, *[F.col(c).cast("double").alias(c) for c in features], label)
    return typed.unionByName(synthetic)


# --- training and scoring ----------------------------------------------------------------------


def assembled(df: DataFrame, features: Sequence[str], vector: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=vector).transform(df)


def trainable(df: DataFrame) -> DataFrame:
    """Rows for training, in pieces of bounded size: Spark ML keeps each partition as one block of boxed rows, many times its file's size."""
    rows = df.count()
    return dealt(df, [], rows) if rows > TASK_ROWS else df


def train_random_forest(
    df: DataFrame, features: Sequence[str], label: str, trees: int = TREES, depth: int = DEPTH, seed: int = SEED
) -> Model:
    """Forest on class-balanced weights; one class only is an error."""
    if df.select(label).distinct().limit(2).count() < 2:
        raise CheckFailed(f"{label} has only one class")
    ready = trainable(assembled(with_weights(df, label), features))
    return RandomForestClassifier(
        featuresCol="features", labelCol=label, weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed, **FEWER_PASSES
    ).fit(ready)


def importances(model: Model, features: Sequence[str], spark: SparkSession) -> DataFrame:
    values = model.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(features, values)), "feature STRING, importance DOUBLE").orderBy(F.desc("importance"), "feature")


def train_gbt(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    order: Sequence[str],
    rounds: int = BOOST_ROUNDS,
    depth: int = BOOST_DEPTH,
    seed: int = SEED,
    hot_rows: int | None = None,
) -> Model:
    """Boosted trees on log-loss, cut after the round that was best on the last 15 % of the rows by time; see ``fit_boosting``."""
    return fit_boosting(df, features, label, order, rounds, depth, seed, hot_rows=hot_rows)[0]


def fit_boosting(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    order: Sequence[str],
    rounds: int = BOOST_ROUNDS,
    depth: int = BOOST_DEPTH,
    seed: int = SEED,
    patience: int = BOOST_PATIENCE,
    hot_rows: int | None = None,
) -> tuple[Model, DataFrame]:
    """Boosted trees and their validation curve (round, loss, kept).

    The trees are fitted on the rows before the last 15 % by time, and every prefix of them is scored on these, which
    are the tail of the training rows, never the test set. Kept are the trees up to the best round before the first
    ``patience`` rounds in a row that do not better it.
    """
    numbered = durable(number_rows(with_weights(df, label), [], [F.col(c) for c in order], "_pos", hot_rows))
    cut = max(1, int(numbered.count() * FIT_SHARE))
    ready = assembled(numbered, features)
    head, tail = ready.filter(F.col("_pos") <= cut), ready.filter(F.col("_pos") > cut)
    model = GBTClassifier(featuresCol="features", labelCol=label, weightCol="weight", maxIter=rounds, maxDepth=depth, seed=seed).fit(trainable(head))
    losses = list(model.evaluateEachIteration(tail)) if not tail.isEmpty() else []
    best = best_round(losses, patience) if losses else rounds
    curve = [(i + 1, float(loss), i < best) for i, loss in enumerate(losses)]
    return first_trees(model, best), df.sparkSession.createDataFrame(curve, "round INT, loss DOUBLE, kept BOOLEAN")


def best_round(losses: Sequence[float], patience: int) -> int:
    """The round (from 1) of the least loss, looked for until ``patience`` rounds in a row do not better it."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def first_trees(model: Model, rounds: int) -> Model:
    """The boosted model of the first ``rounds`` trees of ``model``."""
    trees, weights = model._java_obj.trees(), model.treeWeights
    if rounds >= len(weights):
        return model
    gateway = SparkContext._active_spark_context._gateway
    jvm = gateway.jvm
    kept = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    scale = gateway.new_array(jvm.double, rounds)
    for i in range(rounds):
        kept[i], scale[i] = trees[i], float(weights[i])
    return GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(model.uid, kept, scale))


@dataclass
class Scorer:
    """A trained classifier with the preparation that its training used; without a model, the one class that its training had."""

    model: Model | None
    features: list[str]
    scaler: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    threshold: float = 0.5
    only: float | None = None

    def score(self, df: DataFrame, order: Sequence[str], hot_rows: int | None = None) -> DataFrame:
        return score_table(self, df, order, hot_rows)


def fit_scorer(df: DataFrame, features: Sequence[str], label: str, order: Sequence[str], threshold: float = 0.5, **options) -> Scorer:
    """Fill, scale and train a forest; the scorer repeats the same steps on new rows.

    Where all rows have the same label (hours that all see an alarm) there is nothing to learn: every row is scored with it.
    """
    classes = [r[0] for r in df.select(label).distinct().limit(2).collect()]
    if len(classes) == 1 and classes[0] is not None:
        return Scorer(None, list(features), {}, threshold, float(classes[0]))
    filled = fill_in_order(df.select(*order, *features, label), list(order), list(features), both_ways=False).na.fill(0, list(features))
    scaler = scaler_of(filled, features, order)
    return Scorer(train_random_forest(scale(filled, scaler), features, label, **options), list(features), scaler, threshold)


def score_table(scorer: Scorer, df: DataFrame, order: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """Rows with ``probability`` and ``alarm`` (probability >= threshold); a missing feature is an error."""
    missing = [c for c in scorer.features if c not in df.columns]
    if missing:
        raise CheckFailed(f"features that the model expects are missing: {', '.join(missing)}")
    if scorer.model is None:
        return df.select("*", F.lit(scorer.only).alias("probability"), F.lit(int(scorer.only >= scorer.threshold)).alias("alarm"))
    kept = df.select(*df.columns, *[F.col(c).cast("double").alias(f"_x_{c}") for c in scorer.features])
    inputs = [f"_x_{c}" for c in scorer.features]
    filled = fill_in_order(kept, list(order), inputs, both_ways=False, hot_rows=hot_rows).na.fill(0.0, inputs)
    scaled = filled.withColumns(
        {f"_x_{c}": (F.col(f"_x_{c}") - F.lit(m)) / F.lit(s) for c, (m, s) in scorer.scaler.items()}
    )
    ready = assembled(scaled, inputs, scorer.model.getFeaturesCol())
    scored = scorer.model.transform(ready).withColumn("_p", vector_to_array("probability")[1])
    return scored.select(*df.columns, F.col("_p").alias("probability"), (F.col("_p") >= scorer.threshold).cast("int").alias("alarm"))


def regression_metrics(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row: rmse, mse, mae, r2, largest error, rows; squares are taken around the mean."""
    error = F.col(prediction) - F.col(label)
    total = F.var_pop(label)
    mse = F.avg(error * error)
    return scored.agg(
        F.sqrt(mse).alias("rmse"),
        mse.alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(mse, total)).alias("r2"),
        F.max(F.abs(error)).alias("max_error"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def regressor(kind: str, label: str, seed: int = SEED, **options):
    """``random_forest`` (100 trees, depth 10) or ``xgboost`` (boosted trees, 100 rounds, depth 3)."""
    if kind == "random_forest":
        return RandomForestRegressor(featuresCol="features", labelCol=label, seed=seed, **{"numTrees": 100, "maxDepth": 10, **FEWER_PASSES, **options})
    if kind == "xgboost":
        return GBTRegressor(featuresCol="features", labelCol=label, seed=seed, **{"maxIter": 100, "maxDepth": 3, **options})
    raise ValueError(f"unknown model {kind!r}")


def seeded_split(df: DataFrame, key: str, test_share: float = TEST_SHARE, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a seeded hash of the key: the same rows on any cluster and any run."""
    draw = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1_000_000)) / 1e6
    return df.filter(draw >= test_share), df.filter(draw < test_share)


def bins_of(df: DataFrame, features: Sequence[str], label: str, most: int) -> list[list[float]] | None:
    """For each feature at most ``most`` values, told from all rows, that stand for its bins: its values, or its quantiles if it has more.

    None if there would be more than ``CELLS`` combinations of bins, or if a value or label is missing or not finite,
    which training on the rows reports.
    """
    x = {f"_x{i}": F.col(c).cast("double") for i, c in enumerate(features)}
    plain = [F.coalesce(F.abs(c) < float("inf"), F.lit(False)) for c in (*x.values(), F.col(label).cast("double"))]
    values = df.select(*[c.alias(n) for n, c in x.items()], *[c.alias(f"_ok{i}") for i, c in enumerate(plain)])
    odd = F.count_if(~F.array_min(F.array(*[f"_ok{i}" for i in range(len(plain))]))).alias("odd")
    counted = values.agg(odd, *[F.approx_count_distinct(n).alias(n) for n in x]).first()
    if counted["odd"]:
        return None
    shares = [(i + 0.5) / most for i in range(most)]
    told = values.agg(*[(F.collect_set(n) if counted[n] <= most else F.percentile_approx(n, shares, 10_000)).alias(n) for n in x]).first()
    bins = [sorted({float(v) + 0.0 for v in told[n]}) for n in x]
    bins = [b if len(b) <= most else [b[int(share * len(b))] for share in shares] for b in bins]
    return bins if np.prod([float(len(b)) for b in bins]) <= CELLS else None


def summable(estimator) -> bool:
    """Whether the trees of an estimator depend on the rows of a cell by their weight and mean only."""
    if estimator.getMinInstancesPerNode() != 1 or estimator.isDefined(estimator.weightCol):
        return False
    if isinstance(estimator, GBTRegressor):
        return estimator.getLossType() == "squared" and estimator.getSubsamplingRate() == 1 and not estimator.isDefined(estimator.validationIndicatorCol)
    return estimator.getBootstrap()


def poisson_steps(mean: float) -> list[float]:
    """Where the Poisson number of a uniform draw grows by one."""
    term, steps = float(np.exp(-mean)), [0.0]
    while 1 - steps[-1] > 1e-12 and len(steps) < 100:
        steps.append(steps[-1] + term)
        term *= mean / (len(steps) - 1)
    return steps


def cells_of(df: DataFrame, features: Sequence[str], label: str, bins: Sequence[Sequence[float]], trees: Sequence[int], mean: float, seed: int) -> DataFrame:
    """The rows summed up by the bins of their features (_x0, ...): weight and sum of the label, of all rows (_n, _y) without ``trees``,
    else for each tree of its bag (_n0, _y0, ...): each row comes as often as a Poisson number says."""
    ends = (float("-inf"), float("inf"))
    cut = {f"_v{i}": [ends[0], *[float(np.nextafter((a + b) / 2, np.inf)) for a, b in zip(values, values[1:])], ends[1]] for i, values in enumerate(bins)}
    cut = {c: splits for c, splits in cut.items() if len(splits) > 2}  # a Bucketizer wants two buckets at least
    cut |= {f"_u{t}": [ends[0], *poisson_steps(mean)[1:], ends[1]] for t in trees}
    drawn = df.select(
        *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(features)], F.col(label).cast("double").alias("_label"), *[F.rand(seed + t).alias(f"_u{t}") for t in trees]
    )
    placed = Bucketizer(splitsArray=list(cut.values()), inputCols=list(cut), outputCols=[f"_in{c}" for c in cut]).transform(drawn) if cut else drawn
    sums = [F.sum(f"_in_u{t}").alias(f"_n{t}") for t in trees] + [F.sum(F.col(f"_in_u{t}") * F.col("_label")).alias(f"_y{t}") for t in trees]
    plain = [F.count(F.lit(1)).cast("double").alias("_n"), F.sum("_label").alias("_y")]
    summed = placed.groupBy(*[f"_in_v{i}" for i in range(len(bins)) if f"_v{i}" in cut]).agg(*(sums or plain))
    place = [F.col(f"_in_v{i}").cast("int") if f"_v{i}" in cut else F.lit(0) for i in range(len(bins))]
    return durable(summed.withColumns({f"_x{i}": F.element_at(F.array(*map(F.lit, values)), at + 1) for i, (values, at) in enumerate(zip(bins, place))}))


def fit_cells(estimator, df: DataFrame, features: Sequence[str], label: str, bins: Sequence[Sequence[float]]) -> Model:
    """A forest or boosted trees from all rows of ``df``, summed up by the bins of their features.

    Trees see a feature by its bin only, and the variance within a cell is the same on both sides of every split. So a cell with
    the weight and the mean of its rows gives the gains, splits and means that the rows give, and no row is read once a
    level. A tree of a forest has a bag of its own, drawn row by row, so its sums are its own too.
    """
    inputs = [f"_x{i}" for i in range(len(bins))]

    def fit(cells: DataFrame, n: str, y: str, **options) -> Model:
        ready = assembled(cells.filter(F.col(n) > 0).select(*inputs, F.col(n), (F.col(y) / F.col(n)).alias(label)), inputs)
        every = int(np.ceil(np.sqrt(cells.count())))  # Spark ML looks for values in the square of maxBins rows: in all cells
        return regressor_copy(estimator, weightCol=n, maxBins=max(every, estimator.getMaxBins()), **options).fit(ready)

    if isinstance(estimator, GBTRegressor):
        cells = cells_of(df, features, label, bins, [], 1.0, 0)
        model = fit(cells, "_n", "_y")
        release(cells)
        return model
    trees, seed, made = estimator.getNumTrees(), estimator.getSeed(), []
    subset = estimator.getFeatureSubsetStrategy()
    subset = "onethird" if subset == "auto" and trees > 1 else subset
    for low in range(0, trees, TREES_AT_ONCE):
        some = range(low, min(trees, low + TREES_AT_ONCE))
        cells = cells_of(df, features, label, bins, some, estimator.getSubsamplingRate(), seed)
        with ThreadPool(4) as pool:
            one = inheritable_thread_target(df.sparkSession)(lambda t: fit(cells, f"_n{t}", f"_y{t}", numTrees=1, bootstrap=False, seed=seed + t, featureSubsetStrategy=subset))
            made += pool.map(one, some)
        release(cells)
    return forest_of(estimator, made)


def regressor_copy(estimator, **options):
    """The estimator with other options."""
    return estimator.copy({estimator.getParam(name): value for name, value in options.items()})


def forest_of(estimator: RandomForestRegressor, forests: Sequence[RandomForestRegressionModel]) -> RandomForestRegressionModel:
    """The forest of an estimator, of the first tree of each of ``forests``."""
    gateway = SparkContext._active_spark_context._gateway
    ml = gateway.jvm.org.apache.spark.ml.regression
    trees = gateway.new_array(ml.DecisionTreeRegressionModel, len(forests))
    for i, forest in enumerate(forests):
        trees[i] = forest._java_obj.trees()[0]
    return estimator._copyValues(RandomForestRegressionModel(ml.RandomForestRegressionModel(forests[0].uid, trees, forests[0].numFeatures)))


def train_regressors(
    df: DataFrame, features: Sequence[str], label: str, key: str, kinds: Mapping[str, Mapping] | None = None, seed: int = SEED
) -> tuple[dict[str, Model], DataFrame]:
    """Regressors on 80 % of the rows and their metrics on the rest: (models, metrics per model).

    Beyond ``TASK_ROWS`` rows they are summed up by their features' bins first, if that keeps what the trees are made of; see ``fit_cells``.
    """
    ready = assembled(df, features)
    train, test = seeded_split(ready, key, seed=seed)
    pieces = trainable(train)
    models, rows, bins = {}, [], {}
    for kind, options in (kinds or {"random_forest": {}, "xgboost": {}}).items():
        estimator = regressor(kind, label, seed, **options)
        most = estimator.getMaxBins()
        if pieces is not train and summable(estimator) and most not in bins:
            bins[most] = bins_of(train, features, label, most)
        models[kind] = fit_cells(estimator, train, features, label, bins[most]) if bins.get(most) and summable(estimator) else estimator.fit(pieces)
        rows.append(regression_metrics(models[kind].transform(test), label).select(F.lit(kind).alias("model"), "*"))
    made = rows[0]
    for row in rows[1:]:
        made = made.unionByName(row)
    return models, made


def cross_validate_r2(
    df: DataFrame, features: Sequence[str], label: str, key: str, kind: str = "random_forest", folds: int = 5, seed: int = SEED, **options
) -> DataFrame:
    """One row per fold with its R2, and their mean and population std."""
    fold = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(folds)).cast("int")
    ready = trainable(assembled(df, features).withColumn("fold", fold))
    validator = CrossValidator(
        estimator=regressor(kind, label, seed, **options),
        estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=RegressionEvaluator(labelCol=label, metricName="r2"),
        numFolds=folds,
        foldCol="fold",
        collectSubModels=True,
    )
    model = validator.fit(ready)
    evaluator = validator.getEvaluator()
    scores = [
        float(evaluator.evaluate(model.subModels[i][0].transform(ready.filter(F.col("fold") == i)))) for i in range(folds)
    ]
    rows = [(i, s, float(np.mean(scores)), float(np.std(scores))) for i, s in enumerate(scores)]
    return df.sparkSession.createDataFrame(rows, "fold INT, r2 DOUBLE, mean_r2 DOUBLE, std_r2 DOUBLE")


# --- metrics and thresholds --------------------------------------------------------------------


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def _mcc(tn: Column, fp: Column, fn: Column, tp: Column) -> Column:
    tn, fp, fn, tp = (c.cast("double") for c in (tn, fp, fn, tp))
    return _ratio(tp * tn - fp * fn, F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn))


def confusion_metrics(scores: DataFrame, label: str, probability: str, threshold: float = 0.5) -> DataFrame:
    """One row from one pass: the four counts and what follows from them, and the Brier score."""
    positive, hit = F.col(label) == 1, F.col(probability) >= threshold
    counts = scores.agg(
        F.count_if(~positive & ~hit).alias("tn"),
        F.count_if(~positive & hit).alias("fp"),
        F.count_if(positive & ~hit).alias("fn"),
        F.count_if(positive & hit).alias("tp"),
        F.avg((F.col(probability) - F.col(label)) * (F.col(probability) - F.col(label))).alias("brier_score"),
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    agree = _ratio(tn + tp, n)
    chance = _ratio((tp + fp).cast("double") * (tp + fn) + (tn + fn).cast("double") * (tn + fp), n.cast("double") * n)
    return counts.select(
        "tn",
        "fp",
        "fn",
        "tp",
        agree.alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        _mcc(tn, fp, fn, tp).alias("mcc"),
        F.try_divide(agree - chance, 1 - chance).alias("cohen_kappa"),
        "brier_score",
    )


def roc_pr_auc(scores: DataFrame, label: str, probability: str, hot_rows: int | None = None) -> DataFrame:
    """Exact ROC area with ties and average precision as a step sum; 0.5 each if there is one class.

    Rows are first counted per distinct score, so only distinct scores are ordered.
    """
    positive = F.col(label) == 1
    steps = scores.groupBy(F.col(probability).alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    ranked = running_totals(durable(steps), [F.col("score").desc()], {"tp": "pos", "fp": "neg"}, hot_rows)
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))  # positives above each negative, ties half
    precision = F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp"))))
    pos, neg = F.sum("pos"), F.sum("neg")
    both = (pos > 0) & (neg > 0)
    return ranked.agg(
        F.when(both, F.try_divide(area, pos.cast("double") * neg)).otherwise(0.5).alias("roc_auc"),
        F.when(both, F.try_divide(precision, pos.cast("double"))).otherwise(0.5).alias("average_precision"),
    )


def threshold_counts(scores: DataFrame, label: str, probability: str, grid: tuple[float, float, int]) -> DataFrame:
    """tn, fp, fn, tp at each threshold of an even grid: (k, threshold, ...).

    A score goes to the highest threshold it reaches, so rows meet one counter, not the whole grid.
    Then the counters (one per threshold) are summed from above.
    """
    values = np.linspace(*grid).tolist()
    steps = F.array(*[F.lit(v) for v in values])
    p = F.col(probability)
    guess = F.floor((p - grid[0]) / ((grid[1] - grid[0]) / (grid[2] - 1))).cast("int")
    guess = F.least(F.greatest(guess, F.lit(-1)), F.lit(len(values) - 1))
    # rounding may put the guess one off: step to the exact one
    down = F.when((guess >= 0) & (F.get(steps, F.greatest(guess, F.lit(0))) > p), guess - 1).otherwise(guess)
    slot = F.when(F.coalesce(F.get(steps, down + 1) <= p, F.lit(False)), down + 1).otherwise(down)
    positive = F.col(label) == 1
    counts = scores.groupBy(slot.alias("slot")).agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    spark = scores.sparkSession
    lines = spark.createDataFrame(list(enumerate(values)), "k INT, threshold DOUBLE")
    found = durable(counts)
    totals = found.agg(F.coalesce(F.sum("pos"), F.lit(0)), F.coalesce(F.sum("neg"), F.lit(0))).first()
    above = W.orderBy(F.col("k").desc()).rowsBetween(W.unboundedPreceding, 0)
    hits = lines.join(found, lines["k"] == found["slot"], "left").select(
        "k",
        "threshold",
        F.coalesce(F.sum("pos").over(above), F.lit(0)).alias("tp"),
        F.coalesce(F.sum("neg").over(above), F.lit(0)).alias("fp"),
    )
    return hits.select(
        "k", "threshold", (F.lit(totals[1]) - F.col("fp")).alias("tn"), "fp", (F.lit(totals[0]) - F.col("tp")).alias("fn"), "tp"
    )


def threshold_table(scores: DataFrame, label: str, probability: str, grid: tuple[float, float, int] = F1_THRESHOLDS) -> DataFrame:
    """F1, precision and recall at each threshold."""
    counts = threshold_counts(scores, label, probability, grid)
    fp, fn, tp = F.col("fp"), F.col("fn"), F.col("tp")
    return counts.select(
        "k", "threshold", _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"), _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall")
    )


def threshold_sweep_f1(scores: DataFrame, label: str, probability: str, grid: tuple[float, float, int] = F1_THRESHOLDS) -> DataFrame:
    """One row: the first threshold with the best F1; 0.5 and 0 if none is above 0."""
    best = threshold_table(scores, label, probability, grid).agg(F.max(F.struct("f1_score", -F.col("k"), "threshold")).alias("b"))
    good = F.col("b.f1_score") > 0
    return best.select(
        F.when(good, F.col("b.threshold")).otherwise(0.5).alias("threshold"), F.when(good, F.col("b.f1_score")).otherwise(0.0).alias("f1_score")
    )


def threshold_sweep_mcc(scores: DataFrame, label: str, probability: str, grid: tuple[float, float, int] = MCC_THRESHOLDS) -> DataFrame:
    """One row: the first threshold with the best MCC among those that predict both classes.

    (0.5, 0) if the labels have one class or no threshold is usable.
    """
    counts = threshold_counts(scores, label, probability, grid)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    usable = counts.filter((tp + fp > 0) & (tn + fn > 0) & (tp + fn > 0) & (tn + fp > 0)).withColumn("mcc", _mcc(tn, fp, fn, tp))
    best = usable.agg(F.max(F.struct("mcc", -F.col("k"), "threshold")).alias("b"))
    return best.select(F.coalesce("b.threshold", F.lit(0.5)).alias("threshold"), F.coalesce("b.mcc", F.lit(0.0)).alias("mcc"))


# --- choice, comparison, retraining ------------------------------------------------------------


def select_best_model(candidates: DataFrame) -> DataFrame:
    """Best row by average precision, then MCC (NULL or NaN count 0), then the fixed priority."""
    def known(c: str) -> Column:
        return F.coalesce(F.nanvl(F.col(c), F.lit(0.0)), F.lit(0.0))

    place = F.coalesce(*[F.when(F.col("model") == m, i) for i, m in enumerate(MODEL_PRIORITY)], F.lit(len(MODEL_PRIORITY)))
    return candidates.orderBy(known("average_precision").desc(), known("mcc").desc(), place, "model").limit(1)


def select_best_f1(candidates: DataFrame, position: str = "position") -> DataFrame:
    """The older rule: best test F1, the first one trained on ties."""
    return candidates.orderBy(F.col("f1_score").desc_nulls_last(), position).limit(1)


def compare_models_table(candidates: DataFrame, digits: int = 4) -> DataFrame:
    """Six metrics per model, upper-case names, best F1 first."""
    return candidates.select(F.upper("model").alias("model"), *[F.round(c, digits).alias(c) for c in COMPARED]).orderBy(
        F.col("f1_score").desc_nulls_last(), "model"
    )


def retrain_triggers(
    runs: DataFrame,
    rows_now: int | DataFrame,
    now: datetime | Column,
    models: Sequence[str],
    interval_seconds: int = RETRAIN_SECONDS,
    min_new_rows: int = MIN_NEW_ROWS,
    r2_limit: float = DEPLOY_R2,
) -> DataFrame:
    """Models to retrain, with the reasons that hold: time, new rows, or a latest R2 below the limit.

    ``runs`` is the audit of training runs: (model, trained_at, n_rows, r2); ``rows_now`` the training rows there are now, as a number or a
    table to be counted. Of runs at the same time the one with the last model name, the most rows and the largest R2 counts as the latest.
    """
    rows_now = rows_now if isinstance(rows_now, int) else rows_now.count()
    now = F.lit(now) if isinstance(now, datetime) else now
    spark = runs.sparkSession
    latest = runs.groupBy("model").agg(F.max_by("r2", F.struct("trained_at", "n_rows", "r2")).alias("r2"))
    low = latest.filter(F.col("model").isin(list(models))).agg(F.coalesce(F.min("r2") < r2_limit, F.lit(False)).alias("low"))
    last = runs.agg(F.max("trained_at").alias("at"), F.coalesce(F.max_by("n_rows", F.struct("trained_at", "model", "n_rows")), F.lit(0)).alias("n"))
    due = last.select(
        F.coalesce(F.unix_micros(now) - F.unix_micros(F.col("at")) >= interval_seconds * 1_000_000, F.lit(True)).alias("time_due"),
        (F.lit(rows_now) - F.col("n") >= min_new_rows).alias("rows_due"),
        low.scalar().alias("score_due"),
    ).first()
    rows = [(m, *due) for m in models] if any(due) else []
    return spark.createDataFrame(rows, "model STRING, time_due BOOLEAN, rows_due BOOLEAN, score_due BOOLEAN")


def deploy_gate(metrics: DataFrame, r2_limit: float = DEPLOY_R2) -> DataFrame:
    """Rows good enough to deploy."""
    return metrics.filter(F.coalesce(F.col("r2"), F.lit(0.0)) >= r2_limit)
