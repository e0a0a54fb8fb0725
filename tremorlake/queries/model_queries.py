"""Queries for scaling, training, scoring, metrics and model choice."""

from __future__ import annotations

from pyspark.sql import functions as F

from tremorlake.operators import aggregates as A, learning as L
from tremorlake.operators.windows import temporal_split
from tremorlake.plans.features import hourly_features_view
from tremorlake.queries import query
from tremorlake.queries.feature_queries import _hourly
from tremorlake.session import durable

FEATURES = "eventi_ultime_24h energia_max_ultime_24h energia_media_ultime_24h net_rms_log_ratio_6h frac_stations_2x_6h ora_del_giorno".split()


@query(
    "scale_causal",
    "hourly",
    """, fit AS (SELECT avg(numero_eventi) AS a, stddev_pop(numero_eventi) AS sa, avg(energia_max) AS b, stddev_pop(energia_max) AS sb
      FROM (SELECT * FROM hourly ORDER BY timestamp LIMIT (SELECT CAST(floor(count(*) * 0.85e0) AS BIGINT) FROM hourly)))
    SELECT timestamp, (numero_eventi - a) / sa AS numero_eventi, (energia_max - b) / sb AS energia_max FROM hourly, fit""",
    "numero_eventi energia_max",
)
def _(t):
    rows = _hourly(t).select("timestamp", "numero_eventi", "energia_max")
    return L.scale_causal(rows, ["numero_eventi", "energia_max"], ["timestamp"])


@query(
    "class_weights",
    "scores",
    """ SELECT label, count(*) AS n_rows, (SELECT count(*) FROM scores) / (2e0 * count(*)) AS weight,
    (SELECT count(*) FILTER (label = 0) / count(*) FILTER (label = 1)::DOUBLE FROM scores) AS neg_over_pos FROM scores GROUP BY label""",
    "weight neg_over_pos",
)
def _(t):
    return L.class_weights(t.scores, "label")


def labelled_hours(t):
    rows = hourly_features_view(t.picks, t.catalog, t.energy, label_events=t.big_events)
    return durable(rows.select("timestamp", *FEATURES, "Target_Allarme"))


def labelled_picks(t):
    """Each pick with numeric features and the alarm of a large delta: training rows that grow with the data."""
    return t.picks.select(
        "pick_id",
        "arrival_iso",
        F.hour("arrival_iso").cast("double").alias("ora"),
        (F.col("event_id") % 97).cast("double").alias("phase"),
        F.log1p("delta_seconds").alias("log_amplitude"),
        (F.col("delta_seconds") + F.hour("arrival_iso") / 10.0 >= 9).cast("int").alias("label"),
    )


PICK_FEATURES = ["ora", "phase", "log_amplitude"]


@query("train_random_forest")
def _(t):
    model = L.train_random_forest(labelled_picks(t), PICK_FEATURES, "label", trees=20, depth=6)
    return L.importances(model, PICK_FEATURES, t.spark)


@query("train_gbt")
def _(t):
    rows = durable(labelled_picks(t))
    model = L.train_gbt(rows, PICK_FEATURES, "label", ["arrival_iso", "pick_id"], rounds=8, depth=4)
    scored = L.score_table(L.Scorer(model, PICK_FEATURES), rows, ["pick_id"])
    return L.confusion_metrics(scored, "label", "probability")


@query("boosting_curve")
def _(t):
    """The validation loss after each round, and the rounds that the model keeps."""
    curve = L.fit_boosting(durable(labelled_picks(t)), PICK_FEATURES, "label", ["arrival_iso", "pick_id"], rounds=12, depth=4)[1]
    return curve.select("round", F.round("loss", 6).alias("loss"), "kept")


@query("train_regressors")
def _(t):
    lines = t.raw("lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_key"),
        F.col("l_extendedprice").alias("delta_seconds"),
        "l_quantity",
        "l_discount",
        "l_tax",
    )
    rows = durable(A.risk_proxy_target(lines))
    kinds = {"random_forest": {"numTrees": 10, "maxDepth": 6}, "xgboost": {"maxIter": 8, "maxDepth": 3}}
    features = ["delta_seconds", "l_quantity", "l_discount", "l_tax"]
    return L.train_regressors(rows, features, "risk", "row_key", kinds)[1]


@query("cross_validate_r2")
def _(t):
    rows = durable(A.risk_proxy_target(t.picks.select("pick_id", "delta_seconds", F.hour("arrival_iso").alias("ora"))))
    return L.cross_validate_r2(rows, ["delta_seconds", "ora"], "risk", "pick_id", folds=5, numTrees=5, maxDepth=5)


@query("score_table")
def _(t):
    split = temporal_split(labelled_hours(t), ["timestamp"], "Target_Allarme")
    scorer = L.fit_scorer(split.filter("split = 'train'"), FEATURES, "Target_Allarme", ["timestamp"], trees=20, depth=5)
    scored = scorer.score(split.filter("split = 'test'"), ["timestamp"])
    return scored.select("timestamp", "Target_Allarme", "probability", "alarm")


CONFUSION = """counts AS (SELECT count(*) FILTER (label = 0 AND score < 0.5e0)::DOUBLE AS tn, count(*) FILTER (label = 0 AND score >= 0.5e0)::DOUBLE AS fp,
  count(*) FILTER (label = 1 AND score < 0.5e0)::DOUBLE AS fn, count(*) FILTER (label = 1 AND score >= 0.5e0)::DOUBLE AS tp,
  avg((score - label) * (score - label)) AS brier_score FROM scores)"""


@query(
    "confusion_metrics",
    "scores",
    f""", {CONFUSION}, more AS (SELECT *, tn + fp + fn + tp AS n, (tn + tp) / (tn + fp + fn + tp) AS po,
      ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (tn + fp + fn + tp) ** 2 AS pe FROM counts)
    SELECT tn::BIGINT AS tn, fp::BIGINT AS fp, fn::BIGINT AS fn, tp::BIGINT AS tp, po AS accuracy, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall,
      2 * tp / (2 * tp + fp + fn) AS f1_score, (tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) AS mcc,
      (po - pe) / (1 - pe) AS cohen_kappa, brier_score FROM more""",
    "accuracy precision recall f1_score mcc cohen_kappa brier_score",
)
def _(t):
    return L.confusion_metrics(t.scores, "label", "score")


@query(
    "roc_pr_auc",
    "scores",
    """, p AS (SELECT score FROM scores WHERE label = 1), q AS (SELECT score FROM scores WHERE label = 0),
    steps AS (SELECT s.score, count(*) FILTER (s.label = 1) AS pos, (SELECT count(*) FILTER (x.label = 1) / count(*)::DOUBLE FROM scores x WHERE x.score >= s.score) AS prec
      FROM scores s GROUP BY s.score)
    SELECT (SELECT avg(CASE WHEN p.score > q.score THEN 1e0 WHEN p.score = q.score THEN 0.5e0 ELSE 0e0 END) FROM p, q) AS roc_auc,
      (SELECT sum(pos * prec) / sum(pos) FROM steps) AS average_precision""",
    "roc_auc average_precision",
)
def _(t):
    return L.roc_pr_auc(t.scores, "label", "score")


def sweep_sql(grid: tuple[float, float, int]) -> str:
    import numpy as np

    values = ", ".join(f"({k}, {v!r}::DOUBLE)" for k, v in enumerate(np.linspace(*grid).tolist()))
    return f"""lines(k, threshold) AS (SELECT * FROM (VALUES {values})),
    swept AS (SELECT k, threshold, count(*) FILTER (label = 1 AND score >= threshold)::DOUBLE AS tp, count(*) FILTER (label = 0 AND score >= threshold)::DOUBLE AS fp,
      count(*) FILTER (label = 1 AND score < threshold)::DOUBLE AS fn, count(*) FILTER (label = 0 AND score < threshold)::DOUBLE AS tn
      FROM lines, scores GROUP BY k, threshold)"""


@query(
    "threshold_sweep_f1",
    "scores",
    f""", {sweep_sql(L.F1_THRESHOLDS)}, rated AS (SELECT k, threshold, 2 * tp / nullif(2 * tp + fp + fn, 0) AS f1_score FROM swept)
    SELECT threshold, f1_score FROM rated ORDER BY f1_score DESC NULLS LAST, k LIMIT 1""",
    "threshold f1_score",
)
def _(t):
    return L.threshold_sweep_f1(t.scores, "label", "score")


@query(
    "threshold_table",
    "scores",
    f""", {sweep_sql(L.F1_THRESHOLDS)} SELECT k, threshold, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0e0) AS f1_score,
    coalesce(tp / nullif(tp + fp, 0), 0e0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0e0) AS recall FROM swept""",
    "threshold f1_score precision recall",
)
def _(t):
    return L.threshold_table(t.scores, "label", "score")


@query(
    "threshold_sweep_mcc",
    "scores",
    f""", {sweep_sql(L.MCC_THRESHOLDS)}, rated AS (SELECT k, threshold,
      round((tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 12) AS mcc FROM swept WHERE tp + fp > 0 AND tn + fn > 0)
    SELECT threshold, mcc FROM rated ORDER BY mcc DESC, k LIMIT 1""",
    "threshold mcc",
)
def _(t):
    return L.threshold_sweep_mcc(t.scores, "label", "score")


MODELS = """models AS (SELECT CASE channel WHEN 'view' THEN 'transformer' WHEN 'click' THEN 'random_forest' WHEN 'error' THEN 'xgboost' ELSE channel END AS model,
  round(avg(delta_seconds) / 10, 1) AS average_precision, CASE WHEN channel <> 'view' THEN round(max(delta_seconds) / 50, 1) END AS mcc,
  avg(delta_seconds) / 7 AS f1_score, stddev_pop(delta_seconds) / 10 AS roc_auc, avg(delta_seconds) / 9 AS cohen_kappa,
  avg(delta_seconds) / 11 AS brier_score, min(pick_id) AS position FROM picks GROUP BY channel)"""


def models(t):
    name = F.coalesce(
        F.when(F.col("channel") == "view", "transformer"),
        F.when(F.col("channel") == "click", "random_forest"),
        F.when(F.col("channel") == "error", "xgboost"),
        F.col("channel"),
    )
    mean = F.avg("delta_seconds")
    made = t.picks.groupBy("channel").agg(
        F.round(mean / 10, 1).alias("average_precision"),
        F.round(F.max("delta_seconds") / 50, 1).alias("top"),
        (mean / 7).alias("f1_score"),
        (F.stddev_pop("delta_seconds") / 10).alias("roc_auc"),
        (mean / 9).alias("cohen_kappa"),
        (mean / 11).alias("brier_score"),
        F.min("pick_id").alias("position"),
    )
    return made.select("*", name.alias("model"), F.when(F.col("channel") != "view", F.col("top")).alias("mcc")).drop("channel", "top")


@query(
    "select_best_model",
    "picks",
    f""", {MODELS} SELECT model, average_precision, mcc FROM models ORDER BY average_precision DESC, coalesce(mcc, 0) DESC,
    CASE model WHEN 'transformer' THEN 0 WHEN 'random_forest' THEN 1 WHEN 'xgboost' THEN 2 ELSE 3 END, model LIMIT 1""",
    "average_precision mcc",
)
def _(t):
    return L.select_best_model(models(t)).select("model", "average_precision", "mcc")


@query("select_best_f1", "picks", f", {MODELS} SELECT model, f1_score FROM models ORDER BY f1_score DESC, position LIMIT 1", "f1_score")
def _(t):
    return L.select_best_f1(models(t)).select("model", "f1_score")


@query(
    "compare_models_table",
    "picks",
    f""", {MODELS} SELECT upper(model) AS model, round(f1_score, 4) AS f1_score, round(roc_auc, 4) AS roc_auc, round(average_precision, 4) AS average_precision,
    round(mcc, 4) AS mcc, round(cohen_kappa, 4) AS cohen_kappa, round(brier_score, 4) AS brier_score FROM models ORDER BY 2 DESC, 1""",
    "f1_score:4 roc_auc:4 average_precision:4 mcc:4 cohen_kappa:4 brier_score:4",
)
def _(t):
    return L.compare_models_table(models(t))


AUDIT = """audit AS (SELECT CASE run_id WHEN 'run_0' THEN 'random_forest' ELSE 'xgboost' END AS model, CAST(arrival_iso AS DATE)::TIMESTAMP AS trained_at,
  count(*) AS n_rows, avg(delta_seconds) / 10 AS r2 FROM picks GROUP BY 1, 2)"""


def audit(t):
    model = F.when(F.col("run_id") == "run_0", "random_forest").otherwise("xgboost").alias("model")
    return t.picks.groupBy(model, F.date_trunc("day", "arrival_iso").alias("trained_at")).agg(
        F.count(F.lit(1)).alias("n_rows"), (F.avg("delta_seconds") / 10).alias("r2")
    )


@query(
    "retrain_triggers",
    "picks",
    f""", {AUDIT}, last AS (SELECT max(trained_at) AS trained, max_by(n_rows, (trained_at, model)) AS n FROM audit),
    low AS (SELECT min(r2) < 0.7e0 AS score_due FROM (SELECT model, max_by(r2, trained_at) AS r2 FROM audit GROUP BY model))
    SELECT model, (TIMESTAMP '2024-02-10 00:00:00' - trained >= INTERVAL 2592000 SECOND)::INTEGER AS time_due, score_due::INTEGER AS score_due
    FROM (VALUES ('xgboost'), ('random_forest')) v(model), last, low
    WHERE TIMESTAMP '2024-02-10 00:00:00' - trained >= INTERVAL 2592000 SECOND OR 1000000 - n >= 1000 OR score_due""",
)
def _(t):
    now = F.lit("2024-02-10 00:00:00").cast("timestamp")
    due = L.retrain_triggers(audit(t), 1_000_000, now, ["xgboost", "random_forest"])
    return due.select("model", *[F.col(c).cast("int").alias(c) for c in ("time_due", "score_due")])


@query(
    "retrain_by_rows",
    "picks",
    f""", {AUDIT}, last AS (SELECT max(trained_at) AS trained, max_by(n_rows, (trained_at, model, n_rows)) AS n FROM audit),
    present AS (SELECT count(*) AS rows_now, max(arrival_iso) AS latest FROM picks)
    SELECT model, (latest - trained >= INTERVAL 2592000 SECOND)::INTEGER AS time_due, (rows_now - n >= 1000)::INTEGER AS rows_due
    FROM (VALUES ('xgboost'), ('random_forest')) v(model), last, present WHERE latest - trained >= INTERVAL 2592000 SECOND OR rows_now - n >= 1000
      OR (SELECT min(r2) < 0.7e0 FROM (SELECT model, max_by(r2, (trained_at, n_rows, r2)) AS r2 FROM audit GROUP BY model))""",
)
def _(t):
    """Rows are those of the table, now is its last time."""
    now = t.picks.agg(F.max("arrival_iso")).first()[0]
    due = L.retrain_triggers(audit(t), t.picks, now, ["xgboost", "random_forest"])
    return due.select("model", *[F.col(c).cast("int").alias(c) for c in ("time_due", "rows_due")])


@query("deploy_gate", "picks", f", {AUDIT} SELECT model, trained_at, r2 FROM audit WHERE r2 >= 0.5", "r2")
def _(t):
    return L.deploy_gate(audit(t).select("model", "trained_at", "r2"), 0.5)


@query(
    "oversample_minority",
    "picks",
    """, k AS (SELECT (delta_seconds >= 9)::INTEGER AS label FROM picks), c AS (SELECT label, count(*) AS n FROM k GROUP BY label)
    SELECT label, (SELECT max(n) FROM c) AS n_rows FROM c""",
)
def _(t):
    rows = t.picks.select(
        "pick_id",
        F.col("arrival_epoch").alias("a"),
        (F.col("delta_seconds") * 1000).alias("b"),
        F.hour("arrival_iso").alias("c"),
        (F.col("delta_seconds") >= 9).cast("int").alias("label"),
    )
    return A.target_share(L.oversample_minority(rows, ["a", "b", "c"], "label", "pick_id"), "label").drop("share")
