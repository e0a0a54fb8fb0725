"""Hourly features on small hand-made runs with known answers."""

import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tremorlake.operators import hourly as H, windows as R
from tremorlake.plans.features import hourly_features_view, union_history
from tremorlake.schemas import FEATURES

PICKS = "run_id STRING, station_code STRING, arrival_iso TIMESTAMP, delta_seconds DOUBLE"
QUAKES = "event_id STRING, time TIMESTAMP, magnitude DOUBLE"
ENERGY = "station_code STRING, channel STRING, hour TIMESTAMP, rms DOUBLE, peak DOUBLE"
DAY = datetime(2025, 11, 1)


def view(spark, picks, quakes=(), energy=(), **options):
    frames = [spark.createDataFrame(list(rows), schema) for rows, schema in ((picks, PICKS), (quakes, QUAKES), (energy, ENERGY))]
    return hourly_features_view(*frames, **options).toPandas().set_index("timestamp").sort_index()


def hours(days, stations=2, value=9.0, start=DAY):
    return [("r", f"S{s}", start + timedelta(hours=h), value) for h in range(days * 24) for s in range(stations)]


def test_label_marks_the_six_hours_before_a_strong_event(spark):
    quakes = [("EV1", DAY + timedelta(hours=5, minutes=30), 4.0), ("EV2", DAY + timedelta(days=1, hours=10), 2.0)]
    made = view(spark, hours(3), quakes)
    assert list(made.index[made["Target_Allarme"] == 1]) == [DAY + timedelta(hours=h) for h in range(6)]
    # the current hour counts as past by default, and does not on request
    assert made.loc[DAY + timedelta(hours=5), "magnitudo_max_6h"] == 4.0
    strict = view(spark, hours(3), quakes, strict_past=True)
    assert strict.loc[DAY + timedelta(hours=5), "magnitudo_max_6h"] == 0.0
    assert strict.loc[DAY + timedelta(hours=6), "magnitudo_max_6h"] == 4.0


def test_event_on_the_hour_marks_the_six_hours_before_it(spark):
    made = view(spark, hours(2), [("EV", DAY + timedelta(hours=12), 5.0)])
    assert list(made.index[made["Target_Allarme"] == 1]) == [DAY + timedelta(hours=h) for h in range(6, 12)]


def test_without_catalogue_all_labels_are_zero_and_the_last_hours_are_left_out(spark):
    made = view(spark, hours(3))
    assert made["Target_Allarme"].sum() == 0
    assert list(made.columns) == [f.name for f in FEATURES if f.name != "timestamp"]
    assert made.index.max() == DAY + timedelta(hours=71 - 7)  # t < last arrival - 6 h


def test_gaps_and_completeness(spark):
    noon = DAY + timedelta(hours=12)
    rows = [("r", s, noon, 1.0) for s in "ABC"] + [("r", "A", noon + timedelta(days=1), 2.0)]
    rows += [("r", "A", noon + timedelta(days=3), 3.0)]
    made = view(spark, rows)
    assert made.loc[noon, "is_data_complete"] == 1
    assert made.loc[noon + timedelta(days=1), "is_data_complete"] == 0
    empty = made.loc[str((DAY + timedelta(days=2)).date())]
    assert len(empty) == 24 and empty["numero_eventi"].sum() == 0 and empty["is_data_complete"].sum() == 0
    assert made.loc[noon + timedelta(days=1), "eventi_ultime_24h"] == 1
    assert made.loc[noon + timedelta(days=1), "eventi_ultime_48h"] == 4


def test_causal_energy_ratio(spark):
    energy = [(f"S{s}", "HHZ", DAY + timedelta(hours=h), 10.0 + h, 100.0 + h) for h in range(24) for s in range(2)]
    ratios = H.causal_log_ratio(H.energy_station_hour(spark.createDataFrame(energy, ENERGY)))
    net = H.energy_robust_network(ratios).toPandas().sort_values("hour").reset_index(drop=True)
    assert net["hour"][0] == DAY + timedelta(hours=1)
    assert math.isclose(net["net_rms_log_ratio_med"][0], math.log10(11 / 10))
    assert math.isclose(net["net_rms_log_ratio_med"].iloc[-1], math.log10(33 / 21))
    assert set(net["n_stations_energy"]) == {2}


def test_energy_ignores_rows_without_power(spark):
    rows = [("S", "Z", DAY, 0.0, 5.0), ("S", "Z", DAY + timedelta(hours=1), 2.0, 0.0), ("S", "Z", DAY + timedelta(hours=2), 2.0, 3.0)]
    assert H.energy_station_hour(spark.createDataFrame(rows, ENERGY)).count() == 1


def test_features_do_not_look_ahead(spark):
    rng = np.random.default_rng(2)
    rows = [("r", f"S{rng.integers(4)}", DAY + timedelta(minutes=int(m)), float(v)) for m, v in zip(np.sort(rng.integers(0, 6000, 400)), rng.random(400))]
    energy = [(s, "Z", (t.replace(minute=0)), v + 1, v + 2) for _, s, t, v in rows]
    whole = view(spark, rows, energy=energy)
    cut = DAY + timedelta(hours=60)
    part = view(spark, [r for r in rows if r[2] < cut], energy=[e for e in energy if e[2] < cut])
    same = [c for c in whole.columns if c not in ("is_data_complete", "Target_Allarme")]
    pd.testing.assert_frame_equal(whole.loc[part.index, same], part[same])


def test_history_keeps_equal_timestamps_and_gets_calendar_columns(spark):
    history = spark.createDataFrame([(DAY, 3, 1)], "timestamp TIMESTAMP, numero_eventi LONG, Target_Allarme INT")
    made = union_history(spark.createDataFrame([(DAY, 5)], "timestamp TIMESTAMP, numero_eventi LONG"), history).toPandas()
    assert sorted(made["numero_eventi"]) == [3, 5]
    old = made[made["numero_eventi"] == 3].iloc[0]
    assert (old["giorno_della_settimana"], old["is_weekend"], old["energia_max"]) == (6, 1, 0.0)


def series(spark, counts, extra=None):
    rows = [(DAY + timedelta(hours=i), int(c), float(c) / 2, float(c) / 3, float(c) / 4) for i, c in enumerate(counts)]
    return spark.createDataFrame(rows, "timestamp TIMESTAMP, numero_eventi LONG, energia_max DOUBLE, energia_media DOUBLE, energia_std DOUBLE")


def test_rolling_statistics_equal_a_data_frame_library(spark):
    counts = list(np.random.default_rng(4).integers(0, 9, 80)) + [3] * 30 + [0] * 30
    df, x = series(spark, counts), pd.Series(counts, dtype=float)
    got = R.rolling_skew_kurt(R.rolling_entropy(R.rolling_variance(R.rolling_trend_slope(df)))).toPandas().sort_values("timestamp")
    roll = x.rolling(24)
    want = {
        "varianza_eventi_24h": roll.var(),
        "trend_eventi_12h": x.rolling(12).apply(lambda v: np.polyfit(np.arange(12), v, 1)[0]),
        "skewness_eventi_24h": x.rolling(24, min_periods=1).apply(lambda v: pd.Series(v).skew()),
        "kurtosis_eventi_24h": x.rolling(24, min_periods=1).apply(lambda v: pd.Series(v).kurtosis()),
        "entropy_24h": roll.apply(lambda v: -np.sum(v / v.sum() * np.log2(v / v.sum() + 1e-10)) if v.sum() > 0 else 0.0),
    }
    for name, values in want.items():
        np.testing.assert_allclose(got[name].astype(float), values, atol=1e-9, err_msg=name)


def test_time_range_windows_equal_a_data_frame_library(spark):
    rng = np.random.default_rng(9)
    times = pd.to_datetime(DAY) + pd.to_timedelta(np.sort(rng.choice(np.arange(0, 5 * 24 * 60, 5), 300, replace=False)), unit="m")
    values = pd.Series(rng.random(300) * 1e3 + 1e6, index=times)
    rows = list(zip([t.to_pydatetime() for t in times], values))
    got = R.rolling_time_range(spark.createDataFrame(rows, "t TIMESTAMP, v DOUBLE"), "t", "v", [6, 12]).toPandas().set_index("timestamp").sort_index()
    for w in (6, 12):
        rolled = values.rolling(f"{w}h")
        for name, want in (("max", rolled.max()), ("media", rolled.mean()), ("std", rolled.std())):
            expected = want.resample("h").last().fillna(0)
            np.testing.assert_allclose(got[f"energia_{name}_ultime_{w}h"], expected, rtol=1e-7, err_msg=f"{name}{w}")


def test_split_moves_the_cut_to_keep_both_classes(spark):
    def split(labels):
        df = spark.createDataFrame(list(enumerate(labels)), "t INT, label INT")
        rows = R.temporal_split(df, ["t"], "label").orderBy("t").collect()
        return [r["split"] for r in rows].count("train")

    assert split([0, 1] * 50) == 80
    assert split([0] * 90 + [1] * 10) == 95
    assert split([0] * 99 + [1]) == 80  # a lone positive cannot be split
    with pytest.raises(ValueError):
        split([])


def test_reference_modes(spark):
    rows = [(1, "a", 10.0, 1), (1, "b", 12.0, 2), (1, "c", 20.0, 3), (2, "a", 5.0, 4)]
    picks = spark.createDataFrame(rows, "event_id INT, station_code STRING, arrival_epoch DOUBLE, pick_id INT")
    for mode, want in (("median", 12.0), ("mean", 14.0), ("first", 10.0)):
        got = {r["pick_id"]: r["delta_seconds"] for r in R.group_reference_delta(picks, mode=mode).collect()}
        assert got == {1: 10 - want, 2: 12 - want, 3: 20 - want, 4: 0.0}
    with pytest.raises(ValueError):
        R.group_reference_delta(picks, mode="last")


def test_sequences_end_on_their_own_row(spark):
    df = series(spark, range(6))
    got = R.lookback_sequences(df, ["numero_eventi"], "numero_eventi", 4).orderBy("timestamp").collect()
    assert [[int(x[0]) for x in r["sequence"]] for r in got] == [[0, 1, 2, 3], [1, 2, 3, 4], [2, 3, 4, 5]]


def test_feature_plan_has_no_nested_loop(spark):
    frames = [spark.createDataFrame([], s) for s in (PICKS, QUAKES, ENERGY)]
    grid = H.hour_grid(spark.createDataFrame(hours(1), PICKS), "arrival_iso")
    plan = R.label_future_exists(grid, frames[1], 6)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
