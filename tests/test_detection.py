"""Detection, clusters, spectra and station inversion against plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tremorlake.operators import detection as D

SAMPLES = "station_code STRING, n LONG, x DOUBLE"


def frame(spark, traces):
    import pandas as pd

    parts = [pd.DataFrame({"station_code": k, "n": np.arange(len(v)), "x": np.asarray(v, dtype=float)}) for k, v in traces.items()]
    return spark.createDataFrame(pd.concat(parts), SAMPLES).repartition(4)


def classic_ratio(x, nsta, nlta):
    e = np.r_[0.0, np.cumsum(np.square(x))]
    out = np.zeros(len(x))
    for i in range(nlta - 1, len(x)):
        out[i] = ((e[i + 1] - e[i + 1 - nsta]) / nsta) / ((e[i + 1] - e[i + 1 - nlta]) / nlta)
    return out


def onsets(ratio, on, off):
    found, active = [], False
    for i, r in enumerate(ratio):
        if not active and r > on:
            found.append(i)
            active = True
        elif active and not r > off:
            active = False
    return found


@pytest.mark.parametrize("block_rows", [25, 64, 1000])
def test_ratio_of_long_traces_in_blocks(spark, block_rows):
    rng = np.random.default_rng(1)
    traces = {k: rng.normal(0, 1, n) * (1 + 9 * (np.arange(n) % 97 > 85)) for k, n in (("A", 400), ("B", 61), ("C", 20))}
    got = D.sta_lta_ratio(frame(spark, traces), ["station_code"], 5, 20, "n", block_rows=block_rows)
    rows = {}
    for r in got.collect():
        rows.setdefault(r["station_code"], {})[r["n"]] = r["ratio"]
    assert set(rows) == {"A", "B"}  # C is not longer than the long window
    for k in rows:
        np.testing.assert_allclose([rows[k][i] for i in range(len(traces[k]))], classic_ratio(traces[k], 5, 20), rtol=1e-9)


def test_silence_has_no_ratio(spark):
    loud_then_silent = np.r_[np.ones(30) * 1e8 / 3, np.zeros(60)]
    got = D.sta_lta_ratio(frame(spark, {"A": loud_then_silent}), ["station_code"], 5, 20, "n").orderBy("n").collect()
    assert got[45]["ratio"] == 0.0  # the short window is silent
    assert all(r["ratio"] is None for r in got[50:])  # so is the long one


def test_triggers_of_a_burst_equal_the_sample_loop(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(0, 10, 9000)
    x[4500:4600] += 5000 * np.sin(np.arange(100))
    got = D.detect_triggers(frame(spark, {"A": x}), ["station_code"], 1.0, 5, 60, window_seconds=3600.0).collect()
    want = set()
    step, length = 3600 - 180, 3600
    for begin in range(0, len(x) - 1, step):
        part = x[begin : begin + length + 1]
        side = int(0.05 * len(part))
        side -= 2 * side == len(part)
        depth = np.minimum(np.arange(len(part)), np.arange(len(part))[::-1])
        weight = np.where(depth < side, 0.5 * (1 - np.cos(np.pi * depth / (side - 1))), 1.0)
        for i in onsets(classic_ratio((part - part.mean()) * weight, 5, 60), 3.0, 1.5):
            if begin + length >= len(x) - 1 or i < step:
                want.add((begin // step, float(begin + i)))
    assert {(r["win"], r["seconds"]) for r in got} == want
    assert any(abs(r["seconds"] - 4500) < 5 for r in got)


def test_windows_shorter_than_their_overlap_are_an_error(spark):
    with pytest.raises(ValueError):
        D.chunk_windows(frame(spark, {"A": [1, 2, 3]}), ["station_code"], 1.0, 60.0, 100.0)


def clusters(rows, window, least):
    out, cluster = [], []

    def close():
        if len({r[1] for r in cluster}) >= least:
            out.append([r[2] for r in cluster])

    for row in sorted(rows, key=lambda r: (r[0], r[2])):
        if cluster and row[0] - cluster[0][0] > window:
            close()
            cluster = []
        if not cluster or row[1] not in {r[1] for r in cluster}:
            cluster.append(row)
    close()
    return out


@pytest.mark.parametrize("seed,n", [(1, 200), (2, 1500)])
def test_clusters_equal_the_sequential_rule(spark, seed, n):
    rng = np.random.default_rng(seed)
    seconds = np.sort(rng.choice(20_000, n, replace=False)) / 4.0
    rows = [(float(t), f"S{rng.integers(8)}", i) for i, t in enumerate(seconds)]
    df = spark.createDataFrame([(t, s, "N", f"C{i:06d}", i) for t, s, i in rows], "arrival_epoch DOUBLE, station_code STRING, network STRING, channel STRING, id INT")
    got = {}
    for r in D.coincidence_events(df, 10.0, 3).collect():
        got.setdefault(r["event_id"], []).append((r["arrival_epoch"], r["id"]))
    want = clusters(rows, 10.0, 3)
    assert [[i for _, i in sorted(got[k])] for k in sorted(got)] == want
    assert sorted(got) == [f"AUTO_EV_{i + 1:04d}" for i in range(len(want))]


def test_spectral_peak(spark):
    rate, n = 20.0, 3600
    t = np.arange(n) / rate
    rng = np.random.default_rng(0)
    traces = {"A": np.sin(2 * np.pi * 2.5 * t) + 0.1 * rng.normal(size=n), "B": np.cos(2 * np.pi * 0.4 * t[:500]) + 3}
    got = {r["station_code"]: r["frequency_peak_hz"] for r in D.spectral_peak(frame(spark, traces), ["station_code"], rate).collect()}
    assert abs(got["A"] - 2.5) < 0.02 and abs(got["B"] - 0.4) < 0.05
    # the averaged spectrum itself, segment by segment
    size = 1200
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)
    spectra = []
    for begin in range(0, n - size + 1, size // 2):
        part = traces["A"][begin : begin + size]
        p = np.abs(np.fft.rfft((part - part.mean()) * window)) ** 2 / (rate * (window**2).sum())
        p[1:-1] *= 2
        spectra.append(p)
    top = D.spectral_peak(frame(spark, {"A": traces["A"]}), ["station_code"], rate).first()["power_peak"]
    assert abs(top - np.mean(spectra, axis=0).max()) < 1e-9 * top


def test_trace_report(spark):
    n = np.arange(600)
    x = np.sin(2 * np.pi * 0.1 * n)
    x[430] = -9.0
    starts = spark.createDataFrame([("A", 1_700_000_000)], "station_code STRING, s LONG").select("station_code", F.timestamp_seconds("s").alias("start"))
    got = {r["station_code"]: r for r in D.trace_report(frame(spark, {"A": x, "B": x}), starts, ["station_code"], 1.0, 4, 20).collect()}
    a, b = got["A"], got["B"]
    assert (a["trace_id"], a["start_time_iso"], a["end_time_iso"]) == ("A", "2023-11-14T22:13:20.000000Z", "2023-11-14T22:23:19.000000Z")
    assert a["amplitude_peak_time_epoch"] == 1_700_000_430 and abs(a["frequency_peak_hz"] - 0.1) < 0.02 and a["npts"] == 600
    assert b["start_time_iso"] is None and b["amplitude_peak"] == -9.0


def test_station_positions_from_travel_times(spark):
    rng = np.random.default_rng(3)
    truth = {"ST1": (500.0, -800.0, 3500.0), "ST2": (-2500.0, 1200.0, 5000.0)}
    rows = []
    for code, (x, y, v) in truth.items():
        for _ in range(40):
            e = rng.uniform(-6000, 6000, 2)
            z = -rng.uniform(500, 4000)
            rows.append((code, float(e[0]), float(e[1]), float(z), float(np.sqrt((e[0] - x) ** 2 + (e[1] - y) ** 2 + z**2) / v)))
    df = spark.createDataFrame(rows, "station_code STRING, x_m DOUBLE, y_m DOUBLE, z_m DOUBLE, travel_time DOUBLE")
    for hot_rows in (10**9, 10):  # groups in Python, and sums of the normal equations in Spark
        for r in D.invert_station_location(df, hot_rows=hot_rows).collect():
            np.testing.assert_allclose([r["x_m"], r["y_m"], r["velocity_m_s"]], truth[r["station_code"]], rtol=1e-4, atol=0.5)
            assert r["rms_seconds"] < 1e-5 and r["n_events"] == 40 and r["success"]
            assert r["velocity_km_s"] == r["velocity_m_s"] / 1000 and r["elevation_assumed_m"] == 0.0


def test_station_positions_carry_place_and_events(spark):
    x, y = 431000.0, 4521000.0
    rows = [("A", k % 30, x + 900 * math.cos(k), y + 700 * math.sin(2 * k), -1000.0 - 30 * k, 0.0) for k in range(60)]
    rows = [(*r[:5], math.sqrt((r[2] - x - 50) ** 2 + (r[3] - y) ** 2 + r[4] ** 2) / 3000) for r in rows]
    df = spark.createDataFrame(rows, "station_code STRING, event INT, x_m DOUBLE, y_m DOUBLE, z_m DOUBLE, travel_time DOUBLE")
    got = {hot: D.invert_station_location(df, hot_rows=hot, events="event").first() for hot in (10**9, 10)}
    for r in got.values():
        assert r["event_ids_used"] == ",".join(map(str, range(30))) and abs(r["x_m"] - x - 50) < 0.5
        assert abs(r["latitude"] - 40.84) < 0.1 and abs(r["longitude"] - 14.18) < 0.1
    assert D.invert_station_location(df.limit(0), events="event").collect() == []


def test_jobs_do_not_grow_with_the_stations(spark):
    rows = [(f"S{s}", 100.0 * (k % 7), 100.0 * (k // 7), -500.0, 0.2 + 0.001 * ((k * 7 + s) % 5)) for s in range(12) for k in range(30)]
    df = spark.createDataFrame(rows, "station_code STRING, x_m DOUBLE, y_m DOUBLE, z_m DOUBLE, travel_time DOUBLE")
    context, jobs = spark.sparkContext, {}
    for n in (2, 12):
        context.setJobGroup(f"stations {n}", "")
        many = D.invert_station_location(df.filter(F.col("station_code").isin([f"S{s}" for s in range(n)])), hot_rows=10)
        jobs[n] = len(context.statusTracker().getJobIdsForGroup(f"stations {n}"))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[12] < 2.5 * jobs[2]
    plain = {r["station_code"]: r for r in D.invert_station_location(df).collect()}
    for r in many.collect():
        assert abs(r["rms_seconds"] - plain[r["station_code"]]["rms_seconds"]) < 1e-7


def test_lengths():
    assert D.sta_lta_lengths(100.0, 0.5, 10.0) == (50, 1000)
    assert D.sta_lta_lengths(1.0, 0.2, 0.5) == (1, 2)
