"""Streams over several batches equal their batch twins; late rows are kept by the ingest."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tremorlake.operators.detection import coincidence_events
from tremorlake.schemas import table_schema
from tremorlake.sources.versioned import VersionedTable, by_day
from tremorlake.streaming import monitor as M

T0 = datetime(2024, 1, 1)
SCHEMA = "pick_id LONG, network STRING, station_code STRING, channel STRING, ts TIMESTAMP, value DOUBLE"


@pytest.fixture(scope="module")
def picks():
    rng = np.random.default_rng(11)
    seconds = np.sort(rng.integers(0, 6 * 3600, 1200))
    return [
        (i, f"N{rng.integers(2)}", f"S{rng.integers(6)}", "Z", T0 + timedelta(seconds=int(s), microseconds=i), float(rng.random()))
        for i, s in enumerate(seconds)
    ]


def stream_of(spark, folder, rows, batches):
    """A stream that reads the rows in ``batches`` files, one a batch, in order."""
    for i, part in enumerate(np.array_split(np.arange(len(rows)), batches)):
        df = spark.createDataFrame([rows[j] for j in part], SCHEMA).coalesce(1)
        df.write.mode("append").parquet(str(folder))
        import time

        time.sleep(1.1)  # the file source orders by change time
    return M.read_files(spark, str(folder), df.schema, files_per_batch=1)


def run(spark, stream, tmp_path, name="out"):
    path = str(tmp_path / name)
    M.write_available(stream, path, str(tmp_path / f"{name}-checkpoint"))
    return spark.read.schema(stream.schema).parquet(path)


def test_windows_equal_the_batch(spark, picks, tmp_path):
    stream = M.watermarked(stream_of(spark, tmp_path / "in", picks, 4), "ts")
    got = run(spark, M.stream_station_stats(stream, "ts", "value"), tmp_path).collect()
    batch = M.stream_station_stats(spark.createDataFrame(picks, SCHEMA), "ts", "value")
    end = max(p[4] for p in picks) - timedelta(minutes=10)
    want = [r for r in batch.collect() if r["window_end"] <= end]
    rounded = lambda rows: sorted((r["window_start"], r["station_code"], r["npts"], round(r["mean"], 9), round(r["std"], 9)) for r in rows)
    assert rounded(got) == rounded(want)


def test_hourly_counts_are_exact(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = []
    for hour, stations in enumerate((3000, 5003, 1)):
        for k in range(2 * stations):
            rows.append((len(rows), "N", f"S{k % stations}", "Z", T0 + timedelta(hours=hour, seconds=k * 0.2), 1e6 + float(rng.random())))
        rows.append((len(rows), "N", None, "Z", T0 + timedelta(hours=hour, seconds=1), None))
    rows.sort(key=lambda r: r[4])
    last = (len(rows), "N", "S", "Z", T0 + timedelta(hours=5), 1.0)
    got = run(spark, M.stream_hourly_counts(M.watermarked(stream_of(spark, tmp_path / "in", [*rows, last], 2), "ts"), "ts", "value"), tmp_path).collect()
    assert sorted((r["hour"], r["numero_eventi"], r["stazioni_attive"]) for r in got) == [
        (T0, 6001, 3000), (T0 + timedelta(hours=1), 10007, 5003), (T0 + timedelta(hours=2), 3, 1),
    ]
    for r in got:
        values = [x[5] for x in rows if r["hour"] <= x[4] < r["hour"] + timedelta(hours=1) and x[5] is not None]
        assert r["energia_max"] == max(values) and abs(r["energia_media"] - np.mean(values)) < 1e-6 and abs(r["energia_std"] - np.std(values)) < 1e-8


def test_cooldown_over_batches(spark, picks, tmp_path):
    stream = stream_of(spark, tmp_path / "in", picks, 5)
    is_error = F.col("pick_id") % 50 == 0
    got = run(spark, M.stream_alert_cooldown(stream, "network", "ts", "pick_id", 30, is_error), tmp_path).collect()
    sent, last = set(), {}
    for pick, network, _, _, ts, _ in picks:
        if pick % 50 == 0:
            sent.add((pick, True))
        elif network not in last or ts >= last[network] + timedelta(minutes=30):
            sent.add((pick, False))
            last[network] = ts
    assert {(r["alert_id"], r["is_error"]) for r in got} == sent
    plain = spark.createDataFrame([p for p in picks if p[0] % 50], SCHEMA)
    twin = M.alert_cooldown(plain, "network", "ts", "pick_id", 30)
    assert {r["alert_id"] for r in twin.collect()} == {p for p, error in sent if not error}


def test_clusters_over_batches_equal_one_batch(spark, picks, tmp_path):
    def clusters(name, batches):
        stream = M.watermarked(stream_of(spark, tmp_path / f"in-{name}", picks, batches), "ts", "1 minute")
        found = run(spark, M.stream_coincidence(stream, "ts", 60.0, 3), tmp_path, name).collect()
        return {(r["network"], r["anchor"], r["station_code"], r["pick_id"]) for r in found}

    many, once = clusters("many", 4), clusters("once", 1)
    assert many == once and len(many) > 100


def disordered(spark, picks, tmp_path, batches, minutes=20):
    """The picks in files whose order is off by up to some minutes, on a stream with a watermark that waits for them."""
    rng = np.random.default_rng(21)
    order = sorted(picks, key=lambda p: p[4] + timedelta(minutes=float(rng.uniform(0, minutes))))
    return M.watermarked(stream_of(spark, tmp_path / "in", order, batches), "ts", "30 minutes"), max(p[4] for p in picks) - timedelta(minutes=30)


def test_cooldown_goes_by_alert_time(spark, picks, tmp_path):
    stream, mark = disordered(spark, picks, tmp_path, 4)
    got = run(spark, M.stream_alert_cooldown(stream, "network", "ts", "pick_id", 30, F.col("pick_id") % 50 == 0), tmp_path).collect()
    plain = spark.createDataFrame([p for p in picks if p[0] % 50], SCHEMA)
    twin = {r["alert_id"] for r in M.alert_cooldown(plain, "network", "ts", "pick_id", 30).collect() if r["timestamp"] < mark}
    assert {r["alert_id"] for r in got if not r["is_error"]} == twin and len(twin) > 15
    assert {r["alert_id"] for r in got if r["is_error"]} == {p[0] for p in picks if p[0] % 50 == 0 and p[4] < mark}
    assert len(got) == len({r["alert_id"] for r in got})


def test_a_late_earlier_alert_goes_out_and_holds_the_later_one(spark, tmp_path):
    at = lambda i, minutes: (i, "N", "S", "Z", T0 + timedelta(minutes=minutes), 1.0)
    stream = M.watermarked(stream_of(spark, tmp_path / "in", [at(1, 0), at(3, 90), at(2, 70), at(9, 300)], 4), "ts", "30 minutes")
    got = run(spark, M.stream_alert_cooldown(stream, "network", "ts", "pick_id", 60), tmp_path).collect()
    assert sorted(r["alert_id"] for r in got) == [1, 2]


def test_clusters_out_of_order_equal_the_batch(spark, picks, tmp_path):
    stream, mark = disordered(spark, picks, tmp_path, 4)
    got = run(spark, M.stream_coincidence(stream, "ts", 60.0, 3), tmp_path).collect()
    batch = spark.createDataFrame(picks, SCHEMA).withColumn("arrival_epoch", F.unix_micros("ts") / 1e6)
    members = coincidence_events(batch, 60.0, 3, by=["network"]).groupBy("network", "event_id").agg(F.min("ts").alias("anchor"), F.collect_set("pick_id").alias("ids"))
    want = {(r["network"], i) for r in members.collect() if r["anchor"] + timedelta(seconds=60) < mark for i in r["ids"]}
    assert {(r["network"], r["pick_id"]) for r in got} == want and len(got) == len(want) > 100


def test_clusters_in_small_pieces_equal_the_batch(spark, picks, tmp_path):
    """Also where several triggers of a station have the same time, and some have no station."""
    from tremorlake.streaming.ordered import clusters_in_order

    rows = [(*p[:2], None if i % 50 == 3 else p[2], *p[3:]) for i, p in enumerate(picks)]
    rows += [(5000 + p[0], *p[1:]) for p in rows[::7]]
    stream, mark = disordered(spark, rows, tmp_path, 3)
    timed = stream.select("network", "station_code", "pick_id", F.unix_micros("ts").alias("us"), "ts")
    got = run(spark, clusters_in_order(timed, "ts", 60_000_000, 3, slot=45_000_000, piece=3), tmp_path).collect()
    until, kept = {}, {}
    for i, network, station, _, at, _ in sorted(rows, key=lambda r: (r[4], r[0])):
        if network not in until or at > until[network]:
            until[network] = at + timedelta(seconds=60)
        kept.setdefault((network, until[network]), {}).setdefault(station, i)
    want = {(network, station, i) for (network, end), members in kept.items() if len(members) >= 3 and end < mark for station, i in members.items()}
    assert {(r["network"], r["station_code"], r["pick_id"]) for r in got} == want and len(got) == len(want) > 100


def test_a_network_has_one_piece_in_memory(monkeypatch):
    import pyarrow as pa

    from tremorlake.streaming import ordered

    class Handle(dict):
        """The state of a processor: its list of open rows, its map of pieces, its timers."""

        def __init__(self):
            self.rows = []

        getListState = getMapState = lambda self, *_: self
        exists, get, put, clear = lambda self: bool(self.rows), lambda self: self.rows, lambda self, rows: setattr(self, "rows", rows), lambda self: self.rows.clear()
        getValue, updateValue, removeKey, registerTimer = dict.__getitem__, dict.__setitem__, dict.__delitem__, lambda self, ms: None

    rng = np.random.default_rng(3)
    us = np.sort(rng.integers(0, 10**10, 50_000))
    table = pa.table({"network": ["N"] * len(us), "slot": [0] * len(us), "us": us, "station_code": [f"S{i}" for i in rng.integers(0, 9, len(us))], "pick_id": range(len(us))})
    pieces = ordered._pieces(100)(table.take(rng.permutation(len(us)))).to_pandas()
    seen, closed = [], ordered.Clusters._closed
    monkeypatch.setattr(ordered.Clusters, "_closed", lambda self, network, rows, mark: seen.append(len(rows)) or closed(self, network, rows, mark))
    clusters, mark = ordered.Clusters(10**8, 3), type("Mark", (), {"getCurrentWatermarkInMs": lambda self: 10**8})()
    clusters.init(Handle())
    found = sum(map(len, clusters.handleInputRows(("N",), iter([pieces.sample(frac=1, random_state=1)]), mark)))
    assert max(seen) <= 109 and len(clusters.waiting) == 0 and 800 < found <= 900


def test_ingest_keeps_late_rows_and_adds_nothing_twice(spark, picks, tmp_path):
    late = (99_999, "N0", "S0", "Z", T0 - timedelta(days=2), 0.5)
    stream = stream_of(spark, tmp_path / "in", [*picks[:50], late], 2)
    schema = table_schema("pick_id:long network:str station_code:str ts:ts value:dbl")
    for attempt in range(2):
        M.start_ingest(M.watermarked(stream, "ts"), str(tmp_path / "t"), schema, ["pick_id"], str(tmp_path / f"c{attempt}")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "t")).count() == 51


def test_versioned_ingest_touches_its_days(spark, picks, tmp_path):
    late = (99_999, "N0", "S0", "Z", T0 - timedelta(days=2), 0.5)
    stream = stream_of(spark, tmp_path / "in", [*picks[:20], late, *picks[20:40]], 2)
    schema, key, path = table_schema("pick_id:long ts:ts value:dbl"), ["pick_id", "ts"], str(tmp_path / "t")
    for attempt in range(2):
        M.start_ingest(stream, path, schema, key, str(tmp_path / f"c{attempt}"), by=by_day("ts")).awaitTermination()
    table = VersionedTable(spark, path, schema, key, by_day("ts"))
    assert table.read().count() == table.rows() == 41 and table.versions() == [1, 2]
    assert len(table.manifest(2)[1]["2024-01-01"]) == 2 and len(table.manifest(2)[1]["2023-12-30"]) == 1


def test_ingest_goes_on_past_a_failed_batch(spark, picks, tmp_path, monkeypatch):
    from tremorlake.sources import sinks

    whole = sinks.insert_ignore

    def flaky(batch, *args, **options):
        if batch.filter("pick_id = 0").count():
            raise RuntimeError("disk is full")
        return whole(batch, *args, **options)

    monkeypatch.setattr(sinks, "insert_ignore", flaky)
    stream = stream_of(spark, tmp_path / "in", picks[:40], 2)
    schema = table_schema("pick_id:long value:dbl")
    M.start_ingest(stream, str(tmp_path / "t"), schema, ["pick_id"], str(tmp_path / "c"), str(tmp_path / "bad")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "t")).count() == 20
    bad = spark.read.json(str(tmp_path / "bad"))
    assert bad.count() == 20 and bad.first()["error"] == "disk is full"


def test_risk_and_thresholds(spark):
    rows = [(T0, T0, f"S{i}", "Z", 0.0, 50.0, -100.0, 120.0, 10) for i in range(3)]
    stats = spark.createDataFrame(
        rows,
        "window_start TIMESTAMP, window_end TIMESTAMP, station_code STRING, channel STRING, mean DOUBLE, std DOUBLE, min DOUBLE, max DOUBLE, npts LONG",
    )
    risk = M.risk_of_windows(stats, 100.0).first()
    assert abs(risk["risk_score"] - (0.6 * 0.5 + 0.4 * 2.2)) < 1e-12 and risk["stations_count"] == 3
    cases = spark.createDataFrame([(0.1, 20), (0.1, 5), (0.9, 20), (0.9, 2), (0.7, 20)], "risk_score DOUBLE, stations_count INT")
    got = [r["message"] for r in M.stream_threshold_alerts(cases).collect()]
    assert got == [
        "Stazioni insufficienti: 5/18",
        "Soglia rischio superata: 0.9000/0.7",
        "Stazioni insufficienti: 2/18; Soglia rischio superata: 0.9000/0.7",
    ]


def test_threshold_alerts_are_inclusive(spark):
    df = spark.createDataFrame([(T0, 0.8, 18), (T0, 0.79, 18)], "timestamp TIMESTAMP, risk DOUBLE, stations INT")
    got = M.threshold_alerts(df, "risk").collect()
    assert len(got) == 1 and got[0]["message"] == "Alert: HIGH - Risk: 0.80 - Stations: 18"
    assert got[0]["additional_info"] == {"trigger_timestamp": "2024-01-01T00:00:00.000000"}


def test_buffer_is_an_aggregation_that_sees_no_python(spark, tmp_path):
    rows = [("a", i, datetime(2024, 1, 1) + timedelta(seconds=i), float(i)) for i in range(5)]
    spark.createDataFrame(rows, "network STRING, pick_id LONG, ts TIMESTAMP, v DOUBLE").write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = M.watermarked(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "ts")
    plan = M.stream_alert_cooldown(stream, "network", "ts", "pick_id", 30)._jdf.queryExecution().analyzed().toString()
    assert plan.count("TransformWithStateInPySpark") + plan.count("TransformWithStateInPandas") == 1 and "collect_list" in plan
