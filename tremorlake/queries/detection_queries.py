"""Queries for signal and detection operators on sample rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tremorlake.functions.geo import project_utm
from tremorlake.operators import detection as D
from tremorlake.operators.joins import join_station_dim, join_travel_times
from tremorlake.queries import query
from tremorlake.queries.join_queries import origins

# One sample a second; windows of 200 s that overlap by 60 s, so they start every 140 s.
CHUNKS = """sized AS (SELECT station_code, n, x, count(*) OVER (PARTITION BY station_code) AS npts FROM samples),
  wins AS (SELECT DISTINCT station_code, npts, unnest(generate_series(0, npts // 140)) AS win FROM sized),
  chunks AS (SELECT s.station_code, s.n, s.x, s.npts, w.win, s.n - w.win * 140 AS pos,
      (w.win * 140 + 200 >= s.npts - 1 OR s.n < w.win * 140 + 140) AS kept
    FROM sized s JOIN wins w ON s.station_code = w.station_code AND w.win * 140 < s.npts - 1
      AND s.n BETWEEN w.win * 140 AND w.win * 140 + 200)"""
TAPERED = (
    CHUNKS
    + """, sides AS (SELECT *, x - avg(x) OVER v AS centred, count(*) OVER v AS m,
    CASE WHEN floor(count(*) OVER v * 0.05e0) * 2 = count(*) OVER v THEN floor(count(*) OVER v * 0.05e0) - 1
      ELSE floor(count(*) OVER v * 0.05e0) END AS side FROM chunks WINDOW v AS (PARTITION BY station_code, win)),
  tapered AS (SELECT station_code, n, win, pos, npts, kept, m, centred * CASE WHEN least(pos, m - 1 - pos) < side
    THEN 0.5e0 * (1 - cos(pi() * least(pos, m - 1 - pos) / greatest(side - 1, 1))) ELSE 1 END AS x FROM sides)"""
)


def ratio_sql(source: str, nsta: int, nlta: int) -> str:
    return f"""ratios AS (SELECT *, CASE WHEN pos < {nlta - 1} THEN 0e0 ELSE avg(x * x) OVER s / nullif(avg(x * x) OVER l, 0) END AS ratio
    FROM {source} WHERE m > {nlta} WINDOW s AS (PARTITION BY station_code, win ORDER BY pos ROWS {nsta - 1} PRECEDING),
      l AS (PARTITION BY station_code, win ORDER BY pos ROWS {nlta - 1} PRECEDING))"""


ONSETS = """states AS (SELECT *, coalesce(last_value(CASE WHEN ratio > 2 THEN 1 WHEN ratio <= 0.9e0 THEN 0 END IGNORE NULLS)
    OVER (PARTITION BY station_code, win ORDER BY pos ROWS UNBOUNDED PRECEDING), 0) AS state FROM ratios),
  edges AS (SELECT *, coalesce(lag(state) OVER (PARTITION BY station_code, win ORDER BY pos), 0) AS before FROM states)"""


def chunks(t):
    return D.chunk_windows(t.samples, ["station_code"], 1.0, 20.0, 200.0)


def tapered(t):
    return D.demean_taper(chunks(t), ["station_code", "win"])


@query(
    "chunk_windows",
    "samples",
    f", {CHUNKS} SELECT station_code, n, x, win, pos, kept::INTEGER AS kept FROM chunks",
    "x",
)
def _(t):
    return chunks(t).drop("npts").withColumn("kept", F.col("kept").cast("int"))


@query(
    "energy_rms_peak",
    "samples",
    f", {CHUNKS} SELECT station_code, win, sqrt(avg(x * x)) AS rms, max(abs(x)) AS peak FROM chunks GROUP BY station_code, win",
    "rms peak",
)
def _(t):
    return D.energy_rms_peak(chunks(t), ["station_code", "win"])


@query(
    "window_energy",
    "samples",
    f", {TAPERED} SELECT station_code, win, win * 140e0 AS window_seconds, sqrt(avg(x * x)) AS rms, max(abs(x)) AS peak FROM tapered GROUP BY station_code, win",
    "window_seconds rms peak",
)
def _(t):
    return D.window_energy(t.samples, ["station_code"], 1.0, 20.0, 200.0)


@query("demean_taper", "samples", f", {TAPERED} SELECT station_code, win, pos, x FROM tapered", "x")
def _(t):
    return tapered(t).select("station_code", "win", "pos", "x")


@query(
    "sta_lta_ratio",
    "samples",
    f", {TAPERED}, {ratio_sql('tapered', 4, 20)} SELECT station_code, win, pos, ratio FROM ratios",
    "ratio:8",
)
def _(t):
    return D.sta_lta_ratio(tapered(t), ["station_code", "win"], 4, 20, block_rows=None).select("station_code", "win", "pos", "ratio")


@query(
    "trigger_onsets",
    "samples",
    f", {TAPERED}, {ratio_sql('tapered', 4, 20)}, {ONSETS} SELECT station_code, win, n / 1e0 AS seconds FROM edges WHERE kept AND state = 1 AND before = 0",
    "seconds",
)
def _(t):
    return D.detect_triggers(t.samples, ["station_code"], 1.0, 4.0, 20.0, on=2.0, off=0.9, window_seconds=200.0)


def chain_sql(source: str, window: str) -> str:
    """Anchors by recursion over (t, next t) of the distinct times ``us`` of ``source``."""
    return f"""hops AS (SELECT us, min(us) OVER (ORDER BY us RANGE BETWEEN {window} FOLLOWING AND UNBOUNDED FOLLOWING) AS next_us
      FROM (SELECT DISTINCT us FROM {source})),
    chain(us, next_us) AS (SELECT us, next_us FROM hops WHERE us = (SELECT min(us) FROM hops)
      UNION ALL SELECT h.us, h.next_us FROM chain c JOIN hops h ON h.us = c.next_us)"""


@query(
    "coincidence_events",
    "picks",
    f""", timed AS (SELECT *, epoch_us(arrival_iso) AS us FROM picks), {chain_sql('timed', '600000001')},
    placed AS (SELECT t.*, c.us AS anchor, row_number() OVER (PARTITION BY c.us, station_code ORDER BY t.us, network, channel) AS k
      FROM timed t ASOF JOIN chain c ON t.us >= c.us),
    members AS (SELECT *, count(*) OVER (PARTITION BY anchor) AS n_stations FROM placed WHERE k = 1)
    SELECT pick_id, station_code, n_stations, printf('AUTO_EV_%04d', dense_rank() OVER (ORDER BY anchor)) AS event_id FROM members
    WHERE n_stations >= 3""",
)
def _(t):
    return D.coincidence_events(t.picks, 600.0, 3).select("pick_id", "station_code", "n_stations", "event_id")


@query(
    "trace_summary",
    "samples",
    """, sized AS (SELECT *, count(*) OVER (PARTITION BY station_code) AS m, 0 AS win, n AS pos FROM samples), """
    + ratio_sql("sized", 4, 20)
    + """, a AS (SELECT station_code, count(*) AS npts, count(*) / 1e0 AS duration_s, arg_max(x, (abs(x), -n)) AS amplitude_peak,
      arg_max(n, (abs(x), -n)) / 1e0 AS amplitude_peak_time, sqrt(avg(x * x)) AS amplitude_rms, stddev_pop(x) AS amplitude_std,
      quantile_cont(abs(x), 0.95) AS percentile_95 FROM samples GROUP BY 1),
    b AS (SELECT station_code, max(ratio) AS sta_lta_peak, arg_max(n, (ratio, -n)) / 1e0 AS sta_lta_peak_time, avg(ratio) AS sta_lta_mean
      FROM ratios GROUP BY 1)
    SELECT * FROM a LEFT JOIN b USING (station_code)""",
    "duration_s amplitude_peak amplitude_peak_time amplitude_rms amplitude_std percentile_95 sta_lta_peak sta_lta_peak_time sta_lta_mean",
)
def _(t):
    return D.trace_summary(t.samples, ["station_code"], 1.0, 4, 20)


@query(
    "trace_report",
    "samples",
    """, sized AS (SELECT *, count(*) OVER (PARTITION BY station_code) AS m, 0 AS win, n AS pos FROM samples), """
    + ratio_sql("sized", 4, 20)
    + """, a AS (SELECT station_code, TIMESTAMP '2024-01-01' + to_minutes(CAST(substr(station_code, 3) AS INTEGER)) AS start, count(*) AS npts,
      arg_max(n, (abs(x), -n)) AS peak_at, quantile_cont(abs(x), 0.95) AS percentile_95 FROM samples GROUP BY 1),
    b AS (SELECT station_code, max(ratio) AS sta_lta_peak, arg_max(n, (ratio, -n)) AS ratio_at FROM ratios GROUP BY 1)
    SELECT station_code AS trace_id, strftime(start, '%Y-%m-%dT%H:%M:%S.%fZ') AS start_time_iso,
      strftime(start + to_seconds(npts - 1), '%Y-%m-%dT%H:%M:%S.%fZ') AS end_time_iso, npts, percentile_95, epoch(start) + peak_at AS amplitude_peak_time_epoch,
      sta_lta_peak, epoch(start) + ratio_at AS sta_lta_peak_time_epoch FROM a LEFT JOIN b USING (station_code)""",
    "percentile_95 amplitude_peak_time_epoch:3 sta_lta_peak sta_lta_peak_time_epoch:3",
)
def _(t):
    minutes = F.substring("station_code", 3, 10).cast("long")
    starts = t.samples.select("station_code").distinct().withColumn("start", F.timestamp_micros(F.unix_micros(F.lit("2024-01-01").cast("timestamp")) + minutes * 60_000_000))
    made = D.trace_report(t.samples, starts, ["station_code"], 1.0, 4, 20)
    return made.select("trace_id", "start_time_iso", "end_time_iso", "npts", "percentile_95", "amplitude_peak_time_epoch", "sta_lta_peak", "sta_lta_peak_time_epoch")


@query("spectral_peak")
def _(t):
    return D.spectral_peak(t.samples, ["station_code"], 1.0).select(
        "station_code", F.round("frequency_peak_hz", 10).alias("frequency_peak_hz"), F.round("power_peak", 6).alias("power_peak")
    )


@query("invert_station_location")
def _(t):
    timed = join_travel_times(t.picks, origins(t))
    first = t.picks.filter(F.col("pick_id") % 4 == 0).select(F.col("pick_id").alias("event_id"), "station_code", "delta_seconds")
    placed = join_station_dim(first, t.stations.select("station_code", "latitude", "longitude")).filter(F.col("latitude").isNotNull())
    x, y = project_utm("latitude", "longitude")
    sources = placed.select("event_id", x.alias("x_m"), y.alias("y_m"), (F.col("delta_seconds") * -100).alias("z_m"))
    rows = timed.select("event_id", "station_code", (F.col("travel_time") / 10).alias("travel_time")).join(sources, "event_id")
    solved = D.invert_station_location(rows, events="event_id")
    metres = [F.round(c, 3).alias(c) for c in ("x_m", "y_m", "velocity_m_s", "rms_seconds")]
    degrees = [F.round(c, 8).alias(c) for c in ("latitude", "longitude", "velocity_km_s")]
    return solved.select("station_code", *metres, *degrees, "n_events", "success", F.sha2("event_ids_used", 256).alias("event_ids_sha256"))
