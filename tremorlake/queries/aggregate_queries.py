"""Queries for station, event and report aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tremorlake.functions.geo import bearing_deg
from tremorlake.operators import aggregates as A
from tremorlake.queries import query
from tremorlake.queries.feature_queries import _hourly

HAVERSINE = """2 * 6371e0 * asin(sqrt(least(1e0, sin(radians({lat2} - {lat1}) / 2) ** 2
  + cos(radians({lat1})) * cos(radians({lat2})) * sin(radians({lon2} - {lon1}) / 2) ** 2)))"""
EVENTS = """per_event AS (SELECT event_id, count(DISTINCT station_code) AS n_stations, count(*) AS n_picks,
  min_by(arrival_epoch, (arrival_iso, pick_id)) AS event_reference_epoch, min(arrival_iso) AS first_arrival
  FROM picks GROUP BY event_id)"""
PLACED = "placed AS (SELECT p.*, s.latitude, s.longitude FROM picks p JOIN stations s USING (station_code))"
EPICENTRES = f"""{PLACED}, epicentres AS (SELECT event_id, avg(latitude) AS latitude, avg(longitude) AS longitude,
  count(DISTINCT station_code) AS n_stations, min(arrival_iso) AS first_arrival FROM placed GROUP BY event_id)"""


@query(
    "station_stats",
    "picks",
    """ SELECT station_code, count(delta_seconds) AS base_count, avg(delta_seconds) AS base_mean,
    coalesce(stddev_samp(delta_seconds), 0e0) AS base_std, median(delta_seconds) AS base_median FROM picks GROUP BY station_code""",
    "base_mean base_std base_median",
)
def _(t):
    return A.station_stats(t.picks)


@query(
    "filter_min_count_any",
    "picks",
    """, b AS (SELECT station_code, count(*) AS base_count FROM picks WHERE run_id = 'run_0' AND delta_seconds > 40 GROUP BY 1),
    s AS (SELECT station_code, count(*) AS soft_count FROM picks WHERE run_id = 'run_1' AND channel = 'error' GROUP BY 1)
    SELECT station_code, base_count, soft_count FROM b FULL JOIN s USING (station_code)
    WHERE coalesce(base_count, 0) >= 40 OR coalesce(soft_count, 0) >= 40""",
)
def _(t):
    counts = {
        "base": t.picks.filter((F.col("run_id") == "run_0") & (F.col("delta_seconds") > 40)),
        "soft": t.picks.filter((F.col("run_id") == "run_1") & (F.col("channel") == "error")),
    }
    base, soft = (d.groupBy("station_code").agg(F.count(F.lit(1)).alias(f"{n}_count")) for n, d in counts.items())
    return A.filter_min_count_any(base.join(soft, "station_code", "full"), 40)


@query("event_catalog", "picks", f", {EVENTS} SELECT * FROM per_event", "event_reference_epoch:6")
def _(t):
    return A.event_catalog(t.picks)


@query("event_epicenter", "picks stations", f", {EPICENTRES} SELECT * FROM epicentres", "latitude longitude")
def _(t):
    return A.event_epicenter(t.picks, t.stations)


@query(
    "hourly_spatial",
    "picks stations",
    f""", {PLACED} SELECT date_trunc('hour', arrival_iso) AS hour, count(DISTINCT station_code) AS num_stations,
    avg(latitude) AS mean_latitude, avg(longitude) AS mean_longitude, coalesce(stddev_samp(latitude), 0e0) AS std_latitude,
    coalesce(stddev_samp(longitude), 0e0) AS std_longitude, avg(delta_seconds) AS mean_delta,
    coalesce(stddev_samp(delta_seconds), 0e0) AS std_delta, coalesce(stddev_samp(latitude), 0e0) * 111.32e0 AS dispersione_spaziale_km
    FROM placed GROUP BY 1""",
    "mean_latitude mean_longitude std_latitude:7 std_longitude:7 mean_delta std_delta:8 dispersione_spaziale_km:5",
)
def _(t):
    return A.hourly_spatial(t.picks, t.stations)


@query("daily_counts", "picks", " SELECT CAST(CAST(arrival_iso AS DATE) AS VARCHAR) AS day, count(*) AS n_picks FROM picks GROUP BY 1")
def _(t):
    return A.daily_counts(t.picks).withColumn("day", F.col("day").cast("string"))


CHANNELS = ["click", "error", "purchase", "signup", "view"]


@query(
    "crosstab_top",
    "picks",
    """, best AS (SELECT station_code FROM picks GROUP BY 1 ORDER BY count(*) DESC, station_code LIMIT 10)
    SELECT station_code, """
    + ", ".join(f"count(*) FILTER (channel = '{c}') AS \"{c}\"" for c in CHANNELS)
    + " FROM picks JOIN best USING (station_code) GROUP BY station_code",
)
def _(t):
    return A.crosstab_top(t.picks, CHANNELS, top=10)


@query(
    "station_report",
    "picks",
    """ SELECT station_code, count(*) AS n_picks, avg(delta_seconds) AS mean_delta, max(delta_seconds) AS max_delta
    FROM picks GROUP BY 1 ORDER BY n_picks DESC, station_code""",
    "mean_delta max_delta",
)
def _(t):
    return A.station_report(t.picks)


@query("hour_of_day_histogram", "picks", " SELECT hour(arrival_iso)::INTEGER AS hour_of_day, count(*) AS n_picks FROM picks GROUP BY 1")
def _(t):
    return A.hour_of_day_histogram(t.picks)


@query(
    "size_distribution",
    "picks",
    f""", {EVENTS} SELECT CASE WHEN day(first_arrival) <= 15 THEN 'first' ELSE 'second' END AS phase, n_stations,
    count(*) AS n_events FROM per_event GROUP BY 1, 2 ORDER BY n_events DESC, n_stations""",
)
def _(t):
    phase = F.when(F.dayofmonth("first_arrival") <= 15, "first").otherwise("second").alias("phase")
    return A.size_distribution(A.event_catalog(t.picks), [phase])


@query(
    "phase_comparison",
    "picks",
    f""", {EVENTS} SELECT strftime(first_arrival, '%Y-%m') AS phase, count(DISTINCT CAST(first_arrival AS DATE)) AS n_days,
    count(*) AS n_events, count(*) / count(DISTINCT CAST(first_arrival AS DATE))::DOUBLE AS events_per_day,
    avg(n_stations) AS mean_stations, count(*) FILTER (n_stations = 4) AS n_full FROM per_event GROUP BY 1""",
    "events_per_day mean_stations",
)
def _(t):
    return A.phase_comparison(A.event_catalog(t.picks), full_size=4)


_CENTRE = HAVERSINE.format(lat1="latitude", lon1="longitude", lat2="40.8062e0", lon2="14.1410e0")


@query(
    "propagation_distance",
    "picks stations",
    f""", {EPICENTRES}, far AS (SELECT {_CENTRE} AS km, day(first_arrival) <= 15 AS early FROM epicentres)
    SELECT avg(km) FILTER (early) AS first_km, avg(km) FILTER (NOT early) AS second_km,
    avg(km) FILTER (NOT early) - avg(km) FILTER (early) AS shift_km FROM far""",
    "first_km:8 second_km:8 shift_km:8",
)
def _(t):
    phase = F.when(F.dayofmonth("first_arrival") <= 15, "first").otherwise("second")
    return A.propagation_distance(A.event_epicenter(t.picks, t.stations), ("first", "second"), phase)


MAGNITUDES = """sizes AS (SELECT round(magnitude * 4, 1) AS magnitude FROM catalog),
  cumulated AS (SELECT magnitude, n, CAST(sum(n) OVER (ORDER BY magnitude DESC) AS BIGINT) AS cumulative
    FROM (SELECT magnitude, count(*) AS n FROM sizes GROUP BY 1))"""


@query("magnitude_counts", "catalog", f", {MAGNITUDES} SELECT * FROM cumulated", "magnitude")
def _(t):
    return A.magnitude_counts(t.catalog.withColumn("magnitude", F.round(F.col("magnitude") * 4, 1)))


@query(
    "gutenberg_richter_b",
    "catalog",
    f""", {MAGNITUDES} SELECT -regr_slope(log10(cumulative), magnitude) AS b_value,
    regr_intercept(log10(cumulative), magnitude) AS a_value, count(*) AS n_points FROM cumulated WHERE magnitude BETWEEN 6 AND 15""",
    "b_value:8 a_value:8",
)
def _(t):
    return A.gutenberg_richter_b(t.catalog.withColumn("magnitude", F.round(F.col("magnitude") * 4, 1)))


@query(
    "target_share",
    "scores",
    " SELECT label, count(*) AS n_rows, count(*) / (SELECT count(*) FROM scores)::DOUBLE AS share FROM scores GROUP BY label",
    "share",
)
def _(t):
    return A.target_share(t.scores, "label")


@query(
    "class_balance",
    "picks",
    """ SELECT (delta_seconds >= 45)::INTEGER AS "Target_Allarme", count(*) AS n_rows,
    count(*) / (SELECT count(*) FROM picks)::DOUBLE AS share FROM picks GROUP BY 1""",
    "share",
)
def _(t):
    return A.target_share(t.picks.select((F.col("delta_seconds") >= 45).cast("int").alias("Target_Allarme")), "Target_Allarme")


@query(
    "risk_proxy_target",
    "picks",
    """ SELECT pick_id, greatest(0e0, least(1e0, abs(delta_seconds) /
    (SELECT quantile_cont(abs(delta_seconds), 0.95) FROM picks))) AS risk FROM picks""",
    "risk",
)
def _(t):
    return A.risk_proxy_target(t.picks).select("pick_id", "risk")


@query(
    "risk_proxy_waveform",
    "energy",
    """, spread AS (SELECT station_code, channel, hour, rms / 10 AS std, peak - rms AS amplitude_range FROM energy)
    SELECT station_code, channel, hour, 0.5e0 * (std / (SELECT max(std) FROM spread))
    + 0.5e0 * (amplitude_range / (SELECT max(amplitude_range) FROM spread)) AS risk FROM spread""",
    "risk",
)
def _(t):
    spread = t.energy.select(
        "station_code", "channel", "hour", (F.col("rms") / 10).alias("std"), (F.col("peak") - F.col("rms")).alias("amplitude_range")
    )
    return A.risk_proxy_waveform(spread).select("station_code", "channel", "hour", "risk")


HOLED = """holed AS (SELECT pick_id, CASE WHEN pick_id % 3 = 0 THEN NULL ELSE station_code END AS station_code,
  CASE WHEN channel = 'view' THEN NULL ELSE delta_seconds END AS delta_seconds,
  CASE WHEN channel IN ('view', 'click') THEN NULL ELSE network END AS network FROM picks)"""


def holed(t):
    return t.picks.select(
        "pick_id",
        F.when(F.col("pick_id") % 3 != 0, F.col("station_code")).alias("station_code"),
        F.when(F.col("channel") != "view", F.col("delta_seconds")).alias("delta_seconds"),
        F.when(~F.col("channel").isin("view", "click"), F.col("network")).alias("network"),
    )


@query(
    "missing_pct",
    "picks",
    f""", {HOLED} SELECT 100e0 * (count(*) * 4 - count(pick_id) - count(station_code) - count(delta_seconds) - count(network))
    / (count(*) * 4) AS missing_pct FROM holed""",
    "missing_pct",
)
def _(t):
    return A.missing_pct(holed(t))


@query(
    "alert_kpis",
    "alerts",
    """ SELECT count(*) AS total, count(*) FILTER (timestamp >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 24 HOUR) AS last_24h,
    avg(risk_score) AS mean_risk, count(DISTINCT station) AS stations FROM alerts""",
    "mean_risk",
)
def _(t):
    return A.alert_kpis(t.alerts, F.lit("2024-01-30 00:00:00").cast("timestamp"))


@query("outcome_counts", "", "SELECT o_orderstatus AS status, count(*) AS n_tasks FROM orders GROUP BY 1")
def _(t):
    return A.outcome_counts(t.raw("orders").withColumnRenamed("o_orderstatus", "status"))


@query(
    "ingest_check_counts",
    "picks energy",
    """ SELECT 'raw_deltas' AS table_name, run_id, count(*) AS n_rows, min(arrival_iso) AS first_time, max(arrival_iso) AS last_time
    FROM picks GROUP BY run_id UNION ALL SELECT 'waveform_energy_hourly', 'run_0', count(*), min(hour), max(hour) FROM energy""",
)
def _(t):
    energy = t.energy.withColumn("run_id", F.lit("run_0"))
    return A.ingest_check_counts({"raw_deltas": (t.picks, "arrival_iso"), "waveform_energy_hourly": (energy, "hour")})


@query(
    "lag_autocorr",
    "hourly",
    """, shifted AS (SELECT numero_eventi::DOUBLE AS x, CAST(lag(numero_eventi, 1) OVER w AS DOUBLE) AS a,
    CAST(lag(numero_eventi, 6) OVER w AS DOUBLE) AS b FROM hourly WINDOW w AS (ORDER BY timestamp))
    SELECT corr(x, a) AS autocorr_1h, corr(x, b) AS autocorr_6h FROM shifted""",
    "autocorr_1h autocorr_6h",
)
def _(t):
    return A.lag_autocorr(_hourly(t))


BEARING = """(degrees(atan2(sin(radians({lon2} - {lon1})) * cos(radians({lat2})), cos(radians({lat1})) * sin(radians({lat2}))
  - sin(radians({lat1})) * cos(radians({lat2})) * cos(radians({lon2} - {lon1})))) + 360) % 360"""


@query(
    "circular_mean",
    "picks stations",
    f""", {PLACED}, turned AS (SELECT channel, radians({BEARING.format(lat1="40.8062e0", lon1="14.1410e0", lat2="latitude", lon2="longitude")}) AS b
      FROM placed)
    SELECT channel, (degrees(atan2(avg(sin(b)), avg(cos(b)))) + 360) % 360 AS mean_bearing FROM turned GROUP BY channel""",
    "mean_bearing:6",
)
def _(t):
    from tremorlake.operators.joins import join_station_dim

    placed = join_station_dim(t.picks, t.stations.select("station_code", "latitude", "longitude")).filter(F.col("latitude").isNotNull())
    return A.circular_mean(placed, bearing_deg(*A.CENTRE, "latitude", "longitude"), ["channel"])
