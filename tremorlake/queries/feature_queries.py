"""Queries for the hourly grid, its aggregates and the feature series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tremorlake.operators import hourly as H, windows as R
from tremorlake.plans import features as P
from tremorlake.queries import query

STATION_HOUR = """station_hour AS (
  SELECT hour, station_code, avg(rms) AS rms, max(peak) AS peak FROM energy
  WHERE rms > 0 AND peak > 0 GROUP BY hour, station_code)"""
RATIOS = (
    STATION_HOUR
    + """, based AS (
  SELECT *, quantile_cont(rms, 0.5) OVER past AS base_rms, quantile_cont(peak, 0.5) OVER past AS base_peak
  FROM station_hour
  WINDOW past AS (PARTITION BY station_code ORDER BY hour ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING)),
ratios AS (
  SELECT hour, station_code, log10(rms / greatest(base_rms, 1e-9)) AS rms_log_ratio,
         log10(peak / greatest(base_peak, 1e-9)) AS peak_log_ratio
  FROM based WHERE base_rms IS NOT NULL)"""
)
ROBUST = (
    RATIOS
    + """, robust AS (
  SELECT hour, count(*) AS n_stations_energy, median(rms_log_ratio) AS net_rms_log_ratio_med,
         median(peak_log_ratio) AS net_peak_log_ratio_med,
         count(*) FILTER (rms_log_ratio >= 0.301e0) AS n_stations_2x_rms,
         count(*) FILTER (rms_log_ratio >= 0.301e0) / count(*)::DOUBLE AS frac_stations_2x_rms
  FROM ratios GROUP BY hour)"""
)
GRID = """grid AS (
  SELECT unnest(generate_series(date_trunc('hour', min(arrival_iso)), date_trunc('hour', max(arrival_iso)),
                                INTERVAL 1 HOUR)) AS timestamp FROM picks)"""
COUNTS = """counted AS (
  SELECT date_trunc('hour', arrival_iso) AS hour, count(*) AS numero_eventi,
         count(DISTINCT station_code) AS stazioni_attive, max(delta_seconds) AS energia_max,
         avg(delta_seconds) AS energia_media, stddev_pop(delta_seconds) AS energia_std
  FROM picks GROUP BY 1)"""
CATALOG = """quakes AS (
  SELECT date_trunc('hour', time) AS hour, count(*) AS catalog_n, max(magnitude) AS catalog_max
  FROM catalog GROUP BY 1)"""
BASE = f"""{ROBUST}, {GRID}, {COUNTS}, {CATALOG},
base AS (
  SELECT g.timestamp, coalesce(c.numero_eventi, 0) AS numero_eventi, coalesce(c.energia_max, 0e0) AS energia_max,
         coalesce(c.energia_media, 0e0) AS energia_media, coalesce(c.energia_std, 0e0) AS energia_std,
         q.catalog_n, q.catalog_max, coalesce(r.net_rms_log_ratio_med, 0e0) AS net_rms_log_ratio_med,
         coalesce(r.net_peak_log_ratio_med, 0e0) AS net_peak_log_ratio_med,
         coalesce(r.n_stations_energy, 0)::DOUBLE AS n_stations_energy,
         coalesce(r.frac_stations_2x_rms, 0e0) AS frac_stations_2x_rms,
         (coalesce(c.stazioni_attive, 0)
            >= 0.95e0 * (SELECT count(DISTINCT station_code) FROM picks))::INTEGER AS is_data_complete
  FROM grid g LEFT JOIN counted c ON c.hour = g.timestamp LEFT JOIN quakes q ON q.hour = g.timestamp
       LEFT JOIN robust r ON r.hour = g.timestamp)"""


@query("hour_grid", "picks", f", {GRID} SELECT * FROM grid")
def _(t):
    return H.hour_grid(t.picks, "arrival_iso")


@query("hourly_counts", "picks", f", {COUNTS} SELECT * FROM counted", "energia_max energia_media energia_std")
def _(t):
    return H.hourly_counts(t.picks).drop("last_arrival")


@query(
    "hourly_counts_legacy",
    "picks",
    f""", {GRID} SELECT g.timestamp, count(p.pick_id) AS numero_eventi, coalesce(max(abs(delta_seconds)), 0e0) AS energia_max,
    coalesce(avg(abs(delta_seconds)), 0e0) AS energia_media, coalesce(stddev_samp(abs(delta_seconds)), 0e0) AS energia_std,
    coalesce(min(abs(delta_seconds)), 0e0) AS energia_min
    FROM grid g LEFT JOIN picks p ON date_trunc('hour', p.arrival_iso) = g.timestamp GROUP BY g.timestamp""",
    "energia_max energia_media energia_std energia_min",
)
def _(t):
    return H.hourly_counts_legacy(t.picks, value=F.abs("delta_seconds"))


@query("expected_stations", "picks", " SELECT count(DISTINCT station_code) AS stazioni_attese FROM picks")
def _(t):
    return H.expected_stations(t.picks)


@query(
    "data_completeness",
    "picks",
    f""", {GRID}, {COUNTS} SELECT timestamp, coalesce(stazioni_attive, 0) AS stazioni_attive,
    (coalesce(stazioni_attive, 0) >= 0.95e0 * (SELECT count(DISTINCT station_code) FROM picks))::INTEGER AS is_data_complete
    FROM grid LEFT JOIN counted ON hour = timestamp""",
)
def _(t):
    counts = H.hourly_counts(t.picks).select("hour", "stazioni_attive")
    joined = H.join_hourly_grid(H.hour_grid(t.picks, "arrival_iso"), [counts])
    flag = H.data_completeness(F.col("stazioni_attive"), H.expected_stations(t.picks).scalar())
    return joined.select("timestamp", F.coalesce("stazioni_attive", F.lit(0)).alias("stazioni_attive"), flag.alias("is_data_complete"))


@query("catalog_hourly", "catalog", f", {CATALOG} SELECT * FROM quakes", "catalog_max")
def _(t):
    return H.catalog_hourly(t.catalog)


@query("energy_station_hour", "energy", f", {STATION_HOUR} SELECT * FROM station_hour", "rms peak")
def _(t):
    return H.energy_station_hour(t.energy)


@query("causal_log_ratio", "energy", f", {RATIOS} SELECT * FROM ratios", "rms_log_ratio peak_log_ratio")
def _(t):
    return H.causal_log_ratio(H.energy_station_hour(t.energy))


@query(
    "energy_robust_network",
    "energy",
    f", {ROBUST} SELECT * FROM robust",
    "net_rms_log_ratio_med net_peak_log_ratio_med frac_stations_2x_rms",
)
def _(t):
    return H.energy_robust_network(H.causal_log_ratio(H.energy_station_hour(t.energy)))


@query(
    "join_hourly_grid",
    "picks catalog energy",
    f", {BASE} SELECT * FROM base",
    "energia_max energia_media energia_std catalog_max net_rms_log_ratio_med net_peak_log_ratio_med frac_stations_2x_rms",
)
def _(t):
    return P.hourly_base(t.picks, t.catalog, t.energy).drop("last_arrival")


@query(
    "join_scalar",
    "picks",
    """ SELECT pick_id, delta_seconds, (SELECT count(DISTINCT station_code) FROM picks) AS stazioni_attese,
    (SELECT max(arrival_iso) FROM picks) AS data_end FROM picks
    WHERE arrival_iso < (SELECT max(arrival_iso) FROM picks) - INTERVAL 6 HOUR""",
    "delta_seconds",
)
def _(t):
    end = t.picks.agg(F.max("arrival_iso").alias("end")).scalar()
    return t.picks.filter(F.col("arrival_iso") < end - F.expr("INTERVAL 6 HOURS")).select(
        "pick_id", "delta_seconds", H.expected_stations(t.picks).scalar().alias("stazioni_attese"), end.alias("data_end")
    )


@query(
    "label_future_exists",
    "picks big_events",
    f""", {GRID} SELECT timestamp, EXISTS (SELECT 1 FROM big_events b WHERE b.time > timestamp
    AND b.time <= timestamp + INTERVAL 6 HOUR)::INTEGER AS label FROM grid""",
)
def _(t):
    return R.label_future_exists(H.hour_grid(t.picks, "arrival_iso"), t.big_events, 6, "label")


LEGACY_SERIES = "numero_eventi energia_max energia_media energia_std"


def _hourly(t):
    return H.hourly_counts_legacy(t.picks).select("timestamp", *LEGACY_SERIES.split())


ROLL = """WINDOW w6 AS (ORDER BY timestamp ROWS 5 PRECEDING), w12 AS (ORDER BY timestamp ROWS 11 PRECEDING),
w24 AS (ORDER BY timestamp ROWS 23 PRECEDING), w48 AS (ORDER BY timestamp ROWS 47 PRECEDING)"""


def _roll(template: str, windows=(6, 12, 24, 48)) -> str:
    return ", ".join(template.format(n=n, half=n // 2) for n in windows)


FEATURE_DOUBLES = (
    "energia_max energia_media energia_std "
    + " ".join(f"energia_max_ultime_{n}h energia_media_ultime_{n}h" for n in (6, 12, 24, 48))
    + " net_rms_log_ratio_med net_peak_log_ratio_med frac_stations_2x_rms net_rms_log_ratio_6h "
    "net_rms_log_ratio_max_24h frac_stations_2x_6h frac_stations_2x_max_24h magnitudo_max_6h"
)
COUNT_ROLL = _roll("sum(numero_eventi) OVER w{n}::BIGINT AS eventi_ultime_{n}h")
COUNT_ROLL = _roll("CAST(sum(numero_eventi) OVER w{n} AS BIGINT) AS eventi_ultime_{n}h")
ENERGY_ROLL = _roll(
    "max(energia_max) OVER w{n} AS energia_max_ultime_{n}h, avg(energia_media) OVER w{n} AS energia_media_ultime_{n}h"
)
NETWORK_ROLL = """avg(net_rms_log_ratio_med) OVER w6 AS net_rms_log_ratio_6h,
  max(net_rms_log_ratio_med) OVER w24 AS net_rms_log_ratio_max_24h, avg(frac_stations_2x_rms) OVER w6 AS frac_stations_2x_6h,
  max(frac_stations_2x_rms) OVER w24 AS frac_stations_2x_max_24h"""
CALENDAR = """hour(timestamp)::INTEGER AS ora_del_giorno, dayofweek(timestamp)::INTEGER AS giorno_della_settimana,
  (hour(timestamp) NOT BETWEEN 7 AND 21)::INTEGER AS is_notte, (dayofweek(timestamp) IN (0, 6))::INTEGER AS is_weekend"""
FEATURES_SQL = f"""SELECT timestamp, numero_eventi, energia_max, energia_media, energia_std, {COUNT_ROLL}, {ENERGY_ROLL},
  {CALENDAR}, NULL::DOUBLE AS bvalue_rolling_24h, is_data_complete, net_rms_log_ratio_med, net_peak_log_ratio_med,
  n_stations_energy, frac_stations_2x_rms, {NETWORK_ROLL},
  CAST(coalesce(sum(catalog_n) OVER w6, 0) AS DOUBLE) AS eventi_catalogo_6h,
  coalesce(max(catalog_max) OVER w6, 0e0) AS magnitudo_max_6h,
  EXISTS (SELECT 1 FROM big_events b WHERE b.time > timestamp AND b.time <= timestamp + INTERVAL 6 HOUR)::INTEGER
    AS "Target_Allarme"
  FROM base {ROLL}"""


@query(
    "hourly_features_view",
    "picks catalog energy big_events",
    f""", {BASE}, made AS ({FEATURES_SQL})
    SELECT * FROM made WHERE timestamp < (SELECT max(arrival_iso) FROM picks) - INTERVAL 6 HOUR""",
    FEATURE_DOUBLES,
)
def _(t):
    return P.hourly_features_view(t.picks, t.catalog, t.energy, label_events=t.big_events)


@query(
    "union_history",
    "picks hourly",
    f""", old AS (SELECT date_trunc('hour', arrival_iso) - INTERVAL 60 DAY AS timestamp, count(*) AS numero_eventi,
      max(delta_seconds) AS energia_max, max(delta_seconds) >= 45 AS big FROM picks WHERE run_id = 'run_0' GROUP BY 1),
    made AS (SELECT timestamp, numero_eventi, energia_max, {COUNT_ROLL} FROM hourly {ROLL})
    SELECT timestamp, numero_eventi, energia_max, 0 AS eventi_ultime_6h, {CALENDAR}, big::INTEGER AS "Target_Allarme",
      NULL::DOUBLE AS magnitudo_max_6h FROM old
    UNION ALL SELECT timestamp, numero_eventi, energia_max, eventi_ultime_6h, {CALENDAR}, NULL, 1.5e0 FROM made""",
    "energia_max",
)
def _(t):
    counts = H.hourly_counts(t.picks.filter(F.col("run_id") == "run_0"))
    old = counts.select(
        (F.col("hour") - F.expr("INTERVAL 60 DAYS")).alias("timestamp"),
        "numero_eventi",
        "energia_max",
        (F.col("energia_max") >= 45).cast("int").alias("Target_Allarme"),
    )
    made = R.rolling_counts(_hourly(t)).withColumns(
        {**P.calendar_features("timestamp"), "magnitudo_max_6h": F.lit(1.5)}
    )
    kept = "timestamp numero_eventi energia_max eventi_ultime_6h ora_del_giorno giorno_della_settimana is_notte is_weekend"
    return P.union_history(made, old).select(*kept.split(), "Target_Allarme", "magnitudo_max_6h")


@query("rolling_counts", "hourly", f" SELECT timestamp, numero_eventi, {COUNT_ROLL} FROM hourly {ROLL}")
def _(t):
    return R.rolling_counts(_hourly(t).select("timestamp", "numero_eventi"))


@query(
    "rolling_energy",
    "hourly",
    f" SELECT timestamp, {ENERGY_ROLL} FROM hourly {ROLL}",
    " ".join(f"energia_max_ultime_{n}h energia_media_ultime_{n}h" for n in (6, 12, 24, 48)),
)
def _(t):
    return R.rolling_energy(_hourly(t)).drop(*LEGACY_SERIES.split())


@query(
    "rolling_catalog_past",
    "picks catalog",
    f""", {GRID}, {CATALOG} SELECT timestamp,
    CAST(coalesce(sum(catalog_n) OVER (ORDER BY timestamp ROWS 5 PRECEDING), 0) AS BIGINT) AS eventi_catalogo_6h,
    coalesce(max(catalog_max) OVER (ORDER BY timestamp ROWS 5 PRECEDING), 0e0) AS magnitudo_max_6h
    FROM grid LEFT JOIN quakes ON hour = timestamp""",
    "magnitudo_max_6h",
)
def _(t):
    grid = H.join_hourly_grid(H.hour_grid(t.picks, "arrival_iso"), [H.catalog_hourly(t.catalog)])
    return R.rolling_catalog_past(grid).select("timestamp", "eventi_catalogo_6h", "magnitudo_max_6h")


@query(
    "rolling_network_energy",
    "picks catalog energy",
    f""", {BASE} SELECT timestamp, {NETWORK_ROLL} FROM base {ROLL}""",
    "net_rms_log_ratio_6h net_rms_log_ratio_max_24h frac_stations_2x_6h frac_stations_2x_max_24h",
)
def _(t):
    rolled = R.rolling_network_energy(P.hourly_base(t.picks, t.catalog, t.energy))
    return rolled.select(
        "timestamp", "net_rms_log_ratio_6h", "net_rms_log_ratio_max_24h", "frac_stations_2x_6h", "frac_stations_2x_max_24h"
    )
