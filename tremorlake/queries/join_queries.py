"""Queries for the join operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tremorlake.operators import aggregates as A, joins as J
from tremorlake.queries import query
from tremorlake.queries.aggregate_queries import EVENTS, HAVERSINE
from tremorlake.sources import star

ORIGINS = "origins AS (SELECT pick_id AS event_id, arrival_iso AS origin_time, arrival_epoch AS origin_epoch FROM picks WHERE pick_id % 4 = 0)"


def origins(t):
    return t.picks.filter(F.col("pick_id") % 4 == 0).select(
        F.col("pick_id").alias("event_id"),
        F.col("arrival_iso").alias("origin_time"),
        F.col("arrival_epoch").alias("origin_epoch"),
    )


@query(
    "join_picks_events",
    "picks",
    f""", {ORIGINS}, known AS (SELECT event_id, CASE WHEN event_id % 12 <> 0 THEN origin_time END AS origin_time FROM origins)
    SELECT pick_id, event_id, origin_time FROM picks LEFT JOIN known USING (event_id) WHERE origin_time IS NOT NULL""",
)
def _(t):
    known = origins(t).select("event_id", F.when(F.col("event_id") % 12 != 0, F.col("origin_time")).alias("origin_time"))
    return J.join_picks_events(t.picks, known).select("pick_id", "event_id", "origin_time")


@query(
    "join_travel_times",
    "picks",
    f""", {ORIGINS}, timed AS (SELECT pick_id, station_code, arrival_epoch - origin_epoch AS travel_time,
      count(*) OVER (PARTITION BY station_code) AS n_events FROM picks JOIN origins USING (event_id)
      WHERE arrival_epoch - origin_epoch BETWEEN 0.05 AND 120)
    SELECT * FROM timed WHERE n_events >= 8""",
    "travel_time:5",
)
def _(t):
    return J.join_travel_times(t.picks, origins(t)).select("pick_id", "station_code", "travel_time", "n_events")


@query(
    "join_station_dim",
    "picks stations",
    """, odd AS (SELECT pick_id, CASE WHEN pick_id % 2 = 0 THEN ' ' || lower(station_code) ELSE station_code END AS station_code FROM picks)
    SELECT o.pick_id, o.station_code, s.latitude, s.longitude, s.elevation FROM odd o
    LEFT JOIN stations s ON upper(trim(o.station_code)) = s.station_code""",
    "latitude longitude elevation",
)
def _(t):
    code = F.when(F.col("pick_id") % 2 == 0, F.concat(F.lit(" "), F.lower("station_code"))).otherwise(F.col("station_code"))
    odd = t.picks.select("pick_id", code.alias("station_code"))
    return J.join_station_dim(odd, t.stations.select("station_code", "latitude", "longitude", "elevation"))


UNMATCHED = " SELECT DISTINCT station_code FROM picks WHERE station_code NOT IN (SELECT station_code FROM stations) ORDER BY 1"


@query(
    "require_lookup",
    "picks stations",
    """ SELECT pick_id, p.station_code, latitude, longitude FROM picks p JOIN stations s USING (station_code)
    WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
)
def _(t):
    placed = t.stations.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select("station_code", "latitude", "longitude")
    known = t.picks.join(placed.select("station_code"), "station_code", "left_semi")
    return J.require_lookup(known.select("pick_id", "station_code"), placed)


@query(
    "join_base_soft",
    "picks",
    """, b AS (SELECT station_code, count(*) AS base_count, avg(delta_seconds) AS base_mean, coalesce(stddev_samp(delta_seconds), 0e0) AS base_std,
      median(delta_seconds) AS base_median FROM picks WHERE run_id = 'run_0' AND station_code <> 'ST3' GROUP BY 1),
    s AS (SELECT station_code, count(*) AS soft_count, avg(delta_seconds) AS soft_mean, coalesce(stddev_samp(delta_seconds), 0e0) AS soft_std,
      median(delta_seconds) AS soft_median FROM picks WHERE run_id = 'run_1' AND station_code <> 'ST5' GROUP BY 1)
    SELECT *, soft_mean - base_mean AS soft_minus_base_mean FROM b FULL JOIN s USING (station_code)""",
    "base_mean base_std base_median soft_mean soft_std soft_median soft_minus_base_mean",
)
def _(t):
    base = t.picks.filter((F.col("run_id") == "run_0") & (F.col("station_code") != "ST3"))
    soft = t.picks.filter((F.col("run_id") == "run_1") & (F.col("station_code") != "ST5"))
    return J.join_base_soft(A.station_stats(base, "base"), A.station_stats(soft, "soft"))


ALL_MEANS = """means AS (SELECT station_code, avg(delta_seconds) AS delta_value FROM picks GROUP BY 1),
  base AS (SELECT m.*, s.longitude * 100000e0 AS easting, s.latitude * 100000e0 AS northing FROM means m JOIN stations s USING (station_code))"""


def all_means(t):
    """Mean delta of all picks, whatever their run, at each station's place."""
    return _at_places(t, t.picks.groupBy("station_code").agg(F.avg("delta_seconds").alias("delta_value")), [])


def run_means(t, run: str | None = None):
    """Mean delta at each station's place, of one run or, with its run_id, of each; longitude and latitude stand for x and y."""
    picks = t.picks.filter("run_id IS NOT NULL") if run is None else t.picks.filter(F.col("run_id") == run)
    group = ["run_id"] if run is None else []
    means = picks.groupBy(*group, "station_code").agg(F.avg("delta_seconds").alias("delta_value"))
    return _at_places(t, means, group)


def _at_places(t, means, group):
    placed = J.join_station_dim(means, t.stations.select("station_code", "latitude", "longitude")).filter(F.col("latitude").isNotNull())
    return placed.select(
        *group,
        "station_code",
        (F.col("longitude") * 100000.0).alias("easting"),
        (F.col("latitude") * 100000.0).alias("northing"),
        "delta_value",
    )


def every_run(t, operator):
    """``operator`` on the means of each run there is, with its run_id."""
    runs = [r["run_id"] for r in t.picks.select("run_id").filter("run_id IS NOT NULL").distinct().orderBy("run_id").collect()]
    made = [operator(run_means(t, run)).withColumn("run_id", F.lit(run)) for run in runs]
    return reduce(DataFrame.unionByName, made) if made else operator(run_means(t, "")).withColumn("run_id", F.lit("")).limit(0)


RUN_MEANS = """means AS (SELECT run_id, station_code, avg(delta_seconds) AS delta_value FROM picks GROUP BY 1, 2),
  points AS (SELECT m.*, s.longitude * 100000e0 AS easting, s.latitude * 100000e0 AS northing FROM means m JOIN stations s USING (station_code)),
  base AS (SELECT * FROM points WHERE run_id = 'run_0'), soft AS (SELECT * FROM points WHERE run_id = 'run_1')"""


@query(
    "join_coord_diff",
    "picks stations",
    f""", {RUN_MEANS} SELECT CAST(round(b.easting * 1000) AS BIGINT) AS easting_mm, CAST(round(b.northing * 1000) AS BIGINT) AS northing_mm,
    b.delta_value AS base_value, s.delta_value AS soft_value, s.delta_value - b.delta_value AS difference FROM base b JOIN soft s
    ON CAST(round(b.easting * 1000) AS BIGINT) = CAST(round(s.easting * 1000) AS BIGINT)
    AND CAST(round(b.northing * 1000) AS BIGINT) = CAST(round(s.northing * 1000) AS BIGINT)""",
    "base_value soft_value difference",
)
def _(t):
    return J.join_coord_diff(run_means(t, "run_0"), run_means(t, "run_1"))


_PAIR = HAVERSINE.format(lat1="a.latitude", lon1="a.longitude", lat2="b.latitude", lon2="b.longitude")


@query(
    "join_within_distance",
    "stations",
    f""", pairs AS (SELECT a.station_code AS source, b.station_code AS target, {_PAIR} AS distance_km
    FROM stations a JOIN stations b ON a.station_code <> b.station_code)
    SELECT source, target, distance_km, 1 / (distance_km + 0.1e0) AS weight FROM pairs WHERE distance_km < 10""",
    "distance_km:7 weight:8",
)
def _(t):
    return J.join_within_distance(t.stations)


_PLANAR = """sqrt((b.latitude - a.latitude) * (b.latitude - a.latitude)
  + (b.longitude - a.longitude) * (b.longitude - a.longitude))"""


@query(
    "join_distance_band",
    "stations",
    f""", pairs AS (SELECT a.station_code AS i, b.station_code AS j, {_PLANAR} AS distance
    FROM stations a JOIN stations b ON a.station_code <> b.station_code),
    near AS (SELECT *, 1 / distance AS raw FROM pairs WHERE distance <= 0.08e0)
    SELECT i, j, distance, raw / sum(raw) OVER (PARTITION BY i) AS weight FROM near""",
    "distance weight",
)
def _(t):
    return J.join_distance_band(t.stations, "station_code", 0.08)


@query(
    "join_knn",
    "stations",
    """, pairs AS (SELECT a.station_code AS i, b.station_code AS j, (b.longitude - a.longitude) * (b.longitude - a.longitude)
      + (b.latitude - a.latitude) * (b.latitude - a.latitude) AS d2 FROM stations a JOIN stations b ON a.station_code <> b.station_code),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY d2, j) AS rank FROM pairs)
    SELECT i, j, sqrt(d2) AS distance, rank, 0.2e0 AS weight FROM ranked WHERE rank <= 5""",
    "distance weight",
)
def _(t):
    return J.join_knn(t.stations, "station_code", 5, ("longitude", "latitude"))


@query("anti_missing_codes", "picks stations", UNMATCHED)
def _(t):
    ids = t.picks.select(F.concat_ws(".", "network", "station_code", "channel").alias("station_id"))
    return J.anti_missing_codes(ids, t.stations)


@query(
    "join_fk_map",
    "picks stations",
    f""", {EVENTS}, st AS (SELECT station_code, row_number() OVER (ORDER BY station_code) AS station_id FROM stations),
    ev AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS event_key FROM per_event)
    SELECT pick_id, station_id, event_key, delta_seconds FROM picks JOIN st USING (station_code) JOIN ev USING (event_id)""",
    "delta_seconds",
)
def _(t):
    stations = star.surrogate_keys(t.stations, "station_code", "station_id")
    events = star.surrogate_keys(A.event_catalog(t.picks), "event_id", "event_key")
    return J.join_fk_map(t.picks, stations, events).select("pick_id", "station_id", "event_key", "delta_seconds")


def _grid_sql(source: str, size: int, name: str) -> str:
    return f"""{name}_box AS (SELECT min(easting) AS x0, max(easting) AS x1, min(northing) AS y0, max(northing) AS y1 FROM {source}),
    {name}_nodes AS (SELECT ix, iy, x0 + (x1 - x0) * ix / {size - 1} AS x, y0 + (y1 - y0) * iy / {size - 1} AS y
      FROM {name}_box, range({size}) a(ix), range({size}) b(iy)),
    {name} AS (SELECT CAST(ix AS INTEGER) AS ix, CAST(iy AS INTEGER) AS iy,
      min_by(station_code, ((easting - x) * (easting - x) + (northing - y) * (northing - y), station_code)) AS station_code,
      min_by(delta_value, ((easting - x) * (easting - x) + (northing - y) * (northing - y), station_code)) AS delta_value
      FROM {name}_nodes, {source} GROUP BY ix, iy)"""


@query(
    "interp_nearest",
    "picks stations",
    f", {ALL_MEANS}, {_grid_sql('base', 60, 'g')} SELECT * FROM g",
    "delta_value",
)
def _(t):
    return J.interp_nearest(all_means(t), "station_code", "delta_value", 60, ("easting", "northing"))


@query(
    "interp_nearest_runs",
    "picks stations",
    f""", {RUN_MEANS}, box AS (SELECT run_id, min(easting) AS x0, max(easting) AS x1, min(northing) AS y0, max(northing) AS y1 FROM points GROUP BY 1),
    nodes AS (SELECT run_id, ix, iy, x0 + (x1 - x0) * ix / 59 AS x, y0 + (y1 - y0) * iy / 59 AS y FROM box, range(60) a(ix), range(60) b(iy))
    SELECT run_id, CAST(ix AS INTEGER) AS ix, CAST(iy AS INTEGER) AS iy,
      min_by(station_code, ((easting - x) * (easting - x) + (northing - y) * (northing - y), station_code)) AS station_code,
      min_by(delta_value, ((easting - x) * (easting - x) + (northing - y) * (northing - y), station_code)) AS delta_value
    FROM nodes JOIN points USING (run_id) GROUP BY 1, 2, 3""",
    "delta_value",
)
def _(t):
    return every_run(t, lambda means: J.interp_nearest(means, "station_code", "delta_value", 60, ("easting", "northing")))


@query(
    "grid_diff",
    "picks stations",
    f""", {RUN_MEANS}, {_grid_sql('base', 30, 'g')}, {_grid_sql('soft', 30, 'h')}
    SELECT ix, iy, g.delta_value AS base_value, h.delta_value AS soft_value, h.delta_value - g.delta_value AS difference
    FROM g JOIN h USING (ix, iy)""",
    "base_value soft_value difference",
)
def _(t):
    base, soft = (
        J.interp_nearest(run_means(t, run), "station_code", "delta_value", 30, ("easting", "northing")) for run in ("run_0", "run_1")
    )
    return J.grid_diff(base, soft, "delta_value")


@query(
    "compare_metrics",
    "picks",
    """, m AS (SELECT run_id, avg(delta_seconds) AS accuracy, max(delta_seconds) AS rmse, avg(delta_seconds * delta_seconds) AS r2 FROM picks GROUP BY 1),
    long AS (SELECT run_id, 'accuracy' AS metric, accuracy AS v FROM m UNION ALL SELECT run_id, 'rmse', rmse FROM m
      UNION ALL SELECT run_id, 'r2', r2 FROM m WHERE run_id = 'run_1'),
    a AS (SELECT metric, v AS value_1 FROM long WHERE run_id = 'run_0'), b AS (SELECT metric, v AS value_2 FROM long WHERE run_id = 'run_1')
    SELECT metric, value_1, value_2, value_2 - value_1 AS change, (value_2 - value_1) / value_1 * 100 AS percent,
      CASE WHEN metric IN ('accuracy', 'r2') THEN (value_2 > value_1)::INTEGER ELSE (value_2 < value_1)::INTEGER END AS improved
    FROM a FULL JOIN b USING (metric)""",
    "value_1 value_2 change percent:8",
)
def _(t):
    made = t.picks.groupBy("run_id").agg(
        F.avg("delta_seconds").alias("accuracy"),
        F.max("delta_seconds").alias("rmse"),
        F.avg(F.col("delta_seconds") * F.col("delta_seconds")).alias("r2"),
    )
    long = made.unpivot("run_id", ["accuracy", "rmse", "r2"], "metric", "value")
    first = long.filter((F.col("run_id") == "run_0") & (F.col("metric") != "r2")).drop("run_id")
    return J.compare_metrics(first, long.filter(F.col("run_id") == "run_1").drop("run_id"))
