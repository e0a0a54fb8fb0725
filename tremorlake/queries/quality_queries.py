"""Queries for aliases, coercion, checks and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tremorlake.functions.geo import kruger_forward, rectifying_radius
from tremorlake.operators import aggregates as A, quality as Q
from tremorlake.queries import query
from tremorlake.queries.aggregate_queries import HOLED, holed


@query(
    "alias_columns",
    "",
    "SELECT event_id AS alert_id, ts AS timestamp, value / 500e0 AS risk_score, user_id AS station FROM events",
    "risk_score",
)
def _(t):
    odd = t.events.select(
        F.col("event_id").alias("alert_id"),
        F.col("ts").alias("created_at"),
        F.date_trunc("day", "ts").alias("alert_time"),
        (F.col("value") / 500.0).alias("probability"),
        F.col("user_id").alias("station_id"),
    )
    return Q.alias_columns(odd, Q.ALERT_ALIASES)


@query(
    "coerce_types",
    "",
    """SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN ts END AS at_time, CASE WHEN event_id % 7 <> 0 THEN value END AS value
    FROM events WHERE event_id % 5 <> 0""",
    "value",
)
def _(t):
    texts = t.events.select(
        "event_id",
        F.when(F.col("event_id") % 5 == 0, "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("at_time"),
        F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("value"),
    )
    return Q.coerce_types(texts, {"at_time": "timestamp", "value": "double"}, ["at_time"])


@query(
    "fallback_time",
    "picks",
    """ SELECT pick_id, CASE WHEN pick_id % 3 <> 0 THEN make_timestamp(CAST(round(arrival_epoch * 1e6) AS BIGINT)) END AS timestamp
    FROM picks""",
)
def _(t):
    epoch = F.when(F.col("pick_id") % 3 != 0, F.col("arrival_epoch").cast("string")).otherwise("?")
    untimed = t.picks.select("pick_id", F.lit(None).cast("timestamp").alias("timestamp"), epoch.alias("arrival_epoch"))
    return Q.fallback_time(untimed).select("pick_id", "timestamp")


@query(
    "normalize_alerts",
    "",
    """SELECT ts AS timestamp, 'ST' || (user_id % 26) AS station, greatest(0e0, least(1e0, value / 400e0 - 0.1e0)) AS risk_score,
    CASE WHEN greatest(0e0, least(1e0, value / 400e0 - 0.1e0)) >= 0.85 THEN 'critical'
         WHEN greatest(0e0, least(1e0, value / 400e0 - 0.1e0)) >= 0.65 THEN 'high'
         WHEN greatest(0e0, least(1e0, value / 400e0 - 0.1e0)) >= 0.40 THEN 'medium' ELSE 'low' END AS severity,
    event_id / 1000e0 AS latitude, NULL::DOUBLE AS longitude, event_type AS message FROM events""",
    "risk_score latitude",
)
def _(t):
    odd = t.events.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("alert_time"),
        F.concat(F.lit("ST"), F.col("user_id") % 26).alias("station_code"),
        (F.col("value") / 400.0 - 0.1).cast("string").alias("risk"),
        (F.col("event_id") / 1000.0).cast("string").alias("lat"),
        F.col("event_type").alias("message"),
    )
    return Q.normalize_alerts(odd)


@query(
    "normalize_severity_words",
    "",
    """SELECT event_id::VARCHAR AS message, CASE event_type WHEN 'error' THEN 'high' WHEN 'click' THEN 'medium' ELSE event_type END AS severity,
    'UNKNOWN' AS station FROM events""",
)
def _(t):
    word = F.when(F.col("event_type") == "error", "ALERT").when(F.col("event_type") == "click", "Warn").otherwise(F.upper("event_type"))
    odd = t.events.select(F.col("ts").alias("time"), word.alias("severity"), F.col("event_id").cast("string").alias("message"))
    return Q.normalize_alerts(odd).select("message", "severity", "station")


@query(
    "pick_value_column",
    "picks",
    " SELECT station_code, avg(delta_seconds) AS delta_seconds FROM picks GROUP BY 1",
    "delta_seconds",
)
def _(t):
    return Q.pick_value_column(A.station_stats(t.picks)).select("station_code", "delta_seconds")


@query(
    "filter_in_list",
    "picks",
    """ SELECT pick_id, station_code, channel FROM picks WHERE station_code IN ('ST1', 'ST4', 'ST25') AND network IN ('N0', 'N1')
    AND upper(right(channel, 1)) = 'W'""",
)
def _(t):
    kept = Q.filter_in_list(t.picks, {"station_code": ["st1", " ST4", "ST25"], "network": ["n0", "N1"]})
    return Q.filter_component(kept, "w").select("pick_id", "station_code", "channel")


@query(
    "filter_delta_range",
    "picks",
    " SELECT pick_id, station_code, delta_seconds FROM picks WHERE delta_seconds BETWEEN 2 AND 7.5 AND station_code LIKE '%T1%'",
    "delta_seconds",
)
def _(t):
    return Q.filter_delta_range(t.picks, 2.0, 7.5, "t1").select("pick_id", "station_code", "delta_seconds")


_E = "0.0818191908426214943348e0"


def utm_sql(lat: str, lon: str) -> tuple[str, str]:
    """Easting and northing of the published series as SQL."""
    sine = f"sin(radians({lat}))"
    turn = f"radians({lon} - 15)"
    tau = f"sinh(atanh({sine}) - {_E} * atanh({_E} * {sine}))"
    xi = f"atan2({tau}, cos({turn}))"
    eta = f"asinh(sin({turn}) / sqrt({tau} * {tau} + cos({turn}) * cos({turn})))"
    x, y = f"({eta})", f"({xi})"
    for k, a in enumerate(kruger_forward(), start=1):
        x += f" + {a!r}::DOUBLE * cos({2 * k} * {xi}) * sinh({2 * k} * {eta})"
        y += f" + {a!r}::DOUBLE * sin({2 * k} * {xi}) * cosh({2 * k} * {eta})"
    scale = f"{0.9996 * rectifying_radius()!r}::DOUBLE"
    return f"(500000 + {scale} * ({x}))", f"({scale} * ({y}))"


_X, _Y = utm_sql("latitude", "longitude")
_X0, _Y0 = utm_sql("40.82e0", "14.14e0")


@query(
    "filter_radius",
    "stations",
    f" SELECT station_code, latitude, longitude FROM stations WHERE ({_X} - {_X0}) ** 2 + ({_Y} - {_Y0}) ** 2 <= 9000 ** 2",
    "latitude longitude",
)
def _(t):
    return Q.filter_radius(t.stations, 40.82, 14.14, 9.0).select("station_code", "latitude", "longitude")


POLYGON = [(40.70, 14.00), (40.88, 14.02), (40.93, 14.31), (40.76, 14.20)]


def polygon_sql(corners) -> str:
    """Even-odd crossings as a sum of SQL cases."""
    cases = []
    for (a, b), (c, d) in zip(corners, corners[1:] + corners[:1]):
        cases.append(
            f"CASE WHEN ({a} > latitude) <> ({c} > latitude) AND longitude < {b}e0 + (latitude - {a}e0) * ({d}e0 - {b}e0) / ({c}e0 - {a}e0) "
            "THEN 1 ELSE 0 END"
        )
    return f"({' + '.join(cases)}) % 2 = 1"


@query(
    "filter_polygon",
    "stations",
    f" SELECT station_code, latitude, longitude FROM stations WHERE {polygon_sql(POLYGON)}",
    "latitude longitude",
)
def _(t):
    text = " ".join(f"{a},{b}" for a, b in POLYGON)
    return Q.filter_polygon(t.stations, text).select("station_code", "latitude", "longitude")


@query(
    "check_coordinates",
    "picks",
    """, c AS (SELECT delta_seconds * 10 - 50 AS lat, CASE WHEN pick_id % 9 <> 0 THEN delta_seconds * 20 END AS lon FROM picks)
    SELECT count(*) FILTER (lat NOT BETWEEN -90 AND 90) AS bad_latitude, count(*) FILTER (lon NOT BETWEEN -180 AND 180) AS bad_longitude,
    count(*) FILTER (lat IS NULL OR lon IS NULL) AS missing FROM c""",
)
def _(t):
    lon = F.when(F.col("pick_id") % 9 != 0, F.col("delta_seconds") * 20)
    return Q.check_coordinates(t.picks.select((F.col("delta_seconds") * 10 - 50).alias("lat"), lon.alias("lon")), "lat", "lon")


@query(
    "check_numeric_range",
    "picks",
    f""", {HOLED} SELECT count(*) FILTER (delta_seconds NOT BETWEEN 1 AND 20) AS out_of_range,
    count(*) FILTER (delta_seconds IS NULL) AS missing FROM holed""",
)
def _(t):
    return Q.check_numeric_range(holed(t), "delta_seconds", 1, 20)


@query(
    "check_schema_types",
    "",
    """SELECT count(*) AS n_rows, count(*) FILTER (event_id % 7 = 0) AS value, 0 AS event_id FROM events""",
)
def _(t):
    value = F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col("value").cast("string"))
    found = Q.uncastable(t.events.select(F.col("event_id").cast("string").alias("event_id"), value.alias("value")), {"value": "double", "event_id": "bigint"})
    return found.withColumn("event_id", F.col("event_id").cast("int"))


@query(
    "filter_iqr",
    "picks",
    """, a AS (SELECT pick_id, delta_seconds, arrival_epoch, delta_seconds * delta_seconds AS energy FROM picks),
    b AS (SELECT a.* FROM a, (SELECT quantile_cont(delta_seconds, 0.25) AS q1, quantile_cont(delta_seconds, 0.75) AS q3 FROM a)
      WHERE delta_seconds BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)),
    c AS (SELECT b.* FROM b, (SELECT quantile_cont(energy, 0.25) AS q1, quantile_cont(energy, 0.75) AS q3 FROM b)
      WHERE energy BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))
    SELECT pick_id, delta_seconds, energy FROM c""",
    "delta_seconds energy",
)
def _(t):
    wide = t.picks.select("pick_id", "delta_seconds", (F.col("delta_seconds") * F.col("delta_seconds")).alias("energy"))
    return Q.filter_iqr(wide, ["delta_seconds", "energy"])


@query(
    "filter_anomaly",
    "picks",
    """ SELECT pick_id, delta_seconds - 5 AS delta_seconds, CASE WHEN delta_seconds >= 5.5 THEN 'slow' ELSE 'fast' END AS anomaly
    FROM picks WHERE abs(delta_seconds - 5) >= 0.5""",
    "delta_seconds",
)
def _(t):
    return Q.filter_anomaly(t.picks.select("pick_id", (F.col("delta_seconds") - 5).alias("delta_seconds")))


@query(
    "drop_sparse_rows",
    "picks",
    f""", {HOLED} SELECT pick_id, station_code, delta_seconds, network FROM holed
    WHERE (station_code IS NULL)::INTEGER + (delta_seconds IS NULL)::INTEGER + (network IS NULL)::INTEGER <= 1""",
    "delta_seconds",
)
def _(t):
    return Q.drop_sparse_rows(holed(t), 30.0)


@query(
    "drop_duplicates",
    "picks",
    """ SELECT DISTINCT 0 AS by_key, event_id, station_code, NULL::BIGINT AS pick_id FROM picks
    UNION ALL SELECT 1, event_id, station_code, min(pick_id) FROM picks GROUP BY event_id, station_code""",
)
def _(t):
    rows = t.picks.select(F.lit(0).alias("by_key"), "event_id", "station_code", F.lit(None).cast("long").alias("pick_id"))
    keyed = t.picks.select(F.lit(1).alias("by_key"), "event_id", "station_code", "pick_id")
    return Q.drop_duplicates(rows).unionByName(Q.drop_duplicates(keyed, ["event_id", "station_code"], ["pick_id"]))


@query(
    "fill_defaults",
    "picks",
    f""", {HOLED} SELECT pick_id, coalesce(station_code, 'UNKNOWN') AS station_code, coalesce(delta_seconds, -1e0) AS delta_seconds,
    coalesce(network, 'IV') AS network FROM holed""",
    "delta_seconds",
)
def _(t):
    return Q.fill_defaults(holed(t), {"station_code": Q.UNKNOWN_STATION, "delta_seconds": -1.0, "network": "IV"})


@query(
    "split_features_target",
    "picks",
    f", {HOLED} SELECT pick_id, station_code, delta_seconds FROM holed WHERE delta_seconds IS NOT NULL",
    "delta_seconds",
)
def _(t):
    return Q.split_features_target(holed(t), "delta_seconds", drop=["network"])[0]


@query(
    "filter_time_lookback",
    "alerts",
    " SELECT alert_id, timestamp FROM alerts WHERE timestamp >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY",
)
def _(t):
    return Q.filter_time_lookback(t.alerts, F.lit("2024-01-31 00:00:00").cast("timestamp"), 7).select("alert_id", "timestamp")
