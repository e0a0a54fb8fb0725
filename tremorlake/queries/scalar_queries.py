"""Queries for scalar functions on codes, times, alerts, amplitudes and coordinates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tremorlake.functions import geo as G, scalars as S
from tremorlake.operators.joins import join_station_dim
from tremorlake.queries import query
from tremorlake.queries.aggregate_queries import BEARING, HAVERSINE, PLACED
from tremorlake.queries.feature_queries import GRID
from tremorlake.queries.quality_queries import utm_sql


@query(
    "split_station_id",
    "picks",
    """ SELECT pick_id, upper(network) AS network, upper(station_code) AS station_code, upper(channel) AS channel FROM picks""",
)
def _(t):
    with_place = F.concat_ws(".", F.lower("network"), "station_code", F.lit("00"), "channel")
    without = F.concat_ws(".", "network", F.lower("station_code"), "channel")
    ids = t.picks.select("pick_id", F.when(F.col("pick_id") % 2 == 0, with_place).otherwise(without).alias("station_id"))
    return ids.select("pick_id", *[c.alias(n) for n, c in S.station_id_parts("station_id").items()])


@query("normalize_code", "picks", " SELECT pick_id, station_code FROM picks")
def _(t):
    messy = F.concat(F.lit("  "), F.lower("station_code"), F.lit(" "))
    return t.picks.select("pick_id", S.normalize_code(messy).alias("station_code"))


@query(
    "sanitize_name",
    "stations",
    " SELECT station_code, regexp_replace(location || ' (' || network || '/' || station_code || ')', '[^A-Za-z0-9_.-]+', '_', 'g') AS name FROM stations",
)
def _(t):
    text = F.concat(F.col("location"), F.lit(" ("), F.col("network"), F.lit("/"), F.col("station_code"), F.lit(")"))
    return t.stations.select("station_code", S.sanitize_name(text).alias("name"))


@query(
    "file_key",
    "picks",
    " SELECT pick_id, strftime(arrival_iso, '%Y%m%dT%H%M%S') || '_' || network || '_' || station_code || '_' || channel AS file_key FROM picks",
)
def _(t):
    return t.picks.select("pick_id", S.file_key("arrival_iso", "network", "station_code", "channel").alias("file_key"))


@query(
    "parse_mixed_time",
    "picks",
    """ SELECT pick_id, CASE WHEN pick_id % 11 = 0 THEN NULL WHEN pick_id % 2 = 0 THEN arrival_iso ELSE date_trunc('second', arrival_iso) END AS parsed
    FROM picks""",
)
def _(t):
    iso = F.date_format("arrival_iso", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    seconds = F.floor("arrival_epoch").cast("string")
    text = F.when(F.col("pick_id") % 11 == 0, "soon").when(F.col("pick_id") % 2 == 0, iso).otherwise(seconds)
    return t.picks.select("pick_id", S.parse_mixed_time(text).alias("parsed"))


@query(
    "epoch_iso_convert",
    "picks",
    """ SELECT pick_id, epoch_us(arrival_iso) / 1e6 AS epoch, arrival_iso AS again,
    strftime(arrival_iso, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso FROM picks""",
    "epoch:6",
)
def _(t):
    epoch = S.epoch_of("arrival_iso")
    return t.picks.select("pick_id", epoch.alias("epoch"), S.time_of(epoch).alias("again"), S.iso_text("arrival_iso").alias("iso"))


@query(
    "calendar_features",
    "picks",
    f""", {GRID} SELECT timestamp, hour(timestamp) AS ora_del_giorno, dayofweek(timestamp) AS giorno_della_settimana,
    CASE WHEN hour(timestamp) >= 22 OR hour(timestamp) <= 6 THEN 1 ELSE 0 END AS is_notte,
    CASE WHEN dayofweek(timestamp) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
    isodow(timestamp) - 1 AS frame_weekday, CASE WHEN hour(timestamp) IN (22, 23, 0, 1, 2, 3, 4, 5) THEN 1 ELSE 0 END AS frame_night,
    CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END AS frame_weekend FROM grid""",
)
def _(t):
    from tremorlake.operators.hourly import hour_grid

    frame = S.calendar_features("timestamp", "frame")
    return hour_grid(t.picks, "arrival_iso").select(
        "timestamp",
        *[c.alias(n) for n, c in S.calendar_features("timestamp").items()],
        frame["giorno_della_settimana"].alias("frame_weekday"),
        frame["is_notte"].alias("frame_night"),
        frame["is_weekend"].alias("frame_weekend"),
    )


def _placed(t):
    return join_station_dim(t.picks, t.stations.select("station_code", "latitude", "longitude")).filter(F.col("latitude").isNotNull())


_FROM_CENTRE = {"lat1": "40.8062e0", "lon1": "14.1410e0", "lat2": "latitude", "lon2": "longitude"}


@query(
    "haversine_km",
    "picks stations",
    f", {PLACED} SELECT pick_id, {HAVERSINE.format(**_FROM_CENTRE)} AS km FROM placed",
    "km:8",
)
def _(t):
    return _placed(t).select("pick_id", G.haversine_km(40.8062, 14.1410, "latitude", "longitude").alias("km"))


@query(
    "bearing_deg",
    "picks stations",
    f", {PLACED} SELECT pick_id, {BEARING.format(**_FROM_CENTRE)} AS bearing FROM placed",
    "bearing:7",
)
def _(t):
    return _placed(t).select("pick_id", G.bearing_deg(40.8062, 14.1410, "latitude", "longitude").alias("bearing"))


_X, _Y = utm_sql("lat", "lon")


@query(
    "project_utm",
    "picks",
    f""", points AS (SELECT pick_id, 35 + delta_seconds / 5 AS lat, 12 + (pick_id % 600) / 100e0 AS lon FROM picks)
    SELECT pick_id, {_X} AS easting, {_Y} AS northing, lat AS latitude, lon AS longitude FROM points""",
    "easting:4 northing:4 latitude:8 longitude:8",
)
def _(t):
    points = t.picks.select(
        "pick_id", (F.lit(35.0) + F.col("delta_seconds") / 5).alias("lat"), (F.lit(12.0) + (F.col("pick_id") % 600) / 100.0).alias("lon")
    )
    x, y = G.project_utm("lat", "lon")
    there = points.select("pick_id", x.alias("easting"), y.alias("northing"))
    lat, lon = G.unproject_utm("easting", "northing")
    return there.select("*", lat.alias("latitude"), lon.alias("longitude"))


@query(
    "alert_level",
    "alerts",
    """ SELECT alert_id, CASE WHEN risk_score >= 0.95 THEN 'CRITICAL' WHEN risk_score >= 0.80 THEN 'HIGH'
    WHEN risk_score >= 0.60 THEN 'MEDIUM' ELSE 'LOW' END AS level FROM alerts""",
)
def _(t):
    return t.alerts.select("alert_id", S.alert_level("risk_score").alias("level"))


@query(
    "severity_class",
    "alerts",
    """ SELECT alert_id, CASE WHEN risk_score >= 0.85 THEN 'critical' WHEN risk_score >= 0.65 THEN 'high'
    WHEN risk_score >= 0.40 THEN 'medium' ELSE 'low' END AS severity FROM alerts""",
)
def _(t):
    return t.alerts.select("alert_id", S.severity_class("risk_score").alias("severity"))


@query(
    "alert_message",
    "picks",
    """ SELECT pick_id, printf('Alert: %s - Risk: %.2f - Stations: %d', upper(channel), delta_seconds / 49, pick_id % 27) AS message FROM picks""",
)
def _(t):
    risk, stations = F.col("delta_seconds") / 49, F.col("pick_id") % 27
    return t.picks.select("pick_id", S.alert_message(F.upper("channel"), risk, stations).alias("message"))


@query("log_amplitude", "picks", " SELECT pick_id, ln(1 + abs(5 - delta_seconds)) AS log_amplitude FROM picks", "log_amplitude")
def _(t):
    return t.picks.select("pick_id", S.log_amplitude(5 - F.col("delta_seconds")).alias("log_amplitude"))


@query(
    "freq_band",
    "picks",
    """, box AS (SELECT min(delta_seconds) AS lo, max(delta_seconds) AS hi FROM picks)
    SELECT pick_id, CASE greatest(1, least(5, ceil((delta_seconds - lo) / ((hi - lo) / 5)))) WHEN 1 THEN 'very_low' WHEN 2 THEN 'low'
    WHEN 3 THEN 'medium' WHEN 4 THEN 'high' ELSE 'very_high' END AS band FROM picks, box""",
)
def _(t):
    low, high = (t.picks.agg(f("delta_seconds")).scalar() for f in (F.min, F.max))
    return t.picks.select("pick_id", S.freq_band("delta_seconds", low, high).alias("band"))


@query(
    "waveform_derived",
    "energy",
    """ SELECT station_code, channel, hour AS starttime, peak - rms AS amplitude_range, rms / (peak - rms + 1e-10) AS snr,
    hour(hour) AS hour, minute(hour) AS minute FROM energy WHERE peak > rms + 0.001""",
    "amplitude_range:8 snr:5",
)
def _(t):
    wave = t.energy.filter(F.col("peak") > F.col("rms") + 0.001).select(
        "station_code", "channel", F.col("hour").alias("starttime"), F.col("peak").alias("max"), F.col("rms").alias("min"), F.col("rms").alias("std")
    )
    return S.waveform_derived(wave).drop("max", "min", "std")


@query(
    "json_extract",
    "",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CASE WHEN event_id % 3 = 0 THEN 'ERROR' END AS type, ts AS timestamp
    FROM events""",
)
def _(t):
    kind = F.when(F.col("event_id") % 3 == 0, "ERROR")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    logged = t.events.select("event_id", "props", F.to_json(F.struct(kind.alias("type"), stamp.alias("timestamp"))).alias("line"))
    return logged.select(
        "event_id",
        F.from_json("props", "k BIGINT")["k"].alias("k"),
        *[c.alias(n) for n, c in S.alert_from_json("line").items()],
    )


@query(
    "json_build",
    "alerts",
    """ SELECT alert_id, to_json({'level': CASE WHEN risk_score >= 0.8 THEN 'HIGH' ELSE 'LOW' END, 'risk_index': round(risk_score * 100 + 1, 2),
    'additional_info': {'station': station, 'type': alert_type}})::VARCHAR AS line FROM alerts""",
)
def _(t):
    level = F.when(F.col("risk_score") >= 0.8, "HIGH").otherwise("LOW").alias("level")
    info = F.struct(F.col("station"), F.col("alert_type").alias("type")).alias("additional_info")
    return t.alerts.select("alert_id", S.alert_json(level, F.round(F.col("risk_score") * 100 + 1, 2).alias("risk_index"), info).alias("line"))
