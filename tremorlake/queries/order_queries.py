"""Queries for sorts, limits and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tremorlake.operators import aggregates as A, ordering as O
from tremorlake.queries import query
from tremorlake.queries.aggregate_queries import EVENTS
from tremorlake.queries.feature_queries import _hourly


@query(
    "rank_top_n",
    "picks",
    """ SELECT pick_id, delta_seconds, row_number() OVER (ORDER BY delta_seconds DESC, pick_id) AS rank FROM picks
    QUALIFY rank <= 50""",
    "delta_seconds",
)
def _(t):
    return O.rank_top_n(t.picks.select("pick_id", "delta_seconds"), "delta_seconds", 50, ["pick_id"])


@query(
    "top_k",
    "picks",
    f", {EVENTS} SELECT event_id, n_stations, n_picks FROM per_event ORDER BY n_stations DESC, event_id LIMIT 10",
)
def _(t):
    return O.top_k(A.event_catalog(t.picks).select("event_id", "n_stations", "n_picks"), "n_stations", 10, ["event_id"])


@query(
    "recent_alerts",
    "alerts",
    """, holed AS (SELECT alert_id, CASE WHEN alert_id % 4 <> 0 THEN timestamp END AS timestamp, risk_score FROM alerts)
    SELECT * FROM holed ORDER BY timestamp DESC NULLS LAST, alert_id LIMIT 200""",
    "risk_score",
)
def _(t):
    time = F.when(F.col("alert_id") % 4 != 0, F.col("timestamp")).alias("timestamp")
    return O.recent_alerts(t.alerts.select("alert_id", time, "risk_score"), 200, ["alert_id"])


@query(
    "page_query",
    "picks",
    f", {EVENTS} SELECT event_id, first_arrival FROM per_event ORDER BY first_arrival DESC, event_id LIMIT 100 OFFSET 100",
)
def _(t):
    return O.page_query(A.event_catalog(t.picks).select("event_id", "first_arrival"), "first_arrival", ["event_id"], 100, 100)


@query(
    "last_n_hours",
    "hourly",
    " SELECT * FROM (SELECT timestamp, numero_eventi FROM hourly ORDER BY timestamp DESC LIMIT 417) ORDER BY timestamp",
)
def _(t):
    return O.last_n_hours(_hourly(t).select("timestamp", "numero_eventi"))


@query(
    "sort_output",
    "picks",
    " SELECT event_id, station_code, pick_id, delta_seconds FROM picks ORDER BY event_id, station_code, pick_id",
    "delta_seconds",
)
def _(t):
    return O.sort_output(t.picks.select("event_id", "station_code", "pick_id", "delta_seconds"), "event_id", "station_code", "pick_id")


@query(
    "union_missing_columns",
    "picks energy",
    """ SELECT station_code, channel, delta_seconds, NULL::DOUBLE AS rms FROM picks
    UNION ALL SELECT station_code, channel, NULL, rms FROM energy""",
    "delta_seconds rms",
)
def _(t):
    return O.union_missing_columns(
        [t.picks.select("station_code", "channel", "delta_seconds"), t.energy.select("station_code", "channel", "rms")]
    )


@query("except_codes", "picks stations", " SELECT station_code FROM picks EXCEPT SELECT station_code FROM stations")
def _(t):
    return O.except_codes(t.picks.select("station_code"), t.stations.select("station_code"))


@query(
    "intersect_codes",
    "picks stations",
    " SELECT station_code FROM picks WHERE channel = 'error' INTERSECT SELECT station_code FROM stations WHERE network = 'N1'",
)
def _(t):
    loud = t.picks.filter(F.col("channel") == "error").select("station_code")
    return O.intersect_codes(loud, t.stations.filter(F.col("network") == "N1").select("station_code"))
