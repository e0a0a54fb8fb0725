"""Queries that run as streams over the event table, plus their batch companions.

A stream emits the windows its watermark has closed, so the oracle asks for those: 10 minutes before
the last event, in whole milliseconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tremorlake.operators.detection import coincidence_events
from tremorlake.queries import query
from tremorlake.queries.source_queries import scratch, threshold_rows
from tremorlake.schemas import table_schema
from tremorlake.sources.versioned import VersionedTable, by_day
from tremorlake.streaming import monitor as M

MARK = "(SELECT date_trunc('milliseconds', max(arrival_iso)) - INTERVAL 10 MINUTE FROM picks)"
SLIDING = """starts AS (SELECT *, to_timestamp(floor(epoch_us(arrival_iso) / 600e6) * 600)::TIMESTAMP AS s0 FROM picks),
  slid AS (SELECT *, s0 AS window_start, s0 + INTERVAL 15 MINUTE AS window_end FROM starts
    UNION ALL SELECT *, s0 - INTERVAL 10 MINUTE, s0 + INTERVAL 5 MINUTE FROM starts WHERE arrival_iso < s0 + INTERVAL 5 MINUTE),
  traces AS (SELECT window_start, window_end, station_code, channel, avg(delta_seconds) AS mean, stddev_pop(delta_seconds) AS std,
    min(delta_seconds) AS min, max(delta_seconds) AS max, count(*) AS npts FROM slid GROUP BY ALL),
  risks AS (SELECT window_start, window_end, 0.6e0 * avg(std) / 10 + 0.4e0 * avg(max - min) / 10 AS risk_score,
    count(DISTINCT station_code) AS stations_count, count(*) AS records_count FROM traces GROUP BY ALL)"""
MESSAGE = """concat_ws('; ', CASE WHEN stations_count < 3 THEN 'Stazioni insufficienti: ' || stations_count || '/3' END,
  CASE WHEN risk_score > 0.2e0 THEN printf('Soglia rischio superata: %.4f/0.2', risk_score) END)"""


def stream_picks(t) -> DataFrame:
    """The picks as a stream of the event file, event time in UTC with its watermark."""
    events = M.read_files(t.spark, t.folder, t.raw("events").schema, "events.parquet")
    timed = M.watermarked(events.withColumnRenamed("ts", "arrival_iso"), "arrival_iso")
    return timed.select(
        F.col("event_id").alias("pick_id"),
        F.concat(F.lit("N"), (F.col("user_id") % 3).cast("string")).alias("network"),
        F.concat(F.lit("ST"), (F.col("user_id") % 26).cast("string")).alias("station_code"),
        F.col("event_type").alias("channel"),
        "arrival_iso",
        (F.col("value") / 10.0).alias("delta_seconds"),
    )


def finished(t, stream: DataFrame) -> DataFrame:
    """Run the stream over what is there and read its results."""
    path = scratch(t)
    M.write_available(stream, path, f"{path}-checkpoint")
    return t.spark.read.schema(stream.schema).parquet(path)


@query(
    "stream_station_stats",
    "picks",
    f", {SLIDING} SELECT * FROM traces WHERE window_end <= {MARK}",
    "mean std min max",
)
def _(t):
    return finished(t, M.stream_station_stats(stream_picks(t), "arrival_iso", "delta_seconds"))


@query("stream_risk_score", "picks", f", {SLIDING} SELECT * FROM risks WHERE window_end <= {MARK}", "risk_score")
def _(t):
    return finished(t, M.stream_risk_score(stream_picks(t), "arrival_iso", "delta_seconds", divisor=10.0))


@query(
    "stream_threshold_alerts",
    "picks",
    f""", {SLIDING} SELECT *, {MESSAGE} AS message FROM risks WHERE window_end <= {MARK} AND (stations_count < 3 OR risk_score > 0.2e0)""",
    "risk_score",
)
def _(t):
    risks = M.stream_risk_score(stream_picks(t), "arrival_iso", "delta_seconds", divisor=10.0)
    return finished(t, M.stream_threshold_alerts(risks, least=3, limit=0.2))


@query(
    "monitor_summary",
    "picks",
    f""", {SLIDING} SELECT window_end AS timestamp, risk_score, (stations_count < 3 OR risk_score > 0.2e0)::INTEGER AS alert_required,
    CASE WHEN stations_count < 3 OR risk_score > 0.2e0 THEN {MESSAGE} ELSE 'Tutto nella norma' END AS alert_message,
    stations_count, records_count FROM risks WHERE window_end <= {MARK}""",
    "risk_score",
)
def _(t):
    risks = M.stream_risk_score(stream_picks(t), "arrival_iso", "delta_seconds", divisor=10.0)
    return finished(t, M.monitor_summary(risks, least=3, limit=0.2))


@query(
    "monitor_summary_batch",
    "picks",
    f", {SLIDING} SELECT window_start, window_end, risk_score, stations_count, records_count FROM risks",
    "risk_score",
)
def _(t):
    stats = M.stream_station_stats(t.picks, "arrival_iso", "delta_seconds")
    return M.risk_of_windows(stats, divisor=10.0)


@query(
    "threshold_alerts",
    "alerts",
    """ SELECT timestamp, risk_score AS risk_index, 0.8e0 AS threshold, 18 AS min_stations,
    CASE WHEN risk_score >= 0.95 THEN 'CRITICAL' ELSE 'HIGH' END AS level,
    printf('Alert: %s - Risk: %.2f - Stations: %d', CASE WHEN risk_score >= 0.95 THEN 'CRITICAL' ELSE 'HIGH' END, risk_score, 18) AS message,
    strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS trigger_timestamp FROM alerts WHERE risk_score >= 0.8""",
    "risk_index threshold",
)
def _(t):
    return threshold_rows(t).select("*", F.col("additional_info")["trigger_timestamp"].alias("trigger_timestamp")).drop("additional_info")


COOLDOWN = """loud AS (SELECT station AS area, alert_id, timestamp, epoch_us(timestamp) AS us FROM alerts WHERE risk_score >= 0.6),
  hops AS (SELECT area, alert_id, us, min(us) OVER (PARTITION BY area ORDER BY us RANGE BETWEEN 21600000000 FOLLOWING AND UNBOUNDED FOLLOWING)
    AS next_us FROM loud),
  chain(area, alert_id, us, next_us) AS (SELECT area, alert_id, us, next_us FROM hops h WHERE us = (SELECT min(us) FROM hops f WHERE f.area = h.area)
    UNION ALL SELECT h.area, h.alert_id, h.us, h.next_us FROM chain c JOIN hops h ON h.area = c.area AND h.us = c.next_us)"""


@query("alert_cooldown", "alerts", f", {COOLDOWN} SELECT area, alert_id, make_timestamp(us) AS timestamp FROM chain")
def _(t):
    return M.alert_cooldown(t.alerts.filter(F.col("risk_score") >= 0.6), "station", "timestamp", "alert_id", 360)


@query(
    "stream_alert_cooldown",
    "alerts",
    f""", {COOLDOWN} SELECT area, alert_id, make_timestamp(us) AS timestamp FROM chain
    WHERE make_timestamp(us) < (SELECT date_trunc('milliseconds', max(timestamp)) - INTERVAL 10 MINUTE FROM alerts WHERE risk_score >= 0.6)""",
)
def _(t):
    risk = F.least(F.col("delta_seconds") / 10, F.lit(1.0))
    loud = stream_picks(t).filter(risk >= 0.6)
    sent = M.stream_alert_cooldown(loud, "station_code", "arrival_iso", "pick_id", 360)
    return finished(t, sent).drop("is_error")


@query(
    "stream_hourly_counts",
    "picks",
    f""" SELECT date_trunc('hour', arrival_iso) AS hour, count(*) AS numero_eventi, count(DISTINCT station_code) AS stazioni_attive,
    max(delta_seconds) AS energia_max, avg(delta_seconds) AS energia_media, stddev_pop(delta_seconds) AS energia_std FROM picks
    GROUP BY 1 HAVING date_trunc('hour', min(arrival_iso)) + INTERVAL 1 HOUR <= {MARK}""",
    "energia_max energia_media energia_std",
)
def _(t):
    return finished(t, M.stream_hourly_counts(stream_picks(t), "arrival_iso", "delta_seconds"))


@query("stream_ingest_idempotent", "picks", " SELECT pick_id, network, station_code, channel, arrival_iso, delta_seconds FROM picks", "delta_seconds")
def _(t):
    schema = table_schema("pick_id:long network:str station_code:str channel:str arrival_iso:ts delta_seconds:dbl")
    path = scratch(t)
    for attempt in (1, 2):  # a second stream over the same files adds nothing
        M.start_ingest(stream_picks(t), path, schema, ["pick_id"], f"{path}-checkpoint-{attempt}").awaitTermination()
    return t.spark.read.schema(schema).parquet(path)


@query("stream_ingest_versioned", "picks", " SELECT pick_id, network, station_code, channel, arrival_iso, delta_seconds FROM picks", "delta_seconds")
def _(t):
    schema, key, path = table_schema("pick_id:long network:str station_code:str channel:str arrival_iso:ts delta_seconds:dbl"), ["pick_id", "arrival_iso"], scratch(t)
    for attempt in (1, 2):  # a second stream over the same files adds nothing
        M.start_ingest(stream_picks(t), path, schema, key, f"{path}-checkpoint-{attempt}", by=by_day("arrival_iso")).awaitTermination()
    table = VersionedTable(t.spark, path, schema, key, by_day("arrival_iso"))
    return table.read()


@query(
    "stream_coincidence",
    "picks",
    f""", timed AS (SELECT *, epoch_us(arrival_iso) AS us FROM picks),
    hops AS (SELECT network, us, min(us) OVER (PARTITION BY network ORDER BY us RANGE BETWEEN 1200000001 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_us
      FROM (SELECT DISTINCT network, us FROM timed)),
    chain(network, us, next_us) AS (SELECT network, us, next_us FROM hops h WHERE us = (SELECT min(us) FROM hops f WHERE f.network = h.network)
      UNION ALL SELECT h.network, h.us, h.next_us FROM chain c JOIN hops h ON h.network = c.network AND h.us = c.next_us),
    placed AS (SELECT t.*, c.us AS anchor_us, row_number() OVER (PARTITION BY t.network, c.us, station_code ORDER BY t.us, pick_id) AS k
      FROM timed t ASOF JOIN chain c ON t.network = c.network AND t.us >= c.us),
    members AS (SELECT *, count(*) OVER (PARTITION BY network, anchor_us) AS n_stations FROM placed WHERE k = 1)
    SELECT network, make_timestamp(anchor_us) AS anchor, station_code, pick_id FROM members
    WHERE n_stations >= 3 AND make_timestamp(anchor_us) + INTERVAL 20 MINUTE < {MARK}""",
)
def _(t):
    return finished(t, M.stream_coincidence(stream_picks(t), "arrival_iso", 1200.0, 3))


@query(
    "coincidence_by_network",
    "picks",
    """, timed AS (SELECT *, epoch_us(arrival_iso) AS us FROM picks),
    hops AS (SELECT network, us, min(us) OVER (PARTITION BY network ORDER BY us RANGE BETWEEN 1200000001 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_us
      FROM (SELECT DISTINCT network, us FROM timed)),
    chain(network, us, next_us) AS (SELECT network, us, next_us FROM hops h WHERE us = (SELECT min(us) FROM hops f WHERE f.network = h.network)
      UNION ALL SELECT h.network, h.us, h.next_us FROM chain c JOIN hops h ON h.network = c.network AND h.us = c.next_us),
    placed AS (SELECT t.*, c.us AS anchor_us, row_number() OVER (PARTITION BY t.network, c.us, station_code ORDER BY t.us, channel) AS k
      FROM timed t ASOF JOIN chain c ON t.network = c.network AND t.us >= c.us),
    members AS (SELECT *, count(*) OVER (PARTITION BY network, anchor_us) AS n_stations FROM placed WHERE k = 1)
    SELECT network, station_code, pick_id, n_stations FROM members WHERE n_stations >= 3""",
)
def _(t):
    return coincidence_events(t.picks, 1200.0, 3, by=["network"]).select("network", "station_code", "pick_id", "n_stations")


@query(
    "alert_timeline",
    "alerts",
    """, loud AS (SELECT * FROM alerts WHERE risk_score >= 0.9)
    SELECT h.hour, count(l.alert_id) AS n_alerts FROM (SELECT unnest(generate_series(date_trunc('hour', min(timestamp)),
      date_trunc('hour', max(timestamp)), INTERVAL 1 HOUR)) AS hour FROM loud) h LEFT JOIN loud l ON date_trunc('hour', l.timestamp) = h.hour
    GROUP BY h.hour""",
)
def _(t):
    return M.alert_timeline(t.alerts.filter(F.col("risk_score") >= 0.9))
