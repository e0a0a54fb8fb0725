"""Queries for sources and sinks: tables are written to scratch files in their format and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from tremorlake.functions import scalars as S
from tremorlake.operators import aggregates as A
from tremorlake.operators.hourly import hourly_counts_legacy
from tremorlake.operators.quality import normalize_alerts
from tremorlake.queries import query
from tremorlake.queries.aggregate_queries import EPICENTRES
from tremorlake.schemas import WAREHOUSE, table_schema
from tremorlake.session import checkpoint_folder, durable
from tremorlake.sources import files, ingest, sinks, star
from tremorlake.sources.versioned import VersionedTable, by_value


def scratch(t) -> str:
    """A new folder beside the checkpoints, which all executors share."""
    checkpoint_folder(t.spark)
    return f"{t.spark.sparkContext.getCheckpointDir()}/exports/{uuid.uuid4().hex}"


@query("scan_parquet", "", "SELECT l_orderkey, l_suppkey, l_quantity FROM lineitem", "l_quantity")
def _(t):
    return files.scan_parquet(t.spark, f"{t.folder}/lineitem.parquet", ["l_orderkey", "l_suppkey", "l_quantity"])


@query("scan_csv_checked", "picks", " SELECT pick_id, station_code, arrival_iso, delta_seconds FROM picks", "delta_seconds")
def _(t):
    path = scratch(t)
    iso = F.date_format("arrival_iso", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("arrival_iso")
    sinks.sink_csv(t.picks.select("pick_id", "station_code", iso, "delta_seconds", "channel"), path)
    types = {"pick_id": "bigint", "arrival_iso": "timestamp", "delta_seconds": "double"}
    return files.scan_csv_checked(t.spark, path, ["pick_id", "station_code", "arrival_iso", "delta_seconds"], types).drop("channel")


@query(
    "scan_code_list",
    "",
    "SELECT DISTINCT 'S' || (s_suppkey % 70) AS code FROM supplier UNION SELECT DISTINCT 'X' || s_nationkey FROM supplier WHERE s_suppkey % 5 <> 4",
)
def _(t):
    code, other = F.concat(F.lit("S"), F.col("s_suppkey") % 70), F.concat(F.lit("X"), F.col("s_nationkey"))
    line = F.when(F.col("s_suppkey") % 5 == 4, F.concat(F.lit("  "), code)).when(
        F.col("s_suppkey") % 2 == 0, F.concat(code, F.lit(" ,  "), other, F.lit(",,"))
    ).otherwise(F.concat(code, F.lit("   "), other))
    noise = F.concat(line, F.lit("\n\n# comment, not a code"))
    path = scratch(t)
    t.raw("supplier").select(noise.alias("value")).write.text(path)
    return files.scan_code_list(t.spark, path).select("code")


@query(
    "scan_event_catalog",
    "catalog stations",
    """ SELECT c.event_id::VARCHAR AS event_id, strftime(c.time, '%Y-%m-%dT%H:%M:%S') AS time, s.latitude, s.longitude,
    (c.event_id % 100) / 10e0 AS depth_km, 'ML' AS mag_type, c.magnitude, s.location AS event_location_name, 'earthquake' AS event_type
    FROM catalog c JOIN stations s USING (station_code)""",
    "latitude longitude depth_km magnitude",
)
def _(t):
    quakes = t.catalog.join(t.stations, "station_code").select(
        F.col("event_id").alias("#EventID"),
        F.date_format("time", "' 'yyyy-MM-dd'T'HH:mm:ss' '").alias("Time"),
        F.col("latitude").alias("Latitude"),
        F.concat(F.col("longitude").cast("string"), F.lit(" ")).alias("Longitude"),
        ((F.col("event_id") % 100) / 10).alias("Depth/Km"),
        F.lit("BULLETIN").alias("Author"),
        F.lit("ML").alias("MagType"),
        F.col("magnitude").alias("Magnitude"),
        F.col("location").alias("EventLocationName"),
        F.lit("earthquake").alias("EventType"),
    )
    path = scratch(t)
    quakes.write.option("sep", "|").option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return files.scan_event_catalog(t.spark, path)


@query(
    "scan_json_records",
    "alerts",
    """ SELECT strftime(timestamp, '%Y-%m-%dT%H:%M:%S') AS timestamp, station, risk_score FROM alerts WHERE alert_id % 10 <> 7""",
    "risk_score",
)
def _(t):
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp")
    line = F.to_json(F.struct(stamp, "station", "risk_score"))
    broken = F.when(F.col("alert_id") % 10 == 7, F.substring(line, 1, 25)).otherwise(line)
    path = scratch(t)
    t.alerts.select(broken.alias("value")).write.text(path)
    return files.scan_json_records(t.spark, path, lines=True).select("timestamp", "station", "risk_score")


@query(
    "scan_json_any_fields",
    "alerts",
    """ SELECT timestamp, CASE WHEN alert_id % 3 = 2 THEN 'UNKNOWN' ELSE station END AS station, risk_score,
    CASE WHEN risk_score >= 0.85 THEN 'critical' WHEN risk_score >= 0.65 THEN 'high' WHEN risk_score >= 0.40 THEN 'medium' ELSE 'low' END AS severity,
    CASE WHEN alert_id % 3 = 1 THEN alert_id / 8e0 END AS latitude FROM alerts""",
    "risk_score",
)
def _(t):
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    layouts = [
        F.struct(stamp.alias("timestamp"), "station", "risk_score"),
        F.struct(stamp.alias("created_at"), F.col("station").alias("station_code"), F.col("risk_score").cast("string").alias("probability"), (F.col("alert_id") / 8).cast("string").alias("lat")),
        F.struct(stamp.alias("alert_time"), F.col("risk_score").alias("risk"), F.struct("alert_id").alias("more")),
    ]
    line = F.when(F.col("alert_id") % 3 == 0, F.to_json(layouts[0])).when(F.col("alert_id") % 3 == 1, F.to_json(layouts[1])).otherwise(F.to_json(layouts[2]))
    path = scratch(t)
    t.alerts.select(line.alias("value")).write.text(path)
    read = normalize_alerts(files.scan_json_records(t.spark, path, lines=True))
    return read.select("timestamp", "station", "risk_score", "severity", "latitude")


@query(
    "ingest_legacy_features",
    "hourly",
    """ SELECT timestamp, numero_eventi, energia_max, energia_media, NULL::DOUBLE AS eventi_catalogo_6h FROM hourly""",
    "energia_max energia_media",
)
def _(t):
    path, warehouse = scratch(t), scratch(t)
    old = hourly_counts_legacy(t.picks).select(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("Tempo"), "numero_eventi", "energia_max", F.lit("x").alias("unknown"), "energia_media")
    sinks.sink_csv(old, path)
    for _ in range(2):  # the second load adds nothing
        ingest.ingest_legacy_features(t.spark, path, warehouse)
    return ingest.warehouse_table(t.spark, warehouse, "ml_features_timeseries").select("timestamp", "numero_eventi", "energia_max", "energia_media", "eventi_catalogo_6h")


@query(
    "versioned_upsert",
    "picks",
    """, old AS (SELECT station_code, channel, max(pick_id) AS pick_id, 'old' AS state FROM picks WHERE pick_id % 2 = 0 GROUP BY ALL),
    batch AS (SELECT station_code, channel, max(pick_id) AS pick_id, 'new' AS state FROM picks WHERE pick_id % 7 = 1 GROUP BY ALL)
    SELECT 1 AS version, * FROM old UNION ALL SELECT 2, * FROM batch
    UNION ALL SELECT 2, * FROM old WHERE (station_code, channel) NOT IN (SELECT (station_code, channel) FROM batch)""",
)
def _(t):
    schema = table_schema("station_code:str channel:str pick_id:long state:str")
    table = VersionedTable(t.spark, scratch(t), schema, ["station_code", "channel"], by_value("channel"))
    rows = t.picks.select("station_code", "channel", "pick_id")
    old = rows.filter(F.col("pick_id") % 2 == 0).groupBy("station_code", "channel").agg(F.max("pick_id").alias("pick_id"))
    table.insert_ignore(old.withColumn("state", F.lit("old")))
    table.upsert(rows.filter(F.col("pick_id") % 7 == 1).withColumn("state", F.lit("new")), ["pick_id"])
    first, second = (table.read(v).withColumn("version", F.lit(v)) for v in table.versions())
    return first.unionByName(second)


@query(
    "scan_recent_files",
    "picks",
    " SELECT pick_id, station_code, CASE WHEN pick_id % 3 <> 2 THEN delta_seconds END AS delta_seconds FROM picks",
    "delta_seconds",
)
def _(t):
    path = scratch(t)
    part = [t.picks.filter(F.col("pick_id") % 3 == i).select("pick_id", "station_code", "delta_seconds") for i in range(3)]
    even = F.col("pick_id") % 2 == 0
    sinks.sink_csv(part[0].filter(even), f"{path}/a")
    sinks.sink_csv(part[0].filter(~even).select("delta_seconds", F.lit("x").alias("note"), "station_code", "pick_id"), f"{path}/d")
    part[1].filter(even).select("pick_id", "station_code", "delta_seconds").write.parquet(f"{path}/b/deep")
    part[1].filter(~even).withColumn("depth", F.lit(1.5)).write.mode("append").parquet(f"{path}/b/deep")
    lines = part[2].select(F.to_json(F.struct("pick_id", "station_code")).alias("value"))
    _write_named_lines(t, lines, f"{path}/c")
    found = files.scan_recent_files(t.spark, path, "2020-01-01T00:00:00")
    return found.select(F.col("pick_id").cast("long"), "station_code", F.col("delta_seconds").cast("double"))


def _write_named_lines(t, lines: DataFrame, folder: str) -> None:
    """JSON lines in files that end in .jsonl (Spark's JSON writer ends them in .json)."""
    lines.write.text(folder)
    jvm = t.spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(folder)
    system = where.getFileSystem(t.spark._jsc.hadoopConfiguration())
    for status in system.listStatus(where):
        name = status.getPath().getName()
        if name.endswith(".txt"):
            system.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(f"{folder}/{name[:-4]}.jsonl"))


def _write_runs(t, root: str) -> None:
    """The picks of each run, and station tables, in the layout of a run directory."""
    iso = F.date_format("arrival_iso", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("arrival_iso")
    for run in ("run_0", "run_1"):
        mine = t.picks.filter(F.col("run_id") == run)
        raw = mine.select(
            "event_id",
            "network",
            F.col("station_code").alias("station"),
            "channel",
            "arrival_epoch",
            iso,
            F.col("arrival_epoch").alias("event_reference_epoch"),
            "delta_seconds",
        )
        sinks.sink_csv(raw, f"{root}/{run}/interim/station_deltas.csv", compress=False)
        stats = durable(A.station_stats(mine).withColumnRenamed("station_code", "station"))
        sinks.sink_csv(stats, f"{root}/{run}/processed/station_stats.csv", compress=False)
        spatial = t.stations.join(stats.select(F.col("station").alias("station_code"), "base_mean"), "station_code").select(
            F.col("station_code").alias("station"),
            "network",
            "latitude",
            "longitude",
            (F.col("longitude") * 1000).alias("x_m"),
            (F.col("latitude") * 1000).alias("y_m"),
            "base_mean",
        )
        sinks.sink_csv(spatial, f"{root}/{run}/processed/deltas_spatial.csv", compress=False)


@query(
    "scan_runs",
    "picks",
    " SELECT run_id AS run_name, event_id, station_code AS station, delta_seconds FROM picks",
    "delta_seconds",
)
def _(t):
    root = scratch(t)
    columns = ["event_id", "station", "delta_seconds"]
    for run, order in (("run_0", columns), ("run_1", ["channel", *reversed(columns)])):  # by name, whatever the order
        mine = t.picks.filter(F.col("run_id") == run).withColumnRenamed("station_code", "station")
        sinks.sink_csv(mine.select(*order), f"{root}/{run}/interim/station_deltas.csv", compress=False)
    found = files.scan_runs(t.spark, root, "interim/station_deltas.csv", ["event_id", "station"])
    return found.select("run_name", F.col("event_id").cast("long"), "station", F.col("delta_seconds").cast("double"))


@query("audit_file_hash")
def _(t):
    names = ["events", "lineitem", "orders", "no_such_table"]
    hashed = files.audit_file_hash(t.spark, [f"{t.folder}/{n}.parquet" for n in names])
    return hashed.withColumn("file_path", F.element_at(F.split("file_path", "/"), -1))


PIECE = 4096


@query(
    "audit_piece_hash",
    "picks",
    f""", texts AS (SELECT station_code, pick_id // 50000 AS block, string_agg(pick_id || ',' || event_id || ',' || channel || chr(10), '' ORDER BY pick_id) AS text
    FROM picks GROUP BY ALL),
    pieces AS (SELECT station_code, block, i, substr(text, i * {PIECE} + 1, {PIECE}) AS piece FROM texts, unnest(range(0, (length(text) + {PIECE - 1}) // {PIECE})) AS u(i)),
    digests AS (SELECT station_code, block, i, length(piece) AS length, sha256(piece) AS digest FROM pieces),
    asked AS (SELECT 'station_code=' || station_code AS name, * FROM digests UNION ALL SELECT 'all', * FROM digests)
    SELECT name, sum(length)::BIGINT AS file_size_bytes,
    CASE WHEN count(*) = 1 THEN max(digest) ELSE sha256(string_agg(digest, '' ORDER BY station_code, block, i)) END AS sha256 FROM asked GROUP BY name""",
)
def _(t):
    """The picks as text, a folder a station and a file a block of picks; hashes of each station's folder and of the whole."""
    root = f"{scratch(t)}/all"
    line = F.concat_ws(",", "pick_id", "event_id", "channel").alias("value")
    block = F.lpad(F.floor(F.col("pick_id") / 50000).cast("string"), 12, "0").alias("block")
    by = ["station_code", "block"]
    lines = t.picks.select("station_code", block, "pick_id", line).repartition(*by).sortWithinPartitions(*by, "pick_id")
    lines.drop("pick_id").write.partitionBy(*by).text(root)
    stations = [r[0] for r in t.picks.select("station_code").distinct().collect()]  # a dimension
    hashed = files.audit_file_hash(t.spark, [root, *[f"{root}/station_code={s}" for s in stations]], PIECE)
    return hashed.select(F.element_at(F.split("file_path", "/"), -1).alias("name"), "file_size_bytes", "sha256")


@query(
    "scan_waveform_chunks",
    "samples",
    """ SELECT 'ev' || (n // 128) AS event_key, 'IV' AS network, station_code, '00_HHZ' AS channel, n // 128 * 128 AS start, n % 128 AS pos, x
    FROM samples""",
    "x",
)
def _(t):
    chunk = F.floor(F.col("n") / 128)
    chunks = (
        t.samples.groupBy("station_code", chunk.alias("chunk"))
        .agg(F.sort_array(F.collect_list(F.struct("n", "x"))).alias("rows"))  # at most 128 samples
        .select(
            F.concat(F.lit("data/ev"), "chunk", F.lit("_iv_"), "station_code", F.lit("_00_hhz.mseed")).alias("file"),
            (F.col("chunk") * 128).alias("start"),
            F.lit(1.0).alias("rate"),
            F.col("rows.x").alias("samples"),
        )
    )
    path = scratch(t)
    chunks.write.parquet(path)
    read = files.scan_waveform_chunks(t.spark, path)
    return read.select("event_key", "network", "station_code", "channel", "start", F.posexplode("samples").alias("pos", "x"))


@query(
    "sink_insert_ignore",
    "picks",
    """, target AS (SELECT DISTINCT event_id, station_code FROM picks WHERE pick_id % 3 = 0)
    SELECT event_id, station_code, min(pick_id) AS pick_id FROM picks p
    WHERE NOT EXISTS (SELECT 1 FROM target x WHERE x.event_id = p.event_id AND x.station_code = p.station_code) GROUP BY ALL""",
)
def _(t):
    rows = t.picks.select("event_id", "station_code", "pick_id")
    return sinks.new_rows(rows.filter(F.col("pick_id") % 3 == 0), rows, ["event_id", "station_code"], ["pick_id"])


@query(
    "sink_upsert",
    "picks",
    """, target AS (SELECT station_code, channel, max(pick_id) AS pick_id, 'old' AS state FROM picks WHERE pick_id % 2 = 0 GROUP BY ALL),
    batch AS (SELECT station_code, channel, max(pick_id) AS pick_id, 'new' AS state FROM picks WHERE pick_id % 7 = 1 GROUP BY ALL)
    SELECT * FROM batch UNION ALL SELECT * FROM target WHERE (station_code, channel) NOT IN (SELECT (station_code, channel) FROM batch)""",
)
def _(t):
    rows = t.picks.select("station_code", "channel", "pick_id")
    old = rows.filter(F.col("pick_id") % 2 == 0).groupBy("station_code", "channel").agg(F.max("pick_id").alias("pick_id"))
    batch = rows.filter(F.col("pick_id") % 7 == 1).withColumn("state", F.lit("new"))
    return sinks.merged_rows(old.withColumn("state", F.lit("old")), batch, ["station_code", "channel"], ["pick_id"])


@query(
    "sink_schema_aligned",
    "picks",
    """ SELECT station_code, channel, arrival_iso AS hour, delta_seconds AS rms, NULL::DOUBLE AS peak FROM picks""",
    "rms",
)
def _(t):
    batch = t.picks.select(F.col("arrival_iso").alias("hour"), "station_code", "channel", F.col("delta_seconds").alias("rms"), "pick_id")
    return sinks.aligned(batch, WAREHOUSE["waveform_energy_hourly"])


@query("sink_csv", "picks", " SELECT pick_id::VARCHAR AS pick_id, station_code, channel FROM picks")
def _(t):
    path = scratch(t)
    sinks.sink_csv(t.picks.select("pick_id", "station_code", "channel"), path)
    return t.spark.read.option("header", True).csv(path)


@query("sink_preview", "picks", " SELECT pick_id, station_code FROM picks ORDER BY arrival_iso, pick_id LIMIT 1000")
def _(t):
    return sinks.preview(t.picks, ["arrival_iso", "pick_id"]).select("pick_id", "station_code")


@query("empty_result", "picks", " SELECT pick_id, station_code, delta_seconds FROM picks WHERE delta_seconds > 1e6")
def _(t):
    nothing = t.picks.filter(F.col("delta_seconds") > 1e6).select("pick_id", "station_code", "delta_seconds")
    return nothing.unionByName(sinks.empty_result(t.spark, nothing.schema))


@query(
    "sink_geojson",
    "picks stations",
    f""", {EPICENTRES} SELECT event_id, to_json({{'type': 'Feature', 'geometry': {{'type': 'Point',
    'coordinates': [round(longitude, 6), round(latitude, 6)]}}, 'properties': {{'event_id': event_id, 'n_stations': n_stations}}}})::VARCHAR
    AS feature FROM epicentres""",
)
def _(t):
    points = A.event_epicenter(t.picks, t.stations).withColumns(
        {"latitude": F.round("latitude", 6), "longitude": F.round("longitude", 6)}
    )
    return sinks.geojson_features(points, ["event_id", "n_stations"]).select("event_id", "feature")


def threshold_rows(t) -> DataFrame:
    from tremorlake.streaming.monitor import threshold_alerts

    return threshold_alerts(t.alerts.withColumn("stations", F.lit(18)), "risk_score", 0.8)


@query(
    "sink_alert_log",
    "alerts",
    """ SELECT strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp, risk_score AS risk_index, 0.8e0 AS threshold, 18 AS min_stations,
    CASE WHEN risk_score >= 0.95 THEN 'CRITICAL' ELSE 'HIGH' END AS level FROM alerts WHERE risk_score >= 0.8""",
    "risk_index threshold",
)
def _(t):
    folder = scratch(t)
    alerts = threshold_rows(t).withColumn("timestamp", S.iso_text("timestamp"))
    sinks.sink_alert_log(alerts, folder)
    sinks.sink_alert_log(alerts.limit(0), folder)  # a second append keeps the layout
    read = t.spark.read.option("header", True).csv(f"{folder}/csv")
    return read.select(
        "timestamp", F.col("risk_index").cast("double"), F.col("threshold").cast("double"), F.col("min_stations").cast("int"), "level"
    )


def _warehouse(t) -> tuple[str, DataFrame]:
    root, warehouse = scratch(t), scratch(t)
    _write_runs(t, root)
    audit = ingest.ingest_all_runs(t.spark, root, ["run_0", "run_1"], warehouse)
    return warehouse, audit


@query(
    "ingest_run",
    "picks",
    """ SELECT run_id, event_id::VARCHAR AS event_id, network, station_code, channel, arrival_iso, delta_seconds FROM picks WHERE run_id = 'run_0'""",
    "delta_seconds",
)
def _(t):
    root, warehouse = scratch(t), scratch(t)
    _write_runs(t, root)
    for _ in range(2):  # the second load adds nothing
        ingest.ingest_run(t.spark, "run_0", f"{root}/run_0", warehouse)
    return ingest.warehouse_table(t.spark, warehouse, "raw_deltas").drop("arrival_epoch", "event_reference_epoch")


@query(
    "ingest_all_runs",
    "picks stations",
    """ SELECT 'raw_deltas' AS table_name, run_id, count(*) AS n_rows, count(DISTINCT station_code) AS n_stations FROM picks GROUP BY run_id
    UNION ALL SELECT 'station_stats', run_id, count(DISTINCT station_code), count(DISTINCT station_code) FROM picks GROUP BY run_id
    UNION ALL SELECT 'deltas_spatial', run_id, count(DISTINCT station_code), count(DISTINCT station_code) FROM picks
      WHERE station_code IN (SELECT station_code FROM stations) GROUP BY run_id""",
)
def _(t):
    warehouse, _audit = _warehouse(t)
    made = [
        ingest.warehouse_table(t.spark, warehouse, name)
        .groupBy("run_id")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("station_code").alias("n_stations"))
        .withColumn("table_name", F.lit(name))
        for name in ("raw_deltas", "station_stats", "deltas_spatial")
    ]
    return made[0].unionByName(made[1]).unionByName(made[2])


@query(
    "ingest_audit",
    "picks stations",
    """, names AS (SELECT * FROM (VALUES ('raw_deltas'), ('station_stats'), ('deltas_spatial'), ('catalog_events'), ('waveform_energy_hourly')) v(table_name)),
    runs AS (SELECT DISTINCT run_id FROM picks),
    found AS (SELECT run_id, 'raw_deltas' AS table_name, count(*) AS n FROM picks GROUP BY 1
      UNION ALL SELECT run_id, 'station_stats', count(DISTINCT station_code) FROM picks GROUP BY 1
      UNION ALL SELECT run_id, 'deltas_spatial', count(DISTINCT station_code) FROM picks
        WHERE station_code IN (SELECT station_code FROM stations) GROUP BY 1)
    SELECT run_id, table_name, n AS rows_read, CASE WHEN n IS NULL THEN 'skipped' ELSE 'success' END AS status
    FROM runs CROSS JOIN names LEFT JOIN found USING (run_id, table_name)""",
)
def _(t):
    return _warehouse(t)[1].select("run_id", "table_name", "rows_read", "status")


@query(
    "load_star_schema",
    "picks stations",
    f""", {EPICENTRES}, st AS (SELECT *, row_number() OVER (ORDER BY station_code) AS station_id FROM stations),
    ev AS (SELECT *, row_number() OVER (ORDER BY event_id) AS event_key FROM epicentres)
    SELECT station_id, event_key, 'P' AS phase, p.arrival_iso, p.delta_seconds, CASE WHEN st.station_code <> 'ST0' THEN st.elevation ELSE 0e0 END AS elevation,
      CASE WHEN st.network = 'N2' THEN 'IV' ELSE st.network END AS network, ev.n_stations
    FROM picks p JOIN st USING (station_code) JOIN ev USING (event_id)""",
    "delta_seconds elevation",
)
def _(t):
    stations = t.stations.withColumns(
        {
            "network": F.when(F.col("network") != "N2", F.col("network")),
            "elevation": F.when(F.col("station_code") != "ST0", F.col("elevation")),
        }
    )
    made = star.load_star_schema(stations, t.picks)
    return (
        made["event_deltas"]
        .join(made["stations"].select("station_id", "elevation", "network"), "station_id")
        .join(made["seismic_events"].select("event_key", "n_stations"), "event_key")
    )


@query(
    "download_plan",
    "stations",
    """, plan AS (SELECT network, station_code, channel, unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-02 23:59:59', INTERVAL 6 HOUR)) AS block_start
      FROM stations, (VALUES ('HHZ'), ('HHN')) c(channel)), keyed AS (SELECT *, least(block_start + INTERVAL 6 HOUR, TIMESTAMP '2024-01-02 20:00:00') AS block_end,
      strftime(block_start, '%Y%m%dT%H%M%S') || '_' || network || '_' || station_code || '_' || channel AS file_key FROM plan
      WHERE block_start < TIMESTAMP '2024-01-02 20:00:00')
    SELECT * FROM keyed WHERE NOT (station_code = 'ST3' AND channel = 'HHZ')""",
)
def _(t):
    def plan(done=None):
        return star.download_plan(t.stations, ["HHZ", "HHN"], "2024-01-01", "2024-01-02 20:00:00", 0.25, done)

    done = plan().filter((F.col("station_code") == "ST3") & (F.col("channel") == "HHZ"))
    return plan(done)
