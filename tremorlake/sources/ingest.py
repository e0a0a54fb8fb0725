"""Load runs into the warehouse: checked, re-run safe, with an audit row per run and table."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from tremorlake.operators.ordering import union_missing_columns
from tremorlake.operators.quality import SPATIAL_ALIASES, CheckFailed, alias_columns, coerce_types, first_per_key
from tremorlake.schemas import KEYS, WAREHOUSE, table_schema
from tremorlake.functions.scalars import parse_mixed_time
from tremorlake.session import durable
from tremorlake.sources.files import NO_FILE, audit_file_hash, csv_by_header, csv_headers, path_exists, require_columns, run_of_path
from tremorlake.sources.versioned import VersionedTable, by_month, by_value

# Where a run keeps its files, first choice first, and what each file must have.
RUN_FILES = {
    "raw_deltas": ["interim/station_deltas_from_mseed.csv", "interim/station_deltas.csv"],
    "station_stats": ["processed/station_stats.csv"],
    "deltas_spatial": ["processed/deltas_spatial.csv"],
    "catalog_events": ["interim/catalog_events.csv", "catalog_events.csv"],
    "waveform_energy_hourly": ["interim/station_energy_hourly.csv"],
}
REQUIRED = {
    "raw_deltas": "event_id network station channel arrival_epoch arrival_iso event_reference_epoch delta_seconds".split(),
    "station_stats": ["station"],
    "deltas_spatial": ["station", "base_mean"],
    "catalog_events": "event_id time latitude longitude magnitude".split(),
    "waveform_energy_hourly": "station window_iso rms peak".split(),
}
NOT_NULL = {"catalog_events": ["time", "magnitude"], "waveform_energy_hourly": ["hour", "rms"]}
UPSERTED = {"catalog_events", "waveform_energy_hourly", "stations", "runs"}
PARTITIONED = {  # the others by a hash of their key
    "raw_deltas": by_value("run_id"),
    "station_stats": by_value("run_id"),
    "deltas_spatial": by_value("run_id"),
    "anomalies": by_value("run_id"),
    "waveform_energy_hourly": by_month("hour"),
    "ml_features_timeseries": by_month("timestamp"),
}
RENAMED = {"station": "station_code", "window_iso": "hour"}
PIPELINE_VERSION = "1.0.0"
DELTA_TYPE = "base_mean"
LEGACY_TIME = "Tempo"
AUDIT = table_schema(
    "run_id:str table_name:str rows_read:long status:str error_message:str file_path:str file_size_bytes:long sha256:str "
    "ingest_started:ts ingest_finished:ts"
)


def run_files(spark: SparkSession, runs: Mapping[str, str]) -> dict[str, dict[str, str]]:
    """The file of each table and run that has one, first choice first: {table: {run: path}}.

    One listing per parent directory and kind of file, however many runs there are.
    """
    by_folder = {folder.rstrip("/"): run for run, folder in runs.items()}
    found: dict[str, dict[str, str]] = {table: {} for table in RUN_FILES}
    for parent in sorted({folder.rpartition("/")[0] for folder in by_folder}):
        for table, choices in RUN_FILES.items():
            for inside in choices:
                for name in _with_file(spark, parent, inside):
                    folder = f"{parent}/{name}"
                    if folder in by_folder:
                        found[table].setdefault(by_folder[folder], f"{folder}/{inside}")
    return found


def _with_file(spark: SparkSession, parent: str, inside: str) -> list[str]:
    """Names of the directories in ``parent`` that have the file ``inside``."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{parent}/*/{inside}")
    depth = inside.count("/") + 2
    listed = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return [status.getPath().toString().split("/")[-depth] for status in listed or []]


def table_rows(raw: DataFrame, table: str, reference_date: str) -> DataFrame:
    """Rows of a run file in the table's names and types; bad values are NULL, keyless rows fall out."""
    require_columns(raw, REQUIRED[table], table)
    df = raw.withColumnsRenamed({old: new for old, new in RENAMED.items() if old in raw.columns})
    if table == "deltas_spatial":
        df = alias_columns(df, SPATIAL_ALIASES).withColumn("delta_type", F.lit(DELTA_TYPE)).withColumnRenamed("base_mean", "delta_value")
    if table in ("deltas_spatial", "station_stats"):
        df = df.withColumn("reference_date", F.lit(reference_date))
    types = {f.name: f.dataType.simpleString() for f in WAREHOUSE[table] if f.name in df.columns and f.name != "run_id"}
    return coerce_types(df, types, NOT_NULL.get(table, []))


def station_rows(raw: DataFrame) -> DataFrame:
    """The station dimension that a spatial file carries."""
    df = alias_columns(raw, SPATIAL_ALIASES)
    kept = [f for f in WAREHOUSE["stations"] if f.name in df.columns]
    return coerce_types(df.select(*[f.name for f in kept], "run_id"), {f.name: f.dataType.simpleString() for f in kept})


def _by_header(spark: SparkSession, files: Mapping[str, str]) -> list[tuple[tuple, dict[str, str]]]:
    """Group run files by their header, so that each layout is read by one scan over all its files."""
    groups: dict[tuple, dict[str, str]] = {}
    for (run, path), header in zip(files.items(), csv_headers(spark, list(files.values()))):
        groups.setdefault(header, {})[run] = path
    return sorted(groups.items())


def warehouse_store(spark: SparkSession, warehouse: str, table: str) -> VersionedTable:
    return VersionedTable(spark, f"{warehouse}/{table}", WAREHOUSE[table], KEYS[table], PARTITIONED.get(table))


def _write(spark: SparkSession, table: str, rows: DataFrame, warehouse: str) -> None:
    store, key = warehouse_store(spark, warehouse, table), KEYS[table]
    if table not in UPSERTED:
        store.insert_ignore(rows)
        return
    rest = [c for c in store.schema.names if c in rows.columns and c not in key]
    store.upsert(first_per_key(rows, key, ["run_id", *rest], last=True))  # the later run wins


def ingest_runs(
    spark: SparkSession,
    runs: Mapping[str, str],
    warehouse: str,
    source_type: str = "mseed",
    notes: str | None = None,
    config_path: str | None = None,
    now: datetime | None = None,
    stop_at_first: bool = False,
) -> DataFrame:
    """Load all tables of the runs (run id -> directory); the audit rows are appended and returned.

    One plan per table covers all runs. A missing file is a skip, a file that breaks its contract is
    a failure of that run and table alone; ``stop_at_first`` turns it into an error.
    """
    now = now or datetime.now(timezone.utc).replace(tzinfo=None)
    day = now.strftime("%Y-%m-%d 00:00:00")
    names = {run: folder.rstrip("/").split("/")[-1] for run, folder in runs.items()}
    twice = [name for name, n in Counter(names.values()).items() if n > 1]
    if twice:
        raise ValueError(f"several runs are in directories named {', '.join(sorted(twice))}")
    # one row a run: unhinted, the join would bring all rows of a run together in one task
    run_ids = F.broadcast(spark.createDataFrame([(name, run) for run, name in names.items()], "run_name STRING, run_id STRING"))
    listed = run_files(spark, runs)

    def load(table: str) -> tuple[str, list[tuple], dict[str, str]]:
        files = listed[table]
        audit = [(run, table, None, "skipped", "file not found", None) for run in runs if run not in files]
        parts, station_parts, good = [], [], {}
        for _, members in _by_header(spark, files):
            raw = spark.read.option("header", True).csv(list(members.values()))
            inside = [i for i in RUN_FILES[table] if any(path.endswith(f"/{i}") for path in members.values())]
            named = F.coalesce(*[run_of_path(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), i) for i in inside])
            raw = raw.withColumn("run_name", named).join(run_ids, "run_name").drop("run_name")
            try:
                rows = table_rows(raw, table, day)
            except CheckFailed as error:
                if stop_at_first:
                    raise
                audit += [(run, table, None, "failed", str(error), path) for run, path in members.items()]
                continue
            parts.append(rows)
            good.update(members)
            if table == "deltas_spatial":
                station_parts.append(station_rows(raw))
        if parts:
            rows = durable(union_missing_columns(parts))
            _write(spark, table, rows, warehouse)
            if station_parts:
                _write(spark, "stations", union_missing_columns(station_parts), warehouse)
            counts = {r["run_id"]: r["n"] for r in rows.groupBy("run_id").agg(F.count(F.lit(1)).alias("n")).collect()}
            audit += [(run, table, counts.get(run, 0), "success", None, path) for run, path in good.items()]
        return table, audit, good

    # the tables do not depend on each other: their Spark jobs run side by side
    with ThreadPoolExecutor(len(RUN_FILES)) as pool:
        loaded = list(pool.map(inheritable_thread_target(spark)(load), RUN_FILES))
    audit = [row for _, rows, _ in loaded for row in rows]
    loaded_raw = next(good for table, _, good in loaded if table == "raw_deltas")
    asked = [a[5] for a in audit if a[5]] + ([config_path] if config_path else [])
    hashes = {r["file_path"]: (r["file_size_bytes"], r["sha256"]) for r in audit_file_hash(spark, asked).collect()} if asked else {}
    config_hash = hashes[config_path][1] if config_path else NO_FILE
    if loaded_raw:
        meta = [(run, names[run], now, source_type, notes, PIPELINE_VERSION, config_hash, hashes[path][1]) for run, path in loaded_raw.items()]
        warehouse_store(spark, warehouse, "runs").upsert(spark.createDataFrame(meta, WAREHOUSE["runs"]))
    finished = max(now, datetime.now(timezone.utc).replace(tzinfo=None))
    rows = [(*a[:5], a[5], *hashes.get(a[5], (None, NO_FILE)), now, finished) for a in audit]
    made = spark.createDataFrame(rows, AUDIT)
    made.write.mode("append").parquet(f"{warehouse}/ingest_audit")
    return made


def ingest_run(spark: SparkSession, run_id: str, run_dir: str, warehouse: str, **options) -> DataFrame:
    """``ingest_runs`` for one run."""
    return ingest_runs(spark, {run_id: run_dir}, warehouse, **options)


def ingest_all_runs(spark: SparkSession, root: str, run_names: Sequence[str], warehouse: str, **options) -> DataFrame:
    """``ingest_runs`` for run directories below ``root``, named as their ids."""
    return ingest_runs(spark, {name: f"{root}/{name}" for name in run_names}, warehouse, **options)


def ingest_legacy_features(spark: SparkSession, path: str, warehouse: str) -> tuple[int, int]:
    """Load a legacy feature CSV into the hourly feature table; hours that are there stay as they are.

    The time column is ``timestamp`` or, in old files, ``Tempo``; columns that the table lacks are not
    read, columns that the file lacks are NULL, rows whose time cannot be read fall out. Returns
    (records of the file with a time, rows added); a second load adds none.
    """
    schema = WAREHOUSE["ml_features_timeseries"]
    raw = union_missing_columns(csv_by_header(spark, path))
    if "timestamp" not in raw.columns and LEGACY_TIME in raw.columns:
        raw = raw.withColumnRenamed(LEGACY_TIME, "timestamp")
    require_columns(raw, ["timestamp"], path)
    known = raw.select(*[f.name for f in schema if f.name in raw.columns]).withColumn("timestamp", parse_mixed_time("timestamp"))
    types = {f.name: f.dataType.simpleString() for f in schema if f.name in known.columns and f.name != "timestamp"}
    rows = durable(coerce_types(known, types).filter("timestamp IS NOT NULL"))
    added = warehouse_store(spark, warehouse, "ml_features_timeseries").insert_ignore(rows)
    return rows.count(), added


def warehouse_table(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """A stored table, or an empty one with its columns if nothing was loaded yet."""
    if table in WAREHOUSE:
        return warehouse_store(spark, warehouse, table).read()
    path = f"{warehouse}/{table}"
    return spark.read.schema(AUDIT).parquet(path).select(*AUDIT.names) if path_exists(spark, path) else spark.createDataFrame([], AUDIT)
