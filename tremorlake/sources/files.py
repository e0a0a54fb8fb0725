"""File sources: checked CSV, code lists, event catalogues, JSON records, runs, waveform chunks."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tremorlake.functions.scalars import normalize_code
from tremorlake.operators.ordering import union_missing_columns
from tremorlake.operators.quality import ALERT_ALIASES, CheckFailed, coerce_types
from tremorlake.session import durable, release
from tremorlake.sources.pieces import PIECE_BYTES, piece_digests

# Columns of the '|'-separated event text and their names here.
CATALOG_COLUMNS = {
    "#EventID": "event_id",
    "Time": "time",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Depth/Km": "depth_km",
    "MagType": "mag_type",
    "Magnitude": "magnitude",
    "EventLocationName": "event_location_name",
    "EventType": "event_type",
}
RECORD_WRAPPERS = ["alerts", "events", "results", "data", "items"]
ALERT_RECORD = (
    "timestamp STRING, type STRING, level STRING, risk_index DOUBLE, threshold DOUBLE, min_stations BIGINT, "
    "station STRING, severity STRING, risk_score DOUBLE, latitude DOUBLE, longitude DOUBLE, message STRING, "
    "event_reference_epoch DOUBLE, arrival_epoch DOUBLE, start_epoch DOUBLE, end_epoch DOUBLE, time_epoch DOUBLE"
)
NO_FILE = "N/A"
HEADERS_AT_ONCE = 32


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob has files, on whatever file system it names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return found is not None and len(found) > 0


def require_columns(df: DataFrame, required: Sequence[str], what: str = "table") -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise CheckFailed(f"{what} lacks the columns {', '.join(missing)}; it has {', '.join(df.columns)}")
    return df


def csv_headers(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, ...]]:
    """The header of each CSV file, or of the first part of a directory of parts; () where there is none.

    Metadata work of the driver, as a listing is: the first line of each file is read, plain or packed, many side by side.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(name: str) -> str | None:
        path = jvm.org.apache.hadoop.fs.Path(name)
        system = path.getFileSystem(conf)
        if system.getFileStatus(path).isDirectory():
            inside = sorted(s.getPath().toString() for s in system.listStatus(path) if s.isFile() and s.getLen() > 0 and s.getPath().getName()[0] not in "._")
            if not inside:
                return None
            path = jvm.org.apache.hadoop.fs.Path(inside[0])
        stream = system.open(path)
        try:
            codec = codecs.getCodec(path)
            plain = stream if codec is None else codec.createInputStream(stream)
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
        finally:
            stream.close()

    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        lines = list(pool.map(inheritable_thread_target(spark)(first_line), paths))
    return [tuple(next(csv.reader([line]))) if line else () for line in lines]


def csv_by_header(spark: SparkSession, path: str | Sequence[str], **options) -> list[DataFrame]:
    """One scan for each distinct header among the files of ``path``, so that columns go by name, not by place.

    A pass over the text finds the first line of every file; files without a line have no rows. Where all files agree, which
    is the rule, there is one scan of ``path`` as it is. Else each layout's scan names its files, a row a file in the driver,
    which is what the listing of a scan holds anyway.
    """
    first = spark.read.options(**options).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
    heads = durable(first.filter("start = 0").groupBy("file").agg(F.min_by("value", "line").alias("head")))
    layouts = heads.select("head").distinct().count()
    files: dict[str, list[str]] = {}
    if layouts > 1:
        literal = F.regexp_replace(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))), r"([\\{}\[\]*?])", r"\\$1")  # a path, not a pattern
        for row in heads.select("head", literal.alias("file")).orderBy("head", "file").toLocalIterator():
            files.setdefault(row["head"], []).append(row["file"])
    release(heads)
    if layouts < 2:
        return [spark.read.options(header=True, **options).csv(path)]
    options.pop("recursiveFileLookup", None)  # the files are named one by one from here
    return [spark.read.options(header=True, **options).csv(named) for named in files.values()]


def scan_csv_checked(
    spark: SparkSession, path: str | Sequence[str], required: Sequence[str], types: Mapping[str, str] | None = None
) -> DataFrame:
    """CSV or CSV.GZ with a header; missing columns are named in the error, bad values are NULL.

    Files may differ in the order of their columns and in the columns beyond ``required``.
    """
    df = union_missing_columns([require_columns(one, required, str(path)) for one in csv_by_header(spark, path)])
    return coerce_types(df, {c: t for c, t in (types or {}).items() if c in df.columns})


def scan_code_list(spark: SparkSession, path: str) -> DataFrame:
    """Codes of a text list in order of first mention: (file, line, place, code).

    Blank lines and lines that start with # are skipped; commas or else blanks part the codes of a line.
    """
    whole = spark.read.text(path, wholetext=True)  # a code list is a small hand-written file
    lines = whole.select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", r"\r\n|\n|\r")).alias("line", "text")).withColumn("text", F.trim("text"))
    lines = lines.filter((F.col("text") != "") & ~F.col("text").startswith("#"))
    parts = F.when(F.contains("text", F.lit(",")), F.split("text", ",")).otherwise(F.split("text", r"\s+"))
    codes = lines.select("file", "line", F.posexplode(parts).alias("place", "code")).withColumn("code", F.trim("code")).filter("code <> ''")
    first = codes.groupBy("code").agg(F.min(F.struct("file", "line", "place")).alias("position"))
    return first.select("position.*", "code").orderBy("file", "line", "place")


def scan_event_catalog(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Event text with ``|`` between values: nine columns renamed, times trimmed, numbers cast."""
    df = union_missing_columns([require_columns(one, list(CATALOG_COLUMNS), str(path)) for one in csv_by_header(spark, path, sep="|")])
    numbers = {"latitude", "longitude", "depth_km", "magnitude"}
    out = []
    for source, name in CATALOG_COLUMNS.items():
        value = F.trim(F.col(f"`{source}`"))
        out.append((value.cast("double") if name in numbers else value).alias(name))
    return df.select(*out)


def scan_json_records(
    spark: SparkSession,
    path: str | Sequence[str],
    record: str = ALERT_RECORD,
    lines: bool | None = None,
    aliases: Mapping[str, Sequence[str]] = ALERT_ALIASES,
) -> DataFrame:
    """Records of JSON lines, or of JSON documents: a list, a record, or a list under a wrapper key.

    Records are VARIANT values, so they may have any fields. ``record`` names the columns to read; each is the first of
    its ``aliases`` that a record has, whatever the other records have, and a number may be there as text.
    A field that is absent or does not fit is NULL. Lines or documents that cannot be read are skipped. JSON
    lines split over tasks; a JSON document is one value and is read by one task.
    """
    first = path if isinstance(path, str) else path[0]
    lines = first.endswith((".jsonl", ".jsonl.gz")) if lines is None else lines
    if lines:
        read = spark.read.text(path).filter(F.trim("value") != "").select(F.try_parse_json("value").alias("r"))
    else:
        whole = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
        lists = [F.try_variant_get("v", at, "array<variant>") for at in ("$", *[f"$.{name}" for name in RECORD_WRAPPERS])]
        read = whole.filter("v IS NOT NULL").select(F.explode(F.coalesce(*lists, F.array("v"))).alias("r"))
    records = read.filter(F.schema_of_variant("r").startswith("OBJECT"))

    def value(field: T.StructField) -> Column:
        kind = field.dataType.simpleString()
        return F.coalesce(*[F.try_variant_get("r", f"$.{name}", kind) for name in aliases.get(field.name, [field.name])]).alias(field.name)

    return records.select(*[value(field) for field in T.StructType.fromDDL(record)])


def scan_parquet(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*columns) if columns else df


def with_source(df: DataFrame) -> DataFrame:
    """Source file and its change time as columns."""
    return df.select("*", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_modification_time").alias("source_mtime"))


def scan_recent_files(spark: SparkSession, folder: str, modified_after: str) -> DataFrame:
    """CSV, JSON lines, JSON and Parquet below ``folder`` changed after a time; one table, missing columns NULL.

    ``modified_after`` is UTC text such as 2024-01-31T00:00:00. Lines and documents of JSON that cannot
    be read are skipped.
    """
    found = []
    for glob, read in (
        ("*.{csv,csv.gz}", lambda o: csv_by_header(spark, folder, **o)),
        ("*.jsonl", lambda o: [spark.read.options(mode="DROPMALFORMED", **o).json(folder)]),
        ("*.json", lambda o: [spark.read.options(multiLine=True, mode="DROPMALFORMED", **o).json(folder)]),
        ("*.parquet", lambda o: [spark.read.options(mergeSchema=True, **o).parquet(folder)]),
    ):
        options = {"recursiveFileLookup": True, "pathGlobFilter": glob, "modifiedAfter": modified_after, "timeZone": "UTC"}
        try:
            frames = read(options)
        except Exception as error:  # a format without files has no schema
            if "UNABLE_TO_INFER_SCHEMA" in str(error):
                continue
            raise
        found += [_unwrap(with_source(df)) for df in frames if df.columns]
    if not found:
        raise FileNotFoundError(f"no files below {folder} changed after {modified_after}")
    return union_missing_columns(_as_text(found))


def _unwrap(df: DataFrame) -> DataFrame:
    """Rows of the first wrapper column that holds a list of records, else the rows as they are."""
    for name in RECORD_WRAPPERS:
        if name in df.columns and isinstance(df.schema[name].dataType, T.ArrayType):
            return df.select(F.explode(name).alias("r"), "source_file", "source_mtime").select("r.*", "source_file", "source_mtime")
    return df


def _as_text(frames: list[DataFrame]) -> list[DataFrame]:
    """Columns whose type differs between formats become text, so that the union is well typed."""
    kinds: dict[str, set] = {}
    for frame in frames:
        for field in frame.schema:
            kinds.setdefault(field.name, set()).add(field.dataType.simpleString())
    mixed = {name for name, seen in kinds.items() if len(seen) > 1}
    return [f.withColumns({c: F.col(c).cast("string") for c in f.columns if c in mixed}) if mixed else f for f in frames]


def scan_runs(spark: SparkSession, root: str, inside: str, required: Sequence[str] = ()) -> DataFrame:
    """One table of every run directory below ``root``, with the directory name as ``run_name``."""
    path, run = f"{root}/*/{inside}", run_of_path(F.col("_metadata.file_path"), inside)
    return union_missing_columns([require_columns(one, required, path).withColumn("run_name", run) for one in csv_by_header(spark, path)])


def run_of_path(path: Column, inside: str) -> Column:
    """The directory name in front of ``inside``, NULL if the path has no such part."""
    before = F.substring_index(path, f"/{inside}", 1)  # plain string search: a pattern costs 40 us a row
    return F.when(F.contains(path, F.lit(f"/{inside}")), F.substring_index(before, "/", -1))


def qualified(spark: SparkSession, path: str) -> str:
    """The full URI of a path on the file system that Spark takes it from."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toUri().toString()


def audit_file_hash(spark: SparkSession, paths: Sequence[str], piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Size and SHA-256 of each file or folder of files, ``N/A`` where there is none.

    What is one piece has the SHA-256 of its bytes. A file of more than ``piece_bytes``, or a folder of several files, has the
    SHA-256 of the hexadecimal digests of its pieces, joined in order of path and place: pieces are hashed side by side, and
    the random part of a written file's name does not count. One row of digests is about 64 bytes a piece.
    """
    uris = {path: qualified(spark, path) for path in paths}
    asked = spark.createDataFrame([(p, uris[p]) for p in paths], "file_path STRING, asked STRING")
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("place", "sha256"))), lambda piece: piece["sha256"])
    digests = F.array_join(in_order, "")
    hashed = (
        piece_digests(spark, sorted(set(uris.values())), piece_bytes)
        .groupBy("asked")
        .agg(F.sum("length").alias("file_size_bytes"), F.when(F.count(F.lit(1)) == 1, F.max("sha256")).otherwise(F.sha2(digests, 256)).alias("sha256"))
    )
    return asked.join(hashed, "asked", "left").select("file_path", "file_size_bytes", F.coalesce("sha256", F.lit(NO_FILE)).alias("sha256"))


def waveform_ids(file: Column) -> dict[str, Column]:
    """Event, network, station and channel of file names: the first three parts between ``_``, and the rest."""
    bare = F.regexp_replace(F.element_at(F.split(file, "/"), -1), r"\.[A-Za-z0-9]+$", "")
    parts = F.split(bare, "_")
    size = F.size(parts)
    return {
        "event_key": F.get(parts, F.lit(0)),
        "network": normalize_code(F.get(parts, F.lit(1))),
        "station_code": normalize_code(F.get(parts, F.lit(2))),
        "channel": normalize_code(F.array_join(F.slice(parts, F.lit(4), F.greatest(size - 3, F.lit(0))), "_")),
        "_parts": size,
    }


def scan_waveform_chunks(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Decoded sample arrays (file, start, rate, samples) with the ids of their file names.

    Names of fewer than four parts are left out.
    """
    df = require_columns(scan_parquet(spark, path), ["file", "start", "rate", "samples"], str(path))
    made = df.withColumns(waveform_ids(F.col("file"))).filter(F.col("_parts") >= 4)
    return made.select("file", "event_key", "network", "station_code", "channel", "start", "rate", "samples")
