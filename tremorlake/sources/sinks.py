"""Sinks: insert-ignore, upsert, aligned append, CSV, GeoJSON, alert log.

Parquet has neither keys nor MERGE, so the key rules are plans: what a batch adds (``new_rows``), and
what a table becomes (``merged_rows``). Both pick one row per key by aggregation, which combines
before the shuffle, so that a hot key does not meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tremorlake.operators.quality import first_per_key
from tremorlake.session import durable
from tremorlake.sources.files import path_exists

PREVIEW_ROWS = 1000  # fixed value
TOUCHED_PARTITIONS = 5000  # above this many partitions in a batch the whole table is read
ALERT_LOG_COLUMNS = "timestamp risk_index threshold min_stations level message additional_info".split()  # fixed values


def aligned(batch: DataFrame, schema: T.StructType) -> DataFrame:
    """The target's columns in its order and types; a column the batch lacks is NULL, others are dropped."""
    have = set(batch.columns)
    return batch.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def without_keys(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key ``right`` lacks; NULL keys are equal to each other."""
    other = right.select(*[F.col(k).alias(f"_k_{k}") for k in key])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key])
    return left.join(other, same, "left_anti")


def new_rows(target: DataFrame | None, batch: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of the batch whose key the target lacks; the first in ``order`` of each key."""
    once = first_per_key(batch, list(key), list(order))
    return once if target is None else without_keys(once, target, key)


def merged_rows(target: DataFrame | None, batch: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The target with the batch written over it; the last in ``order`` of each key wins."""
    once = first_per_key(batch, list(key), list(order), last=True)
    if target is None:
        return once
    return without_keys(target, once, key).unionByName(once.select(*target.columns))


def _existing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    return spark.read.schema(schema).parquet(path).select(*schema.names) if path_exists(spark, path) else None


def _touched(table: DataFrame | None, batch: DataFrame, partition: str | None) -> DataFrame | None:
    """The part of the table in the batch's partitions; the scan skips the other directories."""
    if table is None or partition is None:
        return table
    values = [r[0] for r in batch.select(partition).distinct().limit(TOUCHED_PARTITIONS + 1).collect()]
    if len(values) > TOUCHED_PARTITIONS:
        return table
    known = F.col(partition).isin([v for v in values if v is not None])
    return table.filter(known | F.col(partition).isNull() if None in values else known)


def _check_partition(partition: str | None, key: Sequence[str]) -> None:
    if partition is not None and partition not in key:
        raise ValueError(f"partition column {partition} must be part of the key {', '.join(key)}")


def insert_ignore(
    batch: DataFrame, path: str, schema: T.StructType, key: Sequence[str], order: Sequence[str] | None = None, partition: str | None = None
) -> int:
    """Append what is new to a Parquet table; running it again adds nothing. Returns rows added.

    With a partition column (part of the key) only the batch's partitions are looked at.
    """
    _check_partition(partition, key)
    spark = batch.sparkSession
    rows = aligned(batch, schema)
    target = _touched(_existing(spark, path, schema), rows, partition)
    before = 0 if target is None else target.count()  # from the file footers
    added = new_rows(target, rows, key, order or [c for c in schema.names if c not in key])
    writer = added.write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    return _touched(_existing(spark, path, schema), rows, partition).count() - before


def upsert(
    batch: DataFrame, path: str, schema: T.StructType, key: Sequence[str], order: Sequence[str] | None = None, partition: str | None = None
) -> int:
    """Write a batch over a Parquet table by key. Returns rows in what was written.

    The merged rows are written to the checkpoint folder before the old ones are replaced. With a
    partition column (part of the key) only the batch's partitions are read and replaced.
    """
    _check_partition(partition, key)
    spark = batch.sparkSession
    rows = aligned(batch, schema)
    target = _touched(_existing(spark, path, schema), rows, partition)
    merged = durable(merged_rows(target, rows, key, order or [c for c in schema.names if c not in key]))
    writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if partition else "static")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    return merged.count()


def empty_result(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, typed columns: downstream plans need no special case."""
    return spark.createDataFrame([], schema)


def sink_csv(df: DataFrame, path: str, compress: bool = True) -> None:
    writer = df.write.mode("overwrite").option("header", True)
    (writer.option("compression", "gzip") if compress else writer).csv(path)


def preview(df: DataFrame, order: Sequence[str], rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows in a stated order, for the side file."""
    return df.orderBy(*order).limit(rows)


def geojson_features(points: DataFrame, properties: Sequence[str], lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """One GeoJSON Feature text per point, column ``feature``."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"),
        F.struct(*properties).alias("properties"),
    )
    return points.select("*", F.to_json(feature).alias("feature"))


def sink_geojson(points: DataFrame, path: str, properties: Sequence[str]) -> None:
    """Features as JSON lines, written in parallel (the sequence form of a collection)."""
    geojson_features(points, properties).select("feature").write.mode("overwrite").text(path)


def alert_log_rows(alerts: DataFrame) -> DataFrame:
    """Alerts in the log's fixed column order, the info map as JSON text in the flat form."""
    return alerts.select(*ALERT_LOG_COLUMNS)


def sink_alert_log(alerts: DataFrame, folder: str) -> None:
    """Append alerts as JSON lines and as CSV of one fixed layout."""
    rows = durable(alert_log_rows(alerts))
    rows.write.mode("append").json(f"{folder}/jsonl")
    flat = rows.withColumn("additional_info", F.to_json("additional_info"))
    flat.write.mode("append").option("header", True).csv(f"{folder}/csv")
