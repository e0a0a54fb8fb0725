"""Projections of the driver's tables onto the domain tables (picks, stations, energy, catalogue, ...).

``Tables`` gives the Spark side lazily; ``PRELUDE`` holds the same projections as SQL CTEs for the
oracle, so that both sides start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

PRELUDE = {
    "picks": (
        "picks AS (SELECT event_id AS pick_id, event_id - event_id % 4 AS event_id, 'run_' || (event_id % 2) AS run_id, "
        "'N' || (user_id % 3) AS network, 'ST' || (user_id % 26) AS station_code, event_type AS channel, "
        "ts AS arrival_iso, epoch_us(ts) / 1e6 AS arrival_epoch, value / 10e0 AS delta_seconds FROM events)"
    ),
    "stations": (
        "stations AS (SELECT 'ST' || n_nationkey AS station_code, 'N' || (n_nationkey % 3) AS network, "
        "40.82e0 + ((n_nationkey % 5) - 2) * 0.05e0 AS latitude, 14.14e0 + ((n_nationkey % 7) - 3) * 0.05e0 AS longitude, "
        "n_nationkey * 10e0 AS elevation, n_name AS location FROM nation)"
    ),
    "energy": (
        "energy AS (SELECT 'ST' || (user_id % 26) AS station_code, event_type AS channel, date_trunc('hour', ts) AS hour, "
        "avg(value) AS rms, max(value) AS peak FROM events GROUP BY 1, 2, 3)"
    ),
    "catalog": (
        "catalog AS (SELECT event_id, ts AS time, value / 100e0 AS magnitude, 'ST' || (user_id % 26) AS station_code "
        "FROM events WHERE event_type = 'purchase')"
    ),
    "big_events": (
        "big_events AS (SELECT event_id, ts AS time, value / 100e0 AS magnitude FROM events "
        "WHERE event_type = 'purchase' AND value / 100e0 >= 2e0)"
    ),
    "scores": (
        "scores AS (SELECT doc_id, quality AS label, ((doc_id * 37) % 100) / 100e0 AS score FROM labels)"
    ),
    "samples": (
        "samples AS (SELECT 'ST' || l_suppkey AS station_code, "
        "row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_quantity) - 1 AS n, "
        "l_quantity - 25.5e0 AS x FROM lineitem)"
    ),
    "alerts": (
        "alerts AS (SELECT event_id AS alert_id, ts AS timestamp, least(value / 100e0, 1e0) AS risk_score, "
        "'ST' || (user_id % 26) AS station, event_type AS alert_type FROM events)"
    ),
    "hourly": (
        "hourly AS (SELECT g.ts AS timestamp, coalesce(c.n, 0) AS numero_eventi, coalesce(c.e_max, 0e0) AS energia_max, "
        "coalesce(c.e_avg, 0e0) AS energia_media, coalesce(c.e_std, 0e0) AS energia_std FROM "
        "(SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS ts "
        "FROM events) g LEFT JOIN (SELECT date_trunc('hour', ts) AS h, count(*) AS n, max(value / 10e0) AS e_max, "
        "avg(value / 10e0) AS e_avg, stddev_samp(value / 10e0) AS e_std FROM events GROUP BY 1) c ON c.h = g.ts)"
    ),
}


def with_tables(names: str, body: str) -> str:
    """Oracle SQL text: the named projections as CTEs in front of ``body``."""
    start = "WITH RECURSIVE " if " chain(" in body else "WITH "
    return start + ", ".join(PRELUDE[n] for n in names.split()) + " " + body if names else body


class Tables:
    """The driver's Parquet tables and the domain tables made from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def events(self) -> DataFrame:
        return self.raw("events").withColumn("ts", F.col("ts").cast("timestamp"))

    @property
    def picks(self) -> DataFrame:
        return self.events.select(
            F.col("event_id").alias("pick_id"),
            (F.col("event_id") - F.col("event_id") % 4).alias("event_id"),
            F.concat(F.lit("run_"), (F.col("event_id") % 2).cast("string")).alias("run_id"),
            F.concat(F.lit("N"), (F.col("user_id") % 3).cast("string")).alias("network"),
            F.concat(F.lit("ST"), (F.col("user_id") % 26).cast("string")).alias("station_code"),
            F.col("event_type").alias("channel"),
            F.col("ts").alias("arrival_iso"),
            (F.unix_micros("ts") / 1e6).alias("arrival_epoch"),
            (F.col("value") / 10.0).alias("delta_seconds"),
        )

    @property
    def stations(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.raw("nation").select(
            F.concat(F.lit("ST"), key.cast("string")).alias("station_code"),
            F.concat(F.lit("N"), (key % 3).cast("string")).alias("network"),
            (F.lit(40.82) + ((key % 5) - 2) * F.lit(0.05)).alias("latitude"),
            (F.lit(14.14) + ((key % 7) - 3) * F.lit(0.05)).alias("longitude"),
            (key * F.lit(10.0)).alias("elevation"),
            F.col("n_name").alias("location"),
        )

    @property
    def energy(self) -> DataFrame:
        return (
            self.events.groupBy(
                F.concat(F.lit("ST"), (F.col("user_id") % 26).cast("string")).alias("station_code"),
                F.col("event_type").alias("channel"),
                F.date_trunc("hour", "ts").alias("hour"),
            ).agg(F.avg("value").alias("rms"), F.max("value").alias("peak"))
        )

    @property
    def catalog(self) -> DataFrame:
        return self.events.filter(F.col("event_type") == "purchase").select(
            "event_id",
            F.col("ts").alias("time"),
            (F.col("value") / 100.0).alias("magnitude"),
            F.concat(F.lit("ST"), (F.col("user_id") % 26).cast("string")).alias("station_code"),
        )

    @property
    def big_events(self) -> DataFrame:
        """All events of magnitude 2 and above: the ones the future label looks for."""
        return self.catalog.select("event_id", "time", "magnitude").filter(F.col("magnitude") >= 2.0)

    @property
    def scores(self) -> DataFrame:
        return self.raw("labels").select(
            "doc_id", F.col("quality").alias("label"), (((F.col("doc_id") * 37) % 100) / 100.0).alias("score")
        )

    @property
    def alerts(self) -> DataFrame:
        return self.events.select(
            F.col("event_id").alias("alert_id"),
            F.col("ts").alias("timestamp"),
            F.least(F.col("value") / 100.0, F.lit(1.0)).alias("risk_score"),
            F.concat(F.lit("ST"), (F.col("user_id") % 26).cast("string")).alias("station"),
            F.col("event_type").alias("alert_type"),
        )

    @property
    def samples(self) -> DataFrame:
        """One row per waveform sample: a trace per supplier, ordered by order key and line.

        Written down once, as decoded samples would be: operators pass over them several times.
        """
        from tremorlake.scale import number_rows
        from tremorlake.session import durable

        lines = self.raw("lineitem").select(
            F.concat(F.lit("ST"), F.col("l_suppkey").cast("string")).alias("station_code"),
            "l_orderkey",
            "l_linenumber",
            (F.col("l_quantity") - 25.5).alias("x"),
        )
        order = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("x")]
        numbered = number_rows(lines, ["station_code"], order, "n")
        return durable(numbered.select("station_code", (F.col("n") - 1).alias("n"), "x"))
