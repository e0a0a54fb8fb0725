"""Monitor plans: window statistics, risk, threshold alerts, cooldown, hourly counts, ingest, clusters.

Every windowed plan takes a batch or a streaming frame. On a stream, call ``watermarked`` first: late
rows beyond the watermark leave the windows, but ``start_ingest`` still stores them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tremorlake.functions.scalars import ALERT_LEVELS, alert_level, alert_message
from tremorlake.streaming.ordered import clusters_in_order, cooldown_in_order, is_watermarked

# The monitor's configuration.
WATERMARK = "10 minutes"
LOOKBACK, EVERY = "15 minutes", "10 minutes"
STD_WEIGHT, RANGE_WEIGHT = 0.6, 0.4
RISK_DIVISOR = 1_000_000.0
MIN_STATIONS, RISK_LIMIT = 18, 0.7
COOLDOWN_MINUTES = 60
HIGH_LIMIT = dict(ALERT_LEVELS)["HIGH"]
FEW_STATIONS, HIGH_RISK, ALL_CLEAR = "Stazioni insufficienti: ", "Soglia rischio superata: ", "Tutto nella norma"


def watermarked(df: DataFrame, time: str, delay: str = WATERMARK) -> DataFrame:
    """Event time as TIMESTAMP with a watermark (a batch frame passes through)."""
    timed = df.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, delay) if df.isStreaming else timed


def stream_station_stats(df: DataFrame, time: str, value: str, lookback: str = LOOKBACK, every: str = EVERY) -> DataFrame:
    """Per window, station and channel: mean, population std, min, max, rows."""
    return (
        df.groupBy(F.window(time, lookback, every), "station_code", "channel")
        .agg(
            F.avg(value).alias("mean"),
            F.stddev_pop(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.count(value).alias("npts"),
        )
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "station_code", "channel", "mean", "std", "min", "max", "npts")
    )


def risk_of_windows(stats: DataFrame, divisor: float = RISK_DIVISOR) -> DataFrame:
    """Per window: stations, records, and 0.6 mean std + 0.4 mean range over the divisor."""
    risk = STD_WEIGHT * F.avg("std") / divisor + RANGE_WEIGHT * F.avg(F.col("max") - F.col("min")) / divisor
    return stats.groupBy("window_start", "window_end").agg(
        risk.alias("risk_score"), F.count_distinct("station_code").alias("stations_count"), F.count(F.lit(1)).alias("records_count")
    )


def stream_risk_score(
    df: DataFrame, time: str, value: str, divisor: float = RISK_DIVISOR, lookback: str = LOOKBACK, every: str = EVERY
) -> DataFrame:
    """The risk of each window straight from the rows, in three chained aggregations.

    A stream has no exact distinct count. So traces are aggregated to stations, one row per station
    and window, and stations to windows, where counting rows counts stations.
    """
    traces = df.groupBy(F.window(time, lookback, every).alias("window"), "station_code", "channel").agg(
        F.stddev_pop(value).alias("std"), (F.max(value) - F.min(value)).alias("range")
    )
    stations = traces.groupBy("window", "station_code").agg(
        F.sum("std").alias("std"), F.sum("range").alias("range"), F.count(F.lit(1)).alias("traces")
    )
    risk = (STD_WEIGHT * F.sum("std") + RANGE_WEIGHT * F.sum("range")) / F.sum("traces") / divisor
    windows = stations.groupBy("window").agg(
        risk.alias("risk_score"), F.count(F.lit(1)).alias("stations_count"), F.sum("traces").alias("records_count")
    )
    return windows.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "risk_score", "stations_count", "records_count"
    )


def threshold_message(risk: Column, stations: Column, least: int = MIN_STATIONS, limit: float = RISK_LIMIT) -> Column:
    """What is wrong, parts joined by ``; ``, or the all-clear text."""
    few = F.when(stations < least, F.concat(F.lit(FEW_STATIONS), stations.cast("string"), F.lit(f"/{least}")))
    shown = F.call_function("format_number", risk, F.lit("0.0000"))
    high = F.when(risk > limit, F.concat(F.lit(HIGH_RISK), shown, F.lit(f"/{limit}")))
    text = F.concat_ws("; ", few, high)
    return F.when(text == "", ALL_CLEAR).otherwise(text)


def stream_threshold_alerts(risks: DataFrame, least: int = MIN_STATIONS, limit: float = RISK_LIMIT) -> DataFrame:
    """Windows with too few stations or a risk strictly above the limit, with their message."""
    risk, stations = F.col("risk_score"), F.col("stations_count")
    return risks.filter((stations < least) | (risk > limit)).withColumn("message", threshold_message(risk, stations, least, limit))


def threshold_alerts(
    df: DataFrame, risk: str, threshold: float = HIGH_LIMIT, time: str = "timestamp", stations: str = "stations"
) -> DataFrame:
    """Alert rows where the risk reaches the threshold (equal counts here)."""
    score = F.col(risk)
    level = alert_level(score)
    return df.filter(score >= threshold).select(
        F.col(time).alias("timestamp"),
        score.cast("double").alias("risk_index"),
        F.lit(float(threshold)).alias("threshold"),
        F.col(stations).cast("int").alias("min_stations"),
        level.alias("level"),
        alert_message(level, score, F.col(stations)).alias("message"),
        F.create_map(F.lit("trigger_timestamp"), F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("additional_info"),
    )


def monitor_summary(risks: DataFrame, least: int = MIN_STATIONS, limit: float = RISK_LIMIT) -> DataFrame:
    """Per cycle: time, risk, whether an alert is due, message, stations, records."""
    risk, stations = F.col("risk_score"), F.col("stations_count")
    message = threshold_message(risk, stations, least, limit)
    return risks.select(
        F.col("window_end").alias("timestamp"),
        "risk_score",
        (message != ALL_CLEAR).cast("int").alias("alert_required"),
        message.alias("alert_message"),
        "stations_count",
        "records_count",
    )


def stream_hourly_counts(df: DataFrame, time: str, value: str) -> DataFrame:
    """Tumbling hours: rows, stations, max, mean, population std.

    A stream has no exact distinct count. So rows are aggregated to stations, one row per station and
    hour, and stations to hours, where counting rows counts stations (a NULL station counts for none).
    """
    stations = df.groupBy(F.window(time, "1 hour").alias("window"), "station_code").agg(
        F.count(F.lit(1)).alias("rows"), F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_pop(value).alias("var"), F.max(value).alias("max")
    )
    hours = stations.groupBy("window").agg(
        F.sum("rows").alias("numero_eventi"),
        F.count("station_code").alias("stazioni_attive"),
        F.max("max").alias("energia_max"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("mean")).alias("total"),
        F.collect_list(F.when(F.col("n") > 0, F.struct("n", "mean", "var"))).alias("parts"),
    )
    mean = F.try_divide("total", "n")
    squares = F.aggregate("parts", F.lit(0.0), lambda sum_, p: sum_ + p["n"] * (p["var"] + (p["mean"] - mean) * (p["mean"] - mean)))
    return hours.select(
        F.col("window.start").alias("hour"),
        "numero_eventi",
        "stazioni_attive",
        "energia_max",
        mean.alias("energia_media"),
        F.sqrt(F.try_divide(squares, "n")).alias("energia_std"),
    )


def alert_timeline(alerts: DataFrame, time: str = "timestamp") -> DataFrame:
    """Alerts per hour, hours without alerts as 0."""
    from tremorlake.operators.hourly import hour_grid

    counts = alerts.groupBy(F.date_trunc("hour", time).alias("hour")).agg(F.count(F.lit(1)).alias("n_alerts"))
    return hour_grid(alerts, time, "hour").join(counts, "hour", "left").na.fill({"n_alerts": 0})


def cooldown_filter(minutes: float) -> Callable:
    """State function: alerts of one area in time order; drops those within ``minutes`` of the last one sent."""
    wait = round(minutes * 60e6)

    def step(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(chunks), ignore_index=True).sort_values(["us", "alert_id"], kind="stable")
        last = state.get[0] if state.exists else None
        keep = []
        for us, is_error in zip(rows["us"], rows["is_error"]):
            sent = bool(is_error) or last is None or us >= last + wait
            keep.append(sent)
            if sent and not is_error:
                last = int(us)
        if last is not None:
            state.update((last,))
        yield rows[keep][["area", "alert_id", "us", "is_error"]]

    return step


def stream_alert_cooldown(alerts: DataFrame, area: str, time: str, alert_id: str, minutes: float = COOLDOWN_MINUTES, is_error: Column | None = None) -> DataFrame:
    """Alerts that go out: at least ``minutes`` after the last one of their area. Errors always do, and do not count.

    With a watermark on ``time`` alerts go by their time, not by when they arrive: they wait in a buffer until
    the watermark has passed them, and the result equals ``alert_cooldown`` of all alerts that it has passed. Without
    one there is nothing to wait for, and an alert that arrives after a later one counts as it arrives.
    """
    stamp = F.col(time).cast("timestamp")
    rows = alerts.select(
        F.col(area).cast("string").alias("area"),
        F.col(alert_id).cast("long").alias("alert_id"),
        F.unix_micros(stamp).alias("us"),
        (is_error if is_error is not None else F.lit(False)).alias("is_error"),
        *([F.col(time)] if is_watermarked(alerts, time) else []),
    )
    if is_watermarked(alerts, time):
        sent = cooldown_in_order(rows, time, minutes)
    else:
        sent = rows.groupBy("area").applyInPandasWithState(
            cooldown_filter(minutes),
            "area STRING, alert_id LONG, us LONG, is_error BOOLEAN",
            "last_us LONG",
            "append",
            GroupStateTimeout.NoTimeout,
        )
    return sent.select("area", "alert_id", F.timestamp_micros("us").alias("timestamp"), "is_error")


def alert_cooldown(alerts: DataFrame, area: str, time: str, alert_id: str, minutes: float = COOLDOWN_MINUTES) -> DataFrame:
    """The batch twin: sent alerts are the greedy anchors of each area, found in parallel blocks of time."""
    from tremorlake.operators.chains import greedy_anchors
    from tremorlake.operators.quality import first_per_key

    rows = alerts.select(
        F.col(area).cast("string").alias("area"), F.col(alert_id).alias("alert_id"), F.unix_micros(F.col(time).cast("timestamp")).alias("us")
    )
    anchors = greedy_anchors(rows, ["area"], "us", round(minutes * 60e6) - 1).withColumnRenamed("anchor", "us")
    once = first_per_key(rows, ["area", "us"], ["alert_id"])
    return once.join(anchors, ["area", "us"], "left_semi").select("area", "alert_id", F.timestamp_micros("us").alias("timestamp"))


def stream_coincidence(triggers: DataFrame, time: str, window_seconds: float = 10.0, min_stations: int = 3) -> DataFrame:
    """Clusters of each network on a live, watermarked stream of triggers, equal to those of the batch operator.

    Triggers wait until the watermark has passed them, the first of a station and time; the network itself keeps
    its open cluster, one trigger a station, and has one piece of what is released in memory at a time.
    """
    rows = triggers.select("network", "station_code", F.col("pick_id").cast("long").alias("pick_id"), F.unix_micros(time).alias("us"), time)
    found = clusters_in_order(rows, time, round(window_seconds * 1e6), min_stations)
    return found.select("network", F.timestamp_micros("anchor_us").alias("anchor"), "station_code", "pick_id")


def read_files(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """A stream of Parquet files as they arrive in a folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(folder)


def write_available(df: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream over what is there now and append its results to a Parquet folder."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start(path).awaitTermination()


def start_ingest(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    key: Sequence[str],
    checkpoint: str,
    failures: str | None = None,
    partition: str | None = None,
    by: Callable[[], Column] | None = None,
):
    """A stream that inserts each batch by key and goes on past a batch that fails.

    With ``by``, the partition of a row told from its key (``by_day`` and others), ``path`` is a versioned table: a batch
    reads and writes its own partitions only, all of it or nothing, and a batch that is run again after a failure adds nothing.

    ``partition`` (part of the key) limits what a batch is compared with. A failed batch is written to ``failures`` as it came, with its error; without that folder it raises.
    """
    from tremorlake.sources.sinks import insert_ignore
    from tremorlake.sources.versioned import VersionedTable

    def load(batch: DataFrame, number: int) -> None:
        try:
            if by is not None:
                VersionedTable(batch.sparkSession, path, schema, key, by).insert_ignore(batch)
            else:
                insert_ignore(batch, path, schema, key, partition=partition)
        except Exception as error:  # noqa: BLE001
            if failures is None:
                raise
            kept = batch.select(F.to_json(F.struct("*")).alias("row"), F.lit(number).alias("batch"), F.lit(str(error)).alias("error"))
            kept.write.mode("append").json(failures)

    return df.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
