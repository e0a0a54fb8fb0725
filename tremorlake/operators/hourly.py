"""Hourly grid and hourly aggregates of picks, catalogue and waveform energy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tremorlake.scale import spread

LOG_RATIO_LIMIT = 0.301  # fixed value: about twice the base energy
COMPLETE_SHARE = 0.95  # fixed value: share of stations that makes an hour complete
BASE_HOURS = 168  # fixed value: hours in the causal base


def _step() -> Column:
    return F.expr("INTERVAL 1 HOUR")


def hour_grid(df: DataFrame, time: str, name: str = "timestamp") -> DataFrame:
    """Every hour from the first to the last time, both included."""
    ends = df.agg(F.date_trunc("hour", F.min(time)).alias("first"), F.date_trunc("hour", F.max(time)).alias("last"))
    return ends.select(F.explode(F.sequence("first", "last", _step())).alias(name))


def hourly_counts(picks: DataFrame, time: str = "arrival_iso", value: str = "delta_seconds") -> DataFrame:
    """Per hour: rows, distinct stations, max, mean and population std of the delta, last arrival."""
    return picks.groupBy(F.date_trunc("hour", time).alias("hour")).agg(
        F.count(F.lit(1)).alias("numero_eventi"),
        F.count_distinct("station_code").alias("stazioni_attive"),
        F.max(value).alias("energia_max"),
        F.avg(value).alias("energia_media"),
        F.stddev_pop(value).alias("energia_std"),
        F.max(time).alias("last_arrival"),
    )


def hourly_counts_legacy(picks: DataFrame, time: str = "arrival_iso", value: str | Column = "delta_seconds") -> DataFrame:
    """Gap-free variant on a frame's rules: sample std and min too, empty hours and lone rows give 0."""
    value = F.col(value) if isinstance(value, str) else value
    counts = picks.groupBy(F.date_trunc("hour", time).alias("timestamp")).agg(
        F.count(F.lit(1)).alias("numero_eventi"),
        F.max(value).alias("energia_max"),
        F.avg(value).alias("energia_media"),
        F.stddev_samp(value).alias("energia_std"),
        F.min(value).alias("energia_min"),
    )
    zero = {c: 0.0 for c in ("energia_max", "energia_media", "energia_std", "energia_min")}
    return hour_grid(picks, time).join(counts, "timestamp", "left").na.fill({"numero_eventi": 0, **zero})


def expected_stations(picks: DataFrame) -> DataFrame:
    """One row: distinct stations over all data (de-duplicated map-side, then counted)."""
    return picks.select("station_code").distinct().agg(F.count("station_code").alias("stazioni_attese"))


def data_completeness(active: Column, expected: Column) -> Column:
    """1 if at least 95 % of the expected stations were active."""
    share = F.try_divide(F.coalesce(active, F.lit(0)).cast("double"), expected.cast("double"))
    return F.when(share >= COMPLETE_SHARE, 1).otherwise(0)


def catalog_hourly(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy(F.date_trunc("hour", "time").alias("hour")).agg(
        F.count(F.lit(1)).alias("catalog_n"), F.max("magnitude").alias("catalog_max")
    )


def energy_station_hour(energy: DataFrame) -> DataFrame:
    """Per hour and station: mean rms and highest peak over channels, positive rows only."""
    positive = energy.filter((F.col("rms") > 0) & (F.col("peak") > 0))
    return positive.groupBy(F.date_trunc("hour", "hour").alias("hour"), "station_code").agg(
        F.avg("rms").alias("rms"), F.max("peak").alias("peak")
    )


def causal_log_ratio(station_hours: DataFrame, rows: int = BASE_HOURS) -> DataFrame:
    """log10 of rms and peak over their median in the station's ``rows`` preceding hours.

    One row per station and hour comes in, so a window partition is bounded by the hours covered.
    """
    base = W.partitionBy("station_code").orderBy("hour").rowsBetween(-rows, -1)

    def median(c: str) -> Column:
        return F.percentile(c, F.lit(0.5)).over(base)

    with_base = spread(station_hours, ["station_code"]).select("*", median("rms").alias("base_rms"), median("peak").alias("base_peak"))

    def ratio(c: str) -> Column:
        return F.log10(F.col(c) / F.greatest(F.col(f"base_{c}"), F.lit(1e-9)))

    return with_base.filter(F.col("base_rms").isNotNull()).select(
        "hour", "station_code", ratio("rms").alias("rms_log_ratio"), ratio("peak").alias("peak_log_ratio")
    )


def energy_robust_network(ratios: DataFrame) -> DataFrame:
    """Per hour: stations, median log ratios, and how many stations at least doubled their energy."""
    doubled = F.when(F.col("rms_log_ratio") >= LOG_RATIO_LIMIT, 1).otherwise(0)
    return ratios.groupBy("hour").agg(
        F.count_distinct("station_code").alias("n_stations_energy"),
        F.median("rms_log_ratio").alias("net_rms_log_ratio_med"),
        F.median("peak_log_ratio").alias("net_peak_log_ratio_med"),
        F.sum(doubled).alias("n_stations_2x_rms"),
        F.avg(doubled).alias("frac_stations_2x_rms"),
    )


def join_hourly_grid(grid: DataFrame, sides: list[DataFrame]) -> DataFrame:
    """Grid left-joined to tables of one row per hour; the caller fills the gaps."""
    for side in sides:
        grid = grid.join(side.withColumnRenamed("hour", "timestamp"), "timestamp", "left")
    return grid
