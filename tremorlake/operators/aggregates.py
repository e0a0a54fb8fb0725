"""Station, event, report and quality aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tremorlake.functions.geo import KM_PER_DEGREE, haversine_km, mean_bearing
from tremorlake.scale import exact_quantiles, running_totals

MIN_STATION_PICKS = 10  # fixed value: fewest picks that keep a station
CENTRE = (40.8062, 14.1410)  # fixed value: latitude and longitude of the area's centre
MAGNITUDE_FIT = (6.0, 15.0)  # fixed value: magnitude range of the b-value fit


def station_stats(
    picks: DataFrame, prefix: str = "base", value: str = "delta_seconds", hot_rows: int | None = None
) -> DataFrame:
    """Per station: count, mean, sample std (0 for a lone pick) and exact median of the delta."""
    moments = picks.groupBy("station_code").agg(
        F.count(value).alias(f"{prefix}_count"),
        F.avg(value).alias(f"{prefix}_mean"),
        F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias(f"{prefix}_std"),
    )
    median = exact_quantiles(picks, ["station_code"], value, {f"{prefix}_median": 0.5}, hot_rows)
    return moments.join(median, "station_code", "left")


def filter_min_count_any(stats: DataFrame, least: int = MIN_STATION_PICKS) -> DataFrame:
    """Keep a station if any of its ``*_count`` columns reaches ``least``."""
    counts = [F.coalesce(F.col(c), F.lit(0)) for c in stats.columns if c.endswith("_count")]
    if not counts:
        raise ValueError("no *_count column")
    return stats.filter(F.greatest(*counts, F.lit(0)) >= least)


def event_catalog(picks: DataFrame) -> DataFrame:
    """Per event: distinct stations, picks, first reference and first arrival."""
    order = F.struct("arrival_iso", "pick_id")
    reference = "event_reference_epoch" if "event_reference_epoch" in picks.columns else "arrival_epoch"
    return picks.groupBy("event_id").agg(
        F.count_distinct("station_code").alias("n_stations"),
        F.count(F.lit(1)).alias("n_picks"),
        F.min_by(reference, order).alias("event_reference_epoch"),
        F.min("arrival_iso").alias("first_arrival"),
    )


def event_epicenter(picks: DataFrame, stations: DataFrame, least_stations: int = 0) -> DataFrame:
    """Per event: mean position of its picks' stations, distinct stations, first arrival."""
    from tremorlake.operators.joins import join_station_dim

    placed = join_station_dim(picks, stations.select("station_code", "latitude", "longitude"))
    placed = placed.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    per_event = placed.groupBy("event_id").agg(
        F.avg("latitude").alias("latitude"),
        F.avg("longitude").alias("longitude"),
        F.count_distinct("station_code").alias("n_stations"),
        F.min("arrival_iso").alias("first_arrival"),
    )
    return per_event.filter(F.col("n_stations") >= least_stations) if least_stations else per_event


def hourly_spatial(picks: DataFrame, stations: DataFrame) -> DataFrame:
    """Per hour: stations, mean and sample std of position and delta, spread in kilometres."""
    from tremorlake.operators.joins import join_station_dim

    placed = join_station_dim(picks, stations.select("station_code", "latitude", "longitude")).filter(
        F.col("latitude").isNotNull()
    )
    zero = F.lit(0.0)
    made = placed.groupBy(F.date_trunc("hour", "arrival_iso").alias("hour")).agg(
        F.count_distinct("station_code").alias("num_stations"),
        F.avg("latitude").alias("mean_latitude"),
        F.avg("longitude").alias("mean_longitude"),
        F.coalesce(F.stddev_samp("latitude"), zero).alias("std_latitude"),
        F.coalesce(F.stddev_samp("longitude"), zero).alias("std_longitude"),
        F.avg("delta_seconds").alias("mean_delta"),
        F.coalesce(F.stddev_samp("delta_seconds"), zero).alias("std_delta"),
    )
    return made.withColumn("dispersione_spaziale_km", F.col("std_latitude") * KM_PER_DEGREE)


def daily_counts(picks: DataFrame) -> DataFrame:
    return picks.groupBy(F.to_date("arrival_iso").alias("day")).agg(F.count(F.lit(1)).alias("n_picks"))


def top_stations(picks: DataFrame, top: int) -> DataFrame:
    counts = picks.groupBy("station_code").agg(F.count(F.lit(1)).alias("n_picks"))
    return counts.orderBy(F.desc("n_picks"), "station_code").limit(top)


def crosstab_top(picks: DataFrame, channels: Sequence[str], top: int = 50) -> DataFrame:
    """Station x channel counts of the ``top`` stations with most picks, missing pairs 0."""
    kept = F.broadcast(top_stations(picks, top).select("station_code"))  # at most ``top`` rows
    pivot = picks.join(kept, "station_code", "left_semi").groupBy("station_code").pivot("channel", list(channels))
    return pivot.agg(F.count(F.lit(1))).na.fill(0)


def station_report(picks: DataFrame) -> DataFrame:
    return (
        picks.groupBy("station_code")
        .agg(
            F.count(F.lit(1)).alias("n_picks"),
            F.avg("delta_seconds").alias("mean_delta"),
            F.max("delta_seconds").alias("max_delta"),
        )
        .orderBy(F.desc("n_picks"), "station_code")
    )


def hour_of_day_histogram(picks: DataFrame) -> DataFrame:
    return picks.groupBy(F.hour("arrival_iso").alias("hour_of_day")).agg(F.count(F.lit(1)).alias("n_picks"))


def size_distribution(catalog: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """Number of events per station count, optionally per phase."""
    return catalog.groupBy(*by, "n_stations").agg(F.count(F.lit(1)).alias("n_events")).orderBy(
        F.desc("n_events"), "n_stations"
    )


def phase_comparison(catalog: DataFrame, full_size: int = 20) -> DataFrame:
    """Per month: days, events, events a day, mean stations, events with exactly ``full_size`` stations."""
    return catalog.groupBy(F.date_format("first_arrival", "yyyy-MM").alias("phase")).agg(
        F.count_distinct(F.to_date("first_arrival")).alias("n_days"),
        F.count(F.lit(1)).alias("n_events"),
        (F.count(F.lit(1)) / F.count_distinct(F.to_date("first_arrival"))).alias("events_per_day"),
        F.avg("n_stations").alias("mean_stations"),
        F.count_if(F.col("n_stations") == full_size).alias("n_full"),
    )


def propagation_distance(epicentres: DataFrame, phases: tuple[str, str], phase: Column, centre=CENTRE) -> DataFrame:
    """Mean distance of the epicentres to the centre in two phases, and how far it moved."""
    distance = haversine_km("latitude", "longitude", centre[0], centre[1])
    first = F.avg(F.when(phase == phases[0], distance))
    second = F.avg(F.when(phase == phases[1], distance))
    return epicentres.agg(first.alias("first_km"), second.alias("second_km"), (second - first).alias("shift_km"))


def magnitude_counts(catalog: DataFrame, magnitude: str = "magnitude", hot_rows: int | None = None) -> DataFrame:
    """Distinct magnitudes with the number of events of at least that magnitude."""
    known = catalog.filter(F.col(magnitude).isNotNull())
    counts = known.groupBy(F.col(magnitude).alias("magnitude")).agg(F.count(F.lit(1)).alias("n"))
    return running_totals(counts, [F.col("magnitude").desc()], {"cumulative": "n"}, hot_rows)


def gutenberg_richter_b(
    catalog: DataFrame, low: float = MAGNITUDE_FIT[0], high: float = MAGNITUDE_FIT[1], magnitude: str = "magnitude"
) -> DataFrame:
    """log10 N = a - b m, fitted on the distinct magnitudes in [low, high]; NULL below two points."""
    fit = magnitude_counts(catalog, magnitude).filter(F.col("magnitude").between(low, high))
    y = F.log10("cumulative")
    return fit.agg(
        (-F.regr_slope(y, "magnitude")).alias("b_value"),
        F.regr_intercept(y, F.col("magnitude")).alias("a_value"),
        F.count(F.lit(1)).alias("n_points"),
    )


def target_share(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per label."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.agg(F.sum("n_rows").alias("total")).scalar()
    return counts.withColumn("share", F.col("n_rows") / total)


def risk_proxy_target(df: DataFrame, value: str = "delta_seconds", hot_rows: int | None = None) -> DataFrame:
    """abs(value) over its exact 95th percentile, clipped to [0, 1]."""
    p95 = exact_quantiles(df, [], F.abs(value), {"p95": 0.95}, hot_rows).scalar()
    share = F.coalesce(F.try_divide(F.abs(value), p95), F.lit(0.0))
    return df.withColumn("risk", F.greatest(F.lit(0.0), F.least(share, F.lit(1.0))))


def risk_proxy_waveform(df: DataFrame, std: str = "std", amplitude: str = "amplitude_range") -> DataFrame:
    """Half by std and half by amplitude, each over its largest value."""
    top = df.agg(F.struct(F.max(std).alias("s"), F.max(amplitude).alias("a")).alias("top")).scalar()
    half = 0.5 * F.try_divide(F.col(std), top["s"]) + 0.5 * F.try_divide(F.col(amplitude), top["a"])
    return df.withColumn("risk", half)


def null_cells(columns: Sequence[str]) -> Column:
    """Number of NULLs in a row."""
    return sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))


def missing_pct(df: DataFrame) -> DataFrame:
    """NULL share of the whole table in percent."""
    nulls = F.sum(null_cells(df.columns))
    cells = F.count(F.lit(1)) * len(df.columns)
    return df.agg(F.coalesce(F.try_divide(nulls * 100.0, cells), F.lit(0.0)).alias("missing_pct"))


def alert_kpis(alerts: DataFrame, now: Column) -> DataFrame:
    """Total, last 24 hours, mean risk, distinct stations."""
    recent = F.col("timestamp") >= now - F.expr("INTERVAL 24 HOURS")
    return alerts.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(recent).alias("last_24h"),
        F.avg("risk_score").alias("mean_risk"),
        F.count_distinct("station").alias("stations"),
    )


def outcome_counts(tasks: DataFrame, status: str = "status") -> DataFrame:
    return tasks.groupBy(status).agg(F.count(F.lit(1)).alias("n_tasks"))


def ingest_check_counts(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and first / last time per table and run; ``tables`` maps a name to (table, time column)."""
    parts = [
        df.groupBy("run_id").agg(
            F.count(F.lit(1)).alias("n_rows"), F.min(time).alias("first_time"), F.max(time).alias("last_time")
        ).withColumn("table_name", F.lit(name))
        for name, (df, time) in tables.items()
    ]
    made = parts[0]
    for part in parts[1:]:
        made = made.unionByName(part)
    return made


def lag_autocorr(df: DataFrame, col: str = "numero_eventi", lags=(1, 6), order: str = "timestamp") -> DataFrame:
    """Autocorrelation of the hourly series at a few lags, one row."""
    w = W.orderBy(order)
    shifted = df.select(F.col(col).cast("double").alias("x"), *[F.lag(F.col(col).cast("double"), k).over(w).alias(f"l{k}") for k in lags])
    return shifted.agg(
        *[F.corr(F.when(F.col(f"l{k}").isNotNull(), F.col("x")), F.col(f"l{k}")).alias(f"autocorr_{k}h") for k in lags]
    )


def circular_mean(df: DataFrame, bearing: str | Column, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(mean_bearing(bearing).alias("mean_bearing"))
