"""The hourly feature series with its future-looking alarm label: the engine's flagship plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tremorlake.functions.scalars import calendar_features
from tremorlake.operators import hourly as H, windows as R
from tremorlake.schemas import FEATURES
from tremorlake.session import durable

HORIZON_HOURS = 6  # fixed value: how far the label looks ahead
MAGNITUDE_LIMIT = 3.5  # fixed value: smallest magnitude that alarms


def hourly_base(picks: DataFrame, catalog: DataFrame, energy: DataFrame) -> DataFrame:
    """Grid, pick counts, catalogue and robust energy side by side, one row per hour.

    The picks are aggregated once and written down: grid bounds, counts and the data end all come
    from that table of one row per hour, not from the raw picks again.
    """
    counts = durable(H.hourly_counts(picks))
    expected = H.expected_stations(picks).scalar()
    robust = H.energy_robust_network(H.causal_log_ratio(H.energy_station_hour(energy)))
    joined = H.join_hourly_grid(H.hour_grid(counts, "hour"), [counts, H.catalog_hourly(catalog), robust])
    zero = F.lit(0.0)
    return joined.select(
        "timestamp",
        F.coalesce("numero_eventi", F.lit(0)).alias("numero_eventi"),
        *[F.coalesce(c, zero).alias(c) for c in ("energia_max", "energia_media", "energia_std")],
        "catalog_n",
        "catalog_max",
        *[F.coalesce(c, zero).alias(c) for c in ("net_rms_log_ratio_med", "net_peak_log_ratio_med")],
        F.coalesce(F.col("n_stations_energy").cast("double"), zero).alias("n_stations_energy"),
        F.coalesce("frac_stations_2x_rms", zero).alias("frac_stations_2x_rms"),
        H.data_completeness(F.col("stazioni_attive"), expected).alias("is_data_complete"),
        "last_arrival",
    )


def hourly_features_view(
    picks: DataFrame,
    catalog: DataFrame,
    energy: DataFrame,
    label_events: DataFrame | None = None,
    horizon_hours: int = HORIZON_HOURS,
    magnitude_limit: float = MAGNITUDE_LIMIT,
    strict_past: bool = False,
    run_id: str | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """34 columns per hour; hours whose label cannot be known yet are left out.

    ``label_events`` replaces the default choice of catalogue events from ``magnitude_limit`` up.
    """
    if run_id is not None:
        picks = picks.filter(F.col("run_id") == run_id)
    if label_events is None:
        label_events = catalog.filter(F.col("magnitude") >= magnitude_limit)
    base = durable(hourly_base(picks, catalog, energy))
    series = R.rolling_counts(base)
    series = R.rolling_energy(series)
    series = R.rolling_catalog_past(series, strict_past=strict_past)
    series = R.rolling_network_energy(series)
    series = R.label_future_exists(series, label_events, horizon_hours)
    end = base.agg(F.max("last_arrival").alias("end")).scalar()
    known = series.filter(F.col("timestamp") < end - F.expr(f"INTERVAL {int(horizon_hours)} HOURS"))
    calendar = [c.alias(n) for n, c in calendar_features("timestamp").items()]
    made = known.select("*", *calendar, F.lit(None).cast("double").alias("bvalue_rolling_24h"))
    return union_history(made, history)


def as_features(df: DataFrame) -> DataFrame:
    """The feature columns in order and type; columns that ``df`` lacks become typed NULLs."""
    have = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in FEATURES]
    )


def union_history(generated: DataFrame, history: DataFrame | None) -> DataFrame:
    """Stored history and generated rows, equal timestamps kept; calendar columns are derived anew."""
    made = as_features(generated)
    if history is None:
        return made
    calendar = calendar_features("timestamp")
    counts = [f.name for f in FEATURES[1:17]]
    old = as_features(history).withColumns(calendar).withColumn("is_data_complete", F.lit(None).cast("int"))
    return as_features(old.na.fill(0, subset=counts)).unionByName(made)
