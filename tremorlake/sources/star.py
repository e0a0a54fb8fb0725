"""Star layout (stations, events, deltas with surrogate keys) and the download plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tremorlake.scale import number_rows
from tremorlake.session import durable

# Defaults of the star layout.
DEFAULT_ELEVATION, DEFAULT_NETWORK, DEFAULT_PHASE = 0.0, "IV", "P"
LEAST_BLOCK_DAYS = 0.1  # fixed value: shortest download block


def surrogate_keys(df: DataFrame, natural: str, name: str, hot_rows: int | None = None) -> DataFrame:
    """Number the distinct natural keys from 1 in their order; ``df`` is computed once, many keys are numbered in parallel."""
    return number_rows(durable(df.dropDuplicates([natural])), [], [F.col(natural)], name, hot_rows)


def load_star_schema(stations: DataFrame, picks: DataFrame) -> dict[str, DataFrame]:
    """The three tables of the star; deltas keep only rows whose station is known."""
    from tremorlake.operators.aggregates import event_epicenter
    from tremorlake.operators.joins import join_fk_map

    dim = stations.select(
        "station_code",
        F.coalesce("network", F.lit(DEFAULT_NETWORK)).alias("network"),
        "latitude",
        "longitude",
        F.coalesce("elevation", F.lit(DEFAULT_ELEVATION)).alias("elevation"),
    )
    dim = surrogate_keys(dim, "station_code", "station_id")
    events = surrogate_keys(event_epicenter(picks, stations), "event_id", "event_key")
    phase = F.coalesce(F.col("phase"), F.lit(DEFAULT_PHASE)) if "phase" in picks.columns else F.lit(DEFAULT_PHASE)
    deltas = join_fk_map(picks.withColumn("phase", phase), dim, events).select(
        "station_id", "event_key", "phase", "arrival_iso", "delta_seconds"
    )
    return {"stations": dim, "seismic_events": events, "event_deltas": deltas}


def download_plan(
    stations: DataFrame,
    channels: Sequence[str],
    start: str,
    end: str,
    block_days: float,
    done: DataFrame | None = None,
) -> DataFrame:
    """One task per station, channel and time block [t, min(t + block, end)), with its file key.

    ``done`` (a ``file_key`` column) leaves out what is already there.
    """
    from tremorlake.functions.scalars import file_key

    if block_days < LEAST_BLOCK_DAYS:
        raise ValueError(f"blocks of {block_days} days are too short; at least {LEAST_BLOCK_DAYS}")
    first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    step = F.expr(f"INTERVAL {round(block_days * 86_400_000_000)} MICROSECONDS")
    tasks = (
        stations.select("network", "station_code", F.explode(F.array(*[F.lit(c) for c in channels])).alias("channel"))
        .select("*", F.explode(F.sequence(first, last, step)).alias("block_start"))
        .filter(F.col("block_start") < last)
        .withColumn("block_end", F.least(F.col("block_start") + step, last))
        .withColumn("file_key", file_key("block_start", "network", "station_code", "channel"))
    )
    return tasks if done is None else tasks.join(done.select("file_key").distinct(), "file_key", "left_anti")
