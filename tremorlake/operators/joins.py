"""Joins of picks, events, stations, grids and statistics, with neighbour joins by grid cell.

A side is broadcast only through ``bounded``, which looks at its row count first. Bigger sides fall
back to Spark's shuffled joins, where adaptive execution splits skewed partitions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tremorlake.functions.geo import cell, haversine_km
from tremorlake.functions.scalars import normalize_code
from tremorlake.operators.neighbours import nearest
from tremorlake.scale import bounded
from tremorlake.session import durable

TRAVEL_SECONDS = (0.05, 120.0)  # fixed value: plausible travel times
MIN_STATION_EVENTS = 8  # fixed value: fewest events of a usable station
EDGE_KM = 10.0  # fixed value: station pairs closer than this are linked
BAND_DEGREES = 0.015  # fixed value: epicentres closer than this are neighbours
SAME_PLACE_DEGREES = 1e-6  # fixed value: distance given to coincident epicentres
BLOCK_POINTS = 2000  # points of a cell on one side of a join key
HIGHER_IS_BETTER = ("accuracy", "r2", "precision", "recall", "f1")  # fixed values


def join_picks_events(picks: DataFrame, events: DataFrame, key: str = "event_id", time: str = "origin_time") -> DataFrame:
    """Picks with their event; picks whose event has no time fall out."""
    return picks.join(bounded(events.filter(F.col(time).isNotNull())), key)


def join_travel_times(
    picks: DataFrame,
    events: DataFrame,
    limits: tuple[float, float] = TRAVEL_SECONDS,
    least_events: int = MIN_STATION_EVENTS,
) -> DataFrame:
    """Travel time of each pick within ``limits``, for stations with at least ``least_events`` of them.

    The station count is aggregated and joined back, so no station's rows meet in one window task.
    """
    travel = F.col("arrival_epoch") - F.col("origin_epoch")
    timed = picks.join(bounded(events), "event_id").withColumn("travel_time", travel)
    timed = timed.filter(F.col("travel_time").between(*limits))
    enough = timed.groupBy("station_code").agg(F.count(F.lit(1)).alias("n_events")).filter(F.col("n_events") >= least_events)
    return timed.join(bounded(durable(enough)), "station_code")


def join_station_dim(picks: DataFrame, stations: DataFrame, code: str = "station_code") -> DataFrame:
    """Left join on the trimmed upper-case station code; the pick keeps its own code text."""
    clean = stations.withColumn("_code", normalize_code(code)).drop(code)
    return picks.withColumn("_code", normalize_code(code)).join(bounded(clean), "_code", "left").drop("_code")


def unmatched_codes(picks: DataFrame, stations: DataFrame, code: str = "station_code") -> DataFrame:
    """Codes of ``picks`` that ``stations`` does not have, sorted."""
    wanted = picks.select(normalize_code(code).alias(code)).distinct()
    known = stations.select(normalize_code(code).alias(code)).distinct()
    return wanted.join(bounded(known), code, "left_anti").orderBy(code)


def require_lookup(picks: DataFrame, stations: DataFrame, code: str = "station_code") -> DataFrame:
    """``join_station_dim`` that fails naming all codes without a station that has both coordinates.

    ``unmatched_codes`` gives the same list as a table. A pick without a code counts as the code NULL.
    """
    placed = stations
    for column in ("latitude", "longitude"):
        if column in stations.columns:
            placed = placed.filter(F.col(column).isNotNull())
    missing = [r[0] or "NULL" for r in unmatched_codes(picks, placed, code).collect()]
    if missing:
        raise ValueError(f"{len(missing)} stations without coordinates: {', '.join(missing)}")
    return join_station_dim(picks, stations, code)


def join_base_soft(base: DataFrame, soft: DataFrame) -> DataFrame:
    """Two runs' station statistics side by side, with the difference of their means."""
    both = base.join(soft, "station_code", "full")
    return both.withColumn("soft_minus_base_mean", F.col("soft_mean") - F.col("base_mean"))


def join_coord_diff(base: DataFrame, soft: DataFrame, value: str = "delta_value") -> DataFrame:
    """Soft minus base where both have a value at the same point, equal to the millimetre."""

    def keyed(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.round(F.col(c) * 1000).cast("long").alias(f"{c}_mm") for c in ("easting", "northing")], F.col(value).alias(name))

    pairs = keyed(base, "base_value").join(keyed(soft, "soft_value"), ["easting_mm", "northing_mm"])
    return pairs.withColumn("difference", F.col("soft_value") - F.col("base_value"))


def _around(x: Column, y: Column) -> Column:
    """The 3 x 3 cells around a cell."""
    near = F.array(F.lit(-1), F.lit(0), F.lit(1))
    return F.flatten(F.transform(near, lambda i: F.transform(near, lambda j: F.struct((x + i).alias("cx"), (y + j).alias("cy")))))


def cell_pairs(
    left: DataFrame, right: DataFrame, x: str, y: str, size_x: float, size_y: float, suffix: str = "_2", block: int = BLOCK_POINTS
) -> DataFrame:
    """Candidate pairs whose cells touch: an equality join on the cell, never a cross join.

    Every pair closer than the cell size along both axes is among them; the caller filters. A cell with
    many points is cut: its points into blocks, those that come to it into blocks, and each two of
    these are one join key, so that no key has more than about ``block`` points on either side.
    """
    probes = left.withColumn("_cell", F.explode(_around(cell(x, size_x), cell(y, size_y))))
    homes = right.select(
        F.struct(cell(x, size_x).alias("cx"), cell(y, size_y).alias("cy")).alias("_cell"),
        *[F.col(c).alias(f"{c}{suffix}") for c in right.columns],
    )
    counted = homes.select("_cell", F.lit(0).alias("a"), F.lit(1).alias("b")).unionByName(probes.select("_cell", F.lit(1).alias("a"), F.lit(0).alias("b")))
    sizes = counted.groupBy("_cell").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).filter(f"a > 0 AND b > 0 AND (a > {block} OR b > {block})")
    cuts = durable(sizes.select(F.col("_cell").alias("_crowded"), F.ceil(F.col("a") / block).alias("_ka"), F.ceil(F.col("b") / block).alias("_kb")))
    few = bounded(cuts)

    def cut(df: DataFrame, own: str, other: str) -> DataFrame:
        """Block of the row by itself, repeated for each block of the other side; (0, 0) in cells that are not cut."""
        known = df.join(few, F.col("_cell") == F.col("_crowded"), "left").withColumns({"_ka": F.coalesce("_ka", F.lit(1)), "_kb": F.coalesce("_kb", F.lit(1))})
        dealt = F.pmod(F.xxhash64(*[c for c in df.columns if c != "_cell"]), F.col(f"_k{own}"))
        return known.withColumn(f"_{own}", dealt).withColumn(f"_{other}", F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"_k{other}") - 1))).drop("_crowded", "_ka", "_kb")

    return cut(probes, "a", "b").join(cut(homes, "b", "a"), ["_cell", "_a", "_b"]).drop("_cell", "_a", "_b")


def join_within_distance(stations: DataFrame, km: float = EDGE_KM, code: str = "station_code") -> DataFrame:
    """Ordered station pairs closer than ``km`` with weight 1 / (distance + 0.1)."""
    widest = stations.agg(F.max(F.abs("latitude"))).first()[0] or 0.0
    size_lat = km / 111.0
    size_lon = size_lat / max(math.cos(math.radians(min(89.0, widest + size_lat))), 0.01)
    points = stations.select(code, "latitude", "longitude")
    distance = haversine_km("latitude", "longitude", "latitude_2", "longitude_2")
    pairs = cell_pairs(points, points, "latitude", "longitude", size_lat, size_lon).filter(
        F.col(code) != F.col(f"{code}_2")
    )
    near = pairs.withColumn("distance_km", distance).filter(F.col("distance_km") < km)
    return near.select(
        F.col(code).alias("source"), F.col(f"{code}_2").alias("target"), "distance_km", (1 / (F.col("distance_km") + 0.1)).alias("weight")
    )


def planar(x1: str, y1: str, x2: str, y2: str) -> Column:
    dx, dy = F.col(x2) - F.col(x1), F.col(y2) - F.col(y1)
    return F.sqrt(dx * dx + dy * dy)


def band_weight(distance: Column) -> Column:
    return 1 / F.when(distance == 0, F.lit(SAME_PLACE_DEGREES)).otherwise(distance)


def join_distance_band(points: DataFrame, key: str, band: float = BAND_DEGREES) -> DataFrame:
    """Neighbour edges within ``band`` degrees, weight 1 / distance scaled to sum 1 per point."""
    spots = points.select(key, "latitude", "longitude")
    pairs = cell_pairs(spots, spots, "latitude", "longitude", band, band).filter(F.col(key) != F.col(f"{key}_2"))
    near = pairs.withColumn("distance", planar("latitude", "longitude", "latitude_2", "longitude_2")).filter(
        F.col("distance") <= band
    )
    raw = near.withColumn("raw", band_weight(F.col("distance")))
    total = raw.groupBy(key).agg(F.sum("raw").alias("total"))
    return raw.join(total, key).select(
        F.col(key).alias("i"), F.col(f"{key}_2").alias("j"), "distance", (F.col("raw") / F.col("total")).alias("weight")
    )


def join_knn(points: DataFrame, key: str, k: int = 5, coords: tuple[str, str] = ("x", "y")) -> DataFrame:
    """The k nearest other points of each point, with equal weights that sum to 1."""
    edges = nearest(points, points, k, key, key, coords, skip_same=True)
    size = edges.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return edges.join(size, key).select(
        F.col(key).alias("i"), F.col(f"{key}_2").alias("j"), F.sqrt("d2").alias("distance"), "rank", (1 / F.col("_n")).alias("weight")
    )


def anti_missing_codes(deltas: DataFrame, stations: DataFrame) -> DataFrame:
    """Sorted station codes of ``deltas`` that the station table lacks.

    The code comes from a station column or, without one, from the second part of ``station_id``.
    """
    if "station_code" in deltas.columns:
        coded = deltas.select("station_code")
    elif "station" in deltas.columns:
        coded = deltas.select(F.col("station").alias("station_code"))
    elif "station_id" in deltas.columns:
        coded = deltas.select(F.get(F.split("station_id", r"\."), F.lit(1)).alias("station_code"))
    else:
        raise ValueError("no station, station_code or station_id column")
    return unmatched_codes(coded.filter(F.col("station_code").isNotNull()), stations)


def join_fk_map(deltas: DataFrame, stations: DataFrame, events: DataFrame) -> DataFrame:
    """Deltas with the surrogate keys of their station and event; unmatched rows fall out."""
    return deltas.join(bounded(stations.select("station_code", "station_id")), "station_code").join(
        bounded(events.select("event_id", "event_key")), "event_id"
    )


def regular_grid(points: DataFrame, size: int, coords: tuple[str, str]) -> DataFrame:
    """``size`` x ``size`` nodes over the bounding box of the points: (ix, iy, x, y)."""
    x, y = coords
    box = points.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))
    steps = F.sequence(F.lit(0), F.lit(size - 1))
    nodes = box.select("*", F.explode(steps).alias("ix")).select("*", F.explode(steps).alias("iy"))
    return nodes.select(
        "ix",
        "iy",
        (F.col("x0") + (F.col("x1") - F.col("x0")) * F.col("ix") / (size - 1)).alias(x),
        (F.col("y0") + (F.col("y1") - F.col("y0")) * F.col("iy") / (size - 1)).alias(y),
    )


def interp_nearest(points: DataFrame, key: str, value: str, size: int = 400, coords: tuple[str, str] = ("x", "y")) -> DataFrame:
    """Value of the nearest point at each node of a regular grid, ties by point key."""
    grid = regular_grid(points, size, coords).withColumn("node", F.col("ix") * size + F.col("iy"))
    hits = nearest(grid, points, 1, "node", key, coords, keep=[value])
    return hits.select(
        F.floor(F.col("node") / size).cast("int").alias("ix"), (F.col("node") % size).cast("int").alias("iy"), key, value
    )


def grid_diff(base: DataFrame, soft: DataFrame, value: str) -> DataFrame:
    """Soft grid minus base grid; grids of different shape are an error."""

    def shape(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.max("ix"), F.max("iy")).first())

    if shape(base) != shape(soft):
        raise ValueError(f"grids differ in shape: {shape(base)} and {shape(soft)}")
    left = base.select("ix", "iy", F.col(value).alias("base_value"))
    right = soft.select("ix", "iy", F.col(value).alias("soft_value"))
    return left.join(right, ["ix", "iy"]).withColumn("difference", F.col("soft_value") - F.col("base_value"))


def compare_metrics(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two versions' metrics (metric, value) joined; change, percent and whether it got better."""
    both = first.withColumnRenamed("value", "value_1").join(second.withColumnRenamed("value", "value_2"), "metric", "full")
    change = F.col("value_2") - F.col("value_1")
    percent = F.when(F.col("value_1") != 0, change / F.col("value_1") * 100).when(F.col("value_1") == 0, 0.0)
    better = F.when(F.col("metric").isin(*HIGHER_IS_BETTER), change > 0).otherwise(change < 0)
    return both.select(
        "metric", "value_1", "value_2", change.alias("change"), percent.alias("percent"), better.cast("int").alias("improved")
    )
