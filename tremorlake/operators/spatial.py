"""Spatial statistics: Moran's I, its permutation test, local Moran classes, hourly centroids."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tremorlake.functions.geo import bearing_deg, haversine_km, mean_bearing
from tremorlake.operators.aggregates import CENTRE, hourly_spatial
from tremorlake.operators.joins import BAND_DEGREES, SAME_PLACE_DEGREES, band_weight, cell_pairs, join_knn, join_station_dim, planar
from tremorlake.scale import bounded, number_rows
from tremorlake.session import durable

NEIGHBOURS = 5  # fixed value
PERMUTATIONS = 999  # fixed value
FEISTEL_ROUNDS = 4
DEAL_ROWS = 1 << 16  # rows of permuted edges made at once
FEISTEL_PRIME, FEISTEL_KEY = 2**31 - 1, 998244353  # products stay below 2**63
# Classes of the local statistic.
HIGH_HIGH, LOW_LOW = "High-High (Hotspot)", "Low-Low (Coldspot)"
HIGH_LOW, LOW_HIGH = "High-Low (Outlier)", "Low-High (Outlier)"


def centred(points: DataFrame, value: str) -> DataFrame:
    """Points with ``z``, the deviation from the mean."""
    mean = points.agg(F.avg(value)).first()[0]
    return points.withColumn("z", F.col(value) - F.lit(mean))


def moran_global_knn(points: DataFrame, key: str, value: str, k: int = NEIGHBOURS, coords: tuple[str, str] = ("x", "y")) -> DataFrame:
    """One row: Moran's I with equal weights on the k nearest neighbours, its expectation, and n."""
    points = durable(points)
    z = centred(points, value).select(F.col(key).alias("i"), "z")
    return _moran(join_knn(points, key, k, coords), z)


def _moran(edges: DataFrame, z: DataFrame) -> DataFrame:
    neighbour = z.select(F.col("i").alias("j"), F.col("z").alias("z_j"))
    lag = edges.join(bounded(neighbour), "j").groupBy("i").agg(F.sum(F.col("weight") * F.col("z_j")).alias("lag"))
    return (
        z.join(lag, "i", "left")
        .agg(
            F.sum(F.col("z") * F.coalesce("lag", F.lit(0.0))).alias("top"), F.sum(F.col("z") * F.col("z")).alias("bottom"), F.count(F.lit(1)).alias("n")
        )
        .select(
            F.coalesce(F.try_divide("top", "bottom"), F.lit(0.0)).alias("moran_i"),
            F.try_divide(F.lit(-1.0), F.col("n") - 1).alias("expected_i"),
            "n",
        )
    )


def permuted(slot: np.ndarray, n: np.ndarray, perm: np.ndarray, seed: int) -> np.ndarray:
    """The slot that a numbered permutation of ``n`` slots puts in the place of ``slot``.

    A keyed Feistel network on the digits of a number below a * b, the least rectangle that holds n slots, is a permutation
    of these numbers; a result outside the n slots goes through it again until it is inside, which leaves a permutation of the slots.
    """
    n = np.asarray(n, np.int64)
    a = np.ceil(np.sqrt(n)).astype(np.int64)
    b = -(-n // a)
    keys = [((seed * 7919 + np.asarray(perm, np.int64)) * 31 + r) * FEISTEL_KEY % FEISTEL_PRIME for r in range(FEISTEL_ROUNDS)]

    def mixed(v: np.ndarray, key: np.ndarray) -> np.ndarray:
        t = (v * 1000003 + key) % FEISTEL_PRIME
        return t * t % FEISTEL_PRIME * (t + 11) % FEISTEL_PRIME

    out = np.array(slot, np.int64)
    going = np.ones(len(out), bool)
    while going.any():
        at = np.flatnonzero(going)
        left, right = out[at] // b[at], out[at] % b[at]
        for r in range(0, FEISTEL_ROUNDS, 2):
            left = (left + mixed(right, keys[r][at])) % a[at]
            right = (right + mixed(left, keys[r + 1][at])) % b[at]
        out[at] = left * b[at] + right
        going[at] = out[at] >= n[at]
    return out


def moran_permutation_p(
    points: DataFrame,
    key: str,
    value: str,
    k: int = NEIGHBOURS,
    coords: tuple[str, str] = ("x", "y"),
    permutations: int = PERMUTATIONS,
    seed: int = 42,
    edges: DataFrame | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Simulated p of Moran's I: how often values dealt anew reach it, counted on the smaller tail.

    A permutation is computed, not drawn: which value a slot gets follows from the slot, the permutation's number
    and the seed. So an edge knows the slots of its two values in every permutation, they are looked up, and
    products are summed per permutation in one pass, whose partial sums alone are shuffled. ``by``
    has one test per group in the same plan; then ``edges`` (by, i, j, weight) are given, as their neighbours are found within the groups.
    A value equal to the observed one but for rounding counts as reached.
    """
    by = list(by)
    points = durable(points)
    edges = durable(join_knn(points, key, k, coords) if edges is None else edges).select(*by, "i", "j", "weight")
    means = points.groupBy(*by).agg(F.avg(value).alias("_mean"), F.count(F.lit(1)).alias("n"))
    with_mean = points.join(bounded(means), by) if by else points.withColumns({c: F.lit(v) for c, v in means.first().asDict().items()})
    z = with_mean.select(*by, F.col(key).alias("i"), (F.col(value) - F.col("_mean")).alias("z"), "n")
    z = durable(number_rows(z, by, [F.col("i")], "_at").withColumn("slot", F.col("_at") - 1).drop("_at"))
    squares = z.groupBy(*by).agg(F.sum(F.col("z") * F.col("z")).alias("zz"))
    placed = edges.join(bounded(z.select(*by, "i", F.col("slot").alias("si"), "n")), [*by, "i"])
    placed = placed.join(bounded(z.select(*by, F.col("i").alias("j"), F.col("slot").alias("sj"))), [*by, "j"]).select(*by, "si", "sj", "weight", "n")
    group = [placed.schema[c] for c in by]
    dealt = T.StructType([*group, *[T.StructField(c, T.LongType()) for c in ("perm", "ui", "uj")], T.StructField("weight", T.DoubleType())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            si, sj, n = (batch.column(c).to_numpy() for c in ("si", "sj", "n"))
            together = max(1, DEAL_ROWS // max(1, len(n)))
            for low in range(0, permutations + 1, together):  # 0: the values as they are
                perms = np.arange(low, min(low + together, permutations + 1))
                number, edge = np.repeat(perms, len(n)), np.tile(np.arange(len(n)), len(perms))
                ui, uj = (np.where(number == 0, s[edge], permuted(s[edge], n[edge], number, seed)) for s in (si, sj))
                rest = [batch.column(c).take(pa.array(edge)) for c in (*by, "weight")]
                yield pa.RecordBatch.from_arrays([*rest[:-1], pa.array(number), pa.array(ui), pa.array(uj), rest[-1]], names=dealt.names)

    values = z.select(*by, "slot", "z")
    named = lambda slot, name: bounded(values.withColumnsRenamed({"slot": slot, "z": name})).hint("shuffle_hash")
    looked = placed.mapInArrow(deal, dealt).join(named("ui", "z_i"), [*by, "ui"]).join(named("uj", "z_j"), [*by, "uj"])
    sums = looked.groupBy(*by, "perm").agg(F.sum(F.col("weight") * F.col("z_i") * F.col("z_j")).alias("top"))
    scored = sums.join(bounded(squares), by) if by else sums.withColumn("zz", F.lit(squares.first()[0]))
    scored = durable(scored.select(*by, "perm", F.coalesce(F.try_divide("top", "zz"), F.lit(0.0)).alias("i_perm")))
    observed = scored.filter("perm = 0").select(*by, F.col("i_perm").alias("moran_i"))
    simulated = scored.filter("perm > 0")
    simulated = simulated.join(bounded(observed), by) if by else simulated.withColumn("moran_i", F.lit(observed.first()[0]))
    reached = F.count_if(F.col("i_perm") >= F.col("moran_i") - 1e-12)
    tail = F.least(reached, F.lit(permutations) - reached)
    return simulated.groupBy(*by).agg(
        F.first("moran_i").alias("moran_i"), ((tail + 1) / F.lit(float(permutations + 1))).alias("p_sim"), F.avg("i_perm").alias("mean_i_perm")
    )


def band_places(points: DataFrame, value: str, band: float = BAND_DEGREES) -> DataFrame:
    """Per distinct place: points, sums of z, and the neighbour sums within ``band``.

    Epicentres that are means of station positions often coincide. Points of a place share their
    neighbours, so pairs are made of places, not of points, and a crowded place stays one row. For a
    point with value z: lag = (p - w z) / q, where w is the weight of a coincident point.
    """
    z = centred(durable(points), value)
    places = durable(
        z.groupBy("latitude", "longitude").agg(F.count(F.lit(1)).alias("n"), F.sum("z").alias("s"), F.sum(F.col("z") * F.col("z")).alias("ss"))
    )
    pairs = cell_pairs(places, places, "latitude", "longitude", band, band).withColumn(
        "d", planar("latitude", "longitude", "latitude_2", "longitude_2")
    )
    near = pairs.filter((F.col("d") <= band) & (F.col("d") > 0)).withColumn("w", band_weight(F.col("d")))
    around = near.groupBy("latitude", "longitude").agg(F.sum(F.col("w") * F.col("s_2")).alias("a"), F.sum(F.col("w") * F.col("n_2")).alias("b"))
    w = 1 / SAME_PLACE_DEGREES
    zero = F.lit(0.0)
    return places.join(around, ["latitude", "longitude"], "left").select(
        "latitude",
        "longitude",
        "n",
        "s",
        "ss",
        (F.coalesce("a", zero) + w * F.col("s")).alias("p"),
        (F.coalesce("b", zero) + w * (F.col("n") - 1)).alias("q"),
    )


def moran_global_band(points: DataFrame, value: str, band: float = BAND_DEGREES) -> DataFrame:
    """One row: Moran's I with weights 1 / distance within ``band`` degrees, scaled to 1 per point."""
    places = band_places(points, value, band)
    top = F.coalesce(F.try_divide(F.col("p") * F.col("s") - F.col("ss") / SAME_PLACE_DEGREES, F.col("q")), F.lit(0.0))
    sums = places.agg(F.sum(top).alias("top"), F.sum("ss").alias("bottom"), F.sum("n").alias("n"))
    return sums.select(F.coalesce(F.try_divide("top", "bottom"), F.lit(0.0)).alias("moran_i"), "n")


def lisa_class(z: Column, lag: Column) -> Column:
    """Quadrant of a point; whatever is in no other quadrant, also without neighbours, is Low-High."""
    return (
        F.when((z > 0) & (lag > 0), HIGH_HIGH).when((z < 0) & (lag < 0), LOW_LOW).when((z > 0) & (lag < 0), HIGH_LOW).otherwise(LOW_HIGH)
    )


def lisa_local(points: DataFrame, key: str, value: str, band: float = BAND_DEGREES) -> DataFrame:
    """Local Moran of each point, z / (mean of z squared) times its lag, and its class."""
    points = durable(points)
    places = durable(band_places(points, value, band))
    total = places.agg(F.sum("ss").alias("ss"), F.sum("n").alias("n")).first()
    mean_square = (total["ss"] or 0.0) / max(total["n"] or 1, 1)
    lag = F.coalesce(F.try_divide(F.col("p") - F.col("z") / SAME_PLACE_DEGREES, F.col("q")), F.lit(0.0))
    joined = centred(points, value).join(bounded(places.select("latitude", "longitude", "p", "q")), ["latitude", "longitude"])
    local = F.lit(0.0) if mean_square == 0 else F.col("z") / mean_square * F.col("lag")
    return joined.withColumn("lag", lag).select(key, "z", "lag", local.alias("local_moran"), lisa_class(F.col("z"), F.col("lag")).alias("lisa_class"))


def hourly_distance_bearing(picks: DataFrame, stations: DataFrame, centre: tuple[float, float] = CENTRE) -> DataFrame:
    """Per hour: distance of the centroid from the centre, and mean bearing of the picks seen from it."""
    spatial = hourly_spatial(picks, stations).select("hour", "mean_latitude", "mean_longitude")
    placed = join_station_dim(picks, stations.select("station_code", "latitude", "longitude")).filter(F.col("latitude").isNotNull())
    turned = placed.groupBy(F.date_trunc("hour", "arrival_iso").alias("hour")).agg(
        mean_bearing(bearing_deg(centre[0], centre[1], "latitude", "longitude")).alias("direzione_da_centro_deg")
    )
    distance = haversine_km(centre[0], centre[1], "mean_latitude", "mean_longitude")
    return spatial.join(turned, "hour").select("hour", distance.alias("distanza_da_centro_km"), "direzione_da_centro_deg")
