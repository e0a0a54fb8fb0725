"""Queries for spatial statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tremorlake.operators import aggregates as A, spatial as S
from tremorlake.operators.joins import join_knn
from tremorlake.queries import query
from tremorlake.queries.aggregate_queries import BEARING, EPICENTRES, HAVERSINE, PLACED
from tremorlake.queries.join_queries import ALL_MEANS, RUN_MEANS, all_means, every_run, run_means

KNN = """pairs AS (SELECT a.station_code AS i, b.station_code AS j, (b.easting - a.easting) * (b.easting - a.easting)
    + (b.northing - a.northing) * (b.northing - a.northing) AS d2 FROM base a JOIN base b ON a.station_code <> b.station_code),
  knn AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY i ORDER BY d2, j) <= 5),
  zs AS (SELECT station_code, delta_value - (SELECT avg(delta_value) FROM base) AS z FROM base)"""


@query(
    "moran_global_knn",
    "picks stations",
    f""", {ALL_MEANS}, {KNN}, lagged AS (SELECT i, sum(0.2e0 * z) AS lag FROM knn JOIN zs ON j = station_code GROUP BY i)
    SELECT sum(z * lag) / sum(z * z) AS moran_i, -1e0 / (count(*) - 1) AS expected_i, count(*) AS n FROM zs JOIN lagged ON i = station_code""",
    "moran_i expected_i",
)
def _(t):
    return S.moran_global_knn(all_means(t), "station_code", "delta_value", 5, ("easting", "northing"))


@query(
    "moran_global_knn_runs",
    "picks stations",
    f""", {RUN_MEANS}, pairs AS (SELECT a.run_id, a.station_code AS i, b.station_code AS j, (b.easting - a.easting) * (b.easting - a.easting)
      + (b.northing - a.northing) * (b.northing - a.northing) AS d2 FROM points a JOIN points b ON a.run_id = b.run_id AND a.station_code <> b.station_code),
    knn AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY run_id, i ORDER BY d2, j) <= 5),
    zs AS (SELECT run_id, station_code, delta_value - avg(delta_value) OVER (PARTITION BY run_id) AS z FROM points),
    lagged AS (SELECT knn.run_id, i, sum(0.2e0 * z) AS lag FROM knn JOIN zs ON zs.run_id = knn.run_id AND j = station_code GROUP BY 1, 2)
    SELECT zs.run_id, sum(z * lag) / sum(z * z) AS moran_i, -1e0 / (count(*) - 1) AS expected_i, count(*) AS n
    FROM zs JOIN lagged ON lagged.run_id = zs.run_id AND i = station_code GROUP BY 1""",
    "moran_i expected_i",
)
def _(t):
    return every_run(t, lambda means: S.moran_global_knn(means, "station_code", "delta_value", 5, ("easting", "northing")))


def _step(x: str) -> str:
    """One pass of the permutation over ``x``, as columns of a select that may use the ones before them."""
    p, sides = S.FEISTEL_PRIME, {0: ("r", "l", "a"), 1: ("l", "r", "b")}
    out = [f"{x} // b AS l0", f"{x} % b AS r0"]
    for r in range(S.FEISTEL_ROUNDS):
        read, made, size = sides[r % 2]
        old, new = r // 2, r // 2 + 1
        v = f"{read}{old if r % 2 == 0 else new}"
        out += [f"({v} * 1000003 + ((42 * 7919 + perm) * 31 + {r}) * {S.FEISTEL_KEY} % {p}) % {p} AS t{r}"]
        out += [f"({made}{old} + t{r} * t{r} % {p} * (t{r} + 11) % {p}) % {size} AS {made}{new}"]
    last = S.FEISTEL_ROUNDS // 2
    return ", ".join([*out, f"l{last} * b + r{last} AS made"])


@query(
    "moran_permutation_p",
    "picks stations",
    f""", {RUN_MEANS}, pairs AS (SELECT a.run_id, a.station_code AS i, b.station_code AS j, (b.easting - a.easting) * (b.easting - a.easting)
      + (b.northing - a.northing) * (b.northing - a.northing) AS d2 FROM points a JOIN points b ON a.run_id = b.run_id AND a.station_code <> b.station_code),
    knn AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY run_id, i ORDER BY d2, j) <= 5),
    zs AS (SELECT run_id, station_code, delta_value - avg(delta_value) OVER (PARTITION BY run_id) AS z, count(*) OVER (PARTITION BY run_id) AS n,
      row_number() OVER (PARTITION BY run_id ORDER BY station_code) - 1 AS slot FROM points),
    sized AS (SELECT *, ceil(sqrt(n))::BIGINT AS a, (n + ceil(sqrt(n))::BIGINT - 1) // ceil(sqrt(n))::BIGINT AS b FROM zs),
    chain(run_id, perm, slot, n, a, b, made) AS (
      SELECT run_id, perm, slot, n, a, b, made FROM (SELECT *, {_step('slot')} FROM sized, (SELECT unnest(generate_series(1, 999)) AS perm) p)
      UNION ALL SELECT run_id, perm, slot, n, a, b, again FROM (SELECT c.run_id, c.perm, c.slot, c.n, c.a, c.b, {_step('c.made')[:-len(' AS made')]} AS again FROM chain c WHERE c.made >= c.n)),
    dealt AS (SELECT c.run_id, c.perm, s.station_code, v.z FROM chain c JOIN zs s ON s.run_id = c.run_id AND s.slot = c.slot
      JOIN zs v ON v.run_id = c.run_id AND v.slot = c.made WHERE c.made < c.n UNION ALL SELECT run_id, 0, station_code, z FROM zs),
    scored AS (SELECT k.run_id, a.perm, sum(0.2e0 * a.z * b.z) / any_value(q.zz) AS i_perm FROM knn k
      JOIN dealt a ON a.run_id = k.run_id AND a.station_code = k.i JOIN dealt b ON b.run_id = k.run_id AND b.station_code = k.j AND b.perm = a.perm
      JOIN (SELECT run_id, sum(z * z) AS zz FROM zs GROUP BY 1) q ON q.run_id = k.run_id GROUP BY 1, 2),
    counted AS (SELECT s.run_id, any_value(o.i_perm) AS moran_i, count(*) FILTER (s.i_perm >= o.i_perm - 1e-12) AS reached, avg(s.i_perm) AS mean_i_perm
      FROM scored s JOIN scored o ON o.run_id = s.run_id AND o.perm = 0 WHERE s.perm > 0 GROUP BY 1)
    SELECT run_id, moran_i, (least(reached, 999 - reached) + 1) / 1000e0 AS p_sim, mean_i_perm FROM counted""",
    "moran_i p_sim mean_i_perm",
)
def _(t):
    coords = ("easting", "northing")
    edges = every_run(t, lambda means: join_knn(means, "station_code", 5, coords))
    return S.moran_permutation_p(run_means(t), "station_code", "delta_value", 5, coords, edges=edges, by=["run_id"]).select(
        "run_id", "moran_i", "p_sim", "mean_i_perm"
    )


BAND = f"""{EPICENTRES}, spots AS (SELECT event_id, round(latitude, 9) AS latitude, round(longitude, 9) AS longitude,
    n_stations - (SELECT avg(n_stations) FROM epicentres) AS z FROM epicentres),
  near AS (SELECT a.event_id AS i, b.z, sqrt((b.latitude - a.latitude) * (b.latitude - a.latitude)
    + (b.longitude - a.longitude) * (b.longitude - a.longitude)) AS d FROM spots a JOIN spots b
    ON a.event_id <> b.event_id AND abs(a.latitude - b.latitude) <= 0.016e0 AND abs(a.longitude - b.longitude) <= 0.016e0),
  lags AS (SELECT i, sum(z / CASE WHEN d = 0 THEN 1e-6 ELSE d END) / sum(1 / CASE WHEN d = 0 THEN 1e-6 ELSE d END) AS lag
    FROM near WHERE d <= 0.015e0 GROUP BY i),
  joined AS (SELECT event_id, z, coalesce(lag, 0) AS lag FROM spots LEFT JOIN lags ON i = event_id)"""


def epicentres(t):
    made = A.event_epicenter(t.picks, t.stations)
    return made.withColumns({"latitude": F.round("latitude", 9), "longitude": F.round("longitude", 9)})


@query(
    "moran_global_band",
    "picks stations",
    f", {BAND} SELECT sum(z * lag) / sum(z * z) AS moran_i, count(*) AS n FROM joined",
    "moran_i:7",
)
def _(t):
    return S.moran_global_band(epicentres(t), "n_stations")


@query(
    "lisa_local",
    "picks stations",
    f""", {BAND} SELECT event_id, z, lag, z / (SELECT avg(z * z) FROM joined) * lag AS local_moran,
    CASE WHEN z > 0 AND round(lag, 6) > 0 THEN 'High-High (Hotspot)' WHEN z < 0 AND round(lag, 6) < 0 THEN 'Low-Low (Coldspot)'
      WHEN z > 0 AND round(lag, 6) < 0 THEN 'High-Low (Outlier)' ELSE 'Low-High (Outlier)' END AS lisa_class FROM joined""",
    "z:8 lag:5 local_moran:4",
)
def _(t):
    return S.lisa_local(epicentres(t), "event_id", "n_stations")


_FROM_CENTRE = {"lat1": "40.8062e0", "lon1": "14.1410e0"}


@query(
    "hourly_distance_bearing",
    "picks stations",
    f""", {PLACED}, turned AS (SELECT date_trunc('hour', arrival_iso) AS hour, latitude, longitude,
      radians({BEARING.format(**_FROM_CENTRE, lat2="latitude", lon2="longitude")}) AS b FROM placed),
    means AS (SELECT hour, avg(latitude) AS la, avg(longitude) AS lo, avg(sin(b)) AS e, avg(cos(b)) AS n FROM turned GROUP BY hour)
    SELECT hour, {HAVERSINE.format(**_FROM_CENTRE, lat2="la", lon2="lo")} AS distanza_da_centro_km,
      CASE WHEN sqrt(e * e + n * n) < 1e-12 THEN 0e0 ELSE (degrees(atan2(e, n)) + 360) % 360 END AS direzione_da_centro_deg FROM means""",
    "distanza_da_centro_km:7 direzione_da_centro_deg:6",
)
def _(t):
    return S.hourly_distance_bearing(t.picks, t.stations)
