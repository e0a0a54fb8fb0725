"""Geographic column expressions: distances, bearings, transverse Mercator, grid cells."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

EARTH_KM = 6371.0  # fixed value: mean Earth radius
KM_PER_DEGREE = 111.32  # fixed value: one degree of latitude

# WGS 84 ellipsoid and the UTM grid.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_SCALE = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_ZONE_33_MERIDIAN = 15.0


def _col(c: str | Column | float) -> Column:
    if isinstance(c, Column):
        return c
    return F.col(c) if isinstance(c, str) else F.lit(float(c))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance on a sphere of 6371 km."""
    lat1, lon1, lat2, lon2 = map(_col, (lat1, lon1, lat2, lon2))
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


def bearing_deg(lat1, lon1, lat2, lon2) -> Column:
    """Initial bearing from the first to the second point, 0 to 360, north = 0."""
    lat1, lon1, lat2, lon2 = map(_col, (lat1, lon1, lat2, lon2))
    turn = F.radians(lon2 - lon1)
    east = F.sin(turn) * F.cos(F.radians(lat2))
    north = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(turn)
    return F.pmod(F.degrees(F.atan2(east, north)) + 360.0, F.lit(360.0))


def mean_bearing(bearing: str | Column) -> Column:
    """Aggregate: circular mean of bearings in degrees; 0 for no rows or for no clear direction."""
    angle = F.radians(_col(bearing))
    east, north = F.avg(F.sin(angle)), F.avg(F.cos(angle))
    clear = F.sqrt(east * east + north * north) >= 1e-12
    return F.coalesce(F.when(clear, F.pmod(F.degrees(F.atan2(east, north)) + 360.0, F.lit(360.0))), F.lit(0.0))


def _third_flattening() -> float:
    return WGS84_F / (2 - WGS84_F)


def kruger_forward() -> list[float]:
    """Published series coefficients alpha 1..4 of the transverse Mercator projection in n."""
    n = _third_flattening()
    return [
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140,
        49561 * n**4 / 161280,
    ]


def kruger_inverse() -> list[float]:
    """Published series coefficients beta 1..4 of the inverse projection in n."""
    n = _third_flattening()
    return [
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
        n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
        17 * n**3 / 480 - 37 * n**4 / 840,
        4397 * n**4 / 161280,
    ]


def rectifying_radius() -> float:
    n = _third_flattening()
    return WGS84_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)


def project_utm(lat, lon, meridian: float = UTM_ZONE_33_MERIDIAN) -> tuple[Column, Column]:
    """(easting, northing) in metres on the northern UTM grid; below a millimetre inside the zone."""
    lat, lon = _col(lat), _col(lon)
    e = math.sqrt(WGS84_F * (2 - WGS84_F))
    turn = F.radians(lon - meridian)
    sine = F.sin(F.radians(lat))
    tau = F.sinh(F.atanh(sine) - F.lit(e) * F.atanh(F.lit(e) * sine))
    xi = F.atan2(tau, F.cos(turn))
    eta = F.asinh(F.sin(turn) / F.sqrt(tau * tau + F.cos(turn) * F.cos(turn)))
    x, y = eta, xi
    for k, a in enumerate(kruger_forward(), start=1):
        x = x + F.lit(a) * F.cos(xi * (2 * k)) * F.sinh(eta * (2 * k))
        y = y + F.lit(a) * F.sin(xi * (2 * k)) * F.cosh(eta * (2 * k))
    scale = UTM_SCALE * rectifying_radius()
    return F.lit(UTM_FALSE_EASTING) + F.lit(scale) * x, F.lit(scale) * y


def unproject_utm(easting, northing, meridian: float = UTM_ZONE_33_MERIDIAN) -> tuple[Column, Column]:
    """(latitude, longitude) in degrees from the northern UTM grid."""
    scale = UTM_SCALE * rectifying_radius()
    y = _col(northing) / F.lit(scale)
    x = (_col(easting) - UTM_FALSE_EASTING) / F.lit(scale)
    xi, eta = y, x
    for k, b in enumerate(kruger_inverse(), start=1):
        xi = xi - F.lit(b) * F.sin(y * (2 * k)) * F.cosh(x * (2 * k))
        eta = eta - F.lit(b) * F.cos(y * (2 * k)) * F.sinh(x * (2 * k))
    conformal = F.sin(xi) / F.cosh(eta)
    e = math.sqrt(WGS84_F * (2 - WGS84_F))
    iso = F.atanh(conformal)
    sine = conformal
    for _ in range(5):  # converges by a factor e^2 (0.0067) a step
        sine = F.tanh(iso + F.lit(e) * F.atanh(F.lit(e) * sine))
    return F.degrees(F.asin(sine)), F.lit(meridian) + F.degrees(F.atan2(F.sinh(eta), F.cos(xi)))


def cell(coord, size: float) -> Column:
    """Index of the grid cell of width ``size`` that holds a coordinate."""
    return F.floor(_col(coord) / F.lit(float(size)))


def inside_polygon(lat, lon, corners: list[tuple[float, float]]) -> Column:
    """Even-odd test against a literal polygon of (lat, lon) corners, boundary counted as inside."""
    lat, lon = _col(lat), _col(lon)
    crossings, on_edge = F.lit(0), F.lit(False)
    for (lat1, lon1), (lat2, lon2) in zip(corners, corners[1:] + corners[:1]):
        turn = (lon - lon1) * (lat2 - lat1) - (lat - lat1) * (lon2 - lon1)
        within = lat.between(min(lat1, lat2), max(lat1, lat2)) & lon.between(min(lon1, lon2), max(lon1, lon2))
        on_edge = on_edge | ((F.abs(turn) <= 1e-12) & within)
        if lat1 != lat2:
            at = lon1 + (lat - lat1) * (lon2 - lon1) / (lat2 - lat1)
            spans = (lat >= min(lat1, lat2)) & (lat < max(lat1, lat2))
            crossings = crossings + F.when(spans & (lon < at), 1).otherwise(0)
    return on_edge | (crossings % 2 == 1)


def parse_polygon(text: str) -> list[tuple[float, float]]:
    """``"lat,lon lat,lon ..."`` with at least three corners."""
    corners = [tuple(float(v) for v in pair.split(",")) for pair in text.split()]
    if len(corners) < 3 or any(len(c) != 2 for c in corners):
        raise ValueError(f"a polygon needs at least three 'lat,lon' corners: {text!r}")
    return corners
