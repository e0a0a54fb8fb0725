"""Column aliases, coercion, checks, filters and cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tremorlake.functions.geo import KM_PER_DEGREE, inside_polygon, parse_polygon, project_utm
from tremorlake.functions.scalars import severity_class, time_of
from tremorlake.operators.aggregates import null_cells
from tremorlake.scale import bounded, exact_quantiles

# Column aliases, target name first, in order of preference.
ALERT_ALIASES = {
    "timestamp": ["timestamp", "time", "datetime", "created_at", "alert_time"],
    "station": ["station", "station_code", "station_id"],
    "risk_score": ["risk_score", "risk", "score", "probability"],
    "latitude": ["latitude", "lat"],
    "longitude": ["longitude", "lon", "lng"],
}
SPATIAL_ALIASES = {"easting": ["easting", "x_m"], "northing": ["northing", "y_m"], "station_code": ["station_code", "station"]}
EPOCH_FALLBACKS = ["event_reference_epoch", "arrival_epoch", "start_epoch", "end_epoch", "time_epoch"]
VALUE_CANDIDATES = ["delta_seconds", "base_mean", "soft_mean", "base_median", "soft_median"]
SEVERITY_WORDS = {"warn": "medium", "alert": "high"}
UNKNOWN_STATION = "UNKNOWN"
ANOMALY_SECONDS = 0.5
SELECT_RADIUS = (40.82, 14.14, 20.0)  # latitude, longitude, kilometres


class CheckFailed(ValueError):
    """Data that breaks a contract."""


def alias_columns(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rename the first alias that is present to its target; other aliases of the target are dropped."""
    out = df
    for target, names in aliases.items():
        present = [n for n in names if n in out.columns]
        if not present:
            continue
        out = out.drop(*present[1:]).withColumnRenamed(present[0], target)
    return out


def coerce_types(df: DataFrame, types: Mapping[str, str], keys: Sequence[str] = ()) -> DataFrame:
    """Cast with bad values as NULL, then drop rows with a NULL key."""
    cast = {}
    for name, kind in types.items():
        is_text = isinstance(df.schema[name].dataType, T.StringType)
        cast[name] = F.try_to_timestamp(F.col(name)) if kind == "timestamp" and is_text else F.col(name).try_cast(kind)
    out = df.withColumns(cast)
    return out.dropna(subset=list(keys)) if keys else out


def fallback_time(df: DataFrame, time: str = "timestamp", epochs: Sequence[str] = EPOCH_FALLBACKS, mtime: str = "source_mtime") -> DataFrame:
    """If no row has a time: use the first epoch column with any number, else the file's change time."""
    present = [c for c in epochs if c in df.columns]
    counts = [F.count(time).alias("_known")] + [F.count(F.col(c).try_cast("double")).alias(c) for c in present]
    known = df.agg(*counts).first()
    if known["_known"]:
        return df
    for c in present:
        if known[c]:
            return df.withColumn(time, time_of(F.col(c).try_cast("double")))
    return df.withColumn(time, F.col(mtime)) if mtime in df.columns else df


def normalize_alerts(df: DataFrame) -> DataFrame:
    """Alerts of any known layout as timestamp, station, risk, severity, position, message.

    A row without a severity gets the class of its risk, one without a station or message the default of a table without that column.
    """
    out = alias_columns(df, ALERT_ALIASES)
    have = set(out.columns)
    if "timestamp" not in have:
        out = out.withColumn("timestamp", F.lit(None).cast("timestamp"))
    elif isinstance(out.schema["timestamp"].dataType, T.StringType):
        out = out.withColumn("timestamp", F.try_to_timestamp(F.col("timestamp")))
    out = fallback_time(out)
    risk = F.coalesce(F.col("risk_score").try_cast("double"), F.lit(0.0)) if "risk_score" in have else F.lit(0.0)
    risk = F.greatest(F.lit(0.0), F.least(F.lit(1.0), risk))
    out = out.withColumn("risk_score", risk)
    if "severity" in have:
        word = F.lower(F.col("severity").cast("string"))
        severity = word
        for old, new in SEVERITY_WORDS.items():
            severity = F.when(word == old, new).otherwise(severity)
        severity = F.coalesce(severity, severity_class("risk_score"))
    else:
        severity = severity_class("risk_score")
    kept = [
        "timestamp",
        (F.coalesce(F.col("station").cast("string"), F.lit(UNKNOWN_STATION)) if "station" in have else F.lit(UNKNOWN_STATION)).alias("station"),
        "risk_score",
        severity.alias("severity"),
        *[(F.col(c).try_cast("double") if c in have else F.lit(None).cast("double")).alias(c) for c in ("latitude", "longitude")],
        (F.coalesce(F.col("message"), F.lit("")) if "message" in have else F.lit("")).alias("message"),
    ]
    return out.select(*kept, *([F.col("source_file")] if "source_file" in have else []))


def pick_value_column(df: DataFrame, requested: str | None = None) -> DataFrame:
    """``delta_seconds`` from the requested or first candidate column; any unusable value is an error."""
    if requested is not None and requested not in df.columns:
        raise CheckFailed(f"no column {requested}")
    name = requested or next((c for c in VALUE_CANDIDATES if c in df.columns), None)
    if name is None:
        raise CheckFailed(f"no value column among {', '.join(VALUE_CANDIDATES)}; there are {', '.join(df.columns)}")
    number = F.col(name).try_cast("double")
    if df.filter(number.isNull() | F.isnan(number)).limit(1).count():
        raise CheckFailed(f"column {name} has values that are missing or no numbers")
    return df.withColumn("delta_seconds", number)


def filter_in_list(df: DataFrame, wanted: Mapping[str, Sequence[str] | DataFrame]) -> DataFrame:
    """Keep rows whose upper-cased code is listed; an empty result is an error.

    A list may be a Python sequence, or a one-column table of any size.
    """
    out = df
    for column, codes in wanted.items():
        code = F.upper(F.trim(F.col(column)))
        if isinstance(codes, DataFrame):
            side = codes.select(F.upper(F.trim(F.col(codes.columns[0]))).alias("_code")).distinct()
            out = out.withColumn("_code", code).join(bounded(side), "_code", "left_semi").drop("_code")
        else:
            out = out.filter(code.isin([c.strip().upper() for c in codes]))
    if out.isEmpty():
        raise CheckFailed(f"no rows left for {', '.join(wanted)}")
    return out


def filter_component(df: DataFrame, component: str, channel: str = "channel") -> DataFrame:
    """Keep channels whose last letter is the component."""
    return df.filter(F.upper(F.substring(F.col(channel), -1, 1)) == component.upper())


def filter_delta_range(df: DataFrame, low: float, high: float, station: str = "", value: str = "delta_seconds") -> DataFrame:
    out = df.filter(F.col(value).between(low, high))
    return out.filter(F.contains(F.upper("station_code"), F.lit(station.upper()))) if station else out


def filter_radius(df: DataFrame, lat: float, lon: float, km: float) -> DataFrame:
    """Rows within ``km`` of a point on the metric grid, boundary included.

    A latitude / longitude box first, so that the scan can skip row groups.
    """
    import math

    reach_lat = km / KM_PER_DEGREE * 1.01
    reach_lon = reach_lat / max(math.cos(math.radians(min(89.0, abs(lat) + reach_lat))), 0.01)
    boxed = df.filter(F.col("latitude").between(lat - reach_lat, lat + reach_lat) & F.col("longitude").between(lon - reach_lon, lon + reach_lon))
    x, y = project_utm("latitude", "longitude")
    x0, y0 = project_utm(float(lat), float(lon))
    return boxed.filter((x - x0) * (x - x0) + (y - y0) * (y - y0) <= (km * 1000.0) ** 2)


def filter_polygon(df: DataFrame, polygon: str) -> DataFrame:
    """Rows inside ``"lat,lon lat,lon ..."``, boundary included."""
    return df.filter(inside_polygon("latitude", "longitude", parse_polygon(polygon)))


def check_coordinates(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """One row of violation counts: outside the globe, and NULL."""
    return df.agg(
        F.count_if(~F.col(lat).between(-90, 90)).alias("bad_latitude"),
        F.count_if(~F.col(lon).between(-180, 180)).alias("bad_longitude"),
        F.count_if(F.col(lat).isNull() | F.col(lon).isNull()).alias("missing"),
    )


def check_numeric_range(df: DataFrame, column: str, low: float = 0, high: float = 100) -> DataFrame:
    return df.agg(
        F.count_if(~F.col(column).between(low, high)).alias("out_of_range"), F.count_if(F.col(column).isNull()).alias("missing")
    )


def require_coordinates(df: DataFrame, lat: str = "latitude", lon: str = "longitude", allow_nulls: bool = False) -> DataFrame:
    for column in (lat, lon):
        if column not in df.columns:
            raise CheckFailed(f"missing column {column}")
    found = check_coordinates(df, lat, lon).first()
    if found["missing"] and not allow_nulls:
        raise CheckFailed(f"{found['missing']} rows without coordinates")
    if found["bad_latitude"]:
        raise CheckFailed(f"{found['bad_latitude']} latitudes outside [-90, 90]")
    if found["bad_longitude"]:
        raise CheckFailed(f"{found['bad_longitude']} longitudes outside [-180, 180]")
    return df


def require_numeric_range(df: DataFrame, column: str, low: float = 0, high: float = 100, allow_nulls: bool = False) -> DataFrame:
    if column not in df.columns:
        raise CheckFailed(f"missing column {column}")
    found = check_numeric_range(df, column, low, high).first()
    if found["missing"] and not allow_nulls:
        raise CheckFailed(f"{found['missing']} NULLs in {column}")
    if found["out_of_range"]:
        raise CheckFailed(f"{found['out_of_range']} values of {column} outside [{low}, {high}]")
    return df


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def uncastable(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Per column: rows, and values that its type cannot take."""
    counts = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()).alias(c) for c, kind in types.items()]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *counts)


def check_schema_types(df: DataFrame, required: Sequence[str], types: Mapping[str, str] | None = None) -> tuple[bool, str]:
    """(ok, message): not empty, has the columns, and every typed column can be cast."""
    missing = missing_columns(df, required)
    if missing:
        return False, f"Missing required columns: {', '.join(missing)}"
    found = uncastable(df, {c: k for c, k in (types or {}).items() if c in df.columns}).first().asDict()
    if not found.pop("n_rows"):
        return False, "DataFrame is empty"
    for column, bad in found.items():
        if bad:
            return False, f"Type mismatch for column '{column}': {bad} values"
    return True, "Data validation passed"


def filter_iqr(df: DataFrame, columns: Sequence[str] | None = None, hot_rows: int | None = None) -> DataFrame:
    """For each numeric column in order keep Q1 - 1.5 IQR to Q3 + 1.5 IQR of what is left so far.

    Each pair of bounds is two numbers that become literals, so the scan can push them down.
    """
    if columns is None:
        columns = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    out = df
    for column in columns:
        bounds = exact_quantiles(out, [], column, {"q1": 0.25, "q3": 0.75}, hot_rows).first()
        if bounds is None or bounds["q1"] is None:
            return out.filter(F.lit(False))
        spread = 1.5 * (bounds["q3"] - bounds["q1"])
        out = out.filter((F.col(column) >= bounds["q1"] - spread) & (F.col(column) <= bounds["q3"] + spread))
    return out


def anomaly_class(value: str | Column = "delta_seconds", limit: float = ANOMALY_SECONDS) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value >= limit, "slow").when(value <= -limit, "fast")


def filter_anomaly(df: DataFrame, limit: float = ANOMALY_SECONDS, value: str = "delta_seconds") -> DataFrame:
    """Slow (>= limit) and fast (<= -limit) rows with their class."""
    return df.withColumn("anomaly", anomaly_class(value, limit)).filter(F.col("anomaly").isNotNull())


def drop_sparse_rows(df: DataFrame, max_missing_pct: float = 50.0) -> DataFrame:
    """Drop rows with more NULLs than that share of the columns (one NULL is always allowed)."""
    allowed = max(1, int(len(df.columns) * max_missing_pct / 100))
    return df.filter(null_cells(df.columns) <= allowed)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = False) -> DataFrame:
    """The first (or last) row of each key in ``order``.

    An aggregate, not a window: it combines before the shuffle, so a hot key sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    pick = F.max_by if last else F.min_by
    best = pick(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order])).alias("_row")
    return df.groupBy(*keys).agg(best).select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def drop_duplicates(df: DataFrame, keys: Sequence[str] | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Exact duplicates, or all but the first row of a key in ``order``."""
    return df.distinct() if keys is None else first_per_key(df, keys, order)


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(defaults))


def split_features_target(df: DataFrame, target: str | None = None, drop: Sequence[str] = ()) -> tuple[DataFrame, list[str], str]:
    """Rows with a target, the feature columns (all but target and ``drop``), and the target's name.

    Without a name the last column is the target.
    """
    target = target or df.columns[-1]
    if target not in df.columns:
        raise CheckFailed(f"no target column {target}")
    features = [c for c in df.columns if c != target and c not in drop]
    return df.filter(F.col(target).isNotNull()).select(*features, target), features, target


def filter_time_lookback(df: DataFrame, now: Column, days: int, time: str = "timestamp") -> DataFrame:
    """Rows of the last ``days`` days; the table stays whole if no row has a time."""
    if not df.filter(F.col(time).isNotNull()).limit(1).count():
        return df
    return df.filter(F.col(time) >= now - F.expr(f"INTERVAL {int(days)} DAYS"))
