"""Scalar column expressions on codes, times, alerts and amplitudes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Level names with their lowest risk, highest first.
ALERT_LEVELS = [("CRITICAL", 0.95), ("HIGH", 0.80), ("MEDIUM", 0.60)]
SEVERITY_CLASSES = [("critical", 0.85), ("high", 0.65), ("medium", 0.40)]
LOWEST_LEVEL, LOWEST_SEVERITY = "LOW", "low"
FREQUENCY_BANDS = ["very_low", "low", "medium", "high", "very_high"]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_code(code: str | Column) -> Column:
    return F.upper(F.trim(_col(code)))


def station_id_parts(station_id: str | Column) -> dict[str, Column]:
    """Network, station and channel of ``NET.STA[.LOC].CHAN``; fewer than two parts is an error."""
    parts = F.split(normalize_code(station_id), r"\.")
    valid = F.size(parts) >= 2
    bad = F.raise_error(F.concat(F.lit("station id without network and station: "), _col(station_id))).cast("string")
    return {
        "network": F.when(valid, F.get(parts, F.lit(0))).otherwise(bad),
        "station_code": F.get(parts, F.lit(1)),
        "channel": F.when(F.size(parts) >= 3, F.element_at(parts, -1)),
    }


def sanitize_name(name: str | Column) -> Column:
    """Every run of characters that a file name should not have becomes one underscore."""
    return F.regexp_replace(_col(name), r"[^A-Za-z0-9_.-]+", "_")


def file_key(time: str | Column, network: str | Column, station: str | Column, channel: str | Column) -> Column:
    stamp = F.date_format(_col(time), "yyyyMMdd'T'HHmmss")
    return F.concat_ws("_", stamp, *[sanitize_name(c) for c in (network, station, channel)])


def parse_mixed_time(text: str | Column) -> Column:
    """ISO text (has ``+``, ``T`` or ``:``) or epoch seconds to a timestamp, NULL if it is neither."""
    text = F.trim(_col(text))
    seconds = text.try_cast("double")
    return F.when(text.rlike("[+T:]"), F.try_to_timestamp(text)).otherwise(
        F.timestamp_micros(F.round(seconds * 1e6).cast("long"))
    )


def require_times(df: DataFrame, id_col: str, time_col: str) -> DataFrame:
    """Fail with the number of rows whose time could not be read, and the first and last of them by ``id_col``.

    The complete list is the rows of ``df`` whose ``time_col`` is NULL.
    """
    bad = df.filter(F.col(time_col).isNull()).agg(F.count(F.lit(1)), F.min(id_col), F.max(id_col)).first()
    if bad[0]:
        raise ValueError(f"unreadable time in {bad[0]} rows, from {bad[1]} to {bad[2]}")
    return df


def epoch_of(time: str | Column) -> Column:
    return F.unix_micros(_col(time)) / 1e6


def time_of(epoch: str | Column) -> Column:
    return F.timestamp_micros(F.round(_col(epoch) * 1e6).cast("long"))


def iso_text(time: str | Column) -> Column:
    return F.date_format(_col(time), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def calendar_features(time: str | Column, dialect: str = "sql") -> dict[str, Column]:
    """Hour, weekday, night and weekend flags.

    ``sql``: Sunday is 0 and night is from 22 through hour 6. ``frame``: Monday is 0 and night is 22 to 5.
    """
    time = _col(time)
    hour = F.hour(time)
    weekday = F.dayofweek(time) - 1 if dialect == "sql" else F.weekday(time)
    weekend = weekday.isin(0, 6) if dialect == "sql" else weekday.isin(5, 6)
    last_night_hour = 6 if dialect == "sql" else 5
    return {
        "ora_del_giorno": hour,
        "giorno_della_settimana": weekday,
        "is_notte": ((hour >= 22) | (hour <= last_night_hour)).cast("int"),
        "is_weekend": weekend.cast("int"),
    }


def _class_of(value: Column, steps: Sequence[tuple[str, float]], lowest: str) -> Column:
    return F.coalesce(*[F.when(value >= limit, F.lit(name)) for name, limit in steps], F.lit(lowest))


def alert_level(risk: str | Column, steps: Sequence[tuple[str, float]] = tuple(ALERT_LEVELS)) -> Column:
    return _class_of(_col(risk), steps, LOWEST_LEVEL)


def severity_class(risk: str | Column) -> Column:
    """The dashboard's scale; it differs from ``alert_level`` on purpose."""
    return _class_of(_col(risk), SEVERITY_CLASSES, LOWEST_SEVERITY)


def alert_message(level: str | Column, risk: str | Column, stations: str | Column) -> Column:
    """The risk is rounded from its exact binary value, half to even, not from its shortest decimal."""
    shown = F.call_function("format_number", _col(risk), F.lit("0.00"))
    parts = [F.lit("Alert: "), _col(level), F.lit(" - Risk: "), shown, F.lit(" - Stations: "), _col(stations).cast("string")]
    return F.concat(*parts)


def log_amplitude(value: str | Column) -> Column:
    return F.log1p(F.abs(_col(value)))


def freq_band(value: str | Column, low: Column, high: Column) -> Column:
    """Five equal-width, right-closed bins from ``low`` to ``high``; the lowest bin takes ``low`` itself."""
    width = (high - low) / len(FREQUENCY_BANDS)
    index = F.greatest(F.least(F.ceil(F.try_divide(_col(value) - low, width)), F.lit(len(FREQUENCY_BANDS))), F.lit(1))
    return F.get(F.array(*[F.lit(b) for b in FREQUENCY_BANDS]), (index - 1).cast("int"))


def waveform_derived(df: DataFrame) -> DataFrame:
    """amplitude_range, snr, hour and minute from columns max, min, std and starttime."""
    spread = F.col("max") - F.col("min")
    return df.select(
        "*",
        spread.alias("amplitude_range"),
        (F.col("std") / (spread + 1e-10)).alias("snr"),
        F.hour("starttime").alias("hour"),
        F.minute("starttime").alias("minute"),
    )


def alert_from_json(text: str | Column) -> dict[str, Column]:
    """Type and time of a logged alert, NULL where the text has none."""
    text = _col(text)
    return {
        "type": F.get_json_object(text, "$.type"),
        "timestamp": F.try_to_timestamp(F.get_json_object(text, "$.timestamp")),
    }


def alert_json(*fields: Column) -> Column:
    """A log line of the named fields; fields without a value are left out."""
    return F.to_json(F.struct(*fields))
