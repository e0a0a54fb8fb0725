"""Signal and detection operators on tables of one row per sample (keys, n, x).

``n`` counts samples from 0 in a trace. Window functions here run inside bounded pieces of a trace:
time windows, or blocks with enough rows in front of them, never over a trace of any length.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from tremorlake.functions.geo import unproject_utm
from tremorlake.functions.scalars import iso_text
from tremorlake.operators.chains import greedy_anchors
from tremorlake.operators.quality import first_per_key
from tremorlake.scale import HOT_ROWS, bounded, dealt, exact_quantiles, number_rows, spread
from tremorlake.session import durable

# Detection settings.
WINDOW_SECONDS, LEAST_OVERLAP_SECONDS = 3600.0, 60.0
ON_RATIO, OFF_RATIO = 3.0, 1.5
TAPER_SHARE = 0.05
CLUSTER_SECONDS, MIN_STATIONS = 10.0, 3
SEGMENT_SECONDS = 60.0
MARGIN_METRES, VELOCITY_BOUNDS, FIRST_VELOCITY = 15_000.0, (1500.0, 7000.0), 4000.0
BLOCK_ROWS = 200_000
SEGMENTS_PER_GROUP = 64
FIT_STEPS = 200


def sta_lta_lengths(rate: float, sta_seconds: float, lta_seconds: float) -> tuple[int, int]:
    short = max(1, int(sta_seconds * rate))
    return short, max(short + 1, int(lta_seconds * rate))


def with_length(df: DataFrame, keys: Sequence[str], name: str = "npts") -> DataFrame:
    """Rows per trace beside each row."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return df.join(bounded(durable(sizes)), list(keys))


def chunk_windows(
    samples: DataFrame, keys: Sequence[str], rate: float, lta_seconds: float = 20.0, window_seconds: float = WINDOW_SECONDS
) -> DataFrame:
    """Each sample in every window that covers it: adds ``npts``, ``win``, ``pos`` in the window and ``kept``.

    Windows start every (window - overlap) seconds while that is before the last sample; the last
    ones are partial. ``kept`` marks rows that are not repeated by the next window's own zone.
    """
    overlap = max(LEAST_OVERLAP_SECONDS, 3 * lta_seconds)
    if overlap >= window_seconds:
        raise ValueError(f"windows of {window_seconds} s are shorter than their overlap of {overlap} s")
    length, step = round(window_seconds * rate), round((window_seconds - overlap) * rate)
    first = F.greatest(F.lit(0), F.ceil((F.col("n") - length) / step)).cast("long")
    wins = F.sequence(first, F.floor(F.col("n") / step).cast("long"))
    sizes = durable(samples.groupBy(*keys).agg(F.count(F.lit(1)).alias("npts")))
    rows = sizes.agg(F.coalesce(F.sum("npts"), F.lit(0))).first()[0]
    spread = samples.join(bounded(sizes), list(keys)).select("*", F.explode(wins).alias("win"))
    spread = spread.filter(F.col("win") * step < F.col("npts") - 1)
    # what follows sorts by window: no task gets more rows because there are more traces (a row is in length / step windows)
    spread = dealt(spread, [*keys, "win"], -(-rows * length // step))
    begin = F.col("win") * step
    reaches_end = begin + length >= F.col("npts") - 1
    return spread.withColumns({"pos": F.col("n") - begin, "kept": reaches_end | (F.col("n") < begin + step)})


def energy_rms_peak(samples: DataFrame, keys: Sequence[str], value: str = "x") -> DataFrame:
    """Root mean square and largest absolute value per key."""
    x = F.col(value)
    return samples.groupBy(*keys).agg(F.sqrt(F.avg(x * x)).alias("rms"), F.max(F.abs(x)).alias("peak"))


def demean_taper(samples: DataFrame, keys: Sequence[str], pos: str = "pos", value: str = "x", share: float = TAPER_SHARE) -> DataFrame:
    """Subtract the mean of each window and taper both ends by a half cosine.

    ``keys`` must include the window, which bounds the rows of one task. The ratio and the onsets use
    the same partitioning, so a whole detection shuffles its samples once.
    """
    whole = W.partitionBy(*keys)
    joined = samples.select("*", F.avg(value).over(whole).alias("_mean"), F.count(F.lit(1)).over(whole).alias("_n"))
    side = F.floor(F.col("_n") * F.lit(share)).cast("long")
    side = F.when(side * 2 == F.col("_n"), side - 1).otherwise(side)
    depth = F.least(F.col(pos), F.col("_n") - 1 - F.col(pos))
    angle = F.lit(np.pi) * depth / F.greatest(side - 1, F.lit(1))
    weight = F.when(depth < side, 0.5 * (1 - F.cos(angle))).otherwise(1.0)
    return joined.withColumn(value, (F.col(value) - F.col("_mean")) * weight).drop("_mean", "_n")


def window_energy(
    samples: DataFrame, keys: Sequence[str], rate: float, lta_seconds: float = 20.0, window_seconds: float = WINDOW_SECONDS
) -> DataFrame:
    """Root mean square and peak of each window as detection sees it, without its mean and with tapered ends:
    (keys, win, window_seconds from the trace's start, rms, peak). The windows are those of ``chunk_windows``."""
    chunks = chunk_windows(samples, keys, rate, lta_seconds, window_seconds)
    energy = energy_rms_peak(demean_taper(chunks, [*keys, "win"]), [*keys, "win"])
    step = round((window_seconds - max(LEAST_OVERLAP_SECONDS, 3 * lta_seconds)) * rate)
    return energy.select(*keys, "win", (F.col("win") * step / rate).alias("window_seconds"), "rms", "peak")


def sta_lta_ratio(
    samples: DataFrame,
    keys: Sequence[str],
    nsta: int,
    nlta: int,
    pos: str = "pos",
    value: str = "x",
    block_rows: int | None = BLOCK_ROWS,
) -> DataFrame:
    """Classic ratio of the mean squares of the last ``nsta`` and ``nlta`` samples; 0 before it is full.

    Both means are differences of one running sum. It runs in blocks that repeat the nlta - 1 rows in
    front of them, so any trace length is exact; ``block_rows=None`` says that the keys are windows,
    which are bounded already. All-zero stretches are found by an exact count, not
    by a difference of sums: a silent long window has ratio NULL. Traces of at most ``nlta`` samples
    have no rows.
    """
    keys = list(keys)
    if block_rows is None:
        whole = W.partitionBy(*keys)
        rows = samples.withColumn("_n", F.count(F.lit(1)).over(whole)).filter(F.col("_n") > nlta).drop("_n")
        order, at_home = whole.orderBy(pos), F.lit(True)
    else:
        block_rows = max(block_rows, nlta)
        home = F.floor(F.col(pos) / block_rows)
        into_next = F.col(pos) % block_rows >= block_rows - (nlta - 1)
        blocks = F.when(into_next, F.array(home, home + 1)).otherwise(F.array(home))
        long_enough = durable(samples.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > nlta))
        many = long_enough.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
        rows = samples.join(bounded(long_enough.drop("_n")), keys, "left_semi").select("*", F.explode(blocks).alias("_block"))
        rows = dealt(rows, [*keys, "_block"], many)
        order, at_home = W.partitionBy(*keys, "_block").orderBy(pos), F.floor(F.col(pos) / block_rows) == F.col("_block")
    so_far = order.rowsBetween(W.unboundedPreceding, 0)
    x = F.col(value)
    rows = rows.select(
        "*", F.sum(x * x).over(so_far).alias("_e"), F.sum((x != 0).cast("long")).over(so_far).alias("_z")
    )

    def since(c: str, n: int) -> Column:
        return F.col(c) - F.coalesce(F.lag(c, n).over(order), F.lit(0))

    rows = rows.select(
        "*", *[since(c, n).alias(f"{c}{k}") for c in ("_e", "_z") for k, n in (("s", nsta), ("l", nlta))]
    ).filter(at_home)
    short = F.when(F.col("_zs") > 0, F.col("_es") / nsta).otherwise(0.0)
    long = F.when(F.col("_zl") > 0, F.col("_el") / nlta)
    ratio = F.when(F.col(pos) < nlta - 1, 0.0).otherwise(F.try_divide(short, long))
    return rows.withColumn("ratio", ratio).select(*samples.columns, "ratio")


def trigger_onsets(ratios: DataFrame, keys: Sequence[str], on: float = ON_RATIO, off: float = OFF_RATIO, pos: str = "pos") -> DataFrame:
    """Rows where the ratio first exceeds ``on``; a trigger lasts while the ratio stays above ``off``.

    ``keys`` must include the window, which bounds the rows of one task.
    """
    order = W.partitionBy(*keys).orderBy(pos)
    switch = F.when(F.col("ratio") > on, 1).when(F.col("ratio") <= off, 0)
    state = F.coalesce(F.last(switch, ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0)), F.lit(0))
    held = ratios.withColumn("_state", state)
    before = F.coalesce(F.lag("_state").over(order), F.lit(0))
    return held.withColumn("_before", before).filter((F.col("_state") == 1) & (F.col("_before") == 0)).drop("_state", "_before")


def detect_triggers(
    samples: DataFrame,
    keys: Sequence[str],
    rate: float,
    sta_seconds: float,
    lta_seconds: float,
    on: float = ON_RATIO,
    off: float = OFF_RATIO,
    window_seconds: float = WINDOW_SECONDS,
) -> DataFrame:
    """Windows, demean and taper, ratio, onsets; repeats in the overlap are dropped: (keys, seconds)."""
    nsta, nlta = sta_lta_lengths(rate, sta_seconds, lta_seconds)
    windowed = [*keys, "win"]
    chunks = demean_taper(chunk_windows(samples, keys, rate, lta_seconds, window_seconds), windowed)
    onsets = trigger_onsets(sta_lta_ratio(chunks, windowed, nsta, nlta, block_rows=None), windowed, on, off)
    return onsets.filter("kept").select(*keys, "win", (F.col("n") / rate).alias("seconds"))


def with_anchor(rows: DataFrame, anchors: DataFrame, keys: Sequence[str], time: str, window: int) -> DataFrame:
    """Each row with the anchor whose window it is in; by equality on window-sized buckets.

    Anchors are more than a window apart, so a bucket knows at most two.
    """
    width = int(window) + 1
    bucket = F.floor(F.col("anchor") / width)
    homes = anchors.select(*keys, "anchor", F.explode(F.array(bucket, bucket + 1)).alias("_bucket"))
    joined = rows.withColumn("_bucket", F.floor(F.col(time) / width)).join(bounded(homes), [*keys, "_bucket"])
    return joined.filter(F.col(time).between(F.col("anchor"), F.col("anchor") + int(window))).drop("_bucket")


def coincidence_events(
    triggers: DataFrame,
    window_seconds: float = CLUSTER_SECONDS,
    min_stations: int = MIN_STATIONS,
    by: Sequence[str] = (),
    hot_rows: int | None = None,
) -> DataFrame:
    """Triggers of at least ``min_stations`` stations within ``window_seconds`` of a cluster's first one.

    A cluster starts at the first trigger after the one before it closed; a station counts with its
    first trigger only. Clusters are numbered by time from AUTO_EV_0001. Ties go by network, channel.
    """
    by = list(by)
    window = round(window_seconds * 1e6)
    rows = triggers.withColumn("_us", F.round(F.col("arrival_epoch") * 1e6).cast("long"))
    whole = rows if by else rows.withColumn("_all", F.lit(0))
    keys = by or ["_all"]
    anchors = durable(greedy_anchors(whole, keys, "_us", window))
    placed = with_anchor(whole, anchors, keys, "_us", window)
    members = first_per_key(placed, [*keys, "anchor", "station_code"], ["_us", "network", "channel"])
    members = durable(members)
    sizes = members.groupBy(*keys, "anchor").agg(F.count(F.lit(1)).alias("n_stations")).filter(F.col("n_stations") >= min_stations)
    numbered = number_rows(sizes, [], [F.col("anchor"), *[F.col(k) for k in keys]], "_k", hot_rows)
    digits = F.greatest(F.length(F.col("_k").cast("string")), F.lit(4))
    name = F.concat(F.lit("AUTO_EV_"), F.lpad(F.col("_k").cast("string"), digits, F.lit("0")))
    named = numbered.select(*keys, "anchor", "n_stations", name.alias("event_id"))
    out = members.drop(*[c for c in ("event_id", "n_stations") if c in members.columns]).join(bounded(named), [*keys, "anchor"])
    return out.drop("_us", "anchor", "_all")


def trace_summary(
    samples: DataFrame, keys: Sequence[str], rate: float, nsta: int, nlta: int, value: str = "x", hot_rows: int | None = None
) -> DataFrame:
    """Per trace: samples, duration, peak and its time, rms, std, p95, and STA/LTA peak, time and mean."""
    keys = list(keys)
    x = F.col(value)
    samples = durable(samples)
    biggest = F.struct(F.abs(x), -F.col("n"))
    plain = samples.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("npts"),
        (F.count(F.lit(1)) / rate).alias("duration_s"),
        F.max_by(x, biggest).alias("amplitude_peak"),
        (F.max_by("n", biggest) / rate).alias("amplitude_peak_time"),
        F.sqrt(F.avg(x * x)).alias("amplitude_rms"),
        F.stddev_pop(x).alias("amplitude_std"),
    )
    p95 = exact_quantiles(samples, keys, F.abs(x), {"percentile_95": 0.95}, hot_rows)
    ratios = sta_lta_ratio(samples, keys, nsta, nlta, "n", value)
    top = F.struct(F.col("ratio"), -F.col("n"))
    detect = ratios.groupBy(*keys).agg(
        F.max("ratio").alias("sta_lta_peak"),
        (F.max_by("n", F.when(F.col("ratio").isNotNull(), top)) / rate).alias("sta_lta_peak_time"),
        F.avg("ratio").alias("sta_lta_mean"),
    )
    return plain.join(p95, keys).join(detect, keys, "left")


def trace_report(
    samples: DataFrame, starts: DataFrame, keys: Sequence[str], rate: float, nsta: int, nlta: int, value: str = "x", hot_rows: int | None = None
) -> DataFrame:
    """One row a trace with its ids, start and end, times as seconds since 1970, amplitudes, STA/LTA and the strongest frequency.

    ``starts`` has the time of sample 0 of each trace (keys, start). Traces without one have NULL times.
    """
    keys = list(keys)
    samples = durable(samples)
    summary = trace_summary(samples, keys, rate, nsta, nlta, value, hot_rows)
    spectrum = spectral_peak(samples, keys, rate, value=value).select(*keys, "frequency_peak_hz")
    joined = summary.join(spectrum, keys, "left").join(bounded(starts.select(*keys, F.unix_micros("start").alias("_us"))), keys, "left")
    end = F.col("_us") + F.round((F.col("npts") - 1) / rate * 1e6).cast("long")
    epoch = lambda seconds: F.col("_us") / 1e6 + F.col(seconds)
    return joined.select(
        F.concat_ws(".", *keys).alias("trace_id"), *keys, iso_text(F.timestamp_micros("_us")).alias("start_time_iso"), iso_text(F.timestamp_micros(end)).alias("end_time_iso"),
        "duration_s", F.lit(float(rate)).alias("sampling_rate_hz"), "npts", "amplitude_peak", epoch("amplitude_peak_time").alias("amplitude_peak_time_epoch"),
        "amplitude_rms", "amplitude_std", "percentile_95", "sta_lta_peak", epoch("sta_lta_peak_time").alias("sta_lta_peak_time_epoch"), "sta_lta_mean", "frequency_peak_hz",
    )


def spectral_peak(samples: DataFrame, keys: Sequence[str], rate: float, segment_seconds: float = SEGMENT_SECONDS, value: str = "x") -> DataFrame:
    """Frequency of the strongest bin of the averaged spectrum of half-overlapping Hann segments.

    The Python step sees 64 segments of 60 s at a time, so a trace of any length is many small groups.
    """
    keys = list(keys)
    most = max(2, int(rate * segment_seconds))
    sized = with_length(samples.select(*keys, "n", F.col(value).cast("double").alias("x")), keys)
    length = F.least(F.col("npts"), F.lit(most))
    hop = F.greatest(length - F.floor(length / 2), F.lit(1))
    first = F.greatest(F.lit(0), F.floor((F.col("n") - length) / hop) + 1).cast("long")
    segments = sized.withColumns({"_len": length, "_hop": hop}).select(
        "*", F.explode(F.sequence(first, F.floor(F.col("n") / hop).cast("long"))).alias("_seg")
    )
    segments = segments.filter(F.col("_seg") * F.col("_hop") + F.col("_len") <= F.col("npts"))
    segments = segments.withColumn("_bunch", F.floor(F.col("_seg") / SEGMENTS_PER_GROUP))
    numbers = [T.StructField(c, T.DoubleType()) for c in ("frequency", "power", "parts")]
    schema = T.StructType([*[samples.schema[k] for k in keys], *numbers])

    def spectrum(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_seg", "n"])
        size = int(pdf["_len"].iloc[0])
        x = pdf["x"].to_numpy().reshape(-1, size)
        window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)
        power = np.abs(np.fft.rfft((x - x.mean(axis=1, keepdims=True)) * window)) ** 2 / (rate * (window**2).sum())
        power[:, 1 : power.shape[1] - (size % 2 == 0)] *= 2
        return pd.DataFrame(
            {
                **{k: pdf[k].iloc[0] for k in keys},
                "frequency": np.fft.rfftfreq(size, 1 / rate),
                "power": power.sum(axis=0),
                "parts": float(len(x)),
            }
        )

    spectra = segments.groupBy(*keys, "_bunch").applyInPandas(spectrum, schema)
    mean = spectra.groupBy(*keys, "frequency").agg((F.sum("power") / F.sum("parts")).alias("power"))
    return mean.groupBy(*keys).agg(
        F.max_by("frequency", F.struct("power", -F.col("frequency"))).alias("frequency_peak_hz"), F.max("power").alias("power_peak")
    )


class _Fit:
    """Bounded damped least squares of one station, a step at a time: evaluate ``trial``, hand the sums to ``take``."""

    def __init__(self, start: np.ndarray, low: np.ndarray, high: np.ndarray, steps: int = FIT_STEPS):
        self.low, self.high, self.left = low, high, steps
        self.p = self.trial = np.clip(start, low, high)
        self.cost, self.damping, self.done, self.success = math.inf, 1e-3, False, False

    def take(self, cost: float, normal: np.ndarray, gradient: np.ndarray) -> None:
        """Half the cost, normal matrix and gradient at ``trial``; makes the next one, or ends."""
        if cost < self.cost:
            gain, shift = self.cost - cost, np.abs(self.trial - self.p) / np.maximum(np.abs(self.p), 1.0)
            first = math.isinf(self.cost)
            self.p, self.cost, self.normal, self.gradient = self.trial, cost, normal, gradient
            if not first:
                self.damping = max(self.damping / 5, 1e-12)
                if gain <= 1e-14 * max(cost, 1e-300) and shift.max() < 1e-10:
                    return self._end(True)
        else:
            self.damping *= 4
            if self.damping > 1e12:
                return self._end(True)  # no step makes it better
        if self.left == 0:
            return self._end(False)
        self.left -= 1
        free = ~(((self.p <= self.low) & (self.gradient > 0)) | ((self.p >= self.high) & (self.gradient < 0)))
        if not free.any():
            return self._end(True)
        matrix = self.normal[np.ix_(free, free)]
        scaled = matrix + self.damping * np.diag(np.maximum(np.diag(matrix), 1e-30))
        move = np.zeros_like(self.p)
        move[free] = np.linalg.lstsq(scaled, -self.gradient[free], rcond=None)[0]
        self.trial = np.clip(self.p + move, self.low, self.high)

    def _end(self, success: bool) -> None:
        self.done, self.success = True, success and bool(np.isfinite(self.cost))


_SOLVED = "station_code STRING, x_m DOUBLE, y_m DOUBLE, velocity_m_s DOUBLE, n_events BIGINT, rms_seconds DOUBLE, success BOOLEAN"


def _solved_row(station: str, fit: _Fit, n: int) -> tuple:
    return station, float(fit.p[0]), float(fit.p[1]), float(fit.p[2]), int(n), float(math.sqrt(2 * fit.cost / n)), fit.success


def _fit_together(rows: DataFrame, stations: list, first_velocity: float, z_station: float, low: np.ndarray, high: np.ndarray) -> DataFrame:
    """Stations with very many rows: one grouped aggregation of the normal equations a step for all that go on, each with
    its own damping. The parameters are a small table; the number of jobs is that of the slowest station's steps."""
    spark = rows.sparkSession
    fits = {s["station_code"]: (_Fit(np.array([s["x"], s["y"], first_velocity]), low, high), s["n"]) for s in stations}
    going = set(fits)
    while going:
        trials = spark.createDataFrame([(c, *map(float, fits[c][0].trial)) for c in sorted(going)], "station_code STRING, p0 DOUBLE, p1 DOUBLE, p2 DOUBLE")
        at = rows.join(F.broadcast(trials), "station_code")
        dx, dy, dz = F.col("x_m") - F.col("p0"), F.col("y_m") - F.col("p1"), F.col("z_m") - z_station
        d = F.greatest(F.sqrt(dx * dx + dy * dy + dz * dz), F.lit(1e-9))
        r = d / F.col("p2") - F.col("travel_time")
        at = at.select("station_code", r.alias("r"), (-dx / d / F.col("p2")).alias("j0"), (-dy / d / F.col("p2")).alias("j1"), (-d / F.col("p2") / F.col("p2")).alias("j2"))
        pairs = [("r", "r"), *[(f"j{i}", "r") for i in range(3)], *[(f"j{i}", f"j{k}") for i in range(3) for k in range(i, 3)]]
        sums = at.groupBy("station_code").agg(*[F.sum(F.col(a) * F.col(b)).alias(f"s{i}") for i, (a, b) in enumerate(pairs)])
        for row in sums.collect():
            fit, s = fits[row["station_code"]][0], list(row)[1:]
            upper = np.zeros((3, 3))
            upper[np.triu_indices(3)] = s[4:]
            fit.take(0.5 * s[0], upper + upper.T - np.diag(np.diag(upper)), np.array(s[1:4]))
            if fit.done:
                going.discard(row["station_code"])
    return spark.createDataFrame([_solved_row(code, fit, n) for code, (fit, n) in fits.items()], _SOLVED)


def invert_station_location(
    observations: DataFrame,
    z_station: float = 0.0,
    margin: float = MARGIN_METRES,
    velocity: tuple[float, float] = VELOCITY_BOUNDS,
    first_velocity: float = FIRST_VELOCITY,
    hot_rows: int | None = None,
    events: str | None = None,
) -> DataFrame:
    """Least-squares position and wave speed of each station from (x_m, y_m, z_m, travel_time) rows.

    Returns station_code, latitude, longitude, elevation_assumed_m, x_m, y_m, velocity_m_s, velocity_km_s, n_events,
    rms_seconds, success (the solver came to rest; rows that did not stay, marked), and with ``events``, the name of a column, event_ids_used: the
    distinct events in order, joined by commas, one text a station.
    Stations with many rows are solved together by Spark sums of the normal equations, one aggregation a step for all of them;
    the others in parallel, one small group each, by the same steps.
    """
    box = observations.agg(F.min("x_m"), F.max("x_m"), F.min("y_m"), F.max("y_m")).first()
    spark = observations.sparkSession
    if box[0] is None:  # no observations: a typed, empty result
        return _located(spark.createDataFrame([], _SOLVED), z_station, observations, events)
    low = np.array([box[0] - margin, box[2] - margin, velocity[0]])
    high = np.array([box[1] + margin, box[3] + margin, velocity[1]])
    sizes = observations.groupBy("station_code").agg(F.count(F.lit(1)).alias("n"), F.avg("x_m").alias("x"), F.avg("y_m").alias("y"))
    hot = sizes.filter(F.col("n") > (hot_rows or HOT_ROWS)).collect()  # at most rows / hot_rows stations

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y, z, t = (pdf[c].to_numpy() for c in ("x_m", "y_m", "z_m", "travel_time"))
        fit = _Fit(np.array([x.mean(), y.mean(), first_velocity]), low, high)
        while not fit.done:
            p = fit.trial
            dx, dy, dz = x - p[0], y - p[1], z - z_station
            d = np.maximum(np.sqrt(dx * dx + dy * dy + dz * dz), 1e-9)
            r = d / p[2] - t
            jac = np.stack([-dx / d / p[2], -dy / d / p[2], -d / p[2] ** 2])
            fit.take(0.5 * float(r @ r), jac @ jac.T, jac @ r)
        return pd.DataFrame([_solved_row(pdf["station_code"].iloc[0], fit, len(t))], columns=[c.split()[0] for c in _SOLVED.split(", ")])

    needed = observations.select("station_code", "x_m", "y_m", "z_m", "travel_time")
    if not hot:
        return _located(spread(needed, ["station_code"]).groupBy("station_code").applyInPandas(solve, _SOLVED), z_station, observations, events)
    names = F.broadcast(spark.createDataFrame([(r["station_code"],) for r in hot], "station_code STRING"))
    small = needed.join(names, "station_code", "left_anti")
    made = spread(small, ["station_code"]).groupBy("station_code").applyInPandas(solve, _SOLVED)
    large = durable(needed.join(names, "station_code", "left_semi"))
    return _located(made.unionByName(_fit_together(large, hot, first_velocity, z_station, low, high)), z_station, observations, events)


def _located(solved: DataFrame, z_station: float, observations: DataFrame, events: str | None) -> DataFrame:
    latitude, longitude = unproject_utm("x_m", "y_m")
    columns = [
        "station_code", latitude.alias("latitude"), longitude.alias("longitude"), F.lit(float(z_station)).alias("elevation_assumed_m"), "x_m", "y_m",
        "velocity_m_s", (F.col("velocity_m_s") / 1000).alias("velocity_km_s"), "n_events", "rms_seconds", "success",
    ]
    if events is None:
        return solved.select(*columns)
    used = observations.groupBy(F.col("station_code").alias("_of")).agg(F.array_join(F.sort_array(F.collect_set(events)), ",").alias("event_ids_used"))
    return solved.join(used, F.col("station_code") == F.col("_of"), "left").select(*columns, "event_ids_used")
