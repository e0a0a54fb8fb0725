"""Rolling features on the hourly series, group references, sequences and splits.

The hourly series has one row per hour (8,760 a year), however many picks lie behind it, so a window
ordered over the whole series is one small task. Give ``by`` to keep several networks apart.
Operators on raw rows do not use such windows; they go through ``tremorlake.scale``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tremorlake.operators.hourly import hour_grid
from tremorlake.scale import bounded, exact_quantiles, number_rows
from tremorlake.session import durable, release

WINDOWS = (6, 12, 24, 48)  # fixed value: hours of the rolling features


def last_rows(n: int, order: str = "timestamp", by: Sequence[str] = (), end: int = 0):
    """Frame of ``n`` rows that ends ``-end`` rows before the current one."""
    return W.partitionBy(*by).orderBy(order).rowsBetween(-(n - 1) + end, end)


def rolling_counts(df: DataFrame, col: str = "numero_eventi", windows=WINDOWS, by=()) -> DataFrame:
    return df.select("*", *[F.sum(col).over(last_rows(n, by=by)).alias(f"eventi_ultime_{n}h") for n in windows])


def rolling_energy(df: DataFrame, windows=WINDOWS, by=()) -> DataFrame:
    out = []
    for n in windows:
        frame = last_rows(n, by=by)
        out.append(F.max("energia_max").over(frame).alias(f"energia_max_ultime_{n}h"))
        out.append(F.avg("energia_media").over(frame).alias(f"energia_media_ultime_{n}h"))
    return df.select("*", *out)


def rolling_catalog_past(df: DataFrame, hours: int = 6, strict_past: bool = False, by=()) -> DataFrame:
    """Events and largest magnitude of the last hours; ``strict_past`` leaves the current hour out."""
    frame = last_rows(hours, by=by, end=-1 if strict_past else 0)
    return df.select(
        "*",
        F.coalesce(F.sum("catalog_n").over(frame), F.lit(0)).alias(f"eventi_catalogo_{hours}h"),
        F.coalesce(F.max("catalog_max").over(frame), F.lit(0.0)).alias(f"magnitudo_max_{hours}h"),
    )


def rolling_network_energy(df: DataFrame, by=()) -> DataFrame:
    short, long = last_rows(6, by=by), last_rows(24, by=by)
    return df.select(
        "*",
        F.avg("net_rms_log_ratio_med").over(short).alias("net_rms_log_ratio_6h"),
        F.max("net_rms_log_ratio_med").over(long).alias("net_rms_log_ratio_max_24h"),
        F.avg("frac_stations_2x_rms").over(short).alias("frac_stations_2x_6h"),
        F.max("frac_stations_2x_rms").over(long).alias("frac_stations_2x_max_24h"),
    )


def when_full(value: Column, n: int, by=(), order: str = "timestamp") -> Column:
    """NULL until ``n`` rows have been seen."""
    return F.when(F.count(F.lit(1)).over(last_rows(n, order, by)) == n, value)


def rolling_full_window(df: DataFrame, windows=WINDOWS, by=()) -> DataFrame:
    """Sum, max, mean and mean of std, only once the window is full."""
    out = []
    for n in windows:
        frame = last_rows(n, by=by)
        for name, value in (
            ("eventi", F.sum("numero_eventi")),
            ("energia_max", F.max("energia_max")),
            ("energia_media", F.avg("energia_media")),
            ("energia_std", F.avg("energia_std")),
        ):
            out.append(when_full(value.over(frame), n, by).alias(f"{name}_ultime_{n}h"))
    return df.select("*", *out)


def rolling_trend_slope(df: DataFrame, windows=(12, 24), by=()) -> DataFrame:
    """Least-squares slope per hour of counts and maxima over a full window."""
    position = F.unix_seconds("timestamp") / 3600
    placed = df.withColumn("_t", position - F.min(position).over(W.partitionBy(*by)))
    out = []
    for n in windows:
        for name, col in (("eventi", "numero_eventi"), ("energia", "energia_max")):
            slope = F.regr_slope(F.col(col).cast("double"), F.col("_t")).over(last_rows(n, by=by))
            out.append(when_full(slope, n, by).alias(f"trend_{name}_{n}h"))
    return placed.select(*df.columns, *out)


def rolling_half_trend(df: DataFrame, windows=(12, 24), by=()) -> DataFrame:
    """Window sum minus twice the sum of its later half (the established formula and sign)."""
    out = []
    for n in windows:
        whole = F.sum("numero_eventi").over(last_rows(n, by=by))
        late = F.sum("numero_eventi").over(last_rows(n // 2, by=by))
        out.append(when_full(whole - 2 * late, n, by).alias(f"trend_{n}h"))
    return df.select("*", *out)


def rolling_variance(df: DataFrame, n: int = 24, by=()) -> DataFrame:
    frame = last_rows(n, by=by)
    return df.select(
        "*",
        when_full(F.var_samp("numero_eventi").over(frame), n, by).alias(f"varianza_eventi_{n}h"),
        when_full(F.var_samp("energia_max").over(frame), n, by).alias(f"varianza_energia_{n}h"),
    )


def rolling_percentiles(df: DataFrame, n: int = 24, percents=(25, 50, 75, 90, 95), by=()) -> DataFrame:
    frame = last_rows(n, by=by)
    return df.select(
        "*",
        *[
            when_full(F.percentile("energia_max", F.lit(p / 100)).over(frame), n, by).alias(f"energia_p{p}_{n}h")
            for p in percents
        ],
    )


def rolling_skew_kurt(df: DataFrame, col: str = "numero_eventi", n: int = 24, by=()) -> DataFrame:
    """Bias-corrected skewness (from 3 rows) and excess kurtosis (from 4); 0 on a constant frame."""
    frame = last_rows(n, by=by)
    rows = F.count(col).over(frame).cast("double")
    flat = F.max(col).over(frame) == F.min(col).over(frame)
    g, k = F.skewness(col).over(frame), F.kurtosis(col).over(frame)
    skew = g * F.sqrt(rows * (rows - 1)) / (rows - 2)
    kurt = ((rows + 1) * k + 6) * (rows - 1) / ((rows - 2) * (rows - 3))
    return df.select(
        "*",
        F.when(rows >= 3, F.when(flat, 0.0).otherwise(skew)).alias(f"skewness_eventi_{n}h"),
        F.when(rows >= 4, F.when(flat, 0.0).otherwise(kurt)).alias(f"kurtosis_eventi_{n}h"),
    )


def rolling_entropy(df: DataFrame, col: str = "numero_eventi", n: int = 24, by=()) -> DataFrame:
    """Shannon entropy in bits of the shares of a full window, 0 if the window sums to 0."""
    frame = last_rows(n, by=by)
    values = F.collect_list(F.col(col).cast("double")).over(frame)
    total = F.sum(F.col(col).cast("double")).over(frame)

    def add(acc: Column, x: Column) -> Column:
        share = F.try_divide(x, F.col("_total"))
        return acc + share * F.log2(share + 1e-10)

    summed = F.aggregate(F.col("_values"), F.lit(0.0), add)
    entropy = F.when(F.col("_rows") == n, F.when(F.col("_total") > 0, -summed).otherwise(0.0))
    framed = df.select("*", values.alias("_values"), total.alias("_total"), F.count(F.lit(1)).over(frame).alias("_rows"))
    return framed.select(*df.columns, entropy.alias(f"entropy_{n}h"))


def rate_of_change(df: DataFrame, by=()) -> DataFrame:
    w = W.partitionBy(*by).orderBy("timestamp")

    def diff(col: str, k: int) -> Column:
        return F.col(col) - F.lag(col, k).over(w)

    return df.select(
        "*",
        diff("numero_eventi", 1).alias("event_rate_1h"),
        diff("numero_eventi", 6).alias("event_rate_6h"),
        diff("energia_max", 1).alias("energia_rate_1h"),
    )


def label_future_max(df: DataFrame, hours: int = 24, threshold: float = 18.0, by=()) -> DataFrame:
    """Largest value of the next ``hours`` rows, the alarm it makes, and how many rows reach it.

    The last ``hours`` rows cannot see a whole window: NULL, 0 and 0.
    """
    ahead = W.partitionBy(*by).orderBy("timestamp").rowsBetween(1, hours)
    whole = F.count(F.lit(1)).over(ahead) == hours
    reached = F.sum(F.when(F.col("energia_max") >= threshold, 1).otherwise(0)).over(ahead)
    top = F.when(whole, F.max("energia_max").over(ahead))
    return df.select(
        "*",
        top.alias("max_energia_futura"),
        F.when(top >= threshold, 1).otherwise(0).alias("Target_Allarme"),
        F.when(whole, reached).otherwise(0).alias("future_events_above_threshold"),
    )


def label_future_exists(grid: DataFrame, events: DataFrame, hours: int, name: str = "Target_Allarme") -> DataFrame:
    """1 where an event lies in (t, t + hours].

    A range EXISTS would be a nested-loop join. Each event instead marks the ``hours`` grid hours
    that see it, and the marks are joined by equality.
    """
    span, tick = F.expr(f"INTERVAL {int(hours)} HOURS"), F.expr("INTERVAL 1 MICROSECOND")
    first = F.date_trunc("hour", F.col("time") - span - tick) + F.expr("INTERVAL 1 HOUR")
    last = F.date_trunc("hour", F.col("time") - tick)
    marks = events.select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 HOUR"))).alias("timestamp")).distinct()
    marked = grid.join(marks.withColumn(name, F.lit(1)), "timestamp", "left")
    return marked.withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def rolling_time_range(
    rows: DataFrame, time: str, value: str, hours: Sequence[int] = WINDOWS
) -> DataFrame:
    """Max, mean and sample std of the raw rows in (t - W, t] at each hour's last row; empty hours are 0.

    Only the last row of each hour is asked for, and W is whole hours. So its window is: the W-hour
    run of whole hours that ends with its own hour, plus the tail of the hour before that run, later
    than t - W. Whole hours come from one hourly aggregate. The tails come from an equality join of
    each raw row to the one hour that sees it partly. No window runs over raw rows.
    """
    base = rows.select(F.date_trunc("hour", time).alias("hour"), F.col(time).alias("_t"), F.col(value).alias("_x"))
    hourly = durable(
        base.groupBy("hour").agg(
            F.max("_t").alias("t_last"), F.count("_x").alias("n"), F.sum("_x").alias("s"), F.max("_x").alias("m")
        )
    )
    centre = hourly.agg(F.sum("s") / F.sum("n")).first()[0] or 0.0  # shift, so that squares do not cancel
    ordered = W.orderBy("hour")
    series = hour_grid(hourly, "hour", "hour").join(hourly, "hour", "left")
    asked = series.select("hour", *[F.lead("t_last", w).over(ordered).alias(f"_u{w}") for w in hours])
    x = F.col("_x") - F.lit(centre)
    sums = [F.sum(x).alias("d"), F.sum(x * x).alias("q")]
    for w in hours:
        late = F.col("_t") > F.col(f"_u{w}") - F.expr(f"INTERVAL {int(w)} HOURS")
        sums += [
            F.count(F.when(late, x)).alias(f"n{w}"),
            F.sum(F.when(late, x)).alias(f"d{w}"),
            F.sum(F.when(late, x * x)).alias(f"q{w}"),
            F.max(F.when(late, F.col("_x"))).alias(f"m{w}"),
        ]
    parts = base.join(bounded(asked, 200_000), "hour").groupBy("hour").agg(*sums)
    series = series.join(parts, "hour", "left")
    out = []
    for w in hours:
        run = ordered.rowsBetween(-(w - 1), 0)

        def total(c: str) -> Column:
            tail = F.lag(f"{c}{w}", w).over(ordered)
            return F.sum(c).over(run) + F.coalesce(tail, F.lit(0))

        n, d, q = total("n"), total("d"), total("q")
        top = F.greatest(F.max("m").over(run), F.lag(f"m{w}", w).over(ordered))
        std = F.when(n > 1, F.sqrt(F.greatest(q - d * d / n, F.lit(0.0)) / (n - 1)))
        for name, value_at in (("max", top), ("media", F.lit(centre) + d / n), ("std", std)):
            has_rows = F.when(F.col("t_last").isNotNull(), value_at)
            out.append(F.coalesce(has_rows, F.lit(0.0)).alias(f"energia_{name}_ultime_{w}h"))
    return series.select(F.col("hour").alias("timestamp"), *out)


def ffill_causal(df: DataFrame, cols: Sequence[str], order: str = "timestamp", default: float = 0.0, by=()) -> DataFrame:
    """Last known value, then ``default``; only earlier rows are looked at."""
    past = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    filled = {c: F.coalesce(F.last(c, ignorenulls=True).over(past), F.lit(default)) for c in cols}
    return df.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def group_reference_delta(
    picks: DataFrame,
    key: str = "event_id",
    time: str = "arrival_epoch",
    mode: str = "median",
    tie: Sequence[str] = ("pick_id",),
) -> DataFrame:
    """Reference time of each event (median, mean or first arrival) and each pick's delta to it."""
    if mode == "median":
        reference = exact_quantiles(picks, [key], time, {"event_reference_epoch": 0.5})
    elif mode == "mean":
        reference = picks.groupBy(key).agg(F.avg(time).alias("event_reference_epoch"))
    elif mode == "first":
        first = F.min_by(time, F.struct(F.col(time), *[F.col(c) for c in tie]))
        reference = picks.groupBy(key).agg(first.alias("event_reference_epoch"))
    else:
        raise ValueError(f"reference mode must be median, mean or first, not {mode!r}")
    return picks.join(reference, key).withColumn("delta_seconds", F.col(time) - F.col("event_reference_epoch"))


def lookback_sequences(
    df: DataFrame, features: Sequence[str], label: str, length: int, order: str = "timestamp", by=()
) -> DataFrame:
    """For each row with enough past: the last ``length`` feature rows as an array, and its own label."""
    frame = last_rows(length, order, by)
    row = F.array(*[F.col(c).cast("double") for c in features])
    made = df.select(*by, order, label, F.collect_list(row).over(frame).alias("sequence"))
    return made.filter(F.size("sequence") == length)


def rolling_b_value(df: DataFrame, col: str, n: int = 24, by=()) -> DataFrame:
    """log10(e) / (rolling mean - smallest positive value of the series), forward filled, else 0."""
    least = df.filter(F.col(col) > 0).agg(F.coalesce(F.min(F.col(col).cast("double")), F.lit(0.1)).alias("m")).scalar()
    excess = F.avg(col).over(last_rows(n, by=by)) - least
    raw = df.withColumn("b_value", F.when(excess > 0, F.log10(F.lit(2.718281828459045)) / excess))
    return ffill_causal(raw, ["b_value"], by=by)


def rolling_b_proxy(df: DataFrame, n: int = 24, by=()) -> DataFrame:
    """Rolling mean, std and change of the hourly mean of station counts (column bvalue_approx)."""
    frame = last_rows(n, by=by)
    change = F.col("bvalue_approx") - F.lag("bvalue_approx").over(W.partitionBy(*by).orderBy("timestamp"))
    return df.select(
        "*",
        when_full(F.avg("bvalue_approx").over(frame), n, by).alias(f"bvalue_rolling_{n}h"),
        when_full(F.stddev_samp("bvalue_approx").over(frame), n, by).alias(f"bvalue_std_{n}h"),
        change.alias("bvalue_change"),
    )


def temporal_split(
    df: DataFrame,
    order: Sequence[str],
    label: str,
    test_size: float = 0.2,
    hot_rows: int | None = None,
) -> DataFrame:
    """Mark each row ``train`` or ``test``: the first 80 % by time train.

    If that part holds one class only and the rarer class has more than one row, the cut moves to the
    middle row of the rarer class. Ties between class sizes go to the smaller label.
    """
    if not 0 < test_size < 1:
        raise ValueError(f"test_size must lie between 0 and 1, not {test_size}")
    given = durable(df)
    numbered = durable(number_rows(given, [], [F.col(c) for c in order], "_pos", hot_rows))
    release(given)
    total = numbered.count()
    cut = int(total * (1 - test_size))
    if cut == 0:
        raise ValueError(f"too few rows to split: {total}")
    counted = numbered.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.min("_pos").alias("first"))
    seen = counted.agg(F.count_if(F.col("first") <= cut).alias("in_train"), F.min(F.struct("n", F.col(label).alias("rarer"))).alias("least")).first()
    if seen["in_train"] < 2 and seen["least"]["n"] > 1:
        middle = seen["least"]["n"] // 2 + 1
        rare = numbered.filter(F.col(label).eqNullSafe(F.lit(seen["least"]["rarer"]))).select("_pos")
        cut = number_rows(rare, [], [F.col("_pos")], "_k", hot_rows).filter(F.col("_k") == middle).first()["_pos"] - 1
    part = F.when(F.col("_pos") <= cut, "train").otherwise("test")
    return numbered.withColumn("split", part).drop("_pos")


