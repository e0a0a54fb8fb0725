"""Queries for rolling features, references, sequences and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tremorlake.operators import hourly as H, windows as R
from tremorlake.queries import query
from tremorlake.queries.feature_queries import ROLL, _hourly, _roll
from tremorlake.scale import fill_in_order


def _full(n: int, value: str, name: str) -> str:
    return f"CASE WHEN count(*) OVER w{n} = {n} THEN {value} OVER w{n} END AS {name}"


FULL_COLUMNS = [
    (name, value)
    for name, value in (
        ("eventi", "sum(numero_eventi)"),
        ("energia_max", "max(energia_max)"),
        ("energia_media", "avg(energia_media)"),
        ("energia_std", "avg(energia_std)"),
    )
]


@query(
    "rolling_full_window",
    "hourly",
    " SELECT timestamp, "
    + ", ".join(
        _full(n, v, f"{c}_ultime_{n}h") for n in (6, 12, 24, 48) for c, v in FULL_COLUMNS
    )
    + f" FROM hourly {ROLL}",
    " ".join(f"energia_{k}_ultime_{n}h" for n in (6, 12, 24, 48) for k in ("max", "media", "std")),
)
def _(t):
    return R.rolling_full_window(_hourly(t)).drop("numero_eventi", "energia_max", "energia_media", "energia_std")


@query(
    "rolling_trend_slope",
    "hourly",
    " , placed AS (SELECT *, (epoch(timestamp) - epoch(min(timestamp) OVER ())) / 3600e0 AS t FROM hourly) SELECT timestamp, "
    + ", ".join(
        _full(n, f"regr_slope({col}, t)", f"trend_{name}_{n}h")
        for n in (12, 24)
        for name, col in (("eventi", "numero_eventi"), ("energia", "energia_max"))
    )
    + f" FROM placed {ROLL}",
    "trend_eventi_12h:8 trend_energia_12h:8 trend_eventi_24h:8 trend_energia_24h:8",
)
def _(t):
    return R.rolling_trend_slope(_hourly(t)).drop("numero_eventi", "energia_max", "energia_media", "energia_std")


@query(
    "rolling_half_trend",
    "hourly",
    """ SELECT timestamp,
    CASE WHEN count(*) OVER w12 = 12 THEN CAST(sum(numero_eventi) OVER w12 - 2 * sum(numero_eventi) OVER w6 AS BIGINT) END AS trend_12h,
    CASE WHEN count(*) OVER w24 = 24 THEN CAST(sum(numero_eventi) OVER w24 - 2 * sum(numero_eventi) OVER w12 AS BIGINT) END AS trend_24h
    FROM hourly """
    + ROLL,
)
def _(t):
    return R.rolling_half_trend(_hourly(t)).select("timestamp", "trend_12h", "trend_24h")


@query(
    "rolling_variance",
    "hourly",
    " SELECT timestamp, "
    + _full(24, "var_samp(numero_eventi)", "varianza_eventi_24h")
    + ", "
    + _full(24, "var_samp(energia_max)", "varianza_energia_24h")
    + f" FROM hourly {ROLL}",
    "varianza_eventi_24h varianza_energia_24h",
)
def _(t):
    return R.rolling_variance(_hourly(t)).select("timestamp", "varianza_eventi_24h", "varianza_energia_24h")


@query(
    "rolling_percentiles",
    "hourly",
    " SELECT timestamp, "
    + ", ".join(_full(24, f"quantile_cont(energia_max, {p / 100})", f"energia_p{p}_24h") for p in (25, 50, 75, 90, 95))
    + f" FROM hourly {ROLL}",
    " ".join(f"energia_p{p}_24h" for p in (25, 50, 75, 90, 95)),
)
def _(t):
    return R.rolling_percentiles(_hourly(t)).drop("numero_eventi", "energia_max", "energia_media", "energia_std")


@query(
    "rolling_skew_kurt",
    "hourly",
    """, framed AS (SELECT timestamp, list(numero_eventi::DOUBLE) OVER w24 AS xs FROM hourly """
    + ROLL
    + """), centred AS (SELECT timestamp, len(xs) AS n, list_transform(xs, lambda x: x - list_avg(xs)) AS ds FROM framed),
    moments AS (SELECT timestamp, n::DOUBLE AS n, list_avg(list_transform(ds, lambda d: d * d)) AS m2,
      list_avg(list_transform(ds, lambda d: d * d * d)) AS m3, list_avg(list_transform(ds, lambda d: d * d * d * d)) AS m4 FROM centred)
    SELECT timestamp,
      CASE WHEN n >= 3 THEN CASE WHEN m2 = 0 THEN 0e0 ELSE m3 / m2 ** 1.5e0 * sqrt(n * (n - 1)) / (n - 2) END END AS skewness_eventi_24h,
      CASE WHEN n >= 4 THEN CASE WHEN m2 = 0 THEN 0e0 ELSE ((n + 1) * (m4 / (m2 * m2) - 3) + 6) * (n - 1) / ((n - 2) * (n - 3)) END END
        AS kurtosis_eventi_24h FROM moments""",
    "skewness_eventi_24h:8 kurtosis_eventi_24h:8",
)
def _(t):
    return R.rolling_skew_kurt(_hourly(t)).select("timestamp", "skewness_eventi_24h", "kurtosis_eventi_24h")


@query(
    "rolling_entropy",
    "hourly",
    """, framed AS (SELECT timestamp, list(numero_eventi::DOUBLE) OVER w24 AS xs FROM hourly """
    + ROLL
    + """) SELECT timestamp, CASE WHEN len(xs) = 24 THEN CASE WHEN list_sum(xs) > 0 THEN
      -list_sum(list_transform(xs, lambda x: x / list_sum(xs) * log2(x / list_sum(xs) + 1e-10))) ELSE 0e0 END END AS entropy_24h
    FROM framed""",
    "entropy_24h:8",
)
def _(t):
    return R.rolling_entropy(_hourly(t)).select("timestamp", "entropy_24h")


@query(
    "rate_of_change",
    "hourly",
    """ SELECT timestamp, numero_eventi - lag(numero_eventi, 1) OVER w AS event_rate_1h,
    numero_eventi - lag(numero_eventi, 6) OVER w AS event_rate_6h, energia_max - lag(energia_max, 1) OVER w AS energia_rate_1h
    FROM hourly WINDOW w AS (ORDER BY timestamp)""",
    "energia_rate_1h",
)
def _(t):
    return R.rate_of_change(_hourly(t)).select("timestamp", "event_rate_1h", "event_rate_6h", "energia_rate_1h")


@query(
    "label_future_max",
    "hourly",
    """, ahead AS (SELECT timestamp, max(energia_max) OVER f AS top, count(*) OVER f AS n,
      count(*) FILTER (energia_max >= 18) OVER f AS hits FROM hourly
      WINDOW f AS (ORDER BY timestamp ROWS BETWEEN 1 FOLLOWING AND 24 FOLLOWING))
    SELECT timestamp, CASE WHEN n = 24 THEN top END AS max_energia_futura,
      CASE WHEN n = 24 AND top >= 18 THEN 1 ELSE 0 END AS "Target_Allarme",
      CASE WHEN n = 24 THEN hits ELSE 0 END AS future_events_above_threshold FROM ahead""",
    "max_energia_futura",
)
def _(t):
    return R.label_future_max(_hourly(t)).select(
        "timestamp", "max_energia_futura", "Target_Allarme", "future_events_above_threshold"
    )


def _range_sql() -> str:
    parts = []
    for n in (6, 12, 24, 48):
        frame = f"(ORDER BY us RANGE BETWEEN {n * 3600000000 - 1} PRECEDING AND CURRENT ROW)"
        parts += [
            f"max(v) OVER {frame} AS mx{n}, avg(v) OVER {frame} AS av{n}, stddev_samp(v) OVER {frame} AS sd{n}",
        ]
    picks = ", ".join(
        f"coalesce(max_by(mx{n}, (us, pick_id)), 0e0) AS energia_max_ultime_{n}h, "
        f"coalesce(max_by(av{n}, (us, pick_id)), 0e0) AS energia_media_ultime_{n}h, "
        f"coalesce(max_by(sd{n}, (us, pick_id)), 0e0) AS energia_std_ultime_{n}h"
        for n in (6, 12, 24, 48)
    )
    return f""", timed AS (SELECT pick_id, arrival_iso, epoch_us(arrival_iso) AS us, delta_seconds AS v FROM picks),
    rolled AS (SELECT pick_id, us, date_trunc('hour', arrival_iso) AS hour, {', '.join(parts)} FROM timed),
    grid AS (SELECT unnest(generate_series(date_trunc('hour', min(arrival_iso)), date_trunc('hour', max(arrival_iso)),
      INTERVAL 1 HOUR)) AS timestamp FROM picks)
    SELECT timestamp, {picks} FROM grid LEFT JOIN rolled ON hour = timestamp GROUP BY timestamp"""


@query(
    "rolling_time_range",
    "picks",
    _range_sql(),
    " ".join(f"energia_{k}_ultime_{n}h" for n in (6, 12, 24, 48) for k in ("max", "media", "std")),
)
def _(t):
    return R.rolling_time_range(t.picks, "arrival_iso", "delta_seconds")


@query(
    "ffill_causal",
    "hourly",
    """, holed AS (SELECT timestamp, CASE WHEN numero_eventi % 3 = 0 THEN energia_max END AS energia_max,
      CASE WHEN numero_eventi % 2 = 0 THEN energia_media END AS energia_media FROM hourly)
    SELECT timestamp, coalesce(last_value(energia_max IGNORE NULLS) OVER w, 0e0) AS energia_max,
      coalesce(last_value(energia_media IGNORE NULLS) OVER w, 0e0) AS energia_media
    FROM holed WINDOW w AS (ORDER BY timestamp ROWS UNBOUNDED PRECEDING)""",
    "energia_max energia_media",
)
def _(t):
    holed = _hourly(t).select(
        "timestamp",
        F.when(F.col("numero_eventi") % 3 == 0, F.col("energia_max")).alias("energia_max"),
        F.when(F.col("numero_eventi") % 2 == 0, F.col("energia_media")).alias("energia_media"),
    )
    return R.ffill_causal(holed, ["energia_max", "energia_media"])


@query(
    "fill_both_ways",
    "picks",
    """, holed AS (SELECT pick_id, CASE WHEN channel <> 'click' AND pick_id > 20 THEN delta_seconds END AS delta_seconds,
      CASE WHEN pick_id % 5 = 3 THEN station_code END AS station_code FROM picks)
    SELECT pick_id, coalesce(last_value(delta_seconds IGNORE NULLS) OVER b, first_value(delta_seconds IGNORE NULLS) OVER a) AS delta_seconds,
      coalesce(last_value(station_code IGNORE NULLS) OVER b, first_value(station_code IGNORE NULLS) OVER a) AS station_code
    FROM holed WINDOW b AS (ORDER BY pick_id ROWS UNBOUNDED PRECEDING),
      a AS (ORDER BY pick_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
    "delta_seconds",
)
def _(t):
    holed = t.picks.select(
        "pick_id",
        F.when((F.col("channel") != "click") & (F.col("pick_id") > 20), F.col("delta_seconds")).alias("delta_seconds"),
        F.when(F.col("pick_id") % 5 == 3, F.col("station_code")).alias("station_code"),
    )
    return fill_in_order(holed, ["pick_id"], ["delta_seconds", "station_code"])


@query(
    "group_reference_delta",
    "picks",
    """, refs AS (SELECT event_id, median(arrival_epoch) AS med, avg(arrival_epoch) AS mean, min(arrival_epoch) AS first
      FROM picks GROUP BY event_id)
    SELECT pick_id, 'median' AS mode, med AS event_reference_epoch, arrival_epoch - med AS delta_seconds FROM picks JOIN refs USING (event_id)
    UNION ALL SELECT pick_id, 'mean', mean, arrival_epoch - mean FROM picks JOIN refs USING (event_id)
    UNION ALL SELECT pick_id, 'first', first, arrival_epoch - first FROM picks JOIN refs USING (event_id)""",
    "event_reference_epoch:3 delta_seconds:3",
)
def _(t):
    made = [
        R.group_reference_delta(t.picks, mode=mode).select(
            "pick_id", F.lit(mode).alias("mode"), "event_reference_epoch", "delta_seconds"
        )
        for mode in ("median", "mean", "first")
    ]
    return made[0].unionByName(made[1]).unionByName(made[2])


@query(
    "lookback_sequences",
    "hourly",
    """, framed AS (SELECT timestamp, (energia_max >= 45)::INTEGER AS label, list(numero_eventi) OVER w24 AS a,
      list(energia_max) OVER w24 AS b, count(*) OVER w24 AS n FROM hourly """
    + ROLL
    + """) SELECT timestamp, label, unnest(generate_series(0, 23)) AS step,
      unnest(a)::DOUBLE AS numero_eventi, unnest(b) AS energia_max FROM framed WHERE n = 24""",
    "energia_max",
)
def _(t):
    labelled = _hourly(t).withColumn("label", (F.col("energia_max") >= 45).cast("int"))
    made = R.lookback_sequences(labelled, ["numero_eventi", "energia_max"], "label", 24)
    steps = made.select("timestamp", "label", F.posexplode("sequence").alias("step", "row"))
    return steps.select(
        "timestamp",
        "label",
        F.col("step").cast("long").alias("step"),
        F.col("row")[0].alias("numero_eventi"),
        F.col("row")[1].alias("energia_max"),
    )


@query(
    "rolling_b_value",
    "hourly",
    """, least_one AS (SELECT coalesce(min(numero_eventi::DOUBLE) FILTER (numero_eventi > 0), 0.1e0) AS m FROM hourly),
    raw AS (SELECT timestamp, avg(numero_eventi) OVER (ORDER BY timestamp ROWS 23 PRECEDING) - (SELECT m FROM least_one) AS excess
      FROM hourly), b AS (SELECT timestamp, CASE WHEN excess > 0 THEN log10(exp(1e0)) / excess END AS b FROM raw)
    SELECT timestamp, coalesce(last_value(b IGNORE NULLS) OVER (ORDER BY timestamp ROWS UNBOUNDED PRECEDING), 0e0) AS b_value FROM b""",
    "b_value",
)
def _(t):
    return R.rolling_b_value(_hourly(t), "numero_eventi").select("timestamp", "b_value")


@query(
    "rolling_b_proxy",
    "picks",
    """, per_event AS (SELECT event_id, count(DISTINCT station_code) AS k, min(arrival_iso) AS first_at FROM picks GROUP BY event_id),
    means AS (SELECT date_trunc('hour', first_at) AS h, avg(k) AS m FROM per_event GROUP BY 1),
    series AS (SELECT g.ts AS timestamp, coalesce(m, 0e0) AS bvalue_approx FROM
      (SELECT unnest(generate_series(date_trunc('hour', min(arrival_iso)), date_trunc('hour', max(arrival_iso)), INTERVAL 1 HOUR)) AS ts
       FROM picks) g LEFT JOIN means ON h = g.ts)
    SELECT timestamp, bvalue_approx, """
    + _full(24, "avg(bvalue_approx)", "bvalue_rolling_24h")
    + ", "
    + _full(24, "stddev_samp(bvalue_approx)", "bvalue_std_24h")
    + ", bvalue_approx - lag(bvalue_approx) OVER (ORDER BY timestamp) AS bvalue_change FROM series "
    + ROLL,
    "bvalue_approx bvalue_rolling_24h bvalue_std_24h:8 bvalue_change",
)
def _(t):
    from tremorlake.operators.aggregates import event_catalog

    per_event = event_catalog(t.picks)
    means = per_event.groupBy(F.date_trunc("hour", "first_arrival").alias("timestamp")).agg(
        F.avg("n_stations").alias("bvalue_approx")
    )
    grid = H.hour_grid(t.picks, "arrival_iso").join(means, "timestamp", "left").na.fill(0.0)
    return R.rolling_b_proxy(grid)


@query(
    "temporal_split",
    "picks",
    """, placed AS (SELECT pick_id, (delta_seconds >= 48.5)::INTEGER AS label, row_number() OVER (ORDER BY arrival_iso, pick_id) AS pos,
      count(*) OVER () AS n FROM picks),
    rare AS (SELECT label FROM placed GROUP BY label ORDER BY count(*), label LIMIT 1),
    rare_rows AS (SELECT pos, row_number() OVER (ORDER BY pos) AS k, count(*) OVER () AS m FROM placed JOIN rare USING (label)),
    cut AS (SELECT CASE WHEN (SELECT count(DISTINCT label) FROM placed WHERE pos <= floor(n * 0.8e0)) < 2 AND (SELECT max(m) FROM rare_rows) > 1
      THEN (SELECT pos - 1 FROM rare_rows WHERE k = m // 2 + 1) ELSE (SELECT max(floor(n * 0.8e0)) FROM placed) END AS cut_pos)
    SELECT pick_id, label, CASE WHEN pos <= cut_pos THEN 'train' ELSE 'test' END AS split FROM placed, cut""",
)
def _(t):
    labelled = t.picks.select("pick_id", "arrival_iso", (F.col("delta_seconds") >= 48.5).cast("int").alias("label"))
    return R.temporal_split(labelled, ["arrival_iso", "pick_id"], "label").drop("arrival_iso")
