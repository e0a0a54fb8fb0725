"""Time the headline queries in one warm local session and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = """
hourly_features_view causal_log_ratio energy_robust_network rolling_time_range group_reference_delta
station_stats event_epicenter filter_iqr join_travel_times join_station_dim interp_nearest
sta_lta_ratio trigger_onsets coincidence_events trace_summary spectral_peak invert_station_location
moran_global_knn moran_global_band lisa_local stream_station_stats stream_risk_score stream_coincidence
ingest_run roc_pr_auc threshold_sweep_mcc temporal_split score_table
""".split()


def drain(df) -> None:
    """Run the whole plan without collecting rows."""
    df.write.format("noop").mode("overwrite").save()


def forest_regression(spark, folder: str) -> float:
    """Seconds to fit 100 trees of depth 10 on 80 % of the lineitem rows (about 480,000 at sf0.1)."""
    from pyspark.sql import functions as F

    from tremorlake.operators.aggregates import risk_proxy_target
    from tremorlake.operators.learning import assembled, regressor, seeded_split

    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_key"),
        F.col("l_extendedprice").alias("delta_seconds"),
        "l_quantity",
        "l_discount",
        "l_tax",
    )
    features = ["delta_seconds", "l_quantity", "l_discount", "l_tax"]
    train, _ = seeded_split(assembled(risk_proxy_target(lines), features), "row_key")
    train = train.select("features", "risk").repartition(spark.sparkContext.defaultParallelism).cache()
    train.count()
    start = time.perf_counter()
    regressor("random_forest", "risk").fit(train)
    took = time.perf_counter() - start
    train.unpersist()
    return took


def main() -> None:
    from tremorlake.queries import QUERIES, load_all
    from tremorlake.session import local_session

    load_all()
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = local_session(cpus, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    for name in ("hourly_features_view", "ingest_audit"):  # untimed: start the JVM, load and compile classes
        drain(QUERIES[name](spark, folder))
    times = {}
    for name in names:
        start = time.perf_counter()
        drain(QUERIES[name](spark, folder))
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    if not sys.argv[1:]:
        times["forest_regression_fit"] = round(forest_regression(spark, folder), 3)
    scale = os.path.basename(folder.rstrip("/"))
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": scale.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
