"""Checks, aliases, scalars and geography on small frames."""

import math
from datetime import datetime
from functools import reduce

import numpy as np
import pytest
from pyspark.sql import DataFrame, functions as F

from tremorlake.functions import geo as G, scalars as S
from tremorlake.operators import aggregates as A, joins as J, quality as Q, spatial as SP
from tremorlake.operators.joins import join_knn

STATIONS = [("ST01", 40.8, 14.1, 100), ("ST02", 40.9, 14.2, 150), ("ST03", 40.7, 14.0, 120)]


@pytest.fixture(scope="module")
def stations(spark):
    return spark.createDataFrame(STATIONS, "station_code STRING, latitude DOUBLE, longitude DOUBLE, elevation INT")


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_distances_and_bearings(spark):
    got = one(
        spark,
        G.haversine_km(41.9028, 12.4964, 40.8518, 14.2681),
        G.bearing_deg(0, 0, 0, 1),
        G.bearing_deg(0, 0, 1, 0),
        G.haversine_km(10, 20, 10, 20),
    )
    assert 180 < got[0] < 200 and abs(got[1] - 90) < 1e-9 and abs(got[2]) < 1e-9 and got[3] == 0


def test_mean_bearing(spark):
    df = spark.createDataFrame([("even", b) for b in (0.0, 90.0, 180.0, 270.0)] + [("north", 350.0), ("north", 10.0)], "k STRING, b DOUBLE")
    got = {r["k"]: r["mean_bearing"] for r in A.circular_mean(df, "b", ["k"]).collect()}
    assert got["even"] == 0 and min(got["north"], 360 - got["north"]) < 1e-9
    assert A.circular_mean(df.limit(0), "b").first()["mean_bearing"] == 0


def test_projection(spark):
    on_meridian = one(spark, *G.project_utm(0.0, 15.0))
    assert abs(on_meridian[0] - 500000) < 1e-6 and abs(on_meridian[1]) < 1e-6
    # one degree of the equator beside the meridian, scaled by 0.9996 there
    near = one(spark, *G.project_utm(0.0, 15.001))
    assert abs((near[0] - 500000) - math.radians(0.001) * 6378137 * 0.9996) < 1e-3
    for lat, lon in ((40.82, 14.14), (-35.0, 12.0), (71.5, 17.9)):
        x, y = one(spark, *G.project_utm(lat, lon))
        back = one(spark, *G.unproject_utm(x, y))
        assert abs(back[0] - lat) < 1e-9 and abs(back[1] - lon) < 1e-9


def test_polygon_counts_its_boundary(spark):
    rows = [("in", 0.5, 0.5), ("edge", 0.0, 0.5), ("corner", 1.0, 1.0), ("out", 1.5, 0.5), ("beside", 0.5, -0.1)]
    df = spark.createDataFrame(rows, "k STRING, latitude DOUBLE, longitude DOUBLE")
    assert {r["k"] for r in Q.filter_polygon(df, "0,0 0,1 1,1 1,0").collect()} == {"in", "edge", "corner"}
    with pytest.raises(ValueError):
        Q.filter_polygon(df, "0,0 1,1")


def test_radius(stations):
    assert {r[0] for r in Q.filter_radius(stations, 40.82, 14.14, 20.0).collect()} == {"ST01", "ST02", "ST03"}
    assert {r[0] for r in Q.filter_radius(stations, 40.82, 14.14, 5.0).collect()} == {"ST01"}


def test_coordinate_checks(spark, stations):
    assert Q.require_coordinates(stations) is stations
    for lat, lon in ((91.0, 0.0), (0.0, -181.0), (None, 1.0)):
        bad = spark.createDataFrame([(lat, lon)], "latitude DOUBLE, longitude DOUBLE")
        with pytest.raises(Q.CheckFailed):
            Q.require_coordinates(bad)
    Q.require_coordinates(spark.createDataFrame([(None, 1.0)], "latitude DOUBLE, longitude DOUBLE"), allow_nulls=True)
    with pytest.raises(Q.CheckFailed, match="elevation"):
        Q.require_numeric_range(stations, "elevation", 0, 120)


def test_schema_checks(spark, stations):
    assert Q.check_schema_types(stations, ["station_code"], {"latitude": "double"}) == (True, "Data validation passed")
    assert Q.check_schema_types(stations, ["station"])[1] == "Missing required columns: station"
    assert Q.check_schema_types(stations.limit(0), ["latitude"]) == (False, "DataFrame is empty")
    assert Q.check_schema_types(stations, ["station_code"], {"station_code": "double"})[1].startswith("Type mismatch for column 'station_code'")


def test_value_column(spark):
    df = spark.createDataFrame([("A", 0.5, "x"), ("B", 0.7, "y")], "station_code STRING, soft_mean DOUBLE, note STRING")
    assert [r["delta_seconds"] for r in Q.pick_value_column(df).collect()] == [0.5, 0.7]
    for call in (lambda: Q.pick_value_column(df, "nope"), lambda: Q.pick_value_column(df, "note"), lambda: Q.pick_value_column(df.drop("soft_mean"))):
        with pytest.raises(Q.CheckFailed):
            call()


def test_lists(spark, stations):
    assert Q.filter_in_list(stations, {"station_code": ["st01 "]}).count() == 1
    listed = spark.createDataFrame([("st01",), ("ST03",)], "code STRING")
    assert Q.filter_in_list(stations, {"station_code": listed}).count() == 2
    with pytest.raises(Q.CheckFailed):
        Q.filter_in_list(stations, {"station_code": ["NONE"]})


def test_station_lookup(spark, stations):
    picks = spark.createDataFrame([(" st01",), ("ZZ",), ("AA",)], "station_code STRING")
    with pytest.raises(ValueError, match="AA, ZZ"):
        J.require_lookup(picks, stations)
    assert J.require_lookup(picks.limit(1), stations).first()["latitude"] == 40.8
    many = spark.range(150).selectExpr("concat('Q', id) AS station_code").unionByName(spark.createDataFrame([(None,)], "station_code STRING"))
    with pytest.raises(ValueError, match="^151 .*NULL.*Q99"):
        J.require_lookup(many, stations)
    with pytest.raises(ValueError, match="ST01"):
        J.require_lookup(picks.limit(1), stations.withColumn("latitude", F.lit(None).cast("double")))


def test_alert_layouts(spark):
    rows = [("2024-01-01T00:00:00", "WARN", "1.7"), ("junk", "Critical", "x")]
    got = Q.normalize_alerts(spark.createDataFrame(rows, "datetime STRING, severity STRING, probability STRING")).collect()
    assert [(r["severity"], r["risk_score"], r["station"]) for r in got] == [("medium", 1.0, "UNKNOWN"), ("critical", 0.0, "UNKNOWN")]
    bare = spark.createDataFrame([("A", 0.9, 86400.0)], "station_code STRING, risk DOUBLE, start_epoch DOUBLE")
    row = Q.normalize_alerts(bare).first()
    assert row["timestamp"] == datetime(1970, 1, 2) and row["severity"] == "critical"


def test_levels(spark):
    risks = spark.createDataFrame([(r,) for r in (0.4, 0.6, 0.85, 0.96, 0.95, 0.8)], "r DOUBLE")
    got = [(r[0], r[1]) for r in risks.select(S.alert_level("r"), S.severity_class("r")).collect()]
    assert [g[0] for g in got] == ["LOW", "MEDIUM", "HIGH", "CRITICAL", "CRITICAL", "HIGH"]
    assert [g[1] for g in got] == ["medium", "medium", "critical", "critical", "critical", "high"]


def test_messages_round_like_printf(spark):
    values = [0.125, 0.375, 0.015, 0.5, 1.005, 0.995]
    df = spark.createDataFrame([(v,) for v in values], "r DOUBLE").select(S.alert_message(F.lit("HIGH"), "r", F.lit(18)))
    assert [r[0] for r in df.collect()] == [f"Alert: HIGH - Risk: {v:.2f} - Stations: 18" for v in values]


def test_ids_and_times(spark):
    df = spark.createDataFrame([("iv.caam.00.hhz",), ("IV.CAFL.EHZ",), ("IV.CSOB",)], "id STRING")
    got = [tuple(r) for r in df.select(*S.station_id_parts("id").values()).collect()]
    assert got == [("IV", "CAAM", "HHZ"), ("IV", "CAFL", "EHZ"), ("IV", "CSOB", None)]
    with pytest.raises(Exception, match="without network and station"):
        spark.createDataFrame([("CAAM",)], "id STRING").select(*S.station_id_parts("id").values()).collect()
    texts = ["2024-01-01T00:00:00", "2024-01-01 01:00:00+01:00", "1704067200", "soon"]
    times = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING").withColumn("at", S.parse_mixed_time("t"))
    assert [r["at"] for r in times.orderBy("i").collect()] == [datetime(2024, 1, 1)] * 3 + [None]
    with pytest.raises(ValueError, match="3"):
        S.require_times(times, "i", "at")


def test_iqr_goes_column_by_column(spark):
    rows = [(float(i), float(i % 5)) for i in range(20)] + [(500.0, 2.0), (None, 1.0), (3.0, 90.0)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE")
    pdf = df.toPandas()
    for c in ("a", "b"):
        q1, q3 = pdf[c].quantile([0.25, 0.75])
        pdf = pdf[(pdf[c] >= q1 - 1.5 * (q3 - q1)) & (pdf[c] <= q3 + 1.5 * (q3 - q1))]
    assert sorted(map(tuple, Q.filter_iqr(df).collect())) == sorted(map(tuple, pdf.to_numpy()))


def test_lookback_keeps_a_table_without_times(spark):
    now = F.lit("2024-01-10 00:00:00").cast("timestamp")
    df = spark.createDataFrame([(1, None), (2, None)], "i INT, timestamp TIMESTAMP")
    assert Q.filter_time_lookback(df, now, 3).count() == 2
    mixed = spark.createDataFrame([(1, None), (2, datetime(2024, 1, 9)), (3, datetime(2024, 1, 1))], "i INT, timestamp TIMESTAMP")
    assert [r["i"] for r in Q.filter_time_lookback(mixed, now, 3).collect()] == [2]


def test_bands_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 2.0001, 10, 9.9)], "v DOUBLE")
    got = [r[0] for r in df.select(S.freq_band("v", F.lit(0.0), F.lit(10.0))).collect()]
    assert got == ["very_low", "very_low", "very_low", "low", "very_high", "very_high"]


def test_b_value(spark):
    sizes = [(float(m),) for m in range(6, 16) for _ in range(2 ** (15 - m))]
    row = A.gutenberg_richter_b(spark.createDataFrame(sizes, "magnitude DOUBLE")).first()
    counts = {m: sum(1 for s, in sizes if s >= m) for m in range(6, 16)}
    import numpy as np

    slope, intercept = np.polyfit(list(counts), np.log10(list(counts.values())), 1)
    assert abs(row["b_value"] + slope) < 1e-9 and abs(row["a_value"] - intercept) < 1e-9
    assert A.gutenberg_richter_b(spark.createDataFrame([(7.0,)], "magnitude DOUBLE")).first()["b_value"] is None


def test_permutation_p_is_repeatable_and_small_for_a_trend(spark):
    rows = [(f"P{i:02d}", float(i % 6), float(i // 6), float(i // 6) + 0.01 * (i % 6)) for i in range(36)]
    df = spark.createDataFrame(rows, "k STRING, x DOUBLE, y DOUBLE, v DOUBLE")
    first, second = (SP.moran_permutation_p(df, "k", "v", 4, permutations=199).first() for _ in range(2))
    assert first == second and first["moran_i"] > 0.5 and first["p_sim"] == 1 / 200


def test_grids_of_different_shape(spark):
    grid = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0)], "ix INT, iy INT, v DOUBLE")
    assert J.grid_diff(grid, grid, "v").agg(F.sum("difference")).first()[0] == 0
    with pytest.raises(ValueError):
        J.grid_diff(grid, grid.limit(1), "v")


def test_permutations_are_permutations():
    for n in (1, 2, 3, 7, 26, 100, 257):
        for perm in (1, 2, 999):
            slots = np.arange(n)
            assert sorted(SP.permuted(slots, np.full(n, n), np.full(n, perm), 42).tolist()) == slots.tolist()
    dealt = [tuple(SP.permuted(np.arange(4), np.full(4, 4), np.full(4, p), 42).tolist()) for p in range(1, 1000)]
    assert len(set(dealt)) == 24  # every order of four occurs


def test_permutation_p_by_group_is_one_plan_without_a_sort(spark):
    rows = [(g, f"p{k}", float(k % 7), float(k // 7), float((k % 7) * (1 if g == "a" else (k * 37 % 11)))) for g in "ab" for k in range(42)]
    df = spark.createDataFrame(rows, "g STRING, k STRING, x DOUBLE, y DOUBLE, v DOUBLE")
    single = {g: SP.moran_permutation_p(df.filter(F.col("g") == g), "k", "v", 4, permutations=99).first() for g in "ab"}
    edges = reduce(DataFrame.unionByName, [join_knn(df.filter(F.col("g") == g), "k", 4).withColumn("g", F.lit(g)) for g in "ab"])
    seen = []
    kept = SP.durable
    SP.durable = lambda d: (seen.append(d._jdf.queryExecution().executedPlan().toString()), kept(d))[1]
    try:
        both = SP.moran_permutation_p(df, "k", "v", 4, permutations=99, edges=edges, by=["g"]).collect()
    finally:
        SP.durable = kept
    for r in both:
        assert abs(r["moran_i"] - single[r["g"]]["moran_i"]) < 1e-12 and r["p_sim"] == single[r["g"]]["p_sim"]
    wide = [plan for plan in seen if "MapInArrow" in plan]
    assert len(wide) == 1 and "Window" not in wide[0].split("MapInArrow")[0] and "Sort" not in wide[0].split("MapInArrow")[0]
