"""File sources, key rules of the sinks, and loading runs twice."""

import gzip
import hashlib
import json
import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tremorlake.operators.quality import CheckFailed, normalize_alerts
from tremorlake.schemas import KEYS, WAREHOUSE, table_schema
from tremorlake.sources import files, ingest, sinks, star, versioned as versioned_module
from tremorlake.sources.pieces import PIECE_BYTES, PieceReader
from tremorlake.sources.versioned import ConcurrentWrite, VersionedTable, by_day, by_value


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_csv_names_missing_columns_and_reads_gzip(spark, tmp_path):
    path = tmp_path / "a.csv.gz"
    with gzip.open(path, "wt") as out:
        out.write("station,delta_seconds\nST01,0.5\nST02,bad\n")
    df = files.scan_csv_checked(spark, str(path), ["station", "delta_seconds"], {"delta_seconds": "double"})
    assert [tuple(r) for r in df.orderBy("station").collect()] == [("ST01", 0.5), ("ST02", None)]
    with pytest.raises(CheckFailed, match="latitude, longitude"):
        files.scan_csv_checked(spark, str(path), ["station", "longitude", "latitude"])


def test_code_list_keeps_first_mentions_in_order(spark, tmp_path):
    path = write(tmp_path / "codes.txt", "# stations\n\nCAAM, CAFL ,,CSOB\n  CPOZ CAAM\r\n#x\nCAFL,CMSN\n")
    assert [r["code"] for r in files.scan_code_list(spark, path).collect()] == ["CAAM", "CAFL", "CSOB", "CPOZ", "CMSN"]


HEADER = "#EventID|Time|Latitude|Longitude|Depth/Km|Author|Catalog|Contributor|ContributorID|MagType|Magnitude|MagAuthor|EventLocationName|EventType"


def test_event_catalogue_text(spark, tmp_path):
    rows = "1|2025-11-01T05:30:00 |40.8| 14.1|2.5|A|B|C|D|ML| 1.1|E|Here|earthquake\n2|2025-11-02T05:30:00|40.9|14.2|3.0|A|B|C|D|Md|3.9|E|There|earthquake\n"
    path = write(tmp_path / "events.txt", HEADER + "\n" + rows)
    got = files.scan_event_catalog(spark, path).orderBy("event_id").collect()
    assert [r["magnitude"] for r in got] == [1.1, 3.9]
    assert got[0]["time"] == "2025-11-01T05:30:00" and got[0]["longitude"] == 14.1
    with pytest.raises(CheckFailed, match="Magnitude"):
        files.scan_event_catalog(spark, write(tmp_path / "bad.txt", HEADER.replace("|Magnitude|", "|Mag|") + "\n" + rows))


def test_json_documents_and_lines(spark, tmp_path):
    record = {"station": "A", "risk_score": 0.5}
    documents = {
        "list.json": [record, record],
        "alerts.json": {"alerts": [record]},
        "items.json": {"items": [record, record, record]},
        "one.json": record,
    }
    for name, value in documents.items():
        write(tmp_path / "docs" / name, json.dumps(value, indent=2))
    write(tmp_path / "docs" / "broken.json", '{"station": ')
    assert files.scan_json_records(spark, str(tmp_path / "docs")).filter("station = 'A'").count() == 7
    lines = write(tmp_path / "log.jsonl", json.dumps(record) + "\n\n{broken\n" + json.dumps({**record, "type": "ERROR"}) + "\n")
    assert [r["type"] for r in files.scan_json_records(spark, lines).orderBy("type").collect()] == [None, "ERROR"]


def test_recent_files_of_mixed_formats(spark, tmp_path):
    write(tmp_path / "a" / "one.csv", "station,risk\nA,0.5\n")
    write(tmp_path / "b" / "c" / "two.jsonl", '{"station": "B", "risk": 0.7}\n')
    write(tmp_path / "three.json", json.dumps({"alerts": [{"station": "C", "extra": 1}]}))
    old = write(tmp_path / "old.csv", "station,risk\nOLD,0.5\n")
    os.utime(old, (1_500_000_000, 1_500_000_000))
    stamp = datetime.fromtimestamp(time.time() - 3600).strftime("%Y-%m-%dT%H:%M:%S")
    got = files.scan_recent_files(spark, str(tmp_path), stamp).orderBy("station").collect()
    assert [(r["station"], r["risk"]) for r in got] == [("A", "0.5"), ("B", "0.7"), ("C", None)]
    assert got[1]["source_file"].endswith("two.jsonl") and got[0]["source_mtime"] is not None


def test_files_with_different_headers_go_by_name(spark, tmp_path):
    root = tmp_path / "some runs+more"
    write(root / "run[1]" / "in" / "d.csv", "event_id,station\n1,AAA\n")
    write(root / "run 2" / "in" / "d.csv", "station,event_id,extra\nBBB,2,x\n")
    write(root / "run3" / "in" / "d.csv", "event_id,station\n3,CCC\n")
    write(root / "run4" / "in" / "d.csv", "")
    got = files.scan_runs(spark, str(root), "in/d.csv", ["event_id", "station"]).orderBy("event_id").collect()
    assert [(r["event_id"], r["station"], r["extra"]) for r in got] == [("1", "AAA", None), ("2", "BBB", "x"), ("3", "CCC", None)]
    paths = [str(root / name / "in" / "d.csv") for name in ("run 2", "run3")]
    read = files.scan_csv_checked(spark, paths, ["event_id"], {"event_id": "bigint"}).orderBy("event_id").collect()
    assert [(r["event_id"], r["station"]) for r in read] == [(2, "BBB"), (3, "CCC")]
    with pytest.raises(CheckFailed, match="extra"):
        files.scan_runs(spark, str(root), "in/d.csv", ["extra"])


def test_recent_files_of_different_columns(spark, tmp_path):
    write(tmp_path / "one.csv", "station,risk\nA,0.5\n")
    write(tmp_path / "b" / "two.csv", "risk,station\n0.7,B\n")
    write(tmp_path / "three.jsonl", '{"station": "C"}\n{"station": \n{"station": "D", "risk": 1}\n')
    spark.createDataFrame([("E",)], "station STRING").coalesce(1).write.parquet(str(tmp_path / "p"))
    spark.createDataFrame([("F", 2.5)], "station STRING, depth DOUBLE").coalesce(1).write.mode("append").parquet(str(tmp_path / "p"))
    got = files.scan_recent_files(spark, str(tmp_path), "2000-01-01T00:00:00").orderBy("station").collect()
    assert [(r["station"], r["risk"], r["depth"]) for r in got] == [
        ("A", "0.5", None),
        ("B", "0.7", None),
        ("C", None, None),
        ("D", "1", None),
        ("E", None, None),
        ("F", None, 2.5),
    ]


def test_hashes(spark, tmp_path):
    path = write(tmp_path / "f.bin", "hello")
    got = {r["file_path"]: r["sha256"] for r in files.audit_file_hash(spark, [path, str(tmp_path / "none")]).collect()}
    assert got == {path: hashlib.sha256(b"hello").hexdigest(), str(tmp_path / "none"): "N/A"}
    assert files.audit_file_hash(spark, [str(tmp_path / "none")]).first()["sha256"] == "N/A"


def sha(*parts):
    return hashlib.sha256(b"".join(parts)).hexdigest()


def test_hashes_of_pieces_and_folders(spark, tmp_path):
    root = tmp_path / "a b%20c"
    (root / "deep").mkdir(parents=True)
    (root / "_temporary").mkdir()
    big = bytes(range(256)) * 10
    contents = {"part-1": big, "part-0": b"", "deep/x": b"xyz", "_SUCCESS": b"no", ".part-1.crc": b"no", "_temporary/y": b"no"}
    for name, data in contents.items():
        (root / name).write_bytes(data)
    (tmp_path / "empty").mkdir()
    asked = [str(root / "part-1"), str(root / "part-0"), str(root), str(tmp_path / "empty"), str(root / "part-1")]
    rows = files.audit_file_hash(spark, asked, piece_bytes=1000).collect()
    assert len(rows) == 5  # what is asked for twice is answered twice
    got = {r["file_path"]: (r["file_size_bytes"], r["sha256"]) for r in rows}
    pieces = [sha(big[i : i + 1000]) for i in range(0, len(big), 1000)]
    assert got[asked[0]] == (2560, sha("".join(pieces).encode()))
    assert got[asked[1]] == (0, sha(b""))
    assert got[asked[2]] == (2563, sha("".join([sha(b"xyz"), sha(b""), *pieces]).encode()))
    assert got[asked[3]] == (None, "N/A")
    assert files.audit_file_hash(spark, asked[:1]).first()["sha256"] == sha(big)  # one piece: the plain hash
    assert files.audit_file_hash(spark, []).count() == 0


def test_large_files_are_hashed_by_several_tasks(tmp_path):
    path = tmp_path / "large"
    with open(path, "wb") as f:
        f.truncate(5 * 2**30)  # a hole: nothing is written
    tasks = PieceReader([f"file:{path}"], PIECE_BYTES).partitions()
    assert [[p.length for p in task.pieces] for task in tasks] == [[2**31], [2**31], [2**30]]
    small = PieceReader([f"file:{path}"], 2**25).partitions()
    assert {len(task.pieces) for task in small} == {4} and len(small) == 40  # small pieces share tasks
    with pytest.raises(ValueError):
        PieceReader([], 0)


def test_waveform_names(spark, tmp_path):
    rows = [(f"x/{name}", 0.0, 1.0, [1.0]) for name in ("ev1_IV_CAAM_HHZ.mseed", "a_b_IV_cafl_HHN.mseed", "ev2_IV_ST01_00_HHZ.mseed", "IV_CAAM_HHZ.mseed")]
    spark.createDataFrame(rows, "file STRING, start DOUBLE, rate DOUBLE, samples ARRAY<DOUBLE>").write.parquet(str(tmp_path / "w"))
    got = files.scan_waveform_chunks(spark, str(tmp_path / "w")).orderBy("event_key").collect()
    assert [(r["event_key"], r["network"], r["station_code"], r["channel"]) for r in got] == [
        ("a", "B", "IV", "CAFL_HHN"),
        ("ev1", "IV", "CAAM", "HHZ"),
        ("ev2", "IV", "ST01", "00_HHZ"),
    ]


def test_key_rules_on_disk(spark, tmp_path):
    schema, path = table_schema("k:str v:int extra:str"), str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1), ("b", 2), ("b", 9), (None, 7)], "k STRING, v INT")
    assert sinks.insert_ignore(first, path, schema, ["k"], ["v"]) == 3
    assert sinks.insert_ignore(first, path, schema, ["k"], ["v"]) == 0
    assert sorted((r["k"] or "", r["v"]) for r in spark.read.parquet(path).collect()) == [("", 7), ("a", 1), ("b", 2)]
    change = spark.createDataFrame([("b", 5), ("c", 6)], "k STRING, v INT")
    assert sinks.upsert(change, path, schema, ["k"]) == 4
    assert sinks.upsert(change, path, schema, ["k"]) == 4
    assert sorted((r["k"] or "", r["v"]) for r in spark.read.parquet(path).collect()) == [("", 7), ("a", 1), ("b", 5), ("c", 6)]


def test_partitions_limit_what_is_read_and_replaced(spark, tmp_path):
    schema, path = table_schema("k:str part:str v:int"), str(tmp_path / "t")
    first = spark.createDataFrame([("a", "x", 1), ("b", "y", 2), ("c", None, 3)], "k STRING, part STRING, v INT")
    assert sinks.insert_ignore(first, path, schema, ["k", "part"], partition="part") == 3
    assert sinks.insert_ignore(first, path, schema, ["k", "part"], partition="part") == 0
    kept = sorted(p.name for p in (tmp_path / "t" / "part=y").glob("*.parquet"))
    more = spark.createDataFrame([("a", "x", 9), ("d", "x", 4)], "k STRING, part STRING, v INT")
    assert sinks.insert_ignore(more, path, schema, ["k", "part"], partition="part") == 1
    assert sinks.upsert(more, path, schema, ["k", "part"], partition="part") == 2
    assert sorted(p.name for p in (tmp_path / "t" / "part=y").glob("*.parquet")) == kept
    got = spark.read.schema(schema).parquet(path).select("k", "v").collect()
    assert sorted(map(tuple, got)) == [("a", 9), ("b", 2), ("c", 3), ("d", 4)]
    plan = sinks._touched(spark.read.schema(schema).parquet(path), more, "part")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part" in plan.replace("isnotnull(part", "part")
    with pytest.raises(ValueError):
        sinks.upsert(more, path, schema, ["k"], partition="part")


RAW = "event_id,network,station,channel,arrival_epoch,arrival_iso,event_reference_epoch,delta_seconds\n"
RUN = RAW + "ev1,IV,ST01,HHZ,10.0,2025-11-01T00:00:10,9.5,0.5\nev1,IV,ST02,HHZ,11.0,2025-11-01T00:00:11,9.5,1.5\nev2,IV,ST01,HHZ,20.0,not a time,19.0,1.0\n"
STATS = "station,base_count,base_mean,base_std,base_median\nST01,5,0.1,0.2,0.1\nST02,6,0.3,0.2,0.1\n"
SPATIAL = "station,latitude,longitude,x_m,y_m,base_mean\nCAAM,40.8,14.1,430000,4520000,0.2\nCAFL,40.9,14.2,431000,4521000,0.4\n"


def make_runs(tmp_path):
    for run in ("first", "second"):
        write(tmp_path / run / "interim" / "station_deltas.csv", RUN)
    write(tmp_path / "first" / "processed" / "station_stats.csv", STATS)
    write(tmp_path / "first" / "processed" / "deltas_spatial.csv", SPATIAL)
    write(tmp_path / "second" / "processed" / "station_stats.csv", "base_count\n1\n")
    write(tmp_path / "first" / "catalog_events.csv", "event_id,time,latitude,longitude,magnitude\n7,2025-11-01T05:30:00,40.8,14.1,4.0\n8,bad,1,2,3\n")
    energy = "network,station,channel,window_epoch,window_iso,rms,peak\nIV,ST01,HHZ,0,2025-11-01T00:00:00,10,100\n"
    write(tmp_path / "first" / "interim" / "station_energy_hourly.csv", energy)


def test_runs_load_once_however_often(spark, tmp_path):
    make_runs(tmp_path)
    warehouse = str(tmp_path / "warehouse")
    now = datetime(2025, 12, 1, 12)
    for _ in range(2):
        audit = ingest.ingest_all_runs(spark, str(tmp_path), ["first", "second"], warehouse, now=now)

    def table(name):
        return ingest.warehouse_table(spark, warehouse, name)

    assert table("raw_deltas").count() == 6 and table("raw_deltas").filter("arrival_iso IS NULL").count() == 2
    assert table("station_stats").count() == 2 and table("catalog_events").count() == 1
    assert table("waveform_energy_hourly").first()["peak"] == 100.0
    spatial = table("deltas_spatial").orderBy("station_code").first()
    assert (spatial["station_code"], spatial["easting"], spatial["delta_type"]) == ("CAAM", 430000.0, "base_mean")
    assert table("stations").orderBy("station_code").first()["northing"] == 4520000.0
    runs = table("runs").orderBy("run_id").collect()
    assert [r["run_name"] for r in runs] == ["first", "second"]
    assert runs[0]["raw_deltas_hash"] == hashlib.sha256(RUN.encode()).hexdigest()
    status = {(r["run_id"], r["table_name"]): (r["status"], r["rows_read"]) for r in audit.collect()}
    assert status[("second", "station_stats")] == ("failed", None)
    assert status[("second", "deltas_spatial")] == ("skipped", None)
    assert status[("first", "raw_deltas")] == ("success", 3)
    with pytest.raises(CheckFailed):
        ingest.ingest_run(spark, "second", str(tmp_path / "second"), str(tmp_path / "other"), stop_at_first=True)


def test_empty_results_are_typed(spark):
    df = sinks.empty_result(spark, WAREHOUSE["raw_deltas"])
    assert df.count() == 0 and df.columns[:2] == ["run_id", "event_id"] and set(KEYS) == set(WAREHOUSE)
    assert ingest.warehouse_table(spark, "/no/such/warehouse", "stations").count() == 0


def test_geojson_features(spark):
    points = spark.createDataFrame([(1, 14.1, 40.8)], "event_id INT, longitude DOUBLE, latitude DOUBLE")
    made = json.loads(sinks.geojson_features(points, ["event_id"]).first()["feature"])
    assert made == {"type": "Feature", "geometry": {"type": "Point", "coordinates": [14.1, 40.8]}, "properties": {"event_id": 1}}


def test_download_plan_cuts_the_last_block(spark):
    stations = spark.createDataFrame([("IV", "CAAM")], "network STRING, station_code STRING")
    plan = star.download_plan(stations, ["HHZ"], "2024-01-01 00:00:00", "2024-01-01 05:00:00", 0.1).orderBy("block_start").collect()
    assert len(plan) == 3 and plan[-1]["block_end"] == datetime(2024, 1, 1, 5) and plan[0]["file_key"] == "20240101T000000_IV_CAAM_HHZ"
    with pytest.raises(ValueError):
        star.download_plan(stations, ["HHZ"], "2024-01-01", "2024-01-02", 0.05)


class Lost(Exception):
    pass


def versioned(spark, tmp_path, **kinds):
    return VersionedTable(spark, str(tmp_path / "vt"), table_schema("k:str day:ts v:int"), ["k", "day"], by_day("day"), **kinds)


def rows_of(df):
    return sorted((r["k"], r["day"] and r["day"].day, r["v"]) for r in df.collect())


def batch_of(spark, rows):
    made = [(k, day and datetime(2025, 1, day, 5), v) for k, day, v in rows]
    return spark.createDataFrame(made, "k STRING, day TIMESTAMP, v INT")


def test_versions_and_what_they_touch(spark, tmp_path):
    table = versioned(spark, tmp_path)
    assert table.read().count() == 0 and not table.exists()
    assert table.insert_ignore(batch_of(spark, [("a", 1, 1), ("a", 1, 0), ("b", 2, 2), ("c", None, 3)])) == 3
    assert table.insert_ignore(batch_of(spark, [("a", 1, 9), ("b", 2, 9)])) == 0
    assert table.versions() == [1] and table.rows() == 3
    first = table.manifest()[1]
    assert table.upsert(batch_of(spark, [("b", 2, 5), ("d", 2, 6), ("d", 2, 7)])) == 2
    second = table.manifest()[1]
    assert {p for p in second if second[p] != first.get(p)} == {"2025-01-02"}  # nothing else is rewritten
    assert rows_of(table.read()) == [("a", 1, 0), ("b", 2, 5), ("c", None, 3), ("d", 2, 7)]
    assert rows_of(table.read(1)) == [("a", 1, 0), ("b", 2, 2), ("c", None, 3)]
    assert rows_of(table.read(parts=["2025-01-02", "2030-01-01"])) == [("b", 2, 5), ("d", 2, 7)]
    assert table.insert_ignore(batch_of(spark, [])) == 0 and table.upsert(batch_of(spark, [])) == 0
    assert table.vacuum(keep=1) == 1 and rows_of(table.read())[1] == ("b", 2, 5)
    with pytest.raises(ValueError):
        table.read(1)


def test_a_failure_before_the_switch_leaves_the_old_version(spark, tmp_path, monkeypatch):
    table = versioned(spark, tmp_path)
    table.insert_ignore(batch_of(spark, [("a", 1, 1), ("b", 2, 2)]))

    def lose(*_):
        raise Lost

    with monkeypatch.context() as broken:
        broken.setattr(VersionedTable, "_publish", lose)
        for write in (table.upsert, table.insert_ignore):
            with pytest.raises(Lost):
                write(batch_of(spark, [("a", 1, 8), ("e", 1, 8)]))
    assert table.versions() == [1] and rows_of(table.read()) == [("a", 1, 1), ("b", 2, 2)]
    table.upsert(batch_of(spark, [("a", 1, 3)]))
    assert rows_of(table.read()) == [("a", 1, 3), ("b", 2, 2)]
    assert table.vacuum(keep=2) == 2  # the files of the two lost writes


def test_vacuum_deletes_replaced_pieces_only(spark, tmp_path):
    schema = table_schema("k:str v:int")
    table = VersionedTable(spark, str(tmp_path / "vt"), schema, ["k"], by_value("k"))
    put = lambda write, rows: write(spark.createDataFrame(rows, "k STRING, v INT"))
    put(table.insert_ignore, [("a/b:1 %", 1), ("c", 2), (None, 3)])
    put(table.upsert, [("a/b:1 %", 4)])
    put(table.upsert, [("c", 5)])
    pieces = lambda: sum(len(list(commit.glob("part=*"))) for commit in (tmp_path / "vt" / "data").iterdir())
    assert pieces() == 5
    assert table.vacuum(keep=2) == 1 and pieces() == 4  # "a/b:1 %" of the first commit; version 2 still names its "c"
    assert table.read(2).count() == 3
    assert table.vacuum(keep=1) == 1 and pieces() == 3 and table.vacuum(keep=1) == 0
    assert {(r["k"], r["v"]) for r in table.read().collect()} == {("a/b:1 %", 4), ("c", 5), (None, 3)}


def test_the_later_of_two_writers_is_told(spark, tmp_path, monkeypatch):
    one, two = versioned(spark, tmp_path), versioned(spark, tmp_path)
    one.insert_ignore(batch_of(spark, [("a", 1, 1)]))
    old = two.manifest()
    one.upsert(batch_of(spark, [("a", 1, 2)]))
    monkeypatch.setattr(two, "manifest", lambda version=None: old)
    with pytest.raises(ConcurrentWrite):
        two.upsert(batch_of(spark, [("a", 1, 3)]))
    assert rows_of(one.read()) == [("a", 1, 2)]


def test_small_pieces_are_folded_and_names_are_escaped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versioned_module, "FOLDED", 2)
    table = VersionedTable(spark, str(tmp_path / "t"), table_schema("run:str k:int"), ["run", "k"], by_value("run"))
    for k in range(4):
        frame = spark.createDataFrame([("a/b c:1%", k), ("", k), (None, k)], "run STRING, k INT")
        assert table.insert_ignore(frame) == 3
    assert sorted(len(p) for p in table.manifest()[1].values()) == [2, 2] and table.rows() == 12
    assert table.read().filter("run = 'a/b c:1%'").count() == 4
    hashed = VersionedTable(spark, str(tmp_path / "h"), table_schema("k:int v:int"), ["k"], buckets=4)
    assert hashed.insert_ignore(spark.range(100).selectExpr("cast(id as int) k", "1 v")) == 100
    hashed.upsert(spark.createDataFrame([(7, 2)], "k INT, v INT"))
    assert sum(p != q for p, q in zip(hashed.manifest(1)[1].values(), hashed.manifest(2)[1].values())) == 1
    assert hashed.read().filter("v = 2").count() == 1 and hashed.rows() == 100


def test_headers_of_files_and_folders(spark, tmp_path):
    plain = write(tmp_path / "a.csv", 'x,"y,z"\n1,2\n')
    with gzip.open(tmp_path / "b.csv.gz", "wt") as out:
        out.write("u,v\n")
    spark.createDataFrame([(1,)], "q INT").write.option("header", True).csv(str(tmp_path / "c.csv"))
    paths = [plain, str(tmp_path / "b.csv.gz"), str(tmp_path / "c.csv"), write(tmp_path / "d.csv", "")]
    assert files.csv_headers(spark, paths) == [("x", "y,z"), ("u", "v"), ("q",), ()]


def test_legacy_features_load_once(spark, tmp_path):
    text = "Tempo,numero_eventi,energia_max,unknown\n2025-01-01 05:00:00,3,1.5,x\n2025-02-01 06:00:00,bad,2.5,x\nnever,1,1,x\n"
    path, warehouse = write(tmp_path / "legacy.csv", text), str(tmp_path / "w")
    assert ingest.ingest_legacy_features(spark, path, warehouse) == (2, 2)
    assert ingest.ingest_legacy_features(spark, path, warehouse) == (2, 0)
    got = ingest.warehouse_table(spark, warehouse, "ml_features_timeseries").orderBy("timestamp").collect()
    assert [(r["timestamp"].month, r["numero_eventi"], r["energia_max"], r["energia_media"]) for r in got] == [(1, 3, 1.5, None), (2, None, 2.5, None)]
    with pytest.raises(CheckFailed):
        ingest.ingest_legacy_features(spark, write(tmp_path / "bad.csv", "hour\n1\n"), warehouse)


def test_runs_in_directories_of_one_name_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="same"):
        ingest.ingest_runs(spark, {"a": str(tmp_path / "x" / "same"), "b": str(tmp_path / "y" / "same")}, str(tmp_path / "w"))


def test_json_records_of_any_fields(spark, tmp_path):
    records = [
        {"created_at": "2025-01-01T00:00:00", "station_code": "A", "probability": "0.9", "lat": "40.5", "lng": 14},
        {"timestamp": "2025-01-02T00:00:00", "station": "B", "risk_score": 0.2, "severity": "WARN", "extra": {"deep": [1, 2]}},
        {"time": 5, "risk_score": "no number", "latitude": [1]},
        "text", 7, None, [1],
    ]
    want = [("A", 0.9, 40.5, 14.0), ("B", 0.2, None, None), (None, None, None, None)]
    write(tmp_path / "d" / "one.json", json.dumps({"results": records}))
    lines = write(tmp_path / "two.jsonl", "\n".join(json.dumps(r) for r in records) + "\n{broken\n")
    for path in (str(tmp_path / "d"), lines):
        read = files.scan_json_records(spark, path)
        assert [tuple(r) for r in read.orderBy(F.col("station").asc_nulls_last()).select("station", "risk_score", "latitude", "longitude").collect()] == want
        alerts = {r["station"]: r for r in normalize_alerts(read).collect()}
        assert (alerts["A"]["severity"], alerts["A"]["timestamp"], alerts["A"]["latitude"]) == ("critical", datetime(2025, 1, 1), 40.5)
        assert alerts["B"]["severity"] == "medium" and alerts["UNKNOWN"]["message"] == ""
