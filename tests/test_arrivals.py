"""Files judged by their own headers, at once and on a stream."""

import pytest
from pyspark.sql import functions as F

from lakewarden.contracts import Contract
from lakewarden.plans.files import run_files
from lakewarden.plans.layers import Lake, LoadKey
from lakewarden.sources.arrivals import file_lines
from lakewarden.sources.records import read_records
from lakewarden.streaming.ingest import ingest, landing_stream

CONTRACT = Contract.of({"table": "meters", "version": "1.0.0", "manifest_status": "VALIDATED", "schema": [
    {"name": "meter", "type": "integer", "nullable": False, "primary_key": True},
    {"name": "town", "type": "string", "nullable": False},
    {"name": "reading", "type": "float"}]})
FILES = {
    "a.csv": "meter,town,reading\n1,Oslo,2.5\n2,Bergen,\n",
    "b.csv": "﻿town,reading,meter\nTurku,7,3\n\"Åbo, old\",8,4\n",
    "c.csv": "meter,note,town\n5,\"say \"\"hi\"\"\",Vaasa\n6,,Kemi\n6,x,Kemi\n",
    "d.csv": "meter,reading\n7,1\n",
    "e.csv": "meter,town,reading\nx,Oslo,1\n",
    "f.csv": "meter,town,reading\n8,Oslo,1,surplus\n9,Oslo,2\n",
    "g.csv": "meter,town,reading\n10,,1\n\n11\n",
    "h.csv": "meter,town,reading\r\n",
    "i.csv": "town,meter,town,\nOslo,12,Rovaniemi,z\n",
    "j.csv": "meter,town,reading\n13,\"two\nlines\",1\n",
}
WANTED = {
    "a": ("PASS", None, 2), "b": ("PASS", None, 2), "c": ("WARNING", "NON_BREAKING", 3), "d": ("DLQ", "BREAKING", 1), "e": ("DLQ", "BREAKING", 1),
    "f": ("DLQ", None, 2), "g": ("WARNING", None, 2), "h": ("PASS", None, 0), "i": ("WARNING", "NON_BREAKING", 1), "j": ("DLQ", None, 2)}


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for name, text in FILES.items():
        (folder / name).write_bytes(text.encode())
    return folder


def outcome(spark, lake):
    name = F.substring(F.element_at(F.split("_file", "/"), -1), 1, 1)
    results = spark.read.parquet(lake.path("bronze", "meters__files"))
    return results.withColumn("name", name), spark.read.parquet(lake.path("silver", "meters")).withColumn("name", name)


def check(spark, lake):
    results, silver = outcome(spark, lake)
    found = {r["name"]: r for r in results.collect()}
    assert {k: (r["status"], r["evolution_type"], r["rows_total"]) for k, r in found.items()} == WANTED
    assert found["c"]["warnings"] == ["New columns detected (non-breaking): note", "1 duplicate rows (33.3%)"] and found["c"]["rows_valid"] == 2
    assert found["d"]["issues"] == ["Required columns missing: town"] and found["g"]["null_violations"] == {"town": 100.0}
    assert found["f"]["issues"] == ["1 of 2 lines have too many fields or an open quote"]
    rows = {(r["name"], r["meter"], r["town"], r["reading"], tuple(sorted(r["_extra"].items()))) for r in silver.collect()}
    assert rows == {
        ("a", "1", "Oslo", "2.5", ()), ("a", "2", "Bergen", None, ()), ("b", "3", "Turku", "7", ()), ("b", "4", "Åbo, old", "8", ()),
        ("c", "5", "Vaasa", None, (("note", 'say "hi"'),)), ("c", "6", "Kemi", None, (("note", None),)), ("c", "6", "Kemi", None, (("note", "x"),)),
        ("g", "10", None, "1", ()), ("g", "11", None, None, ()), ("i", "12", "Oslo", None, (("col_004", "z"), ("town.1", "Rovaniemi")))}
    away = spark.read.parquet(lake.path("quarantine", "meters"))
    assert away.count() == 6 and away.where("size(_issues) = 1 and _status = 'DLQ'").count() == 6
    records = read_records(spark, lake.path("metrics"))
    assert records.count() == len(FILES) and records.select("run_id").distinct().count() == len(FILES)
    scores = {r["rows_total"]: r["quality_score"] for r in records.where("validation_status = 'PASS' and rows_total > 0").collect()}
    assert scores == {2: 100.0} or set(scores.values()) <= {83.3, 100.0}


def test_files_at_once(spark, tmp_path, landing):
    lake = Lake(str(tmp_path / "lake"))
    for _ in range(2):  # a second run replaces the first
        run_files(file_lines(spark, str(landing)), lake, LoadKey("meters", "r1"), CONTRACT, "2024-01-01T00:00:00")
    check(spark, lake)


@pytest.mark.parametrize("max_files", [None, 3])
def test_files_on_a_stream(spark, tmp_path, landing, max_files):
    lake = Lake(str(tmp_path / "lake"))
    for _ in range(2):  # nothing new has landed the second time
        ingest(landing_stream(spark, str(landing), max_files=max_files), CONTRACT, lake, str(tmp_path / "cp"), timestamp="2024-01-01T00:00:00").awaitTermination()
    check(spark, lake)


def test_headers_of_split_files(spark, tmp_path, landing):
    """Files cut into many blocks have one header each."""
    (landing / "k.csv").write_text("town,meter\n" + "".join(f"T{k},{100 + k}\n" for k in range(2000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        lines = file_lines(spark, str(landing)).where(F.col("_file").endswith("k.csv"))
        lake = Lake(str(tmp_path / "lake"))
        row = run_files(lines, lake, LoadKey("meters", "r1"), CONTRACT, "2024-01-01T00:00:00").first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert (row["status"], row["rows_total"], row["duplicate_count"]) == ("PASS", 2000, 0)
    assert spark.read.parquet(lake.path("silver", "meters")).where("town = concat('T', meter - 100)").count() == 2000


def test_other_encodings_and_separators(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_bytes("town;meter\nMalmö;1\n".encode("latin-1"))
    lake = Lake(str(tmp_path / "lake"))
    run_files(file_lines(spark, str(tmp_path / "in"), "latin-1"), lake, LoadKey("meters", "r1"), CONTRACT, "2024-01-01T00:00:00", ";")
    assert spark.read.parquet(lake.path("silver", "meters")).first()["town"] == "Malmö"
