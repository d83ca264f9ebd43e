"""Where a load is: routes, crashes between steps, the registry's revisions, and onboarding."""

import pytest
from pyspark.sql import functions as F

from lakewarden.contracts import Contract
from lakewarden.plans import layers, onboard as onboarding, workload_landing
from lakewarden.plans.layers import Lake, LoadKey, promote_load, quarantine_load, read_route
from lakewarden.plans.scenario import Load, run_load
from lakewarden.sources.landing import file_summaries, normalization_report
from lakewarden.sources.records import read_records
from lakewarden.sources.registry import read_registry, registry_frame, write_registry

KEY = LoadKey("meters", "0012", "baseline", "csv")


def held(spark, lake, layer):
    try:
        return sorted(r["v"] for r in read_route(spark, lake, layer, "meters").collect())
    except Exception:  # noqa: BLE001  no folder yet
        return []


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_a_load_is_on_one_route(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    quarantine_load(rows(spark, "a", "b"), lake, KEY, ["bad"])
    assert held(spark, lake, "quarantine") == ["a", "b"] and held(spark, lake, "silver") == []
    commit = layers._commit

    def broken(*_):
        raise RuntimeError("lost between both steps")

    monkeypatch.setattr(layers, "_commit", broken)
    with pytest.raises(RuntimeError):
        promote_load(rows(spark, "c"), lake, KEY)
    assert held(spark, lake, "quarantine") == ["a", "b"] and held(spark, lake, "silver") == []
    monkeypatch.setattr(layers, "_commit", commit)
    leave = layers._leave_only
    monkeypatch.setattr(layers, "_leave_only", broken)
    with pytest.raises(RuntimeError):
        promote_load(rows(spark, "c"), lake, KEY)
    assert held(spark, lake, "quarantine") == [] and held(spark, lake, "silver") == ["c"]
    monkeypatch.setattr(layers, "_leave_only", leave)
    path = promote_load(rows(spark, "d", "e"), lake, KEY)
    assert held(spark, lake, "silver") == ["d", "e"] and spark.read.parquet(path).columns == ["v"]
    assert spark.read.parquet(lake.path("silver", "meters")).count() == 2  # earlier versions are gone
    promote_load(rows(spark, "f"), lake, LoadKey("meters", "0013", "baseline", "csv"))
    assert held(spark, lake, "silver") == ["d", "e", "f"]


def test_errors_of_the_run_are_not_the_loads(spark, tmp_path, monkeypatch):
    contract = Contract.of({"table": "meters", "version": "1.0.0", "schema": [{"name": "v", "type": "string"}]})
    lake = Lake(str(tmp_path))
    lost = run_load(spark, lake, Load("meters", lambda s: s.read.parquet(f"{tmp_path}/none"), contract), "r1")
    assert lost.record["validation_status"] == "DLQ" and lost.record["issues"][0].startswith("Unreadable")

    def full(*_):
        raise OSError("disk full")

    monkeypatch.setattr("lakewarden.plans.scenario.promote_load", full)
    failed = run_load(spark, lake, Load("meters", lambda s: rows(s, "a"), contract), "r1")
    assert failed.record["validation_status"] == "ERROR" and failed.exit_code == 2 and "disk full" in failed.record["issues"][0]


def test_emptied_registry(spark, tmp_path):
    path = str(tmp_path / "registry")
    one = Contract.of({"table": "meters", "version": "1.0.0", "schema": [{"name": "v", "type": "string"}]})
    assert read_registry(spark, path).count() == 0
    write_registry(registry_frame(spark, [one]), path)
    write_registry(read_registry(spark, path).where("false"), path)
    assert read_registry(spark, path).count() == 0
    write_registry(registry_frame(spark, [one, one]), path)
    # a revision that was only half written does not count
    registry_frame(spark, []).write.parquet(f"{path}/_revision=3")
    assert read_registry(spark, path).count() == 2
    write_registry(read_registry(spark, path).limit(1), path)
    assert read_registry(spark, path).count() == 1


FILES = {
    "plain.txt": b"a\nb\n", "no_end.txt": b"a\nb", "utf.txt": "é\nb\n".encode(), "bom.txt": b"\xef\xbb\xbfa\n", "crlf.txt": b"a\r\nb\r\n", "crlf_no_end.txt": b"a\r\nb",
    "mixed.txt": b"a\r\nb\nc\n", "cr.txt": b"a\rb\rc", "cr_end.txt": b"a\rb\r", "lf_cr.txt": b"a\rb\nc\n", "cr_after.txt": b"a\nb\r", "latin.txt": "é a\nb\n".encode("latin-1"),
    "wide.txt": b"\xff\xfe" + "a\r\nb\r\n".encode("utf-16-le"), "wide_lf.txt": b"\xff\xfe" + "a\nb".encode("utf-16-le"), "ebcdic.txt": "HELLO WORLD A B".encode("cp037"), "blank.txt": b"\n"}


@pytest.mark.parametrize("declared", [None, "cp1252", "cp037"])
def test_summaries_of_splits_equal_whole_files(spark, tmp_path, declared):
    for name, content in FILES.items():
        (tmp_path / name).write_bytes(content)
    columns = ["path", "length", "status", "encoding", "bom_removed", "line_endings", "warning"]
    told = lambda df: sorted((tuple(r)[0].rsplit("/", 1)[-1], *tuple(r)[1:]) for r in df.select(columns).collect())
    whole = told(normalization_report(spark, str(tmp_path), declared))
    assert told(file_summaries(spark, str(tmp_path), declared)) == whole and len(whole) == len(FILES)


def test_summaries_of_many_splits(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("".join(f"line {k} é\r\n" for k in range(3000)).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        row = file_summaries(spark, str(tmp_path)).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert (row["encoding"], row["line_endings"], row["length"]) == ("utf-8", "CRLF->LF", (tmp_path / "a.txt").stat().st_size)


def test_landing_parts_are_dealt_to_tasks_of_their_own(spark):
    docs = spark.createDataFrame([(k if k else None, None if k == 5 else f"text {k}") for k in range(200)], "doc_id long, text string")
    dealt = [(r["task"], r["part"]) for r in workload_landing._dealt(docs).withColumn("task", F.spark_partition_id()).collect()]
    assert len(dealt) == 200 and len({t for t, _ in dealt}) == 16
    assert all(len({p for t, p in dealt if t == task and p}) == 1 for task in range(16))


def test_onboarding(spark, tmp_path):
    landing, lake = tmp_path / "landing", Lake(str(tmp_path / "lake"))
    landing.mkdir()
    (landing / "Meters_2024-01.csv").write_bytes("meter;town\n1;Malmö\n2;Åbo\n".encode("latin-1"))
    (landing / "plants.json").write_text('[{"plant": 1}, {"plant": 2}]')
    ran = lambda run: {(r["table"], r["outcome"]) for r in onboarding.onboard(spark, lake, str(landing), run).collect()}
    assert ran("r1") == {("meters", "AWAITING_REVIEW"), ("plants", "AWAITING_REVIEW")}
    drafts = {r["table"]: r for r in read_registry(spark, lake.path("contracts")).collect()}
    assert drafts["meters"]["source"]["delimiter"] == ";" and drafts["meters"]["source"]["encoding"] == "latin-1" and drafts["meters"]["manifest_status"] == "DRAFT"
    assert ran("r2") == set()
    validated = read_registry(spark, lake.path("contracts")).withColumn("manifest_status", F.when(F.col("table") == "meters", "VALIDATED").otherwise(F.col("manifest_status")))
    write_registry(validated, lake.path("contracts"))
    (landing / "meters_2024-02.csv").write_bytes(b"meter;town;extra\n3;Oslo;x\n")
    (landing / "meters_again.csv").write_bytes((landing / "Meters_2024-01.csv").read_bytes())
    assert ran("r3") == {("meters", "PASS"), ("meters", "WARNING")}
    assert {r["town"] for r in read_route(spark, lake, "silver", "meters").collect()} == {"Malmö", "Åbo", "Oslo"}
    assert ran("r4") == set() and read_records(spark, lake.path("metrics")).count() == 2
    (landing / "meters_2024-03.csv").write_bytes(b"town\nOslo\n")
    assert ran("r5") == {("meters", "DLQ")} or ran("r5") == set()


@pytest.mark.parametrize("path, table", [("s3a://x/Customers_2024-01-31.csv", "customers"), ("/a/tb_x.json", "tb_x"), ("b/2024.csv", "2024"), ("c/orders-7.txt", "orders")])
def test_table_names(path, table):
    assert onboarding.table_of(path) == table
