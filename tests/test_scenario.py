import pytest
from pyspark.sql import functions as F

from lakewarden.contracts import Contract
from lakewarden.plans.layers import LAYERS, Lake
from lakewarden.plans.scenario import Load, consolidated, document_load, run_exit_code, run_matrix, run_scenario
from lakewarden.plans.stored import run_stored_queries
from lakewarden.sources.reader import read_table
from lakewarden.sources.records import read_records
from lakewarden.streaming.ingest import ingest, landing_stream

RAW = {
    "table": "tb_t", "version": "1.0.0", "manifest_status": "VALIDATED",
    "schema": [{"name": "id", "type": "integer", "nullable": False, "primary_key": True},
               {"name": "nome", "type": "string", "nullable": False}],
    "sample_queries": [{"description": "por nome", "sql": "select nome, count(*) as n from tb_t group by nome"}],
}
CONTRACT = Contract.of(RAW)


def csv(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_unknown_layer():
    assert len(LAYERS) == 7
    with pytest.raises(ValueError):
        Lake("/x").path("diamond")


def test_scenario_routes_and_records(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    good = csv(tmp_path, "good.csv", "id,nome\n1,Ana\n2,Bia\n")
    dups = csv(tmp_path, "dups.csv", "id,nome\n1,Ana\n1,\n")
    bad = csv(tmp_path, "bad.csv", "id,nome\nx,Ana\n")

    def contract(table):
        return Contract.of({**RAW, "table": table})

    def broken():
        raise ValueError("version")

    loads = [
        Load("good", lambda s: read_table(s, good), contract("good")),
        Load("dups", lambda s: read_table(s, dups), contract("dups")),
        Load("bad", lambda s: read_table(s, bad), contract("bad")),
        Load("lost", lambda s: read_table(s, str(tmp_path / "nothing.csv")), contract("lost")),
        Load("odd", lambda s: read_table(s, good), broken),
    ]
    outcomes = {o.record["table"]: o for o in run_scenario(spark, lake, loads, "r1", timestamp="2024-01-01T00:00:00")}
    assert {t: o.record["validation_status"] for t, o in outcomes.items()} == {
        "good": "PASS", "dups": "WARNING", "bad": "DLQ", "lost": "DLQ", "odd": "DLQ"}
    assert {t: o.record["quality_score"] for t, o in outcomes.items()} == {
        "good": 100.0, "dups": 40.0, "bad": 20.0, "lost": 30.0, "odd": 30.0}
    assert run_exit_code(list(outcomes.values())) == 2
    assert spark.read.parquet(lake.path("silver", "good")).count() == 2
    quarantined = spark.read.parquet(lake.path("quarantine", "bad")).first()
    assert quarantined["_status"] == "DLQ" and "id" in quarantined["_issues"][0]
    assert spark.read.parquet(lake.path("bronze", "bad")).count() == 1  # bronze keeps its copy
    assert outcomes["lost"].record["issues"][0].startswith("Unreadable") and outcomes["odd"].record["issues"][0].startswith("Invalid")
    run_scenario(spark, lake, loads[:1], "r1", scenario="again", timestamp="2024-01-02T00:00:00")
    assert read_records(spark, lake.path("metrics")).count() == 6 and consolidated(spark, lake, "r1").count() == 6


def test_rerun_replaces(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    path = csv(tmp_path, "a.csv", "id,nome\n1,Ana\n")
    for _ in range(2):
        run_scenario(spark, lake, [Load("t", lambda s: read_table(s, path), CONTRACT)], "r1")
    assert spark.read.parquet(lake.path("silver", "t")).count() == 1
    assert read_records(spark, lake.path("metrics")).count() == 1


def test_stored_queries(spark):
    out = run_stored_queries(CONTRACT, spark.createDataFrame([("1", "a"), ("2", "a")], "id string, nome string"))
    assert [(r["nome"], r["n"]) for r in out["por nome"].collect()] == [("a", 2)]


def test_document_load(spark):
    assert document_load(spark.createDataFrame([("1", "a")], "id string, nome string")).count() == 2


def test_stream_equals_batch(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    texts = {"a.csv": "id,nome\n1,Ana\n2,Bia\n", "b.csv": "id,nome\n1,Ana\n1,Bia\n3,\n", "c.csv": "id,nome\nx,Ana\n"}
    lake, batch_lake = Lake(str(tmp_path / "lake")), Lake(str(tmp_path / "batch"))
    for name, text in texts.items():
        (landing / name).write_text(text)
        stream = landing_stream(spark, str(landing), ["id", "nome"], max_files=1)
        ingest(stream, CONTRACT, lake, str(tmp_path / "cp"), timestamp="2024-01-01T00:00:00").awaitTermination()
        run_scenario(spark, batch_lake, [Load("tb_t", lambda s, p=str(landing / name): read_table(s, p), CONTRACT)], name,
                     timestamp="2024-01-01T00:00:00")
    drop = ("run_id", "timestamp", "profiling_ms")
    streamed = sorted(str(r) for r in read_records(spark, lake.path("metrics")).drop(*drop).collect())
    batched = sorted(str(r) for r in read_records(spark, batch_lake.path("metrics")).drop(*drop).collect())
    assert streamed == batched and len(streamed) == 3
    assert spark.read.parquet(lake.path("silver", "tb_t")).count() == 5
    assert spark.read.parquet(lake.path("quarantine", "tb_t")).count() == 1
    # Nothing new has landed: the stream starts and ends without another batch.
    ingest(landing_stream(spark, str(landing), ["id", "nome"]), CONTRACT, lake, str(tmp_path / "cp")).awaitTermination()
    assert read_records(spark, lake.path("metrics")).count() == 3


def test_stream_of_breaking_files(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text("id\n1\n")
    lake = Lake(str(tmp_path / "lake"))
    ingest(landing_stream(spark, str(landing), ["id"]), CONTRACT, lake, str(tmp_path / "cp")).awaitTermination()
    r = read_records(spark, lake.path("metrics")).first()
    assert (r["validation_status"], r["evolution_type"], r["quality_score"]) == ("DLQ", "BREAKING", 20.0)
    assert spark.read.parquet(lake.path("quarantine", "tb_t")).filter(F.col("_status") == "DLQ").count() == 1


def test_formats_and_scenarios_of_a_run_keep_apart(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    good = csv(tmp_path, "good.csv", "id,nome\n1,Ana\n2,Bia\n")
    bad = csv(tmp_path, "bad.csv", "id,nome\nx,Ana\n")
    load = lambda p, f: Load("t", lambda s: read_table(s, p, "csv"), Contract.of({**RAW, "table": "t"}), f)
    run_matrix(spark, lake, {"one": [load(good, "csv"), load(bad, "json")], "two": [load(good, "csv")]}, "r1")
    run_matrix(spark, lake, {"one": [load(good, "csv")]}, "r10")
    records = consolidated(spark, lake, "r1")
    assert {(r["run_id"], r["scenario"], r["format"], r["validation_status"]) for r in records.collect()} == {
        ("r1", "one", "csv", "PASS"), ("r1", "one", "json", "DLQ"), ("r1", "two", "csv", "PASS")}
    # The json load is mended and run again: quarantine lets go of it.
    run_matrix(spark, lake, {"one": [load(good, "json")]}, "r1")
    assert consolidated(spark, lake, "r1").filter("validation_status = 'DLQ'").count() == 0
    assert spark.read.parquet(lake.path("quarantine", "t", "r1", "one", "json")).count() == 0
    with pytest.raises(ValueError):
        run_matrix(spark, lake, {"one": [load(good, "csv"), load(good, "csv")]}, "r2")
