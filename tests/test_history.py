import random

import pytest
from pyspark.sql import Window as W, functions as F

from lakewarden.operators.history import (
    dashboard_totals, documentation_status, export_fields, latest, problem_lines, problems, run_totals, score_evolution,
    score_trend, select_records, union_records, worst_exit_codes, EXPORT_FIELDS,
)
from lakewarden.operators.ordered import previous_row
from lakewarden.operators.score import quality_score_sql, run_records
from lakewarden.sources.records import RECORD_DDL, export_records, read_record_documents, read_records, write_records, write_report


def record(run, ts, table="tb", scenario="baseline", status="PASS", score=90.0, slm="SKIPPED", issues=(), warnings=(), evolution=None):
    return (run, ts, table, scenario, "csv", status, evolution, 10, 10, 0, {}, 1.5, 2.0, slm, 0.0, score, list(issues), list(warnings))


@pytest.fixture(scope="module")
def history(spark):
    return spark.createDataFrame([
        record("r1", "2024-01-01T00:00:00", score=80.0),
        record("r2", "2024-01-31T00:00:00", score=80.9, slm="SUCCESS"),
        record("r3", "2024-02-01T00:00:00", score=95.0, status="WARNING", warnings=["x DRAFT y", "dups"]),
        record("r1", "2024-01-01T00:00:00", table="tc", score=20.0, status="DLQ", issues=["gone"], evolution="BREAKING", slm="ERROR"),
        record("r2", "2024-01-02T00:00:00", table="tc", score=10.0, status="DLQ", issues=["gone"]),
        record("r2", "2024-01-02T00:00:00", table="td", score=50.0, status="ODD", warnings=["only DRAFT"]),
    ], RECORD_DDL)


# (status, mean null pct, rows, dups, evolution) -> score; published values of one run.
@pytest.mark.parametrize("status,nulls,rows,dups,evolution,want", [
    ("PASS", 2.29, 500, 0, None, 97.7), ("WARNING", 0.81, 2030, 30, None, 69.4),
    ("WARNING", 8.3, 500, 0, "NON_BREAKING", 66.7), ("DLQ", None, 500, 0, "BREAKING", 20.0),
    ("DLQ", None, 0, 0, None, 30.0), ("PASS", 50.0, 10, 9, None, 50.0), ("PASS", 0.0, 5, 0, None, 100.0),
])
def test_quality_score(spark, status, nulls, rows, dups, evolution, want):
    df = spark.createDataFrame([(status, nulls, rows, dups, evolution)], "s string, n double, r bigint, d bigint, e string")
    assert df.selectExpr(f"{quality_score_sql('s', 'n', 'r', 'd', 'e')} as q").first()["q"] == want


def test_run_records_join_profile_and_documentation(spark):
    results = spark.sql("""select 'tb' as `table`, 'baseline' as scenario, 'PASS' as status, cast(null as string) as evolution_type,
        array('') as issues, array('') as warnings, 10L as rows_total, 10L as rows_valid, map('a', 1D) as null_violations, 0L as duplicate_count""")
    profiled = spark.createDataFrame([("tb", "baseline", 10.0), ("tb", "baseline", 0.01)], "`table` string, scenario string, null_pct double")
    documented = spark.createDataFrame([("tb", "baseline", "SUCCESS", 12.0)], "`table` string, scenario string, slm_status string, slm_inference_ms double")
    r = run_records("r", "t", results, profiled, documented).first()
    assert (r["avg_null_pct"], r["quality_score"], r["slm_status"], r["slm_inference_ms"]) == (5.01, 95.0, "SUCCESS", 12.0)
    r = run_records("r", "t", results, profiled.filter("false")).first()
    assert (r["avg_null_pct"], r["quality_score"], r["slm_status"]) == (0.0, 70.0, "SKIPPED")


def test_trend(history):
    got = {r["table"]: (r["last_score"], r["trend"]) for r in score_trend(history).collect()}
    assert got == {"tb": (95.0, "(+)"), "tc": (10.0, "(-)"), "td": (50.0, "")}


def test_evolution_crosses_months(history):
    got = [(r["run_id"], r["previous_score"], r["trend"]) for r in score_evolution(history).filter("`table` = 'tb'").orderBy("timestamp").collect()]
    assert got == [("r1", None, ""), ("r2", 80.0, "(=)"), ("r3", 80.9, "(+)")]


def test_totals(history):
    t = {r["run_id"]: r for r in run_totals(history).collect()}
    assert (t["r2"]["tables"], t["r2"]["dlq"], t["r2"]["documented"], t["r2"]["mean_score"]) == (3, 1, 1, 47.0)
    d = dashboard_totals(history).first()
    assert (d["runs"], d["records"], d["mean_score"]) == (3, 6, 56.0)
    assert dashboard_totals(history.filter("false")).first()["mean_score"] == 0.0
    assert {r["run_id"]: r["exit_code"] for r in worst_exit_codes(history).collect()} == {"r1": 2, "r2": 2, "r3": 1}


def test_problems(history):
    assert problems(history).count() == 4
    lines = {(r["table"], r["severity"], r["message"]) for r in problem_lines(history).collect()}
    assert lines == {("tb", "WARN", "dups"), ("tc", "ERR", "gone"), ("td", None, None)}


def test_latest_and_filters(history):
    assert {(r["table"], r["run_id"]) for r in latest(history).collect()} == {("tb", "r3"), ("tc", "r2"), ("td", "r2")}
    assert select_records(history, "tb", "baseline").count() == 3
    assert select_records(history, "tb", last_only=True).first()["run_id"] == "r3"
    d = documentation_status(history).first()
    assert (d["documented"], d["skipped"], d["failed"]) == (0, 3, 0)
    assert union_records(history, history).count() == 12


def test_store_load_export(spark, history, tmp_path):
    base = str(tmp_path / "metrics")
    for run in ("r1", "r2", "r3"):
        write_records(history.filter(F.col("run_id") == run), base)
    write_records(history.filter("run_id = 'r1'"), base)  # again: replaced, not doubled
    back = read_records(spark, base)
    assert sorted(map(str, back.collect())) == sorted(map(str, history.select(*back.columns).collect()))
    export_records(back, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).columns == EXPORT_FIELDS
    assert export_fields(history).columns == EXPORT_FIELDS
    write_report(history, str(tmp_path / "report"))
    text = "\n".join(r["value"] for r in spark.read.text(str(tmp_path / "report")).collect())
    assert " DLQ: score " in text and "r2: mean score 47.0/100, tables 3, DLQ 1" in text


def test_record_documents_skip_summaries_and_broken_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"run_id": "r1", "timestamp": "2024-02-01", "table": "t"}')
    (tmp_path / "b.json").write_text('[{"run_id": "r2", "timestamp": "2024-01-01"}, {"run_id": "r3", "timestamp": "2024-03-01"}]')
    (tmp_path / "run_summary.json").write_text('[{"run_id": "zz", "timestamp": "2024-01-01"}]')
    (tmp_path / "c.json").write_text('{"run_id": ')
    assert [r["run_id"] for r in read_record_documents(spark, str(tmp_path)).collect()] == ["r2", "r1", "r3"]


@pytest.mark.parametrize("chunk", [None, "floor(o / 5)", "0"])
def test_previous_row_equals_plain_lag(spark, chunk):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.6 else rng.choice(["a", None]), o, rng.choice([None, 1.0, 2.0])) for o in range(400)]
    df = spark.createDataFrame(rows, "g string, o int, v double").repartition(7)
    got = {(r["g"], r["o"]): r["p"] for r in previous_row(df, ["g"], ["o"], {"p": "v"}, chunk).collect()}
    want, last = {}, {}
    for g, o, v in rows:
        want[g, o] = last.get(g)
        last[g] = v
    assert got == want


def test_previous_row_needs_no_reused_exchange(spark):
    """Both halves of the lookup cut alike even where nothing is shared between them."""
    df = spark.range(0, 200_000, 1, 8).selectExpr("if(id % 3 = 0, 'hot', cast(id % 5 as string)) as g", "cast(hash(id) % 5000 as string) as o", "id as k")
    before = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = previous_row(df, ["g"], ["o", "k"], {"p": "k"})
        plain = df.withColumn("p", F.lag("k").over(W.partitionBy("g").orderBy("o", "k")))
        assert got.count() == 200_000 and got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)
