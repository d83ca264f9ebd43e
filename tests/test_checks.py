import pytest
from pyspark.sql import functions as F

from lakewarden.contracts import Contract
from lakewarden.operators.checks import (
    drop_duplicates, duplicate_counts, null_violations, rejected, schema_diff, validate, validate_with_facts,
)
from lakewarden.operators.profile import column_facts

RAW = {
    "table": "customer", "description": "buyers", "owner": "sales desk", "version": "1.0.0",
    "tolerance": {"max_null_pct": 20, "allow_duplicates": False},
    "schema": [{"name": "c_custkey", "type": "string", "nullable": False, "primary_key": True},
               {"name": "c_name", "type": "string", "nullable": False},
               {"name": "c_acctbal", "type": "float", "nullable": True}],
}
CONTRACT = Contract.of(RAW)
DDL = "c_custkey string, c_name string, c_acctbal string"


def both(df, contract=CONTRACT):
    """The result of the two-pass check, after making sure the profile-based one agrees."""
    row = validate(df, contract).first()
    assert validate_with_facts(df, column_facts(df), contract).first() == row
    return row


def test_pass_with_draft_warning(spark):
    r = both(spark.createDataFrame([("17", "Customer#17", "501.2"), ("23", "Customer#23", "-8.75")], DDL))
    assert (r["status"], r["rows_total"], r["rows_valid"], r["duplicate_count"], r["evolution_type"]) == ("PASS", 2, 2, 0, None)
    assert len([w for w in r["warnings"] if "DRAFT" in w]) == 1


def test_validated_contract_has_no_draft_warning(spark):
    c = Contract.of({**RAW, "manifest_status": "VALIDATED"})
    assert both(spark.createDataFrame([("17", "Customer#17", None)], DDL), c)["warnings"] == []


def test_duplicates(spark):
    r = both(spark.createDataFrame([("17", "Customer#17", "1"), ("17", "Customer#17", "1"), ("23", "B", "2")], DDL))
    assert (r["status"], r["duplicate_count"], r["rows_valid"]) == ("WARNING", 1, 2)
    assert any("1 duplicate rows (33.3%)" in w for w in r["warnings"])


def test_allowed_duplicates_are_still_counted(spark):
    c = Contract.of({**RAW, "tolerance": {"allow_duplicates": True}})
    r = both(spark.createDataFrame([("17", "Customer#17", "1")] * 3, DDL), c)
    assert (r["status"], r["duplicate_count"], r["rows_valid"]) == ("PASS", 2, 1)


def test_null_keys_are_equal(spark):
    r = both(spark.createDataFrame([(None, "a", "1"), (None, "b", "1"), (None, "c", "2")], DDL))
    assert r["duplicate_count"] == 2 and r["null_violations"] == {"c_custkey": 100.0}


def test_null_in_required(spark):
    r = both(spark.createDataFrame([("17", "Customer#17", "1"), ("23", "B", None), (None, "C", "3")], DDL))
    assert r["status"] == "WARNING" and r["null_violations"] == {"c_custkey": 33.33}


def test_null_tolerance_option(spark):
    df = spark.createDataFrame([("17", None, "1")] + [(f"B{i}", "x", "1") for i in range(9)], DDL)
    assert validate(df, CONTRACT).first()["status"] == "WARNING"
    assert validate(df, CONTRACT, enforce_null_tolerance=True).first()["status"] == "PASS"


def test_extra_column_is_non_breaking(spark):
    r = both(spark.createDataFrame([("17", "Customer#17", "1", "x")], DDL + ", c_phone string"))
    assert (r["status"], r["evolution_type"]) == ("WARNING", "NON_BREAKING")
    assert any("c_phone" in w for w in r["warnings"])


def test_missing_optional_is_silent(spark):
    r = both(spark.createDataFrame([("17", "Customer#17")], "c_custkey string, c_name string"))
    assert (r["status"], r["evolution_type"]) == ("PASS", None)


@pytest.mark.parametrize("columns", [["c_custkey", "c_acctbal"], ["c_name", "c_acctbal"]])
def test_missing_required_or_key_is_breaking(spark, columns):
    df = spark.createDataFrame([("17", "Customer#17", "1")] * 4, DDL).select(*columns)
    r = both(df)
    assert (r["status"], r["evolution_type"], r["rows_total"], r["rows_valid"], r["duplicate_count"]) == ("DLQ", "BREAKING", 4, 0, 0)
    assert len(r["issues"]) == 1


def test_nullable_key_missing_is_breaking(spark):
    c = Contract.of({**RAW, "schema": [{"name": "id", "type": "string", "primary_key": True}, {"name": "nome", "type": "string"}]})
    r = both(spark.createDataFrame([("x",)], "nome string"), c)
    assert r["status"] == "DLQ" and "Primary key" in r["issues"][0]


def _typed(t):
    return Contract.of({**RAW, "schema": [{"name": "id", "type": t, "nullable": False, "primary_key": True}]})


@pytest.mark.parametrize("declared,value,ok", [
    ("integer", " 12 ", True), ("integer", "1.0", False), ("integer", "no-12", False), ("float", "1e5", True),
    ("float", "inf", True), ("float", "1d", False), ("boolean", "Não", True), ("boolean", "talvez", False),
    ("date", "whatever", True), ("string", "x", True),
])
def test_key_coercion(spark, declared, value, ok):
    r = both(spark.createDataFrame([(value,)], "id string"), _typed(declared))
    assert (r["status"] == "PASS") == ok
    assert (r["evolution_type"] == "BREAKING") == (not ok)


def test_bad_key_beyond_a_sample_is_found(spark):
    df = spark.range(0, 5000).selectExpr("if(id = 4999, 'x', cast(id as string)) as id")
    assert both(df, _typed("integer"))["status"] == "DLQ"


def test_composite_key(spark):
    c = Contract.of({**RAW, "schema": [{"name": n, "type": "string", "primary_key": True} for n in ("a", "b")]})
    df = spark.createDataFrame([("1", "2"), ("1", None), ("1", None), ("12", ""), ("1", "2")], "a string, b string")
    assert both(df, c)["duplicate_count"] == 2


def test_empty_load(spark):
    r = both(spark.createDataFrame([], DDL))
    assert (r["status"], r["rows_total"], r["rows_valid"], r["duplicate_count"]) == ("PASS", 0, 0, 0)


def test_no_key(spark):
    c = Contract.of({**RAW, "schema": [{"name": "a", "type": "string"}]})
    assert both(spark.createDataFrame([("1",), ("1",)], "a string"), c)["duplicate_count"] == 0


def test_odd_column_names(spark):
    c = Contract.of({**RAW, "schema": [{"name": "a b'c", "type": "integer", "nullable": False, "primary_key": True}]})
    df = spark.createDataFrame([("1",), (None,)], "v string").toDF("a b'c")
    assert both(df, c)["null_violations"] == {"a b'c": 50.0}


def test_rejected(spark):
    r = rejected(spark, "customer", "Invalid contract: it's bad").first()
    assert (r["status"], r["rows_total"], r["issues"]) == ("DLQ", 0, ["Invalid contract: it's bad"])


def test_schema_diff(spark):
    declared = spark.createDataFrame([("a", False, False), ("b", True, True), ("c", True, False), ("d", False, False)],
                                     "name string, nullable boolean, primary_key boolean")
    seen = spark.createDataFrame([("a",), ("a",), ("x",)], "name string")
    got = {r["name"]: r["state"] for r in schema_diff(declared, seen).collect()}
    assert got == {"a": "present", "b": "missing_key", "c": "missing_optional", "d": "missing_required", "x": "extra"}


def test_duplicate_counts_with_hot_key(spark):
    df = spark.range(0, 30000, 1, 8).selectExpr("if(id % 3 = 0, -1, id) as k")
    r = duplicate_counts(df, ["k"]).first()
    assert (r["rows_total"], r["duplicate_count"]) == (30000, 9999)


def test_drop_duplicates_keeps_the_first(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 5), (None, 4), ("b", 9)], "k string, n int")
    kept = drop_duplicates(df, ["k"], ["n"])
    assert {(r["k"], r["n"]) for r in kept.collect()} == {("a", 1), (None, 4), ("b", 9)}
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_null_violations(spark):
    df = spark.createDataFrame([("1", None, None), ("2", "x", None)], DDL)
    assert [(r["column_name"], r["null_pct"], r["null_count"]) for r in null_violations(df, CONTRACT).collect()] == [("c_name", 50.0, 1)]


def test_null_counts_need_no_data_shuffle(spark):
    df = spark.range(0, 100, 1, 4).select(F.col("id").cast("string").alias("c_custkey"), F.lit("n").alias("c_name"))
    plan = null_violations(df, CONTRACT)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
