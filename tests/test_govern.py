import pytest
from pyspark.sql import functions as F

from lakewarden.contracts import Contract
from lakewarden.operators.govern import (
    draft_notice, invalid_contracts, pending_items, promote, readiness, review_warnings, upsert, upsert_actions,
)
from lakewarden.sources.reader import read_load
from lakewarden.sources.registry import contract_columns, read_registry, registry_frame, row_contract, write_registry

COMPLETE = {
    "table": "supplier", "description": "who delivers", "owner": "purchasing", "version": "1.0.0", "manifest_status": "DRAFT",
    "source": {"system": "purchase ledger", "format": "json", "encoding": "latin-1", "os": "mainframe", "update_frequency": "monthly", "contact": "buy@example.org"},
    "regulatory": {"tags": ["SCR"]}, "steward": {"name": "Lou", "email": "lou@example.org"}, "business_context": "delivery terms",
    "sample_queries": [{"description": "count", "sql": "select count(*) from supplier"}],
    "schema": [{"name": "s_suppkey", "type": "string", "description": "number of the supplier", "business_rules": ["never reused"]}],
}
INCOMPLETE = {
    **COMPLETE, "table": "nation", "description": "# TODO: say what it holds", "owner": "", "business_context": None,
    "source": {**COMPLETE["source"], "system": "# TODO: which system"}, "steward": {"name": "# TODO: who"},
    "regulatory": {"tags": ["# TODO: check these"]}, "sample_queries": [],
    "schema": [{"name": "n_nationkey", "type": "string", "description": "# TODO: key of what"}, {"name": "n_weight", "type": "float", "description": "share of trade"}],
}
BARE = {"table": "region", "version": "1.0.0", "schema": [{"name": "r_regionkey", "type": "string"}]}


@pytest.fixture(scope="module")
def registry(spark):
    return registry_frame(spark, [Contract.of(c) for c in (COMPLETE, INCOMPLETE, BARE)])


def test_pending(registry):
    found = {}
    for r in pending_items(registry, contract_columns(registry)).collect():
        found.setdefault(r["table"], set()).add(r["field"])
    assert "supplier" not in found
    assert found["nation"] == {"description", "owner", "business_context", "source.system", "steward.name", "steward.email",
                              "regulatory.tags", "schema[n_nationkey].description"}
    # Missing source fields are not pending; everything else that is missing is.
    assert found["region"] == {"description", "owner", "business_context", "steward.name", "steward.email",
                                "regulatory.tags", "schema[r_regionkey].description"}


def test_warnings_do_not_block(registry):
    got = {(r["table"], r["warning"]) for r in review_warnings(registry, contract_columns(registry)).collect()}
    assert ("nation", "sample_queries is empty") in got and ("nation", "schema[n_weight].business_rules is empty") in got
    assert not any(t == "supplier" for t, _ in got)


def test_readiness_and_promotion(registry):
    columns = contract_columns(registry)
    ready = {r["table"]: r["ready"] for r in readiness(registry, columns).collect()}
    assert ready == {"supplier": True, "nation": False, "region": False}
    done = {r["table"]: r for r in promote(registry, columns, "Lou", "2024-01-01T00:00:00").collect()}
    assert (done["supplier"]["manifest_status"], done["supplier"]["validated_by"], done["supplier"]["validated_at"]) == ("VALIDATED", "Lou", "2024-01-01T00:00:00")
    assert (done["nation"]["manifest_status"], done["nation"]["validated_by"]) == ("DRAFT", None)
    assert promote(registry, columns, "a", "b").columns == registry.columns
    assert {r["table"] for r in draft_notice(promote(registry, columns, "a", "b")).collect()} == {"nation", "region"}


def test_invalid(spark):
    df = spark.createDataFrame([("a", "1.0.0"), ("b", "1.0"), ("", "1.0.0"), ("c", None)], "`table` string, version string")
    assert {r["table"] for r in invalid_contracts(df).collect()} == {"b", "", "c"}


@pytest.fixture(scope="module")
def old_new(spark):
    old = spark.createDataFrame([("v", "1.0.0", "VALIDATED"), ("v_draft", "1.1.0", "DRAFT"), ("d", "1.0.0", "DRAFT"), ("n", "1.0.0", None), ("z", "1.0.0", "DRAFT")],
                                "`table` string, version string, manifest_status string")
    new = spark.createDataFrame([("v", "2.0.0", "DRAFT", 3), ("d", "2.0.0", "DRAFT", 3), ("n", "2.0.0", "DRAFT", 1), ("x", "2.0.0", "DRAFT", 3), ("y", "2.0.0", "DRAFT", 0), ("w", None, "DRAFT", 3)],
                                "`table` string, version string, manifest_status string, column_count bigint")
    return old, new


@pytest.mark.parametrize("overwrite,expected", [
    (False, {"v": "drafted", "d": "kept", "n": "kept", "x": "created", "y": "rejected", "w": "rejected"}),
    (True, {"v": "drafted", "d": "replaced", "n": "replaced", "x": "created", "y": "rejected", "w": "rejected"}),
])
def test_upsert_actions(old_new, overwrite, expected):
    assert {r["table"]: r["action"] for r in upsert_actions(*old_new, overwrite).collect()} == expected


def test_upsert(old_new):
    got = {r["table"]: (r["version"], r["manifest_status"]) for r in upsert(*old_new, overwrite=True).collect()}
    assert got == {"v": ("1.0.0", "VALIDATED"), "v_draft": ("2.0.0", "DRAFT"), "d": ("2.0.0", "DRAFT"), "n": ("2.0.0", "DRAFT"),
                   "x": ("2.0.0", "DRAFT"), "z": ("1.0.0", "DRAFT")}
    got = {r["table"]: r["version"] for r in upsert(*old_new).collect()}
    assert (got["d"], got["v_draft"], got["x"]) == ("1.0.0", "2.0.0", "2.0.0")


def test_repeated_incoming_and_a_validated_draft(spark):
    old = spark.createDataFrame([("v", "1.0.0", "VALIDATED"), ("v_draft", "1.1.0", "VALIDATED")], "`table` string, version string, manifest_status string")
    new = spark.createDataFrame([("v", "2.0.0", "DRAFT", 3), ("n", "1.9.0", "DRAFT", 3), ("n", "1.10.0", "DRAFT", 3), ("n", "9.0.0", "DRAFT", 0)],
                                "`table` string, version string, manifest_status string, column_count bigint")
    got = sorted((r["table"], r["version"]) for r in upsert(old, new, overwrite=True).collect())
    assert got == [("n", "1.10.0"), ("v", "1.0.0"), ("v_draft", "1.1.0")]


def test_stored_registry_after_two_rounds(spark, tmp_path):
    path = str(tmp_path / "registry")
    for contract in (COMPLETE, {**INCOMPLETE, "layout": [{"field": "n_nationkey", "start": 1, "end": 4}]}):
        now = read_registry(spark, path)
        write_registry(upsert(now, registry_frame(spark, [Contract.of(contract)]).withColumn("column_count", F.size("schema")), width="column_count"), path)
    stored = read_registry(spark, path)
    done = promote(stored, contract_columns(stored), "Lou", "2024-01-01")
    assert {(r["table"], r["manifest_status"]) for r in done.collect()} == {("supplier", "VALIDATED"), ("nation", "DRAFT")}
    contract = next(row_contract(r) for r in stored.collect() if r["table"] == "nation")
    assert contract.layout == ({"field": "n_nationkey", "start": 1, "end": 4, "dtype": "string"},)
    (tmp_path / "n.txt").write_text("  17rest\n")
    fixed = Contract.of({**INCOMPLETE, "source": {"format": "fixed_width"}, "layout": [{"field": "k", "start": 1, "end": 4}, {"field": "r", "start": 5, "end": 8}]})
    assert [tuple(r) for r in read_load(spark, str(tmp_path / "n.txt"), fixed).collect()] == [("17", "rest")]
