import pytest

from lakewarden.operators.profile import (
    column_facts, documentation_summary, profile, profile_with_top, sketch_facts, sketch_top_values, top_values,
)
from lakewarden.operators import values


def facts(df, **kw):
    return {r["column_name"]: r for r in profile(df, **kw).collect()}


@pytest.fixture(scope="module")
def dirty(spark):
    return spark.createDataFrame(
        [("a", "1", None), ("a", " 2.5 ", None), ("b", "x", None), ("  ", "1e3", None), (None, "", None), ("b", "1d", None)],
        "s string, n string, empty string")


def test_nulls_distinct_and_numbers(dirty):
    f = facts(dirty)
    assert (f["s"]["rows"], f["s"]["null_count"], f["s"]["null_pct"], f["s"]["unique_count"]) == (6, 2, 33.33, 3)
    assert (f["n"]["null_count"], f["n"]["min_value"], f["n"]["max_value"]) == (1, 1.0, 1000.0)
    assert f["n"]["mean_value"] == pytest.approx(334.5)
    assert f["s"]["min_value"] is None and f["s"]["dtype"] == "VARCHAR"


def test_all_null_column(dirty):
    f = facts(dirty)["empty"]
    assert (f["null_count"], f["null_pct"], f["unique_count"], f["mean_value"]) == (6, 100.0, 0, None)


def test_empty_table_reports_its_columns(dirty):
    f = facts(dirty.filter("false"))
    assert set(f) == {"s", "n", "empty"}
    assert all((r["rows"], r["null_pct"], r["unique_count"]) == (0, 0.0, 0) for r in f.values())


def test_typed_columns(spark):
    df = spark.sql("""select * from values
        (1L, 2.5D, timestamp'2024-01-01 00:00:00', true, date'2024-01-01', 1.5BD, array(1)),
        (1L, double('nan'), null, false, null, 2.5BD, array(1)), (null, 1e7D, null, true, null, null, null)
        t(l, d, ts, b, dt, dc, arr)""")
    f = facts(df)
    assert (f["l"]["unique_count"], f["l"]["null_count"], f["l"]["mean_value"]) == (1, 1, 1.0)
    assert (f["d"]["min_value"], f["d"]["max_value"], f["d"]["unique_count"]) == (2.5, 10000000.0, 3)
    assert f["ts"]["unique_count"] == 1 and f["b"]["unique_count"] == 2 and f["dt"]["null_count"] == 2
    assert f["dc"]["mean_value"] == 2.0 and f["arr"]["unique_count"] == 1
    tops = {(r["column_name"], r["value_rank"]): r["value"] for r in top_values(df).collect()}
    assert tops["ts", 1] == "2024-01-01 00:00:00" and "10000000.0" in {tops["d", i] for i in (1, 2, 3)}


def test_top_values_ties_and_limit(spark):
    df = spark.createDataFrame([(v,) for v in "bbaaccdefg"] + [(None,)] * 9, "v string")
    got = [(r["value"], r["cnt"]) for r in sorted(top_values(df).collect(), key=lambda r: r["value_rank"])]
    assert got == [("a", 2), ("b", 2), ("c", 2), ("d", 1), ("e", 1)]


def test_fewer_values_than_k_with_nulls(spark):
    df = spark.createDataFrame([("x",), (None,), (None,)], "v string")
    assert [(r["value"], r["value_rank"]) for r in top_values(df).collect()] == [("x", 1)]


def test_skewed_column_is_exact(spark):
    df = spark.range(0, 30000, 1, 8).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as v")
    f = facts(df)["v"]
    assert f["rows"] == 30000 and f["unique_count"] == 20001
    top = sorted(top_values(df).collect(), key=lambda r: r["value_rank"])[0]
    assert (top["value"], top["cnt"]) == ("hot", 10000)


def test_long_texts_are_counted_by_digest(spark):
    long = "x" * 200
    rows = [(long + "a",), (long + "a",), (long + "b",), ("7" * 200,), (" " * 300,), (None,), ("  5" + " " * 200,)]
    df = spark.createDataFrame(rows, "t string")
    digest = df.filter("t like '%a'").selectExpr("concat('#', sha2(t, 512)) as t").limit(1)
    df = df.unionByName(digest)
    got = column_facts(df).first()
    assert got == column_facts(df, digest=False).first()
    assert (got["rows"], got["unique_count"], got["null_count"], got["min_value"]) == (8, 6, 2, 5.0)


def test_wide_table_is_split_into_branches(spark, monkeypatch):
    monkeypatch.setattr(values, "COLUMNS_PER_BRANCH", 3)
    df = spark.range(10).selectExpr(*[f"cast(id % {i + 1} as string) as c{i}" for i in range(10)])
    f = facts(df)
    assert [f[f"c{i}"]["unique_count"] for i in range(10)] == list(range(1, 11))


def test_sketch_is_close(spark):
    df = spark.range(0, 50000).selectExpr("cast(id as string) as k", "cast(id % 7 as string) as g", "id")
    exact = {r["column_name"]: r for r in column_facts(df).collect()}
    for r in sketch_facts(df).collect():
        e = exact[r["column_name"]]
        assert (r["rows"], r["null_count"], r["min_value"], r["max_value"]) == (e["rows"], e["null_count"], e["min_value"], e["max_value"])
        assert r["unique_count"] == pytest.approx(e["unique_count"], rel=0.1)
    tops = [r for r in sketch_top_values(df, ["g"]).collect()]
    assert len(tops) == 5 and all(r["cnt"] == pytest.approx(7143, rel=0.05) for r in tops)


def test_value_counts_shuffle_is_shared(spark):
    df = spark.range(0, 1000, 1, 4).selectExpr("cast(id % 10 as string) as a", "id as b")
    out = profile_with_top(df)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan and "WindowGroupLimit" in plan


def test_documentation_summary(spark):
    df = spark.createDataFrame([("a",), (None,), (None,), ("b",), ("c",), ("d",)], "v string")
    row = documentation_summary(profile_with_top(df)).first()
    assert len(row["top_values"]) == 3 and "33.33" in row["anomaly"]


def test_wide_numbers_and_nan(spark):
    rows = [(4539578763621486, float("nan"), "1e17"), (4539578763621488, 1.0, "-1e17"), (None, float("inf"), "x")]
    df = spark.createDataFrame(rows, "card long, odd double, text string")
    for facts in (column_facts(df), sketch_facts(df)):
        got = {r["column_name"]: (r["min_value"], r["max_value"]) for r in facts.collect()}
        assert got == {"card": (4539578763621486.0, 4539578763621488.0), "odd": (1.0, 1.0), "text": (-1e17, 1e17)}
