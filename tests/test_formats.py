import json

import pytest
from pyspark.sql import DataFrameReader, functions as F

from lakewarden.operators.infer import draft_contract
from lakewarden.functions.naming import json_path_tidy
from lakewarden.sources.fixed import (
    check_layout, contract_from_layout, fields_of, format_fixed, infer_layout, layout_findings, layout_of, parse_fixed, read_layout,
)
from lakewarden.contracts import Contract
from lakewarden.sources.nested import (
    flatten, json_documents, nest, observed_keys, observed_schema, observed_types, read_json_document, read_json_lines, write_documents,
)
from lakewarden.sources.reader import format_of, read_load, read_table, write_table
from lakewarden.sources.tabular import (
    detect_delimiter, detect_header, estimated_rows, read_csv, read_lines, read_split_lines, sniff_csv, write_csv,
)


@pytest.fixture(scope="module")
def trips(spark):
    return spark.createDataFrame(
        [("N4", 12.5, "harbour; nights only", None), ("S11", None, "", "late"), ("ring", 23456789.25, None, "ok"), ("x", -0.5, '"loop"', "ok")],
        "line string, km double, remark string, state string")


TRIP_LAYOUT = layout_of([("state", 6, "string"), ("km", 12, "float"), ("line", 5, "string"), ("remark", 22, "string")])


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def put(tmp_path, name, content):
    (tmp_path / name).write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(tmp_path / name)


# ---- delimited

def test_csv_round_trip(spark, trips, tmp_path):
    path = str(tmp_path / "trips.csv")
    write_table(trips, path, "csv", sep=";")
    back = read_csv(spark, path, sep=";")
    assert back.dtypes == [(c, "string") for c in trips.columns]
    assert rows(back) == [("N4", "12.5", "harbour; nights only", None), ("S11", None, "", "late"), ("ring", "23456789.25", None, "ok"), ("x", "-0.5", '"loop"', "ok")]


def test_csv_options(spark, tmp_path):
    path = put(tmp_path, "t.csv", "a,b\n1,NA\n2,\n")
    assert rows(read_csv(spark, path)) == [("1", "NA"), ("2", None)]
    assert rows(read_csv(spark, path, null_values="NA"))[0] == ("1", None)
    assert read_csv(spark, put(tmp_path, "n.csv", "N4,12.5\nring,3\n"), header=False).columns == ["col_001", "col_002"]
    assert read_csv(spark, put(tmp_path, "t.tsv", "a\tb\n1\t2\n")).columns == ["a", "b"]
    assert read_csv(spark, path, sample_rows=1).count() == 1


def test_latin1_csv(spark, tmp_path):
    path = put(tmp_path, "stops.csv", "stop,zone\nÅs,4\nVänö,7\n".encode("latin-1"))
    assert rows(read_csv(spark, path, encoding="ISO-8859-1")) == [("Vänö", "7"), ("Ås", "4")]
    assert read_lines(spark, path, "latin-1").collect()[2]["value"] == "Vänö,7"


@pytest.mark.parametrize("text,sep", [("a;b\n1;2\n", ";"), ("a,b\n1,2\n", ","), ("a|b\n1|2\n", "|"), ("a\tb\n1\t2\n", "\t"),
                                      ("x\ny\n", ","), ("a;b\n1,5;2\n3;4\n", ";")])
def test_delimiter(spark, tmp_path, text, sep):
    assert detect_delimiter(spark.read.text(put(tmp_path, "d.csv", text))).first()["delimiter"] == sep


@pytest.mark.parametrize("text,header", [("stop,zone\nOslo,4\nBergen,12\n", True), ("Oslo,4\nBergen,12\nMoss,7\n", False), ("code,x\nAB,y\nCD,zz\n", True)])
def test_header(spark, tmp_path, text, header):
    lines = spark.read.text(put(tmp_path, "h.csv", text))
    assert detect_header(lines, text.split("\n")[0], ",").first()["has_header"] == header


def test_sniffed_read(spark, tmp_path):
    df = sniff_csv(spark, put(tmp_path, "named.csv", "zone|stop\n4|Oslo\n12|Bergen\n4|Moss\n"))
    assert df.columns == ["zone", "stop"] and df.count() == 3
    bare = sniff_csv(spark, put(tmp_path, "bare.csv", "4;Oslo\n12;Bergen\n"))
    assert bare.columns == ["col_001", "col_002"] and bare.count() == 2


def test_estimated_rows(spark, tmp_path):
    assert estimated_rows(spark.read.text(put(tmp_path, "e.csv", "a\n1\n2\n"))).first()[0] == 2
    assert estimated_rows(spark.read.text(put(tmp_path, "e0.csv", ""))).first()[0] == 0


# ---- nested

def test_json_structures(spark, tmp_path):
    t = read_json_document(spark, put(tmp_path, "a.json", json.dumps([{"zone": 4, "stops": ["Oslo"]}, {"zone": 7}])))
    assert (t.structure, t.root_key, t.df.count()) == ("list", None, 2)
    t = read_json_document(spark, put(tmp_path, "b.json", json.dumps({"zeta": [{"id": 1}], "alfa": [2], "versao": "1"})))
    assert (t.structure, t.root_key, t.df.columns) == ("list", "zeta", ["id"])
    t = read_json_document(spark, put(tmp_path, "c.json", json.dumps({"x": [1], "data": [{"id": 1}]})), root_key="data")
    assert t.df.columns == ["id"]
    t = read_json_document(spark, put(tmp_path, "d.json", json.dumps({"id": 1, "config": "x"})))
    assert (t.structure, t.df.count()) == ("object", 1)
    t = read_json_lines(spark, put(tmp_path, "e.jsonl", '{"id":1}\nnot json\n{"id":2}\n'))
    assert t.structure == "jsonlines" and rows(t.df) == [(1,), (2,)]


def test_flatten_levels(spark, tmp_path):
    path = put(tmp_path, "n.jsonl", json.dumps({"id": 1, "l1": {"a": 1, "l2": {"b": 2, "l3": {"v": 42}}}, "tags": [1, 2]}))
    df = read_json_lines(spark, path).df
    flat, notes = flatten(df, 2)
    assert flat.columns == ["id", "l1__a", "l1__l2__b", "l1__l2__l3", "tags"]
    assert flat.first()["l1__l2__l3"] == '{"v":42}' and flat.first()["tags"] == "[1,2]" and set(notes) == {"l1__l2__l3", "tags"}
    assert flatten(df, 1)[0].columns == ["id", "l1__a", "l1__l2", "tags"]
    assert flatten(df, 5)[0].columns[3] == "l1__l2__l3__v"


def test_json_contract(spark, tmp_path):
    trips = [{"trip": 40 + k, "from": {"Stop Name": "Oslo", "zone": k % 2}, "via": [k], "nr_cpf": str(k)} for k in range(4)] + [{"trip": 50, "from": {}, "nr_cpf": "7"}]
    table = read_json_document(spark, put(tmp_path, "trips.json", json.dumps({"made": "now", "trips": trips})))
    flat, notes = flatten(table.df)
    drafted = draft_contract(flat, "trips", fmt="json", notes=notes, normalize=json_path_tidy)
    cols = {c.name: c for c in drafted.columns}
    assert set(cols) == {"trip", "from__stop_name", "from__zone", "via", "nr_cpf"} and drafted.manifest_status == "DRAFT"
    assert not cols["trip"].nullable and cols["from__zone"].nullable and cols["trip"].type == "integer"
    assert cols["via"].type == "string" and cols["via"].nullable and "collapsed" in cols["via"].business_rules[0]
    assert cols["nr_cpf"].regulatory_flags == ("LGPD_SENSITIVE",)


def test_nest(spark, trips, tmp_path):
    assert nest(trips, {"seen": ["state", "remark"], "way": ["km"]}).columns == ["line", "seen", "way"]
    with pytest.raises(ValueError):
        nest(trips, {"seen": ["nothing"]})
    path = str(tmp_path / "trips.jsonl")
    write_table(trips, path, "json", groups={"seen": ["state", "remark"]})
    texts = {t["line"]: t for t in (json.loads(r["value"]) for r in spark.read.text(path).collect())}
    assert texts["N4"] == {"line": "N4", "km": 12.5, "seen": {"state": None, "remark": "harbour; nights only"}}
    back = {r["line"]: r for r in read_table(spark, path).collect()}
    assert back["ring"].asDict() == {"line": "ring", "km": "23456789.25", "seen__state": "ok", "seen__remark": None}
    assert back["S11"]["km"] is None and back["x"]["km"] == "-0.5"


def test_observed_keys_and_schema(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": "t", "c": {"d": 1}}',)], "j string")
    assert {(r["name"], r["occurrences"]) for r in observed_keys(df, "j").collect()} == {("a", 2), ("b", 1), ("c", 1)}
    schema = observed_schema(df, "j").first()[0]
    assert "a: VARIANT" in schema and "c: OBJECT<d: BIGINT>" in schema


# ---- fixed width

def test_fixed_lines(trips):
    lines = [r["value"] for r in format_fixed(trips, TRIP_LAYOUT).collect()]
    assert {len(x) for x in lines} == {45}
    assert lines[0] == " " * 6 + "        12.5" + "N4   " + "harbour; nights only  "
    assert lines[1][6:18] == " " * 12 and lines[1][:6] == "late  " and lines[2][6:18] == " 23456789.25"


def test_fixed_truncates(spark):
    df = spark.createDataFrame([("LONG_VALUE", 123456789)], "a string, n bigint")
    assert format_fixed(df, layout_of([("a", 4, "string"), ("n", 5, "integer")])).first()[0] == "LONG12345"


def test_fixed_errors(trips):
    with pytest.raises(ValueError):
        layout_of([])
    with pytest.raises(ValueError):
        format_fixed(trips, [])
    with pytest.raises(ValueError):
        format_fixed(trips, layout_of([("nope", 3, "string")]))


def test_fixed_round_trip(spark, trips, tmp_path):
    path = str(tmp_path / "trips.txt")
    write_table(trips, path, "fixed_width", layout=TRIP_LAYOUT)
    back = {r["line"]: r for r in read_table(spark, path, layout=TRIP_LAYOUT).collect()}
    assert set(back) == {"N4", "S11", "ring", "x"} and back["S11"]["remark"] is None  # an empty text is blank, as NULL is
    assert back["ring"]["km"] == "23456789.25" and back["x"]["remark"] == '"loop"' and back["N4"]["state"] is None


def test_parse_only_needed_fields(spark, trips):
    lines = format_fixed(trips, TRIP_LAYOUT)
    plan = parse_fixed(lines, TRIP_LAYOUT).select("line")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("substring") == 1


def test_layout_text(spark, tmp_path):
    path = put(tmp_path, "trips.layout", "# bytes of a trip\n\n  LINE_NO 1 5 an\nKM_RUN 6 17 PACKED distance of a run\nVL_RENDA 18 30 num\nHALF 31\nODD 31 b\nFLAGS 31 32 Binary  raw bits\n")
    drafted, warnings = contract_from_layout(read_layout(spark, path), "trips")
    assert [(c.name, c.type) for c in drafted.columns] == [("line_no", "string"), ("km_run", "float"), ("vl_renda", "float"), ("flags", "string")]
    assert drafted.columns[1].description == "distance of a run" and drafted.columns[3].business_rules and not drafted.columns[0].business_rules
    assert "SCR_CANDIDATE" in drafted.columns[2].regulatory_flags and [f["end"] for f in drafted.layout] == [5, 17, 30, 32]
    assert sum(w.startswith("Line") for w in warnings) == 2 and drafted.source["format"] == "fixed_width"


def test_layout_csv(spark, tmp_path):
    path = put(tmp_path, "trips.csv", "End,Start,Field,Desc\n5,1,LINE_NO,line\n17,6,KM_RUN,\n,18,LOST,x\n")
    drafted, warnings = contract_from_layout(read_layout(spark, path), "trips")
    assert drafted.column_names() == ["line_no", "km_run"] and drafted.columns[0].description == "line" and len(warnings) == 1
    with pytest.raises(ValueError):
        read_layout(spark, put(tmp_path, "short.csv", "field,start\na,1\n"))


def test_layout_findings(spark):
    df = spark.createDataFrame([("x", "a", 1, 10), ("x", "b", 8, 20), ("y", "a", 3, 5), ("y", "b", 10, 20), ("y", "c", 21, 20)],
                               "layout string, name string, start int, end int")
    found = {(r["layout"], r["name"]): (r["reversed"], r["overlap"], r["gap"]) for r in check_layout(df, ["layout"]).collect()}
    assert found == {("x", "a"): (False, False, 0), ("x", "b"): (False, True, 0), ("y", "a"): (False, False, 0),
                     ("y", "b"): (False, False, 4), ("y", "c"): (True, False, 0)}
    found = {tuple(r) for r in layout_findings(check_layout(df, ["layout"])).collect()}
    assert found == {("backwards", "c", 21, 1), ("gap", "b", 10, 4), ("overlap", "b", 8, 3)}


def spans(spark, *lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return [(r["name"], r["start"], r["end"]) for r in infer_layout(df).orderBy("start").collect()]


def test_inferred_layout(spark):
    assert spans(spark, "AB  123  X", "CD  45   Y", "") == [("campo_001", 1, 2), ("campo_002", 5, 7)]
    assert spans(spark, "  AB CDE") == [("campo_002", 3, 4), ("campo_003", 6, 8)]
    assert spans(spark, "ABC   ", "ABCDEF") == [("campo_001", 1, 6)]
    assert spans(spark, "") == []


def test_inferred_contract_is_experimental(spark, tmp_path):
    lines = spark.read.text(put(tmp_path, "data.txt", "N4    12.5  ok\nring 23456  ok\n"))
    c, warnings = contract_from_layout(infer_layout(lines), "tb", inferred=True)
    assert c.manifest_status == "DRAFT_EXPERIMENTAL" and any("guessed" in w for w in warnings)


def test_fixed_without_layout(spark, tmp_path):
    path = put(tmp_path, "g.txt", "AAA  111\nBBB  222\n")
    assert rows(read_table(spark, path)) == [("AAA", "111"), ("BBB", "222")]
    path = put(tmp_path, "w.dat", "a bb c\nddddd e f\n")
    assert rows(read_table(spark, path)) == [("a", "bb", "c"), ("ddddd", "e", "f")]


def test_fields_of(spark):
    f = fields_of(infer_layout(spark.createDataFrame([("AB  123",)], "value string")).collect())
    assert [(x.name, x.start, x.width) for x in f] == [("campo_001", 1, 2), ("campo_002", 5, 3)]


# ---- dispatch

@pytest.mark.parametrize("path,fmt,want", [("a.csv", None, "csv"), ("a.TSV", None, "csv"), ("a.json", None, "json"), ("a.ndjson", None, "json"),
                                           ("a.pos", None, "fixed"), ("a", None, "csv"), ("a", "CSV", "csv"), ("a", " Fixed_Width ", "fixed")])
def test_format_of(path, fmt, want):
    assert format_of(path, fmt) == want


def test_unknown_format():
    with pytest.raises(ValueError, match="xml.*csv"):
        format_of("a", "xml")


def test_read_table_json_is_text(spark, tmp_path):
    df = read_table(spark, put(tmp_path, "r.json", json.dumps({"data": [{"id": 1, "v": None}, {"id": 2, "v": 1.5}]})))
    assert rows(df.select("id", "v")) == [("1", None), ("2", "1.5")]
    df = df.select(F.col("id"))
    assert df.dtypes == [("id", "string")]


def test_csv_text_comes_back(spark, tmp_path):
    rows = [(" lead ", "a"), ('say "hi", ok', "b"), ("line\nbreak", "c"), ("", None), (None, ""), ('"', "\\")]
    df = spark.createDataFrame(rows, "x string, y string")
    write_csv(df, str(tmp_path / "t.csv"))
    back = read_csv(spark, str(tmp_path / "t.csv"), multi_line=True)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_corrupt_rows_are_kept(spark, tmp_path):
    df = read_csv(spark, put(tmp_path, "c.csv", 'a,b\n1,2\n3,4,5\n6\n'), corrupt="bad")
    assert {(r["a"], r["bad"]) for r in df.collect()} == {("1", None), ("3", "3,4,5"), ("6", "6")}


def test_a_first_line_that_comes_again_is_data(spark):
    lines = spark.createDataFrame([(x,) for x in "aaa12"], "value string")
    assert not detect_header(lines, "a", ",").first()["has_header"]


def test_documents_of_different_shapes(spark, tmp_path):
    put(tmp_path, "a.json", '{"rows": [{"x": 1.10}, {"x": 12345678901234567890.12}], "n": 2}')
    put(tmp_path, "b.json", '[{"x": 3}]')
    t = read_json_document(spark, str(tmp_path))
    assert t.structure == "list" and {r["x"] for r in t.df.collect()} == {"1.10", "12345678901234567890.12", "3"}
    put(tmp_path, "c.json", '{"x": true}')
    t = read_json_document(spark, str(tmp_path))
    assert t.structure == "mixed" and t.df.count() == 4


def test_every_document_has_its_own_root(spark, tmp_path):
    put(tmp_path, "a.json", '\n {"meta": [1], "rows": [{"a": 1}]}')
    put(tmp_path, "b.json", '{"note": "[x]", "n": 0.50, "rows": [{"a": 2.50}, {"b": "t", "a": 1e3}]}')
    put(tmp_path, "c.json", '[{"a": 12345678901234567890.12}]')
    put(tmp_path, "d.json", '{"a": true, "c": {"d e": 1.0}}')
    put(tmp_path, "e.json", "[]")
    found = {r["_file"][-6:-5]: (r["structure"], r["root_key"], r["many"]) for r in json_documents(spark, str(tmp_path)).collect()}
    assert found == {"a": ("list", "meta", True), "b": ("list", "rows", True), "c": ("list", None, False), "d": ("object", None, False), "e": ("list", None, False)}
    t = read_json_document(spark, str(tmp_path), "rows")
    assert t.structure == "mixed" and t.root_key is None
    assert sorted((r["a"] or "", r["b"] or "") for r in t.df.collect()) == [("1", ""), ("12345678901234567890.12", ""), ("1e3", "t"), ("2.50", ""), ("true", "")]
    assert t.df.where("c is not null").select("c.`d e`").first()[0] == "1.0"
    (tmp_path / "a.json").unlink()
    assert read_json_document(spark, str(tmp_path)).df.count() == 4
    put(tmp_path, "f.json", '{"a": ')
    with pytest.raises(ValueError, match="1 document"):
        read_json_document(spark, str(tmp_path))


def test_documents_are_listed_once(spark, tmp_path, monkeypatch):
    """However many files and shapes there are, Spark is given folders to read, never a list of files."""
    texts = [json.dumps({"k": k}, indent=1) for k in range(40)] + ['{"rows": [{"k": 40},\r\n{"k": 41}]}', '{"rows": {"k": 42}, "a b": [{"k": 43}]}', '[{"k":\n44}]']
    write_documents(spark.createDataFrame([(t,) for t in texts], "value string"), str(tmp_path / "in"))
    assert len(list((tmp_path / "in").glob("part-*"))) == len(texts) and not list((tmp_path / "in").glob("*/"))
    given = []
    for kind in ("text", "json"):
        real = getattr(DataFrameReader, kind)
        monkeypatch.setattr(DataFrameReader, kind, lambda self, path, real=real, **options: given.append(path) or real(self, path, **options))
    t = read_json_document(spark, str(tmp_path / "in"))
    assert sorted(int(r["k"]) for r in t.df.collect()) == [*range(42), 43, 44]
    assert t.structure == "mixed" and t.root_key is None
    assert all(isinstance(p, str) for p in given) and given.count(str(tmp_path / "in")) == 1 and len(given) == 4


def test_root_that_is_an_object_and_records_of_one_kind(spark, tmp_path):
    t = read_json_document(spark, put(tmp_path, "a.json", '{"x": [1], "one": {"a": 5.0}}'), "one")
    assert (t.structure, t.root_key, t.df.first()["a"]) == ("object", "one", "5.0")
    t = read_json_document(spark, put(tmp_path, "b c.json", "[15, \"x\", 2]"))
    assert {r["item"] for r in t.df.collect()} == {"15", "x", "2"}


def test_json_lines_keep_digits(spark, tmp_path):
    path = put(tmp_path, "a.jsonl", '{"v": 1.10}\n{"v": 12345678901234567890.12}\n{"v": true}\n')
    assert {r["v"] for r in read_table(spark, path).collect()} == {"1.10", "12345678901234567890.12", "true"}


def test_loads_as_their_contract_says(spark, tmp_path):
    raw = {"table": "t", "version": "1.0.0", "schema": [{"name": "town", "type": "string"}]}
    (tmp_path / "a.csv").write_bytes('town;n\n"Malmö\nold";1\nÅbo;2\n'.encode("latin-1"))
    df = read_load(spark, str(tmp_path / "a.csv"), Contract.of({**raw, "source": {"format": "csv", "encoding": "latin-1", "delimiter": ";"}}))
    assert {tuple(r) for r in df.collect()} == {("Malmö\nold", "1"), ("Åbo", "2")}
    (tmp_path / "b.txt").write_bytes("café X1\nnoir Y2\n".encode("latin-1"))
    layout = [{"field": "town", "start": 1, "end": 5}, {"field": "code", "start": 6, "end": 7}]
    df = read_load(spark, str(tmp_path / "b.txt"), Contract.of({**raw, "layout": layout, "source": {"format": "fixed_width", "encoding": "iso_8859-1"}}))
    assert {tuple(r) for r in df.collect()} == {("café", "X1"), ("noir", "Y2")}


def test_lines_with_more_fields_than_stated(spark):
    lines = spark.createDataFrame([("a b",), ("c d e",), ("f",)], "value string")
    assert {tuple(r) for r in read_split_lines(lines, 2).collect()} == {("a", "b", None), ("c", "d", "c d e"), ("f", None, None)}


def test_types_of_keys(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": "t", "c": {"d": 1}}',), ("no json",)], "j string")
    assert {tuple(r) for r in observed_types(df, "j").collect()} == {("a", "BIGINT", 1), ("a", "STRING", 1), ("b", "STRING", 1), ("c", "OBJECT<d: BIGINT>", 1)}


def test_layout_of_long_lines(spark):
    """Fields that span ranges of positions, and ranges without any blank."""
    rows = ["AB " + "x" * 70_000 + "  " + "y" * 200_000 + " z", "CD " + "x" * 70_000 + "  Q", ""]
    assert spans(spark, *rows) == [("campo_001", 1, 2), ("campo_002", 4, 70_003), ("campo_003", 70_006, 270_007)]
