import pytest

from lakewarden.functions.codes import catalog_type, clean_format, exit_code, fixed_width_type
from lakewarden.functions.flags import regulatory_flags, table_tags, tags_of
from lakewarden.functions.naming import base_table_name, json_path_name, rename_snake, snake_case, snake_name
from lakewarden.operators.govern import catalog_columns
from lakewarden.operators.infer import draft_contract, infer_columns, observed_domains, without_contract
from pyspark.sql import functions as F


def infer(spark, values, name="v"):
    return infer_columns(spark.createDataFrame([(v,) for v in values], "v string").toDF(name)).first()


@pytest.mark.parametrize("values,want", [
    (["1.5", "2.3"], "float"), (["1", "2", "3"], "integer"), (["1.0", "2.00"], "integer"), (["1e3", " 7 "], "integer"),
    (["S", "N", "S"], "boolean"), (["sim", "NAO", "não"], "boolean"), (["sim", "nao"], "string"), (["1", "0"], "boolean"),
    (["1", "1"], "integer"), (["True", "false"], "boolean"), (["y", "N"], "boolean"), (["yes", "NO"], "boolean"), (["yes", "n"], "string"),
    (["01/01/2024", "15/06/2023"], "date"), (["1/2/2024"], "date"), (["31-12-2024"], "date"), (["2024-02-29"], "date"),
    (["2023-02-29"], "string"), (["2024/1/5"], "date"), (["01/02/24"], "date"), (["01/02/2024", "01/02/24"], "string"),
    (["32/01/2024"], "string"), (["ABC", "XYZ"], "string"), (["inf", "1"], "string"), (["12345678901"], "integer"),
    (["99999999999999999999"], "float"), ([None, ""], "string"), ([], "string"), (["1_000"], "string"), (["1d"], "string"),
])
def test_types(spark, values, want):
    assert infer(spark, values)["type"] == want


def test_date_format_and_mixed(spark):
    assert infer(spark, ["01/01/2024"])["date_format"] == "%d/%m/%Y"
    assert infer(spark, ["2024-01-01", ""])["date_format"] == "%Y-%m-%d"
    assert infer(spark, ["1", "x"])["mixed"] and infer(spark, ["1", "2", "3", "x"])["mixed"]
    assert not infer(spark, ["1", "x", "y", "z"])["mixed"] and not infer(spark, ["x"])["mixed"]


def test_nullable_and_key(spark):
    assert infer(spark, ["1", ""])["nullable"] and infer(spark, ["1", None])["nullable"] and not infer(spark, ["1"])["nullable"]
    assert infer(spark, ["1", "2"], "id_cliente")["primary_key"]
    assert infer(spark, ["1", "2", None], "CdCliente")["primary_key"]
    assert not infer(spark, ["1", "1"], "id_cliente")["primary_key"]
    assert not infer(spark, ["1", "2"], "nome")["primary_key"]
    assert not infer(spark, [None], "id_x")["primary_key"]


def test_range_and_domain(spark):
    r = infer(spark, ["3", " 1.5 ", "", "2"])
    assert (r["range_min"], r["range_max"], r["domain_size"]) == (1.5, 3.0, None)
    assert infer(spark, [f"v{i}" for i in range(20)])["domain_size"] == 20
    assert infer(spark, [f"v{i}" for i in range(21)])["domain_size"] is None


def test_observed_domain_leaves_out_the_empty_string(spark):
    df = spark.createDataFrame([(v,) for v in [""] * 9 + list("aaabbcdefg") + [None] * 9], "v string")
    got = sorted((r["value_rank"], r["value"], r["cnt"]) for r in observed_domains(df).collect())
    assert got == [(1, "a", 3), (2, "b", 2), (3, "c", 1), (4, "d", 1), (5, "e", 1)]


def test_draft_contract(spark):
    df = spark.createDataFrame([("1", "Ana", "10.5", "S"), ("2", "Bia", "20.5", "N")], "ID_CLIENTE string, `NM Nome` string, VlRenda string, fl string")
    c = draft_contract(df, "tb", delimiter=";")
    assert c.manifest_status == "DRAFT" and c.source["delimiter"] == ";"
    assert c.column_names() == ["id_cliente", "nm_nome", "vl_renda", "fl"]
    assert c.primary_keys() == ["id_cliente"] and [x.type for x in c.columns] == ["integer", "string", "float", "boolean"]
    assert c.columns[2].business_rules == ("Range: 10.5 to 20.5",) and "Domain (2 values)" in c.columns[1].business_rules[0]
    assert c.regulatory["data_classification"] == "confidential" and c.regulatory["tags"] == ["LGPD", "SCR", "BACEN_4658"]


@pytest.mark.parametrize("raw,want", [
    ("CD CLIENTE", "cd_cliente"), ("CdCliente", "cd_cliente"), ("cd_cliente", "cd_cliente"), ("CD-CLIENTE/BANCO", "cd_cliente_banco"),
    ("VLRenda2Mes", "vl_renda2_mes"), ("  __x--y__ ", "x_y"), ("ação$1", "ação_1"),
])
def test_snake_case(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "v string")
    assert df.select(snake_case(F.col("v"))).first()[0] == want == snake_name(raw)


def test_other_names(spark):
    df = spark.createDataFrame([("End.X__ Cidade-1__uf", "tb_a_non_breaking.yaml")], "p string, t string")
    assert df.select(json_path_name(F.col("p")), base_table_name(F.col("t"))).first()[:] == ("end_x__cidade_1__uf", "tb_a")
    assert rename_snake(spark.createDataFrame([(1,)], "`CD X` int")).columns == ["cd_x"]


@pytest.mark.parametrize("name,label,flag", [
    ("nr_cpf_cnpj", "CPF", "LGPD_SENSITIVE"), ("nm_cliente", "NOME", "LGPD_SENSITIVE"), ("vl_renda", "RENDA", "SCR_CANDIDATE"),
    ("cd_senha", "SENHA", "RESTRICTED"), ("carga", None, "LGPD_SENSITIVE"), ("dt_cadastro", "DATA", None),
])
def test_flags(spark, name, label, flag):
    got = spark.createDataFrame([(name, label)], "n string, l string").select(regulatory_flags(F.col("n"), F.col("l"))).first()[0]
    assert got == ([flag] if flag else [])


def test_table_tags(spark):
    df = spark.createDataFrame([("a", ["LGPD_SENSITIVE"]), ("a", ["SCR_CANDIDATE"]), ("b", ["RESTRICTED"]), ("c", [])],
                               "`table` string, regulatory_flags array<string>")
    got = {r["table"]: (r["tags"], r["data_classification"]) for r in table_tags(df).collect()}
    assert got == {"a": (["LGPD", "SCR", "BACEN_4658"], "confidential"), "b": (["BACEN_4658"], "internal"), "c": ([], "internal")}
    assert df.filter("`table` = 'b'").select(tags_of(F.col("regulatory_flags"))).first()[0] == ["BACEN_4658"]


@pytest.mark.parametrize("fmt,storage,want,fixed", [
    ("DATE9.", "numeric", "date", "date"), ("DATETIME19.", "numeric", "date", "datetime"), ("BEST12.", "numeric", "float", "float"),
    ("$CHAR20.", "numeric", "string", "string"), ("Z8.", "numeric", "integer", "integer"), ("YESNO.", "numeric", "boolean", "boolean"),
    ("XYZ", "numeric", "float", "float"), ("", "numeric", "float", "float"), ("DATE9.", "character", "string", "string"),
    ("DT8.", "numeric", "datetime", "datetime"),
])
def test_catalog_types(spark, fmt, storage, want, fixed):
    df = spark.createDataFrame([(fmt, storage)], "f string, s string")
    clean = clean_format(F.col("f"))
    assert df.select(catalog_type(clean, F.col("s"))).first()[0] == want
    assert df.select(catalog_type(clean, F.col("s"), fix_datetime=True)).first()[0] == fixed


def test_catalog_columns(spark):
    cat = spark.createDataFrame([("t", 0, "CD_CLI", "", "Z8.", "numeric"), ("t", 1, "CdX", "Nome", "", "character")],
                                "`table` string, pos int, name string, label string, format string, storage string")
    a, b = sorted(catalog_columns(cat).collect(), key=lambda r: r["pos"])
    assert (a["primary_key"], a["nullable"], a["type"], a["description"]) == (True, False, "integer", "# TODO: describe cd_cli")
    assert (b["primary_key"], b["name"], b["description"], b["regulatory_flags"]) == (False, "cd_x", "Nome", ["LGPD_SENSITIVE"])


def test_codes(spark):
    df = spark.createDataFrame([("PASS",), ("SKIPPED",), ("WARNING",), ("DLQ",), ("ERROR",), ("?",)], "s string")
    assert [r[0] for r in df.select(exit_code(F.col("s"))).collect()] == [0, 0, 1, 2, 2, 1]
    df = spark.createDataFrame([("CHAR",), ("packed",), ("9",), ("d",), ("dt",), ("zz",)], "s string")
    assert [r[0] for r in df.select(fixed_width_type(F.col("s"))).collect()] == ["string", "float", "integer", "date", "datetime", "string"]


def test_without_contract(spark):
    landed = spark.createDataFrame([("a",), ("b",)], "`table` string")
    assert [r["table"] for r in without_contract(landed, landed.filter("`table` = 'a'")).collect()] == ["b"]
