import pytest
from pyspark.sql import functions as F

from lakewarden.functions.encoding import line_ending_class, to_lf
from lakewarden.sources.landing import normalization_report, normalize_bytes, read_bytes, write_normalized


@pytest.mark.parametrize("text,want", [("a\nb\n", "LF"), ("a\r\nb\r\n", "CRLF"), ("a\r\nb\n", "mixed"), ("a\rb\r", "CR"),
                                       ("a\rb\n", "CR"), ("a\r\nb\r", "CRLF"), ("", "LF")])
def test_line_endings(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    kind, lf = df.select(line_ending_class(F.col("t")), to_lf(F.col("t"))).first()
    assert kind == want and lf == text.replace("\r\n", "\n").replace("\r", "\n")


FILES = {
    "plain.csv": (b"id,nome\n1,Ana\n", ("already_utf8", "ascii", False, "LF"), "id,nome\n1,Ana\n"),
    "utf8.csv": ("é\n".encode(), ("already_utf8", "utf-8", False, "LF"), "é\n"),
    "crlf.csv": (b"id\r\n1\r\n", ("ok", "ascii", False, "CRLF->LF"), "id\n1\n"),
    "latin.csv": ("João\n".encode("latin-1"), ("ok", "latin-1", False, "LF"), "João\n"),
    "bom.csv": (b"\xef\xbb\xbfid\n1\n", ("ok", "utf-8-sig", True, "LF"), "id\n1\n"),
    "utf16.csv": (b"\xff\xfe" + "idé\r\n".encode("utf-16-le"), ("ok", "utf-16", True, "CRLF->LF"), "idé\n"),
    "mixed.csv": (b"a\r\nb\n", ("ok", "ascii", False, "mixed->LF"), "a\nb\n"),
    "host.dat": ("CLIENTE ANA  ".encode("cp037"), ("ebcdic", "ebcdic", False, "LF"), None),
}


@pytest.fixture
def landing(tmp_path):
    for name, (content, _, _) in FILES.items():
        (tmp_path / name).write_bytes(content)
    return tmp_path


def test_report_and_text(spark, landing):
    out = {r["path"].rsplit("/", 1)[1]: r for r in normalize_bytes(read_bytes(spark, str(landing))).collect()}
    for name, (_, want, text) in FILES.items():
        r = out[name]
        assert (r["status"], r["encoding"], r["bom_removed"], r["line_endings"]) == want, name
        assert r["text"] == text, name
    assert "EBCDIC" in out["host.dat"]["warning"] and out["plain.csv"]["warning"] is None
    assert "latin-1" in out["latin.csv"]["warning"]


def test_report_keeps_the_original(spark, landing):
    report = normalization_report(spark, str(landing))
    assert report.count() == len(FILES)
    assert all(r["backup_path"] == r["path"] for r in report.collect())
    assert (landing / "crlf.csv").read_bytes() == b"id\r\n1\r\n"


def test_declared_encoding_wins(spark, tmp_path):
    (tmp_path / "c.csv").write_bytes("preço €\n".encode("cp1252"))
    r = normalize_bytes(read_bytes(spark, str(tmp_path)), declared="cp1252").first()
    assert (r["encoding"], r["text"], r["warning"]) == ("cp1252", "preço €\n", None)
    assert normalize_bytes(read_bytes(spark, str(tmp_path)), declared="cp037").first()["status"] == "ebcdic"


def test_write_normalized(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_bytes(b"id\r\n1\r\n\r\n2")
    write_normalized(normalize_bytes(read_bytes(spark, str(tmp_path / "in"))), str(tmp_path / "out"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()] == ["id", "1", "", "2"]
