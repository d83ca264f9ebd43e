"""Byte-level landing checks: byte order marks, encodings, line endings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Encodings that are decoded, by the charset name Spark uses for them.
SINGLE_BYTE_CHARSETS = {
    "latin-1": "ISO-8859-1",
    "iso-8859-1": "ISO-8859-1",
    "iso-8859-15": "ISO-8859-15",
    "cp1252": "windows-1252",
    "windows-1252": "windows-1252",
    "cp850": "IBM850",
    "cp437": "IBM437",
}
EBCDIC_NAMES = ["cp037", "cp500", "cp1140", "ibm037", "ebcdic"]


UTF8_NAMES = ["utf-8", "utf8", "utf-8-sig", "ascii", "us-ascii"]


def charset_of(encoding: str | None) -> str | None:
    """Name that Spark's readers have for an encoding as contracts and triage name it; None for UTF-8, which is their own."""
    name = (encoding or "utf-8").strip().lower().replace("_", "-")
    if name in UTF8_NAMES:
        return None
    return SINGLE_BYTE_CHARSETS.get(name, name.upper())


def has_utf8_bom(content: Column) -> Column:
    return F.hex(F.substring(content, 1, 3)) == "EFBBBF"


def has_utf16le_bom(content: Column) -> Column:
    return F.hex(F.substring(content, 1, 2)) == "FFFE"


def strip_bom(content: Column) -> Column:
    rest = F.length(content)
    return (F.when(has_utf8_bom(content), F.substring(content, F.lit(4), rest))
            .when(has_utf16le_bom(content), F.substring(content, F.lit(3), rest))
            .otherwise(content))


def looks_ebcdic(content: Column) -> Column:
    """Not UTF-8, and spaces are 0x40 rather than 0x20."""
    as_latin = F.decode(content, "ISO-8859-1")

    def hits(ch: str) -> Column:
        return F.length(as_latin) - F.length(F.replace(as_latin, F.lit(ch), F.lit("")))

    return ~F.is_valid_utf8(content) & (hits("@") > hits(" "))


def line_ending_class(text: Column) -> Column:
    """LF, CRLF, CR or mixed. CR beside a lone LF without any CRLF is reported as CR."""
    crlf = F.contains(text, F.lit("\r\n"))
    rest = F.replace(text, F.lit("\r\n"), F.lit(""))
    return (F.when(crlf & F.contains(rest, F.lit("\n")), F.lit("mixed"))
            .when(crlf, F.lit("CRLF"))
            .when(F.contains(rest, F.lit("\r")), F.lit("CR"))
            .otherwise(F.lit("LF")))


def to_lf(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def triage_encoding(content: Column, declared: str | None = None) -> Column:
    """Encoding label of the bytes; a declared encoding wins over the checks.

    substring() on bytes that are all below 0x80 re-encodes to the same length, so comparing
    the UTF-8 text length with the byte length separates ASCII from UTF-8.
    """
    if declared is not None and declared.lower().replace("_", "-") in EBCDIC_NAMES:
        return F.lit("ebcdic")
    if declared is not None and declared.lower() in SINGLE_BYTE_CHARSETS:
        return (F.when(has_utf8_bom(content), F.lit("utf-8-sig"))
                .otherwise(F.lit(declared.lower())))
    ascii_only = F.length(content.cast("string")) == F.length(content)
    return (F.when(has_utf8_bom(content), F.lit("utf-8-sig"))
            .when(has_utf16le_bom(content), F.lit("utf-16"))
            .when(F.is_valid_utf8(content) & ascii_only, F.lit("ascii"))
            .when(F.is_valid_utf8(content), F.lit("utf-8"))
            .when(looks_ebcdic(content), F.lit("ebcdic"))
            .otherwise(F.lit("latin-1")))


def decode_as(content: Column, encoding: Column, declared: str | None = None) -> Column:
    """Text of the bytes without their byte order mark."""
    body = strip_bom(content)
    single = SINGLE_BYTE_CHARSETS.get((declared or "latin-1").lower(), "ISO-8859-1")
    return (F.when(encoding.isin("ascii", "utf-8", "utf-8-sig"),
                   F.make_valid_utf8(body.cast("string")))
            .when(encoding == "utf-16", F.decode(body, "UTF-16LE"))
            .when(encoding == "ebcdic", F.lit(None).cast("string"))
            .otherwise(F.decode(body, single)))
