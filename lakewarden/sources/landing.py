"""Landing files as bytes: encoding triage, byte order marks, line endings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakewarden.functions.encoding import (
    EBCDIC_NAMES, SINGLE_BYTE_CHARSETS, decode_as, has_utf16le_bom, has_utf8_bom, line_ending_class, to_lf, triage_encoding,
)

EBCDIC_WARNING = "EBCDIC encoding found: the sending side has to convert the file"
LATIN_WARNING = "Not UTF-8: read as latin-1"


def read_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as (path, modificationTime, length, content); a file may be up to 2 GB.

    Spark lists no empty files, and there is nothing in them to normalise.
    """
    return spark.read.format("binaryFile").load(path)


def normalize_bytes(files: DataFrame, content: str = "content", declared: str | None = None) -> DataFrame:
    """Add encoding, bom_removed, line_endings, status, warning and the normalised text.

    A narrow projection: every file is handled where it was read, and a consumer of the
    report alone never makes the rewritten text. Bronze is never overwritten, so the
    original bytes stay where they are.
    """
    raw = F.col(content)
    out = files.withColumn("encoding", triage_encoding(raw, declared))
    out = out.withColumn("_text", decode_as(raw, F.col("encoding"), declared))
    out = out.withColumn("_ends", line_ending_class(F.col("_text")))
    is_utf8: Column = F.col("encoding").isin("ascii", "utf-8")
    bom = has_utf8_bom(raw) | has_utf16le_bom(raw)
    ebcdic = F.col("encoding") == "ebcdic"
    return out.select(
        *files.columns,
        "encoding",
        F.when(ebcdic, F.lit(False)).otherwise(bom).alias("bom_removed"),
        F.when(ebcdic | (F.col("_ends") == "LF"), F.lit("LF"))
        .otherwise(F.concat(F.col("_ends"), F.lit("->LF"))).alias("line_endings"),
        F.when(ebcdic, F.lit("ebcdic")).when(is_utf8 & ~bom & (F.col("_ends") == "LF"), F.lit("already_utf8"))
        .otherwise(F.lit("ok")).alias("status"),
        F.when(ebcdic, F.lit(EBCDIC_WARNING))
        .when((F.col("encoding") == "latin-1") & F.lit(declared is None), F.lit(LATIN_WARNING)).alias("warning"),
        to_lf(F.col("_text")).alias("text"),
    )


def normalization_report(spark: SparkSession, path: str, declared: str | None = None) -> DataFrame:
    """One row per landing file. ``backup_path`` is the untouched original."""
    report = normalize_bytes(read_bytes(spark, path), declared=declared)
    return report.select("path", "length", "status", "encoding", "bom_removed", "line_endings",
                         F.col("path").alias("backup_path"), "warning")


def write_normalized(files: DataFrame, path: str) -> None:
    """Normalised text, one line per row, EBCDIC files left out."""
    lines = (files.filter(F.col("status") != "ebcdic")
             .select(F.explode(F.split(F.regexp_replace("text", "\n$", ""), "\n")).alias("value")))
    lines.write.mode("overwrite").text(path)


def file_summaries(spark: SparkSession, path: str, declared: str | None = None) -> DataFrame:
    """(path, length, status, encoding, bom_removed, line_endings, warning) of landing files of any size.

    The same report as normalization_report(), but files are read as lines, which split, and each split sends one row a
    file: whether its bytes are UTF-8 or ASCII, its line ends, and its first bytes. A file beyond 2 GB is no case of
    its own, as long as its lines are not that long.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"), F.col("_metadata.file_block_start").alias("_block"),
        F.col("value").cast("binary").alias("_line"), F.monotonically_increasing_id().alias("_place"))
    line, size = F.col("_line"), F.octet_length("_line")
    latin = F.decode(line, "ISO-8859-1")
    hits = lambda ch: size - F.length(F.replace(latin, F.lit(ch), F.lit("")))
    wide = F.hex(F.substring(line, size - 1, F.lit(2))) == "0D00"
    merged = raw.groupBy("path").agg(
        F.max("length").alias("length"), F.sum(size).alias("_bytes"), F.bool_and(F.is_valid_utf8(line)).alias("_utf8"),
        F.bool_and(F.length(line.cast("string")) == size).alias("_ascii"), F.sum(hits("@")).alias("_at"), F.sum(hits(" ")).alias("_blank"),
        F.count(F.lit(1)).alias("_lines"), F.count_if(latin.endswith("\r")).alias("_crlf"), F.count_if(wide).alias("_wide"), F.sum(hits("\r")).alias("_cr"),
        F.max_by(F.when(latin.endswith("\r"), 1).otherwise(0), F.struct("_block", "_place")).alias("_last_cr"),
        F.min_by(F.substring(line, 1, 3), F.struct("_block", "_place")).alias("_first"))
    # There is a line feed a line, or one less. The reader leaves a UTF-8 byte order mark out, which is three bytes more.
    bom8 = F.col("length") - F.col("_bytes") > F.col("_lines")
    feeds = F.col("length") - F.col("_bytes") - F.when(bom8, 3).otherwise(0)
    # A last line without a line feed behind it is a line too; a carriage return at its end stands alone.
    ended = feeds == F.col("_lines")
    head = F.hex("_first")
    bom16 = F.startswith(head, F.lit("FFFE"))
    name = (declared or "").lower()
    found = (F.when(bom8, "utf-8-sig").when(bom16, "utf-16").when(F.col("_utf8") & F.col("_ascii"), "ascii").when(F.col("_utf8"), "utf-8")
             .when(~F.col("_utf8") & (F.col("_at") > F.col("_blank")), "ebcdic").otherwise("latin-1"))
    if name.replace("_", "-") in EBCDIC_NAMES:
        found = F.lit("ebcdic")
    elif name in SINGLE_BYTE_CHARSETS:
        found = F.when(bom8, "utf-8-sig").otherwise(F.lit(name))
    crlf = F.when(found == "utf-16", F.col("_wide")).otherwise(F.col("_crlf") - F.when(ended, 0).otherwise(F.col("_last_cr")))
    ends = (F.when((crlf > 0) & (feeds > crlf), "mixed").when(crlf > 0, "CRLF").when(F.col("_cr") > crlf, "CR").otherwise("LF"))
    told = merged.select("path", "length", found.alias("encoding"), (bom8 | bom16).alias("_bom"), ends.alias("_ends"))
    ebcdic = F.col("encoding") == "ebcdic"
    return told.select(
        "path", "length",
        F.when(ebcdic, "ebcdic").when(F.col("encoding").isin("ascii", "utf-8") & ~F.col("_bom") & (F.col("_ends") == "LF"), "already_utf8").otherwise("ok").alias("status"),
        "encoding", F.when(ebcdic, F.lit(False)).otherwise(F.col("_bom")).alias("bom_removed"),
        F.when(ebcdic | (F.col("_ends") == "LF"), "LF").otherwise(F.concat("_ends", F.lit("->LF"))).alias("line_endings"),
        F.when(ebcdic, F.lit(EBCDIC_WARNING)).when((F.col("encoding") == "latin-1") & F.lit(declared is None), F.lit(LATIN_WARNING)).alias("warning"))
