"""Delimited files read together, each by the header it came with.

Lines are read as text with the file and the block they come from. The first line of a file's first
block is its header, so files whose columns are in another order, are fewer or more, are mapped by
name and not by place. One plan serves any number of files and layouts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakewarden.functions.encoding import charset_of
from lakewarden.sources.tabular import TEXT_OPTIONS

FILE, BLOCK, PLACE = "_file", "_block", "_place"
EXTRA, CORRUPT = "_extra", "_corrupt_record"


def file_lines(spark: SparkSession, path: str, encoding: str | None = None, stream: bool = False, **options) -> DataFrame:
    """(value, _file, _block) of the lines of all files of a folder, at once or as they arrive."""
    reader = (spark.readStream if stream else spark.read).options(**options)
    charset = charset_of(encoding)
    if charset:
        # One string column through the CSV reader, which is the text source that decodes.
        lines = reader.schema("value string").option("encoding", charset).option("sep", "\u0001").option("quote", "").csv(path)
    else:
        lines = reader.text(path)
    return lines.select("value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK))


def placed(lines: DataFrame) -> DataFrame:
    """Lines with their order inside each block; to be written before use, as places hold for one reading."""
    return lines.withColumn(PLACE, F.monotonically_increasing_id())


def _outside_quotes(line: Column) -> Column:
    return F.regexp_replace(line, '"[^"]*"', "")


def field_count(line: Column, sep: str) -> Column:
    """Fields of a line; separators inside quotes do not count."""
    bare = _outside_quotes(line)
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def _with_fields(df: DataFrame, line: str, sep: str, width: int, out: str) -> DataFrame:
    """Add an array of the first ``width`` fields of a line, parsed as the CSV reader does."""
    names = [f"f{i}" for i in range(width)]
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in TEXT_OPTIONS.items()}
    parsed = F.from_csv(line, ", ".join(f"{n} string" for n in names), {**options, "sep": sep, "nullValue": "\u0001NULL"})
    # a column of its own, so that a line is parsed once
    return df.withColumn("_csv", parsed).withColumn(out, F.array(*[F.col(f"_csv.{n}") for n in names])).drop("_csv")


def headers(lines: DataFrame, sep: str = ",") -> DataFrame:
    """(_file, _first, names) of every file: where its header stands, and its columns in order.

    A name without text is col_001, col_002, ... by its place; a repeated name gets .1, .2, ... after it.
    One row per file and task is shuffled. A file without any line has no row.
    """
    first = lines.where(F.col(BLOCK) == 0).groupBy(FILE).agg(F.min_by("value", PLACE).alias("_line"), F.min(PLACE).alias("_first"))
    first = first.withColumn("_line", F.regexp_replace("_line", "^\ufeff", ""))
    width = first.agg(F.max(F.length("_line") - F.length(F.replace("_line", F.lit(sep), F.lit(""))) + 1)).first()[0] or 1
    first = _with_fields(first, "_line", sep, width, "_raw")
    named = F.transform(F.slice("_raw", F.lit(1), field_count(F.col("_line"), sep).cast("int")), lambda n, i: F.when(F.trim(F.coalesce(n, F.lit(""))) == "", F.concat(F.lit("col_"), F.lpad((i + 1).cast("string"), 3, "0"))).otherwise(n))
    found = first.select(FILE, "_first", named.alias("_n"))
    before = F.transform("_n", lambda n, i: F.size(F.filter(F.slice("_n", F.lit(1), i), lambda m: m == n)))
    names = F.zip_with("_n", before, lambda n, k: F.when(k > 0, F.concat(n, F.lit("."), k.cast("string"))).otherwise(n))
    return found.select(FILE, "_first", names.alias("names"))


def records(lines: DataFrame, heads: DataFrame, columns: list[str], sep: str = ",") -> DataFrame:
    """Rows of all files with the given columns by name, other columns in ``_extra``, and ``_file``.

    A column that a file does not have is NULL there, and so are the last columns of a line with too few fields.
    ``_corrupt_record`` holds the whole line where it has too many fields or a quote that does not end on
    it. Blank lines are left out.
    """
    width = heads.agg(F.max(F.size("names"))).first()[0] or 1
    wanted = F.array(*[F.lit(c) for c in columns]).cast("array<string>")
    known = heads.withColumns({
        "_at": F.transform(wanted, lambda c: F.array_position("names", c).cast("int") - 1),
        "_more": F.array_except("names", wanted), "_width": F.size("names")})
    known = known.withColumn("_more_at", F.transform("_more", lambda c: F.array_position("names", c).cast("int") - 1))
    body = lines.where(F.trim(F.col("value")) != "").join(known.drop("names"), FILE)
    body = body.where(~((F.col(BLOCK) == 0) & (F.col(PLACE) == F.col("_first"))))
    body = _with_fields(body, "value", sep, width, "_f")
    odd = F.contains(_outside_quotes(F.col("value")), F.lit('"'))
    return body.select(
        *[F.get("_f", F.get("_at", F.lit(i))).alias(c) for i, c in enumerate(columns)],
        F.map_from_arrays("_more", F.transform("_more_at", lambda i: F.get("_f", i))).alias(EXTRA),
        F.when(odd | (field_count(F.col("value"), sep) > F.col("_width")), F.col("value")).alias(CORRUPT), FILE)
