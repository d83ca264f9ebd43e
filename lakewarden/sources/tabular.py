"""Delimited text: reading, writing, and finding out delimiter and header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakewarden.functions.encoding import charset_of
from lakewarden.functions.numeric import double_text_sql, is_number_sql
from lakewarden.functions.sqltext import ident, literal

# Candidates in order of preference when nothing else tells them apart.
DELIMITERS = [",", ";", "|", "\t"]


# Quotes are doubled inside quoted text, and blanks belong to the text. An empty field is NULL, "" is an empty text.
TEXT_OPTIONS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_csv(spark: SparkSession, path: str, sep: str | None = None, header: bool = True,
             encoding: str | None = None, null_values: str | None = None, mode: str = "PERMISSIVE",
             schema: T.StructType | None = None, sample_rows: int | None = None, multi_line: bool = False,
             corrupt: str | None = None) -> DataFrame:
    """All columns as strings. ``mode`` DROPMALFORMED skips bad lines.

    Without a header columns are named col_001, col_002, ... A sample is only taken when asked
    for: inference reads everything by default. ``multi_line`` reads line breaks inside quotes, one
    file per task. ``corrupt`` names a column that keeps the whole text of rows with too few or too
    many fields, which otherwise lose or lack values silently; ask for it along with other columns.
    """
    sep = sep or ("\t" if path.lower().endswith(".tsv") else ",")

    def reader(given: T.StructType | None):
        out = (spark.read.options(**TEXT_OPTIONS).option("header", header).option("sep", sep).option("inferSchema", False)
               .option("mode", mode).option("multiLine", multi_line).option("enforceSchema", False if header and given else True))
        # Any text that no field holds: unquoted empty fields become NULL, quoted ones stay empty.
        for name, value in (("encoding", charset_of(encoding)), ("nullValue", "\u0001NULL" if null_values is None else null_values), ("columnNameOfCorruptRecord", corrupt)):
            out = out if value is None else out.option(name, value)
        return out if given is None else out.schema(given)

    df = reader(schema).csv(path)
    if not header and schema is None:
        df = df.toDF(*[f"col_{i + 1:03d}" for i in range(len(df.columns))])
    if corrupt:
        wide = T.StructType([*df.schema.fields, T.StructField(corrupt, T.StringType())])
        # Fields are counted only where the parser does not skip columns.
        df = reader(wide).option("enforceSchema", True).option("columnPruning", False).csv(path)
    return df.limit(sample_rows) if sample_rows else df


def _quote_count(line: str):
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def breaks_inside_quotes(lines: DataFrame) -> bool:
    """Whether a quoted text goes on in the next line: then some line has an odd number of quotes."""
    return bool(lines.agg(F.bool_or(_quote_count("value") % 2 == 1).alias("b")).first()["b"])


def sniff_csv(spark: SparkSession, path: str, encoding: str | None = None, **options) -> DataFrame:
    """read_csv with delimiter, header and line breaks inside quotes found from the data itself."""
    lines = read_lines(spark, path, encoding)
    sep = detect_delimiter(lines).first()["delimiter"]
    first = lines.filter("value <> ''").first()
    header = first is None or detect_header(lines, first["value"], sep).first()["has_header"]
    if "multi_line" not in options:
        options["multi_line"] = breaks_inside_quotes(lines)
    return read_csv(spark, path, sep=sep, header=header, encoding=encoding, **options)


def read_lines(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    charset = charset_of(encoding)
    if charset:
        # One string column through the CSV reader, which is the text source that decodes.
        reader = spark.read.schema("value string").option("encoding", charset).option("sep", "\u0001").option("quote", "")
        return (reader.option("lineSep", "\n") if charset.startswith("UTF-") else reader).csv(path)
    return spark.read.text(path)


def read_split_lines(lines: DataFrame, width: int | None = None, corrupt: str = "_corrupt_record") -> DataFrame:
    """Whitespace-separated fields of text lines, for positional files without any layout.

    With a stated width, lines with more fields keep the first ones, and the whole line in a column for
    corrupt records.
    """
    parts = F.split(F.trim("value"), r"\s+")
    cut = lines.select(parts.alias("p"), "value").filter(F.element_at("p", 1) != "")
    fields = width if width is not None else cut.agg(F.max(F.size("p"))).first()[0] or 0
    longer = [] if width is None else [F.when(F.size("p") > width, F.col("value")).alias(corrupt)]
    return cut.select(*[F.get("p", F.lit(i)).alias(f"col_{i + 1:03d}") for i in range(fields)], *longer)


def estimated_rows(lines: DataFrame) -> DataFrame:
    """Number of lines less the header, never below zero."""
    return lines.agg(F.greatest(F.count(F.lit(1)) - 1, F.lit(0)).alias("rows_estimate"))


def _separator_sql(sep: str) -> str:
    return "chr(9)" if sep == "\t" else literal(sep)


def delimiter_evidence(lines: DataFrame) -> DataFrame:
    """Per candidate: lines, occurrences and their exact sum of squares. One row per task is shuffled."""
    aggs, structs = ["count(1) as lines"], []
    for i, sep in enumerate(DELIMITERS):
        hits = f"cast(length(value) - length(replace(value, {_separator_sql(sep)}, '')) as bigint)"
        # The squares are added up as decimals, which a very large file cannot overflow.
        aggs += [f"coalesce(sum({hits}), 0L) as s{i}", f"coalesce(sum(cast({hits} * {hits} as decimal(20,0))), 0) as q{i}"]
        # n * sum(x^2) - sum(x)^2 is zero exactly when every line has the same number.
        structs.append(f"named_struct('preference', {i}, 'delimiter', {_separator_sql(sep)}, 'lines', lines, 'occurrences', cast(s{i} as double), "
                       f"'spread', lines * cast(q{i} as double) - cast(s{i} as double) * cast(s{i} as double))")
    one = lines.filter("value <> ''").agg(*[F.expr(e) for e in aggs])
    return one.selectExpr(f"inline(array({', '.join(structs)}))")


def detect_delimiter(lines: DataFrame) -> DataFrame:
    """The candidate whose number per line varies least, relative to how often it occurs."""
    best = delimiter_evidence(lines).filter("occurrences > 0").agg(F.expr(
        "min_by(delimiter, struct(spread / (occurrences * occurrences), -occurrences, preference)) as d"))
    return best.selectExpr("coalesce(d, ',') as delimiter")


def detect_header(lines: DataFrame, first_line: str, sep: str) -> DataFrame:
    """Whether the first line names the columns, by a vote of the columns.

    A column whose other values are all numbers votes yes when its first value is none. A
    column of constant length votes yes when the first value is longer or shorter. Only the first
    line itself is left out: where equal lines follow, one of them stands for them in the vote.
    """
    width = first_line.count(sep) + 1
    schema = ", ".join(f"f{i} string" for i in range(width))
    parse = f"from_csv({{}}, '{schema}', map('sep', {_separator_sql(sep)}))"
    body = lines.filter("value <> ''").selectExpr(f"{parse.format('value')} as r", f"value = {literal(first_line)} as same")
    stats, folded, votes = ["count_if(same) as again"], ["h"], []
    for i in range(width):
        stats += [f"bool_and(coalesce({is_number_sql(f'r.f{i}')}, false)) filter (where not same) as n{i}",
                  f"min(coalesce(length(r.f{i}), 0)) filter (where not same) as a{i}",
                  f"max(coalesce(length(r.f{i}), 0)) filter (where not same) as z{i}"]
        size = f"if(again > 1, coalesce(length(h.f{i}), 0), null)"
        folded += [f"if(again > 1, coalesce(n{i}, true) and coalesce({is_number_sql(f'h.f{i}')}, false), n{i}) as n{i}",
                   f"least(a{i}, {size}) as a{i}", f"greatest(z{i}, {size}) as z{i}"]
        votes.append(f"case when n{i} then if({is_number_sql(f'h.f{i}')}, -1, 1) "
                     f"when a{i} = z{i} then if(length(h.f{i}) = a{i}, -1, 1) else 0 end")
    seen = body.agg(*[F.expr(e) for e in stats]).selectExpr("*", f"{parse.format(literal(first_line))} as h").selectExpr(*folded)
    return (seen.selectExpr(f"coalesce({' + '.join(votes)}, 0) as votes")
            .selectExpr("votes > 0 as has_header", "votes"))


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    """Text comes back as it was from read_csv (with multi_line, where it has line breaks); NULL and '' stay apart.

    Numbers are written without an exponent, as landing files have them.
    """
    doubles = {f.name: F.expr(double_text_sql(ident(f.name))) for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    df = df.withColumns(doubles) if doubles else df
    (df.write.mode("overwrite").options(**TEXT_OPTIONS).option("header", header).option("sep", sep)
     .option("emptyValue", '""').option("lineSep", "\n").csv(path))
