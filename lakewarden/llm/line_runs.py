"""Removal of repeated runs of lines, by prefix doubling over sequences of line numbers.

A line's number is the digest of its text; doubling gives the name of the 2, 4, 8, ... lines from
each line on from two names of half the length. Equal names are suffixes with a common prefix of
that many lines. The runs looked up are the shortest with MIN_WORDS words that begin, and that end,
at each line: a maximal repeated run of at least that many words is exactly the union of those
inside it, so the common-prefix intervals need not be followed further. A run's key is the two
overlapping names that cover it; its first place stays, later copies go.

Blank lines take no part in runs; those inside one of the shortest repeated runs go with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakewarden.llm.rows import rows_apart
from lakewarden.llm.staging import staged, whole_text

MIN_WORDS = 25


def line_words(line: Column) -> Column:
    """Words between blanks; a blank line has none."""
    trimmed = F.trim(line)
    return F.when(trimmed == "", 0).otherwise(F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "), F.lit(""))) + 1)


def _doubled(names: str, step: int) -> Column:
    """Names of 2 * step lines from names of step lines."""
    first = F.slice(names, F.lit(1), F.greatest(F.size(names) - step, F.lit(0)))
    return F.transform(first, lambda x, i: F.unhex(F.md5(F.concat(x, F.get(F.col(names), i + step)))))


def _shortest(weights: Column, least: int) -> Column:
    """How many of the weights, from the first on, reach the least sum; null if all do not."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n"))
    found = F.aggregate(weights, start, lambda s, w: F.when(s["sum"] >= least, s).otherwise(
        F.struct((s["sum"] + w).alias("sum"), (s["n"] + 1).alias("n"))))
    return F.when(found["sum"] >= least, found["n"])


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Spans (doc_id, first, last) of line numbers from 0: every run that also begins at an earlier place.

    Places are ordered by doc_id, then line; a null doc_id is last. One digest joins rows of one doc_id.
    """
    parts = F.filter(F.transform(F.split(whole_text(), "\n", -1), lambda line, i: F.struct(i.alias("at"), line.alias("line"), line_words(line).alias("w"))), lambda x: x["w"] > 0)
    rows = docs.select("doc_id", parts.alias("body")).where(F.size("body") > 0)
    rows = rows.select("doc_id", F.col("body.at").alias("at"), F.col("body.w").alias("w"), F.transform("body", lambda x: F.unhex(F.md5(x["line"]))).alias("names1"))
    steps = [1]
    while 2 * steps[-1] <= min_words:
        rows = rows.withColumn(f"names{2 * steps[-1]}", _doubled(f"names{steps[-1]}", steps[-1]))
        steps.append(2 * steps[-1])
    spans = F.transform("w", lambda _, i: F.struct(i.alias("first"), _shortest(F.slice(F.col("w"), i + 1, F.lit(min_words)), min_words).alias("n")))
    back = F.transform("w", lambda _, i: F.struct(i.alias("last"), _shortest(F.reverse(F.slice(
        F.col("w"), F.greatest(i + 2 - min_words, F.lit(1)), F.least(i + 1, F.lit(min_words)))), min_words).alias("n")))
    ends = F.transform(back, lambda s: F.struct((s["last"] - s["n"] + 1).alias("first"), s["n"].alias("n")))
    rows = rows.withColumn("spans", F.array_distinct(F.filter(F.concat(spans, ends), lambda s: s["n"].isNotNull())))

    def key(s: Column) -> Column:
        out = None
        for step in reversed(steps):
            names = F.col(f"names{step}")
            here = F.concat(F.get(names, s["first"]), F.get(names, s["first"] + s["n"] - step))
            out = here if out is None else F.when(s["n"] >= 2 * step, out).otherwise(here)
        return F.unhex(F.md5(F.concat(out, s["n"].cast("string").cast("binary"))))

    runs = rows.select("doc_id", F.explode(F.transform("spans", lambda s: F.struct(
        key(s).alias("key"), s["first"].alias("start"), F.get(F.col("at"), s["first"]).alias("first"), F.get(F.col("at"), s["first"] + s["n"] - 1).alias("last")))).alias("r")).select("doc_id", "r.*")
    place = F.coalesce(F.col("doc_id").cast("decimal(38,0)"), F.expr("cast(9223372036854775808 as decimal(38,0))")) * F.lit(1 << 31) + F.col("first")
    runs = staged(runs.select("doc_id", "first", "last", "key", place.cast("decimal(38,0)").alias("place")), "runs")
    seen = runs.groupBy("key").agg(F.min("place").alias("earliest"), F.count("*").alias("n")).where("n > 1").select("key", "earliest")
    return runs.join(seen, "key").where("place > earliest").select("doc_id", "first", "last")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns of docs, with text rewritten and n_lines, n_removed (long) added.

    Null texts stay null and have no lines; an empty text is one blank line. Rows of one doc_id, or of a null one, are
    documents of their own, in the order of doc_id (null last), then of rows.
    """
    rows, _ = rows_apart(docs)
    out = _without_repeats(rows, min_words).drop("doc_id").withColumnRenamed("_given_id", "doc_id")
    return out.select(*docs.columns, "n_lines", "n_removed")


def _without_repeats(docs: DataFrame, min_words: int) -> DataFrame:
    spans = repeated_runs(docs, min_words)
    order = W.partitionBy("doc_id").orderBy("first", "last")
    reach = F.coalesce(F.max("last").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(-1))
    gaps = spans.withColumn("from", reach + 1).groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("first") > F.col("from"), F.struct("from", F.col("first").alias("to"))))).alias("_gaps"),
        (F.max("last") + 1).alias("_rest"))
    gaps = gaps.select(F.col("doc_id").alias("_doc"), "_gaps", "_rest")
    joined = docs.join(gaps, F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    lines = F.split("text", "\n", -1)
    pieces = F.transform("_gaps", lambda g: F.slice(lines, g["from"] + 1, g["to"] - g["from"]))
    rest = F.slice(lines, F.col("_rest") + 1, F.greatest(F.size(lines) - F.col("_rest"), F.lit(0)))
    kept = F.flatten(F.concat(pieces, F.array(rest)))
    left = F.when(F.col("text").isNotNull() & F.col("_rest").isNotNull(), kept)
    out = joined.withColumns({"n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"), "_kept": left})
    return out.withColumns({
        "n_removed": F.when(F.col("_kept").isNull(), 0).otherwise(F.col("n_lines") - F.size("_kept")).cast("long"),
        "text": F.coalesce(F.array_join("_kept", "\n"), F.col("text"))}).drop("_doc", "_gaps", "_rest", "_kept")


def oracle(min_words: int = MIN_WORDS) -> str:
    """The same over ``documents`` in SQL: every run as its text, the earliest place of equal texts stays."""
    words = "case when trim(line) = '' then 0 else length(trim(line)) - length(replace(trim(line), ' ', '')) + 1 end"
    return f"""
with docs as (select doc_id, coalesce(text, '') as text, text is null as none from documents),
lines as (select doc_id, none, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from docs),
body as (select doc_id, pos, line, w, row_number() over (partition by doc_id order by pos) as p,
                sum(w) over (partition by doc_id order by pos) as c
         from (select *, {words} as w from lines) where w > 0),
bodies as (select doc_id, list(line order by p) as held from body group by doc_id),
runs as (select distinct a.doc_id, a.p as s, b.p as e, a.pos as first, b.pos as last
         from body a join body b on a.doc_id = b.doc_id and b.p between a.p and a.p + {min_words}
         where b.c - a.c + a.w >= {min_words} and (b.c - b.w - a.c + a.w < {min_words} or b.c - a.c < {min_words})),
named as (select runs.*, array_to_string(held[s:e], chr(10)) as key from runs join bodies using (doc_id)),
later as (select * from (select *, row_number() over (partition by key order by doc_id, s) as k from named) where k > 1),
kept as (select l.*, not exists (select 1 from later r where r.doc_id = l.doc_id and l.pos between r.first and r.last) as stays from lines l)
select doc_id, cast(case when bool_or(none) then 0 else count(*) end as bigint) as n_lines, cast(count(*) filter (where not stays) as bigint) as n_removed,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where stays), '')) as kept_sha256
from kept group by doc_id"""
