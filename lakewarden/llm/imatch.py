"""I-Match fingerprints: terms of a chosen band of document frequency, sorted and hashed per lexicon.

The lexicons part all terms among them by the terms' hashes, at several densities: a dense lexicon
tells short texts apart, a sparse one survives large edits of long texts. Document frequencies are
those of all terms, and every term of the band is in one lexicon.

Terms are counted where they are read, so one row per distinct term and task is shuffled. A term below the
band is in hardly any document: its row names them, and each document learns which of its terms
go. Texts move once, to their neighbours in the order of doc_id.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakewarden.llm.order import id_blocks
from lakewarden.llm.rows import rows_apart
from lakewarden.llm.staging import staged, whole_text

SLOTS = 32768
#: (lexicons, slots of each): a lexicon of s slots holds s / SLOTS of all terms.
LEXICONS = ((16, 1775), (64, 64), (32, 8), (16, 1))
COUNT = sum(n for n, _ in LEXICONS)
#: Kept terms have ln(N / df) / ln(N) in this band: not in most documents, nor in hardly any.
BAND = (0.15, 0.95)
NEIGHBOUR_ROWS = 1024
#: A term below the band names its documents in three numbers; up to some 10**12 documents it has no more.
NAMED = 3
NO_HASH, NONE = -1, "-"
BREAKS = r"[\s\p{Punct}]+"


def _hashed_words(words: Column) -> Column:
    return F.array_distinct(F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))


def terms(text: Column) -> Column:
    """Hashes of the distinct lower-case terms between blanks and ASCII punctuation."""
    return _hashed_words(F.split(F.lower(text), BREAKS))


def lexicon_of(term: Column) -> Column:
    """Number of the lexicon that holds a term."""
    slot, out, first, number = F.pmod(term, F.lit(SLOTS)), None, 0, 0
    for n, s in LEXICONS:
        here = (F.floor((slot - first) / s) + number).cast("int")
        first, number = first + n * s, number + n
        out = F.when(slot < first, here) if out is None else out.when(slot < first, here)
    return out


def counted_terms(texts: DataFrame, documents: int) -> DataFrame:
    """(term, place, first, last, third) of all terms of texts (doc_id, text): place is -1 below the band, 1 above it, else 0.

    Counts are exact. A term below the band has at most NAMED documents, which the last three tell (null if fewer).
    """
    low, high = BAND
    if documents ** (1 - high) >= NAMED + 1:
        raise ValueError("terms below the band have more documents than their rows name")
    seen = texts.select("doc_id", F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(
        F.count("*").alias("df"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.bit_xor("doc_id").alias("all"))
    share = F.log(F.lit(float(documents)) / F.col("df")) / math.log(documents) if documents > 1 else F.lit(2.0)
    place = F.when(share > high, -1).when(share < low, 1).otherwise(0)
    third = F.col("first").bitwiseXOR(F.col("last")).bitwiseXOR(F.col("all"))
    return seen.select("term", place.alias("place"), "first", F.when(F.col("df") > 1, F.col("last")).alias("last"), F.when(F.col("df") > 2, third).alias("third"))


def lost_terms(counted: DataFrame) -> DataFrame:
    """(doc_id, lost): the terms of each document that are below the band; documents without any are absent."""
    named = counted.where("place < 0").select("term", F.explode(F.array_compact(F.array("first", "last", "third"))).alias("doc_id"))
    return named.groupBy("doc_id").agg(F.collect_list("term").alias("lost"))


def neighbours(texts: DataFrame, lost: DataFrame) -> DataFrame:
    """Rows (_block, doc_id, name, text, lost, next_name, next_text, next_lost) of texts (doc_id, name, text), doc_ids being unique.

    The next row is the one of the next lower doc_id, after the last the first. Texts are dealt out by blocks of
    the ids; the highest row of a block goes to the block above too, where it is the next of the lowest. Lost
    terms come as rows of their own in front of their document's.
    """
    block, blocks = id_blocks(texts.select("doc_id"), "doc_id", NEIGHBOUR_ROWS)
    tops = texts.select("doc_id", block.alias("_b")).groupBy("_b").agg(F.max("doc_id").alias("doc_id")).select(
        "doc_id", F.pmod(F.col("_b") + 1, F.lit(blocks)).cast("int").alias("_above"))  # one row per block
    rows = texts.select("doc_id", F.lit(1).alias("_kind"), "name", "text", F.lit(None).cast("array<bigint>").alias("lost")).unionAll(
        lost.select("doc_id", F.lit(0), F.lit(None).cast(texts.schema["name"].dataType), F.lit(None).cast("string"), "lost"))
    rows = rows.withColumn("_own", block.cast("int")).join(F.broadcast(tops), "doc_id", "left")
    places = F.array_compact(F.array(F.struct(F.lit(0).alias("copy"), F.col("_own").alias("b")), F.when(F.col("_above").isNotNull(), F.struct(F.lit(1).alias("copy"), F.col("_above").alias("b")))))
    rows = rows.withColumn("_place", F.explode(places)).select(F.col("_place.b").alias("_block"), F.col("_place.copy").alias("_copy"), "doc_id", "_kind", "name", "text", "lost")
    order = W.partitionBy("_block").orderBy("_copy", F.col("doc_id").desc(), "_kind")
    told = F.lag("_kind").over(order) == 0
    behind = F.lead("_kind").over(order) == 0
    next_of = lambda c: F.when(behind, F.lead(c, 2).over(order)).otherwise(F.lead(c).over(order))
    near = rows.withColumns({
        "_lost": F.when(told, F.lag("lost").over(order)), "next_name": next_of("name"), "next_text": next_of("text"),
        "next_lost": F.when(behind, F.lead("lost").over(order))})
    none = F.array().cast("array<bigint>")
    return near.where("_kind = 1 and _copy = 0").select(
        "_block", "doc_id", "name", "text", F.coalesce("_lost", none).alias("lost"), "next_name", "next_text", F.coalesce("next_lost", none).alias("next_lost"))


def hash_of(sorted_terms: Column) -> Column:
    """24 bits of the hash of a lexicon's sorted terms."""
    return F.xxhash64(sorted_terms).bitwiseAND(F.lit((1 << 24) - 1)).cast("int")


def likeness(a: Column, b: Column, whole_a: Column, whole_b: Column) -> Column:
    """Share of equal hashes among the lexicons of which either text has terms; without any, equality of all terms."""
    both = F.zip_with(a, b, lambda x, y: F.when((x == NO_HASH) & (y == NO_HASH), F.lit(None)).otherwise((x == y).cast("int")))
    told = F.filter(both, lambda v: v.isNotNull())
    same = F.aggregate(told, F.lit(0), lambda s, v: s + v)
    return F.when(F.size(told) > 0, same / F.size(told)).otherwise((whole_a == whole_b).cast("double"))


def _hashes(pairs: DataFrame, above: list[int]) -> DataFrame:
    """Rows of neighbours() as (doc_id, base columns, own_fp, edit_fp, seams, touched).

    Only the word at the seam and the last one of an edited text may be words of neither document. They are
    ``seams``, to be looked up among all terms, and ``touched`` has the other edited terms of their lexicons.
    """
    n = F.length("text")
    cut = F.floor(n / 2).cast("int")
    start = F.substring("text", F.lit(1), n - cut)
    edited = F.concat(start, F.substring("next_text", F.lit(1), cut))
    rows = pairs.withColumns({"_edited": edited, "_at": F.size(F.split(F.lower(start), BREAKS)) - 1, "t": terms(F.col("text"))})
    rows = rows.withColumn("_words", F.split(F.lower("_edited"), BREAKS))
    rows = rows.withColumns({"e": _hashed_words(F.col("_words")), "seams": _hashed_words(F.array_compact(F.array(F.get("_words", F.col("_at")), F.element_at("_words", -1))))})
    whole = lambda c: F.xxhash64(F.sort_array(c))
    base = F.struct(F.col("name"), F.col("next_name"), n.cast("long").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"), whole("t").alias("own_all"), whole("e").alias("edit_all"), F.col("seams"))
    common = F.from_json(F.lit(json.dumps(above)), "array<bigint>")
    rows = rows.select(
        "_block", "doc_id", base.alias("base"), F.transform("seams", lexicon_of).alias("_at_lexicons"),
        F.array_except("t", F.concat("lost", common)).alias("own"), F.array_except("e", F.concat("lost", "next_lost", common, "seams")).alias("edit"))

    def flag(found: Column, on: int) -> Column:
        return F.transform(found, lambda h: F.struct(h.alias("term"), F.lit(on).alias("on")))

    flagged = F.concat(flag(F.array_intersect("own", "edit"), 3), flag(F.array_except("own", "edit"), 1), flag(F.array_except("edit", "own"), 2),
                       F.array(F.struct(F.lit(None).cast("bigint").alias("term"), F.lit(0).alias("on"))))  # the row that has the base
    parts = rows.select("_block", "doc_id", "base", "_at_lexicons", F.explode(flagged).alias("f"))
    lexicon = F.when(F.col("f.term").isNull(), -1).otherwise(lexicon_of(F.col("f.term")))
    parts = parts.select("_block", "doc_id", F.when(F.col("f.term").isNull(), F.col("base")).alias("base"), lexicon.alias("lexicon"), F.col("f.term").alias("term"), F.col("f.on").alias("on"),
                         F.array_contains("_at_lexicons", lexicon).alias("touched"))

    def side(bit: int) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("on").bitwiseAND(bit) > 0, F.col("term"))))

    # documents of a block are together already, so neither step shuffles
    by_lexicon = parts.groupBy("_block", "doc_id", "lexicon").agg(side(1).alias("x"), side(2).alias("y"), F.max("touched").alias("touched"), F.max("base").alias("base"))
    hashed = lambda c: F.when(F.size(c) > 0, hash_of(F.col(c))).otherwise(NO_HASH)
    by_lexicon = by_lexicon.select("_block", "doc_id", "lexicon", hashed("x").alias("x"), hashed("y").alias("y"), F.when(F.col("touched"), F.col("y")).alias("edit_terms"), "base")
    whole = by_lexicon.groupBy("_block", "doc_id").agg(
        F.max("base").alias("base"), F.map_from_entries(F.collect_list(F.struct("lexicon", F.struct("x", "y")))).alias("m"),
        F.map_from_entries(F.collect_list(F.when(F.col("edit_terms").isNotNull(), F.struct("lexicon", "edit_terms")))).alias("touched"))
    numbers = F.sequence(F.lit(0), F.lit(COUNT - 1))
    fingerprint = lambda k: F.transform(numbers, lambda i: F.coalesce(F.element_at("m", i)[k], F.lit(NO_HASH)))
    return whole.select("doc_id", "base.*", fingerprint("x").alias("own_fp"), fingerprint("y").alias("edit_fp"), "touched")


def _with_seams(rows: DataFrame, counted: DataFrame) -> DataFrame:
    """The rows with those of their seams that are in the band added to the edited fingerprint."""
    wanted = rows.select("doc_id", F.explode("seams").alias("term")).join(counted.where("place = 0").select("term"), "term")
    wanted = wanted.groupBy("doc_id").agg(F.collect_set("term").alias("found"))
    joined = rows.join(wanted, "doc_id", "left")
    lexicons = F.transform("found", lexicon_of)
    more = lambda i: F.concat(F.coalesce(F.element_at("touched", i), F.array().cast("array<bigint>")), F.filter("found", lambda t: lexicon_of(t) == i))
    told = F.transform("edit_fp", lambda h, i: F.when(F.array_contains(lexicons, i), hash_of(F.sort_array(more(i)))).otherwise(h))
    return joined.withColumn("edit_fp", F.when(F.col("found").isNull(), F.col("edit_fp")).otherwise(told)).drop("found", "seams", "touched")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they and the next document's are.

    The edited text has its last half replaced with the start of the next document in descending
    doc_id. Null texts are empty. Equal texts have equal fingerprints. Rows of one doc_id, or of a null one, each keep
    their row, in an order of their own; a null doc_id is the highest. A single row is its own next.
    An empty frame gives an empty one.
    """
    rows, _ = rows_apart(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    texts = rows.select("doc_id", F.col("_given_id").alias("name"), whole_text().alias("text"))
    documents = texts.count()
    counted = staged(counted_terms(texts, documents), "terms")
    above = [r["term"] for r in counted.where("place > 0").select("term").collect()]  # mean terms of a document x documents ** BAND[0] at most
    told = staged(_hashes(neighbours(texts, staged(lost_terms(counted), "lost")), sorted(above)), "hashes")
    told = staged(_with_seams(told, counted), "fingerprints")
    order = W.partitionBy("_block").orderBy("_copy", F.col("doc_id").desc())
    block, blocks = id_blocks(told.select("doc_id"), "doc_id", NEIGHBOUR_ROWS)
    tops = told.select("doc_id", block.alias("_b")).groupBy("_b").agg(F.max("doc_id").alias("doc_id")).select("doc_id", F.pmod(F.col("_b") + 1, F.lit(blocks)).cast("int").alias("_above"))
    places = F.array_compact(F.array(F.struct(F.lit(0).alias("copy"), block.cast("int").alias("b")), F.when(F.col("_above").isNotNull(), F.struct(F.lit(1).alias("copy"), F.col("_above").alias("b")))))
    dealt = told.join(F.broadcast(tops), "doc_id", "left").withColumn("_place", F.explode(places)).withColumns({"_block": F.col("_place.b"), "_copy": F.col("_place.copy")})
    near = dealt.withColumns({"next_fp": F.lead("own_fp").over(order), "next_all": F.lead("own_all").over(order)}).where("_copy = 0")
    text = lambda fp, all_terms: F.concat_ws(".", F.transform(fp, lambda h: F.when(h == NO_HASH, NONE).otherwise(F.lpad(F.hex(h.cast("long")), 6, "0"))), F.hex(all_terms))
    return near.select(
        F.col("name").alias("doc_id"), "n_chars", "edited_sha256", text("own_fp", "own_all").alias("fingerprint"), text("edit_fp", "edit_all").alias("edited_fingerprint"),
        likeness(F.col("own_fp"), F.col("edit_fp"), F.col("own_all"), F.col("edit_all")).alias("near_edited"),
        likeness(F.col("own_fp"), F.col("next_fp"), F.col("own_all"), F.col("next_all")).alias("near_next"))
