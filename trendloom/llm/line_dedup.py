"""Line deduplication by a deletion-neighbourhood join; native expressions only.

A line is a text between line feeds, without white space at its ends.  It goes if
an equal line stands earlier in the corpus, by doc_id then place, or a line within
one edit (insertion, deletion or substitution of a character) first stands
earlier; lines are judged on the input, not on what is left.  Lines of fewer than
`min_chars` characters have an edit bound of 0, blank lines always stay.

Equal lines are found first, by a 128-bit hash.  Two lines within one edit agree
in the first or the last half of the shorter one, so lines whose halves no other
line has cannot have a neighbour.  The rest emit the deletion variants outside the
shared half as hashed keys: lines within a substitution share a variant and its position, lines within an
insertion share a variant of one with the other as a whole.  Minima of the first
places per key, never pairs, find for each line the earliest neighbour; the edit
distance to it is then verified on the texts.  Each step is stored, and what it was
made of removed, so the disk holds the rows of one step, not of all.  Joins are dealt
out by hint: both sides grow with the corpus, and Spark's estimate of rows that an
explode made is so low that it would broadcast them.

Defined cases: null and empty texts stay as they are; repeated rows of one doc_id
are one document; ties in doc_id and place are equal lines; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns_free, discard, stored

MIN_CHARS = 16


def _lines(docs: DataFrame, text: str) -> DataFrame:
    parts = docs.where(F.col(text).isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split(F.col(text).cast("string"), "\n")).alias("at", "line"))
    return parts.withColumn("line", _stripped(F.col("line"))).where("line <> ''")


def _stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\x0b\x0c"))


def _halves(line: Column, n: Column) -> Column:
    """Keys of the halves that a neighbour has: as the shorter (m = n) or the longer line (m = n - 1) of a pair."""

    def half(m: Column, side: int) -> Column:
        h = F.floor(m / 2).cast("int")
        part = F.substring(line, F.lit(1), h) if side == 0 else F.substring(line, n - h + 1, h)
        return F.xxhash64(F.lit(side), m, part)

    return F.array(half(n, 0), half(n, 1), half(n - 1, 0), half(n - 1, 1))


def _variants(line: Column, n: Column, head: Column, tail: Column) -> Column:
    """(key, kind): the line itself, and the line without character i, alone and with i; past a shared head or before a shared tail only."""
    h = F.floor((n - 1) / 2).cast("int")

    def keys(i: Column) -> Column:
        variant = F.concat(F.substring(line, F.lit(1), i - 1), F.substring(line, i + 1, n))
        return F.flatten(F.transform(F.array(F.xxhash64(F.lit(0), variant)), lambda k: F.array(F.struct(k.alias("key"), F.lit("part").alias("kind")), F.struct(F.xxhash64(i, k).alias("key"), F.lit("same place").alias("kind")))))

    places = F.sequence(F.when(tail, F.lit(1)).otherwise(h + 1), F.when(head, n).otherwise(n - h))
    return F.concat(F.array(F.struct(F.xxhash64(F.lit(0), line).alias("key"), F.lit("whole").alias("kind"))), F.flatten(F.transform(places, keys)))


def repeated_lines(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, gone): numbers of the lines to remove, from 0, of each document that loses some."""
    lines = _lines(docs, text)
    n = F.char_length("line")
    halves = F.when(n >= min_chars, _halves(F.col("line"), n)).otherwise(F.array().cast("array<bigint>"))
    lines = lines.select("doc_id", "at", F.xxhash64("line").alias("h0"), F.xxhash64(F.lit(7), "line").alias("h1"), halves.alias("halves"))
    lines = stored(lines, "lines")
    distinct = lines.groupBy("h0", "h1").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("n"), F.first("halves").alias("halves"))
    distinct = stored(distinct, "distinct")
    keys = distinct.select("h0", "h1", F.posexplode("halves").alias("nth", "half"))
    shared = keys.groupBy("half").agg(F.min("h0").alias("low"), F.max("h0").alias("high"), F.min("h1").alias("low1"), F.max("h1").alias("high1")).where("low <> high or low1 <> high1").select("half")
    sides = keys.join(shared.hint("merge"), "half", "left_semi").groupBy("h0", "h1").agg(F.max(F.col("nth") % 2 == 0).alias("head"), F.max(F.col("nth") % 2 == 1).alias("tail"))
    near = sides.join(distinct.hint("merge"), ["h0", "h1"]).groupBy(F.col("first.doc_id").alias("doc_id")).agg(F.collect_set(F.struct("first.at", "head", "tail")).alias("places"))
    near = stored(near, "near")
    # texts of the lines that may have neighbours, read at their first places
    texts = docs.where(F.col(text).isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).join(near.hint("shuffle_hash"), "doc_id")
    texts = texts.select("doc_id", "places", F.split("text", "\n").alias("parts")).select("doc_id", F.explode(F.transform("places", lambda p: F.struct(p["at"].alias("at"), p["head"].alias("head"), p["tail"].alias("tail"), _stripped(F.get("parts", p["at"])).alias("line")))).alias("x"))
    texts = stored(texts.select(F.struct("doc_id", F.col("x.at").alias("at")).alias("first"), "x.line", "x.head", "x.tail").where(F.char_length("line") >= min_chars).distinct(), "texts")
    discard(near)
    found = texts.select("first", F.explode(_variants(F.col("line"), F.char_length("line"), F.col("head"), F.col("tail"))).alias("v")).select("first", "v.key", "v.kind")
    groups = found.groupBy("key").agg(
        F.min(F.when(F.col("kind") == "whole", F.col("first"))).alias("whole"), F.min(F.when(F.col("kind") == "part", F.col("first"))).alias("part"), F.min(F.when(F.col("kind") == "same place", F.col("first"))).alias("same")
    )
    source = F.when(F.col("kind") == "whole", F.col("part")).when(F.col("kind") == "part", F.col("whole")).otherwise(F.col("same"))
    pairs = found.join(groups.hint("merge"), "key").select("first", source.alias("source")).where("source < first").groupBy("first").agg(F.min("source").alias("source"))
    pairs = stored(pairs, "pairs")
    known = texts.select(F.col("first").alias("source"), F.col("line").alias("earlier"))
    edited = pairs.join(texts.select("first", "line").hint("merge"), "first").join(known.hint("merge"), "source").where((F.levenshtein("line", "earlier", 1) >= 0)).select("first", F.lit(True).alias("edited"))
    gone = distinct.join(edited.hint("merge"), "first", "left").where("n > 1 or edited").select("h0", "h1", "first", "edited")
    hits = lines.select("doc_id", "at", "h0", "h1").join(gone.hint("merge"), ["h0", "h1"]).where("edited or first <> struct(doc_id, at)")
    out = stored(hits.groupBy("doc_id").agg(F.collect_set("at").alias("gone")), "gone")
    discard(lines, distinct, texts, pairs)
    return out


def remove_repeated_lines(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """docs with `text` without repeated lines; all columns stay.  The number of lines removed is in n_gone, unless docs has such a column."""
    of, lost = columns_free(docs, "_gone_of", "_gone")
    gone = repeated_lines(docs, text, min_chars).select(F.col("doc_id").alias(of), F.col("gone").alias(lost))
    kept = F.array_join(F.filter(F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains(lost, i)), "\n")
    out = docs.join(gone.hint("shuffle_hash"), F.col("doc_id").cast("long") == F.col(of), "left")
    columns = [F.when(F.col(lost).isNull(), F.col(c)).otherwise(kept).alias(c) if c == text else F.col(c) for c in docs.columns]
    extra = [] if "n_gone" in map(str.lower, docs.columns) else [F.coalesce(F.size(lost), F.lit(0)).alias("n_gone")]
    return out.select(*columns, *extra)
