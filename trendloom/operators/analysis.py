"""A hook for analysers: functions from a text to token spans, applied to Arrow batches.

Spans feed keywords (`keywords.tokenize(..., spans=True)`), which join compounds only
across tokens that touch, and mining (`span_rows`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_for_mining, clean_text

#: Makes an analyser, once a task: it may load a model.  An analyser gives (token, start, end) in order; start and end count characters from 0.
Factory = Callable[[], Callable[[str], list[tuple[str, int, int]]]]
SPANS = T.ArrayType(T.StructType([T.StructField("token", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_SPAN = pa.struct([("token", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def analyse(rows: DataFrame, factory: Factory, text: Column) -> DataFrame:
    """Adds `cleaned`, the text that was analysed (null: empty), and `spans`.  Other columns pass through unread."""
    rows = rows.withColumn("cleaned", F.coalesce(text, F.lit("")))
    schema = T.StructType([*rows.schema.fields, T.StructField("spans", SPANS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = factory()
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            found = [[{"token": t, "start": a, "end": b} for t, a, b in find(x.as_py())] for x in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(_SPAN))], [*batch.schema.names, "spans"])

    return rows.mapInArrow(run, schema)


def analyse_articles(articles: DataFrame, factory: Factory, text: str = "article_text") -> DataFrame:
    return analyse(articles, factory, clean_text(F.coalesce(F.col(text), F.lit(""))))


def span_rows(analysed: DataFrame, doc_key: Column, pattern: str = "^[가-힣]+$") -> DataFrame:
    """(doc_key, domain, pos, token, start, end) of tokens that match, for `mine_compounds`."""
    kept = F.filter("spans", lambda s: s["token"].rlike(pattern))
    rows = analysed.select(doc_key.alias("doc_key"), "domain", F.posexplode(kept).alias("pos", "s"))
    return rows.select("doc_key", "domain", "pos", "s.token", "s.start", "s.end")


def mining_spans(articles: DataFrame, factory: Factory, text: str = "article_text") -> DataFrame:
    """Spans of the Hangul of articles; a domain that is blank counts as 'all'."""
    domain = F.coalesce(F.nullif(F.trim("domain"), F.lit("")), F.lit("all"))
    rows = articles.select("provider", domain.alias("domain"), "url", F.col(text).alias("text"))
    analysed = analyse(rows, factory, clean_for_mining(F.coalesce("text", F.lit(""))))
    return span_rows(analysed, F.concat_ws("::", "provider", "domain", "url"))
