"""Feed documents, many feeds in one job: whole documents are parsed a document at a time, the rest is native."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import normalize_summary, parse_pub_date, strip_html
from .shared import stored

#: Feeds of this news wire take their title where a summary says nothing, and other names where the catalog has none.
WIRE_PUBLISHERS, WIRE_HOST, WIRE = ("연합뉴스", "yna", "yonhap", "yonhapnews"), "yna.co.kr", ("연합뉴스", "politics", "yonhap_rss")
FEED = ["publisher", "feed_name", "domain", "url"]
_ENTRY = pa.schema([*((c, pa.string()) for c in FEED), ("position", pa.int64()), *((c, pa.string()) for c in ("title", "summary", "link", "published", "error"))])


def _name(element: ET.Element) -> str:
    return element.tag.rpartition("}")[2] if isinstance(element.tag, str) else ""


def _text(entry: ET.Element, *names: str) -> str | None:
    """Text of the first element of one of these local names that has text."""
    return next((e.text.strip() for e in entry.iter() if _name(e) in names and e.text), None)


def _link(entry: ET.Element) -> str:
    """Address or text of the first link that has either, else an identifier that is an address."""
    for e in entry.iter():
        if _name(e) == "link" and (e.get("href") or e.text):
            return (e.get("href") or e.text).strip()
    found = _text(entry, "guid", "id") or ""
    if not found.startswith("http"):
        raise ValueError("an entry has no link")
    return found


def parse_feed(content: bytes) -> list[dict]:
    """Entries of a document: its items, or its entries where it has no item."""
    elements = list(ET.fromstring(content).iter())
    entries = [e for e in elements if _name(e) == "item"] or [e for e in elements if _name(e) == "entry"]
    dates = ("pubDate", "published", "updated", "date")
    texts = ("description", "summary", "content", "encoded")
    return [{"position": i, "title": _text(e, "title"), "summary": _text(e, *texts), "link": _link(e), "published": _text(e, *dates)} for i, e in enumerate(entries)]


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):  # a document may be long: one at a time
            *feed, content = (c[i].as_py() for c in batch.columns)
            head = dict(zip(FEED, feed, strict=True))
            try:
                rows = parse_feed(content or b"")
            except (ET.ParseError, ValueError) as error:
                rows = [{"error": str(error)}]
            yield pa.RecordBatch.from_pylist([head | r for r in rows], schema=_ENTRY)


def feed_key() -> Column:
    return F.concat_ws("::", *(F.coalesce(F.trim(c), F.lit("")) for c in ("publisher", "domain", "feed_name")))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of whole files."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def feed_articles(documents: DataFrame, catalog: DataFrame, checkpoints: DataFrame | None = None, store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(articles, results) of fetched documents (url, content) of the catalog's feeds (publisher, feed_name, domain, url).

    A document that cannot be read, or an entry without link, fails its feed as a whole:
    results (key, provider, domain, query, ok, error) say so, and no article of it is given.
    Articles of a feed with a checkpoint (key, checkpoint) are those published after it;
    of several with one source, domain and address the first is given.
    Parsed entries are stored in `store`, if given, so that articles and results parse documents once.
    """
    feeds = catalog.select(*(F.col(c) for c in FEED[:3]), F.trim("url").alias("url")).join(documents.select(F.trim("url").alias("url"), F.col("content").cast("binary").alias("content")), "url")
    kinds = ", ".join(f"{f.name} {'long' if f.name == 'position' else 'string'}" for f in _ENTRY)
    rows = feeds.select(*FEED, "content").mapInArrow(_parsed, kinds).withColumn("key", feed_key())
    rows = rows if store is None else stored(rows, store)
    wire = F.lower(F.trim("publisher")).isin(*WIRE_PUBLISHERS) | F.coalesce(F.contains("url", F.lit(WIRE_HOST)), F.lit(False))
    given = lambda c, generic, other: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.when(wire, other).otherwise(generic))
    title = F.coalesce(F.nullif(strip_html(F.col("title")), F.lit("")), F.lit("(untitled)"))
    provider = given("publisher", F.try_parse_url("link", F.lit("AUTHORITY")), F.lit(WIRE[0]))
    summary = F.when(wire, F.coalesce(normalize_summary(strip_html(F.col("summary"))), title)).otherwise(strip_html(F.col("summary")))
    entries = rows.where("error is null").select(
        "key", "position", provider.alias("provider"), given("domain", F.lit("general"), F.lit(WIRE[1])).alias("domain"), provider.alias("source"), title.alias("title"), summary.alias("summary"), F.col("link").alias("url"),
        parse_pub_date(F.col("published")).alias("published_at"), given("feed_name", F.lit(""), F.lit(WIRE[2])).alias("_query"),
    )
    if checkpoints is not None:
        entries = entries.join(checkpoints.select("key", F.col("checkpoint").alias("_after")), "key", "left").where("_after is null or published_at > _after").drop("_after")
    first = F.row_number().over(W.partitionBy("key", "source", "domain", "url").orderBy("position"))
    articles = entries.withColumn("_place", first).where("_place = 1 and url <> ''").drop("_place")
    errors = rows.where("error is not null").groupBy(*FEED).agg(F.min("error").alias("error"))
    ran = _with_errors(feeds.select(*FEED).distinct(), errors)
    results = ran.select(feed_key().alias("key"), F.trim("publisher").alias("provider"), F.trim("domain").alias("domain"), F.trim("feed_name").alias("query"), F.col("error").isNull().alias("ok"), "error")
    return articles, results


def _with_errors(feeds: DataFrame, errors: DataFrame) -> DataFrame:
    """Feeds with their error; a catalog column may be null."""
    return feeds.withColumn("error", F.lit(None).cast("string")).unionByName(errors).groupBy(*FEED).agg(F.max("error").alias("error"))
