"""Adapters from star-schema and document tables to the article model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import article_text
from ..schemas import METADATA


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts_of(df: DataFrame, part: int = 4 << 20) -> int:
    """How many parts of so many bytes a table has by Spark's estimate, at least one for each core."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-size // part))


def spread(df: DataFrame, key: str, part: int = 4 << 20) -> DataFrame:
    """Rows dealt by `key` to as many tasks as the table has parts of so many bytes by Spark's estimate, at least to all cores: what a task holds does not grow with the table.

    `key` tells articles apart, so that what is grouped by article next is not dealt again: texts are shuffled, not their words.
    """
    return df.repartition(parts_of(df, part), key)


def _minutes(column: str):
    """Minutes of 30 days from 2024-01-01, in even spread over any number of ids."""
    return F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col(column) * 7919 % 43200).cast("int"))


def articles_from_documents(docs: DataFrame) -> DataFrame:
    out = docs.select(
        F.col("source").alias("provider"), F.col("lang").alias("domain"), F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url"), F.lit("documents").alias("source"),
        F.get(F.split("text", "\n"), F.lit(0)).alias("title"), F.col("text").alias("summary"), _minutes("doc_id").alias("published_at"), (_minutes("doc_id") + F.expr("interval 1 minute")).alias("ingested_at"), "doc_id",
    )
    return spread(out, "url").withColumns({"event_time": F.col("published_at"), "article_text": article_text(F.col("title"), F.col("summary"))})


def articles_from_conversations(rows: DataFrame) -> DataFrame:
    out = rows.select(F.lit("chat").alias("provider"), F.col("role").alias("domain"), F.concat_ws("/", F.lit("conv:/"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("url"), _minutes("conv_id").alias("event_time"), F.col("text").alias("article_text"))
    return spread(out, "url", 256 << 10)  # turns are short and alike, so that few bytes hold many pairs of words


def keyword_stream_from_events(events: DataFrame) -> DataFrame:
    k = F.concat(F.lit("k"), (F.get_json_object("props", "$.k").cast("long") % 10).cast("string"))
    url = F.concat(F.lit("user://"), F.col("user_id").cast("string"), F.lit("/"), F.col("event_id").cast("string"))
    return events.select(F.lit("events").alias("provider"), F.col("event_type").alias("domain"), url.alias("url"), k.alias("keyword"), F.col("ts").cast("timestamp_ntz").alias("event_time"), F.lit(1).cast("long").alias("keyword_count"))


def articles_from_orders(orders: DataFrame) -> DataFrame:
    """Orders as articles of several years: a priority is a domain."""
    return orders.select(
        F.lit("shop").alias("provider"), F.col("o_orderpriority").alias("domain"), F.concat(F.lit("order://"), F.col("o_orderkey").cast("string")).alias("url"), F.col("o_orderdate").cast("timestamp_ntz").alias("event_time"),
        "o_orderkey", "o_custkey", "o_orderstatus",
    )


def keywords_from_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Suppliers of an order's lines as its keywords."""
    # lines are dealt by address, as their article is told by it: they are not dealt again to be counted, joined, ranked or paired
    url = F.concat(F.lit("order://"), F.col("l_orderkey").cast("string")).alias("url")
    counts = lines.select(url, F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("keyword")).repartition("url").groupBy("url", "keyword").agg(F.count("*").alias("keyword_count"))
    return articles_from_orders(orders).join(counts, "url").select("provider", "domain", "url", "event_time", "keyword", "keyword_count", "o_orderstatus")


def fetched_from_lines(lines: DataFrame) -> DataFrame:
    """Lines as fetched articles: lines of an order share its address; untaxed ones have no title, those without discount no address."""
    return lines.select(
        F.concat_ws("::", "l_returnflag", "l_linestatus").alias("key"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("seq"), F.lit("shop").alias("provider"), F.col("l_returnflag").alias("domain"), F.lit("lines").alias("source"),
        F.when(F.col("l_tax") > 0, F.concat(F.lit("part "), F.col("l_partkey").cast("string"))).otherwise(" ").alias("title"), F.lit(None).cast("string").alias("summary"),
        F.when(F.col("l_discount") > 0, F.concat(F.lit("order://"), F.col("l_orderkey").cast("string"))).alias("url"), F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at"), F.lit("2002-01-01T00:00:00Z").alias("ingested_at"),
        F.lit(None).cast(METADATA).alias("metadata"), F.col("l_linestatus").alias("_query"),
    )


def feeds_from_orders(customers: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, catalog): a feed document per customer with orders, its entries by number; customers of one segment have Atom feeds."""
    at = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    link, atom = F.concat(F.lit("http://order/"), F.col("o_orderkey").cast("string")), F.col("c_mktsegment") == "BUILDING"
    item = F.concat(F.lit("<item><title>&lt;b&gt;"), "o_orderpriority", F.lit("&lt;/b&gt;</title><description>order "), F.col("o_orderkey").cast("string"), F.lit("</description><link>"), link, F.lit("</link><pubDate>"), at, F.lit("</pubDate></item>"))
    entry = F.concat(F.lit("<a:entry><a:title>"), "o_orderpriority", F.lit('</a:title><a:link href="'), link, F.lit('"/><a:updated>'), at, F.lit("</a:updated></a:entry>"))
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "c_name", "c_mktsegment", "o_orderkey", F.when(atom, entry).otherwise(item).alias("entry"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "entry"))), lambda x: x["entry"]), "")
    url = F.concat(F.lit("http://customer/"), F.col("c_custkey").cast("string"))
    documents = rows.groupBy("c_custkey", "c_mktsegment").agg(body.alias("body"))
    content = F.when(atom, F.concat(F.lit('<a:feed xmlns:a="http://www.w3.org/2005/Atom">'), "body", F.lit("</a:feed>"))).otherwise(F.concat(F.lit("<rss><channel>"), "body", F.lit("</channel></rss>")))
    catalog = customers.select(F.col("c_name").alias("publisher"), F.lit("orders").alias("feed_name"), F.lower("c_mktsegment").alias("domain"), url.alias("url"))
    return documents.select(url.alias("url"), content.alias("content")), catalog
