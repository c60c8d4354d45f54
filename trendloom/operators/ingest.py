"""The ingest cycle: defaults, validation, checkpoints, messages, metrics and dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import article_text, normalize_summary, parse_pub_date, strip_html
from ..schemas import ARTICLE_KEY, MESSAGE

REQUIRED = ("provider", "domain", "title", "url", "ingested_at")


def parse_articles(raw: DataFrame, value: str = "value") -> DataFrame:
    return raw.select(F.from_json(F.col(value).cast("string"), MESSAGE).alias("m")).select("m.*")


def fill_defaults(df: DataFrame, provider: str = "naver", domain: str = "ai_tech") -> DataFrame:
    filled = {"provider": F.coalesce("provider", F.lit(provider)), "domain": F.coalesce("domain", F.lit(domain)), "query": F.col("metadata.query"), "summary": F.coalesce("summary", "description", "content")}
    return df.withColumns(filled).drop("description", "content")


def with_event_time(df: DataFrame) -> DataFrame:
    times = {c: F.try_to_timestamp(F.col(c)) for c in ("published_at", "ingested_at")}
    df = df.withColumns(times)
    return df.withColumns({"event_time": F.col("published_at"), "article_text": article_text(F.col("title"), F.col("summary"))})


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["event_time", "url"])


def reject_reason() -> Column:
    """Why an article is not valid, or null."""
    blank = lambda c: F.nullif(F.trim(c), F.lit("")).isNull()
    reason = F.lit(None).cast("string")
    for c in reversed(REQUIRED):
        reason = F.when(blank(F.col(c)), f"missing {c}").otherwise(reason)
    known = F.col("metadata").isNotNull()
    for c in ("source", "version"):
        reason = F.when(reason.isNull() & known & blank(F.col(f"metadata.{c}")), f"missing metadata.{c}").otherwise(reason)
    return reason


def validate_articles(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    marked = df.withColumn("reason", reject_reason())
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def normalize_search_items(items: DataFrame, query: str) -> DataFrame:
    url = F.coalesce(F.nullif("originallink", F.lit("")), "link")
    return items.select(F.lit("naver").alias("provider"), strip_html(F.col("title")).alias("title"), normalize_summary(strip_html(F.col("description"))).alias("summary"), url.alias("url"), parse_pub_date(F.col("pubDate")).alias("published_at"), F.col(query).alias("_query"))


def filter_incremental(df: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Rows newer than their key's checkpoint; an unknown key takes the latest checkpoint, rows without a date go."""
    latest = checkpoints.groupBy(F.lit(1).alias("_one")).agg(F.max("checkpoint").alias("_latest"))
    rows = df.join(checkpoints, "key", "left").withColumn("_one", F.lit(1)).join(F.broadcast(latest), "_one", "left")  # one row
    limit = F.coalesce("checkpoint", "_latest")
    return rows.where(limit.isNull() | (F.col("published_at") > limit)).drop("checkpoint", "_one", "_latest")


def articles_ingested_between(articles: DataFrame, since, until) -> DataFrame:
    """Title, summary and domain of articles ingested in [since, until), for mining."""
    return articles.where((F.col("ingested_at") >= since) & (F.col("ingested_at") < until))


def advance_checkpoints(checkpoints: DataFrame, results: DataFrame, run_at) -> DataFrame:
    """Keys that ran well move to run_at, failed ones keep theirs, keys not run are removed."""
    rows = results.join(checkpoints, "key", "left")
    return rows.select("key", F.when(F.col("ok"), F.lit(run_at)).otherwise(F.col("checkpoint")).alias("checkpoint")).where("checkpoint is not null")


def to_messages(articles: DataFrame, schema_version: str = "v1") -> DataFrame:
    """Key (url, else provider) and JSON value with metadata; nulls are kept."""
    meta = F.struct(F.col("provider").alias("source"), F.lit(schema_version).alias("version"), F.col("_query").alias("query"))
    body = F.struct(*(c for c in articles.columns if c not in ("_query", "metadata")), meta.alias("metadata"))
    return articles.select(F.coalesce("url", "provider").alias("key"), F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def collection_metrics(batch: DataFrame) -> DataFrame:
    """One row per query: requests, successes, articles, duplicates, published, errors."""
    fresh = F.col("ok") & ~F.col("duplicate")
    return batch.groupBy("provider", "domain", "query").agg(
        F.min("ts").alias("window_start"), F.max("ts").alias("window_end"), F.count("*").alias("request_count"), F.count_if("ok").alias("success_count"), F.count_if(fresh).alias("article_count"),
        F.count_if(F.col("ok") & F.col("duplicate")).alias("duplicate_count"), F.count_if(fresh).alias("publish_count"), F.count_if(~F.col("ok")).alias("error_count"),
    )


def metrics_summary(metrics: DataFrame, as_of=None, hours: int | None = None, provider: str | None = None) -> DataFrame:
    if as_of is not None and hours:
        metrics = metrics.where(F.col("window_end") >= F.lit(as_of) - F.make_dt_interval(hours=F.lit(hours)))
    if provider:
        metrics = metrics.where(F.col("provider") == provider)
    counts = [c for c in metrics.columns if c.endswith("_count")]
    return metrics.groupBy("provider", "domain", "query").agg(*(F.sum(c).alias(c) for c in counts))


def route_dead_letters(records: DataFrame, published: DataFrame, max_attempts: int = 3) -> DataFrame:
    """Adds outcome and next attempt; records: payload, attempt, delivered (null: not tried)."""
    flat = records.select("*", "payload.*")
    keys = published.select(*ARTICLE_KEY, F.lit(True).alias("_published")).distinct()
    rows = flat.withColumn("_reason", reject_reason()).join(keys, ARTICLE_KEY, "left")
    attempt = F.coalesce("attempt", F.lit(0)) + 1
    outcome = F.when(F.col("payload").isNull() | F.col("_reason").isNotNull(), "permanent").when(attempt > max_attempts, "permanent").when(F.col("_published"), "skipped").when(F.coalesce("delivered", F.lit(True)), "replayed").otherwise("retry")
    return rows.select(*records.columns, outcome.alias("outcome"), F.when(outcome == "retry", attempt).otherwise(F.col("attempt")).alias("next_attempt"))


def outcome_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("outcome").agg(F.count("*").alias("records"))


def backlog_profile(records: DataFrame, warn_from: int = 100) -> DataFrame:
    out = records.groupBy("reason", "attempt").agg(F.count("*").alias("records"))
    return out.withColumn("warn", F.col("records") >= warn_from)
