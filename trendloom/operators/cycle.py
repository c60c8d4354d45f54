"""The ingest cycle: one stored, marked frame of a batch of fetched articles, its outputs, and their commit by run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ARTICLE_KEY, METADATA
from ..sources.feeds import feed_articles
from ..sources.shared import Folder, stored
from .ingest import advance_checkpoints, reject_reason, to_messages

OUTPUTS = ("messages", "rejects", "metrics", "checkpoints", "published")


def mark_fetched(fetched: DataFrame, published: DataFrame) -> DataFrame:
    """Adds reason and status of each fetched row: published, duplicate or rejected.

    The first valid row of a key is published.  Rows after it, rows of keys that were
    published before and rows without url are duplicates; others are not valid.
    fetched: article columns, _query, and seq, the place in which rows were fetched, of any type that has an order.
    """
    rows = fetched.withColumn("reason", reject_reason())
    firsts = rows.where("url is not null").groupBy(*ARTICLE_KEY).agg(F.min(F.when(F.col("reason").isNull(), F.col("seq"))).alias("_first"))
    # of all keys ever published only those of the batch go on; the batch is the small side that the scan is filtered by
    known = published.select(*ARTICLE_KEY).join(firsts.select(*ARTICLE_KEY), ARTICLE_KEY, "left_semi").distinct().withColumn("_known", F.lit(True))
    same = F.lit(True)
    keys = firsts.join(known, ARTICLE_KEY, "left").select(*(F.col(k).alias(f"_{k}") for k in ARTICLE_KEY), "_first", "_known")
    for k in ARTICLE_KEY:
        same = same & (F.col(k) == F.col(f"_{k}"))
    rows = rows.join(keys, same, "left")
    late = F.col("url").isNull() | F.coalesce("_known", F.lit(False)) | F.coalesce(F.col("seq") > F.col("_first"), F.lit(False))
    status = F.when(late, "duplicate").when(F.col("reason").isNotNull(), "rejected").otherwise("published")
    return rows.select(*fetched.columns, "reason", status.alias("status"))


@dataclass
class Cycle:
    """Outputs of a run: messages (key, value), rejects (dead letters), metrics, checkpoints, published keys; marked holds every row with its status."""

    marked: DataFrame
    messages: DataFrame
    rejects: DataFrame
    metrics: DataFrame
    checkpoints: DataFrame
    published: DataFrame


def cycle_metrics(results: DataFrame, marked: DataFrame, started: datetime, ended: datetime) -> DataFrame:
    """One row per query that ran: requests, successes, articles, duplicates, published, errors.

    results: key, provider, domain, query, ok; domain and provider are those of the query's first article, if it has any.
    """
    n = lambda status: F.count_if(F.col("status") == status)
    first = lambda c: F.min_by(c, "seq").alias(f"_{c}")
    counts = marked.groupBy("key").agg(F.count("*").alias("article_count"), n("duplicate").alias("duplicate_count"), n("published").alias("publish_count"), first("provider"), first("domain"))
    rows = results.join(counts, "key", "left").fillna(0, ["article_count", "duplicate_count", "publish_count"])
    fallback = F.coalesce(F.nullif("domain", F.lit("")), F.when(F.col("key").contains("::"), F.substring_index("key", "::", 1)), F.lit("ai_tech"))
    ok = F.coalesce("ok", F.lit(False))
    return rows.select(
        F.coalesce("_provider", "provider").alias("provider"), F.coalesce("_domain", fallback).alias("domain"), "query", F.lit(started).alias("window_start"), F.lit(ended).alias("window_end"),
        F.lit(1).cast("long").alias("request_count"), ok.cast("long").alias("success_count"), "article_count", "duplicate_count", "publish_count", (~ok).cast("long").alias("error_count"),
    )


def ingest_cycle(fetched: DataFrame, results: DataFrame, published: DataFrame, checkpoints: DataFrame, started: datetime, ended: datetime | None = None, schema_version: str = "v1", store: str | None = None) -> Cycle:
    """All outputs of one run from one stored frame, so that each reads what the others read.

    fetched: key (of the query), seq and article columns with _query; results: key, provider, domain, query, ok;
    published: keys published before; checkpoints: key, checkpoint.  The checkpoint of a query that ran well moves to
    `started`, that of a failed one stays, and keys that did not run go.
    """
    marked = stored(mark_fetched(fetched, published), store)
    new = marked.where("status = 'published'")
    payload = F.struct(*(c for c in fetched.columns if c not in ("key", "seq")))
    rejects = marked.where("status = 'rejected'").select(F.lit(started).alias("failed_at"), F.concat(F.lit("validation_error: "), "reason").alias("reason"), F.lit(0).cast("long").alias("attempt"), payload.alias("payload"))
    return Cycle(
        marked=marked,
        messages=to_messages(new.drop("key", "seq", "reason", "status"), schema_version),
        rejects=rejects,
        metrics=cycle_metrics(results, marked, started, ended or started),
        checkpoints=advance_checkpoints(checkpoints, results.select("key", F.coalesce("ok", F.lit(False)).alias("ok")), started),
        published=new.select(*ARTICLE_KEY),
    )


class RunLog:
    """Outputs of runs below one folder.  A run counts once its mark is written, after all of its outputs."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def runs(self) -> list[int]:
        return sorted(int(n.partition("=")[2]) for n in Folder(self.spark, f"{self.path}/_runs").names() if n.startswith("run="))

    def commit(self, run: int, cycle: Cycle) -> bool:
        """Writes the outputs of a run; False, and nothing changed, if the run counts already.  What a broken attempt left is overwritten."""
        if run in self.runs():
            return False
        for name in OUTPUTS:
            getattr(cycle, name).write.mode("overwrite").parquet(f"{self.path}/{name}/run={run}")
        self.spark.range(1).select(F.lit(run).alias("run_id"), F.current_timestamp().alias("committed_at")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_runs/run={run}")
        return True

    def read(self, name: str) -> DataFrame | None:
        """Rows of all runs that count, with their run; folders of others are not read."""
        runs = self.runs()
        if not runs:
            return None
        return self.spark.read.option("basePath", f"{self.path}/{name}").parquet(*(f"{self.path}/{name}/run={r}" for r in runs))

    def last(self, name: str) -> DataFrame | None:
        """Rows of the last run that counts: the checkpoints that hold."""
        runs = self.runs()
        return self.spark.read.parquet(f"{self.path}/{name}/run={runs[-1]}") if runs else None


def run_cycle(log: RunLog, run: int, fetched: DataFrame, results: DataFrame, started: datetime, ended: datetime | None = None) -> bool:
    """One run upon the outputs of the runs before it; a repeated run changes nothing."""
    if run in log.runs():
        return False
    published, checkpoints = log.read("published"), log.last("checkpoints")
    if published is None:
        published = fetched.select(*ARTICLE_KEY).limit(0)
    if checkpoints is None:
        checkpoints = fetched.sparkSession.createDataFrame([], "key string, checkpoint timestamp_ntz")
    return log.commit(run, ingest_cycle(fetched, results, published, checkpoints, started, ended, store=f"{log.path}/marked/run={run}"))


def run_feeds(log: RunLog, run: int, documents: DataFrame, catalog: DataFrame, started: datetime, ended: datetime | None = None) -> bool:
    """One run over fetched feed documents: articles after each feed's checkpoint of the run before, as `run_cycle` takes them."""
    if run in log.runs():
        return False
    articles, results = feed_articles(documents, catalog, log.last("checkpoints"), f"{log.path}/parsed/run={run}")
    articles, results = stored(articles, f"{log.path}/fetched/run={run}"), stored(results, f"{log.path}/results/run={run}")
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    fetched = articles.select(
        "key", F.struct("key", "position").alias("seq"), "provider", "domain", "source", "title", "summary", "url", iso("published_at").alias("published_at"),
        F.lit(started.strftime("%Y-%m-%dT%H:%M:%SZ")).alias("ingested_at"), F.lit(None).cast(METADATA).alias("metadata"), "_query",
    )
    return run_cycle(log, run, fetched, results, started, ended)
