"""Spike events, heat maps and their listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import event_score, is_spike, safe_growth


def _scored(df: DataFrame, current: str = "current_mentions", previous: str = "prev_mentions") -> DataFrame:
    df = df.withColumn("growth", safe_growth(F.col(current), F.col(previous)))
    return df.withColumns({"is_spike": is_spike(F.col(current), F.col("growth")), "event_score": event_score(F.col(current), F.col("growth"))})


def event_rows(df: DataFrame, min_mentions: int = 5, min_growth: float = 0.15) -> DataFrame:
    return df.where((F.col("current_mentions") > 0) & (F.col("is_spike") | (F.col("current_mentions") >= min_mentions) | (F.col("growth") >= min_growth)))


def detect_events(trends: DataFrame, since=None, until=None, warmup: bool = True) -> DataFrame:
    """Events of windows in [since, until); previous is the keyword's last existing window, also before since when warmup."""
    inside = F.lit(True)
    if since is not None:
        inside = inside & (F.col("window_start") >= since)
    if until is not None:
        inside = inside & (F.col("window_start") < until)
    rows = trends if warmup else trends.where(inside)
    w = W.partitionBy("provider", "domain", "keyword").orderBy("window_start")
    rows = rows.select("provider", "domain", "keyword", "window_start", "window_end", F.col("keyword_count").alias("current_mentions"), F.lag("keyword_count", 1, 0).over(w).alias("prev_mentions"))
    return event_rows(_scored(rows.where(inside))).withColumn("event_time", F.col("window_end"))


def list_events(events: DataFrame, since=None, until=None, provider: str | None = None, domain: str | None = None, limit: int = 200) -> DataFrame:
    for test in ([F.col("event_time") >= since] if since is not None else []) + ([F.col("event_time") < until] if until is not None else []):
        events = events.where(test)
    for name, value in (("provider", provider), ("domain", domain)):
        events = events.where(F.col(name) == value) if value else events
    return events.orderBy(F.desc("event_time"), F.desc("event_score"), "keyword", "provider", "domain").limit(limit)


def spike_table(events: DataFrame, by: str = "event_score", k: int = 12) -> DataFrame:
    return events.where("is_spike").orderBy(F.desc(by), F.desc("current_mentions"), "keyword", "domain", "window_start").limit(k)


def heatmap_events(series: DataFrame, spine: DataFrame, min_mentions: int = 5, min_growth: float = 0.15) -> DataFrame:
    """Events over dense buckets: series (keyword, bucket, mentions), spine (bucket) of all buckets from 0."""
    keywords = series.groupBy("keyword").agg(F.lit(1).alias("_one"))
    dense = keywords.join(F.broadcast(spine.select("bucket", F.lit(1).alias("_one"))), "_one").drop("_one")  # a bounded list of buckets
    dense = dense.join(series, ["keyword", "bucket"], "left").withColumn("current_mentions", F.coalesce("mentions", F.lit(0)))
    w = W.partitionBy("keyword").orderBy("bucket")
    dense = dense.withColumn("prev_mentions", F.lag("current_mentions", 1, 0).over(w))
    return event_rows(_scored(dense), min_mentions, min_growth).select("keyword", "bucket", "current_mentions", "prev_mentions", "growth", "is_spike", "event_score")


def heatmap_matrix(events: DataFrame, n_buckets: int, falloff: float = 0.45) -> DataFrame:
    """Largest intensity of each cell: growth from 0.12 to 1 in the event's bucket, less beside it."""
    value = F.least(F.lit(1.0), F.greatest(F.lit(0.12), F.col("growth")))
    cells = events.select("keyword", "bucket", value.alias("value"), F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("by"))
    cells = cells.select("keyword", (F.col("bucket") + F.col("by")).alias("bucket"), F.when(F.col("by") == 0, F.col("value")).otherwise(F.col("value") * falloff).alias("value"))
    return cells.where((F.col("bucket") >= 0) & (F.col("bucket") < n_buckets)).groupBy("keyword", "bucket").agg(F.max("value").alias("value"))


def heatmap_keywords(ranked: DataFrame, k: int = 8) -> DataFrame:
    """The first k spikes by rank, or the first k keywords where there is no spike."""
    any_spike = F.max(F.col("is_spike").cast("int")).over(W.partitionBy(F.lit(1)))
    top = ranked.orderBy(F.desc("is_spike"), "rank").limit(k)  # bounded before the window
    return top.withColumn("_any", any_spike).where("is_spike or _any = 0").drop("_any")

