"""Merges into current tables, as DataFrame views: stored rows without the staged keys, and the staged rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..schemas import ARTICLE_KEY, EVENT_KEY, PAIR_KEY, TREND_KEY


def _replace(current: DataFrame, staged: DataFrame, keys: list[str]) -> DataFrame:
    return current.join(staged, keys, "left_anti").select(*staged.columns).unionByName(staged)


def latest(staged: DataFrame, keys: list[str] = ARTICLE_KEY) -> DataFrame:
    """One row per key: the last ingested, then the last published, then the last title; rows equal in these by their other columns, so that a repeated merge takes the same row."""
    first = ["ingested_at", "published_at", "title"]
    order = [F.desc_nulls_last(c) for c in (*first, *(c for c, t in staged.dtypes if c not in (*first, *keys) and "map<" not in t and "variant" not in t))]
    return staged.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")


def merge_articles(current: DataFrame, staged: DataFrame) -> DataFrame:
    return _replace(current, latest(staged.where("url is not null")), ARTICLE_KEY)


def merge_keywords(current: DataFrame, staged: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = keys or [*ARTICLE_KEY, "keyword"]
    return _replace(current, staged.groupBy(*keys).agg(F.max("keyword_count").alias("keyword_count"), F.max("processed_at").alias("processed_at")), keys)


def merge_sums(current: DataFrame, staged: DataFrame, keys: list[str], value: str, mode: str = "replace", windows: DataFrame | None = None) -> DataFrame:
    """Staged sums replace the stored value; in mode 'recompute' staged holds all rows of its windows, so stored rows of those windows go too.

    `windows` names the recomputed ones, also those of which nothing is left.  In mode 'sums' staged is in addition
    one row a key, and all in `windows`, so that it is neither summed nor looked up again.
    """
    if mode == "sums":
        window = ["provider", "domain", "window_start", "window_end"]
        return current.join(windows.select(*window).distinct(), window, "left_anti").select(*staged.columns).unionByName(staged)
    sums = staged.groupBy(*keys).agg(F.sum(value).alias(value), F.max("processed_at").alias("processed_at"))
    if mode == "recompute":
        window = ["provider", "domain", "window_start", "window_end"]
        current = current.join((staged if windows is None else windows).select(*window).distinct(), window, "left_anti")
    return _replace(current, sums, keys)


def merge_trends(current: DataFrame, staged: DataFrame, mode: str = "recompute", windows: DataFrame | None = None) -> DataFrame:
    return merge_sums(current, staged, TREND_KEY, "keyword_count", mode, windows)


def merge_relations(current: DataFrame, staged: DataFrame, mode: str = "recompute", windows: DataFrame | None = None) -> DataFrame:
    return merge_sums(current, staged, PAIR_KEY, "cooccurrence_count", mode, windows)


def insert_if_absent(current: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows of keys that are not stored; of several rows of a key that with the least values of the other columns."""
    rest = [c for c in current.columns if c not in keys]
    ready = new.where(" and ".join(f"{k} is not null" for k in keys)).groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_rest")).select(*keys, "_rest.*") if rest else new.select(*keys).dropna().distinct()
    return current.unionByName(ready.join(current, keys, "left_anti").select(*current.columns))


def replace_event_range(events: DataFrame, new: DataFrame, since, until, provider: str | None = None, domain: str | None = None, delete_by: str = "window_start") -> DataFrame:
    gone = (F.col(delete_by) >= since) & (F.col(delete_by) < until)
    for name, value in (("provider", provider), ("domain", domain)):
        gone = gone & (F.col(name) == value) if value else gone
    return _replace(events.where(~F.coalesce(gone, F.lit(False))), new, EVENT_KEY)


def exclude(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not among the known ones; rows with a null key stay."""
    return df.join(known.select(*keys).distinct(), keys, "left_anti")


def apply_retention(df: DataFrame, time: str, cutoff) -> DataFrame:
    return df.where(F.col(time) >= cutoff)


def dedup_articles(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in a stated order."""
    return df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")
