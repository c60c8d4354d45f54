"""Serving queries: KPIs, top and related keywords, buckets, series, shares and article lists."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import event_score, is_spike, safe_growth
from ..schemas import ARTICLE_KEY


#: Bucket minutes and number of buckets of the ranges on offer; longest hours of a window and its bucket minutes.
PRESETS = {"10m": (1, 10), "30m": (3, 10), "1h": (5, 12), "6h": (30, 12), "12h": (60, 12), "1d": (120, 12)}
AUTO_BUCKETS = ((6, 5), (48, 15), (168, 60))


def in_range(time: str | Column, start, end) -> Column:
    time = F.col(time) if isinstance(time, str) else time
    return (time >= start) & (time < end)


def previous_range(start, end):
    return start - (end - start), start


def filter_provider(df: DataFrame, source: str | None) -> DataFrame:
    return df if not source or source in ("all", "global") else df.where(F.col("provider") == source)


def filter_domain(df: DataFrame, catalog: DataFrame, domain: str | None) -> DataFrame:
    """Rows of a domain, or of all domains of a group; an unknown id stands for itself."""
    if not domain or domain == "all":
        return df
    wanted = catalog.where((F.col("domain_id") == domain) | (F.col("group_id") == domain)).select(F.col("domain_id").alias("domain"))
    return df.join(wanted.distinct(), "domain", "left_semi").unionByName(df.where(F.col("domain") == domain).join(wanted.where(F.col("domain") == domain), "domain", "left_anti"))


def kpi_articles(articles: DataFrame, start, end) -> DataFrame:
    """Articles in the range and in the one before; the last update of all time."""
    time = F.coalesce("published_at", "ingested_at")
    return articles.agg(F.count_if(in_range(time, start, end)).alias("current_articles"), F.count_if(in_range(time, *previous_range(start, end))).alias("previous_articles"), F.max(time).alias("last_update"))


def kpi_distinct(trends: DataFrame, events: DataFrame, start, end) -> DataFrame:
    words = trends.where(in_range("window_start", start, end)).select(F.lit("unique_keywords").alias("name"), "keyword")
    spikes = events.where(in_range("event_time", start, end) & F.col("is_spike")).select(F.lit("spike_keywords").alias("name"), "keyword")
    both = words.union(spikes).distinct()
    return both.agg(F.count_if(F.col("name") == "unique_keywords").alias("unique_keywords"), F.count_if(F.col("name") == "spike_keywords").alias("spike_keywords"))


def mention_totals(trends: DataFrame, start, end) -> DataFrame:
    """Mentions of each keyword now and in the range before, one aggregation."""
    low, _ = previous_range(start, end)
    now = in_range("window_start", start, end)
    out = trends.where(in_range("window_start", low, end)).groupBy("keyword")
    out = out.agg(F.sum(F.when(now, F.col("keyword_count")).otherwise(0)).alias("mentions"), F.sum(F.when(~now, F.col("keyword_count")).otherwise(0)).alias("previous_mentions"))
    return out.where("mentions > 0")


def article_counts(keywords: DataFrame, start, end) -> DataFrame:
    return keywords.where(in_range("event_time", start, end)).groupBy("keyword").agg(F.countDistinct(*ARTICLE_KEY).alias("article_count"))


def top_keywords(trends: DataFrame, keywords: DataFrame, start, end, k: int = 20, text: str | None = None) -> DataFrame:
    """The k most mentioned keywords with growth, score and distinct articles; only they meet the article counts."""
    totals = mention_totals(search_keywords(trends, text) if text else trends, start, end)
    top = totals.orderBy(F.desc("mentions"), "keyword").limit(k)
    counts = keywords.join(top.select("keyword"), "keyword", "left_semi")
    out = top.join(article_counts(counts, start, end), "keyword", "left").fillna(0, ["article_count"])
    out = out.withColumn("growth", safe_growth(F.col("mentions"), F.col("previous_mentions")))
    return out.withColumns({"is_spike": is_spike(F.col("mentions"), F.col("growth")), "event_score": event_score(F.col("mentions"), F.col("growth"))})


def search_keywords(df: DataFrame, text: str, column: str = "keyword") -> DataFrame:
    escaped = text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return df.where(F.col(column).ilike(f"%{escaped}%"))


def rank_keywords(df: DataFrame, by: str = "mentions") -> DataFrame:
    """By mentions or growth, largest first; missing growth counts as 0, ties go by mentions, then keyword."""
    first = F.coalesce("growth", F.lit(0.0)) if by == "growth" else F.col("mentions")
    return df.orderBy(F.desc(first), F.desc("mentions"), "keyword")


def ordered_catalog(catalog: DataFrame) -> DataFrame:
    """Active domains by group, place and id."""
    return catalog.where("is_active").orderBy("group_sort_order", "sort_order", "domain_id")


def order_themes(themes: DataFrame) -> DataFrame:
    return themes.orderBy(F.desc("mentions"), "label")


def lookup(df: DataFrame, text: str = "", domain: str | None = None, status: str | None = None, active: bool | None = None) -> DataFrame:
    """Dictionary or query rows by a part of the word, domain, status and activity; what is not asked for does not filter."""
    df = search_keywords(df, text, "word") if text else df
    for name, value in (("domain", domain if domain != "all" else None), ("status", status), ("is_active", active)):
        df = df.where(F.col(name) == value) if value is not None and value != "" else df
    return df


def query_keywords_labelled(queries: DataFrame, catalog: DataFrame, provider: str) -> DataFrame:
    """All queries of a provider with the label of their domain, in catalog order."""
    labels = catalog.select("domain_id", F.col("label").alias("domain_label"), F.col("sort_order").alias("_place"))
    return queries.where(F.col("provider") == provider).join(labels, "domain_id").orderBy("_place", "sort_order", "query").drop("_place")


def attach_keywords(articles: DataFrame, arrays: DataFrame, word: str | None = None) -> DataFrame:
    """Articles with their keywords, most frequent first, and whether `word` is one of them; articles without keywords have an empty list."""
    out = articles.join(arrays, ARTICLE_KEY, "left").withColumn("keywords", F.coalesce("keywords", F.array().cast("array<string>")))
    return out.withColumn("keyword_match", F.array_contains("keywords", word).cast("int") if word else F.lit(0))


def preset_range(as_of, preset: str) -> tuple:
    """(start, end, bucket minutes) of a range on offer, which ends at as_of."""
    width, buckets = PRESETS[preset]
    return as_of - timedelta(minutes=width * buckets), as_of, width


def auto_bucket(start, end) -> int:
    """Bucket minutes of any other range, by its length."""
    return next((width for hours, width in AUTO_BUCKETS if end - start <= timedelta(hours=hours)), 240)


def both_directions(relations: DataFrame, word: str) -> DataFrame:
    a = relations.where(F.col("keyword_a") == word).select(F.col("keyword_b").alias("keyword"), "window_start", "cooccurrence_count")
    return a.unionByName(relations.where(F.col("keyword_b") == word).select(F.col("keyword_a").alias("keyword"), "window_start", "cooccurrence_count"))


def related_keywords(relations: DataFrame, word: str, start, end, k: int = 20) -> DataFrame:
    both = both_directions(relations, word).where(in_range("window_start", start, end))
    top = both.groupBy("keyword").agg(F.sum("cooccurrence_count").alias("weight")).orderBy(F.desc("weight"), "keyword").limit(k)
    return normalize_weight(top, "weight")


def normalize_weight(df: DataFrame, column: str, digits: int = 4) -> DataFrame:
    """Share of the largest value; df is a bounded list."""
    return df.withColumn("share", F.round(F.col(column) / F.max(column).over(W.partitionBy(F.lit(1))), digits))


def theme_distribution(trends: DataFrame, catalog: DataFrame, word: str, start, end) -> DataFrame:
    """Mentions of a keyword per catalog domain and the share of mentions in all domains."""
    found = trends.where(in_range("window_start", start, end) & (F.col("keyword") == word)).groupBy("domain").agg(F.sum("keyword_count").alias("mentions"))
    total = found.groupBy(F.lit(1).alias("_one")).agg(F.sum("mentions").alias("total"))
    items = catalog.select(F.col("domain_id").alias("domain"), "label", F.lit(1).alias("_one")).join(found, "domain", "left").join(F.broadcast(total), "_one", "left").drop("_one")
    share = F.when(F.col("total") > 0, F.coalesce("mentions", F.lit(0)) / F.col("total")).otherwise(0.0)
    return items.select("domain", "label", F.coalesce("mentions", F.lit(0)).alias("mentions"), share.alias("share"))


def _bucket(time: Column, start, width_minutes: int) -> Column:
    """Start of the bucket aligned to start."""
    width = width_minutes * 60_000_000
    origin = F.unix_micros(F.lit(start).cast("timestamp"))
    return F.timestamp_micros(origin + F.floor((F.unix_micros(time.cast("timestamp")) - origin) / width) * width)


def spine(spark, start, end, width_minutes: int) -> DataFrame:
    n = -(-int((end - start).total_seconds()) // (width_minutes * 60))
    return spark.range(n).select((F.lit(start).cast("timestamp") + F.make_dt_interval(mins=(F.col("id") * width_minutes).cast("int"))).alias("bucket_start"))


def article_buckets(articles: DataFrame, start, end, width_minutes: int) -> DataFrame:
    """Articles of every bucket from start, zeros included, and the last update in it."""
    time = F.coalesce("published_at", "ingested_at")
    counted = articles.where(in_range(time, start, end)).groupBy(_bucket(time, start, width_minutes).alias("bucket_start")).agg(F.count("*").alias("articles"), F.max(time).alias("last_update"))
    return spine(articles.sparkSession, start, end, width_minutes).join(counted, "bucket_start", "left").fillna(0, ["articles"])


def keyword_buckets(keywords: DataFrame, words: list[str] | None, start, end, width_minutes: int) -> DataFrame:
    rows = keywords.where(in_range("event_time", start, end))
    rows = rows.where(F.col("keyword").isin(words)) if words is not None else rows
    return rows.groupBy("keyword", _bucket(F.col("event_time"), start, width_minutes).alias("bucket_start")).agg(F.sum("keyword_count").alias("mentions"), F.countDistinct(*ARTICLE_KEY).alias("articles"))


def trend_series(trends: DataFrame, words: list[str], start, end, width_minutes: int, mode: str = "sum") -> DataFrame:
    """Dense series of at most five keywords; mode 'last' keeps a bucket's last window instead of the sum."""
    if len(words) > 5:
        raise ValueError("at most five keywords")
    rows = trends.where(in_range("window_start", start, end) & F.col("keyword").isin(words)).withColumn("bucket_start", _bucket(F.col("window_start"), start, width_minutes))
    value = F.sum("keyword_count") if mode == "sum" else F.max_by("keyword_count", "window_start")
    points = rows.groupBy("keyword", "bucket_start").agg(value.alias("mentions"))
    names = trends.sparkSession.createDataFrame([(w,) for w in words], "keyword string")
    dense = spine(trends.sparkSession, start, end, width_minutes).select("bucket_start", F.explode(F.array(*map(F.lit, words))).alias("keyword")) if words else names.withColumn("bucket_start", F.lit(None).cast("timestamp"))
    return dense.join(points, ["keyword", "bucket_start"], "left").fillna(0, ["mentions"])


def trend_window_series(keywords: DataFrame, articles: DataFrame, words: list[str], start, end, width_minutes: int) -> DataFrame:
    """Dense series of mentions by publication time of the keywords' articles."""
    times = articles.where(in_range("published_at", start, end)).select(*ARTICLE_KEY, F.col("published_at").alias("_at"))
    rows = keywords.where(F.col("keyword").isin(words)).join(times, ARTICLE_KEY).select("keyword", "keyword_count", F.col("_at").alias("window_start"))
    return trend_series(rows, words, start, end, width_minutes)


def overview_candidates(trends: DataFrame, start, end, limit: int) -> DataFrame:
    return mention_totals(trends, start, end).orderBy(F.desc("mentions"), "keyword").limit(max(4 * limit, 80)).select("keyword")


def overview_keywords(trends: DataFrame, keywords: DataFrame, start, end, width_minutes: int, limit: int = 20) -> DataFrame:
    """Keywords re-derived from buckets of the candidates: now, before, growth and score."""
    low, _ = previous_range(start, end)
    some = keywords.join(overview_candidates(trends, start, end, limit), "keyword", "left_semi")
    buckets = keyword_buckets(some, None, low, end, width_minutes)
    now = in_range("bucket_start", F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
    out = buckets.groupBy("keyword").agg(F.sum(F.when(now, F.col("mentions")).otherwise(0)).alias("mentions"), F.sum(F.when(~now, F.col("mentions")).otherwise(0)).alias("previous_mentions"), F.sum(F.when(now, F.col("articles")).otherwise(0)).alias("article_count"))
    out = out.where("mentions > 0").withColumn("growth", safe_growth(F.col("mentions"), F.col("previous_mentions")))
    return out.withColumns({"is_spike": is_spike(F.col("mentions"), F.col("growth")), "event_score": event_score(F.col("mentions"), F.col("growth"))}).orderBy(F.desc("mentions"), "keyword").limit(limit)


def overview_kpis(articles: DataFrame, trends: DataFrame, keywords: DataFrame, start, end, width_minutes: int, limit: int = 20) -> DataFrame:
    low, _ = previous_range(start, end)
    buckets = article_buckets(articles, low, end, width_minutes)
    now = in_range("bucket_start", F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
    counts = buckets.groupBy(F.lit(1).alias("_one")).agg(F.sum(F.when(now, F.col("articles")).otherwise(0)).alias("current_articles"), F.sum(F.when(~now, F.col("articles")).otherwise(0)).alias("previous_articles"), F.max(F.when(now, F.col("last_update"))).alias("last_update"))
    words = overview_keywords(trends, keywords, start, end, width_minutes, max(4 * limit, 80)).groupBy(F.lit(1).alias("_one")).agg(F.count("*").alias("unique_keywords"), F.count_if("is_spike").alias("spike_keywords"))
    return counts.join(F.broadcast(words), "_one", "left").drop("_one").fillna(0, ["unique_keywords", "spike_keywords"])


def articles_with_keyword(articles: DataFrame, keywords: DataFrame, word: str) -> DataFrame:
    return articles.join(keywords.where(F.col("keyword") == word), ARTICLE_KEY, "left_semi")


def article_view(articles: DataFrame) -> DataFrame:
    name = F.coalesce(F.nullif("source", F.lit("")), "provider")
    return articles.withColumns({"id": F.concat_ws(":", *ARTICLE_KEY), "publisher": name, "summary": F.coalesce("summary", F.lit(""))})


def sort_articles(articles: DataFrame, by: str = "latest", k: int = 50, match: Column | None = None) -> DataFrame:
    order = [F.desc_nulls_last("published_at"), "url"]
    return articles.orderBy(*([F.desc(match)] if by == "relevance" and match is not None else []), *order).limit(k)


def page(df: DataFrame, order: list, page: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """(rows of a page from 1, one row with the total of all pages); neither runs before it is asked for."""
    return df.orderBy(*order).offset((page - 1) * limit).limit(limit), df.agg(F.count("*").alias("total"))


def source_options(articles: DataFrame, default: str = "all") -> DataFrame:
    return articles.select(F.trim("provider").alias("provider")).where((F.col("provider") != "") & (F.col("provider") != default)).distinct().orderBy("provider")


def growth_counts(tables: dict[str, tuple[DataFrame, str]], as_of, hours: int = 24) -> DataFrame:
    """Rows per table and domain in the hours before as_of; tables: name -> (rows, time column)."""
    parts = [df.where((F.col(t) >= F.lit(as_of) - F.make_dt_interval(hours=F.lit(hours))) & (F.col(t) < as_of)).groupBy(F.lit(name).alias("table"), "domain").agg(F.count("*").alias("rows")) for name, (df, t) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
