"""Declared schemas of messages and tables; sources never infer."""

from pyspark.sql import types as T


def _struct(names: str, kind: T.DataType) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names.split()]


METADATA = T.StructType(_struct("source version query", T.StringType()))
MESSAGE = T.StructType([*_struct("provider domain source title summary url published_at ingested_at", T.StringType()), T.StructField("metadata", METADATA), *_struct("description content", T.StringType())])
RAW_ARTICLE = T.StructType([*MESSAGE.fields, *_struct("_query", T.StringType())])
SEARCH_ITEM = T.StructType(_struct("title originallink link description pubDate", T.StringType()))
FEED_ITEM = T.StructType(_struct("title description summary content encoded link guid id pubDate published updated date", T.StringType()))
FEED_CATALOG = T.StructType(_struct("publisher feed_name domain url is_active", T.StringType()))
DEAD_LETTER = T.StructType([*_struct("failed_at reason", T.StringType()), T.StructField("attempt", T.LongType()), T.StructField("payload", RAW_ARTICLE), *_struct("last_retry_at permanent_fail_at replayed_at error _corrupt_record", T.StringType())])

ARTICLE_KEY = ["provider", "domain", "url"]
KEYWORD_KEY = ["article_provider", "article_domain", "article_url", "keyword"]
TREND_KEY = ["provider", "domain", "window_start", "window_end", "keyword"]
PAIR_KEY = ["provider", "domain", "window_start", "window_end", "keyword_a", "keyword_b"]
EVENT_KEY = ["provider", "domain", "keyword", "window_start"]
