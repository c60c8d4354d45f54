"""Registered queries over tables that are stored first: ingest runs, month tables, feeds, analysers, backfills, candidates, the stream."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..operators import analysis, backfill, cycle, dictionary, events, keywords, merge
from ..schemas import ARTICLE_KEY, EVENT_KEY, PAIR_KEY, TREND_KEY
from ..sources import feeds
from ..sources.dictionaries import VersionedDictionaries, publish_dictionary, with_versions
from ..sources.fixtures import articles_from_documents, articles_from_orders, feeds_from_orders, fetched_from_lines, keywords_from_lines, table
from ..sources.months import MonthTable
from ..sources.readers import read_article_stream
from ..sources.shared import new_folder, stored
from ..streaming import job
from . import serving

STARTED, DAY = datetime(2002, 1, 1), "1 day"
NOW = datetime(2024, 2, 1)


def text_times(df: DataFrame) -> DataFrame:
    """Times as text, so that no client's time zone matters."""
    return df.select(*(F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if t.startswith("timestamp") else F.col(c) for c, t in df.dtypes))


# --- the ingest cycle


def _fetched(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = fetched_from_lines(table(s, d, "lineitem"))
    keys = rows.select("key").distinct()
    return rows, keys.select("key", F.lit("shop").alias("provider"), F.lit(None).cast("string").alias("domain"), F.substring_index("key", "::", -1).alias("query"), (F.col("key") != "R::F").alias("ok"))


def _cycle(s: SparkSession, d: str) -> cycle.Cycle:
    rows, results = _fetched(s, d)
    known = table(s, d, "lineitem").join(table(s, d, "orders").where("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey"))
    known = known.select(F.lit("shop").alias("provider"), F.col("l_returnflag").alias("domain"), F.concat(F.lit("order://"), F.col("l_orderkey").cast("string")).alias("url")).distinct()
    points = s.createDataFrame([("R::F", datetime(2001, 1, 1)), ("A::F", datetime(2001, 1, 1)), ("gone::X", datetime(2001, 1, 1))], "key string, checkpoint timestamp_ntz")
    return cycle.ingest_cycle(rows, results, known, points, STARTED, STARTED + timedelta(minutes=5))


def q_ingest_messages(s, d):
    value = lambda path: F.get_json_object("value", path)
    return _cycle(s, d).messages.select("key", value("$.title").alias("title"), value("$.metadata.version").alias("version"), value("$.metadata.query").alias("query"))


def q_ingest_rejects(s, d):
    return _cycle(s, d).rejects.select("reason", "attempt", F.col("payload.url").alias("url"), F.col("payload.published_at").alias("published_at"))


def q_ingest_status(s, d):
    return _cycle(s, d).marked.select("key", "seq", "status")


def q_ingest_metrics(s, d):
    return text_times(_cycle(s, d).metrics)


def q_ingest_checkpoints(s, d):
    return text_times(_cycle(s, d).checkpoints.withColumn("checkpoint", F.col("checkpoint").cast("timestamp_ntz")))


def q_ingest_runs(s, d):
    """The same batch fetched twice, the second run committed twice."""
    log = cycle.RunLog(s, new_folder(s, "runs"))
    rows, results = _fetched(s, d)
    for run in (1, 2, 2):
        cycle.run_cycle(log, run, rows, results, STARTED + timedelta(hours=run))
    return log.read("metrics").groupBy(F.col("run").cast("long").alias("run")).agg(*(F.sum(c).alias(c) for c in ("request_count", "article_count", "duplicate_count", "publish_count")))


FETCHED = """WITH fetched AS (SELECT l_returnflag || '::' || l_linestatus AS key, l_orderkey * 100 + l_linenumber AS seq, l_returnflag AS domain, l_linestatus AS query, CASE WHEN l_tax > 0 THEN 'part ' || l_partkey ELSE ' ' END AS title,
  CASE WHEN l_discount > 0 THEN 'order://' || l_orderkey END AS url, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS published_at FROM lineitem),
known AS (SELECT DISTINCT l_returnflag AS domain, 'order://' || l_orderkey AS url FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'),
firsts AS (SELECT domain, url, min(seq) FILTER (WHERE title <> ' ') AS first FROM fetched WHERE url IS NOT NULL GROUP BY domain, url),
marked AS (SELECT f.*, CASE WHEN f.url IS NULL OR k.url IS NOT NULL OR coalesce(seq > first, false) THEN 'duplicate' WHEN title = ' ' THEN 'rejected' ELSE 'published' END AS status
  FROM fetched f LEFT JOIN known k ON k.domain = f.domain AND k.url = f.url LEFT JOIN firsts t ON t.domain = f.domain AND t.url = f.url)"""
SQL = {
    "ingest_messages": f"{FETCHED} SELECT url AS key, title, 'v1' AS version, query FROM marked WHERE status = 'published'",
    "ingest_rejects": f"{FETCHED} SELECT 'validation_error: missing title' AS reason, CAST(0 AS BIGINT) AS attempt, url, published_at FROM marked WHERE status = 'rejected'",
    "ingest_status": f"{FETCHED} SELECT key, seq, status FROM marked",
    "ingest_metrics": f"""{FETCHED} SELECT 'shop' AS provider, domain, query, '2002-01-01 00:00:00' AS window_start, '2002-01-01 00:05:00' AS window_end, CAST(1 AS BIGINT) AS request_count, CAST(key <> 'R::F' AS BIGINT) AS success_count, count(*) AS article_count,
      count(*) FILTER (WHERE status = 'duplicate') AS duplicate_count, count(*) FILTER (WHERE status = 'published') AS publish_count, CAST(key = 'R::F' AS BIGINT) AS error_count FROM marked GROUP BY key, domain, query""",
    "ingest_checkpoints": f"{FETCHED} SELECT DISTINCT key, CASE WHEN key = 'R::F' THEN '2001-01-01 00:00:00' ELSE '2002-01-01 00:00:00' END AS checkpoint FROM fetched",
    "ingest_runs": f"""{FETCHED}, runs AS (SELECT 1 AS run, key, url IS NULL OR coalesce(seq > first, false) AS again, title <> ' ' AS good FROM fetched f LEFT JOIN firsts t USING (domain, url)
      UNION ALL SELECT 2, key, url IS NULL OR first IS NOT NULL, title <> ' ' FROM fetched f LEFT JOIN firsts t USING (domain, url))
      SELECT CAST(run AS BIGINT) AS run, count(DISTINCT key) AS request_count, count(*) AS article_count, count(*) FILTER (WHERE again) AS duplicate_count, count(*) FILTER (WHERE NOT again AND good) AS publish_count FROM runs GROUP BY run""",
}


# --- month tables


def _log(s: SparkSession, d: str) -> DataFrame:
    return keywords_from_lines(table(s, d, "orders"), table(s, d, "lineitem"))


def _at(s: SparkSession, name: str, keys: list[str], time: str) -> MonthTable:
    return MonthTable(s, new_folder(s, name), keys, time)


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("processed_at", F.col("window_end"))


def _order_trends(s: SparkSession, d: str) -> MonthTable:
    out = _at(s, "trends", TREND_KEY, "window_start")
    out.append(_stamped(keywords.keyword_trends(_log(s, d), DAY)))
    return out


def _shown(trends: DataFrame) -> DataFrame:
    return text_times(trends.select("provider", "domain", "window_start", "keyword", "keyword_count"))


def _late(s: SparkSession, d: str, log: DataFrame, make, keys: list[str], merge_them) -> DataFrame:
    """First the orders that are not pending, then all windows in which a pending one lies; what `make` gives is one row a key, and so neither summed nor looked up by the merge."""
    log = stored(log)
    out = _at(s, "windows", keys, "window_start")
    out.append(_stamped(make(log.where("o_orderstatus <> 'P'"))))
    windows = stored(keywords.windowed_articles(log.where("o_orderstatus = 'P'"), DAY))
    out.merge(_stamped(make(log)).join(windows, ["provider", "domain", "window_start"], "left_semi"), lambda c, staged: merge_them(c, staged, "sums", windows))
    return out.read()


def q_merge_trends_months(s, d):
    return _shown(_late(s, d, _log(s, d), lambda log: keywords.keyword_trends(log, DAY), TREND_KEY, merge.merge_trends))


def q_merge_relations_months(s, d):
    pairs = keywords.keyword_pairs(keywords.representative_keywords(_log(s, d)), also=("o_orderstatus",))
    out = _late(s, d, pairs, lambda log: keywords.keyword_relations(log, DAY), PAIR_KEY, merge.merge_relations)
    return text_times(out.select("provider", "domain", "window_start", "keyword_a", "keyword_b", "cooccurrence_count"))


def q_merge_articles_months(s, d):
    """Each customer's last order as an article, which moves to its month; later loads replace earlier ones."""
    rows = articles_from_orders(table(s, d, "orders"))
    rows = rows.select("provider", F.lit("all").alias("domain"), F.concat(F.lit("customer://"), F.col("o_custkey").cast("string")).alias("url"), F.col("url").alias("title"), F.col("event_time").alias("published_at"), F.col("event_time").alias("ingested_at"), "o_orderstatus")
    out = _at(s, "articles", ARTICLE_KEY, "published_at")
    out.append(merge.latest(rows.where("o_orderstatus = 'F'")))
    out.merge(rows.where("o_orderstatus <> 'F'"), merge.merge_articles)
    return text_times(out.read().select("url", "title", "published_at"))


def q_merge_keywords_months(s, d):
    """Keywords of finished orders, then those of all others counted by quantity; the larger count of a key stays within a load, the later load in all."""
    log = _log(s, d).withColumn("processed_at", F.col("event_time"))
    keys = ["provider", "domain", "event_time", "keyword"]
    out = _at(s, "keywords", keys, "event_time")
    for status in ("F", "O", "P"):
        out.merge(log.where(F.col("o_orderstatus") == status), lambda c, staged: merge.merge_keywords(c, staged, keys))
    return text_times(out.read().drop("processed_at"))


def q_replace_events_months(s, d):
    found = events.detect_events(keywords.keyword_trends(_log(s, d), "7 days")).drop("prev_mentions")
    out = _at(s, "events", EVENT_KEY, "window_start")
    out.append(found)
    since, until = datetime(1997, 3, 20), datetime(1997, 6, 10)
    new = found.where(serving.in_range("window_start", since, until) & (F.col("domain") == "1-URGENT")).withColumn("event_score", F.lit(1))
    months = [f"1997-{m:02d}" for m in range(3, 7)]
    out.merge(new, lambda c, staged: merge.replace_event_range(c, staged, since, until), also=months)
    return text_times(out.read().select("domain", "keyword", "window_start", "current_mentions", "event_score"))


def q_drop_months(s, d):
    out = _order_trends(s, d)
    out.drop_months(datetime(1998, 3, 15), 6)
    return _shown(out.read())


def q_retention_months(s, d):
    out = _order_trends(s, d)
    out.retain("window_end", datetime(1998, 3, 10, 12), timedelta(days=1))
    return _shown(out.read())


def q_pruned_windows(s, d):
    return _shown(_order_trends(s, d).read(datetime(1997, 11, 20), datetime(1998, 1, 3)))


def _purged(s: SparkSession) -> DataFrame:
    return s.createDataFrame([("s1", "1-URGENT"), ("s2", "all")], "word string, domain string")


def q_purge_months(s, d):
    out = _order_trends(s, d)
    dictionary.purge_months({"trends": out}, _purged(s))
    return _shown(out.read())


def q_purge_by_domain(s, d):
    log = _log(s, d)
    pairs = keywords.keyword_pairs(keywords.representative_keywords(log))
    return dictionary.purge_words({"keywords": log, "relations": pairs, "stg_keywords": log}, _purged(s))[1]


def q_table_growth(s, d):
    log = _log(s, d)
    return serving.growth_counts({"keywords": (log, "event_time"), "trends": (keywords.keyword_trends(log, DAY), "window_start")}, datetime(2001, 7, 20), 24 * 30)


LOG = """WITH log AS (SELECT 'shop' AS provider, o_orderpriority AS domain, 'order://' || o_orderkey AS url, o_orderdate AS event_time, 's' || l_suppkey AS keyword, o_orderstatus, count(*) AS keyword_count FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY domain, url ORDER BY keyword_count DESC, keyword) AS rank FROM log),
pairs AS (SELECT a.domain, a.event_time, least(a.keyword, b.keyword) AS keyword_a, greatest(a.keyword, b.keyword) AS keyword_b FROM ranked a JOIN ranked b ON a.url = b.url AND a.rank < b.rank WHERE b.rank <= 4)"""
_DAYS = "strftime(date_trunc('day', event_time), '%Y-%m-%d %H:%M:%S')"
_TRENDS = f"{LOG} SELECT provider, domain, {_DAYS} AS window_start, keyword, CAST(sum(keyword_count) AS BIGINT) AS keyword_count FROM log WHERE {{0}} GROUP BY ALL"
_WEEK = "time_bucket(INTERVAL 7 days, event_time, TIMESTAMP '1970-01-01')"
SQL |= {
    "merge_trends_months": _TRENDS.format("true"),
    "merge_relations_months": f"{LOG} SELECT 'shop' AS provider, domain, {_DAYS} AS window_start, keyword_a, keyword_b, count(*) AS cooccurrence_count FROM pairs GROUP BY ALL",
    "merge_articles_months": """SELECT 'customer://' || o_custkey AS url, 'order://' || o_orderkey AS title, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS published_at FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus = 'F', o_orderdate DESC, 'order://' || o_orderkey DESC) = 1""",
    "merge_keywords_months": f"""{LOG}, loads AS (SELECT provider, domain, event_time, keyword, o_orderstatus, max(keyword_count) AS keyword_count FROM log GROUP BY ALL)
      SELECT provider, domain, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, keyword, keyword_count FROM loads QUALIFY row_number() OVER (PARTITION BY domain, event_time, keyword ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END) = 1""",
    "replace_events_months": f"""{LOG}, weeks AS (SELECT domain, keyword, {_WEEK} AS w, CAST(sum(keyword_count) AS BIGINT) AS n FROM log GROUP BY ALL),
      lagged AS (SELECT *, lag(n, 1, 0) OVER (PARTITION BY domain, keyword ORDER BY w) AS p FROM weeks),
      grown AS (SELECT *, CASE WHEN p <= 0 THEN CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END ELSE CAST(n - p AS DOUBLE) / p END AS growth FROM lagged),
      found AS (SELECT *, n >= 5 AND growth >= 0.4 AS spike FROM grown WHERE n > 0 AND (n >= 5 OR growth >= 0.15))
      SELECT domain, keyword, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, n AS current_mentions,
        CAST(CASE WHEN w >= TIMESTAMP '1997-03-20' AND w < TIMESTAMP '1997-06-10' THEN 1 ELSE least(100, greatest(0, round_even(growth * 45 + sqrt(n) * 6 + CASE WHEN spike THEN 20 ELSE 0 END, 0))) END AS INTEGER) AS event_score
      FROM found WHERE domain = '1-URGENT' OR w < TIMESTAMP '1997-03-20' OR w >= TIMESTAMP '1997-06-10'""",
    "drop_months": _TRENDS.format("event_time >= TIMESTAMP '1997-09-01'"),
    "retention_months": _TRENDS.format("date_trunc('day', event_time) + INTERVAL 1 DAY >= TIMESTAMP '1998-03-10 12:00:00'"),
    "pruned_windows": _TRENDS.format("event_time >= TIMESTAMP '1997-11-20' AND event_time < TIMESTAMP '1998-01-03'"),
    "purge_months": _TRENDS.format("keyword <> 's2' AND NOT (keyword = 's1' AND domain = '1-URGENT')"),
    "purge_by_domain": f"""{LOG} SELECT 'keywords' AS name, count(*) AS removed FROM log WHERE keyword = 's2' OR (keyword = 's1' AND domain = '1-URGENT')
      UNION ALL SELECT 'relations', count(*) FROM pairs WHERE 's2' IN (keyword_a, keyword_b) OR ('s1' IN (keyword_a, keyword_b) AND domain = '1-URGENT') UNION ALL SELECT 'stg_keywords', count(*) FROM log WHERE keyword IN ('s1', 's2')""",
    "table_growth": f"""{LOG} SELECT 'keywords' AS "table", domain, count(*) AS rows FROM log WHERE event_time >= TIMESTAMP '2001-06-20' AND event_time < TIMESTAMP '2001-07-20' GROUP BY domain
      UNION ALL SELECT 'trends', domain, count(DISTINCT (date_trunc('day', event_time), keyword)) FROM log WHERE event_time >= TIMESTAMP '2001-06-20' AND event_time < TIMESTAMP '2001-07-20' GROUP BY domain""",
}


# --- feeds


def q_feed_articles(s, d):
    documents, catalog = feeds_from_orders(table(s, d, "customer"), table(s, d, "orders"))
    points = catalog.where("domain = 'machinery'").select(feeds.feed_key().alias("key"), F.lit(datetime(1998, 1, 1)).cast("timestamp").alias("checkpoint"))
    articles, _ = feeds.feed_articles(documents, catalog, points)
    return text_times(articles.select("key", "position", "provider", "domain", "title", "summary", "url", "published_at"))


def q_feed_results(s, d):
    """Feeds of the customers of one nation are cut short in their documents, and so fail."""
    documents, catalog = feeds_from_orders(table(s, d, "customer"), table(s, d, "orders"))
    broken = table(s, d, "customer").where("c_nationkey = 3").select(F.concat(F.lit("http://customer/"), F.col("c_custkey").cast("string")).alias("url"), F.lit(True).alias("broken"))
    documents = documents.join(broken, "url", "left").select("url", F.when(F.col("broken"), F.expr("substr(content, 1, length(content) - 3)")).otherwise(F.col("content")).alias("content"))
    return feeds.feed_articles(documents, catalog)[1].select("key", "query", "ok")


def q_feed_runs(s, d):
    """Two runs over the feeds, before and after the orders of 1998; each publishes what its checkpoints have not seen."""
    log, new_year = cycle.RunLog(s, new_folder(s, "feeds")), datetime(1998, 1, 1)
    for run, orders in ((1, table(s, d, "orders").where(F.col("o_orderdate") < new_year)), (2, table(s, d, "orders"))):
        cycle.run_feeds(log, run, *feeds_from_orders(table(s, d, "customer"), orders), new_year if run == 1 else STARTED)
    value = lambda path: F.get_json_object("value", path)
    return log.read("messages").select(F.col("run").cast("long").alias("run"), "key", value("$.domain").alias("domain"), value("$.published_at").alias("published_at"))


SQL |= {
    "feed_runs": """WITH rows AS (SELECT *, min(o_orderdate) OVER (PARTITION BY o_custkey) < TIMESTAMP '1998-01-01' AS known FROM orders JOIN customer ON o_custkey = c_custkey)
      SELECT CAST(CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 1 ELSE 2 END AS BIGINT) AS run, 'http://order/' || o_orderkey AS key, lower(c_mktsegment) AS domain, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS published_at
      FROM rows WHERE o_orderdate < TIMESTAMP '1998-01-01' OR o_orderdate > TIMESTAMP '1998-01-01' OR NOT known""",
    "feed_articles": """SELECT c_name || '::' || lower(c_mktsegment) || '::orders' AS key, place AS position, c_name AS provider, lower(c_mktsegment) AS domain, o_orderpriority AS title, CASE WHEN c_mktsegment <> 'BUILDING' THEN 'order ' || o_orderkey END AS summary,
      'http://order/' || o_orderkey AS url, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS published_at
      FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS place FROM orders JOIN customer ON o_custkey = c_custkey) WHERE c_mktsegment <> 'MACHINERY' OR o_orderdate > TIMESTAMP '1998-01-01'""",
    "feed_results": "SELECT DISTINCT c_name || '::' || lower(c_mktsegment) || '::orders' AS key, 'orders' AS query, c_nationkey <> 3 AS ok FROM customer JOIN orders ON o_custkey = c_custkey",
}


# --- analysers, dictionaries, backfills, the stream


def _docs(s: SparkSession, d: str) -> DataFrame:
    return articles_from_documents(table(s, d, "documents"))


def long_words():
    """An analyser that finds words of eight letters or more."""
    import re

    found = re.compile(r"\S{8,}").finditer
    return lambda text: [(m.group(), m.start(), m.end()) for m in found(text)]


def q_analysed_keywords(s, d):
    """Long words of each article; articles without any take all their words."""
    return text_times(keywords.article_keywords(keywords.tokenize(analysis.analyse_articles(_docs(s, d), long_words), spans=True)))


def q_mined_spans(s, d):
    """Pairs of long words that stand side by side: one blank counts as touching."""
    spans = analysis.span_rows(analysis.analyse_articles(_docs(s, d), long_words), F.col("url"), "^[a-z]+$").withColumn("end", F.col("end") + 1)
    return keywords.mine_compounds(spans, max_parts=2, min_freq=3)


def q_versioned_tokens(s, d):
    """Tokens without the stopwords of the last of two versions."""
    path, known = new_folder(s, "dictionaries"), table(s, d, "benchmark").select(F.explode(F.split(clean_text(F.col("text")), " ")).alias("word"), F.lit("all").alias("domain"))
    for longest in (3, 4):
        publish_dictionary(known.where(f"length(word) between 2 and {longest}"), path, "stopword_dict")
    lists, docs = VersionedDictionaries(s, path), _docs(s, d)
    out = keywords.tokenize(docs, **lists(docs))
    return with_versions(out.select("url", F.size("tokens").cast("long").alias("n_tokens")), lists.versions)


def _filled(s: SparkSession, d: str, dry_run: bool) -> job.CurrentTables:
    """Tables as they stand before a backfill; a dry run reads articles, and no other table."""
    out = job.CurrentTables.at(s, new_folder(s, "current"))
    docs = _docs(s, d)
    out.articles.append(docs.drop("doc_id"))
    if dry_run:
        return out
    out.keywords.append(keywords.article_keywords(keywords.tokenize(docs)).withColumn("processed_at", F.col("event_time")))
    words = out.keywords.read()
    out.trends.append(_stamped(keywords.keyword_trends(words)))
    out.relations.append(_stamped(keywords.keyword_relations(keywords.keyword_pairs(keywords.representative_keywords(words)))))
    return out


def _backfilled(s: SparkSession, d: str, dry_run: bool) -> tuple[job.CurrentTables, DataFrame]:
    compounds = s.createDataFrame([("ofthe", "all")], "word string, domain string")
    tables = _filled(s, d, dry_run)
    tokenizer = lambda hit: keywords.tokenize(hit, compounds=keywords.scoped_words(compounds, hit.select("domain")))
    return tables, backfill.run_backfill(tables.articles, tables.keywords, tables.trends, tables.relations, "ofthe", tokenizer, since=datetime(2024, 1, 10), until=datetime(2024, 1, 20), dry_run=dry_run, processed_at=NOW)


def q_backfill_dry_run(s, d):
    return _backfilled(s, d, True)[1]


def q_backfill_run(s, d):
    tables, _ = _backfilled(s, d, False)
    return text_times(tables.trends.read().drop("window_end", "processed_at"))


def q_backfill_relations(s, d):
    tables, _ = _backfilled(s, d, False)
    return text_times(tables.relations.read().drop("window_end", "processed_at"))


def q_stream_trends(s, d):
    """Documents as messages through the streaming job into month tables."""
    folder = new_folder(s, "messages")
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(c)
    rows = _docs(s, d).select("provider", "domain", "title", "summary", "url", iso("published_at"), iso("ingested_at"))
    rows.select(F.to_json(F.struct("*")).alias("value")).write.option("compression", "gzip").text(folder)
    out = new_folder(s, "stream")
    tables = job.CurrentTables.at(s, f"{out}/current")
    job.start(read_article_stream(s, "text", {"path": folder}), out, f"{out}/checkpoint", {"availableNow": True}, tables=tables).awaitTermination()
    return text_times(tables.trends.read().drop("window_end", "processed_at"))


# --- candidates


def _nouns(s: SparkSession, d: str) -> DataFrame:
    return dictionary.whitespace_spans(_docs(s, d))


def q_mined_candidates(s, d):
    """Mined compounds merged into candidates of an earlier run: words of one language, some decided."""
    mined = stored(keywords.mine_compounds(_nouns(s, d)))
    old = mined.where("domain = 'en'").select("word", "domain", F.lit(1).cast("long").alias("frequency"), F.lit(1).cast("long").alias("doc_count"), F.when(F.col("doc_count") < 3, "rejected").otherwise("needs_review").alias("status"), *(F.lit(datetime(2024, 1, 1)).alias(c) for c in ("first_seen_at", "last_seen_at")))
    return text_times(dictionary.merge_mined(old, mined, NOW))


def _signals(s: SparkSession, d: str) -> DataFrame:
    log = stored(keywords.ranked_keywords(_log(s, d)))  # ranked where lines are counted, not in parts as large as files are read
    trends = keywords.keyword_trends(log, "7 days")
    pairs = keywords.keyword_relations(keywords.keyword_pairs(keywords.representative_keywords(log)), "7 days")
    return stored(dictionary.stopword_signals(trends, log, pairs, 5, datetime(2001, 9, 1), 3650))


def q_recommended_stopwords(s, d):
    """Suppliers as words: those of the first nations are stopwords, those of the next are candidates of an earlier run."""
    signals = _signals(s, d)
    suppliers = table(s, d, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("word"), "s_nationkey")
    numbers = [F.lit(0.0).alias(c) for c in ("score", "domain_breadth", "repetition", "stability", "cooccurrence_breadth")]
    old = suppliers.where("s_nationkey between 5 and 14").select(
        "word", F.lit("all").alias("domain"), F.lit("ko").alias("language"), *numbers, F.lit(False).alias("short_word"), F.lit(0).cast("long").alias("frequency"), F.when(F.col("s_nationkey") < 10, "needs_review").otherwise("rejected").alias("status"),
        *(F.lit(datetime(2001, 1, 1)).alias(c) for c in ("first_seen_at", "last_seen_at")),
    )
    out = dictionary.recommend_stopwords(signals, old, suppliers.where("s_nationkey < 5").select("word"), NOW, threshold=0.2, most=1_000_000)
    return text_times(out.select("word", "status", "frequency", "first_seen_at", "last_seen_at", "change"))


def _customers(s: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("c_mktsegment") == "BUILDING", "pending").when(F.col("c_mktsegment") == "MACHINERY", "approved").otherwise("needs_review")
    return table(s, d, "customer").select(F.col("c_name").alias("word"), F.lower("c_mktsegment").alias("domain"), status.alias("status"), F.col("c_custkey").alias("frequency"), F.lit(None).cast("timestamp_ntz").alias("reviewed_at"), F.lit(None).cast("string").alias("reviewed_by"))


def _evidence(s: SparkSession, d: str) -> DataFrame:
    n = table(s, d, "orders").groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "P").alias("total"))
    return table(s, d, "customer").join(n, F.col("c_custkey") == F.col("o_custkey")).select(F.col("c_name").alias("word"), "total")


def q_simple_review(s, d):
    return text_times(dictionary.simple_review(_customers(s, d), _evidence(s, d), NOW))


def q_simple_review_counts(s, d):
    return dictionary.simple_review_counts(dictionary.simple_review(_customers(s, d), _evidence(s, d), NOW))


_ARTICLES = """articles AS (SELECT source AS provider, lang AS domain, 'doc://' || doc_id AS url, string_split(text, chr(10))[1] AS title, text AS summary, TIMESTAMP '2024-01-01' + to_minutes(CAST(doc_id * 7919 % 43200 AS BIGINT)) AS event_time FROM documents),
texts AS (SELECT *, CASE WHEN summary IS NULL OR trim(summary) = '' OR coalesce(trim(summary) = trim(title), false) THEN title ELSE concat_ws(' ', title, summary) END AS article_text FROM articles),
cleaned AS (SELECT *, trim(regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(article_text, 'http\\S+', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\\[\\+\\d+\\s+chars\\]', ' ', 'g')), '[^a-z가-힣\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS clean FROM texts),
toks AS (SELECT provider, domain, url, event_time, article_text, list_filter(string_split(coalesce(clean, ''), ' '), lambda x: length(x) >= 2 AND regexp_full_match(x, '[가-힣]+|[a-z]+')) AS words FROM cleaned)"""
_HIT = "contains(regexp_replace(article_text, '\\s+', '', 'g'), 'ofthe') AND event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-20' AND len(words) > 0"
_NEW = f"""WITH {_ARTICLES}, again AS (SELECT provider, domain, url, event_time, {_HIT} AS hit, CASE WHEN {_HIT} THEN string_split(trim(replace(' ' || array_to_string(words, '  ') || ' ', ' of  the ', ' ofthe ')), '  ') ELSE words END AS words FROM toks),
kw AS (SELECT provider, domain, url, event_time, hit, keyword, count(*) AS keyword_count FROM (SELECT *, unnest(words) AS keyword FROM again) GROUP BY ALL)"""
_TEN = "strftime(time_bucket(INTERVAL 10 minutes, event_time, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S')"
SQL |= {
    "analysed_keywords": f"""WITH {_ARTICLES}, chosen AS (SELECT *, CASE WHEN list_max(list_transform(words, lambda x: length(x))) >= 8 THEN list_filter(words, lambda x: length(x) >= 8) ELSE words END AS picked FROM toks)
      SELECT provider, domain, url, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, keyword, count(*) AS keyword_count FROM (SELECT *, unnest(picked) AS keyword FROM chosen) GROUP BY ALL""",
    "mined_spans": f"""WITH {_ARTICLES}, longs AS (SELECT domain, url, string_split(coalesce(clean, ''), ' ') AS words FROM cleaned), runs AS (SELECT domain, url, words[i] || words[i + 1] AS word FROM (SELECT *, unnest(range(1, len(words))) AS i FROM longs) WHERE length(words[i]) >= 8 AND length(words[i + 1]) >= 8 AND regexp_full_match(words[i] || words[i + 1], '[a-z]+'))
      SELECT domain, word, count(*) AS frequency, count(DISTINCT url) AS doc_count FROM runs GROUP BY ALL HAVING count(*) >= 3""",
    "versioned_tokens": f"""WITH {_ARTICLES}, stop AS (SELECT DISTINCT word FROM (SELECT unnest(string_split(trim(regexp_replace(regexp_replace(lower(text), '[^a-z가-힣\\s]', ' ', 'g'), '\\s+', ' ', 'g')), ' ')) AS word FROM benchmark) WHERE length(word) BETWEEN 2 AND 4),
      flat AS (SELECT url, unnest(words) AS word FROM toks), kept AS (SELECT url, count(*) AS n FROM flat WHERE word NOT IN (SELECT word FROM stop) GROUP BY url)
      SELECT t.url, coalesce(n, 0) AS n_tokens, CAST(0 AS BIGINT) AS compound_noun_dict_version, CAST(2 AS BIGINT) AS stopword_dict_version FROM toks t LEFT JOIN kept k ON k.url = t.url""",
    "backfill_dry_run": f"{_NEW} SELECT 'dry_run' AS status, (SELECT count(*) FROM toks WHERE event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-20') AS scanned_articles, count(DISTINCT url) AS affected_articles, count(DISTINCT (provider, domain, {_TEN})) AS affected_windows, count(*) AS keyword_rows FROM kw WHERE hit",
    "backfill_run": f"{_NEW} SELECT provider, domain, {_TEN} AS window_start, keyword, CAST(sum(keyword_count) AS BIGINT) AS keyword_count FROM kw GROUP BY ALL",
    "backfill_relations": f"""{_NEW}, ranked AS (SELECT *, row_number() OVER (PARTITION BY provider, domain, url ORDER BY keyword_count DESC, keyword) AS rank FROM kw)
      SELECT a.provider, a.domain, strftime(time_bucket(INTERVAL 10 minutes, a.event_time, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S') AS window_start, least(a.keyword, b.keyword) AS keyword_a, greatest(a.keyword, b.keyword) AS keyword_b, count(*) AS cooccurrence_count
      FROM ranked a JOIN ranked b ON a.url = b.url AND a.rank < b.rank WHERE b.rank <= 4 GROUP BY ALL""",
    "stream_trends": f"WITH {_ARTICLES} SELECT provider, domain, {_TEN} AS window_start, keyword, count(*) AS keyword_count FROM (SELECT *, unnest(words) AS keyword FROM toks) GROUP BY ALL",
    "mined_candidates": f"""WITH {_ARTICLES}, words AS (SELECT url, domain, string_split(clean, ' ') AS w FROM cleaned WHERE clean <> ''),
      runs AS (SELECT url, domain, array_to_string(w[i:i + n], '') AS word FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM words) JOIN (VALUES (1), (2), (3)) v(n) ON i + n <= len(w)),
      mined AS (SELECT domain, word, count(*) AS f, count(DISTINCT url) AS c FROM runs WHERE length(word) >= 4 GROUP BY ALL HAVING count(*) >= 3)
      SELECT word, domain, CASE WHEN domain <> 'en' THEN f WHEN c < 3 THEN 1 ELSE f + 1 END AS frequency, CASE WHEN domain <> 'en' THEN c WHEN c < 3 THEN 1 ELSE c + 1 END AS doc_count, CASE WHEN domain = 'en' AND c < 3 THEN 'rejected' ELSE 'needs_review' END AS status,
        CASE WHEN domain = 'en' THEN '2024-01-01 00:00:00' ELSE '2024-02-01 00:00:00' END AS first_seen_at, CASE WHEN domain = 'en' AND c < 3 THEN '2024-01-01 00:00:00' ELSE '2024-02-01 00:00:00' END AS last_seen_at, CASE WHEN domain <> 'en' THEN 'new' WHEN c >= 3 THEN 'updated' END AS change FROM mined""",
    "recommended_stopwords": f"""{LOG}, weeks AS (SELECT domain, keyword, {_WEEK} AS w, sum(keyword_count) AS n FROM log WHERE {_WEEK} >= TIMESTAMP '2001-09-01' - INTERVAL 3650 DAY AND {_WEEK} < TIMESTAMP '2001-09-01' GROUP BY ALL),
      base AS (SELECT keyword, least(1.0, count(DISTINCT domain) / 5) AS breadth, CAST(sum(n) AS BIGINT) AS frequency FROM (SELECT keyword, domain, sum(n) AS n FROM weeks GROUP BY ALL HAVING sum(n) >= 10) GROUP BY keyword),
      spoken AS (SELECT keyword, least(1.0, avg(keyword_count) / 5) AS repetition FROM log GROUP BY keyword), steady AS (SELECT keyword, coalesce(greatest(0.0, least(1.0, 1 - stddev_samp(n) / avg(n))), 0.0) AS stability FROM weeks GROUP BY keyword),
      near AS (SELECT keyword, least(1.0, count(DISTINCT partner) / 50) AS partners FROM (SELECT keyword_a AS keyword, keyword_b AS partner FROM pairs UNION SELECT keyword_b, keyword_a FROM pairs) GROUP BY keyword),
      scored AS (SELECT b.keyword AS word, frequency, round(breadth * 0.30 + coalesce(repetition, 0) * 0.20 + coalesce(stability, 0) * 0.25 + coalesce(partners, 0) * 0.15 + CAST(length(b.keyword) <= 2 AS INTEGER) * 0.10, 4) AS score FROM base b LEFT JOIN spoken USING (keyword) LEFT JOIN steady USING (keyword) LEFT JOIN near USING (keyword)),
      suppliers AS (SELECT 's' || s_suppkey AS word, s_nationkey FROM supplier), old AS (SELECT word, CASE WHEN s_nationkey < 10 THEN 'needs_review' ELSE 'rejected' END AS status FROM suppliers WHERE s_nationkey BETWEEN 5 AND 14),
      found AS (SELECT * FROM scored WHERE score >= 0.2 AND word NOT IN (SELECT word FROM suppliers WHERE s_nationkey < 5) AND word NOT IN (SELECT word FROM old WHERE status = 'rejected'))
      SELECT coalesce(o.word, f.word) AS word, coalesce(status, 'needs_review') AS status, CASE WHEN f.word IS NULL THEN 0 ELSE frequency END AS frequency, CASE WHEN o.word IS NULL THEN '2024-02-01 00:00:00' ELSE '2001-01-01 00:00:00' END AS first_seen_at,
        CASE WHEN f.word IS NULL THEN '2001-01-01 00:00:00' ELSE '2024-02-01 00:00:00' END AS last_seen_at, CASE WHEN o.word IS NULL THEN 'new' WHEN f.word IS NOT NULL THEN 'updated' END AS change FROM old o FULL JOIN found f ON f.word = o.word""",
}
_REVIEW = """WITH n AS (SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'P') AS total FROM orders GROUP BY 1),
c AS (SELECT c_name AS word, lower(c_mktsegment) AS domain, CASE c_mktsegment WHEN 'BUILDING' THEN 'pending' WHEN 'MACHINERY' THEN 'approved' ELSE 'needs_review' END AS status, c_custkey AS frequency FROM customer),
looked AS (SELECT c.word, coalesce(total, 0) > 0 AS ok FROM c LEFT JOIN n ON o_custkey = frequency WHERE status <> 'approved' ORDER BY frequency DESC LIMIT 200)"""
SQL |= {
    "simple_review": f"""{_REVIEW} SELECT c.word, domain, CASE WHEN ok THEN 'approved' WHEN ok IS NOT NULL AND status = 'pending' THEN 'needs_review' ELSE status END AS status, frequency, CASE WHEN ok THEN '2024-02-01 00:00:00' END AS reviewed_at, CASE WHEN ok THEN 'auto-approver' END AS reviewed_by,
      CASE WHEN ok THEN 'auto_approved' WHEN NOT ok THEN 'needs_review' END AS outcome FROM c LEFT JOIN looked ON looked.word = c.word""",
    "simple_review_counts": f"{_REVIEW} SELECT count(*) AS total, count(*) FILTER (WHERE ok) AS auto_approved, count(*) FILTER (WHERE NOT ok) AS needs_review FROM looked",
}
QUERIES = {k[2:]: v for k, v in list(globals().items()) if k.startswith("q_")}
