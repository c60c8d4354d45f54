"""Single functions and small operators that other tests do not reach."""

import html
import random
import re
import unicodedata
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from trendloom.functions import text as tx
from trendloom.operators import dictionary, events, ingest, keywords, merge
from trendloom.plans import serving
from trendloom.sources import sinks

T = datetime


def _all(spark, values, column):
    df = spark.createDataFrame(list(enumerate(values)), "i long, t string").repartition(2)
    return [r.x for r in df.select("i", column(F.col("t")).alias("x")).orderBy("i").collect()]


def test_entities_as_html_defines_them(spark):
    rng = random.Random(3)
    parts = ["&amp;", "&lt;", "&notit;", "&not", "&copy", "&#65;", "&#x41;", "&#X1F600;", "&#128512", "&#0;", "&#x80;", "&#150;", "&#xD800;", "&#x110000;", "&#99999999999;", "&#000000000065;", "&#xFFFE;", "&#13;", "&hearts;", "&CounterClockwiseContourIntegral;", "&unknown;", "&", "&#", "&#x", "&;", "& ", "a", "b<", "é", "&ampx", "&AMP", "&ltx;", "&acE;"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 6))) for _ in range(500)] + [f"x&{n}y" for n in list(html.entities.html5)[::4]] + [f"&{n[:-1]}z " for n in list(html.entities.html5)[::5]]
    assert _all(spark, texts, tx.unescaped) == list(map(html.unescape, texts))
    assert _all(spark, [None, "&lt;p class=&quot;x&quot;&gt; &eacute;t&#233; &nbsp;"], tx.strip_html) == [None, "été"]


def test_letters_composed_with_marks_go(spark):
    def clean(text):
        text = re.sub(r"\[\+\d+\s+chars\]", " ", re.sub(r"<[^>]+>", " ", re.sub(r"http\S+", " ", unicodedata.normalize("NFC", text)))).lower()
        return re.sub(r"\s+", " ", re.sub(r"[^a-z가-힣\s]", " ", text)).strip()

    rng = random.Random(2)
    marks = [chr(c) for c in (*range(0x300, 0x330), 0x338, 0x345, 0x591, 0x3099, 0x1DC0, 0x20D0, 0x1D165)]
    texts = ["".join(rng.choice("aeiouAEIOUKscnzt가각ㄱ wK") + "".join(rng.choice(marks) for _ in range(rng.choice([0, 0, 1, 1, 2, 3]))) for _ in range(rng.randint(0, 8))) for _ in range(1000)]
    texts += [unicodedata.normalize("NFD", x) for x in ("café crème", "한국 각", "Übermut İstanbul")]
    assert _all(spark, texts, tx.clean_text) == list(map(clean, texts))


def test_small_expressions(spark):
    row = spark.range(1).select(
        tx.utc_seconds(F.lit("2024-01-01T09:30:00.9+09:00")).alias("utc"),
        tx.minutes_ago(F.lit(T(2024, 1, 1, 0, 0, 30)), F.lit(T(2024, 1, 1, 1))).alias("ago"),
        tx.minutes_ago(F.lit(T(2024, 1, 2)), F.lit(T(2024, 1, 1))).alias("ahead"),
        tx.bucket_index(F.lit(T(2024, 1, 1, 0, 59, 59)), F.lit(T(2024, 1, 1)), 1800).alias("bucket"),
        tx.bucket_index(F.lit(T(2023, 12, 31, 23, 59)), F.lit(T(2024, 1, 1)), 1800).alias("before"),
        tx.composite_key("id", "id").alias("key"),
        tx.frequency_per_doc(F.lit(10), F.lit(3)).alias("per_doc"),
        tx.frequency_per_doc(F.lit(10), F.lit(0)).alias("no_doc"),
        tx.clean_for_mining(F.lit("AI 인공 지능, 2026!  반도체")).alias("mined"),
        tx.publisher(F.lit(" "), F.lit("https://news.example/x")).alias("host"),
        tx.evidence_summary(F.lit('{"total": 3, "match": {"title": "t", "link": "l"}}')).alias("evidence"),
        tx.evidence_summary(F.lit('{"error": "e"}')).alias("failed"),
        *(c.alias(f"{source}{i}") for source in ("naver", "global", "rss") for i, c in enumerate(tx.source_share(source))),
    ).first()
    assert (row.utc, row.ago, row.ahead, row.bucket, row.before, row.key) == ("2024-01-01T00:30:00Z", 59, 0, 1, -1, "0::0")
    assert (row.per_doc, row.no_doc, row.mined, row.host) == (3.33, 10.0, "인공 지능 반도체", "news.example")
    assert tuple(row.evidence) == (3, "t", "l", None)
    assert tuple(row.failed) == (None, None, None, "e")
    assert (row.naver0, row.naver1, row.global0, row.global1, row.rss0, row.rss1) == (1.0, 0.0, 0.5, 0.5, 0.0, 1.0)


def test_search_items_and_checkpoints(spark):
    items = spark.createDataFrame([("<b>T</b> &amp; x", "", "http://n/1", "<b>...</b>", "Mon, 02 Mar 2026 03:00:00 +0900", "q"), ("t", "http://o/1", "http://n/2", "a  b", "bad", "q")], "title string, originallink string, link string, description string, pubDate string, query string")
    got = ingest.normalize_search_items(items, "query").collect()
    assert [(r.provider, r.title, r.summary, r.url, r.published_at and str(r.published_at), r._query) for r in got] == [("naver", "T & x", None, "http://n/1", "2026-03-01 18:00:00", "q"), ("naver", "t", "a b", "http://o/1", None, "q")]
    points = spark.createDataFrame([("a", T(2024, 1, 1)), ("b", T(2024, 1, 1)), ("gone", T(2024, 1, 1))], "key string, checkpoint timestamp_ntz")
    results = spark.createDataFrame([("a", True), ("b", False), ("new", True), ("failed", False)], "key string, ok boolean")
    assert {r.key: r.checkpoint for r in ingest.advance_checkpoints(points, results, T(2024, 2, 1)).collect()} == {"a": T(2024, 2, 1), "b": T(2024, 1, 1), "new": T(2024, 2, 1)}


def test_dead_letter_counts(spark):
    rows = spark.createDataFrame([("r", 0, "retry"), ("r", 0, "retry"), ("s", 1, "skipped")], "reason string, attempt long, outcome string")
    assert {r.outcome: r.records for r in ingest.outcome_counts(rows).collect()} == {"retry": 2, "skipped": 1}
    assert {(r.reason, r.attempt): (r.records, r.warn) for r in ingest.backlog_profile(rows, 2).collect()} == {("r", 0): (2, True), ("s", 1): (1, False)}


def test_versions_and_overview(spark):
    versions = spark.createDataFrame([("stopword_dict", 3), ("compound_noun_dict", 1)], "dict_name string, version long")
    audit = spark.createDataFrame([("a",), ("b",)], "word string")
    assert {r.dict_name: r.version for r in dictionary.next_versions(versions, audit, "stopword_dict").collect()} == {"stopword_dict": 5, "compound_noun_dict": 1}
    assert dictionary.dictionary_overview(words=audit, none=audit.limit(0), versions=versions).first().asDict() == {"words": 2, "none": 0, "versions": 2}


def test_review_decisions_leave_an_audit(spark):
    candidates = spark.createDataFrame([("a", "all", "needs_review", None, None), ("b", "all", "needs_review", None, None), ("c", "all", "approved", None, "x")], "word string, domain string, status string, reviewed_at timestamp_ntz, reviewed_by string")
    decisions = spark.createDataFrame([("a", "all", "approved", "me"), ("b", "all", "rejected", "me"), ("zz", "all", "approved", "me")], "word string, domain string, action string, actor string")
    known = spark.createDataFrame([("c", "all", "file")], "word string, domain string, source string")
    after, words, audit = dictionary.review_decisions(candidates, decisions, known, T(2024, 1, 1))
    assert {r.word: (r.status, r.reviewed_by) for r in after.collect()} == {"a": ("approved", "me"), "b": ("rejected", "me"), "c": ("approved", "x")}
    assert {r.word: r.source for r in words.collect()} == {"a": "auto-approved", "c": "file"}
    assert sorted((r.word, r.action, r.before_status, r.after_status, r.actor, r.acted_at) for r in audit.collect()) == [("a", "approved", "needs_review", "approved", "me", T(2024, 1, 1)), ("b", "rejected", "needs_review", "rejected", "me", T(2024, 1, 1))]


def test_article_lists(spark):
    rows = [("naver", "d", "u1", "S", None, T(2024, 1, 1)), (" rss ", "d", "u2", "", "x", T(2024, 1, 3)), ("all", "d", "u3", None, "y", None), (None, "d", "u4", None, None, T(2024, 1, 2))]
    articles = spark.createDataFrame(rows, "provider string, domain string, url string, source string, summary string, published_at timestamp_ntz")
    assert [r.provider for r in serving.source_options(articles).collect()] == ["naver", "rss"]
    assert [serving.filter_provider(articles, s).count() for s in (None, "all", "global", "naver", "none")] == [4, 4, 4, 1, 0]
    assert {r.url: (r.id, r.publisher, r.summary) for r in serving.article_view(articles).where("provider is not null").collect()} == {"u1": ("naver:d:u1", "S", ""), "u2": (" rss :d:u2", " rss ", "x"), "u3": ("all:d:u3", "all", "y")}
    assert [r.url for r in serving.sort_articles(articles).collect()] == ["u2", "u4", "u1", "u3"]
    assert [r.url for r in serving.sort_articles(articles, "relevance", 2, (F.col("url") == "u1").cast("int")).collect()] == ["u1", "u2"]
    shown, total = serving.page(articles, ["url"], 2, 3)
    assert [r.url for r in shown.collect()] == ["u4"]
    assert total.first().total == 4


def test_growth_counts_and_heat_keywords(spark):
    log = spark.createDataFrame([("d", T(2024, 1, 1)), ("d", T(2024, 1, 1, 23)), ("e", T(2024, 1, 2))], "domain string, at timestamp_ntz")
    got = {(r["table"], r.domain): r.rows for r in serving.growth_counts({"a": (log, "at"), "b": (log.where("domain = 'e'"), "at")}, T(2024, 1, 2, 0, 1)).collect()}
    assert got == {("a", "d"): 1, ("a", "e"): 1, ("b", "e"): 1}
    ranked = spark.createDataFrame([(f"k{i}", i, i in (3, 5)) for i in range(9)], "keyword string, rank int, is_spike boolean")
    assert sorted(r.keyword for r in events.heatmap_keywords(ranked).collect()) == ["k3", "k5"]
    assert sorted(r["rank"] for r in events.heatmap_keywords(ranked.withColumn("is_spike", F.lit(False)), 2).collect()) == [0, 1]


def test_logs_and_current_rows(spark, tmp_path):
    rows = spark.createDataFrame([("k", 1, T(2024, 1, 1))], "key string, n long, processed_at timestamp_ntz")
    for i, n in enumerate((1, 2, 2)):
        sinks.write_batch(rows.withColumn("n", F.lit(n).cast("long")), str(tmp_path / "log"), min(i, 1))
    assert [r.n for r in sinks.current_view(spark.read.parquet(str(tmp_path / "log")), ["key"]).collect()] == [2]
    for _ in range(2):
        sinks.append_table(rows, str(tmp_path / "plain"), 1)
    assert spark.read.parquet(str(tmp_path / "plain")).count() == 2


def test_merges_and_exclusion(spark):
    stored = spark.createDataFrame([("p", "d", "u", "old")], "provider string, domain string, url string, title string")
    new = spark.createDataFrame([("p", "d", "u", "new"), ("p", "d", "v", "b"), ("p", "d", "v", "a"), ("p", "d", None, "x")], stored.schema)
    for parts in (1, 3):
        out = merge.insert_if_absent(stored, new.repartition(parts), ["provider", "domain", "url"])
        assert sorted((r.url, r.title) for r in out.collect()) == [("u", "old"), ("v", "a")]
    assert sorted(str(r.url) for r in merge.exclude(new, stored, ["url"]).collect()) == ["None", "v", "v"]
    sums = spark.createDataFrame([("p", "d", T(2024, 1, 1), T(2024, 1, 2), k, n, T(2024, 1, 3)) for k, n in (("a", 1), ("b", 2))], "provider string, domain string, window_start timestamp_ntz, window_end timestamp_ntz, keyword string, keyword_count long, processed_at timestamp_ntz")
    staged = sums.where("keyword = 'a'").withColumn("keyword_count", F.lit(5).cast("long"))
    got = lambda mode: sorted((r.keyword, r.keyword_count) for r in merge.merge_trends(sums, staged.union(staged), mode).collect())
    assert got("replace") == [("a", 10), ("b", 2)]
    assert got("recompute") == [("a", 10)]


def test_last_window_of_an_event_range(spark):
    """The window before the range gives the first growth only with warmup."""
    t = spark.createDataFrame([("p", "d", "k", T(2024, 1, d), T(2024, 1, d + 1), n) for d, n in ((1, 10), (2, 10), (3, 20))], "provider string, domain string, keyword string, window_start timestamp_ntz, window_end timestamp_ntz, keyword_count long")
    got = lambda **k: [(r.window_start.day, r.prev_mentions) for r in events.detect_events(t, since=T(2024, 1, 2), **k).orderBy("window_start").collect()]
    assert got() == [(2, 10), (3, 10)]
    assert got(warmup=False) == [(2, 0), (3, 10)]
    assert keywords.hourly_rollup(t.withColumnRenamed("window_start", "processed_at"), "processed_at").count() == 3


@pytest.mark.parametrize(("name", "text"), [("title", " "), ("url", None)])
def test_reject_reasons(spark, name, text):
    row = {"provider": "p", "domain": "d", "title": "t", "url": "u", "ingested_at": "x"} | {name: text}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row)).withColumn("metadata", F.lit(None).cast("struct<source:string,version:string,query:string>"))
    good, bad = ingest.validate_articles(df)
    assert (good.count(), [r.reason for r in bad.collect()]) == (0, [f"missing {name}"])
