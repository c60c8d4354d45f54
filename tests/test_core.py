"""Cases of single functions and operators."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from trendloom.functions import text as tx
from trendloom.operators import dictionary, events, ingest, keywords, merge
from trendloom.plans import serving
from trendloom.schemas import ARTICLE_KEY

T = datetime


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("raw", "clean"), [("<b>AI</b> 2026 혁신!", "ai 혁신"), ("see https://x.y/z?q  now [+12 chars]", "see now"), ("", "")])
def test_clean_text(spark, raw, clean):
    assert one(spark, tx.clean_text(F.lit(raw))) == clean


def test_tokens_are_of_one_script(spark):
    assert one(spark, tx.tokens(F.lit("ai a 혁신 ai혁신 gpt"), F.array(F.lit("gpt")))) == ["ai", "혁신"]


def test_longest_compound_wins(spark):
    words = lambda *w: F.array(*map(F.lit, w))
    assert one(spark, tx.merge_compounds(words("인공", "지능", "반도체"), words("인공지능", "반도체"))) == ["인공지능", "반도체"]
    assert one(spark, tx.merge_compounds(F.array().cast("array<string>"), words("가나"))) == []


def test_compounds_join_only_tokens_that_touch(spark):
    words = lambda *w: F.array(*map(F.lit, w))
    spans = lambda *p: F.array(*(F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in p))
    tokens = words("데이터", "센터", "투자")
    merged = lambda text, *p: one(spark, tx.merge_compounds(tokens, words("데이터센터"), 6, spans(*p), F.lit(text)))
    assert merged("데이터 센터 투자", (0, 3), (4, 6), (7, 9)) == ["데이터센터", "투자"]
    assert merged("데이터, 센터 투자", (0, 3), (5, 7), (8, 10)) == ["데이터", "센터", "투자"]
    assert one(spark, tx.compound_window(words("가나다"))) == 3
    assert one(spark, tx.compound_window(words("가나다라마바사아"))) == 6


def test_hangul_is_composed_before_cleaning(spark):
    import unicodedata

    for text in ("혁신 ai 값", "가각", "no hangul"):
        assert one(spark, tx.clean_text(F.lit(unicodedata.normalize("NFD", text)))) == text
    assert one(spark, tx.clean_text(F.lit("now [+12 chars] [+3chars]"))) == "now chars"


def test_texts_are_tokenised_once(spark):
    a = spark.createDataFrame([("p", "d", "u", T(2024, 1, 1), "alpha beta")], "provider string, domain string, url string, event_time timestamp_ntz, article_text string")
    plan = keywords.article_keywords(keywords.tokenize(a))._jdf.queryExecution().executedPlan().toString()
    assert sum("http" in line for line in plan.splitlines()) == 1


def test_purge_counts_every_row(spark):
    log = spark.createDataFrame([("a", "b"), ("a", "b"), ("b", "a"), ("b", "c")], "keyword_a string, keyword_b string")
    kept, counts = dictionary.purge_words({"pairs": log}, spark.createDataFrame([("a",), ("a",)], "word string"))
    assert [tuple(r) for r in kept["pairs"].collect()] == [("b", "c")]
    assert [tuple(r) for r in counts.collect()] == [("pairs", 3)]


def test_ranges_on_offer():
    assert serving.preset_range(T(2024, 1, 2), "6h") == (T(2024, 1, 1, 18), T(2024, 1, 2), 30)
    assert [serving.auto_bucket(T(2024, 1, 1), T(2024, 1, d)) for d in (1, 3, 5, 20)] == [5, 15, 60, 240]


def test_bounded_pairs_take_the_most_frequent(spark):
    df = _keywords(spark, [("p", "d", "u", T(2024, 1, 1), k, n) for k, n in (("a", 3), ("b", 2), ("c", 1))])
    got = lambda **k: {(r.keyword_a, r.keyword_b): r.cooccurrence_count for r in keywords.min_count_relations(df, **k).collect()}
    assert got() == {("a", "b"): 2, ("a", "c"): 1, ("b", "c"): 1}
    assert got(most=2) == {("a", "b"): 2}


def test_files_of_feeds_letters_and_words(spark, tmp_path):
    from trendloom.sources import readers

    (tmp_path / "feeds.csv").write_text("publisher,feed_name,domain,url,is_active,notes\nA,f,d,http://a,true,x\nB,g,d,http://b,false,\nC,h,d, ,yes,\n")
    assert [r.publisher for r in readers.read_feed_catalog(spark, str(tmp_path / "feeds.csv")).collect()] == ["A"]
    (tmp_path / "feed.xml").write_text("<rss><channel><item><title><![CDATA[<b>T</b> one]]></title><description>&lt;p&gt;S&lt;/p&gt;</description><link>http://x/1</link><pubDate>Mon, 02 Mar 2026 03:00:00 +0900</pubDate></item></channel></rss>")
    row = readers.read_feed_items(spark, str(tmp_path / "feed.xml"), "A", "d", "f").first()
    assert (row.provider, row.source, row.title, row.summary, row.url, str(row.published_at), row._query) == ("A", "A", "T one", "S", "http://x/1", "2026-03-01 18:00:00", "f")
    (tmp_path / "dead.jsonl").write_text('{"failed_at": "t", "reason": "r", "attempt": 1, "payload": {"title": "x"}}\n\n{bad\n')
    good, bad = readers.read_dead_letters(spark, str(tmp_path / "dead.jsonl"))
    assert [r.attempt for r in good.collect()] == [1]
    assert bad.count() == 1
    (tmp_path / "words.txt").write_text("# note\n\n가나\n가나\nabc\n다라 \n")
    assert sorted(r.word for r in readers.read_word_list(spark, str(tmp_path / "words.txt")).collect()) == ["가나", "다라"]


@pytest.mark.parametrize(("current", "previous", "growth", "score"), [(9, 0, 1.0, 83), (7, 5, 0.4, 54), (1, 10, -0.9, 0), (0, 0, 0.0, 0)])
def test_growth_and_score(spark, current, previous, growth, score):
    g = tx.safe_growth(F.lit(current), F.lit(previous))
    assert one(spark, g) == pytest.approx(growth)
    assert one(spark, tx.event_score(F.lit(current), g)) == score


def test_dates_and_summaries(spark):
    assert one(spark, tx.parse_pub_date(F.lit("Mon, 02 Mar 2026 03:00:00 +0900")).cast("string")) == "2026-03-01 18:00:00"
    assert one(spark, tx.parse_pub_date(F.lit("2026-03-02T03:00:00+09:00")).cast("string")) == "2026-03-01 18:00:00"
    assert one(spark, tx.parse_pub_date(F.lit("soon"))) is None
    assert one(spark, tx.normalize_summary(F.lit(" ... - "))) is None
    assert one(spark, tx.strip_html(F.lit("&lt;p&gt;a &amp; b&lt;/p&gt;"))) == "a & b"


def test_article_text(spark):
    rows = spark.createDataFrame([("t", None), ("t", " "), ("t", "t"), ("t", "s")], "title string, summary string")
    assert [r.x for r in rows.select(tx.article_text(F.col("title"), F.col("summary")).alias("x")).collect()] == ["t", "t", "t", "t s"]


def _keywords(spark, rows):
    return spark.createDataFrame(rows, "provider string, domain string, url string, event_time timestamp_ntz, keyword string, keyword_count long")


def test_pairs_are_all_of_the_best(spark):
    df = _keywords(spark, [("p", "d", "u", T(2024, 1, 1), k, n) for k, n in zip("abcde", (1, 1, 3, 1, 2), strict=True)])
    ranked = keywords.representative_keywords(df, 4)
    assert {(r.keyword_a, r.keyword_b) for r in keywords.keyword_pairs(ranked).collect()} == {("c", "e"), ("a", "c"), ("b", "c"), ("a", "e"), ("b", "e"), ("a", "b")}
    assert ("c", "a") in {(r.keyword_a, r.keyword_b) for r in keywords.keyword_pairs(ranked, "rank").collect()}


def test_previous_is_the_last_existing_window(spark):
    rows = [("p", "d", "k", T(2024, 1, 1, 0, 0), T(2024, 1, 1, 0, 10), 2), ("p", "d", "k", T(2024, 1, 1, 0, 30), T(2024, 1, 1, 0, 40), 4)]
    df = spark.createDataFrame(rows, "provider string, domain string, keyword string, window_start timestamp_ntz, window_end timestamp_ntz, keyword_count long")
    since = T(2024, 1, 1, 0, 20)
    assert events.detect_events(df, since).first()["prev_mentions"] == 2
    assert events.detect_events(df, since, warmup=False).first()["prev_mentions"] == 0


def test_merge_modes_and_idempotence(spark):
    s = "provider string, domain string, window_start timestamp_ntz, window_end timestamp_ntz, keyword string, keyword_count long, processed_at timestamp_ntz"
    w = (T(2024, 1, 1), T(2024, 1, 1, 0, 10))
    stored = spark.createDataFrame([("p", "d", *w, "k", 10, w[0]), ("p", "d", *w, "old", 1, w[0])], s)
    staged = spark.createDataFrame([("p", "d", *w, "k", 2, w[1]), ("p", "d", *w, "k", 3, w[1])], s)
    got = lambda df: sorted((r.keyword, r.keyword_count) for r in df.collect())
    assert got(merge.merge_trends(stored, staged, "replace")) == [("k", 5), ("old", 1)]
    assert got(merge.merge_trends(stored, staged)) == [("k", 5)]
    assert got(merge.merge_trends(merge.merge_trends(stored, staged, "replace"), staged, "replace")) == [("k", 5), ("old", 1)]


def test_latest_wins(spark):
    a = spark.createDataFrame([("p", "d", "u", T(2024, 1, 1), None, "x"), ("p", "d", "u", T(2024, 1, 1), T(2024, 1, 1), "y")], "provider string, domain string, url string, ingested_at timestamp_ntz, published_at timestamp_ntz, title string")
    assert [r.title for r in merge.latest(a).collect()] == ["y"]


def test_dead_letters_routes(spark):
    def payload(**k):
        return {"provider": "p", "domain": "d", "title": "t", "url": "u", "ingested_at": "2024", **k}

    rows = [payload(title=" "), payload(), payload(url="seen"), payload(url="v"), payload(url="w")]
    df = spark.createDataFrame([(json.dumps(p), a, ok) for p, a, ok in zip(rows, (0, 3, 0, 1, 0), (True, True, True, False, True), strict=True)], "j string, attempt long, delivered boolean")
    from trendloom.schemas import RAW_ARTICLE

    df = df.select(F.from_json("j", RAW_ARTICLE).alias("payload"), "attempt", "delivered", F.get_json_object("j", "$.url").alias("name"))
    routed = ingest.route_dead_letters(df, spark.createDataFrame([("p", "d", "seen")], ARTICLE_KEY))
    assert sorted((r.attempt, r.name, r.outcome, r.next_attempt) for r in routed.collect()) == [(0, "seen", "skipped", 0), (0, "u", "permanent", 0), (0, "w", "replayed", 0), (1, "v", "retry", 2), (3, "u", "permanent", 3)]


def test_candidate_decisions(spark):
    rows = [(False, 1, True, "가나", 9, 9), (True, 0, True, "가나", 9, 9), (True, 5, False, "가나", 9, 9), (True, 5, True, "가", 9, 9), (True, 5, True, "ab", 9, 9), (True, 5, True, "가나", 3, 5), (True, 5, True, "가나", 2, 5)]
    df = spark.createDataFrame(rows, "ok boolean, total long, hit boolean, word string, docs long, f long")
    got = [r.x for r in df.select(tx.decide(F.col("ok"), F.col("total"), F.col("hit"), F.col("word"), F.lit(False), F.col("docs"), F.col("f")).alias("x")).collect()]
    assert got == ["api_error", "no_search_results", "no_exact_match", "low_confidence", "low_confidence", "high_confidence", "needs_manual_review"]


def test_series_sums_or_keeps_the_last(spark):
    t = [("k", T(2024, 1, 1, 0, 0), 3), ("k", T(2024, 1, 1, 0, 10), 4)]
    df = spark.createDataFrame(t, "keyword string, window_start timestamp, keyword_count long")
    run = lambda mode: serving.trend_series(df, ["k"], T(2024, 1, 1), T(2024, 1, 1, 0, 30), 30, mode).collect()[0]["mentions"]
    assert run("sum") == 7
    assert run("last") == 4


def test_changes_audit_and_conflicts(spark):
    d = spark.createDataFrame([("a", "all", "s")], "word string, domain string, source string")
    c = spark.createDataFrame([("add", "a", "all", "s", "me"), ("add", "b", "all", "s", "me"), ("delete", "zz", "all", "s", "me")], "action string, word string, domain string, source string, actor string")
    kept, audit, conflicts = dictionary.apply_changes(d, c, T(2024, 1, 1))
    assert sorted(r.word for r in kept.collect()) == ["a", "b"]
    assert [r.word for r in audit.collect()] == ["b"]
    assert sorted(r.word for r in conflicts.collect()) == ["a", "zz"]


def test_domain_scopes(spark):
    w = spark.createDataFrame([("가나", "all"), ("다라", "x")], "word string, domain string")
    got = {r.domain: r.words for r in keywords.scoped_words(w, spark.createDataFrame([("x",), ("y",)], "domain string")).collect()}
    assert got == {"x": ["가나", "다라"], "y": ["가나"], "all": ["가나", "다라"]}
    rows = spark.createDataFrame([("a",), ("b",), ("q",)], "domain string")
    catalog = spark.createDataFrame([("a", "g"), ("b", "g")], "domain_id string, group_id string")
    for asked, want in (("g", ["a", "b"]), ("a", ["a"]), ("q", ["q"]), ("all", ["a", "b", "q"])):
        assert sorted(r.domain for r in serving.filter_domain(rows, catalog, asked).collect()) == want


def test_stream_gives_the_same_in_one_or_many_batches(spark, tmp_path):
    from trendloom.sources.readers import read_article_stream
    from trendloom.streaming import job

    (tmp_path / "in").mkdir()
    for i in range(4):
        lines = [json.dumps({"url": f"u{j}", "title": f"alpha beta{'' if j % 2 else ' gamma'} w", "provider": "p", "domain": "d", "published_at": f"2024-01-01T00:{j:02d}:00Z", "ingested_at": "2024-01-01T01:00:00Z"}) for j in range(i * 5, i * 5 + 6)]
        (tmp_path / "in" / f"{i}.json").write_text("\n".join([*lines, "not json"]))
    got = []
    for n in ("1", "4"):
        out = tmp_path / f"out{n}"
        raw = read_article_stream(spark, "text", {"path": str(tmp_path / "in"), "maxFilesPerTrigger": n})
        job.start(raw, str(out), str(tmp_path / f"check{n}"), {"availableNow": True}).awaitTermination(120)
        log = spark.read.parquet(f"{out}/keywords").drop("batch_id", "processed_at")
        got.append(sorted(map(str, job.recomputed(log)[0].collect())))
    assert got[0] == got[1]
    assert got[0]
