"""Month tables, ingest runs, the stream's restart, backfills, feeds, dictionaries and candidates, over files."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trendloom.operators import analysis, backfill, cycle, dictionary, keywords, merge
from trendloom.schemas import ARTICLE_KEY, TREND_KEY
from trendloom.sources import dictionaries, feeds
from trendloom.sources.months import MonthTable, month_of
from trendloom.streaming import job

T = datetime
TREND = "provider string, domain string, window_start timestamp_ntz, window_end timestamp_ntz, keyword string, keyword_count long, processed_at timestamp_ntz"


def _trends(spark, rows):
    return spark.createDataFrame([("p", "d", t, t + timedelta(minutes=10), k, n, T(2024, 9, 1)) for t, k, n in rows], TREND)


def _files(table):
    return {m: sorted(os.listdir(f"{table.path}/month={m}")) for m in table.months()}


@pytest.fixture
def year(spark, tmp_path):
    table = MonthTable(spark, str(tmp_path / "trends"), TREND_KEY, "window_start")
    table.append(_trends(spark, [(T(2024, m, d), k, m) for m in range(1, 8) for d in (3, 20) for k in ("a", "b")]))
    return table


# --- months


def test_month_names():
    assert [month_of(T(2024, 1, 31), n) for n in (-13, -1, 0, 11, 12)] == ["2022-12", "2023-12", "2024-01", "2024-12", "2025-01"]


def test_merge_rewrites_touched_months_only(spark, year):
    before = _files(year)
    staged = _trends(spark, [(T(2024, 5, 3), "a", 100), (T(2024, 8, 1), "c", 1)])
    for _ in range(2):  # a repeated merge changes nothing
        assert year.merge(staged, merge.merge_trends) == ["2024-05", "2024-08"]
        rows = sorted((str(r.window_start.date()), r.keyword, r.keyword_count) for r in year.read(T(2024, 5, 1)).where("window_start < '2024-06-01' or window_start >= '2024-08-01'").collect())
        assert rows == [("2024-05-03", "a", 100), ("2024-05-20", "a", 5), ("2024-05-20", "b", 5), ("2024-08-01", "c", 1)]
    after = _files(year)
    assert {m for m in after if after[m] != before.get(m)} == {"2024-05", "2024-08"}


def test_reads_prune_months(year):
    plan = year.read(T(2024, 3, 10), T(2024, 4, 10))._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.split("PartitionFilters")[1:]).split("]")[0]
    assert "2024-03" in filters
    assert "2024-04" in filters
    assert year.read(T(2024, 3, 10), T(2024, 4, 10)).count() == 4


def test_articles_move_to_another_month(spark, tmp_path):
    table = MonthTable(spark, str(tmp_path / "articles"), ARTICLE_KEY, "published_at")
    article = lambda u, m, title: ("p", "d", u, title, T(2024, m, 2), T(2024, m, 3))
    schema = "provider string, domain string, url string, title string, published_at timestamp_ntz, ingested_at timestamp_ntz"
    table.append(spark.createDataFrame([article("u", 1, "old"), article("v", 2, "stays")], schema))
    table.merge(spark.createDataFrame([article("u", 3, "new"), article("u", 2, "older"), (None, "d", None, "x", None, None)], schema), merge.merge_articles)
    assert table.months() == ["2024-02", "2024-03"]  # nothing is left of January
    assert sorted((r.url, r.title) for r in table.read().collect()) == [("u", "new"), ("v", "stays")]


def test_retention_by_folder(spark, year):
    year.append(_trends(spark, [(T(2031, 1, 1), "future", 1)]))
    before = _files(year)
    assert year.drop_months(T(2024, 8, 15), 6) == ["2024-01"]
    assert year.retain("window_end", T(2024, 4, 3, 0, 10), timedelta(minutes=10)) == ["2024-02", "2024-03"]
    after = _files(year)
    assert sorted(after) == ["2024-04", "2024-05", "2024-06", "2024-07", "2031-01"]
    assert {m for m in after if after[m] != before[m]} == {"2024-04"}
    assert year.retain("window_end", T(2024, 4, 20), timedelta(minutes=10)) == []
    assert sorted(str(r.window_start.date()) for r in year.read(until=T(2024, 5, 1)).collect()) == ["2024-04-20"] * 2
    assert year.drop_months(T(2024, 1, 1), 6) == []


def test_purge_by_domain(spark, year, tmp_path):
    year.append(_trends(spark, [(T(2024, 2, 5), "stop", 1)]).withColumn("domain", F.lit("other")))
    before = _files(year)
    words = spark.createDataFrame([("stop", "other"), ("a", "elsewhere")], "word string, domain string")
    assert dictionary.purge_months({"trends": year}, words) == {"trends": 1}
    after = _files(year)
    assert {m for m in after if after[m] != before[m]} == {"2024-02"}
    pairs = spark.createDataFrame([("x", "stop", "b"), ("other", "b", "stop"), ("other", "b", "c")], "domain string, keyword_a string, keyword_b string")
    kept, counts = dictionary.purge_words({"relations": pairs, "stg_relations": pairs}, words)
    assert {r["name"]: r.removed for r in counts.collect()} == {"relations": 1, "stg_relations": 2}
    assert sorted(tuple(r) for r in kept["relations"].collect()) == [("other", "b", "c"), ("x", "stop", "b")]


# --- the ingest cycle

FETCHED = "key string, seq long, provider string, domain string, source string, title string, summary string, url string, published_at string, ingested_at string, metadata struct<source:string,version:string,query:string>, _query string"


def _fetched(spark, rows):
    return spark.createDataFrame([(k, i, "p", d, "s", t, None, u, "2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z", None, "q") for i, (k, d, t, u) in enumerate(rows)], FETCHED)


def test_cycle_marks_rows(spark):
    rows = [("d::q", "d", " ", "u1"), ("d::q", "d", "t", "u1"), ("d::q", "d", " ", "u1"), ("d::q", "d", "t", "u1"), ("d::q", "d", "t", None), ("e::q", "e", "t", "u1"), ("e::q", "e", "t", "seen"), ("e::q", "e", " ", "bad")]
    known = spark.createDataFrame([("p", "e", "seen"), ("p", "d", "other")], ARTICLE_KEY)
    results = spark.createDataFrame([("d::q", "p", "d", "q", True), ("e::q", "p", "e", "q", False), ("none::q", "p", None, "q", True), ("x", "p", None, "q", None)], "key string, provider string, domain string, query string, ok boolean")
    points = spark.createDataFrame([("e::q", T(2023, 1, 1)), ("stale", T(2023, 1, 1))], "key string, checkpoint timestamp_ntz")
    out = cycle.ingest_cycle(_fetched(spark, rows), results, known, points, T(2024, 1, 2), T(2024, 1, 3))
    assert [r.status for r in out.marked.orderBy("seq").collect()] == ["rejected", "published", "duplicate", "duplicate", "duplicate", "published", "duplicate", "rejected"]
    assert sorted((r.reason, r.payload.url) for r in out.rejects.collect()) == [("validation_error: missing title", "bad"), ("validation_error: missing title", "u1")]
    assert sorted((r.key, json.loads(r.value)["domain"]) for r in out.messages.collect()) == [("u1", "d"), ("u1", "e")]
    metrics = {r.domain: (r.request_count, r.success_count, r.article_count, r.duplicate_count, r.publish_count, r.error_count) for r in out.metrics.collect()}
    assert metrics == {"d": (1, 1, 5, 3, 1, 0), "e": (1, 0, 3, 1, 1, 1), "none": (1, 1, 0, 0, 0, 0), "ai_tech": (1, 0, 0, 0, 0, 1)}
    assert {r.key: r.checkpoint for r in out.checkpoints.collect()} == {"d::q": T(2024, 1, 2), "none::q": T(2024, 1, 2), "e::q": T(2023, 1, 1)}


def test_broken_run_is_repeated_as_a_whole(spark, tmp_path, monkeypatch):
    rows = _fetched(spark, [("d::q", "d", "t", f"u{i % 3}") for i in range(6)])
    results = spark.createDataFrame([("d::q", "p", "d", "q", True)], "key string, provider string, domain string, query string, ok boolean")
    log = cycle.RunLog(spark, str(tmp_path / "runs"))
    assert log.read("messages") is None
    with monkeypatch.context() as m:
        m.setattr(cycle, "OUTPUTS", ("messages", "no such output"))
        with pytest.raises(AttributeError):
            cycle.run_cycle(log, 1, rows, results, T(2024, 1, 1))
    assert log.runs() == []
    assert cycle.run_cycle(log, 1, rows, results, T(2024, 1, 1))
    assert not cycle.run_cycle(log, 1, rows, results, T(2024, 1, 5))
    assert cycle.run_cycle(log, 2, _fetched(spark, [("d::q", "d", "t", "u0"), ("d::q", "d", "t", "new")]), results, T(2024, 1, 2))
    assert sorted((r.run, r.key) for r in log.read("messages").collect()) == [(1, "u0"), (1, "u1"), (1, "u2"), (2, "new")]
    assert [(r.run, r.article_count, r.duplicate_count, r.publish_count) for r in log.read("metrics").orderBy("run").collect()] == [(1, 6, 3, 3), (2, 2, 1, 1)]
    assert [r.checkpoint for r in log.last("checkpoints").collect()] == [T(2024, 1, 2)]


# --- the stream


def _messages(folder, files):
    folder.mkdir()
    for i, rows in enumerate(files):
        (folder / f"{i}.json").write_text("\n".join(json.dumps({"url": u, "title": t, "provider": "p", "domain": "d", "published_at": at, "ingested_at": "2024-01-01T01:00:00Z"}) for u, t, at in rows) + "\nnot json")
        os.utime(folder / f"{i}.json", (i + 1, i + 1))


def _current(tables):
    shown = {name: getattr(tables, name).read().drop("processed_at", "ingested_at") for name in ("articles", "keywords", "trends", "relations")}
    return {name: sorted(map(str, df.select(sorted(df.columns)).collect())) for name, df in shown.items()}


def test_restart_after_a_failed_batch(spark, tmp_path):
    from trendloom.sources.readers import read_article_stream

    files = [[(f"u{i}-{j}", f"alpha beta {'gamma' if j % 2 else 'delta'} w{i}", f"2024-0{1 + i}-01T00:{j:02d}:00Z") for j in range(5)] + [("u0-0", "again", "2024-01-01T00:00:00Z")] for i in range(2)]
    _messages(tmp_path / "in", files)
    kept = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    job.use_rocksdb(spark)
    try:
        got = []
        for broken in (False, True):
            out = tmp_path / f"out{broken}"
            tables, failed = job.CurrentTables.at(spark, f"{out}/current"), []

            def sink(df, i, broken=broken, failed=failed):
                if broken and i == 1 and not failed:
                    failed.append(i)
                    raise OSError("the sink is down")

            def go(out=out, tables=tables, sink=sink):
                raw = read_article_stream(spark, "text", {"path": str(tmp_path / "in"), "maxFilesPerTrigger": "1"})
                query = job.start(raw, str(out), f"{out}/checkpoint", {"availableNow": True}, tables=tables, sink=sink, delay="1 hour")
                query.awaitTermination(180)
                return query

            if broken:
                with pytest.raises(Exception, match="the sink is down"):
                    go()
            query = go()
            got.append(_current(tables))
            state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
            assert state[-1] <= 6  # a month later all earlier keys are forgotten
        assert got[0] == got[1]
        assert len(got[0]["articles"]) == 10
        assert [p.name for p in sorted((tmp_path / "outTrue" / "articles").iterdir())][:2] == ["batch_id=0", "batch_id=1"]
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", kept)


def test_current_tables_follow_corrected_articles(spark, tmp_path):
    tables, path = job.CurrentTables.at(spark, str(tmp_path / "current")), str(tmp_path / "logs")
    schema = "provider string, domain string, url string, title string, event_time timestamp_ntz, published_at timestamp_ntz, ingested_at timestamp_ntz, article_text string"
    article = lambda u, at, text: ("p", "d", u, text, at, at, at, text)
    batches = [[article("u", T(2024, 1, 1), "alpha beta"), article("v", T(2024, 1, 1, 0, 5), "alpha")], [article("u", T(2024, 2, 1), "gamma beta")]]
    for i, rows in enumerate(batches):
        for _ in range(2):
            job.process_batch(spark.createDataFrame(rows, schema), i, path)
            job.merge_batch(spark, path, i, tables)
    trends = sorted((str(r.window_start.date()), r.keyword, r.keyword_count) for r in tables.trends.read().collect())
    assert trends == [("2024-01-01", "alpha", 1), ("2024-02-01", "beta", 1), ("2024-02-01", "gamma", 1)]
    assert [(r.keyword_a, r.keyword_b) for r in tables.relations.read().collect()] == [("beta", "gamma")]


# --- dictionaries


def test_dictionaries_are_read_when_a_version_changes(spark, tmp_path):
    path, now = str(tmp_path), [0.0]
    lists = dictionaries.VersionedDictionaries(spark, path, 60, lambda: now[0])
    articles = spark.createDataFrame([("d",), ("e",)], "domain string")
    words = lambda: {r.domain: r.words for r in lists(articles)["stopwords"].collect()}
    assert words() == {}
    assert lists.reads == 2
    publish = lambda *w: dictionaries.publish_dictionary(spark.createDataFrame(list(w), "word string, domain string"), path, "stopword_dict")
    assert publish(("x", "all"), ("y", "d"), ("x", "all")) == 1
    assert words() == {}  # not looked at yet
    now[0] = 60
    assert words() == {"d": ["x", "y"], "e": ["x"], "all": ["x", "y"]}
    now[0] = 200
    words()
    assert (lists.reads, lists.versions) == (3, {"compound_noun_dict": 0, "stopword_dict": 1})
    (tmp_path / "stopword_dict" / "version=2").mkdir()  # being written
    now[0] = 300
    assert words()["e"] == ["x"]
    assert publish(("z", "all")) == 2
    now[0] = 400
    assert words()["e"] == ["z"]
    row = dictionaries.with_versions(articles, lists.versions).first()
    assert (row.stopword_dict_version, row.compound_noun_dict_version) == (2, 0)


def test_batches_note_dictionary_versions(spark, tmp_path):
    words, path = str(tmp_path / "words"), str(tmp_path / "logs")
    lists = dictionaries.VersionedDictionaries(spark, words, 0)
    articles = spark.createDataFrame([("p", "d", "u", "stop alpha beta", T(2024, 1, 1), T(2024, 1, 1), T(2024, 1, 1), "stop alpha beta")], "provider string, domain string, url string, title string, event_time timestamp_ntz, published_at timestamp_ntz, ingested_at timestamp_ntz, article_text string")
    for batch, (name, word) in enumerate((("stopword_dict", "stop"), ("compound_noun_dict", "alphabeta"))):
        dictionaries.publish_dictionary(spark.createDataFrame([(word, "all")], "word string, domain string"), words, name)
        job.process_batch(articles, batch, path, lists)
    log = spark.read.parquet(f"{path}/keywords").orderBy("batch_id", "keyword").collect()
    assert [(r.batch_id, r.keyword, r.stopword_dict_version, r.compound_noun_dict_version) for r in log] == [(0, "alpha", 1, 0), (0, "beta", 1, 0), (1, "alphabeta", 1, 1)]


# --- analysers and backfills


def _pieces():
    """Tokens of two letters within each word, so that the tokens of a word touch."""
    return lambda text: [(text[i : i + 2], i, i + 2) for i in range(len(text) - 1) if text[i : i + 2].strip() == text[i : i + 2] and (i == 0 or text[i - 1] == " " or (i - text.rfind(" ", 0, i) - 1) % 2 == 0)]


def test_analyser_spans(spark):
    articles = spark.createDataFrame([("p", "d", "u", T(2024, 1, 1), "데이터센터를 ABCD xy stop", 1), ("p", "d", "v", T(2024, 1, 1), "a bc d", 2), ("p", "d", "w", T(2024, 1, 1), None, 3)], "provider string, domain string, url string, event_time timestamp_ntz, article_text string, extra int").repartition(2)
    analysed = analysis.analyse_articles(articles, _pieces)
    assert {r.url: [tuple(s) for s in r.spans] for r in analysed.collect()}["u"][:3] == [("데이", 0, 2), ("터센", 2, 4), ("터를", 4, 6)]
    lists = lambda *w: spark.createDataFrame([("d", list(w))], "domain string, words array<string>")
    tokens = {r.url: r.tokens for r in keywords.tokenize(analysed, stopwords=lists("xy", "bc"), compounds=lists("abcd", "cdxy", "데이터센", "xyst"), spans=True).collect()}
    assert tokens == {"u": ["데이터센", "터를", "abcd", "xyst", "op"], "v": [], "w": []}  # a blank between tokens counts as touching; v falls back to its words
    mined = analysis.mining_spans(articles, _pieces)
    assert sorted((r.token, r.start, r.end) for r in mined.collect()) == [("데이", 0, 2), ("터를", 4, 6), ("터센", 2, 4)]
    found = keywords.mine_compounds(mined, min_freq=1, exclude=spark.createDataFrame([("데이터센",)], "word string"))
    assert sorted((r.word, r.frequency) for r in found.collect()) == [("데이터센터를", 1), ("터센터를", 1)]


def test_backfill(spark, tmp_path):
    tables = job.CurrentTables.at(spark, str(tmp_path))
    rows = [("p", "d", "u", T(2024, 1, 31, 23, 55), "new york city"), ("p", "d", "v", T(2024, 1, 31, 23, 58), "old york"), ("p", "e", "w", T(2024, 2, 1), "new york"), ("p", "d", "late", T(2024, 3, 1), "new york")]
    articles = spark.createDataFrame(rows, "provider string, domain string, url string, event_time timestamp_ntz, article_text string")
    words = keywords.article_keywords(keywords.tokenize(articles)).withColumn("processed_at", F.col("event_time"))
    stamp = lambda df: df.withColumn("processed_at", F.col("window_end"))
    tables.articles.append(articles)
    tables.keywords.append(words)
    tables.trends.append(stamp(keywords.keyword_trends(words)))
    tables.relations.append(stamp(keywords.keyword_relations(keywords.keyword_pairs(keywords.representative_keywords(words)))))
    before = _current(tables)
    compounds = spark.createDataFrame([("d", ["newyork"]), ("e", ["newyork"])], "domain string, words array<string>")
    run = lambda **k: backfill.run_backfill(tables.articles, tables.keywords, tables.trends, tables.relations, " newyork ", lambda hit: keywords.tokenize(hit, compounds=compounds), until=T(2024, 2, 15), **k).first()
    dry = run(dry_run=True)
    assert (dry.status, dry.scanned_articles, dry.affected_articles, dry.affected_windows, dry.keyword_rows) == ("dry_run", 3, 2, 2, 3)
    assert _current(tables) == before
    done = run(domain="d")
    assert (done.status, done.scanned_articles, done.affected_articles, done.affected_windows, done.keyword_rows, done.trend_rows, done.relation_rows) == ("ok", 2, 1, 1, 2, 4, 2)
    trends = sorted((r.domain, str(r.window_start), r.keyword) for r in tables.trends.read().collect())
    assert [t for t in trends if t[0] == "d" and "01-31" in t[1]] == [("d", "2024-01-31 23:50:00", k) for k in ("city", "newyork", "old", "york")]
    assert sorted(t[2] for t in trends if t[0] == "e" or "03-01" in t[1]) == ["new", "new", "york", "york"]
    for bad in ({"word": " "}, {"since": T(2024, 2, 1), "until": T(2024, 2, 1)}):
        with pytest.raises(ValueError, match="word|since"):
            backfill.run_backfill(tables.articles, tables.keywords, tables.trends, tables.relations, **({"word": "x", "tokenizer": None} | bad))


# --- feeds

RSS = """<rss xmlns:c="http://purl.org/rss/1.0/modules/content/"><channel><title>Feed</title>
<item><title>&lt;b&gt;One&lt;/b&gt; &amp;amp; more</title><c:encoded>Body</c:encoded><description>Later</description><link>http://x/1</link><pubDate>Mon, 02 Mar 2026 03:00:00 +0900</pubDate></item>
<item><description/><guid>http://x/2</guid><updated>2026-03-02T00:00:00Z</updated></item>
<item><title>Copy</title><link>http://x/1</link></item></channel></rss>"""
ATOM = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A</title><summary>...</summary><link/><link href=" http://y/1 "/><published>2026-03-02T00:00:00Z</published></entry></feed>'


def test_feeds_as_whole_documents(spark):
    documents = spark.createDataFrame([("http://a", RSS.encode()), ("http://b", ATOM.encode()), ("http://c", b"<rss><item><guid>tag:1</guid></item></rss>"), ("http://d", b"<rss>"), ("http://unknown", ATOM.encode()), ("http://yna.co.kr/f", ATOM.encode()), ("http://e", None)], "url string, content binary")
    catalog = spark.createDataFrame([(" A ", "f", "d", "http://a"), (None, None, None, " http://b "), ("C", "f", "d", "http://c"), ("D", "f", "d", "http://d"), (None, None, None, "http://yna.co.kr/f"), ("E", "f", "d", "http://e"), ("None", "f", "d", "http://not/fetched")], "publisher string, feed_name string, domain string, url string")
    articles, results = feeds.feed_articles(documents, catalog)
    rows = {(r.key, r.position): r for r in articles.collect()}
    one, two, atom, wire = (rows[k] for k in (("A::d::f", 0), ("A::d::f", 1), ("::::", 0), ("::::", 0)))
    assert (one.provider, one.domain, one.source, one.title, one.summary, one.url, str(one.published_at), one._query) == ("A", "d", "A", "One & more", "Body", "http://x/1", "2026-03-01 18:00:00", "f")
    assert (two.title, two.summary, two.url, str(two.published_at)) == ("(untitled)", None, "http://x/2", "2026-03-02 00:00:00")
    assert ("A::d::f", 2) not in rows
    both = {r.provider: r for r in articles.where("key = '::::'").collect()}
    atom, wire = both["y"], both["연합뉴스"]
    assert (atom.domain, atom.summary, atom.url, atom._query) == ("general", "...", "http://y/1", "")
    assert (wire.domain, wire.summary, wire._query) == ("politics", "A", "yonhap_rss")
    assert {r.key: r.ok for r in results.collect()} == {"A::d::f": True, "::::": True, "C::d::f": False, "D::d::f": False, "E::d::f": False}
    points = spark.createDataFrame([("A::d::f", T(2026, 3, 1, 20))], "key string, checkpoint timestamp")
    assert sorted(r.url for r in feeds.feed_articles(documents, catalog, points)[0].where("key = 'A::d::f'").collect()) == ["http://x/2"]
    assert feeds.feed_articles(documents.limit(0), catalog)[0].count() == 0


# --- candidates


def test_candidates_by_status(spark):
    old = spark.createDataFrame([("open", "all", 2, 1, "needs_review"), ("done", "all", 2, 1, "approved"), ("unseen", "all", 2, 1, "needs_review")], "word string, domain string, frequency long, doc_count long, status string").withColumns({c: F.lit(T(2024, 1, 1)) for c in ("first_seen_at", "last_seen_at")})
    found = spark.createDataFrame([("open", "all", 5, 3), ("done", "all", 5, 3), ("new", "all", 5, 3), ("open", "d", 1, 1)], "word string, domain string, frequency long, doc_count long")
    merged = dictionary.merge_mined(old, found, T(2024, 2, 2))
    got = {(r.word, r.domain): (r.frequency, r.doc_count, r.status, r.first_seen_at.month, r.last_seen_at.month, r.change) for r in merged.collect()}
    assert got == {("open", "all"): (7, 4, "needs_review", 1, 2, "updated"), ("done", "all"): (2, 1, "approved", 1, 1, None), ("unseen", "all"): (2, 1, "needs_review", 1, 1, None), ("new", "all"): (5, 3, "needs_review", 2, 2, "new"), ("open", "d"): (1, 1, "needs_review", 2, 2, "new")}
    assert tuple(dictionary.merge_outcome(merged).first()) == (2, 1)
    again = {r.word: r.frequency for r in dictionary.merge_found(old, found.drop("doc_count"), ["word", "domain"], T(2024, 2, 2), replace=("frequency",)).where("domain = 'all'").collect()}
    assert again == {"open": 5, "done": 2, "unseen": 2, "new": 5}


def test_simple_review(spark):
    rows = [("a", "pending", 9), ("b", "needs_review", 8), ("c", "pending", 7), ("d", "approved", 99), ("e", "pending", 1)]
    candidates = spark.createDataFrame([(w, "all", s, n, None, None) for w, s, n in rows], "word string, domain string, status string, frequency long, reviewed_at timestamp_ntz, reviewed_by string")
    reviewed = dictionary.simple_review(candidates, spark.createDataFrame([("a", 0), ("b", 2), ("e", 5)], "word string, total long"), T(2024, 1, 1), limit=3)
    assert {r.word: (r.status, r.reviewed_by, r.outcome) for r in reviewed.collect()} == {"a": ("needs_review", None, "needs_review"), "b": ("approved", "auto-approver", "auto_approved"), "c": ("needs_review", None, "needs_review"), "d": ("approved", None, None), "e": ("pending", None, None)}
    assert tuple(dictionary.simple_review_counts(reviewed).first()) == (3, 1, 2)


def test_review_by_evidence(spark):
    candidates = spark.createDataFrame([("인공 지능", "all", "needs_review", 9, 4), ("없는말", "all", "needs_review", 9, 4), ("다른말", "all", "needs_review", 9, 4), ("일반", "all", "needs_review", 9, 4)], "word string, domain string, status string, frequency long, doc_count long")
    evidence = spark.createDataFrame([("인공 지능", True, 3, 1, "x", "새 인공지능", "l1"), ("인공 지능", True, 3, 0, "x", "없음", "l0"), ("없는말", True, 0, 0, None, None, None), ("다른말", True, 2, 0, "x", "y", "l"), ("일반", True, 2, 0, "일반", "y", "l")], "word string, ok boolean, total long, position int, title string, description string, link string")
    reviewed = dictionary.review_candidates(candidates, evidence, spark.createDataFrame([("일반",)], "word string"))
    assert {r.word: (r.auto_decision, r.status) for r in reviewed.collect()} == {"인공 지능": ("high_confidence", "approved"), "없는말": ("no_search_results", "rejected"), "다른말": ("no_exact_match", "rejected"), "일반": ("low_confidence", "needs_review")}
    assert {r["word"]: r["match"]["link"] for r in reviewed.where("match is not null").collect()} == {"인공 지능": "l1", "일반": "l"}
    assert {r.auto_decision: (r.candidates, r.approved, r.rejected) for r in dictionary.review_outcome(reviewed).collect()}["high_confidence"] == (1, 1, 0)
