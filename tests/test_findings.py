"""Cases that reviews of rounds 3 and 4 found."""

import glob
import os
import time
from datetime import datetime as T

from pyspark.sql import functions as F

from trendloom.functions import text as tx
from trendloom.llm import chat_format
from trendloom.operators import dictionary, keywords, merge
from trendloom.plans import registry, serving, stored_queries
from trendloom.sources import feeds, fixtures
from trendloom.sources.months import MonthTable
from trendloom.sources.shared import shared_folder, stored


def _greedy(words, known):
    out, i, most = [], 0, min(6, max(2, *map(len, known)))
    while i < len(words):
        n = max((n for n in range(2, most + 1) if i + n <= len(words) and "".join(words[i : i + n]) in known), default=1)
        out.append("".join(words[i : i + n]))
        i += n
    return out


def test_word_lists_are_dealt_by_bucket(spark):
    text = " ".join(("ab", "cd", "ef", "ab", "gh", "ij", "kl")[i * i % 7] + "x" * (i % 3) for i in range(4000))
    known, stop = {"abcd", "abxcdxx", "ab" + "cdx", "ghxx" + "ab", "abab", "abxab", "cdxxab", "ababxcdxx"}, {"cdx", "ab", "abxcdxx"}
    lists = lambda words: spark.createDataFrame([("d", w) for w in words], "domain string, word string").groupBy("domain").agg(F.collect_list("word").alias("words"))
    rows = spark.createDataFrame([("p", d, "u" + d, T(2024, 1, 1), text) for d in ("d", "e")], "provider string, domain string, url string, event_time timestamp_ntz, article_text string")
    got = keywords.tokenize(rows, stopwords=lists(stop), compounds=lists(known))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan  # before, articles were dealt by domain to meet their lists, and each token read a whole list
    tokens = {r.domain: r.tokens for r in got.collect()}
    assert tokens["d"] == [w for w in _greedy([w for w in text.split() if w not in stop], known) if w not in stop]
    assert tokens["e"] == text.split()


def test_tokens_need_no_cleaned_text(spark):
    df = spark.createDataFrame([("Ab1cd  e f-ghi 혁신ai 혁 신문, zz",)], "t string")
    assert df.select(tx.tokens(tx.lower_text(F.col("t")))).first()[0] == ["ab", "cd", "ghi", "신문", "zz"] == df.select(tx.tokens(tx.clean_text(F.col("t")))).first()[0]


def _sql_equals(spark, name, folder, **tables):
    import duckdb

    c = duckdb.connect()
    for t, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{t}.parquet")
        c.execute(f"create view {t} as select * from '{folder}/{t}.parquet/*.parquet'")
    r = c.execute(registry.SQL[name])
    names = [x[0] for x in r.description]
    want = sorted(map(repr, r.fetchall()))
    assert sorted(repr(tuple(x)) for x in registry.QUERIES[name](spark, str(folder)).select(*names).collect()) == want and want


def test_events_of_one_second_are_told_once(spark, tmp_path):
    at = lambda us: T(2024, 1, 1, 0, 0, 11, us)
    rows = [(1, at(5), 1, "view", 1.0, '{"k": 3}'), (2, at(900_000), 1, "view", 1.0, '{"k": 13}'), (3, T(2024, 1, 1, 0, 0, 12), 2, "view", 1.0, '{"k": 3}')]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    _sql_equals(spark, "merge_keywords_max", tmp_path, events=events)


def test_pages_of_one_address_are_letters_of_their_own(spark, tmp_path):
    pages = spark.createDataFrame([(i, "http://same" if i % 4 < 2 else f"http://{i}", "<title>t</title>") for i in range(40)], "page_id bigint, url string, html string")
    _sql_equals(spark, "dead_letter_routing", tmp_path, pages=pages)


def test_merge_stores_rows_once(spark, tmp_path):
    table = MonthTable(spark, f"{tmp_path}/t", ["k"], "time")
    rows = lambda *r: spark.createDataFrame(list(r), "k string, time timestamp_ntz, n int")
    table.append(rows(("a", T(2024, 1, 5), 1), ("b", T(2024, 2, 5), 1), ("c", T(2024, 2, 6), 1)))
    staged = stored(rows(("b", T(2024, 2, 7), 2), ("c", T(2024, 3, 1), 2)), f"{tmp_path}/staged")
    before = set(os.listdir(shared_folder(spark).removeprefix("file:")))
    assert table.merge(staged, lambda c, s: c.join(s, "k", "left_anti").unionByName(s), read_back=True) == ["2024-02", "2024-03"]
    assert set(os.listdir(shared_folder(spark).removeprefix("file:"))) == before  # before, staged rows and then all rows were stored again
    table.replace(table.of_months(["2024-03"]).where("n > 2"), ["2024-03"])
    assert table.months() == ["2024-01", "2024-02"]
    assert sorted((r.k, r.n) for r in table.read().collect()) == [("a", 1), ("b", 2)]


def test_chat_records_are_told_by_their_own_paths(spark):
    df = spark.createDataFrame([('{"prompt": "p", "completion": "c"}', "OBJECT<messages:ARRAY<OBJECT<content,role>>>")], "record string, paths string")
    assert chat_format.format_records(df, paths="paths").first().layout == "prompt"  # before, the paths given were hashed and the record was not read


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_articles_are_dealt_once_in_bounded_parts(spark, tmp_path):
    spark.createDataFrame([(i, f"some words of text {i}", "en", "web", 20) for i in range(20)], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    docs = registry._docs(spark, str(tmp_path))
    kw = keywords.article_keywords(keywords.tokenize(docs))
    assert _exchanges(keywords.keyword_pairs(keywords.representative_keywords(kw))) == 1  # before, words of an article were dealt again to be counted
    assert fixtures.spread(docs, "url", 100).rdd.getNumPartitions() > spark.sparkContext.defaultParallelism  # before, a part for each core at any size


def _keyword_rows(spark):
    rows = [("p", "d", f"u{i % 7}", T(2024, 1, 1, 0, i % 40), w, 1 + i % 3) for i in range(7) for w in ("the", "of", f"w{i}", f"x{i}", f"y{i}")]
    return spark.createDataFrame(rows, "provider string, domain string, url string, event_time timestamp_ntz, keyword string, keyword_count bigint")


def test_purge_deals_no_table_by_word(spark):
    kw = _keyword_rows(spark)
    kept, counts = dictionary.purge_words({"keywords": kw, "trends": keywords.keyword_trends(kw)}, spark.createDataFrame([("the",)], "word string"))
    assert dict(map(tuple, counts.collect())) == {"keywords": 7, "trends": 1} and kept["keywords"].count() == 28
    assert "SortMergeJoin" not in counts._jdf.queryExecution().executedPlan().toString()  # before, all rows of all tables met the words by word


def test_ranks_and_windows_made_once_give_the_same(spark):
    kw = _keyword_rows(spark)
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(keywords.representative_keywords(keywords.ranked_keywords(kw), 2)) == rows(keywords.representative_keywords(kw, 2))
    assert rows(keywords.dealt_trends(kw)) == rows(keywords.keyword_trends(kw))
    start, end = T(2024, 1, 1), T(2024, 1, 1, 0, 30)
    assert rows(serving.mention_totals(keywords.windowed_keywords(kw), start, end)) == rows(serving.mention_totals(keywords.keyword_trends(kw), start, end))


def _folder(spark, tmp_path):
    spark.createDataFrame([(i, f"this text {i % 3} holds this and that", "en", "web", 20) for i in range(20)], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_texts_read_more_than_once_are_tokenised_once(spark, tmp_path):
    folder = _folder(spark, tmp_path)
    for name in ("merge_relations_sum", "review_decisions", "review_dictionary"):
        files = registry.QUERIES[name](spark, folder).inputFiles()
        assert files and not any("documents" in f for f in files), name  # before, texts were read for each use


def test_runs_of_arrays_are_those_of_rows(spark):
    words = {f"u{i}": [("ab", "cd", "ef", "gh")[i * j % 4] for j in range(i)] for i in range(12)}
    rows = spark.createDataFrame([(u, "d", j, w, j, j + (0 if j % 5 == 4 else 1)) for u, ws in words.items() for j, w in enumerate(ws)], "doc_key string, domain string, pos int, token string, start int, end int")
    arrays = rows.groupBy("doc_key", "domain").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token", "start", "end"))), lambda s: F.struct(s["token"].alias("token"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))
    got, want = (sorted(map(tuple, keywords.mine_compounds(x).collect())) for x in (arrays, rows))
    assert got == want and want
    docs = spark.createDataFrame([("u1", "d", "Ab 1 cd"), ("u2", "d", None), ("u3", "d", "")], "url string, domain string, article_text string")
    assert [[s.token for s in r.spans or ()] for r in dictionary.whitespace_spans(docs).collect()] == [["ab", "cd"], [], []]


def test_lines_of_an_order_are_dealt_once(spark):
    orders = spark.createDataFrame([(1, "1-URGENT", T(2024, 1, 1), 7, "P")], "o_orderkey bigint, o_orderpriority string, o_orderdate timestamp_ntz, o_custkey bigint, o_orderstatus string")
    lines = spark.createDataFrame([(1, 3), (1, 3), (1, 4)], "l_orderkey bigint, l_suppkey bigint")
    log = fixtures.keywords_from_lines(orders, lines)
    pairs = keywords.keyword_pairs(keywords.representative_keywords(log), also=("o_orderstatus",))
    assert _exchanges(pairs) == 2  # before: counted, joined, ranked and paired after a shuffle each
    assert [(r.keyword_a, r.keyword_b, r.o_orderstatus) for r in pairs.collect()] == [("s3", "s4", "P")]


def test_feeds_of_a_run_are_parsed_once(spark, tmp_path):
    documents = spark.createDataFrame([("http://f/1", "<rss><channel><item><title>t</title><link>http://a/1</link></item></channel></rss>"), ("http://f/2", "<rss>")], "url string, content string")
    catalog = spark.createDataFrame([("p", "n", "d", "http://f/1"), ("q", "n", "d", "http://f/2")], "publisher string, feed_name string, domain string, url string")
    articles, results = feeds.feed_articles(documents, catalog, store=f"{tmp_path}/parsed")
    assert "MapInArrow" not in articles._jdf.queryExecution().executedPlan().toString() + results._jdf.queryExecution().executedPlan().toString()
    assert [r.url for r in articles.collect()] == ["http://a/1"] and {r.key: r.ok for r in results.collect()} == {"p::d::n": True, "q::d::n": False}


def test_articles_equal_in_time_and_title_are_told_by_other_columns(spark):
    rows = [("p", "d", f"u{i % 3}", T(2024, 1, 1), T(2024, 1, 1), None if i % 3 else "t", i) for i in range(60)]
    schema = "provider string, domain string, url string, ingested_at timestamp_ntz, published_at timestamp_ntz, title string, doc_id bigint"
    for some in (rows, rows[::-1], rows[30:] + rows[:30]):
        got = merge.latest(spark.createDataFrame(some, schema).repartition(5))
        assert sorted(r.doc_id for r in got.collect()) == [57, 58, 59]  # before, any of them, by the order in which they came


def test_shuffle_files_go_with_the_next_step(spark, tmp_path):
    base = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for top in base for f in glob.glob(f"{top}/*/shuffle_*.data")}
    before = files()
    table = MonthTable(spark, f"{tmp_path}/t", ["k"], "time")
    rows = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id") % 5000).alias("k"), F.lit(T(2024, 1, 5)).alias("time"))
    counted = stored(rows.groupBy("k", "time").agg(F.count("*").alias("n")))
    first = files() - before
    table.append(counted)
    for _ in range(100):
        if not first & files():
            break
        time.sleep(0.1)
    assert not first & files()  # before, those of all steps stood beside each other until the driver happened to collect its garbage
    assert table.read().count() == 5000


def test_a_merge_leaves_no_staged_rows(spark, tmp_path):
    table = MonthTable(spark, f"{tmp_path}/t", ["k"], "time")
    before = set(os.listdir(shared_folder(spark).removeprefix("file:")))
    table.merge(spark.createDataFrame([("a", T(2024, 1, 5))], "k string, time timestamp_ntz"), lambda c, s: c.join(s, "k", "left_anti").unionByName(s))
    assert set(os.listdir(shared_folder(spark).removeprefix("file:"))) == before  # before, they stayed beside the table
    assert table.read().count() == 1


def test_a_dry_run_stands_on_articles_alone(spark, tmp_path):
    _sql_equals(spark, "backfill_dry_run", tmp_path, documents=spark.createDataFrame([(i, f"a text\nof the kind {i % 3}", "en", "web", 20) for i in range(2000)], "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    tables, _ = stored_queries._backfilled(spark, str(tmp_path), True)
    assert os.listdir(os.path.dirname(tables.articles.path.removeprefix("file:"))) == ["articles"]  # before, three tables were made that no dry run reads


def test_partners_of_a_keyword_are_dealt_together(spark):
    words = ["a", "b", "b\x1fc", "b\x1ec", "\x1e1", "\x1e2\x1f", "", "d e", "가"]
    counts = {(u, w): 1 + (u * 7 + i) % 4 for u in range(5) for i, w in enumerate(words) if (u + i) % 3}
    rows = [("p", f"d{u % 2}", f"u{u}", w, n) for (u, w), n in counts.items()]
    kw = spark.createDataFrame(rows, "provider string, domain string, url string, keyword string, keyword_count bigint")
    got = keywords.min_count_relations(kw)
    plan = got._jdf.queryExecution().executedPlan().toString()
    want = {}
    for (u, a), n in counts.items():
        for (v, b), m in counts.items():
            if u == v and a.encode() < b.encode():
                want["p", f"d{u % 2}", a, b] = want.get(("p", f"d{u % 2}", a, b), 0) + min(n, m)
    assert {tuple(r)[:4]: r.cooccurrence_count for r in got.collect()} == want and want
    assert plan.index("Exchange hashpartitioning") > plan.index("posexplode(split(")  # before, each pair was shuffled as a row of its own
