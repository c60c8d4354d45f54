"""Keywords of articles, their windows and pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import BUCKETS, MAX_PARTS, bucket, listed, lower_text, merge_compounds, tokens, touching_runs
from ..schemas import ARTICLE_KEY

ARTICLE = [*ARTICLE_KEY, "event_time"]


def scoped_words(words: DataFrame, domains: DataFrame) -> DataFrame:
    """(domain, words): for each domain its own dictionary words and those of domain 'all'; 'all' itself has every word."""
    names = domains.select("domain").distinct()
    own = names.join(words, "domain").select("domain", "word")
    shared = words.where("domain = 'all'").groupBy(F.lit(1).alias("_one")).agg(F.collect_set("word").alias("shared"))  # one row
    shared = names.withColumn("_one", F.lit(1)).join(F.broadcast(shared), "_one").select("domain", F.explode("shared").alias("word"))
    every = words.select(F.lit("all").alias("domain"), "word")
    return own.union(shared).union(every).groupBy("domain").agg(F.sort_array(F.collect_set("word")).alias("words"))


def _dealt(words: DataFrame, name: str) -> DataFrame:
    """Word lists (domain, words) as (domain, name, name_window): each list dealt by `bucket`, so that a look-up costs the same for any list, and the `compound_window` of its words."""
    dealt = words.select("domain", F.explode("words").alias("word")).groupBy("domain", bucket(F.col("word")).alias("bucket"))
    dealt = dealt.agg(F.collect_set("word").alias("some"), F.max(F.length("word")).alias("longest"))
    lists = dealt.groupBy("domain").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "some"))).alias("by_bucket"), F.max("longest").alias("longest"))
    window = F.least(F.lit(MAX_PARTS), F.greatest(F.lit(2), "longest"))
    return lists.select("domain", F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.col("by_bucket")[b]).alias(name), window.alias(f"{name}_window"))


def tokenize(articles: DataFrame, text: str = "article_text", stopwords: DataFrame | None = None, compounds: DataFrame | None = None, spans: bool = False) -> DataFrame:
    """Adds tokens: cleaned words of one script without stopwords, compounds merged, filtered again.

    With spans, articles come from `analysis.analyse_articles`: the analyser's tokens are
    used, compounds are merged of tokens that touch, and stopwords and single letters go
    once after that; an article of which nothing is left takes the words as above.
    """
    out = articles
    for name, words in (("_stop", stopwords), ("_compound", compounds)):
        # dictionaries are curated word lists, one row per domain after grouping; articles are not dealt by domain for them
        out = out if words is None else out.join(F.broadcast(_dealt(words, name)), "domain", "left")
    no_stop = lambda words: words if stopwords is None else F.filter(words, lambda t: ~listed(F.col("_stop"), t))
    kept = lambda words: no_stop(F.filter(words, lambda t: F.length(t) > 1))
    merged = lambda words, **also: merge_compounds(words, F.col("_compound"), window=F.coalesce("_compound_window", F.lit(2)), **also)
    out = out.withColumn("tokens", no_stop(tokens(F.col("cleaned") if spans else lower_text(F.coalesce(F.col(text), F.lit(""))))))
    if compounds is not None:
        out = out.withColumn("tokens", kept(merged(F.col("tokens"))))
    if spans:
        found = F.transform("spans", lambda s: s["token"])
        if compounds is not None:
            found = merged(found, spans=F.col("spans"), text=F.col("cleaned"))
        out = out.withColumn("_found", kept(found)).withColumn("tokens", F.when(F.size("_found") > 0, F.col("_found")).otherwise(F.col("tokens")))
    return out.drop("_stop", "_stop_window", "_compound", "_compound_window", "_found")


def article_keywords(tokenized: DataFrame, min_len: int = 2) -> DataFrame:
    """keyword_count per article and keyword."""
    # explode would also be inferred as a filter on the size of tokens, for which every text were tokenised twice
    words = tokenized.select(*ARTICLE, F.explode_outer("tokens").alias("keyword"))
    return words.where(F.length("keyword") >= min_len).groupBy(*ARTICLE, "keyword").agg(F.count("*").alias("keyword_count"))


def _windowed(df: DataFrame, time: str, width: str) -> DataFrame:
    return df.withColumn("_w", F.window(time, width)).withColumns({"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}).drop("_w")


def keyword_trends(keywords: DataFrame, width: str = "10 minutes") -> DataFrame:
    return _windowed(keywords, "event_time", width).groupBy("provider", "domain", "window_start", "window_end", "keyword").agg(F.sum("keyword_count").alias("keyword_count"))


def windowed_keywords(keywords: DataFrame, width: str = "10 minutes") -> DataFrame:
    """Keywords with their windows, not summed: for totals over whole windows, which are the same as those of `keyword_trends`."""
    return _windowed(keywords, "event_time", width).select("provider", "domain", "window_start", "window_end", "keyword", "keyword_count")


def windowed_articles(articles: DataFrame, width: str = "10 minutes") -> DataFrame:
    """The windows in which articles lie, each once."""
    return _windowed(articles.select("provider", "domain", "event_time"), "event_time", width).select("provider", "domain", "window_start", "window_end").distinct()


def dealt_trends(keywords: DataFrame, width: str = "10 minutes") -> DataFrame:
    """`keyword_trends` where articles of a window share few keywords: rows are dealt by window as they are, as sums before would merge next to none of them."""
    rows = windowed_keywords(keywords, width).repartition("provider", "domain", "window_start")
    return rows.groupBy("provider", "domain", "window_start", "window_end", "keyword").agg(F.sum("keyword_count").alias("keyword_count"))


def ranked_keywords(keywords: DataFrame) -> DataFrame:
    """Keywords with their rank in their article, from 1: the most frequent first, ties by keyword."""
    return keywords.withColumn("rank", F.row_number().over(W.partitionBy(*ARTICLE).orderBy(F.desc("keyword_count"), "keyword")))


def representative_keywords(keywords: DataFrame, limit: int = 4) -> DataFrame:
    """The most frequent keywords of each article; keywords that have their rank are not ranked again."""
    ranked = keywords if "rank" in keywords.columns else ranked_keywords(keywords)
    return ranked.where(F.col("rank") <= limit)


def keyword_pairs(ranked: DataFrame, order: str = "sorted", also: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of an article's ranked keywords, one shuffle; order 'sorted' by name or 'rank'.  `also`: further columns of an article that stay."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "keyword")))
    lists = ranked.groupBy(*ARTICLE, *also).agg(F.transform(ordered, lambda s: s["keyword"]).alias("k"))
    later = lambda a, i: F.transform(F.slice("k", i + 2, F.size("k")), lambda b: F.struct(a.alias("a"), b.alias("b")))
    pairs = lists.select(*ARTICLE, *also, F.explode(F.flatten(F.transform("k", later))).alias("p"))
    low, high = (F.least("p.a", "p.b"), F.greatest("p.a", "p.b")) if order == "sorted" else (F.col("p.a"), F.col("p.b"))
    return pairs.select(*ARTICLE, *also, low.alias("keyword_a"), high.alias("keyword_b"))


def keyword_relations(pairs: DataFrame, width: str = "10 minutes") -> DataFrame:
    return _windowed(pairs, "event_time", width).groupBy("provider", "domain", "window_start", "window_end", "keyword_a", "keyword_b").agg(F.count("*").alias("cooccurrence_count"))


def keyword_arrays(keywords: DataFrame) -> DataFrame:
    """Keywords of each article as one array, most frequent first."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("keyword_count")).alias("n"), "keyword")))
    return keywords.groupBy(*ARTICLE_KEY).agg(F.transform(ordered, lambda s: s["keyword"]).alias("keywords"))


def hourly_rollup(keywords: DataFrame, time: str = "processed_at") -> DataFrame:
    start = F.date_trunc("hour", F.col(time))
    out = keywords.groupBy("provider", "domain", start.alias("window_start"), "keyword").agg(F.sum("keyword_count").alias("keyword_count"))
    return out.withColumn("window_end", F.col("window_start") + F.expr("interval 1 hour"))


def min_count_relations(keywords: DataFrame, most: int | None = None, parts: int = 0) -> DataFrame:
    """All pairs of an article's keywords, from one list per article; weight is the sum of the smaller counts.

    `most` bounds the keywords of an article that are paired, the most frequent first; None, the default, pairs all.
    Pairs are summed in `parts` parts, at least in those that Spark has for a shuffle.
    """
    if most is not None:
        keywords = representative_keywords(keywords.withColumn("event_time", F.lit(None).cast("timestamp_ntz")), most)
    lists = keywords.groupBy(*ARTICLE_KEY).agg(F.array_sort(F.collect_list(F.struct("keyword", "keyword_count"))).alias("k"))
    firsts = lists.select("provider", "domain", F.posexplode("k").alias("at", "a"), "k").where(F.col("at") + 1 < F.size("k"))
    # few pairs repeat within a task, so a keyword is dealt with all its partners in one text, which takes a fraction of their rows; it is parted where pairs are summed
    later = F.slice("k", F.col("at") + 2, F.size("k"))
    joined = F.array_join(F.transform(later, lambda b: _without(_MARK, b["keyword"])), _MARK[0])
    parts = max(int(keywords.sparkSession.conf.get("spark.sql.shuffle.partitions")), parts)
    dealt = firsts.select("provider", "domain", F.col("a.keyword").alias("keyword_a"), joined.alias("joined"), F.transform(later, lambda b: F.least("a.keyword_count", b["keyword_count"])).alias("weights"))
    dealt = dealt.repartition(parts, "domain", "keyword_a")  # a provider may be a literal, by which Spark would not see that pairs are dealt already
    pairs = dealt.select("provider", "domain", "keyword_a", "weights", F.posexplode(F.split("joined", _MARK[0])).alias("at", "b"))
    pairs = pairs.select("provider", "domain", "keyword_a", _again(_MARK, F.col("b")).alias("keyword_b"), F.get("weights", F.col("at")).alias("weight"))
    return pairs.groupBy("provider", "domain", "keyword_a", "keyword_b").agg(F.sum("weight").alias("cooccurrence_count"))


#: Parts words that are joined in one text, and marks such characters in words themselves.
_MARK = ("\x1f", "\x1e")


def _without(mark: tuple[str, str], word: Column) -> Column:
    return F.replace(F.replace(word, F.lit(mark[1]), F.lit(f"{mark[1]}2")), F.lit(mark[0]), F.lit(f"{mark[1]}1"))


def _again(mark: tuple[str, str], word: Column) -> Column:
    whole = F.replace(F.replace(word, F.lit(f"{mark[1]}1"), F.lit(mark[0])), F.lit(f"{mark[1]}2"), F.lit(mark[1]))
    return F.when(F.contains(word, F.lit(mark[1])), whole).otherwise(word)


def mine_compounds(spans: DataFrame, max_parts: int = 4, min_chars: int = 4, min_freq: int = 3, exclude: DataFrame | None = None) -> DataFrame:
    """Runs of 2 to max_parts touching tokens, counted per domain and word.  spans: (doc_key, domain, pos, token, start, end), or a row a document (doc_key, domain, spans: array of token, start, end), which needs no order to be made."""
    if "spans" in spans.columns:
        runs = spans.select("doc_key", "domain", F.explode_outer(touching_runs(F.col("spans"), max_parts)).alias("word"))
        return _counted_runs(runs, min_chars, min_freq, exclude)
    w = W.partitionBy("doc_key").orderBy("pos")
    out = spans
    for n in range(1, max_parts):
        touching = F.lead("start", n).over(w) == (F.col("end") if n == 1 else F.lead("end", n - 1).over(w))
        out = out.withColumn(f"_t{n}", F.coalesce(touching, F.lit(False)) & (F.lit(True) if n == 1 else F.col(f"_t{n - 1}"))).withColumn(f"_w{n}", F.lead("token", n).over(w))
    words = F.array(*(F.when(F.col(f"_t{n}"), F.concat("token", *(F.col(f"_w{i}") for i in range(1, n + 1)))) for n in range(1, max_parts)))
    return _counted_runs(out.select("doc_key", "domain", F.explode(words).alias("word")), min_chars, min_freq, exclude)


def _counted_runs(runs: DataFrame, min_chars: int, min_freq: int, exclude: DataFrame | None) -> DataFrame:
    counted = runs.where(F.length("word") >= min_chars).groupBy("domain", "word").agg(F.count("*").alias("frequency"), F.countDistinct("doc_key").alias("doc_count")).where(F.col("frequency") >= min_freq)
    return counted.join(exclude.select("word").distinct(), "word", "left_anti") if exclude is not None else counted
