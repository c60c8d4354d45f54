"""Dictionaries: stopword signals, purges, backfills, reviews and change sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bound, clean_text, compact, decide
from ..schemas import ARTICLE_KEY
from ..sources.months import MONTH, MonthTable
from .keywords import _windowed, keyword_pairs, keyword_relations, keyword_trends, representative_keywords

WEIGHTS = {"domain_breadth": 0.30, "repetition": 0.20, "stability": 0.25, "cooccurrence_breadth": 0.15, "short_word": 0.10}
WINDOW = ["provider", "domain", "window_start"]


def eligible_keywords(trends: DataFrame, as_of, days: int = 7, min_mentions: int = 10) -> DataFrame:
    recent = trends.where((F.col("window_start") >= F.lit(as_of) - F.make_dt_interval(days=F.lit(days))) & (F.col("window_start") < as_of))
    return recent.groupBy("keyword", "domain").agg(F.sum("keyword_count").alias("n")).where(F.col("n") >= min_mentions)


def partners(keyword_set: DataFrame, relations: DataFrame) -> DataFrame:
    """(keyword, partner) of either side; two equi-joins for the OR condition."""
    a = relations.select(F.col("keyword_a").alias("keyword"), F.col("keyword_b").alias("partner"))
    both = a.union(relations.select("keyword_b", "keyword_a")).distinct()
    return both.join(keyword_set.select("keyword").distinct(), "keyword", "left_semi")


def stopword_signals(trends: DataFrame, keywords: DataFrame, relations: DataFrame, n_domains: int, as_of, days: int = 7) -> DataFrame:
    """Signals of keywords mentioned often enough: breadth, repetition, stability, partners, shortness."""
    base = eligible_keywords(trends, as_of, days).groupBy("keyword").agg(F.least(F.lit(1.0), F.countDistinct("domain") / n_domains).alias("domain_breadth"), F.sum("n").alias("frequency"))
    recent = trends.where((F.col("window_start") >= F.lit(as_of) - F.make_dt_interval(days=F.lit(days))) & (F.col("window_start") < as_of))
    repeated = keywords.groupBy("keyword").agg(F.least(F.lit(1.0), F.avg("keyword_count") / 5).alias("repetition"))
    steady = recent.groupBy("keyword").agg(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.stddev_samp("keyword_count") / F.avg("keyword_count"))).alias("stability"))
    near = partners(base, relations).groupBy("keyword").agg(F.least(F.lit(1.0), F.countDistinct("partner") / 50).alias("cooccurrence_breadth"))
    out = base
    for part in (repeated, steady, near):
        out = out.join(part, "keyword", "left")
    return out.fillna(0.0, ["repetition", "stability", "cooccurrence_breadth"]).withColumn("short_word", F.length("keyword") <= 2)


def stopword_scores(signals: DataFrame, threshold: float = 0.45, most: int = 500, known: DataFrame | None = None) -> DataFrame:
    """Weighted scores of the `most` broadest keywords that reach the threshold and are not known."""
    top = signals.orderBy(F.desc("domain_breadth"), F.desc("frequency"), "keyword").limit(most)
    if known is not None:
        top = top.join(known.select(F.col("word").alias("keyword")).distinct(), "keyword", "left_anti")
    total = sum((F.col(k).cast("double") * w for k, w in WEIGHTS.items()), F.lit(0.0))
    return top.select("keyword", "frequency", F.round(total, 4).alias("score")).where(F.col("score") >= threshold)


def merge_found(current: DataFrame, found: DataFrame, keys: list[str], now, add: tuple[str, ...] = (), replace: tuple[str, ...] = (), open_status: str = "needs_review") -> DataFrame:
    """Candidates after a run that found some, by stored status x found, with `change`: new, updated or null.

    New words enter with the open status and both times `now`; words whose status is
    open add the columns in `add` to theirs, take those in `replace` and are seen `now`;
    decided words stay as they are.  Both sides have one row a key.
    """
    values = (*add, *replace)
    both = current.join(found.select(*keys, *(F.col(c).alias(f"_{c}") for c in values), F.lit(True).alias("_found")), keys, "full_outer")
    new = F.col("status").isNull() & F.col("_found")
    hit = (F.col("status") == open_status) & F.col("_found")
    updated = {c: F.when(new, F.col(f"_{c}")).when(hit, F.col(c) + F.col(f"_{c}") if c in add else F.col(f"_{c}")).otherwise(F.col(c)) for c in values}
    updated |= {"first_seen_at": F.when(new, F.lit(now)).otherwise(F.col("first_seen_at")), "last_seen_at": F.when(new | hit, F.lit(now)).otherwise(F.col("last_seen_at")), "status": F.when(new, F.lit(open_status)).otherwise(F.col("status"))}
    change = F.when(new, "new").when(hit, "updated")
    return both.select(*(updated.get(c, F.col(c)).alias(c) for c in current.columns), change.alias("change"))


def merge_mined(current: DataFrame, mined: DataFrame, now) -> DataFrame:
    """Compound candidates by word and domain: frequency and doc_count add up."""
    return merge_found(current, mined, ["word", "domain"], now, add=("frequency", "doc_count"))


def merge_recommended(current: DataFrame, scored: DataFrame, now) -> DataFrame:
    """Stopword candidates of domain 'all', language 'ko': score, signals and frequency are those of the last run."""
    signals = ("score", "domain_breadth", "repetition", "stability", "cooccurrence_breadth", "short_word", "frequency")
    found = scored.withColumnRenamed("keyword", "word").withColumns({"domain": F.lit("all"), "language": F.lit("ko")})
    return merge_found(current, found, ["word", "domain", "language"], now, replace=signals)


def merge_outcome(merged: DataFrame) -> DataFrame:
    """One row: new and updated candidates of a merge."""
    return merged.agg(F.count_if(F.col("change") == "new").alias("new"), F.count_if(F.col("change") == "updated").alias("updated"))


def recommend_stopwords(signals: DataFrame, candidates: DataFrame, stopwords: DataFrame, now, threshold: float = 0.45, most: int = 500) -> DataFrame:
    """Candidates after a run of the recommender: `most` broadest keywords, those known left out, scored, merged by status.  signals: of `stopword_signals`."""
    scored = stopword_scores(signals, threshold, most, excluded_words(stopwords, candidates))
    rounded = {c: F.round(c, 4) for c in ("domain_breadth", "repetition", "stability", "cooccurrence_breadth")}
    return merge_recommended(candidates, signals.withColumns(rounded).drop("frequency").join(scored, "keyword"), now)


def review_queue(candidates: DataFrame, as_of, limit: int = 2000) -> DataFrame:
    stale = F.col("auto_checked_at").isNull() | (F.col("auto_checked_at") < F.lit(as_of) - F.make_dt_interval(days=F.lit(3))) | (F.col("last_seen_at") > F.col("auto_checked_at")) | (F.col("auto_decision") == "api_error")
    return candidates.where((F.col("status") == "needs_review") & stale).orderBy(F.desc("frequency"), F.desc("doc_count"), F.desc("last_seen_at"), "word", "domain").limit(limit)


def exact_match(candidates: DataFrame, evidence: DataFrame) -> DataFrame:
    """First evidence item whose compact title, else description, holds the compact word."""
    rows = candidates.select("word").distinct().join(evidence, "word", "left")
    squeeze = lambda c: F.lower(compact(c))
    in_title, in_text = (F.coalesce(F.contains(squeeze(F.col(c)), squeeze(F.col("word"))), F.lit(False)) for c in ("title", "description"))
    hit = F.when(in_title | in_text, F.struct(F.when(in_title, 0).otherwise(1).alias("side"), "position", F.when(in_title, F.col("title")).otherwise(F.col("description")).alias("text"), "link"))
    first = F.min_by(hit, F.when(hit.isNotNull(), F.struct(F.col("position"), F.when(in_title, 0).otherwise(1))))
    return rows.groupBy("word").agg(F.max("ok").alias("ok"), F.max("total").alias("total"), first.alias("match"))


def review_candidates(candidates: DataFrame, evidence: DataFrame, generic: DataFrame) -> DataFrame:
    """Candidates with their decision and new status; approved words go to the dictionary by `approved_words`."""
    rows = candidates.join(exact_match(candidates, evidence), "word", "left").join(generic.select("word", F.lit(True).alias("_generic")).distinct(), "word", "left")
    made = decide(F.col("ok"), F.col("total"), F.col("match").isNotNull(), F.col("word"), F.col("_generic"), F.col("doc_count"), F.col("frequency"))
    rows = rows.withColumn("auto_decision", made).drop("_generic")
    status = F.when(F.col("auto_decision") == "high_confidence", "approved").when(F.col("auto_decision").isin("no_search_results", "no_exact_match"), "rejected").otherwise(F.col("status"))
    return rows.withColumn("status", status)


def review_outcome(reviewed: DataFrame) -> DataFrame:
    """Candidates per decision of a review, and how many of them were approved or rejected by it."""
    return reviewed.groupBy("auto_decision").agg(F.count("*").alias("candidates"), F.count_if(F.col("status") == "approved").alias("approved"), F.count_if(F.col("status") == "rejected").alias("rejected"))


def simple_review(candidates: DataFrame, evidence: DataFrame, reviewed_at, limit: int = 200, by: str = "auto-approver") -> DataFrame:
    """Candidates after the simple review, with `outcome`: auto_approved, needs_review, or null for those not reviewed.

    The `limit` most frequent open or pending ones are looked up; evidence: word, total.
    Any found are approved, other pending ones go to review.
    """
    keys = ["word", "domain"]
    open_ = candidates.where(F.col("status").isin("needs_review", "pending")).orderBy(F.desc("frequency"), *keys).limit(limit)
    found = evidence.groupBy("word").agg(F.max("total").alias("_total"))
    looked = open_.select(*keys).join(found, "word", "left").select(*keys, (F.coalesce("_total", F.lit(0)) > 0).alias("_ok"))
    rows = candidates.join(looked, keys, "left")
    changed = {
        "status": F.when(F.col("_ok"), "approved").when(F.col("_ok").isNotNull() & (F.col("status") == "pending"), "needs_review").otherwise(F.col("status")),
        "reviewed_at": F.when(F.col("_ok"), F.lit(reviewed_at)).otherwise(F.col("reviewed_at")),
        "reviewed_by": F.when(F.col("_ok"), by).otherwise(F.col("reviewed_by")),
    }
    outcome = F.when(F.col("_ok"), "auto_approved").when(~F.col("_ok"), "needs_review").alias("outcome")
    return rows.select(*(changed.get(c, F.col(c)).alias(c) for c in candidates.columns), outcome)


def simple_review_counts(reviewed: DataFrame) -> DataFrame:
    """One row: total, auto_approved, needs_review."""
    return reviewed.agg(F.count("outcome").alias("total"), *(F.count_if(F.col("outcome") == o).alias(o) for o in ("auto_approved", "needs_review")))


def excluded_words(stopwords: DataFrame, candidates: DataFrame) -> DataFrame:
    """Words that are not recommended again: stopwords, and candidates that were decided."""
    return stopwords.select("word").union(candidates.where(F.col("status").isin("approved", "rejected")).select("word")).distinct()


def review_decisions(candidates: DataFrame, decisions: DataFrame, dictionary: DataFrame, reviewed_at, source: str = "auto-approved") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(candidates, dictionary, audit rows) after a reviewer's decisions: word, domain, action approved or rejected, actor; approved words enter the dictionary once."""
    made = decisions.select("word", "domain", F.col("action").alias("_action"), F.col("actor").alias("_actor"))
    rows = candidates.join(made, ["word", "domain"], "left")
    now = F.when(F.col("_action").isNotNull(), F.lit(reviewed_at)).otherwise(F.col("reviewed_at")).alias("reviewed_at")
    changed = {"status": F.coalesce("_action", "status").alias("status"), "reviewed_at": now, "reviewed_by": F.coalesce("_actor", "reviewed_by").alias("reviewed_by")}
    after = rows.select(*(changed.get(c, F.col(c)) for c in candidates.columns))
    approved = rows.where("_action = 'approved'").select("word", "domain", F.lit("approved").alias("status"))
    audit = rows.where("_action is not null").select("word", "domain", F.col("_action").alias("action"), F.col("status").alias("before_status"), F.col("_action").alias("after_status"), F.col("_actor").alias("actor"), F.lit(reviewed_at).alias("acted_at"))
    return after, approved_words(dictionary, approved, source), audit


def approved_words(dictionary: DataFrame, reviewed: DataFrame, source: str) -> DataFrame:
    new = reviewed.where("status = 'approved'").select("word", "domain", F.lit(source).alias("source")).distinct()
    return dictionary.unionByName(new.join(dictionary, ["word", "domain"], "left_anti").select(*dictionary.columns))


def apply_changes(dictionary: DataFrame, changes: DataFrame, acted_at) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new dictionary, audit rows, conflicts); changes: action add, update or delete, word, domain, source, actor."""
    keys = ["word", "domain"]
    old = dictionary.select(*keys, F.struct(*dictionary.columns).alias("before"))
    rows = changes.join(old, keys, "left").withColumn("after", F.when(F.col("action") != "delete", F.struct(*dictionary.columns)))
    conflict = ((F.col("action") == "add") & F.col("before").isNotNull()) | ((F.col("action") != "add") & F.col("before").isNull())
    done = rows.where(~conflict)
    text = lambda c: F.to_json(c, {"ignoreNullFields": "false"})
    audit = done.select("word", "domain", "action", text("before").alias("before_json"), text("after").alias("after_json"), "actor", F.lit(acted_at).alias("acted_at"))
    kept = dictionary.join(done, keys, "left_anti").unionByName(done.where("action <> 'delete'").select("after.*"))
    return kept, audit, rows.where(conflict).select(*keys, "action")


def next_versions(versions: DataFrame, audit: DataFrame, name: str) -> DataFrame:
    """The version of a dictionary grows by one for each changed row."""
    n = audit.groupBy(F.lit(name).alias("dict_name")).agg(F.count("*").alias("_n"))
    return versions.join(n, "dict_name", "left").select("dict_name", (F.col("version") + F.coalesce("_n", F.lit(0))).alias("version"))


def _purged(name: str, df: DataFrame, words: DataFrame) -> tuple[DataFrame, Column]:
    """Rows marked by the words on either side, and the test of those that go; staging tables, named stg_*, count for any domain."""
    scopes = words.groupBy("word").agg(F.collect_set(F.coalesce("domain", F.lit("all")) if "domain" in words.columns else F.lit("all")).alias("_in"))
    columns = [c for c in ("keyword", "keyword_a", "keyword_b") if c in df.columns]
    for c in columns:
        # words are a curated list: tables are not dealt by word for it
        df = df.join(F.broadcast(scopes.withColumnsRenamed({"word": c, "_in": f"_{c}_in"})), c, "left")
    anywhere = F.lit(name.startswith("stg_") or "domain" not in df.columns)
    hit = lambda c: F.col(f"_{c}_in").isNotNull() & (anywhere | F.array_contains(f"_{c}_in", "all") | (F.array_contains(f"_{c}_in", F.col("domain")) if "domain" in df.columns else F.lit(False)))
    gone = F.lit(False)
    for c in columns:
        gone = gone | F.coalesce(hit(c), F.lit(False))
    return df, gone


def purge_words(tables: dict[str, DataFrame], words: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables without rows of the words (word, and domain: one, or 'all'), on either side of a pair, and the rows removed per table."""
    out, counts = {}, None
    for name, df in tables.items():
        marked, gone = _purged(name, df, words)
        out[name] = marked.where(~gone).select(*df.columns)
        # a table of one keyword column is counted from the rows of the words alone: the semi-join goes below the sums that made the table
        some, gone = _purged(name, df.join(F.broadcast(words.select(F.col("word").alias("keyword")).distinct()), "keyword", "left_semi"), words) if "keyword" in df.columns else (marked, gone)
        n = some.agg(F.count_if(gone).alias("removed")).select(F.lit(name).alias("name"), "removed")
        counts = n if counts is None else counts.union(n)
    return out, counts


def purge_months(tables: dict[str, MonthTable], words: DataFrame) -> dict[str, int]:
    """Rows of the words removed from stored tables, per table.  One scan of keys counts them by month; only months that hold some are rewritten."""
    removed = {}
    for name, table in tables.items():
        rows = table.spark.read.parquet(table.path).withColumn(MONTH, F.col(MONTH).cast("string"))
        marked, gone = _purged(name, rows, words)
        found = {r[MONTH]: r["n"] for r in marked.where(gone).groupBy(MONTH).agg(F.count("*").alias("n")).collect()}  # a row a month
        if found:
            kept, gone = _purged(name, table.of_months(found), words)
            table.replace(kept.where(~gone).select(*(c for c in rows.columns if c != MONTH)), found)
        removed[name] = sum(found.values())
    return removed


def whitespace_spans(articles: DataFrame) -> DataFrame:
    """(doc_key, domain, spans): token spans of cleaned texts in which a blank counts as touching, a row an article."""
    words = F.filter(F.split(clean_text(F.col("article_text")), " "), lambda w: w != "")
    spans = bound(words, lambda s: F.transform(s, lambda w, i: F.struct(w.alias("token"), i.alias("start"), (i + 1).alias("end"))))
    return articles.select(F.col("url").alias("doc_key"), "domain", spans.alias("spans"))


def articles_containing(articles: DataFrame, word: str, domain: str | None = None) -> DataFrame:
    rows = articles.where(F.contains(compact(F.col("article_text")), F.lit("".join(word.split()))))
    return rows if not domain or domain == "all" else rows.where(F.col("domain") == domain)


def recompute_windows(keywords: DataFrame, affected: DataFrame, width: str = "10 minutes") -> tuple[DataFrame, DataFrame]:
    """Trends and relations of every window that an affected article lies in, from all articles in it."""
    windows = _windowed(affected.select("provider", "domain", "event_time"), "event_time", width).select(*WINDOW).distinct()
    log = _windowed(keywords, "event_time", width).join(windows, WINDOW, "left_semi").drop("window_start", "window_end")
    return keyword_trends(log, width), keyword_relations(keyword_pairs(representative_keywords(log)), width)


def backfill_counts(keywords: DataFrame, hit: DataFrame, width: str = "10 minutes") -> DataFrame:
    parts = {
        "articles": hit.select(*ARTICLE_KEY),
        "keywords": keywords.join(hit, ARTICLE_KEY, "left_semi").select(*ARTICLE_KEY),
        "windows": _windowed(hit.select("provider", "domain", "event_time"), "event_time", width).select(*WINDOW).distinct().select("provider", "domain", F.col("window_start").cast("string")),
    }
    rows = None
    for name, df in parts.items():
        part = df.toDF("a", "b", "c").select(F.lit(name).alias("name"))
        rows = part if rows is None else rows.union(part)
    return rows.agg(*(F.count_if(F.col("name") == n).alias(n) for n in parts))


def dictionary_overview(**tables: DataFrame) -> DataFrame:
    rows = None
    for name, df in tables.items():
        part = df.select(F.lit(name).alias("name"))
        rows = part if rows is None else rows.union(part)
    return rows.agg(*(F.count_if(F.col("name") == n).alias(n) for n in tables))
