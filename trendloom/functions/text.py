"""Text and scalar expressions, all native.  Tables of characters are derived from the standard library's."""

from __future__ import annotations

import html.entities
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NAMED = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
MAX_PARTS = 6


def composed_hangul(text: Column) -> Column:
    """Canonical composition of Hangul, by its arithmetic; texts without such letters are left as they are."""
    parts = F.regexp_extract_all(text, F.lit("(?s)[ᄀ-ᄒ][ᅡ-ᅵ][ᆨ-ᇂ]?|[가-힣][ᆨ-ᇂ]|."), F.lit(0))
    code = lambda p, i: F.ascii(F.substring(p, i, 1))
    last = lambda p, i: F.when(F.length(p) >= i, code(p, i) - 0x11A7).otherwise(0)
    letter = lambda n: F.decode(F.unhex(F.hex(n)), "UTF-16BE")

    def joined(p: Column) -> Column:
        whole = F.when(code(p, 1) < 0xAC00, letter(0xAC00 + ((code(p, 1) - 0x1100) * 21 + code(p, 2) - 0x1161) * 28 + last(p, 3)))
        open_ = (code(p, 1) - 0xAC00) % 28 == 0  # a syllable that has no last letter yet
        return F.when(F.length(p) < 2, p).otherwise(F.coalesce(whole, F.when(open_, letter(code(p, 1) + last(p, 2))).otherwise(p)))

    return F.when(text.rlike("[ᄀ-ᄒ][ᅡ-ᅵ]|[가-힣][ᆨ-ᇂ]"), F.array_join(F.transform(parts, joined), "")).otherwise(text)


@cache
def _marks() -> tuple[str, str]:
    """(a class of the marks that Latin letters are composed with, a pattern of the letters that composition joins with one).

    A mark joins its letter unless a mark of the same combining class stands between
    them; marks of other classes may.  I with a dot above is left out, as its lower
    case is i again.
    """
    by_class, letters = defaultdict(list), defaultdict(str)
    for code in range(sys.maxunicode + 1):
        char = chr(code)
        if unicodedata.combining(char):
            by_class[unicodedata.combining(char)].append(code)
        parts = unicodedata.decomposition(char).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            letter, mark = (chr(int(x, 16)) for x in parts)
            if letter.isascii() and letter.isalpha() and letter + mark != "I\u0307" and unicodedata.normalize("NFC", letter + mark) == char:
                letters[mark] += letter

    def chars(codes: list[int]) -> str:
        runs: list[list[int]] = []
        for c in sorted(codes):
            if runs and runs[-1][1] == c - 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
        return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs)

    by_kind = defaultdict(list)
    for mark, some in letters.items():
        by_kind[unicodedata.combining(mark)].append((mark, some))
    joins = []
    for kind, pairs in by_kind.items():
        others = chars([c for k, codes in by_class.items() if k != kind for c in codes])
        joins += [f"[{some}](?=[{others}]*\\x{{{ord(mark):x}}})" for mark, some in pairs]
    return f"[{chars(list(map(ord, letters)))}]", "|".join(joins)


def without_composed(text: Column) -> Column:
    """Latin letters that composition (NFC) would join with a mark, and thus take out of a-z, become blanks.  Texts without marks are left as they are."""
    marks, joins = _marks()
    return F.when(text.rlike(marks), F.regexp_replace(F.translate(text, "\u212a", "K"), joins, " ")).otherwise(text)  # the Kelvin sign is a K


def lower_text(text: Column) -> Column:
    """Lower case without links, tags and [+N chars] marks.  Hangul is composed first; letters that would be composed with marks go."""
    text = F.regexp_replace(without_composed(composed_hangul(text)), r"(?U)http\S+", " ")
    text = F.regexp_replace(text, r"<[^>]+>", " ")
    return F.lower(F.regexp_replace(text, r"\[\+\d+\s+chars\]", " "))


def clean_text(text: Column) -> Column:
    """Letters a-z and Hangul of `lower_text` with single blanks."""
    return F.trim(F.regexp_replace(lower_text(text), "[^a-z가-힣]+", " "))  # white space and all else between letters at once


def _character(code: Column) -> Column:
    """The character of a code point, by its UTF-16 units."""
    above = code - 0x10000
    units = F.when(code < 0x10000, F.lpad(F.hex(code), 4, "0")).otherwise(F.concat(F.hex(0xD800 + F.shiftright(above, 10)), F.hex(0xDC00 + above.bitwiseAND(0x3FF))))
    return F.decode(F.unhex(units), "UTF-16BE")


@cache
def _references() -> tuple[dict[str, str], dict[int, str]]:
    """(characters of named references, with their semicolon if it is needed; characters of numbers that do not stand for themselves), as HTML defines them."""
    odd = {n: html.unescape(f"&#{n};") for n in (*range(0xA0), *range(0xFDD0, 0xFDF0), *(p << 16 | x for p in range(17) for x in (0xFFFE, 0xFFFF)))}
    return dict(html.entities.html5), {n: c for n, c in odd.items() if c != chr(n)}


def _resolved(piece: Column) -> Column:
    """What a piece that begins with & stands for; other pieces stay."""
    names, odd = _references()
    begin, end = "\x01", "\x02"

    def found(table: dict, key: Column) -> Column:
        """The value of a key in a literal of all pairs, null where it is none: for so rare a look-up cheaper to plan than a map."""
        pairs = "".join(f"{begin}{k}{end}={v}" for k, v in table.items()) + begin
        value = F.call_function("substring_index", F.lit(pairs), F.concat(F.lit(begin), key, F.lit(end)), F.lit(-1))
        return F.when(value.startswith("="), F.substring(F.call_function("substring_index", value, F.lit(begin), F.lit(1)), 2, 99))

    body = F.regexp_extract(piece, "^&#[xX]?([0-9a-fA-F]+);?$", 1)
    base = F.when(piece.rlike("^&#[xX]"), 16).otherwise(10)
    digits = F.regexp_replace(body, "^0+(?=.)", "")
    code = F.when(F.length(digits) > 8, 0x110000).otherwise(F.when(base == 16, F.conv(digits, 16, 10)).otherwise(digits).cast("long"))
    number = F.coalesce(found(odd, code.cast("string")), F.when(((code >= 0xD800) & (code <= 0xDFFF)) | (code > 0x10FFFF), "\ufffd").otherwise(_character(code)))
    name = F.substring(piece, 2, 33)
    begins = [F.concat(found({k: v for k, v in names.items() if len(k) == n and k[-1] != ";"}, F.substring(name, 1, n)), F.substring(piece, n + 2, 40)) for n in range(6, 1, -1)]
    word = F.coalesce(found(names, name), *begins, piece)
    return F.when(piece.rlike("^&#([0-9]+|[xX][0-9a-fA-F]+);?$"), number).when(piece.rlike("^&[^#]"), word).otherwise(piece)


def unescaped(text: Column) -> Column:
    """All character references of HTML resolved, each once: common names by replacement, others, where a text has them, piece by piece."""
    common = text
    for name, char in _NAMED:
        common = F.replace(common, F.lit(name), F.lit(char))
    pieces = F.regexp_extract_all(text, F.lit(r"(?s)&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&"), F.lit(0))
    others = text.rlike(r"&(?!(lt|gt|quot|apos|amp|nbsp|#39);)(#[0-9xX]|[^\t\n\f <&#;])")
    return F.when(others, F.array_join(F.transform(pieces, _resolved), "")).otherwise(common)


def strip_html(text: Column) -> Column:
    """Character references resolved, then tags dropped, then trimmed."""
    return F.btrim(F.regexp_replace(unescaped(text), r"<[^>]+>", ""), F.lit(" \t\r\n\x0b\x0c\u00a0"))


def normalize_summary(text: Column) -> Column:
    """Single blanks; null if no letter, digit or Hangul is left."""
    text = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(text.rlike("[A-Za-z0-9가-힣]"), text)


def article_text(title: Column, summary: Column) -> Column:
    same = summary.isNull() | (F.trim(summary) == "") | F.coalesce(F.trim(summary) == F.trim(title), F.lit(False))
    return F.when(same, title).otherwise(F.concat_ws(" ", title, summary))


def clean_for_mining(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"[^가-힣\s]", " "), r"\s+", " "))


def compact(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", "")


def tokens(text: Column, stopwords: Column | None = None, min_len: int = 2) -> Column:
    """Tokens of one script, a-z or Hangul, at least min_len long and no stopwords; in order.  All but letters of these scripts parts tokens, so a text need not be cleaned of it."""
    found = F.regexp_extract_all(text, F.lit(f"(?<![a-z가-힣])(?:[a-z]{{{min_len},}}+|[가-힣]{{{min_len},}}+)(?![a-z가-힣])"), F.lit(0))
    if stopwords is None:
        return found
    stop = F.coalesce(stopwords, F.array().cast("array<string>"))
    return F.filter(found, lambda t: ~F.array_contains(stop, t))


#: Word lists are dealt to so many buckets, so that a look-up reads a thousandth of a list.
BUCKETS = 1024


def bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def listed(buckets: Column, word: Column) -> Column:
    """Whether a word is in a list dealt by `bucket`."""
    return F.coalesce(F.array_contains(F.get(buckets, bucket(word)), word), F.lit(False))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), the value computed once: what functions of elements refer to is computed anew for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def compound_window(known: Column) -> Column:
    """Most tokens of a compound: the characters of the longest known word, from 2 to MAX_PARTS."""
    return F.least(F.lit(MAX_PARTS), F.greatest(F.lit(2), F.coalesce(F.array_max(F.transform(known, F.length)), F.lit(2))))


def touching(spans: Column, text: Column) -> Column:
    """For each token but the last, whether only white space, or nothing, stands between it and the next; spans: array of (start, end) from 0."""
    gap = lambda a, b: F.substring(text, a["end"] + 1, b["start"] - a["end"])
    free = lambda a, i: F.when(i + 1 < F.size(spans), F.coalesce(~gap(a, F.get(spans, i + 1)).rlike(r"\S"), F.lit(False))).otherwise(False)
    return F.transform(spans, free)


def touching_runs(spans: Column, max_parts: int) -> Column:
    """Joined tokens of all runs of 2 to max_parts that touch; spans: array of (token, start, end)."""

    def runs(s: Column) -> Column:
        def of(x: Column, i: Column) -> Column:
            parts = [x, *(F.get(s, i + n) for n in range(1, max_parts))]
            touch, out = F.lit(True), []
            for n in range(1, max_parts):
                touch = touch & (parts[n]["start"] == parts[n - 1]["end"])
                out.append(F.when(touch, F.concat(*(p["token"] for p in parts[: n + 1]))))
            return F.array(*out)

        return F.flatten(F.transform(s, of))

    return bound(spans, runs)


def merge_compounds(words: Column, known: Column, max_window: int = MAX_PARTS, spans: Column | None = None, text: Column | None = None, window: Column | None = None) -> Column:
    """Greedy longest match: runs of 2 to max_window tokens that join to a known word become that word.

    No more tokens are joined than the longest known word has characters; with spans, only tokens that touch in the text.
    With `window`, the `compound_window` of the known words, `known` is dealt by `bucket`.  The work is linear in the tokens:
    each position is given the length of its match as a digit, and a pattern that takes as many digits as the first says walks them.
    """
    if not 2 <= max_window <= MAX_PARTS:
        raise ValueError(f"max_window must lie between 2 and {MAX_PARTS}")
    free = F.lit(None).cast("array<boolean>") if spans is None else touching(spans, F.lit("") if text is None else text)
    is_known = (lambda s, word: F.array_contains(s["known"], word)) if window is None else (lambda s, word: listed(s["known"], word))
    walk = "|".join(f"{n}.{{{n - 1}}}" for n in range(1, max_window + 1))

    def longest(s: Column, i: Column) -> Column:
        size = F.lit("1")
        for n in range(2, max_window + 1):
            fits = (i + n <= F.size(s["words"])) & (F.lit(n) <= s["window"])
            if spans is not None:
                fits = fits & F.forall(F.slice(s["free"], i + 1, n - 1), lambda x: x)
            size = F.when(fits & is_known(s, F.array_join(F.slice(s["words"], i + 1, n), "")), str(n)).otherwise(size)
        return size

    def merged(s: Column) -> Column:
        digits = F.array_join(F.transform(s["words"], lambda w, i: longest(s, i)), "")
        steps = F.regexp_extract_all(digits, F.lit(walk), F.lit(0))
        parts = F.flatten(F.transform(steps, lambda p: F.concat(F.array(F.length(p)), F.array_repeat(F.lit(0), F.length(p) - 1))))
        joined = F.zip_with(F.transform(s["words"], lambda w, i: F.struct(w.alias("w"), i.alias("i"))), parts, lambda x, n: F.when(n == 1, x["w"]).when(n > 1, F.array_join(F.slice(s["words"], x["i"] + 1, n), "")))
        return F.filter(joined, lambda w: w.isNotNull())

    values = F.struct(words.alias("words"), known.alias("known"), free.alias("free"), (compound_window(known) if window is None else window).alias("window"))
    return F.when(F.size(words) > 0, bound(values, merged)).otherwise(words)


def parse_pub_date(text: Column) -> Column:
    """RFC 822 or ISO dates as UTC timestamps of whole seconds; dates without zone are UTC; anything else is null."""
    plain = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3},\s*", "")
    zoned = F.regexp_replace(F.regexp_replace(plain, r"(GMT|UTC)$", "+0000"), r"([+-]\d{2}):(\d{2})$", "$1$2")
    tries = [F.try_to_timestamp(zoned, F.lit(f)) for f in ("d MMM yyyy HH:mm:ss Z", "yyyy-MM-dd'T'HH:mm:ssZ", "yyyy-MM-dd'T'HH:mm:ss.SSSZ")]
    return F.date_trunc("second", F.coalesce(*tries, F.try_to_timestamp(plain)))


def utc_seconds(text: Column) -> Column:
    return F.date_format(F.date_trunc("second", F.try_to_timestamp(text)), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def safe_growth(current: Column, previous: Column) -> Column:
    grown = F.when(current > 0, 1.0).otherwise(0.0)
    return F.when(F.coalesce(previous, F.lit(0)) <= 0, grown).otherwise((current - previous) / F.nullif(previous, F.lit(0)))


def is_spike(current: Column, growth: Column) -> Column:
    return (current >= 5) & (growth >= 0.4)


def event_score(current: Column, growth: Column) -> Column:
    """45 per unit of growth, 6 per root of mentions, 20 for a spike; half to even, from 0 to 100."""
    raw = growth * 45 + F.sqrt(current) * 6 + F.when(is_spike(current, growth), 20).otherwise(0)
    return F.least(F.lit(100), F.greatest(F.lit(0), F.rint(raw))).cast("int")


def bucket_index(ts: Column, origin: Column, width_seconds: int) -> Column:
    micros = F.unix_micros(ts.cast("timestamp")) - F.unix_micros(origin.cast("timestamp"))
    return F.floor(micros / (width_seconds * 1_000_000))


def minutes_ago(ts: Column, as_of: Column) -> Column:
    return F.greatest(F.lit(0), F.floor((F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(ts.cast("timestamp"))) / 60_000_000))


def source_share(source: str) -> tuple[Column, Column]:
    """Shares of the two providers: all of one, or half each for all sources."""
    first = {"naver": 1.0, "all": 0.5, "global": 0.5}.get(source, 0.0)
    return F.lit(first), F.lit(1.0 - first)


def composite_key(*columns: str) -> Column:
    return F.concat_ws("::", *columns)


def publisher(name: Column, url: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(name), F.lit("")), F.try_parse_url(url, F.lit("HOST")))


def frequency_per_doc(frequency: Column, docs: Column) -> Column:
    return F.round(frequency / F.greatest(docs, F.lit(1)), 2)


def decide(found: Column, total: Column, matched: Column, word: Column, generic: Column, docs: Column, frequency: Column) -> Column:
    """Outcome of a candidate's review, the first rule that holds."""
    sure = (docs >= 3) & (frequency >= 5) & (frequency / F.greatest(docs, F.lit(1)) <= 8)
    return (
        F.when(~F.coalesce(found, F.lit(False)), "api_error")
        .when(F.coalesce(total, F.lit(0)) == 0, "no_search_results")
        .when(~F.coalesce(matched, F.lit(False)), "no_exact_match")
        .when((F.length(word) <= 1) | F.coalesce(generic, F.lit(False)) | ~word.rlike("[가-힣]"), "low_confidence")
        .when(sure, "high_confidence")
        .otherwise("needs_manual_review")
    )


def evidence_summary(evidence: Column) -> Column:
    part = lambda path: F.get_json_object(evidence, path)
    return F.struct(part("$.total").cast("long").alias("total"), part("$.match.title").alias("title"), part("$.match.link").alias("link"), part("$.error").alias("error"))
