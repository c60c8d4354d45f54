"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and benchmark items are folded to lower case with single blanks.  An item of
L characters occurs in a document if some substring lies within
e = floor(rate * L) edits.  By the q-gram lemma such a substring shares at least
L - q + 1 - q * e q-grams with the item, all on diagonals within e of each other;
so q-gram hits are counted in diagonal bands of 2 * (e + 1), overlapping by half,
and only bands that reach the bound are verified by alignment within the band.

The index of the benchmark holds at most `BLOCK_CHARS` characters; larger
benchmarks are split into blocks by item, each met with all documents.  Documents
are not shuffled but for the union of several blocks' findings.

Defined cases: null and empty texts and items match nothing; items shorter than a
q-gram, for which the lemma says nothing, match as exact substrings; the budget of
short items shrinks until the bound is positive; repeated rows of a doc_id are
judged alike, repeated items once each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Powers, short_ranges

Q, RATE, BLOCK_CHARS, SLICE = 8, 0.1, 4 << 20, 1 << 19
_CHARS = Powers(0xC2B2AE3D27D4EB4F)
_BITS, _CELLS = 22, 1 << 20


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(points: np.ndarray) -> np.ndarray:
    at = np.arange(max(0, len(points) - Q + 1))
    return short_ranges((points.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), _CHARS, at, at + Q)


def edit_budget(length: int, rate: float = RATE) -> int:
    """Edits allowed: the rate of the length, fewer where the lemma's bound would not be positive."""
    return max(0, min(int(rate * length), (length - Q) // Q))


def banded_distances(items: list[np.ndarray], which: np.ndarray, text: np.ndarray, first: np.ndarray, last: np.ndarray, low: np.ndarray, width: int, budget: int) -> list[tuple[int, int] | None]:
    """For each candidate, (edits, end) of the best alignment of all of item `which` with a part of text[first:last], on `width` diagonals from `low` on; None over budget.

    Candidates of one budget are aligned together, one row of the item at a time; those over budget leave.
    """
    out: list[tuple[int, int] | None] = [None] * len(which)
    longest = max(len(p) for p in items)
    letters = np.zeros((len(items), longest), np.uint32)
    for i, p in enumerate(items):
        letters[i, : len(p)] = p
    size, length = np.array([len(p) for p in items])[which], last - first
    live, step = np.arange(len(which)), np.arange(width)
    column = low[:, None] + step
    row = np.where((column >= 0) & (column <= length[:, None]), 0, budget + 1)
    for i in range(1, longest + 1):
        j = column + i
        inside = (j >= 1) & (j <= length[live, None])
        at = np.where(inside, first[live, None] + j - 1, 0)
        best = np.where(inside, row + (text[at] != letters[which[live], i - 1][:, None]), budget + 1)
        best[:, :-1] = np.minimum(best[:, :-1], row[:, 1:] + 1)
        best = np.where((j >= 0) & (j <= length[live, None]), best, budget + 1)
        row = np.minimum.accumulate(best - step, axis=1) + step
        done = size[live] == i
        for c in np.flatnonzero(done):
            k = int(row[c].argmin())
            if row[c, k] <= budget:
                out[live[c]] = int(row[c, k]), int(j[c, k])
        stay = ~done & (row.min(1) <= budget)
        if not stay.all():
            live, column, row = live[stay], column[stay], row[stay]
            if not len(live):
                break
    return out


class Index:
    """Postings of the q-grams of a block of items."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE):
        items = [(i, t) for i, text in items if (t := normal(text))]
        self.short = [(i, t) for i, t in items if len(t) < Q]
        items = [(i, t) for i, t in items if len(t) >= Q]
        self.ids, self.texts, self.points = [i for i, _ in items], [t for _, t in items], [_points(t) for _, t in items]
        self.budget = np.array([edit_budget(len(p), rate) for p in self.points], np.int64)
        self.bound = np.array([len(p) - Q + 1 for p in self.points], np.int64) - Q * self.budget
        grams = [_grams(p) for p in self.points]
        key = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(key, kind="stable")
        self.key = key[order]
        self.item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])[order]
        self.place = np.concatenate([np.arange(len(g)) for g in grams])[order] if grams else np.zeros(0, np.int64)
        self.mark = np.zeros(1 << _BITS, bool)
        self.mark[(self.key >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def search(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """(item id, edits, end in the folded text) of each item found in each text."""
        out: list[list[tuple[int, int, int]]] = [[(i, 0, t.find(s) + len(s)) for i, s in self.short if s in t] for t in texts]
        if not self.ids:
            return out
        points = [_points(t) for t in texts]
        length = np.array([len(p) for p in points])
        first = np.concatenate(([0], np.cumsum(length)))
        grams = _grams(np.concatenate(points)) if points else np.zeros(0, np.uint64)
        at = np.flatnonzero(self.mark[(grams >> np.uint64(64 - _BITS)).astype(np.int64)])
        doc = np.searchsorted(first, at, "right") - 1
        some = at + Q <= first[doc + 1]
        at, doc = at[some], doc[some]
        low, high = np.searchsorted(self.key, grams[at], "left"), np.searchsorted(self.key, grams[at], "right")
        n = high - low
        at, doc = np.repeat(at, n), np.repeat(doc, n)
        posting = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        item = self.item[posting]
        diagonal = at - first[doc] - self.place[posting]
        size = self.budget[item] + 1
        found: dict[tuple[int, int], set[int]] = {}
        for family in (0, 1):
            band = (diagonal + family * size) // (2 * size) + (1 << 30)
            if len(doc) and (doc.max() >= 1 << 12 or band.max() >= 1 << 31):
                raise ValueError("too many texts in a slice or too long a text")
            key = (doc.astype(np.int64) << 51) | (item.astype(np.int64) << 31) | band
            key, count = np.unique(key, return_counts=True)
            which = (key >> 31) & ((1 << 20) - 1)
            for k in key[count >= self.bound[which]]:
                b = int((k >> 31) & ((1 << 20) - 1))
                start = (int(k & ((1 << 31) - 1)) - (1 << 30)) * 2 * (int(self.budget[b]) + 1) - family * (int(self.budget[b]) + 1)
                found.setdefault((int(k >> 51), b), set()).add(start)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        rest: dict[int, list[tuple[int, int, int]]] = {}
        for (d, b), starts in found.items():
            e = int(self.budget[b])
            for start in starts:
                begin = max(0, start)
                exact = texts[d].find(self.texts[b], begin, max(begin, start + 2 * e + 1 + len(self.texts[b])))
                if exact >= 0:
                    best[d, b] = min(best.get((d, b), (0, exact + len(self.texts[b]))), (0, exact + len(self.texts[b])))
                elif e:
                    rest.setdefault(e, []).append((d, b, start))
        every = np.concatenate(points) if points else np.zeros(0, np.uint32)
        for e, candidates in rest.items():
            width, together = 4 * e + 2, max(1, _CELLS // (4 * e + 2))
            candidates = [c for c in candidates if best.get(c[:2], (1, 0))[0]]  # found as they are, they need no alignment
            for i in range(0, len(candidates), together):
                d, b, start = np.array(candidates[i : i + together]).T
                items, which = np.unique(b, return_inverse=True)
                hits = banded_distances([self.points[x] for x in items], which, every, first[d], first[d + 1], start - e, width, e)
                for key, hit in zip(zip(d.tolist(), b.tolist(), strict=True), hits, strict=True):
                    if hit:
                        best[key] = min(best.get(key, hit), hit)
        for (d, b), hit in sorted(best.items()):
            out[d].append((self.ids[b], *hit))
        return out


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("found", pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("end", pa.int64())])))])


def _search(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(doc_id.as_py())
                texts.append(normal(text.as_py()))
                held += len(texts[-1])
                if held > SLICE or len(ids) >= 4000:
                    yield _found(index.value, ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield _found(index.value, ids, texts)

    return run


def _found(index: Index, ids: list, texts: list[str]) -> pa.RecordBatch:
    hits = [[{"item_id": i, "edits": e, "end": end} for i, e, end in sorted(h)] for h in index.search(texts)]
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hits, _SCHEMA.field(1).type)], schema=_SCHEMA)


def find_benchmark(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, found): items found in each document, one row per input row (per doc_id where the benchmark has several blocks)."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    chars = items.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // block_chars))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = []
    for b in range(blocks):
        block = [(r.item_id, r.text) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()]  # about block_chars characters
        parts.append(texts.mapInArrow(_search(spark.sparkContext.broadcast(Index(block, rate))), "doc_id long, found array<struct<item_id:bigint,edits:int,end:bigint>>"))
    if blocks == 1:
        return parts[0]
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    return every.groupBy("doc_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))).alias("found"))
