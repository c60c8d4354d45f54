"""Token counts under a unigram vocabulary, by dynamic programming on a trie.

The distinct words (matches of the pattern) of all documents, range partitioned
and sorted, are the depth-first walk of their trie: the stack of forward scores
is kept for the prefix that a word shares with its predecessor, so every trie
node is scored once, and a word's terminal node stores its count of tokens.
Among segmentations of equal score the one with fewer tokens counts.

Documents are then split once more.  Words of at most `HEAD` most frequent ones
are counted in the task; other words meet their stored counts in a join on the
word, pre-counted by document.

Defined cases: null and empty texts have no words and no tokens; repeated rows
of one doc_id are one document whose counts add up; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import Splitter, head_words, text_slices
from .common import stored

HEAD = 1 << 18


def zipf_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    """Log-probabilities of pieces under Zipf's law by rank."""
    total = math.log(sum(1 / (r + 1) for r in ranks.values()))
    return {piece: -math.log(r + 1) - total for piece, r in ranks.items()}


class Walk:
    """Forward scores along one path of the trie; best[i] is (score, -tokens) of the first i bytes."""

    def __init__(self, scores: dict[bytes, float]):
        self.scores, self.longest = scores, max(map(len, scores))
        self.path, self.best = b"", [(0.0, 0)]
        self.nodes = 0

    def count(self, word: bytes) -> int:
        shared, most = 0, min(len(word), len(self.path))
        while shared < most and word[shared] == self.path[shared]:
            shared += 1
        del self.best[shared + 1 :]
        for i in range(shared + 1, len(word) + 1):
            self.best.append(max((b[0] + s, b[1] - 1) for j in range(max(0, i - self.longest), i) if (s := self.scores.get(word[j:i])) is not None and (b := self.best[j])))
        self.nodes += len(word) - shared
        self.path = word
        return -self.best[-1][1]


def _walk(scores):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Walk(scores.value)
        for batch in batches:
            counts = [walk.count(w.as_py().encode()) for w in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["word", "tokens"])

    return run


def _count(pattern: str, head):
    """A row of known counts per document, under a key no word has, and a row per other word of it."""
    schema = pa.schema([("doc_id", pa.int64()), ("word", pa.string()), ("times", pa.int64()), ("words", pa.int64()), ("known", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, counts = Splitter(pattern), head.value
        seen: dict[str, tuple[int, int, list[str]]] = {}

        def measure(led: list[str], others: list[str]) -> None:
            words, place, first = splitter.words(led, others)
            known = [counts.get(w) for w in words]
            total = np.concatenate(([0], np.cumsum(np.array([k or 0 for k in known], np.int64)[place])))[first]
            rare = np.array([k is None for k in known], bool)[place]
            for r, a, b, k in zip(led + others, first[:-1].tolist(), first[1:].tolist(), np.diff(total).tolist(), strict=True):
                seen[r] = b - a, k, [words[w] for w in place[a:b][rare[a:b]]] if rare[a:b].any() else []

        for batch in batches:
            for low, high in text_slices(batch.column(1)):
                led, others, which, first = splitter.distinct(batch.column(1)[low:high])
                if len(seen) > 300_000:
                    seen.clear()
                measure([r for r in led if r not in seen], [r for r in others if r not in seen])
                found = [seen[r] for r in led + others]
                words, known = (np.concatenate(([0], np.cumsum(np.array([f[j] for f in found], np.int64)[which])))[first] for j in (0, 1))
                rare = np.array([bool(f[2]) for f in found])[which]
                places = np.flatnonzero(rare)
                at = np.searchsorted(places, first)
                rows: list[tuple] = []
                for i, doc_id in enumerate(batch.column(0)[low:high].to_pylist()):
                    rows.append((doc_id, f"\0\0{doc_id}", 0, int(words[i + 1] - words[i]), int(known[i + 1] - known[i])))
                    rows.extend((doc_id, w, n, 0, 0) for w, n in Counter(w for p in which[places[at[i] : at[i + 1]]] for w in found[p][2]).items())
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def word_counts(words: DataFrame, scores: dict[bytes, float]) -> DataFrame:
    """(word, tokens) of distinct words."""
    shipped = words.sparkSession.sparkContext.broadcast(scores)
    return words.repartitionByRange("word").sortWithinPartitions("word").mapInArrow(_walk(shipped), "word string, tokens long")


def token_counts(docs: DataFrame, scores: dict[bytes, float], pattern: str, most: int = HEAD) -> DataFrame:
    """(doc_id, n_words, n_tokens), one row per doc_id."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    words, frequent = head_words(texts, pattern, most)
    counts = stored(word_counts(words.select("word"), scores), "counts")
    head = counts.join(frequent.select("word"), "word", "left_semi").toArrow()  # at most `most` rows
    known = spark.sparkContext.broadcast(dict(zip(head.column("word").to_pylist(), head.column("tokens").to_pylist(), strict=True)))
    parts = texts.mapInArrow(_count(pattern, known), "doc_id long, word string, times long, words long, known long")
    parts = parts.join(counts, "word", "left")
    tokens = F.sum(F.col("known") + F.col("times") * F.coalesce("tokens", F.lit(0)))
    return parts.groupBy("doc_id").agg(F.sum("words").alias("n_words"), tokens.alias("n_tokens"))
