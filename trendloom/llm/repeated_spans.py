"""Substring deduplication on a De Bruijn graph of words, compacted by minimisers.

Windows of `window` words are the edges of the graph, the runs of `window - 1` words
that they lead from and to its nodes.  A node is dealt by its minimiser, of the k-mers
in it the one with the least hash, so all visits of all texts to a node meet under one
key.  Consecutive nodes of a text with one minimiser are a path, which is one row: its
hash covers its words and the word before and after, hence all edges at its nodes.

* A minimiser met in one document only has no repeated edge: dropped.
* Where all paths of a minimiser are equal, every node on them has one edge in and one
  out, so they compact to one nonbranching path without a row for each node.
* Where they differ, each distinct path (never each copy) is read at its source
  coordinates, the least document and the place there, and gives a row for each node
  with the words before and after.  Aggregates of these rows give each edge its least
  source and tell the nodes with several edges in or out; joins bring both back to the
  paths, which are cut at branching nodes and where the source changes.

Pieces of a document's paths that follow each other in the document and in the source,
over a node that does not branch, are glued to long spans.  They are glued in the row
of the document, by coordinates; there is no table of the whole graph's unitigs.

Before words are cut, the words of each path are compared, as 128-bit digests, with
those read at the path's source coordinates.  That edges of differing paths are equal
rests on 64-bit hashes of a node and of the next word.

Each step is stored, and what it was made of removed once nothing reads it, so the disk
holds the rows of one step, not of all.

Whether a window repeats in an earlier document is thus known for every window, on
the input as given.

Defined cases: null or empty texts have no words; texts shorter than the window
lose nothing; repeats within one document are not removed; rows that repeat a
doc_id are one document, and each row loses the windows that its own text has in an
earlier document; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import ragged
from .common import SLICE_BYTES, Words, as_long, discard, slices, stored

PATHS = "kmer long, path long, doc_id long, first_window long, n_nodes int, ends boolean"
_VISITS = "path long, kmer long, nth int, node long, prev long, next long, doc long, pos long"
_SPAN = "first_word:long,n_windows:long,source_id:long,source_first:long"


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the least of each run of `width` values, the leftmost of equals."""
    n = len(values) - width + 1
    best, span = np.arange(len(values)), 1
    while span < width:  # doubling: the least of twice the span from two overlapping halves
        step = min(span, width - span)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        span += step
    return best[:n]


def _paths_of(words: Words, doc: int, k: int, window: int) -> tuple[np.ndarray, ...] | None:
    """Paths of text number `doc`: chosen k-mer index, first node, number of nodes (word indices of `words`), whether the text ends with it."""
    low, high = words.first[doc], words.first[doc + 1]
    if high - low < window:
        return None
    chosen = low + _least(words.kmers[low : high - k + 1], window - k)
    start = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    ends = np.zeros(len(start), bool)
    ends[-1] = True
    return chosen[start], low + start, np.diff(np.append(start, len(chosen))), ends


def _reach(first, n_nodes, ends, begin, window: int):
    """First and end word of a path with the words before and after it, where the text has such."""
    return first - (first > begin), first + n_nodes + window - 1 - ends


def _content(words: Words, first, n_nodes, ends, begin, window: int) -> np.ndarray:
    """Hash of paths: their words, those before and after, and which of these there are."""
    place = (2 * (first > begin) + ends).astype(np.uint64)
    return words.spans(*_reach(first, n_nodes, ends, begin, window)) ^ (place * np.uint64(0x9E3779B97F4A7C15))


def _find_paths(k: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for low, high, data, at in slices(batch.column(1)):
                words = Words(data, at)
                words.kmers = words.grams(k)
                found = [(i, p) for i in range(high - low) if (p := _paths_of(words, i, k, window))]
                if not found:
                    continue
                chosen, first, n, ends = (np.concatenate([p[j] for _, p in found]) for j in range(4))
                doc = np.repeat([i for i, _ in found], [len(p[0]) for _, p in found])
                begin = words.first[doc]
                content = _content(words, first, n, ends, begin, window)
                columns = as_long(words.kmers[chosen]), as_long(content), ids[low + doc], first - begin, n.astype(np.int32), ends
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["kmer", "path", "doc_id", "first_window", "n_nodes", "ends"])

    return run


def _proof(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _visit_nodes(window: int):
    """Asked paths at their source coordinates: a row with the digest of the path's words (nth -1), and a row a node where paths of the minimiser differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, at in slices(batch.column(0)):
                words, asks = Words(data, at), batch.column(1)[low:high]
                hashes, flat = as_long(words.hash), asks.flatten()
                ask = {f.name: c.to_numpy(zero_copy_only=False) for f, c in zip(flat.type, flat.flatten(), strict=True)}
                row = np.repeat(np.arange(high - low), pc.list_value_length(asks).to_numpy())
                ask |= {"begin": words.first[row], "stop": words.first[row + 1], "first": words.first[row] + ask["first_window"]}
                ask["left"], ask["right"] = _reach(ask["first"], ask["n_nodes"], ask["ends"], ask["begin"], window)
                ask = {c: v[ask["right"] <= ask["stop"]] for c, v in ask.items()}
                same = as_long(_content(words, ask["first"], ask["n_nodes"], ask["ends"], ask["begin"], window)) == ask["path"]
                ask = {c: v[same] for c, v in ask.items()}  # others ask for another row of the same doc_id
                if not len(ask["path"]):
                    continue
                ranges = zip(words.start[ask["left"]].tolist(), words.end[ask["right"] - 1].tolist(), strict=True)
                proof = np.frombuffer(b"".join(_proof(data[x:y].tobytes().split()) for x, y in ranges), np.int64).reshape(-1, 2)
                n = ask["n_nodes"].astype(np.int64) * ask["branches"]
                start, which, none = ragged(ask["first"], n), np.repeat(np.arange(len(n)), n), np.zeros(len(n), np.int64)
                begin, stop, after = ask["begin"][which], ask["stop"][which], start + window - 1
                of = np.concatenate((np.arange(len(n)), which))
                nth = np.concatenate((none - 1, start - ask["first"][which]))
                node = np.concatenate((proof[:, 0], as_long(words.spans(start, after))))
                prev = pa.array(np.concatenate((proof[:, 1], hashes[np.maximum(start - 1, begin)])), mask=np.concatenate((none > 0, start == begin)))
                then = pa.array(np.concatenate((none, hashes[np.minimum(after, stop - 1)])), mask=np.concatenate((none == 0, after == stop)))
                columns = ask["path"][of], ask["kmer"][of], nth.astype(np.int32), node, prev, then, ask["doc"][of], ask["first_window"][of] + nth
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["path", "kmer", "nth", "node", "prev", "next", "doc", "pos"])

    return run


def _glued(pieces: list[tuple[int, int, int, int, bool]]) -> list[tuple[int, int, int, int]]:
    """(first window, number of windows, source, first window there) of pieces that follow each other in both texts over a node that does not branch."""
    out: list[tuple[int, int, int, int]] = []
    for first, n, source, pos, fork in sorted(pieces):
        if out and not fork:
            f, m, s, p = out[-1]
            if s == source and f + m == first and p + m == pos:
                out[-1] = f, m + n, s, p
                continue
        out.append((first, n, source, pos))
    return out


def _cut(window: int):
    """Remove words covered by repeated windows, where the words of a path are those at its source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, at in slices(batch.column(1), 4 * SLICE_BYTES):
                asked = batch.column(2)[low:high]
                out: tuple[list, list, list, list] = [], [], [], []
                for i in range(high - low):
                    kept = text = data[at[i] : at[i + 1]].tobytes().split()
                    spans: list[tuple[int, int, int, int]] = []
                    if asked[i].is_valid:
                        pieces = []
                        for a in asked[i].as_py():
                            left, right = _reach(a["first_window"], a["n_nodes"], a["ends"], 0, window)
                            if right > len(text) or _proof(text[left:right]) != np.array([a["p0"], a["p1"]]).tobytes():
                                continue  # another row of the same doc_id, or other words under equal hashes
                            pieces += [(a["first_window"] + p["low"], p["high"] - p["low"] + 1, p["doc"], p["pos"], p["fork"]) for p in a["pieces"]]
                        spans, gone = _glued(pieces), np.zeros(len(text) + 1, np.int32)
                        for first, n, _, _ in spans:
                            gone[first] += 1
                            gone[first + n - 1 + window] -= 1
                        kept = [w for w, g in zip(text, (np.cumsum(gone)[: len(text)] > 0).tolist(), strict=True) if not g]
                    for c, v in zip(out, (len(text), len(text) - len(kept), b" ".join(kept).decode("utf-8", "replace"), [dict(zip(_SPAN_NAMES, x, strict=True)) for x in spans]), strict=True):
                        c.append(v)
                yield pa.RecordBatch.from_arrays([batch.column(0)[low:high], *(pa.array(c, f.type) for c, f in zip(out, list(_KEPT)[1:], strict=True))], schema=_KEPT)

    return run


_SPAN_NAMES = ["first_word", "n_windows", "source_id", "source_first"]
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("spans", pa.list_(pa.struct([(n, pa.int64()) for n in _SPAN_NAMES])))])


def distinct_paths(texts: DataFrame, window: int, k: int) -> tuple[DataFrame, DataFrame]:
    """All paths, and the distinct ones under minimisers of several documents: least place, and whether others of the minimiser differ."""
    paths = stored(texts.mapInArrow(_find_paths(k, window), PATHS), "paths")
    kmers = paths.groupBy("kmer").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.min("path").alias("p0"), F.max("path").alias("p1")).where("low < high")
    kmers = kmers.select("kmer", (F.col("p0") != F.col("p1")).alias("branches"))
    distinct = paths.groupBy("kmer", "path", "n_nodes", "ends").agg(F.min(F.struct("doc_id", "first_window")).alias("least"))
    return paths, stored(distinct.join(kmers, "kmer").select("kmer", "path", "n_nodes", "ends", "branches", F.col("least.doc_id").alias("doc"), "least.first_window"), "distinct")


def graph_edges(visits: DataFrame) -> DataFrame:
    """(node, next, source, fork): edges with their least source, and whether the node they leave has several edges in or out."""
    edges = visits.groupBy("node", "next").agg(F.min(F.struct("doc", "pos")).alias("source"), F.min("prev").alias("p0"), F.max("prev").alias("p1"))
    several = (F.min("p0") != F.max("p1")) | (F.min("next") != F.max("next"))
    nodes = edges.groupBy("node").agg(F.coalesce(several, F.lit(False)).alias("fork"))
    return edges.where("next is not null").join(nodes, "node").select("node", "next", "source", "fork")


def repeated_spans(texts: DataFrame, window: int = 50, k: int = 25) -> DataFrame:
    """(doc_id, asks): paths with their pieces that also start in a document of smaller doc_id, and the digest of the path's words at its source."""
    if not 1 <= k < window:
        raise ValueError("k must lie between 1 and window - 1")
    texts = texts.where("doc_id is not null and text is not null")
    paths, distinct = distinct_paths(texts, window, k)
    asks = distinct.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(F.struct("kmer", "path", "doc", "first_window", "n_nodes", "ends", "branches")).alias("asks"))
    visits = stored(texts.join(asks.hint("shuffle_hash"), "doc_id").select("text", "asks").mapInArrow(_visit_nodes(window), _VISITS), "visits")
    proofs = visits.where("nth < 0").groupBy("kmer", "path").agg(F.min(F.struct("node", "prev")).alias("proof"))
    visits = visits.where("nth >= 0")
    whole = F.struct(F.lit(0).alias("low"), (F.col("n_nodes") - 1 - F.col("ends").cast("int")).alias("high"), "doc", F.col("first_window").alias("pos"), F.lit(False).alias("fork"))
    plain = distinct.where("not branches and n_nodes > int(ends)").select("kmer", "path", F.array(whole).alias("pieces"))
    steps = F.array_sort(F.collect_set(F.struct(F.col("nth").alias("low"), F.col("nth").alias("high"), F.col("source.doc").alias("doc"), F.col("source.pos").alias("pos"), "fork")))
    pieces = F.expr(  # a step extends the last piece if its source goes on there and its first node does not branch
        "aggregate(steps, cast(array() as array<struct<low:int,high:int,doc:bigint,pos:bigint,fork:boolean>>), (acc, x) -> if(size(acc) > 0 and not x.fork and element_at(acc, -1).high = x.low - 1 "
        "and element_at(acc, -1).doc = x.doc and element_at(acc, -1).pos + x.low - element_at(acc, -1).low = x.pos, concat(slice(acc, 1, size(acc) - 1), array(named_struct('low', element_at(acc, -1).low, "
        "'high', x.high, 'doc', x.doc, 'pos', element_at(acc, -1).pos, 'fork', element_at(acc, -1).fork))), concat(acc, array(x))))"
    )
    edges = stored(graph_edges(visits), "edges")
    forked = visits.join(edges, ["node", "next"]).groupBy("kmer", "path").agg(steps.alias("steps")).select("kmer", "path", pieces.alias("pieces"))
    compact = stored(plain.unionByName(forked).join(proofs, ["kmer", "path"]), "compact")
    discard(distinct, visits, edges)
    hits = paths.join(compact, ["kmer", "path"]).withColumn("pieces", F.expr("filter(pieces, p -> p.doc < doc_id)")).where("size(pieces) > 0")
    hits = hits.groupBy("doc_id").agg(F.collect_list(F.struct("first_window", "n_nodes", "ends", F.col("proof.node").alias("p0"), F.col("proof.prev").alias("p1"), "pieces")).alias("asks"))
    out = stored(hits, "asks")
    discard(paths, compact)
    return out


def remove_repeated_spans(docs: DataFrame, window: int = 50, k: int = 25) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_text (kept words joined by one blank) and the removed spans (first word, windows, and where they stand in an earlier document)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spans = repeated_spans(texts, window, k)
    return texts.join(spans.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", "asks").mapInArrow(_cut(window), f"doc_id long, n_words long, n_removed long, kept_text string, spans array<struct<{_SPAN}>>")
