"""Byte-level BPE encoding and decoding with Spark higher-order functions.

A word is folded as a string of one character per piece; pieces are numbered by
their ranks, so comparing characters compares ranks.  Ranks of pairs are one stored row:
an array of hash buckets, each a string of pairs and the piece that they join to.
`fold_merges` maps the bytes of a word to characters and, step by step, looks up all
adjacent pairs and replaces the pair of least rank, the leftmost of equals.

Words (matches of the pattern) are counted over all documents.  Those that occur
again, at most the `HEAD` most frequent, are folded once and stored for the tasks
that split texts, as sorted hashes with their bytes to compare; executors fetch them.  Any other word of a
document is folded in the document's own row.  No text is shuffled.  Decoding joins
the bytes of the ids' pieces.

Words of over `LONG` bytes, where the quadratic fold would not end, are merged by
a heap over the same ranks; the result is the same.

Defined cases: null texts count as empty and have no ids; repeated rows are
encoded alike; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hash_ranges, slices, small_batches, stored, text_buffers

HEAD, LONG, BUCKETS, CLASSES = 1 << 21, 256, 1 << 16, 16
_COUNTED, _TEXTS = 300_000, 1 << 21
_OFFSET, _SURROGATES, _END, _DONE, _NONE = 0x100, 0xD800, "!", ".", "\U0010ffff"


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by bytes of a file with lines of a base64 piece and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in lines if line.strip())}


def _char(rank: int) -> str:
    """The character of a piece; greater ranks have greater characters."""
    return chr(rank + _OFFSET if rank + _OFFSET < _SURROGATES else rank + _OFFSET + 0x800)


def last_pairs(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes, int]] | None:
    """The pair that each piece is merged from, by the pieces before it; None if the merges do not lead to some piece."""
    out = []
    for piece, rank in ranks.items():
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            least, i = min((r if (r := ranks.get(a + b)) is not None else len(ranks), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if least >= rank:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        if len(parts) > 2 or max(ranks[x] for x in parts) > rank:
            return None
        if len(parts) == 2:
            out.append((*parts, rank))
    return out


def _all_pairs(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes, int]]:
    cuts = ((piece[:i], piece[i:], rank) for piece, rank in ranks.items() for i in range(1, len(piece)))
    return [(a, b, rank) for a, b, rank in cuts if a in ranks and b in ranks]


def rank_table(spark: SparkSession, ranks: dict[bytes, int]) -> Column:
    """Hash buckets of the pairs that can meet: each bucket has "no piece", then for each pair the pair, the joined piece and the pair's parts between marks.

    A subquery over one stored row: as a literal, megabytes of it stood in each description of a plan, and the driver keeps those of all plans.
    """
    buckets = [[_END + _NONE + _END] for _ in range(BUCKETS)]
    pairs = last_pairs(ranks)
    for a, b, rank in _all_pairs(ranks) if pairs is None else pairs:
        a, b = _char(ranks[a]), _char(ranks[b])
        buckets[zlib.crc32((a + b).encode()) % BUCKETS].append(_END.join((a + b, _char(rank), a, b, "")))
    row = spark.createDataFrame([("\n".join(map("".join, buckets)),)], "buckets string")
    return stored(row.select(F.split("buckets", "\n").alias("buckets")).coalesce(1), "ranks").scalar().alias("buckets")


def piece_chars(word: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes of a text, one character for each byte's piece."""
    single = "".join(_char(ranks[bytes([b])]) for b in range(256))
    return F.translate(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), "".join(map(chr, range(256))), single)


def piece_literal(ranks: dict[bytes, int]) -> Column:
    """Hexadecimal bytes of each id, at the id's place."""
    pieces = [""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex()
    return F.split(F.lit(",".join(pieces)), ",")


def _bind(value: Column, body) -> Column:
    """Names a value for the expressions in body."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold_merges(word: Column, table: Column, ranks: dict[bytes, int]) -> Column:
    """Pieces of a text, one character each: ranked merges folded over its bytes."""
    one, two = F.lit(1), F.lit(2)

    def offer(pair: Column) -> Column:
        bucket = F.get(table, F.crc32(pair.cast("binary")).bitwiseAND(BUCKETS - 1).cast("int"))
        return F.call_function("substring_index", bucket, pair, F.lit(-1))

    def merged(pieces: Column, least: Column) -> Column:
        pair = F.concat(F.substring(least, F.lit(4), one), F.substring(least, F.lit(6), one))
        joined = F.overlay(pieces, F.substring(least, two, one), F.call_function("instr", pieces, pair), two)
        return F.when(F.substring(least, two, one) == _NONE, F.concat(F.lit(_DONE), pieces)).otherwise(joined)

    def step(pieces: Column, _) -> Column:
        least = F.array_min(F.transform(F.sequence(one, F.length(pieces) - 1), lambda i: offer(F.substring(pieces, i, two))))
        return F.when((F.ascii(pieces) == ord(_DONE)) | (F.length(pieces) < 2), pieces).otherwise(_bind(least, lambda x: merged(pieces, x)))

    bytes_left = F.sequence(one, F.greatest(F.octet_length(word), one))
    return F.aggregate(bytes_left, piece_chars(word, ranks), step, lambda pieces: F.replace(pieces, F.lit(_DONE), F.lit("")))


def piece_ids(pieces: Column) -> Column:
    """Ids (array<int>) of a string of one character per piece."""
    code = lambda c: F.ascii(c) - F.when(F.ascii(c) < _SURROGATES, _OFFSET).otherwise(_OFFSET + 0x800)
    return F.when(F.length(pieces) > 0, F.transform(F.split(pieces, ""), code)).otherwise(F.array().cast("array<int>"))


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges by a heap of (rank, place) over linked pieces."""
    n = len(word)
    end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive, heap = [True] * n, []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n and (rank := ranks.get(word[i : end[after[i]]])) is not None:
            heapq.heappush(heap, (rank, i, end[after[i]]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or end[after[i]] != stop:
            continue
        j = after[i]
        alive[j], end[i], after[i] = False, stop, after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        offer(before[i])
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def _strings(column: pa.Array, lead: str = "") -> list[str]:
    """Each string after `lead`; one long string cut at marks is far cheaper than a conversion of each."""
    if not len(column):
        return []
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column.cast(pa.string())), "\x1e" + lead)[0].as_py()
    out = (lead + joined).split("\x1e")
    return out if len(out) == len(column) else [lead + x for x in column.to_pylist()]


class Splitter:
    """Splits texts by the pattern, each distinct run of a slice of texts once.

    The matches before and after a single blank that stands beside no other white
    space do not depend on each other, so texts are cut before such blanks; other
    texts are one run each.
    """

    #: Two white spaces together, one at an end, or one that is not ASCII.
    ODD = r"\s\s|\A\s|\s\z|[\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

    def __init__(self, pattern: str):
        self.find = regex.compile(pattern).findall

    def distinct(self, texts: pa.Array) -> tuple[list[str], list[str], np.ndarray, np.ndarray]:
        """(distinct runs that a blank leads, other distinct runs, number of the run at each place, first place of each text and the end)."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = pc.match_substring_regex(texts, self.ODD)
        parts = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        first, values = parts.offsets.to_numpy().astype(np.int64) - parts.offsets[0].as_py(), parts.flatten()
        head = np.zeros(len(values), bool)
        head[first[:-1]] = True
        later, heads = values.filter(pa.array(~head)).dictionary_encode(), pc.if_else(odd, texts, values.take(pa.array(first[:-1]))).dictionary_encode()
        which = np.empty(len(values), np.int64)
        which[~head] = later.indices.to_numpy()
        which[head] = heads.indices.to_numpy() + len(later.dictionary)
        return _strings(later.dictionary, " "), _strings(heads.dictionary), which, first

    def words(self, led: list[str], others: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(distinct words, number of the word at each place, first place of each run and the end); runs that a blank leads are matched together."""
        found = self.find("".join(led))
        ends, bounds = np.cumsum(np.fromiter(map(len, found), np.int64, len(found))), np.cumsum(np.fromiter(map(len, led), np.int64, len(led)))
        first = np.searchsorted(ends, bounds, "right")
        if len(led) and (ends[first - 1] != bounds).any():  # the pattern leaves characters out
            each = list(map(self.find, led))
            found, first = [w for words in each for w in words], np.cumsum([len(w) for w in each])
        each = list(map(self.find, others))
        first = np.concatenate(([0], first, len(found) + np.cumsum([len(w) for w in each], dtype=np.int64))).astype(np.int64)
        coded = pa.array([*found, *(w for words in each for w in words)], pa.large_string()).dictionary_encode()
        return _strings(coded.dictionary), coded.indices.to_numpy(), first


def text_slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about `_TEXTS` bytes."""
    return ((low, high) for low, high, _, _ in slices(column, _TEXTS))


def _count_words(pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, led, others = Splitter(pattern), {}, {}

        def flush() -> pa.RecordBatch:
            words, which, first = splitter.words(list(led), list(others))
            counts = np.zeros(len(words), np.int64)
            np.add.at(counts, which, np.repeat(np.array([*led.values(), *others.values()], np.int64), np.diff(first)))
            led.clear()
            others.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts)], ["word", "n"])

        for batch in batches:
            for low, high in text_slices(batch.column(0)):
                a, b, which, _ = splitter.distinct(batch.column(0)[low:high])
                times = np.bincount(which, minlength=len(a) + len(b)).tolist()
                for known, found, counts in ((led, a, times[: len(a)]), (others, b, times[len(a) :])):
                    known.update(zip(found, map(int.__add__, counts, (known.get(r, 0) for r in found)), strict=True))
                if len(led) + len(others) > _COUNTED:
                    yield flush()
        yield flush()
        pa.default_memory_pool().release_unused()

    return run


def pieces_ids(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(first place of each row and the end, ids) of strings of one character per piece."""
    raw, at = text_buffers(pieces)
    begins = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))  # characters before each byte
    codes = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int32)
    return begins[at], codes - np.where(codes < _SURROGATES, _OFFSET, _OFFSET + 0x800).astype(np.int32)


class Known:
    """Ids of known words: sorted hashes, with the words' bytes to compare.  Its size is bounded by the number of words."""

    def __init__(self, words: pa.Array, pieces: pa.Array):
        raw, at = text_buffers(words)
        first, self.ids = pieces_ids(pieces)
        hashes = hash_ranges(raw, at[:-1], at[1:])
        order = np.argsort(hashes)
        self.bytes, self.hash = raw.tobytes(), hashes[order]
        self.word_at, self.word_size = at[:-1][order].astype(np.uint32), np.diff(at)[order].astype(np.uint16)
        self.ids_at, self.ids_size = first[:-1][order].astype(np.uint32), np.diff(first)[order].astype(np.uint16)
        if len(self.ids) and self.ids.max() < 1 << 16:
            self.ids = self.ids.astype(np.uint16)

    @classmethod
    def of(cls, parts: list[Known]) -> Known:
        """One table of the words of several."""
        if len(parts) == 1:
            return parts[0]
        self = cls.__new__(cls)
        self.bytes, self.ids = b"".join(k.bytes for k in parts), np.concatenate([k.ids for k in parts])
        hashes = np.concatenate([k.hash for k in parts])
        order = np.argsort(hashes)
        self.hash = hashes[order]
        for at, size, of in (("word_at", "word_size", "bytes"), ("ids_at", "ids_size", "ids")):
            begin = np.cumsum([0, *(len(getattr(k, of)) for k in parts)])
            setattr(self, at, np.concatenate([getattr(k, at) + np.uint32(b) for k, b in zip(parts, begin[:-1], strict=True)])[order])
            setattr(self, size, np.concatenate([getattr(k, size) for k in parts])[order])
        return self

    def find(self, words: list[bytes]) -> list[bytes | None]:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        hashes = hash_ranges(np.frombuffer(b"".join(words), np.uint8), np.concatenate(([0], ends[:-1])), ends)
        place = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        same = self.hash[place] == hashes
        size = np.where(same, self.ids_size[place], 0).astype(np.int64)
        ids, at = self.ids[ragged(self.ids_at[place].astype(np.int64), size)].astype(np.int32).tobytes(), (4 * np.concatenate(([0], np.cumsum(size)))).tolist()
        begin = self.word_at[place].astype(np.int64)
        rows = zip(words, same.tolist(), begin.tolist(), (begin + self.word_size[place]).tolist(), at[:-1], at[1:], strict=True)
        return [ids[f:t] if hit and self.bytes[a:b] == w else None for w, hit, a, b, f, t in rows]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The known words of a partition as one table for each length modulo CLASSES."""
    columns = list(zip(*(b.columns for b in batches if b.num_rows), strict=True))
    if columns:
        words, pieces = map(pa.concat_arrays, columns)
        classes = pc.binary_length(words.cast(pa.binary())).to_numpy() % CLASSES
        for c in np.unique(classes):
            some = pa.array(classes == c)
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([pickle.dumps(Known(words.filter(some), pieces.filter(some)))], pa.binary())], ["class", "part"])


class KnownParts:
    """Tables of words by their length modulo CLASSES, in files that executors packed and fetch; a task's process reads them and unpacks each class once."""

    def __init__(self, files: list[str]):
        self.files, self.tables = files, {}
        self.parts: dict[int, list[bytes]] | None = None

    def _read(self) -> dict[int, list[bytes]]:
        parts: dict[int, list[bytes]] = {}
        for name in self.files:
            rows = pq.ParquetFile(SparkFiles.get(name)).read()
            for c, part in zip(rows.column("class").to_pylist(), rows.column("part").to_pylist(), strict=True):
                parts.setdefault(c, []).append(part)
        return parts

    def find(self, words: list[bytes]) -> list[bytes | None]:
        """Packed 32-bit ids of each word, None for unknown ones."""
        out: list[bytes | None] = [None] * len(words)
        classes = np.fromiter(map(len, words), np.int64, len(words)) % CLASSES
        if self.parts is None:
            self.parts = self._read()
        for c in np.unique(classes).tolist():
            if c in self.parts:
                self.tables[c] = Known.of(list(map(pickle.loads, self.parts.pop(c))))
            if c in self.tables:
                places = np.flatnonzero(classes == c).tolist()
                for i, ids in zip(places, self.tables[c].find([words[i] for i in places]), strict=True):
                    out[i] = ids
        return out


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All of start[i], start[i] + 1, ... of length[i] numbers, one after another."""
    return np.repeat(start - (np.cumsum(length) - length), length) + np.arange(length.sum())


class Coder:
    """Ids of texts; a word that is not known has the number of a rare word, negative."""

    def __init__(self, pattern: str, known: KnownParts, ranks: dict[bytes, int]):
        self.splitter, self.known, self.ranks = Splitter(pattern), known, ranks
        self.rare: list[str] = []
        self.words: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        new = [w for w in words if w not in self.words]
        raw = [w.encode() for w in new]
        for w, r, ids in zip(new, raw, self.known.find(raw), strict=True):
            if ids is None and len(r) > LONG:
                ids = np.array(merge_long(r, self.ranks), np.int32).tobytes()
            elif ids is None:
                self.rare.append(w)
                ids = np.array([-len(self.rare)], np.int32).tobytes()
            self.words[w] = ids

    def code(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, first place of each text and the end)."""
        if len(self.runs) + len(self.words) > _COUNTED:
            self.rare, self.words, self.runs = [], {}, {}
        led, others, which, first = self.splitter.distinct(texts)
        new = [r for r in led if r not in self.runs], [r for r in others if r not in self.runs]
        words, place, run_at = self.splitter.words(*new)
        self._learn(words)
        ids, ends = _joined(list(map(self.words.__getitem__, words)), place)
        ids, ends = ids.tobytes(), (4 * ends[run_at]).tolist()
        self.runs.update(zip(new[0] + new[1], (ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)), strict=True))
        ids, ends = _joined(list(map(self.runs.__getitem__, led + others)), which)
        return ids, ends[first]


def _joined(codes: list[bytes], which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed ids codes[which[0]], codes[which[1]], ... joined, first place of each and the end)."""
    at = np.concatenate(([0], np.cumsum(np.fromiter(map(len, codes), np.int64, len(codes)) // 4)))
    lists = pa.LargeListArray.from_arrays(at, pa.array(np.frombuffer(b"".join(codes), np.int32))).take(pa.array(which))
    ends = lists.offsets.to_numpy() if len(which) else np.zeros(1, np.int64)
    return lists.flatten().to_numpy(), ends - ends[0]


_CODED = pa.schema([("doc_id", pa.int64()), ("packed", pa.binary()), ("rare", pa.list_(pa.string()))])


def _encode_known(pattern: str, known, ranks):
    """(doc_id, packed ids, rare words); a negative id is the number, from -1, of one of the rare words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(pattern, known.value, ranks.value)
        for batch in batches:
            for low, high in text_slices(batch.column(1)):
                codes, at = coder.code(batch.column(1)[low:high])
                packed, rare = [], []
                for a, b in zip(at[:-1], at[1:], strict=True):
                    ids, which = codes[a:b], ()
                    gaps = np.flatnonzero(ids < 0)
                    if len(gaps):
                        ids = ids.copy()
                        which, number = np.unique(-1 - ids[gaps], return_inverse=True)
                        ids[gaps] = -1 - number
                    packed.append(ids.tobytes())
                    rare.append([coder.rare[w] for w in which])
                yield pa.RecordBatch.from_arrays([batch.column(0)[low:high], pa.array(packed, pa.binary()), pa.array(rare, _CODED.field(2).type)], schema=_CODED)
        del coder
        pa.default_memory_pool().release_unused()

    return run


def _filled(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(doc_id, ids, first place of each document and the end) with the pieces of rare words in their places."""
    for low, high, data, at in slices(batch.column(1), _TEXTS):
        ids, first = np.frombuffer(data.tobytes(), np.int32), at // 4
        rare = batch.column(2)[low:high]
        rare_at, piece_at, piece = (rare.offsets.to_numpy() - rare.offsets[0].as_py()).astype(np.int64), *pieces_ids(rare.flatten())
        start, length = np.arange(len(ids)), np.ones(len(ids), np.int64)
        gaps = np.flatnonzero(ids < 0)
        which = rare_at[np.searchsorted(first, gaps, "right") - 1] - 1 - ids[gaps]
        start[gaps], length[gaps] = len(ids) + piece_at[which], piece_at[which + 1] - piece_at[which]
        ends = np.concatenate(([0], np.cumsum(length)))
        yield batch.column(0)[low:high], np.concatenate((ids, piece))[ragged(start, length)], ends[first]


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc_id, ids, at in _filled(batch):
            yield pa.RecordBatch.from_arrays([doc_id, pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))], ["doc_id", "ids"])


def _digests(ranks):
    """Number of ids, digests of the ids and of the bytes they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = [b""] * (max(ranks.value.values()) + 1)
        for piece, rank in ranks.value.items():
            pieces[rank] = piece
        name, piece = [b"%d" % i for i in range(len(pieces))].__getitem__, pieces.__getitem__
        for batch in batches:
            for doc_id, ids, at in _filled(batch):
                each = [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
                joined = ([hashlib.sha256(mark.join(map(of, x))).hexdigest() for x in each] for mark, of in ((b",", name), (b"", piece)))
                yield pa.RecordBatch.from_arrays([doc_id, pa.array(np.diff(at)), *(pa.array(x, pa.string()) for x in joined)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def head_words(texts: DataFrame, pattern: str, most: int = HEAD) -> tuple[DataFrame, DataFrame]:
    """(word, n) of all distinct words, and of the most frequent, at most `most`: those over a count that a histogram of counts gives."""
    words = stored(texts.select("text").mapInArrow(_count_words(pattern), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    step = F.floor(F.log2("n") * 16)
    steps = sorted(words.groupBy(step.alias("step")).count().collect(), reverse=True)  # at most 16 * 63 rows
    total, least = 0, 1 << 62
    for s, n in steps:
        if (total := total + n) > most:
            break
        least = s
    return words, words.where(step >= least)


def _coded(docs: DataFrame, ranks: dict[bytes, int], pattern: str, most: int) -> DataFrame:
    """(doc_id, packed, rare): packed ids, and the pieces of the rare words whose numbers stand among them."""
    spark = small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = rank_table(spark, ranks)
    words = head_words(texts, pattern, most)[1].where((F.octet_length("word") <= LONG) & (F.col("n") > 1))
    folded = words.select("word", table).select("word", _bind(F.col("buckets"), lambda t: fold_merges(F.col("word"), t, ranks)).alias("pieces"))
    # at most `most` words in CLASSES files, which executors fetch from the shared folder; the driver has only their names
    files = stored(folded.mapInArrow(_pack, "class int, part binary").repartition(CLASSES), "packed").inputFiles()
    for file in files:
        spark.sparkContext.addFile(file)
    known = spark.sparkContext.broadcast(KnownParts([f.rpartition("/")[2] for f in files]))
    coded = texts.mapInArrow(_encode_known(pattern, known, spark.sparkContext.broadcast(ranks)), "doc_id long, packed binary, rare array<string>")
    return coded.select("*", table).select("doc_id", "packed", _bind(F.col("buckets"), lambda t: F.transform("rare", lambda w: fold_merges(w, t, ranks))).alias("rare"))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, most: int = HEAD) -> DataFrame:
    """One row per input row: doc_id and ids (array<int>)."""
    return _coded(docs, ranks, pattern, most).mapInArrow(_ids, "doc_id long, ids array<int>")


def encode_digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, most: int = HEAD) -> DataFrame:
    """One row per input row: doc_id, n_tokens, and digests of the decimal ids joined by commas and of the bytes that the ids decode to."""
    shipped = docs.sparkSession.sparkContext.broadcast(ranks)
    return _coded(docs, ranks, pattern, most).mapInArrow(_digests(shipped), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes (binary) of an array of ids."""
    pieces = piece_literal(ranks)
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), ""))

