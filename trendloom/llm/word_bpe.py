"""Word-level BPE encoding and decoding with a minimal acyclic transducer as lexicon.

Words (matches of the pattern in normalised text) are counted over all documents.
The most frequent, at most `LEXICON`, are merged once and compiled into a minimal
acyclic transducer: an automaton over their bytes whose arcs emit ids, as early as
possible, so that words share beginnings and, once nothing more is to be emitted,
endings.  It is one file of arrays in the shared folder, which Spark hands to every
executor, later ones too; tasks map it into memory and follow all distinct words of a
slice of texts at once, a byte a step.  Words outside the lexicon are merged exactly,
all those of a slice at once, very long ones by a heap of ranked pairs.

Special tokens are found in the raw text, as the vocabulary says; what lies between is
composed (NFC), lower-cased letter by letter and split.  Text with characters that
are not yet assigned in Python's tables is normalised and split by the tokenizers library.
Decoding joins the tokens of the ids by blanks, as that library does for a vocabulary
without a decoder.

Defined cases: null texts count as empty and have no ids; repeated rows are encoded
alike; long texts are cut at white space, so memory does not follow their length;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import ragged
from .common import shared_folder, small_batches, stored

LEXICON, MAX_BYTES, CUT_CHARS, GROUP_CHARS, COUNTED = 1 << 17, 64, 1 << 18, 1 << 20, 1 << 17
_SPACE = regex.compile(r"[ \t\n\r]")


@dataclass
class Vocabulary:
    """What a vocabulary file says: ids, ranks of pairs of ids with the joined id, special tokens, the splitting pattern; source: the file's text."""

    ids: dict[str, int]
    pairs: dict[tuple[int, int], tuple[int, int]]
    special: dict[str, int]
    pattern: str
    suffix: str
    source: str

    def __post_init__(self) -> None:
        plain = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or 174 <= b]
        rest = iter(range(256, 512))
        letters = {b: chr(b) if b in plain else chr(next(rest)) for b in range(256)}  # bytes as printable characters
        self.bytes = {c: b for b, c in letters.items()}
        self.inner, self.final = ([self.ids[c + end] for _, c in sorted(letters.items())] for end in ("", self.suffix))
        self.tokens = [""] * (1 + max(*self.ids.values(), *self.special.values()))
        for token, i in (self.ids | self.special).items():
            self.tokens[i] = token


def read_vocabulary(path: str) -> Vocabulary:
    """A file of the tokenizers library: BPE with ends of words, NFC, lower case, byte-level letters; any other kind is an error."""
    with open(path, encoding="utf-8") as f:
        source = f.read()
    raw = json.loads(source)
    steps = [n["type"] for n in raw["normalizer"]["normalizers"]], [p["type"] for p in raw["pre_tokenizer"]["pretokenizers"]]
    plain = all(not a[flag] for a in raw["added_tokens"] for flag in ("single_word", "lstrip", "rstrip", "normalized"))
    model = raw["model"]
    if steps != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]) or not plain or raw["decoder"] or model["type"] != "BPE" or not model["end_of_word_suffix"]:
        raise ValueError(f"{path} is no lower-case BPE with ends of words")
    ids = model["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    pairs = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in reversed(list(enumerate(merges)))}
    pattern = raw["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    return Vocabulary(ids, pairs, {a["content"]: a["id"] for a in raw["added_tokens"]}, pattern, model["end_of_word_suffix"], source)


def merge(word: bytes, vocabulary: Vocabulary) -> tuple[int, ...]:
    """Ids of a word: the pair of least rank, the leftmost of equals, is joined until no pair has a rank."""
    ids = [vocabulary.inner[b] for b in word[:-1]] + [vocabulary.final[word[-1]]]
    n, pairs, heap = len(ids), vocabulary.pairs, []
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n and (found := pairs.get((ids[i], ids[after[i]]))):
            heapq.heappush(heap, (found[0], i, ids[i], ids[after[i]], found[1]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, a, b, joined = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j >= n or ids[j] != b:
            continue
        ids[i], ids[j], after[i] = joined, -1, after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return tuple(x for x in ids if x >= 0)


def _shared(a, b) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


class _State:
    __slots__ = ("arcs", "final")

    def __init__(self) -> None:
        self.arcs: list[list] = []  # [byte, next state or its number, ids]
        self.final: tuple[int, ...] | None = None


def compile_lexicon(entries: list[tuple[bytes, tuple[int, ...]]]) -> bytes:
    """A minimal transducer of distinct words in ascending order, as one block of arrays.

    States leave the path of the last word once a later word parts from it; equal ones
    become one.  Ids move towards the start of the path as far as words agree on them.
    """
    numbers: dict[tuple, int] = {}
    path, last = [_State()], b""

    def freeze(depth: int) -> None:
        while len(path) > depth:
            state = path.pop()
            number = numbers.setdefault((state.final, tuple(map(tuple, state.arcs))), len(numbers))
            if path:
                path[-1].arcs[-1][1] = number
            else:
                numbers["root"] = number

    for word, ids in entries:
        common = _shared(last, word)
        freeze(common + 1)
        for i in range(common):
            arc, below = path[i].arcs[-1], path[i + 1]
            agreed = _shared(arc[2], ids)
            moved = arc[2][agreed:]
            if moved:
                arc[2] = arc[2][:agreed]
                for a in below.arcs:
                    a[2] = moved + a[2]
                if below.final is not None:
                    below.final = moved + below.final
            ids = ids[agreed:]
        for b in word[common:]:
            path[-1].arcs.append([b, None, ids])
            path.append(_State())
            ids = ()
        path[-1].final = ids
        last = word
    freeze(0)
    root = numbers.pop("root")
    outputs: dict[tuple[int, ...], int] = {}
    size = 0
    arcs, finals = [], np.full((len(numbers), 2), -1, np.int64)

    def place(ids: tuple[int, ...]) -> tuple[int, int]:
        nonlocal size
        if ids not in outputs:
            outputs[ids] = size
            size += len(ids)
        return outputs[ids], len(ids)

    for (final, leaving), number in numbers.items():
        arcs += [(number << 8 | b, target, *place(ids)) for b, target, ids in leaving]
        if final is not None:
            finals[number] = place(final)
    table = np.array(sorted(arcs), np.int64).reshape(-1, 4)
    pool = np.array([i for ids in outputs for i in ids], np.int64)
    head = np.array([len(table), len(finals), len(pool), root], np.int64)
    return b"".join(x.tobytes() for x in (head, table.T.copy(), finals.T.copy(), pool))


class Lexicon:
    """A compiled lexicon over its bytes or over a file that is mapped into memory."""

    def __init__(self, source: bytes | str):
        block = np.memmap(source, np.int64, "r") if isinstance(source, str) else np.frombuffer(source, np.int64)
        n_arcs, n_states, n_ids, self.root = block[:4].tolist()
        ends = np.cumsum([4, *[n_arcs] * 4, *[n_states] * 2, n_ids])
        self.key, self.target, self.out_at, self.out_size, self.final_at, self.final_size, self.pool = (block[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True))

    def find(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(whether each word is known, number of its ids, ids of all known words, one word after another)."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(size) - size
        data = np.frombuffer(b"".join(words), np.uint8)
        state, known = np.full(len(words), self.root), (size <= MAX_BYTES) & (size > 0) & (len(self.key) > 0)
        step, who, via = 0, [], []
        while len(live := np.flatnonzero(known & (size > step))):
            key = state[live] << 8 | data[start[live] + step]
            arc = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            hit = self.key[arc] == key
            known[live[~hit]] = False
            live, arc = live[hit], arc[hit]
            state[live] = self.target[arc]
            who.append(live)
            via.append(arc)
            step += 1
        ends = np.flatnonzero(known)
        ends = ends[self.final_at[state[ends]] >= 0]
        known = np.zeros(len(words), bool)
        known[ends] = True
        who, via = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (who, via))
        via, who = via[known[who]], who[known[who]]
        at, length = np.concatenate((self.out_at[via], self.final_at[state[ends]])), np.concatenate((self.out_size[via], self.final_size[state[ends]]))
        who = np.concatenate((who, ends))
        order = np.argsort(who, kind="stable")
        counts = np.bincount(who, length, len(words)).astype(np.int64)
        return known, counts, self.pool[ragged(at[order], length[order])]


class Splitter:
    """Special tokens and words of a text, in runs of bounded length."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.find = regex.compile(vocabulary.pattern).findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")") if vocabulary.special else None
        self.assigned: set[str] = set()
        self.library = None

    def runs(self, text: str) -> Iterator[tuple[bool, str]]:
        """(special, text): special tokens, and the text between, cut after white space."""
        for i, part in enumerate(self.specials.split(text) if self.specials else [text]):
            at = 0
            while i % 2 == 0 and len(part) - at > CUT_CHARS and (space := _SPACE.search(part, at + CUT_CHARS)):
                yield False, part[at : space.end()]
                at = space.end()
            if part[at:]:
                yield bool(i % 2), part[at:]

    def words(self, text: str) -> list[str]:
        if not text.isascii():
            met = set(text) - self.assigned
            self.assigned |= {c for c in met if unicodedata.category(c) != "Cn"}
            if met - self.assigned:
                return self._library_words(text)
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no form of its own at the end of a word
        return self.find(text.lower())

    def _library_words(self, text: str) -> list[str]:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.vocabulary.source)
        found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(self.vocabulary.bytes[c] for c in letters).decode() for letters, _ in found]


def _count_words(shipped):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, counts = Splitter(shipped.value), Counter()
        for batch in batches:
            for text in batch.column(0):
                for special, part in splitter.runs(text.as_py() or ""):
                    if not special:
                        counts.update(splitter.words(part))
                    if len(counts) > COUNTED:
                        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])
                        counts = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    return run


def frequent_words(docs: DataFrame, shipped, most: int = LEXICON) -> DataFrame:
    """Words of at most MAX_BYTES, counted over all documents: those over a count that a histogram of counts gives, at most `most`."""
    words = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_count_words(shipped), "word string, n long")
    words = stored(words.where(F.octet_length("word") <= MAX_BYTES).groupBy("word").agg(F.sum("n").alias("n")), "words")
    step = F.floor(F.log2("n") * 16)
    total, least = 0, 1 << 62
    for s, n in sorted(words.groupBy(step.alias("step")).count().collect(), reverse=True):  # at most 16 * 63 rows
        if (total := total + n) > most:
            break
        least = s
    return words.where(step >= least).select("word")


def _merged(shipped):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = Merger(shipped.value)
        for batch in batches:
            ids = merger.merged([w.encode() for w in batch.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.binary()), pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))], ["word", "ids"])

    return run


def _compiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    entries = [(w, tuple(i)) for b in batches for w, i in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array([compile_lexicon(sorted(entries))], pa.binary())], ["lexicon"])


def ship_lexicon(docs: DataFrame, shipped, most: int = LEXICON) -> str:
    """Compiles the frequent words, writes them to the shared folder and gives executors the file; returns its name.  It has at most `most` words of MAX_BYTES."""
    spark = docs.sparkSession
    merged = frequent_words(docs, shipped, most).mapInArrow(_merged(shipped), "word binary, ids array<int>")
    block = merged.repartition(1).mapInArrow(_compiled, "lexicon binary").first()  # at most `most` words
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}")
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = store.create(target)
    try:
        out.write(bytearray(block["lexicon"] if block else compile_lexicon([])))
    finally:
        out.close()
    spark.sparkContext.addFile(store.makeQualified(target).toString())
    return name


class Merger:
    """`merge` for many words at once: each round joins, in every word, the pair of least rank, the leftmost of equals."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.inner, self.final = vocabulary, np.array(vocabulary.inner), np.array(vocabulary.final)
        self.base = len(vocabulary.tokens) + 1
        pairs = sorted((a * self.base + b, rank, joined) for (a, b), (rank, joined) in vocabulary.pairs.items())
        self.key, self.rank, joined = np.array(pairs, np.int64).reshape(-1, 3).T.copy()
        self.none = int(self.rank.max(initial=0)) + 1
        self.joined = np.zeros(self.none, np.int64)
        self.joined[self.rank] = joined

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.base + b
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.key[at] == key) & (a >= 0), self.rank[at], self.none)

    def _same_width(self, words: list[bytes], width: int) -> np.ndarray:
        """A row of ids for each word of at most `width` bytes, -1 after its end."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        within = np.arange(width) < size[:, None]
        out = np.full((len(words), width + 1), -1)
        out[:, :-1][within] = self.inner[data]
        out[np.arange(len(words)), size - 1] = self.final[data[np.cumsum(size) - 1]]
        who, ids = np.arange(len(words)), out.copy()
        ranks = self._ranks(ids[:, :-1], ids[:, 1:])
        columns = np.arange(width)
        while True:
            at = ranks.argmin(1)
            best = ranks[np.arange(len(who)), at]
            live = best < self.none
            if not live.all():
                out[who[~live]] = ids[~live]
                who, ids, ranks, at, best = who[live], ids[live], ranks[live], at[live], best[live]
            if not len(who):
                return out
            row = np.arange(len(who))
            ids[row, at] = self.joined[best]
            later = columns > at[:, None]
            ids[:, :-1] = np.where(later, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            ranks[:, :-1] = np.where(later[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = self.none
            ranks[row, at] = self._ranks(ids[row, at], ids[row, at + 1])
            inside = np.flatnonzero(at > 0)
            ranks[inside, at[inside] - 1] = self._ranks(ids[inside, at[inside] - 1], ids[inside, at[inside]])

    def merged(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word; words are merged in classes of like width, very long ones by the heap."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        low = 0
        for width in (8, 12, 16, 24, 40, MAX_BYTES):
            some = np.flatnonzero((size > low) & (size <= width)).tolist()
            if some:
                ids = self._same_width([words[i] for i in some], width)
                counts = (ids >= 0).sum(1)
                for i, x in zip(some, np.split(ids[ids >= 0], np.cumsum(counts)[:-1]), strict=True):
                    out[i] = x
            low = width
        for i in np.flatnonzero(size > MAX_BYTES).tolist():
            out[i] = np.array(merge(words[i], self.vocabulary))
        return out


class Coder:
    """Ids of words: those of the lexicon at once, others by merges."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon, self.merger = vocabulary, lexicon, Merger(vocabulary)

    def code(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, one word after another; number of ids of each word)."""
        raw = [w.encode() for w in words]
        known, counts, ids = self.lexicon.find(raw)
        if known.all():
            return ids, counts
        own = self.merger.merged([raw[i] for i in np.flatnonzero(~known).tolist()])
        counts[~known] = list(map(len, own))
        out = np.empty(counts.sum(), np.int64)
        mine = np.repeat(known, counts)
        out[mine], out[~mine] = ids, np.concatenate(own)
        return out, counts


def _groups(column: pa.Array, splitter: Splitter) -> Iterator[tuple[list[int], list[list[str]]]]:
    """Runs of several texts, about GROUP_CHARS characters at a time: the text's place, and its words or its one special token led by None."""
    places, found, size = [], [], 0
    for place, text in enumerate(column):
        places.append(place)
        found.append([])
        for special, part in splitter.runs(text.as_py() or ""):
            places.append(place)
            found.append([None, part] if special else splitter.words(part))
            size += len(part)
            if size > GROUP_CHARS:
                yield places, found
                places, found, size = [], [], 0
    if places:
        yield places, found


def _coded(column: pa.Array, splitter: Splitter, coder: Coder) -> Iterator[tuple[int, np.ndarray]]:
    """(place of a text, next ids of it): every text at least once, in order."""
    special = coder.vocabulary.special
    for places, found in _groups(column, splitter):
        flat = pa.array([w for words in found if not (words and words[0] is None) for w in words], pa.string()).dictionary_encode()
        ids, counts = coder.code(flat.dictionary.to_pylist())
        first, which = np.cumsum(counts) - counts, flat.indices.to_numpy()
        size = counts[which]
        every, ends = ids[ragged(first[which], size)], np.concatenate(([0], np.cumsum(size)))
        at = 0
        for place, words in zip(places, found, strict=True):
            if words and words[0] is None:
                yield place, np.array([special[words[1]]])
            else:
                yield place, every[ends[at] : ends[at + len(words)]]
                at += len(words)


def _encoded(name: str, shipped, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shipped.value
        splitter, coder = Splitter(vocabulary), Coder(vocabulary, Lexicon(SparkFiles.get(name)))
        token = vocabulary.tokens.__getitem__
        for batch in batches:
            n = len(batch.column(1))
            counts, parts = np.zeros(n, np.int64), [[] for _ in range(0 if digests else n)]
            sums, current, place = [], None, -1
            for at, ids in _coded(batch.column(1), splitter, coder):
                if not digests:
                    parts[at].append(ids)
                    continue
                if at != place:
                    sums += [[x.hexdigest() for x in current]] if current else []
                    current, place = (hashlib.sha256(), hashlib.sha256()), at
                if len(ids):
                    current[0].update(ids.astype("<u4").tobytes())
                    current[1].update(((" " if counts[at] else "") + " ".join(map(token, ids.tolist()))).encode())
                    counts[at] += len(ids)
            if digests:
                sums += [[x.hexdigest() for x in current]] if current else []
                columns = list(zip(*sums, strict=True)) or [(), ()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts), *(pa.array(c, pa.string()) for c in columns)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.concatenate(p).astype(np.int32) for p in parts], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return run


def _run(docs: DataFrame, vocabulary: Vocabulary, most: int, digests: bool, columns: str) -> DataFrame:
    spark = small_batches(docs.sparkSession)
    shipped = spark.sparkContext.broadcast(vocabulary)  # a vocabulary file
    name = ship_lexicon(docs, shipped, most)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_encoded(name, shipped, digests), columns)


def encode(docs: DataFrame, vocabulary: Vocabulary, most: int = LEXICON) -> DataFrame:
    """One row per input row: doc_id and ids (array<int>)."""
    return _run(docs, vocabulary, most, False, "doc_id long, ids array<int>")


def encode_digests(docs: DataFrame, vocabulary: Vocabulary, most: int = LEXICON) -> DataFrame:
    """One row per input row: doc_id, n_tokens, and digests of the ids as little-endian 32-bit integers and of the text that they decode to."""
    return _run(docs, vocabulary, most, True, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id and text of rows of doc_id and ids: the tokens joined by blanks; an id outside the vocabulary is left out."""
    tokens = encoded.sparkSession.sparkContext.broadcast(vocabulary.tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokens.value
        for batch in batches:
            texts = [" ".join(known[i] for i in ids or () if i is not None and 0 <= i < len(known) and known[i]) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")
