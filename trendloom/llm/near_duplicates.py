"""MinHash near-duplicates by a chosen-path set similarity join.

A document is the set of its distinct word shingles (ASCII letters folded).
Documents with equal sets form one class first, so copies cost nothing later.
Every class has a sketch of minwise tokens.  In each of `trees` independent
trees a class starts at a minwise token of its own, and a node sends its classes
on by minwise tokens that the node's key chooses, 1/similarity of them on
average (the chosen-path branching of Christiani and Pagh).  Nodes of at most
`small` classes are compared exhaustively, larger nodes branch again.  Classes
that still share a large node at the last level agree in `levels` chosen tokens;
each is first compared with two hubs of the node, the one that met the most classes
in all trees (of a text and its edited copies, the text) and one by chance.  What
the links so far leave in different components of a large node is then compared
exhaustively on full sets: nodes with the same largest component make one group, and
a group is dealt into cells of about `BLOCK` by `BLOCK` classes (fewer, if sets are long).
Components need one link to a group, not all pairs in it; no node is cut and no
class or pair of a node is left out.

Candidates pass a size bound and a bound on equal sketch tokens that a pair at
the threshold fails with a chance below 1e-5; links are confirmed on full sets of
shingles made of the words themselves, without hashes.  Equal sets are told by their
size and two sums over independent 64-bit hashes.

Defined cases: null, empty or blank texts have an empty set and no links; texts
with fewer words than a shingle are one shingle; rows that repeat a doc_id are
one vertex and each is returned; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import TO_LOWER, Words, as_long, discard, exact_grams, mix, slices, stored, together, word_numbers
from .components import connected_components

SKETCH, BLOCK, BLOCK_SHINGLES = 32, 256, 1 << 19
_SALT = mix(np.arange(1, SKETCH + 3, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
_LOW_BITS = 0x0101010101010101


def _sets(column: pa.Array, k: int):
    """(first row, two lists of shingle hashes) of each slice; the first hashes are sorted and distinct, the second those of the same shingles."""
    for low, high, data, at in slices(column):
        words = Words(data, at, TO_LOWER)
        first, again = words.first, words.hashes(1)
        grams, checks = words.grams(k), words.grams(k, again)
        short, short_checks = (words.spans(first[:-1], np.minimum(first[1:], first[:-1] + k), h) for h in (words.hash, again))
        sets, others = [], []
        for i, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
            own, at_own = np.unique(grams[a : b - k + 1], return_index=True) if b - a >= k else (short[i : i + (b > a)], np.zeros(int(b > a), np.int64))
            sets.append(own)
            others.append(checks[a + at_own] if b - a >= k else short_checks[i : i + (b > a)])
        yield low, sets, others


def _describe(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for low, sets, others in _sets(batch.column(1), k):
                n = np.array([len(s) for s in sets])
                d0, d1 = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
                sketch = np.zeros((len(sets), SKETCH), np.uint64)
                if n.any():
                    full, start = n > 0, np.concatenate(([0], np.cumsum(n[n > 0])[:-1]))
                    every = np.concatenate(sets)
                    for j in range(SKETCH):
                        sketch[full, j] = np.minimum.reduceat((every ^ _SALT[j]) * _SALT[j + 1], start)
                    d0[full] = np.add.reduceat(mix(every ^ _SALT[-1]), start)
                    d1[full] = np.add.reduceat(mix(np.concatenate(others) + _SALT[-2]), start)
                yield pa.RecordBatch.from_arrays(
                    [ids[low : low + len(sets)], pa.array(n), pa.array(as_long(d0)), pa.array(as_long(d1)), pa.array([x.tobytes() for x in sketch], pa.binary())],
                    ["doc_id", "n_shingles", "d0", "d1", "sketch"],
                )

    return run


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, SKETCH)


def _child(key: np.ndarray, token: np.ndarray, position: np.ndarray) -> np.ndarray:
    return mix(key ^ mix(token + position.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def _roots(trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, sketch = batch.column(0).to_numpy(zero_copy_only=False), _sketches(batch.column(1))
                for t in range(trees):
                    key = _child(mix(np.full(len(ids), t + 1, np.uint64)), sketch[:, t % SKETCH], np.full(len(ids), t % SKETCH))
                    yield pa.RecordBatch.from_arrays([pa.array(as_long(key)), pa.array(ids)], ["key", "id"])

    return run


def _branches(similarity: float):
    """One child of every row's node, and a second for a share, so that 1/similarity children are expected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key, ids = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), batch.column(1).to_numpy(zero_copy_only=False)
                sketch, rows = _sketches(batch.column(2)), np.arange(len(ids))
                one = (key % np.uint64(SKETCH)).astype(np.int64)
                two = (one + 1 + ((key >> np.uint64(8)) % np.uint64(SKETCH - 1)).astype(np.int64)) % SKETCH
                again = (key >> np.uint64(32)).astype(np.float64) / 2.0**32 < 1 / similarity - 1
                for position, some in ((one, rows), (two, rows[again])):
                    child = _child(key[some], sketch[some, position[some]], position[some])
                    yield pa.RecordBatch.from_arrays([pa.array(as_long(child)), pa.array(ids[some])], ["key", "id"])

    return run


def _words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Folded words, with one blank between: what full sets are made of, and shorter than hashes of shingles."""
    for batch in batches:
        for low, high, data, at in slices(batch.column(1)):
            data = TO_LOWER[data]
            words = [b" ".join(data[a:b].tobytes().split()) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0)[low:high], pa.array(words, pa.binary())], ["id", "members"])


def full_sets(words: list[bytes], k: int) -> list[np.ndarray]:
    """Exact sets of the shingles of different texts: sorted numbers, equal for equal shingles.  A text of fewer than k words has a number of its own."""
    grams = exact_grams(word_numbers(words), k)
    own = max((int(g.max()) for g in grams if len(g)), default=0) + 1
    return [np.unique(g) if len(g) else np.array([own + i]) for i, g in enumerate(grams)]


def _confirm(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for i, pair in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = full_sets([v.as_py() for v in pair], k)
                both = np.sort(np.concatenate((x, y)), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                good[i] = 100 * shared >= percent * (len(x) + len(y) - shared)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good))

    return run


def _compare_cell(k: int, percent: int):
    """Links between rows of different labels, crossing rows with all of a cell; as many as join what they can join."""

    def run(cell: pa.Table) -> pa.Table:
        ids, labels, main, crossing = (cell.column(c).to_numpy() for c in ("id", "label", "main", "crossing"))
        members = cell.column("members").to_pylist()
        place = {m: i for i, m in enumerate(dict.fromkeys(members))}  # a class may stand in both strips
        distinct = full_sets(list(place), k)
        sets = [distinct[place[m]] for m in members]
        xs, ys, links, parent = np.flatnonzero(crossing), np.flatnonzero(~crossing), [], {}
        if len(xs) and len(ys):
            n = np.array([len(v) for v in sets])
            distinct, token = np.unique(np.concatenate([sets[y] for y in ys]), return_inverse=True)
            start = np.cumsum(n[ys]) - n[ys]

            def root(v: int) -> int:
                while (up := parent.get(v, v)) != v:
                    v = up
                return v

            for x in xs:
                at = np.minimum(np.searchsorted(distinct, sets[x]), len(distinct) - 1)
                held = np.zeros(len(distinct), np.int64)
                held[at[distinct[at] == sets[x]]] = 1
                shared = np.add.reduceat(held[token], start)
                near = 100 * shared >= percent * (n[x] + n[ys] - shared)
                for y in ys[near & (labels[ys] != labels[x]) & ((labels[ys] == main[ys]) | (ids[x] < ids[ys]))]:
                    p, q = root(labels[x]), root(labels[y])
                    if p != q:
                        parent[max(p, q)] = min(p, q)
                        links.append(sorted((ids[x], ids[y])))
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pa.table({"a": a, "b": b})

    return run


def least_equal_tokens(similarity: float, miss: float = 1e-5) -> int:
    """Most equal sketch tokens that a pair of this similarity has, but for a chance of `miss`."""
    tail, m = 0.0, 0
    while (tail := tail + comb(SKETCH, m) * similarity**m * (1 - similarity) ** (SKETCH - m)) <= miss:
        m += 1
    return m


def _equal_tokens(x: str, y: str):
    """Equal low bytes of two sketches, of four 8-byte words."""
    different = F.lit(0)
    for j in range(SKETCH // 8):
        d = F.col(f"{x}.b{j}").bitwiseXOR(F.col(f"{y}.b{j}"))
        for by in (4, 2, 1):
            d = d.bitwiseOR(F.shiftrightunsigned(d, by))
        different = different + F.bit_count(d.bitwiseAND(F.lit(_LOW_BITS)))
    return F.lit(SKETCH) - different


_LOW = [f"b{j}" for j in range(SKETCH // 8)]
_CLASSES = "id long, n long, d0 long, d1 long, sketch binary, " + ", ".join(f"{b} long" for b in _LOW)


def _low_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes with the low bytes of their sketches."""
    for batch in batches:
        if batch.num_rows:
            low = np.ascontiguousarray(_sketches(batch.column(4)).astype(np.uint8)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(np.ascontiguousarray(low[:, j])) for j in range(len(_LOW)))], [*batch.schema.names, *_LOW])


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, trees: int = 16, levels: int = 6, small: int = 8) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (least doc_id reachable by links), kept."""
    similarity, least = percent / 100, least_equal_tokens(percent / 100)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described = stored(texts.mapInArrow(_describe(shingle), "doc_id long, n_shingles long, d0 long, d1 long, sketch binary"), "described")
    classes = described.where("n_shingles > 0 and doc_id is not null").groupBy("d0", "d1", F.col("n_shingles").alias("n")).agg(F.min("doc_id").alias("id"), F.min("sketch").alias("sketch"))
    classes = stored(classes.select("id", "n", "d0", "d1", "sketch").mapInArrow(_low_bytes, _CLASSES), "classes")
    marks = classes.select("id", "n", *_LOW)

    def within(x: str, y: str):
        sizes = F.least(f"{x}.n", f"{y}.n") * 100 >= F.greatest(f"{x}.n", f"{y}.n") * percent
        return sizes & (_equal_tokens(x, y) >= least)

    def pair(x: str, y: str) -> list:
        return [F.least(f"{x}.id", f"{y}.id").alias("a"), F.greatest(f"{x}.id", f"{y}.id").alias("b"), _equal_tokens(x, y).alias("equal")]

    # each level is two small plans, the same for all levels, so Spark compiles them once; the pairs of all levels are one plan
    level, nodes = classes.select("id", "sketch").mapInArrow(_roots(trees), "key long, id long"), []
    for depth in range(levels):
        level = stored(level, "level")
        sizes = level.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
        shared = stored(level.join(sizes, "key"), "shared")
        discard(level)
        nodes.append(shared)
        large = shared.where(F.col("size") > small).select("key", "id")
        if depth + 1 < levels:
            level = large.join(classes.select("id", "sketch"), "id").select("key", "id", "sketch").mapInArrow(_branches(similarity), "key long, id long")
    few = together(nodes).where(F.col("size") <= small).join(marks, "id")  # keys of different levels are hashes of different paths
    pairs = few.alias("x").join(few.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.id") < F.col("y.id")) & within("x", "y")).select(*pair("x", "y"))
    found = stored(pairs, "near")
    met = together(nodes).select("id", "size")
    large = stored(large.join(marks, "id").join(met.groupBy("id").agg(F.sum("size").alias("met")), "id"), "large")
    discard(*nodes)
    this = F.struct("id", "n", *_LOW)
    central, chance = F.max_by(this, F.struct("met", -F.col("id"))), F.min_by(this, F.xxhash64("key", "id"))
    hubs = large.groupBy("key").agg(F.array_distinct(F.array(central, chance)).alias("hubs")).select("key", F.explode("hubs").alias("hub")).select("key", "hub.*")
    star = large.alias("x").join(hubs.alias("y").hint("merge"), (F.col("x.key") == F.col("y.key")) & (F.col("x.id") != F.col("y.id")) & within("x", "y")).select(*pair("x", "y"))
    candidates = stored(found.union(star).groupBy("a", "b").agg(F.max("equal").alias("equal")), "pairs")
    discard(found)

    ids = candidates.select(F.col("a").alias("doc_id")).union(candidates.select("b")).union(large.select("id")).distinct()
    sets = texts.join(ids.hint("shuffle_hash"), "doc_id", "left_semi").mapInArrow(_words_of, "id long, members binary")
    sets = stored(sets.groupBy("id").agg(F.max("members").alias("members")), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        x, y = (sets.select(F.col("id").alias(s), F.col("members").alias(f"members_{s}")) for s in "ab")
        return pairs.join(x, "a").join(y, "b").select("a", "b", "members_a", "members_b").mapInArrow(_confirm(shingle, percent), "a long, b long")

    def labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs whose ends are not known to be in one component."""
        for s in "ab":
            pairs = pairs.join(labels.select(F.col("id").alias(s), F.col("label").alias(f"label_{s}")), s, "left").withColumn(f"label_{s}", F.coalesce(f"label_{s}", s))
        return pairs.where("label_a <> label_b").select("a", "b")

    likely = candidates.groupBy("b").agg(F.max_by("a", F.struct("equal", -F.col("a"))).alias("a")).select("a", "b")
    links = stored(confirmed(likely), "confirmed")
    labels = connected_components(links)
    links = stored(links.union(confirmed(labelled(candidates.join(likely, ["a", "b"], "left_anti"), labels))), "confirmed")
    labels = connected_components(links)

    member = large.select("key", "id", "n").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    parts = member.groupBy("key", "label").agg(F.count("*").alias("size"))
    mixed = parts.groupBy("key").agg(F.max_by("label", F.struct("size", "label")).alias("main"), F.count("*").alias("parts")).where("parts > 1").select("key", "main")
    member = stored(member.join(mixed, "key").select("main", "id", "n", "label").distinct(), "mixed")
    outside = F.col("label") != F.col("main")

    def strips(some: Column) -> Column:
        return F.ceil(F.greatest(F.count(F.when(some, 1)) / BLOCK, F.sum(F.when(some, F.col("n"))) / BLOCK_SHINGLES))

    cells = member.groupBy("main").agg(strips(outside).alias("down"), strips(F.lit(True)).alias("across"))

    def dealt(rows: DataFrame, own: str, copied: str, count: str, copies: str) -> DataFrame:
        """Rows in one of `count` strips by their id, once for each of `copies` crossing strips."""
        rows = rows.withColumn(own, F.pmod(F.xxhash64("id", F.lit(own)), count)).withColumn(copied, F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1)))
        return rows.select("main", "i", "j", "id", "label", F.lit(own == "i").alias("crossing"))

    member = member.join(cells, "main")
    member = dealt(member.where(outside), "i", "j", "down", "across").union(dealt(member, "j", "i", "across", "down"))
    # rows dealt to strips stand for many times their estimate, so they are not left to a broadcast; hubs likewise
    late = stored(member.join(sets.hint("merge"), "id").groupBy("main", "i", "j").applyInArrow(_compare_cell(shingle, percent), "a long, b long"), "late")
    if not late.isEmpty():
        labels = connected_components(links.union(late))

    classes = classes.select("d0", "d1", F.col("n").alias("n_shingles"), "id").join(labels, "id", "left")
    out = described.drop("sketch").join(classes, ["d0", "d1", "n_shingles"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("label", "id", "doc_id").alias("component_id"), (F.col("doc_id") == F.coalesce("label", "id", "doc_id")).alias("kept"))
