"""Document quality: ridge regression on random Fourier features of text statistics.

The statistics of a text (sizes, character classes, repetition of words, word
sequences and lines) are computed once for every document.  Standardised and
bounded, they pass through random Fourier features, whose inner products
approximate a Gaussian kernel (Rahimi and Recht).  Every partition sums its part
of the normal equations of all labelled rows that are not held out; the sums are
added by Spark, and the driver solves a system of fixed size.  Isotonic
regression by pooling adjacent violators, over sums of labels in fixed score
bins, turns ridge scores into probabilities of label 1.

Defined cases: null and empty texts have all-zero statistics and are scored like
any other; repeated rows are scored alike; extra columns are ignored; without
labelled rows every score is 0, with one class it is that class's label.  Labels,
lang, source and doc_id are not inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, slices, stored
from .labelled import is_held_out

THRESHOLD, BINS = 0.7, 512
_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "blank": (9, 11, 12, 13, 32), "newline": (10,),
    "stop": b".,;:", "excited": b"!?", "bar": b"|", "bracket": b"()[]{}<>", "sign": b"#$%&*+-/=@\\^_`~\"'", "high": range(128, 256),
}
_TABLE = np.zeros((256, len(_CLASSES)))
for _j, _c in enumerate(_CLASSES.values()):
    _TABLE[list(_c), _j] = 1
N_STATS = len(_CLASSES) + 11


def statistics(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of N_STATS numbers per text."""
    words = Words(data, at)
    grams, long = words.grams(4), (words.end - words.start).astype(float)
    out = np.zeros((len(at) - 1, N_STATS))
    for i in range(len(at) - 1):
        raw, (a, b) = data[at[i] : at[i + 1]], words.first[i : i + 2]
        n, k = len(raw), b - a
        if not k:
            continue
        counts = np.bincount(raw, minlength=256)
        share = counts[counts > 0] / n
        lines = [x for x in raw.tobytes().split(b"\n") if x.strip()]
        longest = max(map(len, lines))
        _, each = np.unique(words.hash[a:b], return_counts=True)
        out[i, : len(_CLASSES)] = counts @ _TABLE / n
        out[i, len(_CLASSES) :] = (
            np.log1p(n) / 10, np.log1p(k) / 10, long[a:b].mean() / 10, long[a:b].std() / 10, np.log1p(long[a:b].max()) / 10,
            len(each) / k, each.max() / k, len(np.unique(grams[a : b - 3])) / (k - 3) if k > 3 else 1.0, len(set(lines)) / len(lines), np.log1p(longest) / 10, -(share * np.log(share)).sum() / 5,
        )
    return out


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, at in slices(batch.column(1)):
            yield pa.RecordBatch.from_arrays([batch.column(0)[low:high], pa.array([x.tobytes() for x in statistics(data, at)], pa.binary())], ["doc_id", "stats"])


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stats): the statistics as packed doubles, one row per input row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(_described, "doc_id long, stats binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, N_STATS)


class Model:
    """Standardisation, random features, ridge weights and the calibration steps."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int, width: float, seed: int = 11):
        r = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.direction, self.phase = r.standard_normal((N_STATS, features)) / width, r.uniform(0, 2 * np.pi, features)
        self.weights = np.zeros(features + 1)
        self.steps = np.zeros(BINS)

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -8, 8) @ self.direction
        x = np.sqrt(2 / len(self.phase)) * np.cos(x + self.phase)
        return np.concatenate((x, np.ones((len(x), 1))), 1)

    def bins(self, stats: np.ndarray) -> np.ndarray:
        """Score bin of each row; ridge scores from -0.5 to 1.5 share BINS bins."""
        return np.clip(((self.features(stats) @ self.weights + 0.5) / 2 * BINS).astype(np.int64), 0, BINS - 1)


def pool_adjacent_violators(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The nondecreasing sequence nearest to value in weighted squares."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            (v1, w1, n1), (v0, w0, n0) = blocks.pop(), blocks.pop()
            blocks.append([(v0 * w0 + v1 * w1) / (w0 + w1), w0 + w1, n0 + n1])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.zeros(0)


def fit(stats: DataFrame, labels: DataFrame, features: int = 128, width: float = 4.0, ridge: float = 1e-3) -> Model:
    """Fit on every labelled row that is not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label")).where(F.col("label").isin(0.0, 1.0) & ~is_held_out())
    rows = stored(stats.join(known.groupBy("doc_id").agg(F.max("label").alias("label")), "doc_id").select("stats", "label"), "labelled")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, N_STATS))
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                total += [np.full(N_STATS, len(x)), x.sum(0), (x * x).sum(0)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(N_STATS)), *map(pa.array, total)], ["at", "n", "s", "q"])

    sums = rows.mapInArrow(moments, "at long, n double, s double, q double").groupBy("at").agg(F.sum("n"), F.sum("s"), F.sum("q")).orderBy("at").collect()
    n, s, q = np.array([r[1:] for r in sums]).T if sums else np.zeros((3, N_STATS))
    if not n.max():
        return Model(np.zeros(N_STATS), np.ones(N_STATS), features, width)  # of zero weights and steps
    mean = s / n
    model = Model(mean, np.sqrt(np.maximum(q / n - mean * mean, 1e-8)), features, width)

    def normal_equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((features + 1, features + 2))
        for batch in batches:
            if batch.num_rows:
                z, y = model.features(_matrix(batch.column(0))), batch.column(1).to_numpy(zero_copy_only=False)
                total += z.T @ np.concatenate((z, y[:, None]), 1)
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array((i * (features + 2) + j).ravel()), pa.array(total.ravel())], ["at", "part"])

    parts = rows.mapInArrow(normal_equations, "at long, part double").groupBy("at").agg(F.sum("part").alias("part"))
    cells = parts.toPandas().sort_values("at")["part"].to_numpy().reshape(features + 1, features + 2)  # of fixed size
    penalty = np.eye(features + 1) * ridge * n.max() / features
    penalty[-1, -1] = 1e-9 * n.max()
    model.weights = np.linalg.solve(cells[:, :-1] + penalty, cells[:, -1])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, good = np.zeros(BINS), np.zeros(BINS)
        for batch in batches:
            if batch.num_rows:
                at = model.bins(_matrix(batch.column(0)))
                count += np.bincount(at, minlength=BINS)
                good += np.bincount(at, batch.column(1).to_numpy(zero_copy_only=False), BINS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS)), pa.array(count), pa.array(good)], ["bin", "n", "good"])

    table = rows.mapInArrow(binned, "bin long, n double, good double").groupBy("bin").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).toPandas().sort_values("bin")
    some = table["n"].to_numpy() > 0
    steps = pool_adjacent_violators((table["good"] / table["n"]).to_numpy()[some], table["n"].to_numpy()[some])
    model.steps = np.interp(np.arange(BINS), np.flatnonzero(some), steps)
    return model


def score_quality(stats: DataFrame, model: Model) -> DataFrame:
    """One row per row of stats: doc_id, held_out, score, predicted."""
    shipped = stats.sparkSession.sparkContext.broadcast(model)  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shipped.value.steps[shipped.value.bins(_matrix(batch.column(1)))])], ["doc_id", "score"])

    scored = stats.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document; the texts are read once."""
    stats = stored(document_statistics(docs), "statistics")
    return score_quality(stats, fit(stats, labels))
