"""Helpers shared by the training-data operators.

Words are runs of bytes other than blank, tab, line feed, vertical tab, form
feed and carriage return.  All vector work reads the Arrow string buffers, in
slices of a bounded number of bytes, so memory does not follow batch sizes.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

MASK64 = (1 << 64) - 1
SLICE_BYTES = 1 << 20
_ODD = 0x9E3779B97F4A7C15

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler (the finaliser published with SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_LONG = 16  # chunks after which a range is hashed on its own


def _keys(seed: int, j: np.ndarray) -> np.ndarray:
    return mix((j.astype(np.uint64) + np.uint64(seed << 32 | 1)) * np.uint64(_ODD))


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the bytes data[start:end]: sums of scrambled 8-byte chunks, each under the key of its place, so no sequence of bytes cancels out."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    loads = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    n = end - start
    out = n.astype(np.uint64) * np.uint64(_ODD)
    who, at, left, j = np.flatnonzero(n), start[n > 0], n[n > 0], 0
    key = _keys(seed, np.arange(_LONG))
    while len(who) and j < _LONG:
        out[who] += mix((loads[at] & _MASKS[np.minimum(left, 8)]) ^ key[j])
        some = np.flatnonzero(left > 8)
        who, at, left, j = who[some], at[some] + 8, left[some] - 8, j + 1
    for i, a, m in zip(who, at, left, strict=True):
        places = np.arange(0, m, 8)
        out[i] += mix((loads[a + places] & _MASKS[np.minimum(m - places, 8)]) ^ _keys(seed, _LONG + places // 8)).sum(dtype=np.uint64)
    return mix(out)


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, b in (("up", self.base), ("down", self.inverse)):
                steps = np.full(n, b, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_WORDS = Powers(0xA0761D6478BD642F)
#: Prefix sums modulo 2**64 tell ranges of up to so many values apart; over some longer sequences they cancel out.
MOST_RANGE = 128


def short_ranges(values: np.ndarray, powers: Powers, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of values[start:end], of at most MOST_RANGE values each, wherever they stand."""
    if len(start) and (end - start).max() > MOST_RANGE:
        raise ValueError(f"at most {MOST_RANGE} values")
    up, down = powers.upto(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(_ODD))


class Words:
    """The words of a few texts: hash, byte range, and first[i]:first[i+1] of text i."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, fold: np.ndarray = SAME, seed: int = 0):
        self.data, self.offsets = data if fold is SAME else fold[data], offsets
        inside = np.zeros(len(data) + 2, bool)
        np.logical_not(IS_SPACE[data], out=inside[1:-1])
        starts = inside[1:-1] & ~inside[:-2]
        ends = inside[1:-1] & ~inside[2:]
        edge = offsets[1:-1]
        edge = edge[(edge > 0) & (edge < len(data))]
        both = edge[inside[edge] & inside[edge + 1]]  # a text ends and the next begins without a blank
        starts[both] = True
        ends[both - 1] = True
        self.start, self.end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.hash = self.hashes(seed)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, seed: int) -> np.ndarray:
        return hash_ranges(self.data, self.start, self.end, seed)

    def grams(self, k: int, hashes: np.ndarray | None = None) -> np.ndarray:
        """Hash of the k words from each word on (empty with fewer than k words)."""
        at = np.arange(max(0, len(self) - k + 1))
        return self.spans(at, at + k, hashes)

    def spans(self, start: np.ndarray, end: np.ndarray, hashes: np.ndarray | None = None) -> np.ndarray:
        return short_ranges(self.hash if hashes is None else hashes, _WORDS, start, end)


def word_numbers(texts: list[bytes]) -> list[np.ndarray]:
    """Numbers of each text's words, equal for equal words: exact, no hash."""
    known: dict[bytes, int] = {}
    return [np.array([known.setdefault(w, len(known)) for w in t.split()], np.int64) for t in texts]


def exact_grams(numbers: list[np.ndarray], k: int) -> list[np.ndarray]:
    """For each sequence, a number for the k values from each value on, equal for equal ones in all sequences."""
    codes = numbers
    for step in range(1, k):
        codes = [c[:-1] * (1 << 31) + x[step:] if len(x) > step else c[:0] for c, x in zip(codes, numbers, strict=True)]
        cut = np.cumsum([len(c) for c in codes])[:-1]
        codes = np.split(np.unique(np.concatenate(codes), return_inverse=True)[1], cut)
    return codes


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about `most` bytes."""
    data, at = text_buffers(column)
    low, n = 0, len(at) - 1
    while low < n:
        high = min(n, max(low + 1, int(np.searchsorted(at, at[low] + most, "right")) - 1))
        yield low, high, data[at[low] : at[high]], at[low : high + 1] - at[low]
        low = high


def as_long(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; a session of one process may go without, a cluster may not."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder and spark.sparkContext.master.startswith("local["):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def small_batches(spark: SparkSession, rows: int = 1000) -> SparkSession:
    """Arrow batches of whole texts are held several times at once: where the session has Spark's default of 10000 rows, sets fewer."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, "10000") == "10000":
        spark.conf.set(name, str(rows))
    return spark


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to a new folder below the shared one and read back: cuts lineage, survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    df.sparkSession._jvm.System.gc()  # Spark removes the shuffle files of plans that the driver has collected, and only then
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(frames: list[DataFrame]) -> DataFrame:
    """Frames of one schema written by stored(), read by one scan: a plan over them does not grow with their number."""
    folders = dict.fromkeys(f.rpartition("/")[0] for df in frames for f in df.inputFiles())
    return frames[0].sparkSession.read.schema(frames[0].schema).parquet(*folders)


def discard(*frames: DataFrame) -> None:
    """Remove folders written by stored(), once nothing reads them any more."""
    for df in frames:
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def columns_free(df: DataFrame, *wanted: str) -> list[str]:
    """Names like `wanted` that no column of df has (clashes differ by case too)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
