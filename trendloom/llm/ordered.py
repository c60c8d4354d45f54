"""Places of rows within groups and digests of a group's rows in order, for groups of any size.

Both deal rows out by ranges of (group, order), so that the rows of a large group
spread over many tasks; what joins the parts has a row per partition or per megabyte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import stored

PIECE_CHARS = 1 << 20


def numbered(rows: DataFrame, key: str, order: list[str], keep: list[str], place: str) -> DataFrame:
    """(key, *keep, place): the place from 0 of each row among those of its key, by `order`, nulls first.

    Rows equal in `order` are interchangeable.  Rows of a key lie in one range of
    partitions; only the first key of a partition can go on from an earlier one,
    so the shifts that are broadcast have a row per partition at most.
    """
    part, at, n = "_part", "_at", "_n"
    local = rows.repartitionByRange(key, *order).withColumn(part, F.spark_partition_id())
    local = local.withColumn(at, F.row_number().over(W.partitionBy(part, key).orderBy(*order)).cast("long") - 1)
    local = stored(local.select(key, *keep, part, at), "numbered")
    runs = local.groupBy(key, part).agg((F.max(at) + 1).alias(n))
    before = F.sum(n).over(W.partitionBy(key).orderBy(part).rowsBetween(W.unboundedPreceding, -1))
    shifts = runs.select(F.col(key).alias("_key"), F.col(part).alias("_in"), before.alias("_shift")).where("_shift > 0")
    out = local.join(F.broadcast(shifts), F.col(key).eqNullSafe(F.col("_key")) & (F.col(part) == F.col("_in")), "left")
    return out.select(key, *keep, (F.col(at) + F.coalesce("_shift", F.lit(0))).alias(place))


def _pieces(sep: str):
    """Neighbouring rows of a group joined, up to PIECE_CHARS at a time: key columns, first place, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, first, texts, size, schema = None, None, [], 0, None

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, (*head, first, sep.join(texts)), strict=True))], schema=schema)

        for batch in batches:
            schema = batch.schema
            *keys, seq, text = (c.to_pylist() for c in batch.columns)
            for row in zip(zip(*keys, strict=True), seq, text, strict=True):
                if texts and (row[0] != head or size > PIECE_CHARS):
                    yield flush()
                    texts, size = [], 0
                if not texts:
                    head, first = row[0], row[1]
                texts.append(row[2])
                size += len(row[2])
        if texts:
            yield flush()

    return run


def _digests(sep: bytes, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, digest, done = None, None, []

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:-1]), pa.array(columns[-1], pa.string())], names)

        for batch in batches:
            *keys, _, text = (c.to_pylist() for c in batch.columns)
            for key, piece in zip(zip(*keys, strict=True), text, strict=True):
                if digest is not None and key == head:
                    digest.update(sep)
                else:
                    if digest is not None:
                        done.append((*head, digest.hexdigest()))
                    head, digest = key, hashlib.sha256()
                digest.update(piece.encode())
            if done:
                yield flush(done)
                done = []
        if digest is not None:
            yield flush([(*head, digest.hexdigest())])

    return run


def joined_digests(rows: DataFrame, key: list[str], seq: str, text: str, sep: str, name: str) -> DataFrame:
    """(*key, name): SHA-256 of each group's texts in the order of seq, joined by sep.

    key columns and seq are long.  Ranges of rows are joined to pieces first; a digest
    must read its group in order, and takes it piece by piece, never as a whole.
    """
    kinds = ", ".join(f"`{k}` long" for k in key)
    dealt = rows.select(*key, seq, text).repartitionByRange(*key, seq).sortWithinPartitions(*key, seq)
    pieces = stored(dealt.mapInArrow(_pieces(sep), f"{kinds}, `{seq}` long, `{text}` string"), "pieces")
    dealt = pieces.repartition(*key).sortWithinPartitions(*key, seq)
    return dealt.mapInArrow(_digests(sep.encode(), [*key, name]), f"{kinds}, `{name}` string")
