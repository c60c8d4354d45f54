"""A bounded sample of labelled texts on which the classifiers are fitted.

Rows whose crc32(doc_id as text) mod 4 is 2 are held out and never read here.
The bound is `most` rows and `most_chars` characters per class, taken in the order
of a hash of doc_id, so the sample does not depend on partitions or on the size of
the cluster.  Texts are taken whole or not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def is_held_out(doc_id: str | Column = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 4 == 2


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, most_chars: int) -> DataFrame:
    """(doc_id, text, label) of at most `most` rows per class whose texts have at most `most_chars` characters together; a doc_id with several labels takes the largest, one with several texts the least."""
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    ids = ids.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out()).groupBy("doc_id").agg(F.max("label").alias("label"))
    order = [F.xxhash64(F.lit(label), "doc_id"), "doc_id"]
    picked = ids.where("label = 1").orderBy(*order).limit(most).union(ids.where("label = 0").orderBy(*order).limit(most))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull() & (F.char_length("text") <= most_chars))
    rows = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # the broadcast side has 2 * most rows
    so_far = F.sum(F.char_length("text")).over(W.partitionBy("label").orderBy(*order))
    return rows.withColumn("so_far", so_far).where(F.col("so_far") <= most_chars).select("doc_id", "text", "label")
