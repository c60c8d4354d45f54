"""Connected components by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, label) of every vertex of `links`; label is the least id of its component.

    Each round takes the least label among neighbours, then the label of that
    label.  A vertex with many links is met by partial minima and by joins whose
    large keys Spark splits.  Rounds are written to the shared folder.
    """
    both = links.select(F.col(a).alias("id"), F.col(b).alias("to")).where("id <> to").distinct()
    both = stored(both.union(both.select("to", "id")).distinct(), "links")
    labels = stored(both.groupBy("id").agg(F.least(F.col("id"), F.min("to")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "to"), "to").groupBy("id").agg(F.min("label").alias("near"))
        step = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("next"))
        jump = step.select(F.col("id").alias("next"), F.col("next").alias("far"))
        step = stored(step.join(jump, "next").select("id", F.least("next", "far").alias("label"), (F.least("next", "far") < F.col("label")).alias("moved")), "labels")
        labels = step.select("id", "label")
        if step.where("moved").isEmpty():
            return labels
