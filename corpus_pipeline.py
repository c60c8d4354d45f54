"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and reads all that its predecessor kept.

Defined cases, for all stages: a document without doc_id cannot be judged by id and is
kept; rows that share a doc_id are one document, which goes if one of its rows is toxic
or contaminated, and stays among near duplicates if one of its rows does; null texts
stay null; of near duplicates and repeated lines the least doc_id keeps its text; an
empty table gives empty stages; extra columns stay.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm import byte_bpe, decontaminate, line_dedup, near_duplicates, toxicity
from trendloom.llm.common import discard, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    scored = toxicity.score_toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return docs.join(scored.where("predicted = 1").select("doc_id").distinct(), "doc_id", "left_anti")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand earlier; n_chars follows the text."""
    out = line_dedup.remove_repeated_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that of least doc_id."""
    judged = near_duplicates.near_duplicates(docs).groupBy("doc_id").agg(F.bool_or("kept").alias("kept"))
    return docs.join(judged.where("not kept").select("doc_id"), "doc_id", "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    found = decontaminate.find_benchmark(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(found.where("size(found) > 0").select("doc_id").distinct(), "doc_id", "left_anti")


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and of the decoded bytes."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.encode_digests(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("tokens", encode_tokens),
]
#: Trained, approximate and recursive stages have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's result stored and read again."""
    docs, read = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if read is not None:
            discard(read)  # no later stage reads it
        read = docs
    return docs
