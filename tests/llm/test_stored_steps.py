"""What operators leave on disk between their steps, and how large the plans of these steps are."""

import os
import re

import pytest

pytest.importorskip("public_tokenizers")
from trendloom.llm import byte_bpe, common, line_dedup, near_duplicates, repeated_spans  # noqa: E402


@pytest.fixture(scope="module")
def texts(spark):
    lines = [f"this is the line with number {i} of all the lines of a text" for i in range(12)]
    words = " ".join(f"word{i}" for i in range(90))
    rows = [(i, "\n".join(lines[i % 4 : i % 4 + 5])) for i in range(8)] + [(20 + i, words + " and more" * i) for i in range(4)] + [(30, ""), (31, None)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(2)


def _folders(spark):
    top = common.shared_folder(spark).removeprefix("file:")
    return set(os.listdir(top)) if os.path.isdir(top) else set()


def test_line_dedup_leaves_numbers_of_lines_alone(spark, texts):
    before = _folders(spark)
    out = line_dedup.remove_repeated_lines(texts)
    left = sorted(re.sub("-.*", "", f) for f in _folders(spark) - before)
    assert left == ["gone"]  # before, all lines, the distinct ones and their texts stood beside the last plan's shuffles
    assert out.where("n_gone > 0").count() > 0


def test_repeated_spans_leave_asks_alone(spark, texts):
    before = _folders(spark)
    out = repeated_spans.remove_repeated_spans(texts)
    left = sorted(re.sub("-.*", "", f) for f in _folders(spark) - before)
    assert left == ["asks"]  # before, all paths and visits stood beside the last plan's shuffles
    assert out.where("n_removed > 0").count() > 0


def test_plans_of_near_duplicates_do_not_grow_with_levels(texts, monkeypatch):
    joins = {}

    def spy(levels):
        def store(df, label):
            joins.setdefault(levels, []).append(len(re.findall(r"\bJoin\b", df._jdf.queryExecution().optimizedPlan().toString())))
            return common.stored(df, label)

        return store

    for levels in (2, 4):
        monkeypatch.setattr(near_duplicates, "stored", spy(levels))
        got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(texts, 3, 85, levels=levels).collect()}
        assert got[21] == 20
    assert max(joins[4]) == max(joins[2])  # before, one plan held the pairs of all levels


def test_packed_words_do_not_pass_the_driver(spark, texts, monkeypatch):
    shipped = []
    broadcast = spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda x: shipped.append(x) or broadcast(x))
    ranks = {bytes([i]): i for i in range(256)} | {b"wo": 256, b"rd": 257, b"word": 258}
    got = {r.doc_id: r.ids for r in byte_bpe.encode(texts, ranks, r"\s?\S+|\s+").collect()}
    assert got[20][:3] == [258, ord("0"), ord(" ")] and got[30] == []
    known = next(x for x in shipped if isinstance(x, byte_bpe.KnownParts))
    assert all(isinstance(f, str) for f in known.files) and not known.parts  # before, the packed tables themselves were collected and broadcast


def test_pairs_of_all_levels_are_one_plan(texts, monkeypatch):
    steps = {}

    def spy(levels):
        return lambda df, label: steps.setdefault(levels, []).append(label) or common.stored(df, label)

    for levels in (2, 4):
        monkeypatch.setattr(near_duplicates, "stored", spy(levels))
        got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(texts, 3, 85, levels=levels).collect()}
        assert got[21] == 20
    assert steps[4].count("near") == steps[2].count("near") == 1  # before, each level had a plan of its own for its pairs


def test_plans_of_byte_bpe_do_not_hold_the_ranks(texts, monkeypatch):
    plans = []

    def store(df, label):
        plans.append(df._jdf.queryExecution().toString())
        return common.stored(df, label)

    monkeypatch.setattr(byte_bpe, "stored", store)
    ranks = {bytes([i]): i for i in range(256)} | {b"wo": 256, b"rd": 257, b"word": 258}
    out = byte_bpe.encode(texts, ranks, r"\s?\S+|\s+")
    plans.append(out._jdf.queryExecution().toString())
    assert {r.doc_id: r.ids for r in out.collect()}[20][:3] == [258, ord("0"), ord(" ")]
    assert max(map(len, plans)) < 30_000  # before, each held all buckets of the ranks, several times


def _broadcasts(monkeypatch, module):
    """What the plans of the module's steps join by broadcast, filled as they are stored."""
    found = []

    def store(df, label):
        found.extend(re.findall(r"\bBroadcastHashJoin.*", df._jdf.queryExecution().executedPlan().toString()))
        return common.stored(df, label)

    monkeypatch.setattr(module, "stored", store)
    return found


def test_line_dedup_broadcasts_nothing(texts, monkeypatch):
    found = _broadcasts(monkeypatch, line_dedup)
    assert line_dedup.remove_repeated_lines(texts).where("n_gone > 0").count() > 0
    assert not found  # before, all deletion variants were, where Spark took the exploded rows for a small table


def test_near_duplicates_broadcast_no_exploded_rows(spark, texts, monkeypatch):
    plans = []
    monkeypatch.setattr(near_duplicates, "stored", lambda df, label: plans.append((label, df._jdf.queryExecution().executedPlan())) or common.stored(df, label))
    assert {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(texts, 3, 85).collect()}[21] == 20
    for label, plan in plans:
        for i, node in enumerate(lines := plan.toString().split("\n")):
            if "BroadcastExchange" in node:  # what stands deeper, up to the next node as high, is broadcast
                depth = len(node) - len(node.lstrip(" :+-*()0123456789"))
                below = []
                for x in lines[i + 1 :]:
                    if len(x) - len(x.lstrip(" :+-*()0123456789")) <= depth:
                        break
                    below.append(x)
                assert not any("Generate" in x for x in below), label  # before, hubs and rows dealt to strips were
