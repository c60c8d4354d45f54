"""Repair of conversations' structure by alignment to an alternating grammar.

A conversation's roles should read as (s?(ua)+)?: an optional system turn, then pairs
of user and assistant, or nothing.  For each feasible length the grammar has one
string from a given state, so turns are aligned to it by the Wagner-Fischer
recurrence: keep 0, rerole 1, delete 2 (the only edit of blank and duplicate turns),
insert 5; a truncated turn that is not deleted adds 5.  A cell is computed only if the
least cost through it, 5 for each surplus insertion and 2 for each surplus deletion,
does not exceed the incumbent, the cheapest alignment so far (Ukkonen's band); lengths
are tried in the order of that bound.  Each optimal table is traced for its audit, the
letters of the edits, and the ASCII-least audit of all lengths is kept.

Conversations are cut into blocks of BLOCK turns.  A block's alignments lead from each
of the grammar's four states to each other at a least cost; costs of what follows are
carried from the last block to the first as one number per state, and the chosen
states from the first to the last.  Insertions belong to the turn that they precede,
so audits of a block never are beginnings of one another, and the least audit of each
block in turn is the least audit of the conversation.  Only those four numbers are
handed on in order; tables are computed block by block in any task.

Defined cases: null roles and texts become one blank, as a null turn does in its key;
turns are ordered by turn (null first), then role, then text; rows without conv_id are
one conversation; equal rows are duplicates; an empty table has no conversations;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns_free, discard, stored
from .ordered import joined_digests, numbered

BLOCK, FAR = 32, 1 << 40
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
#: States: nothing yet, after s, after u, after ua; each with the state after u or a, whichever may follow.
START, SYSTEM, USER, PAIR = range(4)
NEXT = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", PAIR), PAIR: ("u", USER)}
#: What must be inserted at the end of a conversation in each state, and its cost.
CLOSING = ("", "II", "I", "")
ENDS = tuple(INSERT * len(x) for x in CLOSING)
KEEPABLE, FAULTY = "suax", "SUAX"
ROLES = {"u": "user", "a": "assistant"}


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that crc32 of `conv_id:turn` modulo 20 deals: 0 drops, 1 empties, 2 strips [.!?], 3 repeats, 4 makes it a user's."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind")).where("kind > 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")


def faults(rows: DataFrame) -> DataFrame:
    """Numbered rows with fault: blank, duplicate, truncated or null; the first that holds."""
    # first occurrences by partial minima, then a join on places, which are unique: a text that recurs is no skew
    first = rows.groupBy("conv_id", "role", "text").agg(F.min("at").alias("at")).select(F.col("conv_id").alias("_id"), F.col("at").alias("_at"), F.lit(True).alias("_first"))
    rows = rows.join(first, F.col("conv_id").eqNullSafe(F.col("_id")) & (F.col("at") == F.col("_at")), "left")
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank").when(F.col("_first").isNull(), "duplicate").when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated")
    return rows.select("conv_id", "at", "role", "text", fault.alias("fault"))


def _symbols(role: Column, fault: Column) -> tuple[Column, Column]:
    """(symbol: the initial, upper case if truncated, '-' if it must go; initial), x for any other initial."""
    initial = F.when(F.substring(role, 1, 1).isin("s", "u", "a"), F.substring(role, 1, 1)).otherwise("x")
    return F.when(fault.isin("blank", "duplicate"), "-").when(fault == "truncated", F.upper(initial)).otherwise(initial), initial


def _target(state: int, system: bool, length: int) -> tuple[str, int]:
    """The grammar's string of that length from a state, with or without a leading s, and the state it leads to."""
    out = "s" if system else ""
    state = SYSTEM if system else state
    while len(out) < length:
        letter, state = NEXT[state]
        out += letter
    return out, state


def _keep(symbol: str, letter: str) -> int:
    """Cost of taking a turn for a letter, kept or reroled; FAR if it cannot be."""
    if symbol == "-":
        return FAR
    same = symbol.lower() == letter
    return FAR if letter == "s" and not same else (0 if same else REROLE) + (CUT if symbol.isupper() else 0)


def _table(symbols: str, target: str, most: int) -> list[dict[int, int]]:
    """Costs from turn i and letter j on to the end, within the band of `most`; a block ends with a turn, so no insertion follows its last."""
    n, m = len(symbols), len(target)
    least = lambda ins, dels: INSERT * max(0, ins - dels) + DELETE * max(0, dels - ins)
    rest: dict[int, int] = {m: 0}
    rows = [rest]
    for i in range(n - 1, -1, -1):
        row: dict[int, int] = {}
        for j in range(m, -1, -1):
            if least(j, i) + least(m - j, n - i) > most:
                continue
            cost = rest.get(j, FAR) + DELETE
            if j < m:
                cost = min(cost, rest.get(j + 1, FAR) + _keep(symbols[i], target[j]), row.get(j + 1, FAR) + (INSERT if target[j] != "s" else FAR))
            if cost < FAR:
                row[j] = cost
        rows.append(row)
        rest = row
    return rows[::-1]


def _trace(symbols: str, target: str, rows: list[dict[int, int]]) -> str:
    """The ASCII-least audit of the cheapest alignments: D before I before K before R."""
    i = j = 0
    out = ""
    while i < len(symbols):
        left = rows[i][j]
        if rows[i + 1].get(j, FAR) + DELETE == left:
            out, i = out + "D", i + 1
        elif j < len(target) and target[j] != "s" and rows[i].get(j + 1, FAR) + INSERT == left:
            out, j = out + "I", j + 1
        else:
            out, i, j = out + ("K" if symbols[i].lower() == target[j] else "R"), i + 1, j + 1
    return out


@lru_cache(maxsize=1 << 16)
def aligned(symbols: str, state: int, ends: tuple[int, int, int, int]) -> tuple[int, str, int]:
    """(cost, audit, state after it) of the cheapest alignment of a block from a state, with ends[s] for what follows state s."""
    n = len(symbols)
    bound = lambda m: max(0, INSERT * (m - n), DELETE * (n - m))
    best: tuple[int, str, int] | None = None
    low = min(ends)
    for m in sorted(range(2 * n + 3), key=bound):
        if best is not None and bound(m) + low > best[0]:
            break  # every further length costs more
        for system in (False, True) if state == START and m else (False,):
            target, after = _target(state, system, m)
            if ends[after] >= FAR or (best is not None and bound(m) + ends[after] > best[0]):
                continue
            rows = _table(symbols, target, FAR if best is None else best[0] - ends[after])
            cost = rows[0].get(0, FAR) + ends[after]
            if cost < FAR and (best is None or cost <= best[0]):
                found = (cost, _trace(symbols, target, rows), after)
                best = found if best is None else min(best, found)
    return best or (FAR, "", state)


@lru_cache(maxsize=1 << 16)
def passages(symbols: str) -> tuple[int, ...]:
    """Least costs of a block from each state to each state, row by row; FAR if there is no way."""
    only = lambda t: tuple(0 if s == t else FAR for s in range(4))
    return tuple(min(FAR, aligned(symbols, s, only(t))[0]) for s in range(4) for t in range(4))


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        costs = [passages(s) for s in b.column("symbols").to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.select(["conv_id", "block"]).columns, pa.array(costs, pa.list_(pa.int64()))], ["conv_id", "block", "costs"])


def _carry_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a conversation from the last block on: what follows each block, less its least cost."""
    conv, ends, any_yet = None, ENDS, False
    for b in batches:
        out = []
        for c, costs in zip(b.column("conv_id").to_pylist(), b.column("costs").to_pylist(), strict=True):
            if not any_yet or c != conv:
                conv, ends, any_yet = c, ENDS, True
            out.append(ends)
            way = [min(costs[4 * s + t] + ends[t] for t in range(4)) for s in range(4)]
            ends = tuple(min(FAR, w - min(way)) for w in way)
        yield pa.RecordBatch.from_arrays([*b.select(["conv_id", "block"]).columns, pa.array(out, pa.list_(pa.int64()))], ["conv_id", "block", "ends"])


_WAYS = pa.struct([("audit", pa.string()), ("after", pa.int32()), ("cost", pa.int64())])


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The audit, the state after it and the cost of a block from each state."""
    for b in batches:
        ways = []
        for symbols, ends, first in zip(b.column("symbols").to_pylist(), b.column("ends").to_pylist(), b.column("block").to_pylist(), strict=True):
            ends = ENDS if ends is None else tuple(ends)
            found = [aligned(symbols, s, ends) if first or s == START else (FAR, "", s) for s in range(4)]
            ways.append([{"audit": audit, "after": after, "cost": cost - ends[after]} for cost, audit, after in found])
        yield pa.RecordBatch.from_arrays([*b.select(["conv_id", "block", "symbols"]).columns, pa.array(ways, pa.list_(_WAYS))], ["conv_id", "block", "symbols", "ways"])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a conversation from its first block on: the state that each block is entered in."""
    conv, state, any_yet = None, START, False
    for b in batches:
        entry, audit, cost, after = [], [], [], []
        for c, ways in zip(b.column("conv_id").to_pylist(), b.column("ways").to_pylist(), strict=True):
            if not any_yet or c != conv:
                conv, state, any_yet = c, START, True
            way = ways[state]
            entry.append(state)
            audit.append(way["audit"])
            cost.append(way["cost"])
            state = way["after"]
            after.append(state)
        arrays = [*b.select(["conv_id", "block", "symbols"]).columns, pa.array(entry, pa.int32()), pa.array(after, pa.int32()), pa.array(audit, pa.string()), pa.array(cost, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "block", "symbols", "state", "after", "audit", "cost"])


def chosen_edits(blocks: DataFrame) -> DataFrame:
    """(conv_id, block, symbols, state, after, audit, cost) of the cheapest repair; blocks: conv_id, block, symbols."""
    conv, place = "conv_id long, block long", ["conv_id", "block"]
    many = blocks.where("block > 0").select("conv_id").distinct().select(F.col("conv_id").alias("_id"))
    long = blocks.join(many, F.col("conv_id").eqNullSafe(F.col("_id")), "left_semi")
    costs = stored(long.mapInArrow(_passages, f"{conv}, costs array<long>"), "passages")
    ends = costs.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block")).mapInArrow(_carry_back, f"{conv}, ends array<long>")
    ends = ends.select(F.col("conv_id").alias("_id"), F.col("block").alias("_block"), "ends")
    known = blocks.join(ends, F.col("conv_id").eqNullSafe(F.col("_id")) & (F.col("block") == F.col("_block")), "left").select(*place, "symbols", "ends")
    ways = stored(known.mapInArrow(_ways, f"{conv}, symbols string, ways array<struct<audit string, after int, cost long>>"), "ways")
    out = ways.repartition("conv_id").sortWithinPartitions(*place).mapInArrow(_walk, f"{conv}, symbols string, state int, after int, audit string, cost long")
    out = stored(out, "edits")
    discard(costs, ways)
    return out


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, at, inserted roles before the turn, new role or null, kept) of each turn of a block."""
    for b in batches:
        out = []
        for conv, block, symbols, state, audit in zip(*(c.to_pylist() for c in b.columns), strict=True):
            before: list[str] = []
            i = 0
            for edit in audit:
                role = None
                if edit in "IR":
                    letter, state = NEXT[state]
                    role = ROLES[letter]
                elif edit == "K":
                    state = SYSTEM if symbols[i].lower() == "s" else NEXT[state][1]
                if edit == "I":
                    before.append(role)
                else:
                    out.append((conv, BLOCK * block + i, before, role, edit != "D"))
                    before, i = [], i + 1
        columns = list(zip(*out, strict=True)) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv_id", "at", "inserted", "new_role", "kept"])


def repaired_turns(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, at, role, text) of the repaired turns as lines: at, and the `role:text` lines of the turn and of insertions before it, joined by newlines."""
    picked = edits.select("conv_id", "block", "symbols", "state", "audit").mapInArrow(_lines, "conv_id long, at long, inserted array<string>, new_role string, kept boolean")
    picked = picked.select(F.col("conv_id").alias("_id"), F.col("at").alias("_at"), "inserted", "new_role", "kept")
    both = rows.join(picked, F.col("conv_id").eqNullSafe(F.col("_id")) & (F.col("at") == F.col("_at")))
    empty = lambda roles: F.transform(roles, lambda r: F.concat(r, F.lit(":")))
    own = F.when(F.col("kept"), F.array(F.concat(F.coalesce("new_role", "role"), F.lit(":"), F.col("text")))).otherwise(F.array().cast("array<string>"))
    lines = both.select("conv_id", "at", F.concat(empty(F.col("inserted")), own).alias("lines"))
    last = edits.groupBy("conv_id").agg(F.max_by("after", "block").alias("after"), F.max(F.col("block") * BLOCK + F.length("symbols")).alias("at"))
    closing = F.when(F.col("after") == SYSTEM, F.array(F.lit("user"), F.lit("assistant"))).when(F.col("after") == USER, F.array(F.lit("assistant"))).otherwise(F.array().cast("array<string>"))
    lines = lines.unionByName(last.select("conv_id", "at", empty(closing).alias("lines"))).where("size(lines) > 0")
    return lines.select("conv_id", "at", F.array_join("lines", "\n").alias("text"))


def repair(conversations: DataFrame) -> DataFrame:
    """Structure of each conversation and its cheapest repair: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    conversations: conv_id, turn, role, text, taken as they are.
    """
    number = numbered(conversations.select("conv_id", "turn", "role", "text"), "conv_id", ["turn", "role", "text"], ["turn", "role", "text"], "at")
    rows = stored(faults(number), "faults")
    gaps = number.groupBy("conv_id", "turn").agg(F.lit(1).alias("_one")).groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    symbol, initial = _symbols(F.col("role"), F.col("fault"))
    block = F.floor(F.col("at") / BLOCK)
    one = rows.select("conv_id", block.alias("block"), F.struct("at", symbol.alias("symbol"), initial.alias("initial")).alias("one"), "fault")
    joined = lambda name: F.array_join(F.transform(F.array_sort(F.collect_list("one")), lambda x: x[name]), "")
    counts = [F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")]
    blocks = stored(one.groupBy("conv_id", "block").agg(joined("symbol").alias("symbols"), joined("initial").alias("initials"), *counts), "blocks")
    edits = chosen_edits(blocks.select("conv_id", "block", "symbols"))
    lines = stored(repaired_turns(rows, edits), "lines")
    digests = joined_digests(lines, ["conv_id"], "at", "text", "\n", "repaired_sha256")
    # neighbours across blocks: each block's initials begin with the last one of the block before
    before = blocks.select("conv_id", (F.col("block") + 1).alias("block"), F.right("initials", F.lit(1)).alias("led")).withColumnsRenamed({"conv_id": "_id", "block": "_block"})
    pairs = blocks.join(before, F.col("conv_id").eqNullSafe(F.col("_id")) & (F.col("block") == F.col("_block")), "left")
    run = F.concat(F.coalesce("led", F.lit("")), F.col("initials"))
    legal = F.regexp_count(run, F.lit("s(?=u)|u(?=a)|a(?=u)"))
    found = pairs.select("conv_id", "blank", "duplicate", "truncated", (F.length(run) - 1 - legal).alias("illegal"))
    found = found.groupBy("conv_id").agg(*(F.sum(x).alias(x) for x in ("blank", "duplicate", "truncated", "illegal")))
    closing = F.get(F.array(*map(F.lit, CLOSING)), F.max_by("after", "block"))
    audit = F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), ""), closing)
    cost = (F.sum("cost") + F.lit(INSERT) * F.length(closing)).cast("long")
    out = edits.groupBy("conv_id").agg(cost.alias("cost"), audit.alias("audit"))
    for part in (found, gaps, digests):
        name = columns_free(out, "_id")[0]
        part = part.withColumnRenamed("conv_id", name)
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col(name)), "left").drop(name)
    return out.select("conv_id", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated", F.col("illegal").cast("long").alias("illegal"), "cost", "audit", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """`repair` of the damaged rows, one row per conversation of the table; those without rows are zeros."""
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = repair(stored(damaged(conversations), "damaged")).withColumnRenamed("conv_id", "_id")
    out = every.join(found, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    zeros = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.fillna(0, zeros).fillna("", ["audit"]).withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)))
