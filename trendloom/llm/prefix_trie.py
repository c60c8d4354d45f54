"""The trie of conversations' shared beginnings, its subtree totals by parallel tree contraction.

A node is a distinct sequence of the first turns of some rebuilt conversations.  It
is told by its depth and two 64-bit hashes of its turns, each turn hashed with its
place, so that hashes of prefixes are running combinations and no text is shuffled
beyond the numbering of turns.  A node is named by its depth and its least member.

Subtree totals are found by alternate rounds over the live nodes:

* rake: leaves leave the tree, their totals are added to their parents;
* compress: of the nodes with one child that have a parent, those whose key is least
  among such neighbours are spliced out: the parent takes their weight and child.

Every chain of such nodes has a least key, so each round makes progress; keys begin
with the number of trailing zeros of the depth, so a fresh chain halves.  Rounds run
backwards then: the total of a spliced node is its weight at that time and the total
of its child.  All joins within rounds are between unique keys; sums into a parent
with many children are partial sums first.  Rounds are stored in the shared folder.

Defined cases: null roles and texts count as empty; turns are ordered by turn (null
first), then role, then text; rows without conv_id belong to no conversation and are
ignored; an empty table has no nodes; repeated rows are turns of their own; extra
columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import discard, stored
from .ordered import joined_digests, numbered

BLOCK = 4096
#: At most so many parents have more than their share, one in HOT, of all nodes as children; these are broadcast.
HOT = 1000
ID, PARENT, WEIGHTS = ["c", "d"], ["pc", "pd"], ["leaves", "saved"]


def own_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, at, a, b, words): turns by their place, two hashes of role and text, and the words of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    turns = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role, text).where("conv_id is not null")
    hashes = {"a": F.xxhash64(F.lit(1), "role", "text"), "b": F.xxhash64(F.lit(2), "text", "role"), "words": F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")}
    return numbered(turns.withColumns(hashes), "conv_id", ["turn", "role", "text"], ["a", "b", "words"], "at")


def shared_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % 4


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations: conv_id, n_turns; turns: conv_id, depth from 1, a, b, words, last) after each takes the first turns of conv_id - conv_id % 20."""
    h = shared_turns(F.col("conv_id"))
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    lender = sizes.select(F.col("conv_id").alias("lender"), F.col("n").alias("_lent"))
    convs = sizes.withColumn("lender", F.col("conv_id") - F.col("conv_id") % 20).join(lender, "lender", "left")
    convs = convs.select("conv_id", "lender", "n", h.alias("h"), F.least(h, F.coalesce("_lent", F.lit(0))).alias("k"))
    convs = stored(convs.withColumn("n_turns", F.col("k") + F.greatest(F.lit(0), F.col("n") - F.col("h"))), "rebuilt")
    heads = turns.where((F.col("conv_id") % 20 == 0) & (F.col("at") < 3)).withColumnRenamed("conv_id", "lender")  # three rows, and at most 20 takers, a lender
    lent = convs.join(heads, "lender").where("at < h").select("conv_id", (F.col("at") + 1).alias("depth"), "a", "b", "words", "n_turns")
    # a long conversation meets its row of convs once a block, so no key has more than BLOCK rows
    block = lambda c: F.floor(F.col(c) / BLOCK)
    spread = convs.select("conv_id", "h", "k", "n_turns", F.explode(F.sequence(F.lit(0), block("n"))).alias("block"))
    own = turns.where(F.col("at") >= h).withColumn("block", block("at")).join(spread, ["conv_id", "block"])
    own = own.select("conv_id", (F.col("at") - F.col("h") + F.col("k") + 1).alias("depth"), "a", "b", "words", "n_turns")
    return convs, lent.unionByName(own).withColumn("last", F.col("depth") == F.col("n_turns")).drop("n_turns")


def prefix_rows(turns: DataFrame) -> DataFrame:
    """Adds the prefix's hashes p, q and those of the prefix before, op, oq: running combinations within blocks, then over blocks."""
    key = ["conv_id", "block"]
    here = {"a": F.xxhash64("a", "depth"), "b": F.xxhash64("depth", "b")}
    rows = turns.withColumns(here).withColumn("block", F.floor(F.col("depth") / BLOCK))
    run = W.partitionBy(*key).orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({"p": F.bit_xor("a").over(run), "q": F.bit_xor("b").over(run)})
    before = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = turns.withColumns(here).groupBy("conv_id", F.floor(F.col("depth") / BLOCK).alias("block")).agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    blocks = blocks.select(*key, F.bit_xor("a").over(before).alias("ba"), F.bit_xor("b").over(before).alias("bb")).where("block > 0")
    rows = rows.join(blocks, key, "left")
    p, q = (F.col(x).bitwiseXOR(F.coalesce(y, F.lit(0))) for x, y in (("p", "ba"), ("q", "bb")))
    return rows.select("conv_id", "depth", "words", "last", p.alias("p"), q.alias("q"), p.bitwiseXOR(F.col("a")).alias("op"), q.bitwiseXOR(F.col("b")).alias("oq"))


def trie_nodes(convs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(c, d, pc, pd, p, q, n_convs, n_children, saved): every node with its parent."""
    none = F.lit(None).cast("long")
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), *(F.lit(0).cast("long").alias(x) for x in ("words", "p", "q")), none.alias("op"), none.alias("oq"))
    nodes = prefixes.drop("last").select(*root.columns).unionByName(root).groupBy("depth", "p", "q")
    nodes = nodes.agg(F.min("conv_id").alias("c"), F.count("*").alias("n_convs"), F.min("op").alias("op"), F.min("oq").alias("oq"), F.min("words").alias("words"))
    nodes = stored(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")).drop("words"), "nodes")
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("op").alias("p"), F.col("oq").alias("q")).agg(F.count("*").alias("n_children"))
    nodes_kids = stored(nodes.join(kids, ["depth", "p", "q"], "left").fillna(0, ["n_children"]), "nodes")
    link, total = ["depth", "op", "oq"], nodes_kids.count()
    parents = nodes_kids.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("p").alias("op"), F.col("q").alias("oq"), F.col("c").alias("pc"), (F.col("n_children") * HOT > total).alias("hot"))
    marked = nodes_kids.join(F.broadcast(parents.where("hot").drop("hot")), link, "left")  # at most HOT rows
    done = marked.where("pc is not null or depth = 0")
    rest = marked.where("pc is null and depth > 0").drop("pc").join(parents.where("not hot").drop("hot"), link)
    both = done.unionByName(rest).select("c", F.col("depth").alias("d"), "pc", F.when(F.col("depth") > 0, F.col("depth") - 1).alias("pd"), "p", "q", "n_convs", "n_children", "saved")
    out = stored(both, "tree")
    discard(nodes, nodes_kids)
    return out


def _key(c: str, d: str) -> Column:
    """Order of neighbours in a chain: trailing zeros of the depth, then a hash, then the name; no two nodes are equal."""
    return F.struct(F.bit_count(F.col(d).bitwiseAND(-F.col(d)) - 1), F.xxhash64(c, d), F.col(c), F.col(d))


def _rake(live: DataFrame) -> DataFrame:
    """Live nodes without the leaves, whose weights are added to their parents."""
    gone = live.where("n = 0 and pc is not null").groupBy(F.col("pc").alias("c"), F.col("pd").alias("d")).agg(F.count("*").alias("_n"), *(F.sum(w).alias(f"_{w}") for w in WEIGHTS))
    rest = live.where("n > 0 or pc is null").join(gone, ID, "left")
    more = lambda w: (F.col(w) + F.coalesce(f"_{w}", F.lit(0))).alias(w)
    return rest.select(*ID, *PARENT, (F.col("n") - F.coalesce("_n", F.lit(0))).alias("n"), *map(more, WEIGHTS))


def _unary(live: DataFrame) -> DataFrame:
    """Nodes with a parent and one child, and that child (kc, kd)."""
    only = live.groupBy(F.col("pc").alias("c"), F.col("pd").alias("d")).agg(F.min("c").alias("kc"), F.min("d").alias("kd"))
    return live.where("n = 1 and pc is not null").join(only, ID)


def _spliced(chains: DataFrame) -> DataFrame:
    """Of the nodes of chains those with the least key among neighbours."""
    below = chains.select(F.col("c").alias("kc"), F.col("d").alias("kd"))
    pairs = chains.select(*ID, "kc", "kd").join(below, ["kc", "kd"])
    first = _key("c", "d") < _key("kc", "kd")
    beaten = pairs.select(F.when(first, F.col("kc")).otherwise(F.col("c")).alias("c"), F.when(first, F.col("kd")).otherwise(F.col("d")).alias("d")).distinct()
    return chains.join(beaten, ID, "left_anti")


def _without(live: DataFrame, spliced: DataFrame) -> DataFrame:
    """Live nodes after the spliced ones gave their weights to their parents and their children new parents."""
    none, no = F.lit(None).cast("long"), F.lit(False)
    names = [*ID, *(f"_{w}" for w in WEIGHTS), "np", "nd", "gone"]
    ups = spliced.select("pc", "pd", *WEIGHTS, none, none, no).toDF(*names)
    downs = spliced.select("kc", "kd", F.lit(0), F.lit(0), "pc", "pd", no).toDF(*names)
    selves = spliced.select(*ID, F.lit(0), F.lit(0), none, none, F.lit(True)).toDF(*names)
    change = ups.unionByName(downs).unionByName(selves).groupBy(*ID).agg(*(F.sum(f"_{w}").alias(f"_{w}") for w in WEIGHTS), F.max("np").alias("np"), F.max("nd").alias("nd"), F.bool_or("gone").alias("gone"))
    rows = live.join(change, ID, "left").where("not coalesce(gone, false)")
    more = lambda w: (F.col(w) + F.coalesce(f"_{w}", F.lit(0))).alias(w)
    return rows.select(*ID, F.coalesce("np", "pc").alias("pc"), F.coalesce("nd", "pd").alias("pd"), "n", *map(more, WEIGHTS))


def subtree_totals(tree: DataFrame) -> DataFrame:
    """(c, d, leaves, saved) summed over the subtree of each node of a forest; tree: c, d, pc, pd (null: root), n_children, leaves, saved."""
    live = stored(tree.select(*ID, *PARENT, F.col("n_children").alias("n"), *WEIGHTS), "live")
    rounds: list[tuple[DataFrame, DataFrame | None]] = []
    spent = []
    while not live.where("n > 0").isEmpty():
        raked = stored(_rake(live), "raked")
        out = stored(_spliced(_unary(raked)), "spliced")
        some = not out.isEmpty()
        rounds.append((live, out if some else None))
        spent += [raked, out] if some else [out]
        live = stored(_without(raked, out), "live") if some else raked
    known = [live.select(*ID, *WEIGHTS)]
    for before, out in reversed(rounds):
        if out is not None:
            below = reduce(DataFrame.unionByName, known).select(F.col("c").alias("kc"), F.col("d").alias("kd"), *(F.col(w).alias(f"_{w}") for w in WEIGHTS))
            known.append(stored(out.join(below, ["kc", "kd"]).select(*ID, *((F.col(w) + F.col(f"_{w}")).alias(w) for w in WEIGHTS)), "totals"))
            spent.append(known[-1])
        known.append(before.where("n = 0 and pc is not null").select(*ID, *WEIGHTS))
        spent.append(before)
    every = stored(reduce(DataFrame.unionByName, known), "totals")
    discard(*spent, live)
    return every


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = stored(own_turns(conversations), "turns")
    convs, rows = rebuilt(turns)
    prefixes = stored(prefix_rows(rows), "prefixes")
    tree = trie_nodes(convs, prefixes)
    totals = subtree_totals(tree.withColumn("leaves", (F.col("n_children") == 0).cast("long")))
    place = ["depth", "p", "q"]
    zero = F.lit(0).cast("long")
    ends = prefixes.where("last").select(*place, "conv_id").unionByName(convs.where("n_turns = 0").select(zero.alias("depth"), zero.alias("p"), zero.alias("q"), "conv_id"))
    digests = joined_digests(ends.withColumn("name", F.col("conv_id").cast("string")), place, "conv_id", "name", ",", "ends_sha256")
    out = tree.join(totals.select(*ID, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")), ID)
    out = out.withColumnRenamed("d", "depth").join(digests, place, "left")
    ends_sha256 = F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))
    return out.select(F.col("c").alias("conv_id"), "depth", F.col("pc").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", ends_sha256.alias("ends_sha256"))
