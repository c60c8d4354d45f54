"""Word BPE against its library; the prefix trie and turn repair against brute force and their SQL."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from trendloom.llm import ordered, prefix_trie, queries, toxicity, turn_repair, word_bpe  # noqa: E402

DATA = Path("/root/testdata/sf0.001")
TURNS = "conv_id long, turn long, role string, text string, at int, _id int, block string"
COLUMNS = ("conv_id", "turn", "role", "text")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _table(spark, rows, parts=5):
    """Extra columns take names that the operators use inside."""
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], TURNS).repartition(parts)


@pytest.fixture(scope="module")
def awkward():
    rng = random.Random(4)
    roles, texts = ["system", "user", "assistant", "assistant", "user", "tool", None, ""], ["Yes.", "No!", "same", "x y?", " \n", "", None, "More. "]
    rows = [(c, rng.choice([None, i, i, i, i + 3]), rng.choice(roles), rng.choice(texts)) for c in range(30) for i in range(rng.randint(0, 9))]
    rows += [(1000 + c, i, ["user", "assistant"][i % 2] if rng.random() < 0.8 else "system", f"text {rng.randint(0, 300)}" + rng.choice(["...", "", "."])) for c, n in enumerate([200, 65, 64, 33, 32, 31]) for i in range(n)]
    rows += [(None, i, "user", f"a{i}.") for i in range(4)] + [(7000, 3, "user", "q.")] * 5 + [(7001, 1, "user", "long " * 200_000 + ".")]
    return rows + [(40 + c, i, "user", f"w {i % 3}") for c in (0, 1, 7) for i in range(40 + c)]


# --- word BPE


@pytest.fixture(scope="module")
def vocabulary():
    return word_bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_lexicon_is_minimal_and_exact(vocabulary):
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8))).encode() for _ in range(4000)} | {"é".encode(), "한국어".encode()})
    entries = [(w, word_bpe.merge(w, vocabulary)) for w in words]
    lexicon = word_bpe.Lexicon(word_bpe.compile_lexicon(entries))
    known, counts, ids = lexicon.find([*words, b"zzzz", b"ab\xff", b"", b"a" * 100])
    assert known.tolist() == [True] * len(words) + [False] * 4
    ends = np.cumsum(counts)
    assert all(tuple(ids[e - n : e]) == i for e, n, (_, i) in zip(ends, counts, entries, strict=False))
    states = [(lexicon.final_at[s], lexicon.final_size[s], *lexicon.key[at] & 255, *lexicon.target[at], *lexicon.out_at[at]) for s in range(len(lexicon.final_at)) for at in [lexicon.key >> 8 == s]]
    assert len(set(states)) == len(states)  # no two states are alike
    assert len(states) < sum(map(len, words)) / 3
    assert word_bpe.Lexicon(word_bpe.compile_lexicon([])).find([b"a"])[0].tolist() == [False]
    some = [*words[::7], b"ab" * 40, b"x", b"aaaaaaaaaaaa", b"\xff\xfe"]
    assert [tuple(x.tolist()) for x in word_bpe.Merger(vocabulary).merged(some)] == [word_bpe.merge(w, vocabulary) for w in some]


def test_word_bpe_equals_library(spark, vocabulary):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [None, "", "  ", "ΑΣ ΣΑΣ", "İstanbul Éé é 각", "a\x1cb\x1fc​d\x85e", "<|endoftext|>x<|startoftext|><|ENDOFTEXT|> <|endoftext|>", "It's WE'LL don'T 123 ４５ ²", "x" * 3000 + " y"]
    texts += ["word " * 120_000, "ab" * 200_000, "ա՘b \U00010940 ꟎ \U0003d000", "日本語" * 200, "It's WE'LL don'T 123 ４５ ²"]
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int, ids string").repartition(3)
    want = []
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert _rows(word_bpe.encode_digests(df, vocabulary)) == sorted(want, key=repr)
    ids = word_bpe.encode(df, vocabulary, 3)  # nearly all words lie outside so small a lexicon
    assert sorted((r.doc_id, r.ids) for r in ids.collect()) == [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)]
    back = {r.doc_id: r.text for r in word_bpe.decode(ids, vocabulary).collect()}
    assert back == {i: library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for i, t in enumerate(texts)}
    assert _rows(word_bpe.encode_digests(df.limit(0), vocabulary)) == []


# --- ordered groups


def test_places_and_digests_of_large_groups(spark):
    rows = [(None if k == 3 else k, (i * 37) % 1000, str(i)) for k, n in ((1, 900), (2, 3), (3, 40)) for i in range(n)] + [(1, 5, "again")]
    df = spark.createDataFrame(rows, "k long, o long, t string").repartition(7)
    got = sorted(((r.k, r.o, r.place) for r in ordered.numbered(df, "k", ["o"], ["o"], "place").collect()), key=repr)
    want = [(k, o, place) for k in (1, 2, None) for place, o in enumerate(sorted(r[1] for r in rows if r[0] == k))]
    assert got == sorted(want, key=repr)
    big = spark.createDataFrame([(1, i, "x" * 300_000 + str(i)) for i in range(9)] + [(2, 1, "a"), (2, 0, "b")], "k long, o long, t string").repartition(4)
    digests = {r.k: r.d for r in ordered.joined_digests(big, ["k"], "o", "t", ";", "d").collect()}
    assert digests == {1: hashlib.sha256(";".join("x" * 300_000 + str(i) for i in range(9)).encode()).hexdigest(), 2: hashlib.sha256(b"b;a").hexdigest()}


# --- prefix trie


def _trie(rows):
    conv = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            conv[c].append((t is not None, t or 0, r or "", x or ""))
    conv = {c: [x[2:] for x in sorted(v)] for c, v in conv.items()}
    new = {c: conv.get(c - c % 20, [])[: (h := zlib.crc32(str(c).encode()) % 4)] + v[h:] for c, v in conv.items()}
    members, kids, totals = defaultdict(list), defaultdict(list), {}
    for c, v in new.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    for k in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        totals[k] = (sum(totals[x][0] for x in kids[k]) if kids[k] else 1, (len(members[k]) - 1) * words + sum(totals[x][1] for x in kids[k]))
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(new[c]) == len(k))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), *totals[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_prefix_trie(spark, awkward, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    rows = [r for r in awkward if (r[0] or 0) < 1000 or r[0] == 7000]
    assert _rows(prefix_trie.prefix_trie(_table(spark, rows))) == _trie(rows)
    assert _rows(prefix_trie.prefix_trie(_table(spark, rows).limit(0))) == []


def test_contraction_of_chains_and_stars(spark):
    tree = [(0, 0, None, None)] + [(0, d, 0, d - 1) for d in range(1, 40)] + [(i, 1, 0, 0) for i in range(1, 50)] + [(i, d, i, d - 1) for i in range(1, 50, 7) for d in range(2, 2 + i % 9)]
    kids = defaultdict(int)
    for _, _, pc, pd in tree:
        kids[pc, pd] += 1
    df = spark.createDataFrame([(*n, kids[n[0], n[1]], int(kids[n[0], n[1]] == 0), 1 + n[0]) for n in tree], "c long, d long, pc long, pd long, n_children long, leaves long, saved long")
    want = {}
    for c, d, pc, pd in sorted(tree, key=lambda n: -n[1]):
        a, b = want.get((c, d), (0, 0))
        want[c, d] = own = (a + (kids[c, d] == 0), b + 1 + c)
        if pc is not None:
            x = want.get((pc, pd), (0, 0))
            want[pc, pd] = (x[0] + own[0], x[1] + own[1])
    assert {(r.c, r.d): (r.leaves, r.saved) for r in prefix_trie.subtree_totals(df).collect()} == want


# --- turn repair


def _cheapest(rows):
    """(cost, audit, lines) by least costs over the four states of the grammar, then the least letters."""
    to, n = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}, len(rows)
    cost = [[1 << 30] * 4 for _ in range(n + 1)]
    cost[n][0] = cost[n][3] = 0

    def moves(i, q):
        letter, after = to[q]
        yield "I", 5, i, after
        if i < n:
            role, _, fault = rows[i]
            yield "D", 2, i + 1, q
            if fault not in ("blank", "duplicate"):
                cut = 5 if fault == "truncated" else 0
                if role[:1] == "s" and q == 0:
                    yield "K", cut, i + 1, 1
                if role[:1] == letter:
                    yield "K", cut, i + 1, after
                yield "R", 1 + cut, i + 1, after

    for i in range(n, -1, -1):
        for _ in range(4):
            for q in range(4):
                cost[i][q] = min([cost[i][q], *(c + cost[a][b] for _, c, a, b in moves(i, q))])
    i, q, audit, lines = 0, 0, "", []
    while i < n or cost[i][q]:
        letter, _, a, b = min(m for m in moves(i, q) if m[1] + cost[m[2]][m[3]] == cost[i][q])
        new = {"u": "user:", "a": "assistant:"}[to[q][0]]
        lines += {"I": [new], "D": []}.get(letter, [(rows[i][0] + ":" if letter == "K" else new) + rows[i][1]] if i < n else [])
        audit, i, q = audit + letter, a, b
    return cost[0][0], audit, lines


def _repaired(table):
    conv = defaultdict(list)
    filled = lambda v: " " if v is None else str(v)
    for c, t, r, x in table:
        kind, r, x = zlib.crc32(f"{filled(c)}:{filled(t)}".encode()) % 20, filled(r), filled(x)
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        conv[c] += [(t, "user" if kind == 4 else r, x)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for c, v in conv.items():
        seen, rows = set(), []
        for _, r, x in sorted(v, key=lambda y: ((y[0] is not None, y[0] or 0), y[1], y[2])):
            body = x.strip(" \t\n\r\x0b\x0c")
            rows.append((r, x, "blank" if not body else "duplicate" if (r, x) in seen else None if body[-1] in ".!?" else "truncated"))
            seen.add((r, x))
        turns = [t for t, _, _ in v if t is not None]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        cost, audit, lines = _cheapest(rows)
        counts = (sum(r[2] == name for r in rows) for name in ("blank", "duplicate", "truncated"))
        out.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_alignment_of_short_blocks():
    rng = random.Random(1)
    roles = {"s": "system", "u": "user", "a": "assistant", "x": "tool", "-": "user"}
    for _ in range(1500):
        symbols = "".join(rng.choice("suaxSUAX-") for _ in range(rng.randint(0, 9)))
        cost, audit, _ = _cheapest([(roles[c.lower()], "", "blank" if c == "-" else "truncated" if c.isupper() else None) for c in symbols])
        found = turn_repair.aligned(symbols, turn_repair.START, turn_repair.ENDS)
        assert (found[0], found[1] + turn_repair.CLOSING[found[2]]) == (cost, audit), symbols


def test_turn_repair(spark, awkward):
    assert _rows(turn_repair.repair_damaged(_table(spark, awkward))) == _repaired(awkward)
    assert _rows(turn_repair.repair_damaged(_table(spark, awkward).limit(0))) == []


# --- registered queries


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        c.execute(f"create view {f.stem} as select * from '{f}'")
    result = c.execute(queries.ORACLES[name])
    names = [x[0] for x in result.description]
    want = sorted(result.fetchall(), key=repr)
    got = queries.QUERIES[name](spark, str(DATA))
    assert sorted(got.columns) == sorted(names)
    assert _rows(got.select(*names)) == want
    assert want


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_word_bpe_query(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in queries.QUERIES["op11_word_bpe"](spark, str(DATA)).collect()}
    for r in spark.read.parquet(str(DATA / "documents.parquet")).select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [(r.score, r.predicted) for r in toxicity.score_toxicity(docs, toxicity.train(docs, none)).collect()] == [(0.0, 0)] * 2
    assert toxicity.score_toxicity(docs.limit(0), toxicity.train(docs.limit(0), none)).count() == 0
