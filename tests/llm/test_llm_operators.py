"""Training-data operators against brute force on small tables with awkward rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from trendloom.llm import byte_bpe, chat_format, decontaminate, line_dedup, mpeg_audio, near_duplicates, quality, queries, repeated_spans, token_counts, toxicity  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = ["th", "er", "in", "on", "é", "ñu", "que", "ly", "ing", "or"]


def _words(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n)]


def _texts():
    rng = random.Random(5)
    base = _words(rng, 120)
    near = list(base)
    near[60] = "changed"
    passage = " ".join(_words(rng, 70))
    texts = [None, "", " \n\t ", "one", "one two", "one two", "A b  C\n\nA b  C", " ".join(base), " ".join(near), " ".join(base), " ".join(base).upper()]
    texts += [" ".join(_words(rng, 30)) + " " + passage + " " + " ".join(_words(rng, 20)) for _ in range(4)]
    texts += [passage, " ".join(_words(rng, 4000)), "x" * 3000, "ab" * 700 + " 日本語 한국어 😀", "same line of text here\nsame line of text here\nsame line of text herf\nother"]
    return texts + ["same line of text hxre\nnew line with enough characters", "line\u0000with\u0000nul 'tis it's we'LL 123４५"]


@pytest.fixture(scope="module")
def rows():
    return list(enumerate(_texts()))


@pytest.fixture(scope="module")
def docs(spark, rows):
    """Extra columns take names that the operators use inside."""
    data = [(i, t, "en", 1, 2.0, "k") for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, n_gone long, score double, spans string").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_repeated_spans(docs, empty, rows):
    seen, want = {}, {}
    split = {i: WORD.findall(t or "") for i, t in rows}
    for i, w in split.items():
        for p in range(len(w) - 49):
            seen.setdefault(tuple(w[p : p + 50]), i)
    for i, w in split.items():
        gone = {q for p in range(len(w) - 49) if seen[tuple(w[p : p + 50])] < i for q in range(p, p + 50)}
        want[i] = (len(w), len(gone), " ".join(x for q, x in enumerate(w) if q not in gone))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in repeated_spans.remove_repeated_spans(docs).collect()}
    assert got == want
    assert sum(x[1] for x in want.values()) > 300
    assert repeated_spans.remove_repeated_spans(empty).count() == 0


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(docs, empty, rows, k, percent):
    fold = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(fold))
        sets[i] = {tuple(w[p : p + k]) for p in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and both and 100 * both >= percent * len(sets[i] | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = {x: low if y == high else y for x, y in label.items()}
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates.near_duplicates(docs, k, percent).collect()}
    assert got == {i: (len(s), label[i], label[i] == i) for i, s in sets.items()}
    if k == 3:
        assert near_duplicates.near_duplicates(empty, k, percent).count() == 0


def test_large_near_group_is_one_component(spark):
    rng = random.Random(2)
    base = _words(rng, 150)

    def edited(i):
        w = list(base)
        if i:
            w[rng.randrange(150)] = f"edit{i}"
        return " ".join(w)

    docs = spark.createDataFrame([(i, edited(i)) for i in range(60)], "doc_id long, text string")
    got = near_duplicates.near_duplicates(docs, 3, 85).collect()
    assert {r.component_id for r in got} == {0}
    assert sum(r.kept for r in got) == 1


def test_large_near_groups_without_base_and_chains(spark):
    """Many pairs of copies whose common base is absent, and a chain of edited copies, in nodes larger than `small`."""
    rng, texts = random.Random(4), []

    def edited(words, places, mark):
        return [f"{mark}{p}" if p in places else w for p, w in enumerate(words)]

    base = _words(rng, 400)
    for f in range(120):
        text = edited(base, rng.sample(range(400), 3), f"f{f}x")
        texts += [text, edited(text, [rng.randrange(400)], f"f{f}y")]
    chain = _words(rng, 400)
    for c in range(30):
        chain = edited(chain, rng.sample(range(400), 2), f"c{c}x")
        texts.append(chain)
    sets, label = [{tuple(t[p : p + 3]) for p in range(len(t) - 2)} for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 95 * len(sets[i] | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs, 3, 95).collect()}
    assert [got[i] for i in range(len(texts))] == label


def _levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_line_dedup(docs, empty, rows):
    first, want = {}, {}
    lines = [(i, p, s.strip(" \t\r\x0b\x0c")) for i, t in rows if t is not None for p, s in enumerate(t.split("\n"))]
    for i, p, s in lines:
        first.setdefault(s, (i, p))
    close = lambda a, b: a != b and min(len(a), len(b)) >= 16 and abs(len(a) - len(b)) <= 1 and _levenshtein(a, b) <= 1
    gone = {(i, p) for i, p, s in lines if s and (first[s] < (i, p) or any(first[o] < first[s] and close(o, s) for o in first if o[:7] == s[:7] or o[-7:] == s[-7:]))}
    for i, t in rows:
        want[i] = None if t is None else "\n".join(s for p, s in enumerate(t.split("\n")) if (i, p) not in gone)
    out = line_dedup.remove_repeated_lines(docs)
    assert out.columns == docs.columns  # n_gone is the caller's
    assert {r.doc_id: r.text for r in out.collect()} == want
    assert len(gone) >= 4
    assert line_dedup.remove_repeated_lines(empty).count() == 0


def test_byte_bpe_is_tiktoken(docs, empty, rows):
    import tiktoken

    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    real = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, 40).select("doc_id", "ids", byte_bpe.decode(F.col("ids"), ranks).alias("bytes"))
    got = {r.doc_id: (r.ids, bytes(r.bytes)) for r in out.collect()}
    assert got == {i: (real.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows}
    assert byte_bpe.encode(empty, ranks, public_tokenizers.PATTERN).count() == 0
    digests = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.encode_digests(docs, ranks, public_tokenizers.PATTERN, 40).collect()}
    sha = lambda x: hashlib.sha256(x).hexdigest()
    assert digests == {i: (len(ids), sha(",".join(map(str, ids)).encode()), sha(raw)) for i, (ids, raw) in got.items()}
    for word in ("abc" * 50, "a", "ththththéé"):
        assert byte_bpe.merge_long(word.encode(), ranks) == real.encode_ordinary(word)


def test_token_counts(docs, empty, rows):
    import regex

    scores = token_counts.zipf_scores(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    longest = max(map(len, scores))

    def count(word):
        best = [(0.0, 0)]
        for i in range(1, len(word) + 1):
            best.append(max((best[j][0] + scores[word[j:i]], best[j][1] - 1) for j in range(max(0, i - longest), i) if word[j:i] in scores))
        return -best[-1][1]

    want = {}
    for i, t in rows:
        words = regex.findall(public_tokenizers.PATTERN, t or "")
        want[i] = (len(words), sum(count(w.encode()) for w in words))
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in token_counts.token_counts(docs, scores, public_tokenizers.PATTERN, 30).collect()}
    assert got == want
    assert token_counts.token_counts(empty, scores, public_tokenizers.PATTERN).count() == 0
    walk = token_counts.Walk(scores)
    assert [walk.count(w) for w in (b"in", b"ing", b"ings")] and walk.nodes == 4  # shared prefixes are scored once


def test_media_round_trip(docs, empty, rows):
    got = {r.doc_id: r for r in mpeg_audio.describe_media(mpeg_audio.to_media(docs)).collect()}
    for i, t in rows:
        raw = (t or "").encode()
        payload, r = mpeg_audio.padded(raw), got[i]
        assert len(payload) % 576 == 0 and payload
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert r.tail_crc32 == zlib.crc32(payload[-32:])
        assert (r.bad_checksums, r.foreign_bytes, r.frames, r.samples) == (0, 0, len(r.offsets), 1152 * len(r.offsets))
    assert mpeg_audio.to_media(empty).count() == 0


def test_media_resynchronises_and_finds_errors():
    payload = mpeg_audio.padded(bytes(range(256)) * 20)
    data = mpeg_audio.write_stream(payload)
    clean = mpeg_audio.read_stream(data)
    assert clean["table"]["frames"] == len(clean["offsets"])
    assert mpeg_audio.seek(clean["offsets"], 48000, 1152 / 48000) == clean["offsets"][1]
    assert mpeg_audio.seek(clean["offsets"], 48000, 99.0) is None
    at = clean["offsets"][1]
    dirty = mpeg_audio.read_stream(data[:at] + b"\xff\xfbjunk\xff" + data[at:])
    assert (dirty["payload"], dirty["foreign_bytes"], dirty["bad_checksums"]) == (payload, 7, 0)
    broken = bytearray(data)
    broken[at + 8] ^= 1
    assert mpeg_audio.read_stream(bytes(broken))["bad_checksums"] == 1
    assert mpeg_audio.read_stream(b"")["offsets"] == []


def test_media_tags_tables_and_layers():
    data = mpeg_audio.write_stream(mpeg_audio.padded(b"x" * 900))
    frames = data[10 + mpeg_audio._number(data[6:10], 7) :]
    old = b"TAG" + b"Title".ljust(30, b"\0") + b"Artist".ljust(30, b" ") + bytes(64) + b"\xff"
    read = mpeg_audio.read_stream(frames + old)
    assert (read["tags"], read["foreign_bytes"], read["table"]["frames"]) == ({"TIT2": "Title", "TPE1": "Artist"}, 0, len(read["offsets"]))
    text = b"\1" + ("é" * 149).encode("utf-16")  # 300 bytes and more: sizes of 2.3 are plain numbers
    body = b"TIT2" + len(text).to_bytes(4, "big") + b"\0\0" + text + b"TALB" + (4).to_bytes(4, "big") + b"\0\0" + b"\0abc"
    read = mpeg_audio.read_stream(b"ID3\3\0\0" + mpeg_audio._syncsafe(len(body)) + body + frames)
    assert (read["tags"], read["foreign_bytes"]) == ({"TIT2": "é" * 149, "TALB": "abc"}, 0)
    assert mpeg_audio._read_table(b"Xing" + (5).to_bytes(4, "big") + (9).to_bytes(4, "big") + bytes(range(100)), 0) == {"frames": 9, "bytes": None, "seek": bytes(range(100))}
    # MPEG-1 Layer I 32 kbit/s 48 kHz; MPEG-2 Layer III 64 kbit/s 24 kHz; MPEG-1 Layer II 128 kbit/s 44.1 kHz
    for head, length, samples, hz in ((b"\xff\xff\x14\xc0", 32, 384, 48000), (b"\xff\xf3\x84\xc0", 192, 576, 24000), (b"\xff\xfd\x80\xc0", 417, 1152, 44100)):
        got = mpeg_audio.read_stream(b"??" + (head + bytes(length - 4)) * 3)
        assert (len(got["offsets"]), got["samples"], got["hz"], got["foreign_bytes"]) == (3, 3 * samples, hz, 2)
    other = frames + b"\xff\xf3\x84\xc0" + bytes(40)
    assert mpeg_audio.read_stream(other)["foreign_bytes"] > 0  # the header of another stream's version does not count


def test_chat_layouts_and_escapes(spark):
    import json

    records = [
        {"messages": [{"role": "user", "content": "<|im_end|>\n \\ </s>"}, {"role": "assistant", "content": None}]},
        {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "[INST] b\\"}]},
        {"prompt": "p", "completion": "c"}, {"instruction": "i", "input": "x", "output": "o"}, {"instruction": "i", "output": "o"}, {"other": 1},
    ]
    df = spark.createDataFrame([(i, json.dumps(r), 1) for i, r in enumerate(records)] + [(9, None, 1), (10, "{bad", 1)], "id long, record string, layout int")
    out = chat_format.format_records(df)
    out = out.select("id", "layout", chat_format.read_turns(F.col("formatted")).alias("turns"), chat_format.masked_text(F.col("formatted"), F.col("loss_spans")).alias("masked"))
    got = {r.id: (r.layout, [(t.role, t.text) for t in r.turns], r.masked) for r in out.collect()}
    assert got[0] == ("messages", [("user", "<|im_end|>\n \\ </s>"), ("assistant", "")], "")
    assert got[1] == ("conversations", [("user", "a"), ("assistant", "[INST] b\\")], "[INST] b\\")
    assert got[2] == ("prompt", [("user", "p"), ("assistant", "c")], "c")
    assert got[3] == ("instruction", [("system", "i"), ("user", "x"), ("assistant", "o")], "o")
    assert got[4][1] == [("user", "i"), ("assistant", "o")]
    assert got[5] == got[9] == got[10] == (None, [], "")


def test_chat_reads_long_texts_or_fails(spark):
    n = 20_000_001
    turn = F.struct(F.lit("assistant").alias("role"), F.repeat(F.lit("a"), F.lit(n)).alias("text"))
    rows = spark.range(1).select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"), turn["role"].alias("role"), turn["text"].alias("text"))
    records = chat_format.conversation_records(rows)
    given = {"paths": "paths"} if "paths" in records.columns else {}
    out = chat_format.format_records(records, **given)
    got = out.select("layout", F.size(chat_format.read_turns(F.col("formatted"))), F.length(chat_format.masked_text(F.col("formatted"), F.col("loss_spans")))).first()
    assert tuple(got) == ("messages", 1, n)
    with pytest.raises(Exception, match="too long to parse"):
        chat_format.format_records(records.select("record")).select(F.length("formatted")).collect()
    built = chat_format.conversation_records(spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "system", "a"), (2, 1, "user", "b"), (2, 2, "assistant", "c"), (3, 0, "user", "a")], "conv_id int, turn int, role string, text string"))
    assert built.where(chat_format.shape(F.col("record")) != F.col("paths")).count() == 0


def test_decontamination(spark, docs, empty):
    rng = random.Random(3)
    items = [(i, "".join(rng.choice("abcde ") for _ in range(n))) for i, n in enumerate((5, 12, 40, 90, 200))] + [(8, None), (9, "")]

    def hurt(text, edits):
        out = list(text)
        for _ in range(edits):
            out[rng.randrange(len(out))] = rng.choice("abcde")
        return "".join(out)

    texts = [hurt(items[4][1], 15), "zz " + items[3][1].upper() + " zz", hurt(items[2][1], 9), None, "", "q" * 5000]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")

    def brute(t):
        t, found = decontaminate.normal(t), []
        for i, x in items:
            x = decontaminate.normal(x)
            if x:
                row = [0] * (len(t) + 1)
                for p, c in enumerate(x, 1):
                    new = [p]
                    for q, y in enumerate(t, 1):
                        new.append(min(row[q - 1] + (c != y), row[q] + 1, new[-1] + 1))
                    row = new
                if min(row) <= (decontaminate.edit_budget(len(x)) if len(x) >= decontaminate.Q else 0):
                    found.append((i, min(row)))
        return found

    want = {i: brute(t) for i, t in enumerate(texts)}
    for block in (decontaminate.BLOCK_CHARS, 100):  # one block, then several
        got = {r.doc_id: [(f.item_id, f.edits) for f in r.found] for r in decontaminate.find_benchmark(table, bench, block_chars=block).collect()}
        assert got == want
    assert any(want.values())
    assert decontaminate.find_benchmark(empty, bench).count() == 0
    assert decontaminate.find_benchmark(docs, bench.limit(0)).where("size(found) > 0").count() == 0


def _labelled(spark, n, good, bad, name):
    rng = random.Random(8)
    rows = [(i, bad(rng) if i % 3 == 0 else good(rng)) for i in range(n)]
    docs = spark.createDataFrame([*rows, (n, None), (n + 1, ""), (n + 2, "a")], "doc_id long, text string")
    hit = 0 if name == "quality" else 1
    labels = spark.createDataFrame([(i, hit if i % 3 == 0 else 1 - hit) for i, _ in rows], f"doc_id long, {name} int")
    return docs, labels, rows, hit


def test_quality_on_held_out_rows(spark):
    docs, labels, rows, _ = _labelled(spark, 400, lambda r: " ".join(_words(r, 60)) + ".", lambda r: "!! ".join(w.upper() for w in _words(r, 20) * 3), "quality")
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert len(got) == 403 and all(0 <= r.score <= 1 for r in got.values())
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out for i in held)
    assert sum(got[i].predicted == (0 if i % 3 == 0 else 1) for i in held) >= 0.95 * len(held)
    assert quality.pool_adjacent_violators(np.array([1.0, 3, 2, 4]), np.ones(4)).tolist() == [1, 2.5, 2.5, 4]


def test_toxicity_on_held_out_rows(spark):
    def bad(r):
        w = _words(r, 60)
        w[r.randrange(60)] = w[r.randrange(60)] = "vileword" + r.choice(["", "s", "."])
        return " ".join(w)

    docs, labels, rows, _ = _labelled(spark, 500, lambda r: " ".join(_words(r, 60)), bad, "toxic")
    net = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, net).collect()}
    assert len(got) == 503 and all(0 <= r.score <= 1 for r in got.values())
    assert got[500].score == got[501].score == 0
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i].predicted == (i % 3 == 0) for i in held) >= 0.9 * len(held)
    assert toxicity.score_toxicity(docs.limit(0), net).count() == 0


def test_network_gradients():
    rows = [b"aa bb cc dd idiot ee", b"ff gg hh ii jj kk ll mm"]
    x = toxicity.Inputs(np.frombuffer(b"".join(rows), np.uint8), np.array([0, len(rows[0]), len(rows[0]) + len(rows[1])]))
    x.rows(np.arange(toxicity.BUCKETS) % toxicity.ROWS, np.arange(toxicity.BUCKETS) % toxicity.ROWS)
    _, places, length = x.windows()
    net = toxicity.Network()
    net.small = {k: v.astype(float) for k, v in net.small.items()}
    net.words, net.grams = net.words.astype(float) * 30, net.grams.astype(float) * 30
    which, y = x.which[places], np.array([1.0, 0.0])

    def loss():
        p = 1 / (1 + np.exp(-net.run(net.vectors(x) @ net.small["x"] + net.small["bias"], which, length)))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    state: dict = {}
    net.step(x, which, length, y, np.ones(2), state, 0.0)
    for k in ("u0", "c1", "v0", "bias", "head"):
        g = state[k][0] / 0.1
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, d = net.small[k][at], 1e-5
        net.small[k][at] = old + d
        up = loss()
        net.small[k][at] = old - d
        assert g[at] == pytest.approx((up - loss()) / 2 / d, rel=0.15, abs=1e-5)
        net.small[k][at] = old


def test_registered_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))


def _thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("size", [1024, 4096])
def test_words_that_cancel_out_under_powers_stay_apart(spark, size):
    """A Thue-Morse word and its complement collide under any polynomial modulo 2**64."""
    word, base = _thue_morse(size), [f"w{i}" for i in range(60)]
    other = word.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(0, " ".join([*base[:30], word, *base[30:]])), (1, " ".join([*base[:30], other, *base[30:]])), (2, word), (3, other)], "doc_id long, text string")
    assert [r.n_removed for r in repeated_spans.remove_repeated_spans(docs).orderBy("doc_id").collect()] == [0, 0, 0, 0]
    assert [r.component_id for r in near_duplicates.near_duplicates(docs, 3, 95).orderBy("doc_id").collect()] == [0, 1, 2, 3]


def test_repeated_ids_with_other_texts(spark):
    long = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(1, long), (2, "short"), (2, long), (2, "other " + long), (3, None)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in repeated_spans.remove_repeated_spans(docs).collect())
    assert got == [(1, 80, 0), (2, 1, 0), (2, 80, 80), (2, 81, 80), (3, 0, 0)]


def test_nodes_and_degrees_of_the_word_graph(spark):
    window, k = 6, 3
    rng = random.Random(3)
    stem, left, right = (_words(rng, 40) for _ in range(3))
    texts = [left + stem, right + stem, stem + left, stem + right, left + stem + right, ["x", "y"] * 20]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    paths, distinct = repeated_spans.distinct_paths(docs, window, k)
    assert paths.selectExpr("sum(n_nodes)").first()[0] == sum(len(t) - window + 2 for t in texts)
    asks = distinct.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(F.struct(*distinct.columns)).alias("asks"))
    visits = docs.join(asks, "doc_id").select("text", "asks").mapInArrow(repeated_spans._visit_nodes(window), repeated_spans._VISITS)
    after, before, where = {}, {}, {}
    for i, t in enumerate(texts):
        for p in range(len(t) - window + 2):
            node = tuple(t[p : p + window - 1])
            where[i, p] = node
            after.setdefault(node, set()).update(t[p + window - 1 : p + window])
            before.setdefault(node, set()).update(t[p - 1 : p] if p else [])
    got = {where[r.source.doc, r.source.pos]: r.fork for r in repeated_spans.graph_edges(visits.where("nth >= 0")).collect()}
    assert got
    for node, fork in got.items():
        assert fork == (len(after[node]) > 1 or len(before[node]) > 1)
    forks = {n for n in after if len(after[n]) > 1 or len(before[n]) > 1}
    met = {tuple(texts[i]) for i in range(5)}
    assert len(met) == 5 and {n for n, f in got.items() if f} == {n for n in forks if after[n]} and forks


def test_spans_are_glued_and_cut_at_branching_nodes(spark):
    rng = random.Random(4)
    base, other = _words(rng, 300), _words(rng, 100)
    texts = [base, ["lead"] + base[:200] + other, other[:30] + base, base]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    for window, k in ((50, 25), (20, 7)):
        got = {r.doc_id: r for r in repeated_spans.remove_repeated_spans(docs, window, k).collect()}
        n = 300 - window + 1
        fork = 200 - window + 1  # the node after which documents 0 and 1 part
        # the first node of base has the words "lead" and other[29] before it, so the span of document 2 begins at it anyway
        whole = [(0, fork, 0, 0), (fork, n - fork, 0, fork)]
        assert [tuple(s) for s in got[0].spans] == []
        assert [tuple(s) for s in got[1].spans] == [(1, fork, 0, 0)]
        assert [tuple(s) for s in got[2].spans if s.source_id == 0] == [(30 + f, m, s, p) for f, m, s, p in whole]
        assert [tuple(s) for s in got[3].spans] == whole
        assert [got[i].n_removed for i in range(4)] == [0, 200, 330 if window == 20 else 300, 300]
