"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Each word is one step.  Its input joins a hashed word vector with the mean of
hashed character n-gram vectors (3 to 5 bytes, word starts told apart, and starts of 6
to 10 bytes); words and
n-grams of fewer than `LEAST_DOCS` training documents share row 0, so that rare
ones are not learnt by heart.  Two gated recurrent layers read a window of words in either direction, attention
pools their states, and a logistic unit scores the window.  Windows of
`WINDOW` words overlap by half and cover every word of a text; a document's
score is that of its highest window.

Trained in numpy by back-propagation through time on a bounded sample of whole texts
(`most` documents and `most_chars` characters per class), in one Spark task, so that the
driver meets the fitted tables only.  Labels are of documents, so windows start from the
log-odds of their words and n-grams between the classes: the first coordinate of
a vector starts there, and in the first epochs the toxic windows are those of
toxic documents that hold a word or n-gram of high odds.  Later a toxic document
is also represented by the window that the network itself finds highest.

Defined cases: null, empty and blank texts score 0; texts shorter than a window
are one masked window; repeated rows are scored alike; extra columns are ignored;
without labelled documents of both classes every score is 0.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, TO_LOWER, Words, hash_ranges, slices
from .labelled import is_held_out, labelled_sample

WINDOW, STRIDE, HIDDEN, WIDTH = 32, 16, 8, 8
BUCKETS, ROWS, LEAST_DOCS = 1 << 20, 1 << 15, 4
GRAMS, STARTS = (3, 4, 5), (6, 7, 8, 10)
THRESHOLD, HIGH_ODDS = 0.3, 2.3


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)


class Inputs:
    """Distinct words of some texts: word rows, character n-gram rows, and which word stands at each place."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        words = Words(data, at, TO_LOWER)
        self.first = words.first
        distinct, one, self.which = np.unique(words.hash, return_index=True, return_inverse=True)
        self._describe(distinct, words.data, words.start[one], words.end[one])

    @classmethod
    def of(cls, rows: list[bytes]) -> Inputs:
        """The same of many texts, met in slices; only their distinct words are held together."""
        self, known, which, kept, each, low = cls.__new__(cls), {}, [], [], [], 0
        while low < len(rows):
            high, size = low, 0
            while high < len(rows) and (high == low or size + len(rows[high]) <= SLICE_BYTES):
                size, high = size + len(rows[high]), high + 1
            words = Words(np.frombuffer(b"".join(rows[low:high]), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in rows[low:high]]))), TO_LOWER)
            distinct, one, place = np.unique(words.hash, return_index=True, return_inverse=True)
            before = len(known)
            number = np.array([known.setdefault(h, len(known)) for h in distinct.tolist()], np.int32)
            kept.extend(words.data[words.start[i] : words.end[i]].tobytes() for i in one[np.argsort(number)][number[np.argsort(number)] >= before])
            which.append(number[place])
            each.append(np.diff(words.first))
            low = high
        self.which = np.concatenate([*which, np.zeros(0, np.int32)])
        self.first = np.concatenate(([0], np.cumsum(np.concatenate([*each, np.zeros(0, np.int64)]))))
        end = np.cumsum([len(w) for w in kept], dtype=np.int64)
        self._describe(np.fromiter(known, np.uint64, len(known)), np.frombuffer(b"".join(kept), np.uint8), np.concatenate(([0], end[:-1])) if kept else end, end)
        return self

    def _describe(self, distinct: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        self.word = (distinct % np.uint64(BUCKETS)).astype(np.int64)
        length, rows, owner = end - start, [], []
        for n in GRAMS + STARTS:
            count = np.maximum(length - n + 1, 0) if n in GRAMS else (length >= n).astype(np.int64)
            who = np.repeat(np.arange(len(distinct)), count)
            place = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
            begin = start[who] + place
            rows.append((hash_ranges(data, begin, begin + n) + (place == 0).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(BUCKETS))
            owner.append(who)
        owner, rows = np.concatenate(owner), np.concatenate(rows).astype(np.int64)
        order = np.argsort(owner, kind="stable")
        self.gram, self.count = rows[order], np.bincount(owner, minlength=len(distinct))

    def rows(self, word_row: np.ndarray, gram_row: np.ndarray) -> Inputs:
        """The same with buckets replaced by table rows."""
        self.word, self.gram = word_row[self.word], gram_row[self.gram]
        return self

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, places (windows x WINDOW), lengths); places past the end repeat the last one."""
        n = np.diff(self.first)
        each = np.where(n == 0, 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)))
        doc = np.repeat(np.arange(len(n)), each)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)
        start = np.minimum(nth * STRIDE, np.maximum(n[doc] - WINDOW, 0))
        length = np.minimum(n[doc] - start, WINDOW)
        places = (self.first[doc] + start).astype(np.int32)[:, None] + np.minimum(np.arange(WINDOW, dtype=np.int32), length.astype(np.int32)[:, None] - 1)
        return doc, places, length


class Network:
    """Parameters and passes; direction 0 reads forwards, 1 backwards."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        f = lambda *shape, s=0.3: (r.standard_normal(shape) * s).astype(np.float32)
        self.words, self.grams = f(ROWS, WIDTH, s=0.01), f(ROWS, WIDTH, s=0.01)
        self.word_row = self.gram_row = np.zeros(BUCKETS, np.int32)
        self.small = {"x": f(2 * WIDTH, 6 * HIDDEN), "bias": np.zeros(6 * HIDDEN, np.float32), "head": np.zeros(1, np.float32)}
        for d in (0, 1):
            self.small |= {f"u{d}": f(HIDDEN, 2 * HIDDEN), f"c{d}": f(HIDDEN, HIDDEN), f"v{d}": f(HIDDEN, 2)}
        self.shift = np.float32(0)

    def vectors(self, x: Inputs) -> np.ndarray:
        """Word vector and mean n-gram vector of each distinct word."""
        total = np.zeros((len(x.word), WIDTH), np.float32)
        some = x.count > 0
        if some.any():
            start = np.concatenate(([0], np.cumsum(x.count[some])[:-1]))
            total[some] = np.add.reduceat(self.grams[x.gram], start) / x.count[some][:, None]
        return np.concatenate((self.words[x.word], total), 1)

    def run(self, inputs: np.ndarray, which: np.ndarray, length: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Logit of each window.  inputs: gate inputs of each distinct word; which: windows x WINDOW."""
        p, n = self.small, len(which)
        mask = (np.arange(WINDOW) < length[:, None]).astype(np.float32)
        marks = np.zeros((WINDOW, n, 2), np.float32)
        for d in (0, 1):
            h = np.zeros((n, HIDDEN), np.float32)
            gates = inputs[:, d * 3 * HIDDEN : (d + 1) * 3 * HIDDEN]
            for t in range(WINDOW) if d == 0 else range(WINDOW - 1, -1, -1):
                g = gates[which[:, t]]
                zr = _sigmoid(g[:, : 2 * HIDDEN] + h @ p[f"u{d}"])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(g[:, 2 * HIDDEN :] + (r * h) @ p[f"c{d}"])
                new = h + mask[:, t, None] * z * (c - h)
                if keep is not None:
                    keep.append((d, t, h, z, r, c, new))
                h = new
                marks[t] += h @ p[f"v{d}"]  # attention score and contribution, both linear in the state
        score = np.where(mask.T > 0, marks[:, :, 0], -1e9)
        weight = np.exp(score - score.max(0))
        weight /= weight.sum(0)
        logit = (weight * marks[:, :, 1]).sum(0) + p["head"][0]
        if keep is not None:
            keep.append((mask, marks, weight))
        return logit

    def step(self, x: Inputs, which: np.ndarray, length: np.ndarray, label: np.ndarray, weight: np.ndarray, state: dict, rate: float) -> None:
        """One gradient step of the weighted logistic loss over some windows."""
        p, kept = self.small, []
        used, local = np.unique(which, return_inverse=True)
        local = local.reshape(which.shape)
        start = np.cumsum(x.count) - x.count
        part = Inputs.__new__(Inputs)
        part.word, part.count = x.word[used], x.count[used]
        flat = np.repeat(start[used], part.count) + np.arange(part.count.sum()) - np.repeat(np.cumsum(part.count) - part.count, part.count)
        part.gram = x.gram[flat]
        vectors = self.vectors(part)
        inputs = vectors @ p["x"] + p["bias"]
        logit = self.run(inputs, local, length, kept)
        mask, marks, alpha = kept.pop()
        dy = (_sigmoid(logit) - label) * weight / weight.sum()
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        grad["head"][0] = dy.sum()
        da = dy * marks[:, :, 1]
        dmarks = np.stack((alpha * (da - (alpha * da).sum(0)), alpha * dy), 2).astype(np.float32)
        dinputs = np.zeros((len(which), WINDOW, 6 * HIDDEN), np.float32)
        dh, last = None, None
        for d, t, h, z, r, c, new in reversed(kept):
            if d != last:
                dh, last = np.zeros_like(h), d
            m = mask[:, t, None]
            grad[f"v{d}"] += new.T @ dmarks[t]
            dn = dh + dmarks[t] @ p[f"v{d}"].T
            dz, dc = dn * m * (c - h) * z * (1 - z), dn * m * z * (1 - c * c)
            drh = dc @ p[f"c{d}"].T
            grad[f"c{d}"] += (r * h).T @ dc
            dzr = np.concatenate((dz, drh * h * r * (1 - r)), 1)
            grad[f"u{d}"] += h.T @ dzr
            dh = dn * (1 - m * z) + drh * r + dzr @ p[f"u{d}"].T
            dinputs[:, t, d * 3 * HIDDEN : (d + 1) * 3 * HIDDEN] = np.concatenate((dzr, dc), 1)
        flat = local.ravel()
        order = np.argsort(flat, kind="stable")
        dwords = np.add.reduceat(dinputs.reshape(-1, 6 * HIDDEN)[order], np.searchsorted(flat[order], np.arange(len(used))))
        grad["x"], grad["bias"] = vectors.T @ dwords, dwords.sum(0)
        dvectors = dwords @ p["x"].T
        state["n"] = n = state.get("n", 0) + 1
        for k, g in grad.items():  # Adam
            a, b = state.setdefault(k, (np.zeros_like(g), np.zeros_like(g)))
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p[k] -= rate * (a / (1 - 0.9**n)) / (np.sqrt(b / (1 - 0.99**n)) + 1e-8)
        owner = np.repeat(np.arange(len(used)), part.count)
        for name, table, rows, g in (("words", self.words, part.word, dvectors[:, :WIDTH]), ("grams", self.grams, part.gram, (dvectors[:, WIDTH:] / np.maximum(part.count, 1)[:, None])[owner])):
            if len(rows):  # Adagrad on the rows that occur
                order = np.argsort(rows, kind="stable")
                row, begin = np.unique(rows[order], return_index=True)
                g = np.add.reduceat(g[order], begin)
                seen = state.setdefault(name, np.full(len(table), 1e-5, np.float32))
                seen[row] += (g * g).mean(1)
                table[row] -= 10 * rate * g / np.sqrt(seen[row])[:, None]

    def window_logits(self, x: Inputs, places: np.ndarray, length: np.ndarray, block: int = 2048) -> np.ndarray:
        inputs, which = self.vectors(x) @ self.small["x"] + self.small["bias"], x.which.astype(np.int32)
        out = [self.run(inputs, which[places[i : i + block]], length[i : i + block]) for i in range(0, len(places), block)]
        return np.concatenate(out) if out else np.zeros(0, np.float32)

    def scores(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Score of each text: that of its highest window."""
        x = Inputs(data, at).rows(self.word_row, self.gram_row)
        doc, places, length = x.windows()
        best = np.full(len(at) - 1, -np.inf)
        if len(doc):
            logits = self.window_logits(x, places, length).astype(np.float64) + self.shift
            head = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
            best[doc[head]] = np.maximum.reduceat(logits, head)
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-best))


class _Known:
    """Documents and toxic documents of each bucket; a row for those met in LEAST_DOCS documents or more, the most frequent first, 0 for others."""

    def __init__(self):
        self.count, self.toxic = np.zeros(BUCKETS, np.int32), np.zeros(BUCKETS, np.int32)

    def add(self, buckets: np.ndarray, label: float) -> None:
        once = np.unique(buckets)
        self.count[once] += 1
        if label:
            self.toxic[once] += 1

    def rows(self, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row of each bucket and log-odds of each row."""
        best = np.argsort(-self.count, kind="stable")[: ROWS - 1]
        best = best[self.count[best] >= LEAST_DOCS]
        row, odds = np.zeros(BUCKETS, np.int32), np.zeros(ROWS)
        row[best] = np.arange(1, len(best) + 1)
        odds[1 : len(best) + 1] = np.log((self.toxic[best] + 2) / (self.count[best] - self.toxic[best] + 2) * (labels == 0).sum() / labels.sum())
        return row, odds


def fit(texts: list[str], labels: np.ndarray, epochs: int = 6, steps: int = 120, seed: int = 7) -> Network:
    """Train on texts labelled 0 or 1; the last step moves the border between the classes to THRESHOLD.  Without both classes all scores are 0."""
    net, rng, state = Network(seed), np.random.default_rng(seed), {}
    labels = np.asarray(labels, np.float32)
    if len(set(labels.tolist())) < 2:
        net.shift = np.float32(-np.inf)
        return net
    x = Inputs.of([t.encode() for t in texts])
    words, grams, start = _Known(), _Known(), np.cumsum(x.count) - x.count
    for i, label in enumerate(labels):
        own = np.unique(x.which[x.first[i] : x.first[i + 1]])
        words.add(x.word[own], label)
        if len(own):
            grams.add(np.concatenate([x.gram[start[w] : start[w] + x.count[w]] for w in own]), label)
    (net.word_row, word_odds), (net.gram_row, gram_odds) = words.rows(labels), grams.rows(labels)
    x.rows(net.word_row, net.gram_row)
    net.words[:, 0], net.grams[:, 0] = 0.3 * np.clip(word_odds, -1, 3), 0.3 * np.clip(gram_odds, -1, 3)
    strong = word_odds[x.word] > HIGH_ODDS
    np.logical_or.at(strong, np.repeat(np.arange(len(x.word)), x.count), gram_odds[x.gram] > HIGH_ODDS)
    doc, places, length = x.windows()
    which = x.which[places]
    y = labels[doc]
    told = strong[which].any(1) & (y == 1)
    fitted = doc % 4 != 3  # every fourth document only sets the border
    for epoch in range(epochs):
        weight, hard = np.ones(len(doc), np.float32), rng.random(len(doc)) < 0.3
        if epoch >= 2:
            logits = net.window_logits(x, places, length)
            top = np.full(len(labels), -np.inf)
            np.maximum.at(top, doc, logits)
            told, hard = (told & (logits > -2)) | (logits >= top[doc] - 1e-6), hard & (rng.random(len(doc)) < 0.3) | (logits > -4)
        chosen = np.flatnonzero(fitted & ((y == 0) & hard | (y == 1) & told))
        positive, negative = weight[chosen][y[chosen] == 1].sum(), weight[chosen][y[chosen] == 0].sum()
        weight = np.where(y == 1, max(1.0, 0.3 * negative / max(positive, 1)), 1).astype(np.float32)
        chosen = rng.permutation(chosen)
        batch = min(512, max(32, len(chosen) // steps))
        for i in range(0, len(chosen), batch):
            b = chosen[i : i + batch]
            net.step(x, which[b], length[b], y[b], weight[b], state, 0.01 if epoch < epochs - 1 else 0.003)
    top = np.full(len(labels), -30.0)
    np.maximum.at(top, doc, net.window_logits(x, places, length))
    if len(set(labels[3::4])) == 2:
        top, labels = top[3::4], labels[3::4]
    order = np.argsort(top)
    wrong = np.concatenate(([0], np.cumsum(labels[order] == 1))) + np.concatenate((np.cumsum(labels[order][::-1] == 0)[::-1], [0]))
    least = np.flatnonzero(wrong == wrong.min())
    cut = least[len(least) // 2]
    low, high = (top[order[cut - 1]] if cut else top.min() - 2), (top[order[cut]] if cut < len(order) else top.max() + 2)
    net.shift = np.float32(np.log(THRESHOLD / (1 - THRESHOLD)) - (low + high) / 2)
    return net


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fitted network of one partition that holds the whole sample."""
    rows = sorted({d: (t, y) for b in batches for d, t, y in sorted(zip(*(c.to_pylist() for c in b.columns), strict=True), reverse=True)}.items())
    net = fit([t for _, (t, _) in rows], np.array([y for _, (_, y) in rows]))
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net)], pa.binary())], ["net"])


def train(docs: DataFrame, labels: DataFrame, most: int = 1000, most_chars: int = 8_000_000) -> Network:
    """Fit on at most `most` labelled documents, of at most `most_chars` characters in all, per class that are not held out."""
    sample = labelled_sample(docs, labels, "toxic", most, most_chars)
    fitted = sample.repartition(1).mapInArrow(_fit, "net binary").first()
    return pickle.loads(fitted["net"]) if fitted else fit([], np.zeros(0))  # without rows there may be no partition


def score_toxicity(docs: DataFrame, net: Network) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    model = docs.sparkSession.sparkContext.broadcast(net)  # fixed size: hashed tables

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, at in slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0)[low:high], pa.array(model.value.scores(data, at))], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
