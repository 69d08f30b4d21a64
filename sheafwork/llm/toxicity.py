"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A text's words (runs of letters and digits, lower-case) are read in overlapping windows of ``WINDOW`` words every
``STRIDE``, from the first to the last word. A word's input is its own embedding, if it is in the vocabulary, plus
its character input: the mean embedding of its hashed character n-grams (``GRAM_SIZES``). Two gated recurrent layers read a window in either direction,
attention pools their states, and a logistic unit scores it; a text's score is that of its most toxic window,
calibrated on the training documents.

Training sees whole texts and labels of a bounded sample: up to ``SAMPLE`` documents of either label, in the order of a
hash of the id among the labelled ones outside the held-out fold, and as many of them as hold ``CHARACTERS`` in all;
a text of more than a twentieth of that is passed over. Long texts are learnt from and calibrated on as short ones are.
The windows to learn from are, for either label, those with the highest summed log-odds of their words, later
those that the network itself scores highest, and some drawn at random. Scoring covers all windows of all texts.

Defined cases: null texts and texts without words have one empty window and score as the calibrated bias does;
equal texts score equally, as scores are rounded to six places; without both labels to learn from, every score is the labels' mean (0 without labels);
repeated label rows count once, by their highest label; of rows that repeat a doc_id with different texts, the one of
the least text hash is learnt from; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.llm.common import held, held_out, map_arrow, release

WINDOW, STRIDE = 24, 16
#: Documents of either label to learn from at most, and the characters of their texts.
SAMPLE, CHARACTERS = 1000, 6_000_000
VOCABULARY, WIDTH, HIDDEN = 3000, 8, 8
#: Sizes of the character n-grams, in bytes with a mark at either end of a word, and the buckets they are hashed to.
GRAM_SIZES, GRAMS = (3, 5, 7), 8192
#: Words whose n-grams are looked up at once.
PORTION = 20_000
#: Words whose inputs a worker remembers; beyond that, it starts afresh.
REMEMBERED = 120_000
WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def windows(n: int, window: int = WINDOW, stride: int = STRIDE) -> range:
    """Starts of the windows over n words; the last one reaches the end."""
    return range(0, max(1, n - (window - stride)), stride)


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of the bytes of <word>, word after word, and where each word's begin (and the end)."""
    data = np.frombuffer("".join(f"<{w}>" for w in words).encode(), dtype=np.uint8).astype(np.int64)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    word = np.cumsum(data == ord("<")) - 1
    found, owners = [], []
    for n in GRAM_SIZES:
        if len(data) < n:
            continue
        end = len(data) - n + 1
        inside = np.flatnonzero(word[:end] == word[n - 1 :])
        mixed = np.full(len(inside), n, dtype=np.int64)
        for k in range(n):
            mixed = (mixed * 1_000_003 + data[inside + k]) & 0x7FFFFFFF
        found.append((mixed ^ mixed >> 13) % GRAMS)
        owners.append(word[inside])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(found)[order], np.searchsorted(owner[order], np.arange(len(words) + 1))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _direction(gates: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: bool):
    """States of one direction. gates: time x rows x 3H from the inputs; mask: time x rows, 0 where a window has ended."""
    steps, n, h3 = gates.shape
    h = h3 // 3
    state = np.zeros((n, h), dtype=gates.dtype)
    states, kept = np.empty((steps, n, h), dtype=gates.dtype), []
    for t in range(steps):
        zr = sigmoid(gates[t, :, : 2 * h] + state @ u[:, : 2 * h])
        z, r = zr[:, :h], zr[:, h:]
        inner = state @ u[:, 2 * h :]
        c = np.tanh(gates[t, :, 2 * h :] + r * inner)
        step = mask[t][:, None] * (1 - z)
        if keep:
            kept.append((state, z, r, inner, c, step))
        state = state + step * (c - state)
        states[t] = state
    return states, kept


def _direction_back(d_states: np.ndarray, kept: list, mask: np.ndarray, u: np.ndarray):
    """Gradients of the gates and of u."""
    steps, n, h = d_states.shape
    d_gates, d_u, d = np.zeros((steps, n, 3 * h), dtype=u.dtype), np.zeros_like(u), np.zeros((n, h), dtype=u.dtype)
    for t in range(steps - 1, -1, -1):
        state, z, r, inner, c, step = kept[t]
        d = d + d_states[t]
        dz = -d * mask[t][:, None] * (c - state) * z * (1 - z)
        dc = d * step * (1 - c * c)
        dr = dc * inner * r * (1 - r)
        d_gates[t] = np.hstack([dz, dr, dc])
        d_u[:, : 2 * h] += state.T @ np.hstack([dz, dr])
        d_u[:, 2 * h :] += state.T @ (dc * r)
        d = d * (1 - step) + np.hstack([dz, dr]) @ u[:, : 2 * h].T + (dc * r) @ u[:, 2 * h :].T
    return d_gates, d_u


@dataclass
class Network:
    """Parameters by name, the vocabulary, and the calibration of a text's highest window."""

    vocabulary: dict[str, int]
    p: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    @staticmethod
    def fresh(vocabulary: list[str], seed: int = 7) -> Network:
        g = np.random.default_rng(seed)
        part = lambda *s, by=0.3: (g.standard_normal(s) * by).astype(np.float32)
        p = {"words": part(len(vocabulary) + 1, WIDTH, by=0.1), "grams": part(GRAMS, WIDTH, by=0.1), "attend": part(2 * HIDDEN), "out": part(2 * HIDDEN), "bias": np.zeros(1, np.float32)}
        for way in ("ahead", "back"):
            p |= {f"w_{way}": part(WIDTH, 3 * HIDDEN), f"b_{way}": np.zeros(3 * HIDDEN, np.float32), f"u_{way}": part(HIDDEN, 3 * HIDDEN)}
        p["words"][-1] = 0
        return Network({w: k for k, w in enumerate(vocabulary)}, p)

    def inputs(self, words: list[str]) -> np.ndarray:
        """The input vector of each word, some thousand words at a time, as their n-grams take far more room."""
        if len(words) > PORTION:
            return np.vstack([self.inputs(words[k : k + PORTION]) for k in range(0, len(words), PORTION)])
        own = np.fromiter((self.vocabulary.get(w, len(self.vocabulary)) for w in words), dtype=np.int64, count=len(words))
        grams, starts = grams_of(words)
        return self.p["words"][own] + np.add.reduceat(self.p["grams"][grams], starts[:-1], axis=0) / np.diff(starts)[:, None].astype(np.float32)

    def gates(self, x: np.ndarray) -> np.ndarray:
        """Both directions' input gates of each word, ahead then back."""
        return np.hstack([x @ self.p[f"w_{way}"] + self.p[f"b_{way}"] for way in ("ahead", "back")])

    def logits(self, gates: np.ndarray, ids: np.ndarray, keep: bool = False):
        """A score for each window. ids: rows x time, -1 where a window has ended."""
        width, ids = 3 * HIDDEN, ids.T
        mask = (ids >= 0).astype(np.float32)
        own = gates[ids]  # ended steps read the last row, and the mask leaves them out
        ahead, kept_a = _direction(own[:, :, :width], mask, self.p["u_ahead"], keep)
        back, kept_b = _direction(own[::-1, :, width:], mask[::-1], self.p["u_back"], keep)
        back = back[::-1]
        a, v = self.p["attend"], self.p["out"]
        score = ahead @ a[:HIDDEN] + back @ a[HIDDEN:] + (mask - 1) * 1e9
        weight = np.exp(score - score.max(axis=0)) * mask
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        value = ahead @ v[:HIDDEN] + back @ v[HIDDEN:]
        out = (weight * value).sum(axis=0) + self.p["bias"][0]
        return (out, (ids, mask, ahead, back, kept_a, kept_b, weight, value)) if keep else out

    def gradients(self, gates: np.ndarray, ids: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
        """Mean loss, gradients of the parameters behind the gates, and of the gates themselves."""
        out, (ids, mask, ahead, back, kept_a, kept_b, weight, value) = self.logits(gates, ids, keep=True)
        d = ((sigmoid(out) - y) / len(y)).astype(np.float32)
        pooled = (weight * value).sum(axis=0)
        d_score, d_value = d * weight * (value - pooled), d * weight
        a, v = self.p["attend"], self.p["out"]
        states = np.concatenate([ahead, back], axis=2)
        d_states = d_score[:, :, None] * a + d_value[:, :, None] * v
        grad = {"attend": np.einsum("tn,tnh->h", d_score, states), "out": np.einsum("tn,tnh->h", d_value, states), "bias": np.array([d.sum()], np.float32)}
        ga, grad["u_ahead"] = _direction_back(np.ascontiguousarray(d_states[:, :, :HIDDEN]), kept_a, mask, self.p["u_ahead"])
        gb, grad["u_back"] = _direction_back(np.ascontiguousarray(d_states[::-1, :, HIDDEN:]), kept_b, mask[::-1], self.p["u_back"])
        rows = np.concatenate([ga, gb[::-1]], axis=2) * mask[:, :, None]
        d_gates = np.zeros_like(gates)
        np.add.at(d_gates, ids[ids >= 0], rows[ids >= 0])
        loss = float(np.mean(np.logaddexp(0, out) - y * out))
        return loss, grad, d_gates


def _ids(table: dict[str, int], words: list[str]) -> np.ndarray:
    return np.fromiter(map(table.__getitem__, words), dtype=np.int64, count=len(words))


def cut(ids: np.ndarray) -> np.ndarray:
    """All windows of a text's word numbers: rows x WINDOW, -1 beyond the end."""
    starts = windows(len(ids))
    padded = np.full(starts[-1] + WINDOW, -1, dtype=np.int64)
    padded[: len(ids)] = ids
    return padded[np.arange(0, starts[-1] + 1, STRIDE)[:, None] + np.arange(WINDOW)]


def train(texts: list[str | None], labels: list[int], seed: int = 7) -> Network:
    """Fits a network to whole texts and their labels."""
    y = np.array(labels, dtype=np.float32)
    if len(y) == 0 or y.min() == y.max():
        return Network({}, {}, constant=float(y.mean()) if len(y) else 0.0)
    g, pool = np.random.default_rng(seed), {}
    spelt = [[pool.setdefault(w, w) for w in words_of(t)] for t in texts]  # each word is held once
    seen: dict[str, np.ndarray] = {}
    for words, label in zip(spelt, labels, strict=True):
        for w in set(words):
            seen.setdefault(w, np.zeros(2))[label] += 1
    vocabulary = sorted((w for w, n in seen.items() if n.sum() >= 3), key=lambda w: (-seen[w].sum(), w))[:VOCABULARY]
    every = sorted(seen)
    number = {w: k for k, w in enumerate(every)}
    n1, n0 = y.sum(), len(y) - y.sum()
    odds = np.array([np.log((seen[w][1] + 0.5) / (n1 + 1)) - np.log((seen[w][0] + 0.5) / (n0 + 1)) for w in every])
    odds[[seen[w].sum() < 3 for w in every]] = 0
    grams, starts = grams_of(every)
    # The odds of a word are at least those of any of its n-grams, so that telling parts of words count too.
    present = np.zeros((2, GRAMS))
    for words, label in zip(spelt, labels, strict=True):
        if words:
            own = {number[w] for w in words}
            present[label, np.unique(np.concatenate([grams[starts[k] : starts[k + 1]] for k in own]))] += 1
    by_gram = np.log((present[1] + 0.5) / (n1 + 1)) - np.log((present[0] + 0.5) / (n0 + 1))
    by_gram[present.sum(axis=0) < 3] = 0
    odds = np.maximum(odds, np.maximum.reduceat(by_gram[grams], starts[:-1])) if every else odds
    cuts = [cut(_ids(number, words)) for words in spelt]
    flat, owner = np.vstack(cuts), np.repeat(np.arange(len(cuts)), [len(c) for c in cuts])
    rank = np.where(flat >= 0, odds[flat], 0).sum(axis=1)
    net = Network.fresh(vocabulary, seed)
    in_words = np.array([net.vocabulary.get(w, len(vocabulary)) for w in every])
    sizes = np.diff(starts)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0

    def tops(score: np.ndarray) -> np.ndarray:
        order = np.lexsort((-score, owner))
        first = np.ones(len(order), bool)
        first[1:] = owner[order][1:] != owner[order][:-1]
        return order[first]

    def score_all() -> np.ndarray:
        gates = net.gates(net.inputs(every))
        return np.concatenate([net.logits(gates, flat[k : k + 512]) for k in range(0, len(flat), 512)])

    for phase, epochs in enumerate((8, 6, 6)):
        chosen = tops(rank if phase == 0 else score_all())
        clean = np.flatnonzero(y[owner] == 0)
        chosen = np.concatenate([chosen, g.choice(clean, min(len(clean), len(y)), replace=False)])
        for _ in range(epochs):
            g.shuffle(chosen)
            for k in range(0, len(chosen), 128):
                rows = chosen[k : k + 128]
                used, inverse = np.unique(flat[rows], return_inverse=True)
                local = inverse.reshape(flat[rows].shape)
                if used[0] < 0:
                    used, local = used[1:], local - 1
                spans = [np.arange(starts[w], starts[w + 1]) for w in used]
                grams_used, cuts_used = grams[np.concatenate(spans)] if spans else grams[:0], np.cumsum([0, *map(len, spans)])
                x = net.p["words"][in_words[used]] + (np.add.reduceat(net.p["grams"][grams_used], cuts_used[:-1], axis=0) / sizes[used][:, None].astype(np.float32) if spans else 0)
                _, grad, d_gates = net.gradients(net.gates(x.astype(np.float32)), local, y[owner[rows]])
                d_x = np.zeros_like(x)
                for way, part in (("ahead", d_gates[:, : 3 * HIDDEN]), ("back", d_gates[:, 3 * HIDDEN :])):
                    grad[f"w_{way}"], grad[f"b_{way}"] = x.T @ part, part.sum(axis=0)
                    d_x += part @ net.p[f"w_{way}"].T
                grad["words"], grad["grams"] = np.zeros_like(net.p["words"]), np.zeros_like(net.p["grams"])
                np.add.at(grad["words"], in_words[used], d_x)
                grad["words"][-1] = 0
                np.add.at(grad["grams"], grams_used, np.repeat(d_x / sizes[used][:, None], sizes[used], axis=0))
                step += 1
                for name, value in net.p.items():  # Adam
                    first, second = moment[name]
                    first += 0.1 * (grad[name] - first)
                    second += 0.001 * (grad[name] ** 2 - second)
                    value -= 0.01 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    score = score_all()
    top = score[tops(score)]
    by_owner = y[owner[tops(score)]]
    scale, shift = 1.0, 0.0
    for _ in range(300):  # calibration: a logistic fit of the labels on the highest window
        off = sigmoid(scale * top + shift) - by_owner
        scale, shift = max(0.05, scale - 0.05 * float((off * top).mean())), shift - 0.5 * float(off.mean())
    net.scale, net.shift = scale, shift
    return net


class Scorer:
    """Scores whole texts; remembers words. Lives in one worker."""

    def __init__(self, net: Network):
        self.net, self.known = net, {}
        self.rows = np.zeros((4096, 6 * HIDDEN), dtype=np.float32)

    def learn(self, words: list[str]) -> None:
        n = len(self.known)
        if n + len(words) > len(self.rows):
            self.rows = np.vstack([self.rows[:n], np.zeros((max(len(words), REMEMBERED // 4), 6 * HIDDEN), dtype=np.float32)])
        self.rows[n : n + len(words)] = self.net.gates(self.net.inputs(words))
        self.known.update(zip(words, range(n, n + len(words)), strict=True))

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Scores from 0 to 1, of the highest of all windows of each text."""
        if self.net.constant is not None:
            return np.full(len(texts), self.net.constant)
        if len(self.known) > REMEMBERED:
            self.known, self.rows = {}, np.zeros((4096, 6 * HIDDEN), dtype=np.float32)
        spelt = [words_of(t) for t in texts]
        new = set().union(*spelt) - self.known.keys()
        if new:
            self.learn(sorted(new))
        cuts = [cut(_ids(self.known, words)) for words in spelt]
        flat = np.vstack(cuts)
        logits = np.concatenate([self.net.logits(self.rows, flat[k : k + 2048]) for k in range(0, len(flat), 2048)])
        top = np.maximum.reduceat(logits, np.cumsum([0, *(len(c) for c in cuts[:-1])]))
        return np.round(sigmoid(self.net.scale * top.astype(np.float64) + self.net.shift), 6)


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> tuple[list[str | None], list[int]]:
    """Texts and labels of at most ``size`` documents of either label outside the held-out fold."""
    own = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)").where(~held_out("doc_id", 5, 0))
    own = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("draw", F.xxhash64("doc_id", F.lit("toxicity")))
    some = [own.where(F.col("toxic") == label).orderBy("draw", "doc_id").limit(2 * size) for label in (0, 1)]
    drawn = F.broadcast(some[0].unionByName(some[1]))  # at most four times ``size`` rows of numbers
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("length", F.coalesce(F.length("text"), F.lit(0)))
    once = texts.join(drawn, "doc_id").groupBy("doc_id", "toxic", "draw").agg(F.min(F.struct(F.xxhash64("text").alias("key"), "length", "text")).alias("t"))
    order = Window.partitionBy("toxic").orderBy("draw", "doc_id")
    fitting = once.where(F.col("t.length") <= CHARACTERS // 20).select("toxic", F.col("t.text").alias("text"), F.row_number().over(order).alias("n"), F.sum("t.length").over(order).alias("sum"))
    kept = fitting.where((F.col("n") <= size) & (F.col("sum") <= CHARACTERS)).orderBy("toxic", "n").collect()
    return [r["text"] for r in kept], [r["toxic"] for r in kept]


class Judge:
    """Scores batches of texts in a worker that keeps its scorer from task to task."""

    def __init__(self, docs: DataFrame, labels: DataFrame, size: int = SAMPLE):
        self.shared = docs.sparkSession.sparkContext.broadcast(train(*sample(docs, labels, size)))  # some ten thousand numbers
        release()

    def __call__(self, texts: pa.Array) -> np.ndarray:
        net = self.shared.value
        scorer = held("toxicity", net, lambda: Scorer(net))
        parts = [scorer.score(texts[k : k + 300].to_pylist()) for k in range(0, len(texts), 300)]
        return np.concatenate(parts) if parts else np.zeros(0)


def score(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    judge = Judge(docs, labels, size)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = judge(batch.column(2))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out("doc_id", 5, 0).alias("held_out"), F.col("text").cast("string").alias("text"))
    return map_arrow(own, run, "doc_id bigint, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, size: int = SAMPLE) -> DataFrame:
    """The rows of documents that score below the threshold, all columns as they are; no join, one pass."""
    judge, place = Judge(docs, labels, size), docs.columns.index("text")
    return map_arrow(docs, lambda batch: batch.filter(pa.array(judge(batch.column(place)) < threshold)), docs.schema)
