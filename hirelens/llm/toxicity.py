"""Toxicity: a bidirectional gated recurrent network with attention pooling over overlapping windows of words.

A word's input joins a word vector (exact words of a bounded vocabulary, the rest share one) and a character vector
(the mean over its hashed character trigrams).  Two gated recurrent units read each window of WIDTH words in
both directions, attention weights pool their states, and a logistic unit scores the window.  Windows overlap by half,
cover the whole text, and the greatest window score is the document's.

Labels mark documents, not windows, so fitting alternates: choose each labelled document's highest window (and,
for clean documents, another at random), then descend the gradient over those, all in numpy.  Word vectors start from the
words' log odds between the two labels.  Fitting takes at most `positives` + `negatives` labelled rows of at most
LONGEST characters outside the held-out fold.

Edge cases: null and empty texts are one empty window; a null doc_id is never held out nor learned from; without labels
of both kinds every score is 0; several labels of a document: the greatest; repeated rows give repeated
results; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import cut, fold, labelled_sample, texts

WIDTH, STRIDE = 32, 16
WORD, CHAR, HIDDEN, BUCKETS = 6, 6, 8, 8192
VOCABULARY, POSITIVES, NEGATIVES, LONGEST = 4000, 2000, 6000, 12_000
EPOCHS, BATCH, RATE, DECAY = 6, 256, 0.01, 0.02
SHRINK, LEAST_SUPPORT = 20, 8
PARTS, HELD_OUT = 5, 0
#: Words in a vectorised step, and windows in a step of the network.
WORDS_AT_ONCE, WINDOWS_AT_ONCE = 300_000, 2048

_DROP = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words without ASCII punctuation; characters of punctuation alone leave no word."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(None, _DROP).split()


def _trigrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each trigram of ^word$, first trigram of each word)."""
    codes = np.frombuffer(b"\x02" + b"\x03\x02".join(words) + b"\x03", np.uint8).astype(np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(lengths) - lengths
    h = (codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1]) * np.uint32(0x85EBCA6B) + codes[2:]
    h = (h * np.uint32(0xC2B2AE35)) >> np.uint32(19)
    keep = np.ones(len(h), bool)  # those that begin in a word's last two places span two words
    keep[(starts + lengths - 2)[:-1]] = False
    keep[(starts + lengths - 1)[:-1]] = False
    return h[keep].astype(np.int64), starts - 2 * np.arange(len(words))


class Network:
    """Parameters by name in p; vocabulary maps words to rows of the word table (row 0: any other word)."""

    def __init__(self, vocabulary: dict[bytes, int], odds: np.ndarray, seed: int = 7):
        r = np.random.default_rng(seed)
        d = WORD + CHAR
        f = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.vocabulary = vocabulary
        self.p = {"word": 0.1 * r.standard_normal((len(vocabulary) + 1, WORD)).astype(np.float32), "char": 0.3 * r.standard_normal((BUCKETS, CHAR)).astype(np.float32)}
        self.p["word"][1:, 0] = odds
        for side in "fb":
            self.p |= {f"W{side}": f(d, 3 * HIDDEN), f"U{side}": f(HIDDEN, 3 * HIDDEN), f"c{side}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"A": f(2 * HIDDEN, HIDDEN), "a": f(HIDDEN), "v": f(2 * HIDDEN), "o": np.full(1, -2, np.float32)}

    def inputs(self, words: list[bytes]) -> np.ndarray:
        """Input vectors of distinct words."""
        p, get = self.p, self.vocabulary.get
        buckets, starts = _trigrams(words)
        sums = np.add.reduceat(p["char"][buckets], starts, axis=0)
        n = np.diff(np.r_[starts, len(buckets)])[:, None].astype(np.float32)
        return np.concatenate([p["word"][[get(w, 0) for w in words]], sums / n], axis=1)

    @staticmethod
    def _sigmoid(x):
        return 0.5 * np.tanh(0.5 * x) + 0.5

    def _direction(self, side: str, projected: np.ndarray, ids: np.ndarray, keep: dict | None) -> np.ndarray:
        """States of one direction: (steps, windows, HIDDEN).  projected: W x + c of each distinct word."""
        u, h2 = self.p[f"U{side}"], 2 * HIDDEN
        windows, steps = ids.shape
        h = np.zeros((windows, HIDDEN), np.float32)
        out = np.empty((steps, windows, HIDDEN), np.float32)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            x = projected[ids[:, t]]
            g = self._sigmoid(x[:, :h2] + h @ u[:, :h2])
            z, r = g[:, :HIDDEN], g[:, HIDDEN:]
            n = np.tanh(x[:, h2:] + (r * h) @ u[:, h2:])
            if keep is not None:
                keep[side, t] = (h, z, r, n)
            h = n + z * (h - n)
            out[t] = h
        return out

    def forward(self, vectors: np.ndarray, ids: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Scores of windows; ids: (windows, WIDTH) rows of vectors, -1 where a window has no word."""
        p = self.p
        full = np.concatenate([vectors, np.zeros((1, vectors.shape[1]), np.float32)])  # row -1: no word
        h = np.concatenate([self._direction(side, full @ p[f"W{side}"] + p[f"c{side}"], ids, keep) for side in "fb"], axis=2)
        e = np.tanh(h @ p["A"])
        s = e @ p["a"] + np.where(ids.T < 0, np.float32(-30), np.float32(0))
        w = np.exp(s - s.max(0))
        w /= w.sum(0)
        pooled = np.einsum("tn,tnh->nh", w, h)
        y = self._sigmoid(pooled @ p["v"] + p["o"][0])
        if keep is not None:
            keep["pool"] = (full, h, e, w, pooled, y)
        return y

    def gradient(self, words: list[bytes], ids: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted cross entropy by each parameter."""
        p, keep = self.p, {}
        vectors = self.inputs(words)
        self.forward(vectors, ids, keep)
        full, h, e, w, pooled, y = keep["pool"]
        steps = ids.shape[1]
        dy = ((y - target) * weight).astype(np.float32)
        g = {"v": pooled.T @ dy, "o": dy.sum(keepdims=True)}
        dpool = dy[:, None] * p["v"]
        dw = np.einsum("tnh,nh->tn", h, dpool)
        ds = w * (dw - (w * dw).sum(0))
        de = ds[:, :, None] * p["a"] * (1 - e * e)
        g["a"] = np.einsum("tn,tnk->k", ds, e)
        g["A"] = np.einsum("tnh,tnk->hk", h, de, optimize=True)
        dh = w[:, :, None] * dpool[None] + de @ p["A"].T
        dx = np.zeros((len(full), WORD + CHAR), np.float32)
        for k, side in enumerate("fb"):
            u, h2 = p[f"U{side}"], 2 * HIDDEN
            du, dc, dproj = np.zeros_like(u), np.zeros(3 * HIDDEN, np.float32), np.zeros((len(full), 3 * HIDDEN), np.float32)
            carry = np.zeros((len(ids), HIDDEN), np.float32)
            for t in range(steps - 1, -1, -1) if side == "f" else range(steps):
                before, z, r, n = keep[side, t]
                d = carry + dh[t][:, k * HIDDEN : (k + 1) * HIDDEN]
                dn = d * (1 - z) * (1 - n * n)
                dz = d * (before - n) * z * (1 - z)
                drh = dn @ u[:, h2:].T
                dr = drh * before * r * (1 - r)
                gates = np.concatenate([dz, dr], axis=1)
                carry = d * z + drh * r + gates @ u[:, :h2].T
                du[:, :h2] += before.T @ gates
                du[:, h2:] += (r * before).T @ dn
                step = np.concatenate([gates, dn], axis=1)
                dc += step.sum(0)
                np.add.at(dproj, ids[:, t], step)
            dc_words = dproj
            g |= {f"U{side}": du, f"c{side}": dc, f"W{side}": full.T @ dc_words}
            dx += dc_words @ p[f"W{side}"].T
        dx = dx[:-1]
        rows = np.array([self.vocabulary.get(x, 0) for x in words])
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], rows, dx[:, :WORD])
        buckets, starts = _trigrams(words)
        n = np.diff(np.r_[starts, len(buckets)])
        np.add.at(g["char"], buckets, np.repeat(dx[:, WORD:] / n[:, None], n, axis=0))
        return g

    def score_windows(self, words: list[bytes], ids: np.ndarray) -> np.ndarray:
        vectors = self.inputs(words) if words else np.zeros((0, WORD + CHAR), np.float32)
        return np.concatenate([self.forward(vectors, ids[i : i + WINDOWS_AT_ONCE]) for i in range(0, len(ids), WINDOWS_AT_ONCE)])

    def scores(self, batch: list[str | None]) -> np.ndarray:
        """The greatest window score of each text."""
        out = np.zeros(len(batch))
        group: list[tuple[int, list[bytes]]] = []
        size = 0
        for k, text in enumerate(batch):
            words = words_of(text)
            # A longer text goes in several parts that overlap like windows do.
            for at in range(0, max(1, len(words) - WIDTH + STRIDE), WORDS_AT_ONCE):
                part = words[at : at + WORDS_AT_ONCE + WIDTH - STRIDE] if len(words) > WORDS_AT_ONCE else words
                if group and size + len(part) > WORDS_AT_ONCE:
                    self._group(group, out)
                    group, size = [], 0
                group.append((k, part))
                size += len(part)
        if group:
            self._group(group, out)
        return out

    def _group(self, group: list[tuple[int, list[bytes]]], out: np.ndarray) -> None:
        distinct, ids, owner = windows_of([w for _, w in group])
        y = self.score_windows(distinct, ids)
        np.maximum.at(out, np.array([k for k, _ in group])[owner], y)


def windows_of(documents: list[list[bytes]]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words, windows as rows of them with -1 for no word, document of each window)."""
    known: dict[bytes, int] = {}
    flat = [x for d in documents for x in d]
    for x in flat:
        if x not in known:
            known[x] = len(known)
    index = np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))
    lengths = np.array([len(d) for d in documents], np.int64)
    per = np.maximum(1, -(-(lengths - WIDTH + STRIDE) // STRIDE))
    owner = np.repeat(np.arange(len(documents)), per)
    place = (np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)) * STRIDE
    begin = (np.cumsum(lengths) - lengths)[owner] + place
    at = begin[:, None] + np.arange(WIDTH)
    inside = place[:, None] + np.arange(WIDTH) < lengths[owner][:, None]
    ids = np.where(inside, index[np.minimum(at, max(0, len(index) - 1))] if len(index) else -1, -1)
    return list(known), ids, owner


def fit(batch: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Network | None:
    """None without both labels."""
    y = np.asarray(labels, np.float32)
    if not len(y) or y.min() == y.max():
        return None
    r = np.random.default_rng(seed)
    documents = [words_of(t) for t in batch]
    hits = [Counter(), Counter()]
    for d, label in zip(documents, y, strict=True):
        hits[int(label)].update(set(d))
    n = np.bincount(y.astype(int), minlength=2)
    # Log odds shrink towards the labels' own with SHRINK documents, so rare words that chance marks count for little.
    support = {w: c + hits[1][w] for w, c in hits[0].items()} | {w: c + hits[0][w] for w, c in hits[1].items()}
    often = [w for w, c in support.items() if c >= LEAST_SUPPORT]
    share = n[1] / n.sum()
    odds = {w: float(np.log((hits[1][w] + SHRINK * share) / (hits[0][w] + SHRINK * (1 - share))) - np.log(share / (1 - share))) for w in often}
    chosen = sorted(often, key=lambda w: (-abs(odds[w]) * support[w] ** 0.5, w))[:VOCABULARY]
    net = Network({w: k + 1 for k, w in enumerate(chosen)}, np.array([odds[w] / 2 for w in chosen], np.float32), seed)
    distinct, ids, owner = windows_of(documents)
    first = np.r_[np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]), len(owner)]
    value = np.array([odds.get(w, 0.0) if w in net.vocabulary else 0.0 for w in distinct] + [0.0])
    prior = np.sort(value[ids], axis=1)[:, -3:].sum(1)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    for epoch in range(epochs):
        rank = prior if not epoch else net.score_windows(distinct, ids)
        top = np.array([a + int(rank[a:b].argmax()) for a, b in zip(first[:-1], first[1:], strict=True)])
        other = np.array([r.integers(a, b) for a, b in zip(first[:-1], first[1:], strict=True)])[y == 0]
        rows = np.r_[top, other]
        target = np.r_[y, np.zeros(len(other), np.float32)]
        order = r.permutation(len(rows))
        rate = RATE * (1 - epoch / epochs) + 0.002
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            used, local = np.unique(ids[rows[own]], return_inverse=True)
            empty = used[0] < 0
            local = local.reshape(len(own), WIDTH) - int(empty)
            words = [distinct[k] for k in used[int(empty) :]]
            if not words:
                continue
            g = net.gradient(words, local, target[own], np.full(len(own), 1 / len(own), np.float32))
            step += 1
            for k, d in g.items():
                d = np.clip(d, -1, 1)
                m, v = moments[k]
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                if k in ("word", "char"):
                    net.p[k] *= 1 - rate * DECAY
                net.p[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-6)).astype(np.float32)
    return net


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> Network | None:
    """labels: doc_id and toxic (0 or 1)."""
    rows = labelled_sample(docs, labels, F.col("toxic"), {1: positives, 0: negatives}, PARTS, HELD_OUT, LONGEST)
    return fit([r["text"] for r in rows], np.array([r["value"] for r in rows]))


def _scores(net: Network | None, batch: list[str | None]) -> np.ndarray:
    return np.zeros(len(batch)) if net is None else net.scores(batch)


def score(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    net = train(docs, labels, positives, negatives)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut(batch):
                s = _scores(net, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(fold("doc_id", PARTS) == HELD_OUT, F.lit(False)).alias("held_out")
    return texts(docs).select("doc_id", "text", held).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, labels: DataFrame, most: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, that score under `most`."""
    net = train(docs, labels)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut(batch):
                yield part.filter(pa.array(_scores(net, part.column(place).to_pylist()) < most))

    return docs.mapInArrow(run, docs.schema)
