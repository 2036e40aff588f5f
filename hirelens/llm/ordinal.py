"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k | x) = sigmoid(t_k - w.x) with thresholds t_0 < t_1 < ... and weights w that all grades share.  x
is hashed text: shares of the byte n-grams of 1 to 3 bytes (lower and upper case apart) over BUCKETS buckets.  Thresholds are
kept in order by learning the first and the logarithms of the steps.  A score needs one table lookup per byte and
n-gram length, so whole texts of any length are scored in bounded memory.

Fitting takes at most `per_grade` labelled rows a grade of at most LONGEST characters, outside the held-out fold.

Edge cases: null and empty texts have x = 0; a null doc_id is never held out nor learned from; with one grade or
none among the labels every text gets that grade (or 0) with certainty; several labels of a document: the
greatest grade; repeated rows give repeated results; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import cut, fold, labelled_sample, texts

BUCKETS, ORDERS, PER_GRADE, LONGEST, PARTS, HELD_OUT = 4096, (1, 2, 3), 1500, 50_000, 5, 0
STEPS, RIDGE = 300, 3e-3
SEGMENT = 1 << 20


def _hashes(codes: np.ndarray, order: int) -> np.ndarray:
    """The bucket of the n-gram that begins at each byte but the last order - 1."""
    n = len(codes) - order + 1
    h = np.full(n, order, np.uint32)
    for j in range(order):
        h *= np.uint32(0x01000193)
        h ^= codes[j : j + n]
        h *= np.uint32(0x9E3779B1)
    return h >> np.uint32(32 - (BUCKETS - 1).bit_length())


def features(text: str | None) -> np.ndarray:
    """Shares of the n-grams by bucket."""
    x = np.zeros(BUCKETS, np.float64)
    codes = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    for order in ORDERS:
        if len(codes) >= order:
            x += np.bincount(_hashes(codes, order), minlength=BUCKETS) / (len(codes) - order + 1)
    return x.astype(np.float32)


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # one less than the grades
    grades: list[int]

    def scores(self, batch: list[str | None]) -> np.ndarray:
        """w.x of texts: bytes of many texts are hashed at once; n-grams that span two texts are left out."""
        out = np.zeros(len(batch))
        bodies = [(t or "").encode("utf-8", "surrogatepass") for t in batch]
        begin = 0
        while begin < len(bodies):
            end, size = begin, 0
            while end < len(bodies) and (end == begin or size + len(bodies[end]) <= SEGMENT):
                size += len(bodies[end])
                end += 1
            out[begin:end] = self._some(bodies[begin:end])
            begin = end
        return out

    def _some(self, bodies: list[bytes]) -> np.ndarray:
        lengths = np.array([len(b) for b in bodies], np.int64)
        starts = np.cumsum(lengths) - lengths
        total = np.zeros(len(bodies))
        codes = np.frombuffer(b"".join(bodies), np.uint8)
        for at in range(0, len(codes), SEGMENT):  # a longer single text goes in steps
            part = codes[at : at + SEGMENT + max(ORDERS) - 1]
            own = min(SEGMENT, len(codes) - at)
            for order in ORDERS:
                if len(part) < order:
                    continue
                w = self.weights[_hashes(part, order)[:own]]
                sums = np.r_[0.0, np.cumsum(w, dtype=np.float64)]
                lo = np.clip(starts - at, 0, len(w))
                hi = np.clip(starts + lengths - order + 1 - at, 0, len(w))
                total += np.where(lengths >= order, (sums[np.maximum(hi, lo)] - sums[lo]) / np.maximum(lengths - order + 1, 1), 0)
        return total

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k: a column each, falling from left to right."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -500, 500)))


def fit(x: np.ndarray, grade: np.ndarray, grades: list[int]) -> Model:
    """Maximum likelihood with a ridge penalty, by Adam on all rows."""
    if len(grades) < 2:
        return Model(np.zeros(BUCKETS), np.zeros(0), grades or [0])
    y = np.searchsorted(grades, grade)
    k = len(grades)
    mean, scale = x.mean(0), x.std(0) + 1e-4
    z = (x - mean) / scale
    w = np.zeros(x.shape[1], np.float32)
    shares = np.clip(np.cumsum(np.bincount(y, minlength=k))[:-1] / len(y), 0.01, 0.99)
    start = np.log(shares / (1 - shares))
    t = np.r_[start[0], np.log(np.maximum(np.diff(start), 0.05))]
    m, v = np.zeros(len(w) + len(t)), np.zeros(len(w) + len(t))
    rows = np.arange(len(y))
    balance = (len(y) / k / np.maximum(np.bincount(y, minlength=k), 1))[y]  # every grade weighs the same
    for step in range(1, STEPS + 1):
        steps = np.exp(t[1:])
        th = np.r_[t[0], t[0] + np.cumsum(steps)]
        s = z @ w
        cdf = 1 / (1 + np.exp(np.clip(s[:, None] - th[None, :], -50, 50)))
        cdf = np.c_[np.zeros(len(y)), cdf, np.ones(len(y))]
        hi, lo = cdf[rows, y + 1], cdf[rows, y]
        p = np.maximum(hi - lo, 1e-12)
        dhi, dlo = hi * (1 - hi), lo * (1 - lo)
        ds = balance * (dhi - dlo) / p  # of the negative log likelihood by s
        gth = np.zeros(k - 1)
        np.add.at(gth, np.minimum(y, k - 2), np.where(y < k - 1, -balance * dhi / p, 0))
        np.add.at(gth, np.maximum(y - 1, 0), np.where(y > 0, balance * dlo / p, 0))
        g = np.r_[z.T @ ds.astype(np.float32) / len(y) + RIDGE * w, np.r_[gth.sum(), np.cumsum(gth[::-1])[::-1][1:] * steps] / len(y)]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        d = 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w -= d[: len(w)].astype(np.float32)
        t -= d[len(w) :]
    th = np.r_[t[0], t[0] + np.cumsum(np.exp(t[1:]))]
    weights = (w / scale).astype(np.float64)
    return Model(weights, th + float(mean @ weights), grades)


def train(docs: DataFrame, ratings: DataFrame, grades: list[int], per_grade: int = PER_GRADE) -> Model:
    """ratings: doc_id and an integer grade."""
    rows = labelled_sample(docs, ratings, F.col("grade"), dict.fromkeys(grades, per_grade), PARTS, HELD_OUT, LONGEST)
    present = sorted({r["value"] for r in rows})
    if not rows:
        return fit(np.zeros((0, BUCKETS), np.float32), np.zeros(0), [])
    return fit(np.stack([features(r["text"]) for r in rows]), np.array([r["value"] for r in rows]), present)


def rate(docs: DataFrame, ratings: DataFrame, grades: list[int], per_grade: int = PER_GRADE, least: float = 0.5) -> DataFrame:
    """doc_id, held_out, expected_grade, tail_prob (of a grade above the lowest), selected (tail_prob >= least)."""
    model = train(docs, ratings, grades, per_grade)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut(batch):
                tails = model.tails(model.scores(part.column(1).to_pylist()))
                expected = model.grades[0] + tails @ np.diff(model.grades).astype(float)
                tail = tails[:, 0] if tails.shape[1] else np.full(part.num_rows, float(model.grades[0] > min(grades)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(expected, pa.float64()), pa.array(tail, pa.float64()), pa.array((tail >= least).astype(np.int32))], ["doc_id", "held_out", "expected_grade", "tail_prob", "selected"])

    held = F.coalesce(fold("doc_id", PARTS) == HELD_OUT, F.lit(False)).alias("held_out")
    return texts(docs).select("doc_id", "text", held).mapInArrow(run, "doc_id long, held_out boolean, expected_grade double, tail_prob double, selected int")
