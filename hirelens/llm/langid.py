"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, seeded by its code point.  A trigram's vector binds its letters'
vectors by elementwise product after permuting the first twice and the second once (a permutation is a rotation).
A document's vector bundles (adds) its trigrams' vectors; a language's prototype bundles the documents of that language,
each scaled to length one.  The prediction is the prototype of greatest cosine.

Only letters count: case is folded and each run of other characters is one blank.  Prototypes are bundled on the
executors, from every document with a language outside the held-out fold; the sums are of whole numbers, so they don't
depend on the layout, and the driver receives one vector a language.

A gate (keep_known) asks for the cosine that texts of the predicted language reach.  It is set from all held-out documents
and beginnings of them, by the effective number of trigrams: a bundle of few distinct trigrams has a small cosine, whatever
its language.  Cosines are counted in steps of 1 / STEPS, so what a quantile takes is bounded.  Unrelated texts have cosines of about 1 / sqrt(DIMENSIONS).

Edge cases: null texts and texts without letters give `und` with score 0; a null doc_id is never held out and never learned
from; with no labelled row every text is `und`; ties go to the language that sorts first; repeated rows give
repeated results; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import cut, fold, texts

DIMENSIONS, PARTS, HELD_OUT = 2048, 4, 2
#: Parts of one that a document's vector is rounded to before it is added to its language's.
UNIT = 1 << 24
#: The gate: the lengths of held-out documents' beginnings, classes of trigram numbers (powers of two),
#: the quantile that counts, the share of it that is asked for, the fewest scores a class is set from, and the steps of cosines.
BEGINNINGS, CLASSES, QUANTILE, SHARE, FEWEST, STEPS = [8 << k for k in range(10)], 16, 0.005, 0.8, 20, 1 << 16
#: Elements of bound trigrams held at a time, and rows of vectors.
BOUND, ROWS = 1 << 24, 1000
#: Characters looked at in one step; longer texts are taken in segments that overlap by two.
SEGMENT = 1_000_000
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """True for the code points that are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=20_000)
def letter_vector(code: int, dimensions: int) -> np.ndarray:
    return np.random.default_rng(code).integers(0, 2, dimensions, np.int8) * np.int8(2) - np.int8(1)


def _segments(text: str) -> list[str]:
    return [text[i : i + SEGMENT + 2] for i in range(0, max(1, len(text) - 2), SEGMENT)]


def profiles(batch: list[str | None], dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """(bundled vectors, numbers of trigrams) of texts."""
    out, n = np.zeros((len(batch), dimensions), np.float32), np.zeros(len(batch), np.int64)
    # A text is set between blanks, so even one letter makes a trigram.
    parts = [(k, s, not i) for k, t in enumerate(batch) if t for i, s in enumerate(_segments(f" {t.lower()} "))]
    begin = 0
    while begin < len(parts):
        end, size = begin, 0
        while end < len(parts) and (end == begin or size + len(parts[end][1]) <= SEGMENT):
            size += len(parts[end][1])
            end += 1
        owner = [k for k, _, _ in parts[begin:end]]
        joined = "\n".join(["", *[s for _, s, _ in parts[begin:end]], ""])
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        segment = np.cumsum(np.r_[0, np.array([len(s) + 1 for _, s, _ in parts[begin:end]])])
        at = np.repeat(np.arange(end - begin), np.diff(segment))  # of each character after the first
        letters = _letters()[codes]
        letter = np.where(letters, codes, np.uint32(32))
        there = np.zeros(0x110000, bool)
        there[letter] = True
        there[32] = True
        kinds = np.flatnonzero(there)
        place = np.zeros(0x110000, np.int32)
        place[kinds] = np.arange(len(kinds), dtype=np.int32)
        kind = place[letter]
        blank = int(np.searchsorted(kinds, 32))
        stays = letters[1:] | letters[:-1]  # of a run of others only the first stays
        stays[segment[:-1][[x for _, _, x in parts[begin:end]]]] = True
        keep = np.flatnonzero(stays) + 1
        kind, at = kind[keep], at[np.minimum(keep - 1, len(at) - 1)]
        if len(keep) >= 3:
            whole = (at[2:] == at[:-2]) & ((kind[1:-1] != blank) | (kind[2:] != blank))
            wide = kind if len(kinds) <= 1000 else kind.astype(np.int64)
            gram = ((wide[:-2] * len(kinds) + wide[1:-1]) * len(kinds) + wide[2:])[whole]
            row = at[2:][whole]
            if len(kinds) <= 400:  # few letters: a table of all trigrams finds those present
                there = np.zeros(len(kinds) ** 3, bool)
                there[gram] = True
                grams = np.flatnonzero(there)
                place = np.zeros(len(kinds) ** 3, np.int32)
                place[grams] = np.arange(len(grams), dtype=np.int32)
                gram = place[gram]
            else:
                grams, gram = np.unique(gram, return_inverse=True)
            owners, row_of = np.unique(owner, return_inverse=True)
            counts = np.zeros((len(owners), dimensions), np.float32)
            table = np.stack([letter_vector(int(c), dimensions) for c in kinds])
            first, second = np.roll(table, 2, 1), np.roll(table, 1, 1)
            per = max(1, min(4_000_000 // max(1, len(owners)), BOUND // dimensions))  # trigrams bound at a time
            pair = row_of[row].astype(np.int64)
            for g in range(0, len(grams), per):
                part = grams[g : g + per]
                own = slice(None) if per >= len(grams) else (gram >= g) & (gram < g + per)
                m = np.bincount(pair[own] * len(part) + (gram[own] - g), minlength=len(owners) * len(part)).reshape(len(owners), len(part)).astype(np.float32)
                vectors = (first[part // len(kinds) ** 2] * second[part // len(kinds) % len(kinds)] * table[part % len(kinds)]).astype(np.float32)
                counts += m @ vectors
            out[owners] += counts
            n += np.bincount(np.asarray(owner)[row], minlength=len(batch))
        begin = end
    return out, n


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _labelled(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))


def learn(docs: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """(languages in order, prototypes of length one)."""
    rows = _labelled(docs).where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", PARTS) != HELD_OUT))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in cut(batch):
                for i in range(0, part.num_rows, ROWS):
                    own = part.slice(i, ROWS)
                    vectors = np.rint(_unit(profiles(own.column(0).to_pylist(), dimensions)[0]) * np.float32(UNIT)).astype(np.int64)
                    langs, of = np.unique(np.array(own.column(1).to_pylist(), object), return_inverse=True)
                    for k, lang in enumerate(langs.tolist()):
                        total[lang] = total.get(lang, 0) + vectors[of == k].sum(0)
        for lang, v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dimensions, pa.string()), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(v)], ["lang", "place", "v"])

    sums = rows.select("text", "lang").mapInArrow(bundle, "lang string, place int, v long").groupBy("lang", "place").agg(F.sum("v").alias("v")).toArrow()
    langs = sorted(set(sums.column("lang").to_pylist()))
    out = np.zeros((len(langs), dimensions))
    if langs:
        of = {lang: k for k, lang in enumerate(langs)}
        out[[of[x] for x in sums.column("lang").to_pylist()], sums.column("place").to_numpy()] = sums.column("v").to_numpy()
    return langs, _unit(out).astype(np.float32)


def effective(vectors: np.ndarray, n: np.ndarray) -> np.ndarray:
    """n squared over the sum of squared trigram counts, which a bundle's squared length tells: repeats hardly add."""
    squares = np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64) / max(1, vectors.shape[1])
    return np.where(n > 0, n.astype(np.float64) ** 2 / np.maximum(squares, 1e-9), 0)


def _classes(size: np.ndarray) -> np.ndarray:
    return np.clip(np.log2(np.maximum(size, 1)).astype(int), 0, CLASSES - 1)


def _nearest(batch: list[str | None], prototypes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(nearest prototypes, cosines, numbers of trigrams, their classes) of texts."""
    best, score, count, kind = [np.zeros(0, int)], [np.zeros(0)], [np.zeros(0, int)], [np.zeros(0, int)]
    for i in range(0, len(batch), ROWS):
        vectors, n = profiles(batch[i : i + ROWS], prototypes.shape[1])
        kind.append(_classes(effective(vectors, n)))
        cosine = _unit(vectors) @ prototypes.T
        best.append(cosine.argmax(1))
        score.append(np.where(n > 0, np.clip(cosine.max(1), 0, 1), 0).astype(float))
        count.append(n)
    return np.concatenate(best), np.concatenate(score), np.concatenate(count), np.concatenate(kind)


def predict(batch: list[str | None], langs: list[str], prototypes: np.ndarray) -> tuple[list[str], np.ndarray]:
    """(languages, scores from 0 to 1) of texts."""
    if not langs:
        return [UNKNOWN] * len(batch), np.zeros(len(batch))
    best, score, n, _ = _nearest(batch, prototypes)
    return [langs[k] if m else UNKNOWN for k, m in zip(best, n, strict=True)], score


def calibrate(docs: DataFrame, langs: list[str], prototypes: np.ndarray, least: float) -> np.ndarray:
    """Least cosines by language and class of trigram number, from held-out documents and their beginnings.

    A class with few scores takes the next smaller class's; a language without any takes the lowest of the others.
    """
    gates = np.full((len(langs), CLASSES), np.nan)
    rows = _labelled(docs).where(F.col("lang").isin(langs) & (fold("doc_id", PARTS) == HELD_OUT))
    place = {lang: k for k, lang in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut(batch):
                parts = [(x[:n], g) for x, g in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) if x for n in [*[k for k in BEGINNINGS if k < len(x)], len(x)]]
                parts.sort(key=lambda x: len(x[0]))  # texts of one length have fewer trigrams among them
                _, score, n, kind = _nearest([x for x, _ in parts], prototypes)
                there = np.flatnonzero(n > 0)
                own = np.array([place[g] for _, g in parts], np.int64)[there] * CLASSES + kind[there]
                values, times = np.unique(own * (STEPS + 1) + np.floor(score[there] * STEPS).astype(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values // (STEPS + 1)), pa.array(values % (STEPS + 1)), pa.array(times.astype(np.int64))], ["own", "score", "n"])

    # One row for each step that cosines of a language and class have: what a quantile takes doesn't grow with the texts.
    scores = rows.select("text", "lang").mapInArrow(run, "own long, score long, n long").groupBy("own", "score").agg(F.sum("n").alias("n"))
    for r in scores.groupBy("own").agg(F.sum("n").alias("n"), F.percentile("score", F.lit(QUANTILE), F.col("n")).alias("low")).where(F.col("n") >= FEWEST).collect():
        gates[divmod(r["own"], CLASSES)] = SHARE * r["low"] / STEPS
    known = ~np.isnan(gates).all(1)
    gates = np.maximum.accumulate(np.nan_to_num(gates, nan=0.0), axis=1)
    gates[~known] = gates[known].min(0) if known.any() else 0
    return np.maximum(gates, least)


def identify(docs: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    langs, prototypes = learn(docs, dimensions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut(batch):
                lang, score = predict(part.column(1).to_pylist(), langs, prototypes)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    held = F.coalesce(fold("doc_id", PARTS) == HELD_OUT, F.lit(False)).alias("held_out")
    return texts(docs).select("doc_id", "text", held).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, least: float) -> DataFrame:
    """The rows of docs, all columns, whose text has a language with a score of at least the gate, which is `least` or more."""
    langs, prototypes = learn(docs)
    gates = calibrate(docs, langs, prototypes, least) if langs else None
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut(batch):
                if langs:
                    best, score, n, kind = _nearest(part.column(place).to_pylist(), prototypes)
                    yield part.filter(pa.array((n > 0) & (score >= gates[best, kind])))

    return docs.mapInArrow(run, docs.schema)
