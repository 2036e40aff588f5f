"""SentencePiece encoding and decoding as weighted finite-state transduction.

A model file compiles to three transducers: the normaliser (longest-match rewriting of the rules in the model, blanks to
U+2581, dummy prefix), the pieces (a trie whose arcs read characters and whose final arcs write a piece), and byte
fallback (an arc for each character that no piece reads, writing its UTF-8 bytes as byte pieces).  Composed with an
input they give a lattice; the encoding is its shortest path in the tropical semiring.

Unigram models weigh a piece by minus its score.  Merge (BPE) models need a weight on pairs: a path is the result of merging
exactly when each two neighbours are what merging their joined text gives (and each piece is what its own text
gives), so a pair weighs 0 or infinity.  That makes the path of finite weight unique, and so is the piece that ends it at
each place: lattice states need no more memory than places.  Pair weights are found once by running the merges on the
joined text of the two pieces.  In runs of blanks merges tie in score, so their order decides, which no weight on pairs tells:
a part that begins with such a run is one arc, whose output is what merging it gives.  Time is linear in a text, and
for runs of blanks n log n.

No piece holds U+2581 after another character, so a text falls apart before each run of blanks; each distinct
part is composed once per worker and its ids kept in two bounded generations.

Decoding runs the transducers backwards: pieces to text, byte pieces to bytes (broken UTF-8 gives U+FFFD), U+2581 to blank,
and the dummy prefix is taken off.

Edge cases: very long texts, words and runs of blanks are encoded whole; equal scores merge from the left; a null text encodes as empty, which has no ids; null doc_id passes through; repeated rows give repeated
results; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .runtime import cut, texts

BLANK = "▁"
# Kinds of pieces and of models in a SentencePiece model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
INFINITY = float("inf")
#: Parts and pairs kept by a worker, and the longest part kept, in characters.
GENERATION, PAIRS, KEPT = 400_000, 600_000, 1000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        n = shift = 0
        while True:
            c = data[at]
            at += 1
            n |= (c & 127) << shift
            if c < 128:
                return n
            shift += 7

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        n = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, data[at : at + n]
        at += n


class Normaliser:
    """Rewrites the longest rule that matches at each place; other characters stay."""

    def __init__(self, spec: bytes):
        f = dict(_fields(spec))
        self.prefix, self.squeeze, self.escape = bool(f.get(3, 1)), bool(f.get(4, 1)), bool(f.get(5, 1))
        self.rules: dict[bytes, bytes] = {}
        if charsmap := f.get(2, b""):
            self._compile(charsmap)
        self.longest = max(map(len, self.rules), default=0)

    def _compile(self, charsmap: bytes) -> None:
        """Rules from a double array whose leaves point into zero-ended replacements."""
        (n,) = struct.unpack_from("<I", charsmap)
        units, strings = np.frombuffer(charsmap, "<u4", n // 4, 4).tolist(), charsmap[4 + n :]
        offset = lambda u: (u >> 10) << ((u & 512) >> 6)
        todo = [(offset(units[0]), b"")]
        while todo:
            base, read = todo.pop()
            for c in range(1, 256):
                place = base ^ c
                if place < len(units) and units[place] & 0x800000FF == c:
                    node, key = units[place], read + bytes([c])
                    below = place ^ offset(node)
                    if node >> 8 & 1:
                        at = units[below] & 0x7FFFFFFF
                        self.rules[key] = strings[at : strings.index(b"\0", at)]
                    todo.append((below, key))

    def __call__(self, text: str) -> str:
        if self.rules:
            data, out, at = text.encode("utf-8", "surrogatepass"), [], 0
            while at < len(data):
                for n in range(min(self.longest, len(data) - at), 0, -1):
                    if (to := self.rules.get(data[at : at + n])) is not None:
                        break
                else:
                    n = 1 if data[at] < 128 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
                    to = data[at : at + n]
                out.append(to)
                at += n
            text = b"".join(out).decode("utf-8", "replace")
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if text and self.prefix:
            text = f" {text}"
        return text.replace(" ", BLANK) if self.escape else text


class Transducer:
    """A compiled model."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.model, normaliser = UNIGRAM, b""
        for k, v in _fields(data):
            if k == 1:
                f = dict(_fields(v))
                self.pieces.append(f.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", f.get(2, b"\0\0\0\0"))[0])
                self.kinds.append(f.get(3, NORMAL))
            elif k == 2:
                self.model = dict(_fields(v)).get(3, UNIGRAM)
            elif k == 3:
                normaliser = v
        if self.model not in (UNIGRAM, BPE) or UNUSED in self.kinds or USER in self.kinds:
            raise ValueError("only unigram and merge models without user-defined or unused pieces are compiled")
        self.normalise = Normaliser(normaliser)
        self.number = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == NORMAL}
        if any(BLANK in p.lstrip(BLANK) for p in self.number):
            raise ValueError("a piece goes on after a blank, so texts don't fall apart before blanks")
        self.unknown = self.kinds.index(UNKNOWN) if UNKNOWN in self.kinds else 0
        self.byte = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}
        self.worst = min((self.scores[i] for i in self.number.values()), default=0.0) - 10.0
        # The trie: a state maps characters to states, and the empty string to the piece it writes.
        self.start: dict = {}
        for p, i in self.number.items():
            state = self.start
            for c in p:
                state = state.setdefault(c, {})
            state[""] = i
        self.pair: dict[tuple[int, int], float] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self._decoded = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k in (CONTROL, UNKNOWN) else p.replace(BLANK, " ").encode() for p, k in zip(self.pieces, self.kinds, strict=True)]
        if self.unknown < len(self._decoded) and UNKNOWN in self.kinds:
            self._decoded[self.unknown] = b" \xe2\x81\x87 "

    def merged(self, text: str) -> list[str]:
        """The symbols that merging gives: the pair of best score first, the leftmost of equal ones."""
        symbols: list[str | None] = list(text)
        after = [*range(1, len(symbols)), -1]
        before = [-1, *range(len(symbols) - 1)]
        number, scores = self.number, self.scores
        heap = [(-scores[k], i, 2) for i in range(len(symbols) - 1) if (k := number.get(symbols[i] + symbols[i + 1])) is not None]
        heapify(heap)
        while heap:
            _, i, size = heappop(heap)
            j = after[i] if symbols[i] is not None else -1
            if j < 0 or len(symbols[i]) + len(symbols[j]) != size:
                continue  # one of the two has merged otherwise
            symbols[i] += symbols[j]
            symbols[j] = None
            n = after[i] = after[j]
            if n >= 0:
                before[n] = i
            for a, b in ((before[i], i), (i, n)):
                if a >= 0 and b >= 0 and (k := number.get(symbols[a] + symbols[b])) is not None:
                    heappush(heap, (-scores[k], a, len(symbols[a]) + len(symbols[b])))
        return [x for x in symbols if x is not None]

    def weight(self, before: int, piece: int) -> float:
        """Of a piece after another (-1: at the start)."""
        if self.model == UNIGRAM:
            return -self.scores[piece]
        key = (before, piece)
        w = self.pair.get(key)
        if w is None:
            own = [self.pieces[piece]] if before < 0 else [self.pieces[before], self.pieces[piece]]
            w = 0.0 if self.merged("".join(own)) == own else INFINITY
            if len(self.pair) > PAIRS:
                self.pair.clear()
            self.pair[key] = w
        return w

    def fallback(self, character: str) -> list[int]:
        return [self.byte[b] for b in character.encode("utf-8", "replace")] if len(self.byte) == 256 else [self.unknown]

    def shortest_path(self, part: str) -> list[int]:
        """Ids of the lattice of one normalised part."""
        run = len(part) - len(part.lstrip(BLANK))
        if self.model == BPE and run > 1:  # ties: see above
            symbols = self.merged(part)
            return [i for s in symbols for i in ([self.number[s]] if s in self.number else self.fallback(s))]
        n, start, weight, pairs = len(part), self.start, self.weight, self.pair
        merge = self.model == BPE
        cost = [INFINITY] * (n + 1)
        last = [-1] * (n + 1)  # the piece that ends the best path to a place; -1: none, -2: fallback
        back = [0] * (n + 1)
        cost[0] = 0.0
        for i in range(n):
            here = cost[i]
            if here == INFINITY:
                continue
            before, state, j = last[i], start, i
            if before == -2:
                before = -1
            single = False
            while j < n:
                state = state.get(part[j])
                if state is None:
                    break
                j += 1
                piece = state.get("")
                if piece is None:
                    continue
                if j == i + 1:
                    single = True
                if merge:
                    if not cost[j]:
                        continue  # weights are 0 or infinity, so this place has its path
                    w = pairs.get((before, piece))
                    if w is None:
                        w = weight(before, piece)
                else:
                    w = weight(before, piece)
                if here + w < cost[j]:
                    cost[j], last[j], back[j] = here + w, piece, i
            if not single:  # byte fallback reads one character that no piece reads alone
                w = here + (0.0 if merge else -self.worst)
                if w < cost[i + 1]:
                    cost[i + 1], last[i + 1], back[i + 1] = w, -2, i
        if cost[n] == INFINITY:
            raise ValueError("no path of finite weight: the pair weights do not fit this model")
        out: list[list[int]] = []
        at = n
        while at:
            out.append([last[at]] if last[at] >= 0 else self.fallback(part[at - 1]))
            at = back[at]
        return [i for x in reversed(out) for i in x]

    def parts(self, text: str) -> list[str]:
        """A normalised text cut before each run of blanks."""
        return re.findall(f"{BLANK}*[^{BLANK}]+|{BLANK}+", text)

    def encode_all(self, batch: list[str]) -> list[bytes]:
        """Ids of texts as little-endian 32-bit integers."""
        split = []
        for t in batch:
            n = self.normalise(t)
            # Without runs of blanks the cheap cut gives the same parts.
            if n.startswith(BLANK) and BLANK * 2 not in n and not n.endswith(BLANK):
                split.append([f"{BLANK}{x}" for x in n[1:].split(BLANK)])
            else:
                split.append(self.parts(n))
        if len(self.known) > GENERATION:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = set().union(*split).difference(known)
        for c in new:
            ids = older.get(c)
            known[c] = np.array(self.shortest_path(c), "<u4").tobytes() if ids is None else ids
        get = known.__getitem__
        out = [b"".join(map(get, s)) for s in split]
        for c in [c for c in new if len(c) > KEPT]:  # long parts are not kept
            del known[c]
        return out

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self._decoded.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.normalise.prefix and text.startswith(" ") else text


_COMPILED: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One per worker process."""
    if path not in _COMPILED:
        with open(path, "rb") as f:
            _COMPILED[path] = Transducer(f.read())
    return _COMPILED[path]


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (array), n_ids, ids_crc32 (of the ids as little-endian 32-bit integers), decoded_crc32 (of the text
    decoded from the ids, as UTF-8) and round_trip (whether that is the text) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model)
        for batch in batches:
            for part in cut(batch):
                given = [x or "" for x in part.column(1).to_pylist()]
                bodies = t.encode_all(given)
                n = np.fromiter((len(b) // 4 for b in bodies), np.int64, len(bodies))
                flat = np.frombuffer(b"".join(bodies), "<u4").astype(np.int32)
                decoded = [t.decode(np.frombuffer(b, "<u4").tolist()) for b in bodies]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(flat)), pa.array(n), pa.array([zlib.crc32(b) for b in bodies], pa.int64()), pa.array([zlib.crc32(d.encode()) for d in decoded], pa.int64()), pa.array([d == g for d, g in zip(decoded, given, strict=True)])],
                    ["doc_id", "ids", "n_ids", "ids_crc32", "decoded_crc32", "round_trip"],
                )

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>, n_ids long, ids_crc32 long, decoded_crc32 long, round_trip boolean")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([t.decode(x or []) for x in b.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
