"""Best-fit packing of tokenised documents by a configuration linear program.

A configuration is a multiset of piece lengths that fits in a sequence; the program asks for the fewest
configurations that cover the length histogram.  Multiplicative weights solve it to a fractional solution and a lower
bound (see fractional), knapsack dynamic programming prices the configurations, and the solution is rounded to whole
multiples; what these leave is packed best fit into what room they leave.  If plain best fit has fewer
sequences, it is taken.  The histogram (one row per length) and the plan (runs of places, at most a few for each
configuration) don't grow with the documents, so the driver solves it; ranks of pieces within their length are
dealt out over salted groups and placed on executors.

Edge cases: a null text counts as empty, so its document is the end id alone; a very long text is cut into pieces, all full
but the last; pieces of equal length are placed in the order of their ids; repeated rows and repeated or null
doc_ids are packed as they stand; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import cut, staged, texts
from .subwords import encoder

CAPACITY, ROUNDS = 4096, 400
#: Lengths under a SMALL-th of the capacity are short; long ones make CLASSES rows.  A round covers at most QUOTA of a row, takes
#: what is worth within NEAR steps of the best; the first step of a price, and the rounds after which steps are half as long.
SMALL, CLASSES, QUOTA, NEAR, FIRST_STEP, SLOWER = 16, 256, 0.01, 0.25, 0.1, 20
#: Rounds of a short run, the gap between plan and bound that needs no long one, the share of a fractional solution that is
#: rounded at once, how often the rest is solved anew; pieces numbered in one group.
SHORT_RUN, GAP, SCALE, LEVELS, GROUP = 60, 0.001, 0.93, 3, 50_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most `capacity` ids of every document, the end id included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, False)
        for batch in batches:
            for part in cut(batch):
                rows = []
                for doc_id, body in zip(part.column(0).to_pylist(), enc.encode_all([t or "" for t in part.column(1).to_pylist()]), strict=True):
                    ids = np.append(np.frombuffer(body, enc.dtype).astype("<u4"), np.uint32(end_id)).astype("<u4")
                    for k, at in enumerate(range(0, len(ids), capacity)):
                        own = ids[at : at + capacity]
                        rows.append((doc_id, k, at, len(own), zlib.crc32(own.tobytes())))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECES, strict=True)], schema=_PIECES)

    return texts(docs).mapInArrow(run, PIECES)


@dataclass
class Plan:
    """Sequences in groups alike: (how many, [(length, copies), ...]) and what is known of the optimum."""

    groups: list[tuple[int, list[tuple[int, int]]]]
    sequences: int
    #: No packing has fewer sequences: the program's dual says so.
    lower_bound: int
    #: Runs of places, ordered by length and rank: first rank, copies to a sequence, first sequence, offset there.
    length: np.ndarray
    rank: np.ndarray
    copies: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def knapsack(lengths: np.ndarray, value: np.ndarray, capacity: int) -> np.ndarray:
    """Best value of each capacity 0 .. capacity with any number of copies; units may stay free.  All capacities up to the
    shortest length apart depend on earlier ones alone, so they are found at once."""
    best = np.zeros(capacity + 1)
    if not len(lengths):
        return best
    step = int(lengths.min())
    for begin in range(step, capacity + 1, step):
        c = np.arange(begin, min(begin + step, capacity + 1))
        place = c[None, :] - lengths[:, None]
        own = np.where(place >= 0, best[np.maximum(place, 0)] + value[:, None], -np.inf).max(0)
        best[c] = np.maximum.accumulate(np.maximum(own, best[begin - 1]))
    return best


def _classes(need: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(longest length, shortest length, pieces) of at most CLASSES classes of neighbouring long lengths, of like sizes."""
    long = np.flatnonzero(need[: capacity + 1] * (np.arange(capacity + 1) >= capacity // SMALL))
    if not len(long):
        return long, long, long
    share = np.cumsum(need[long]) * CLASSES // max(1, int(need[long].sum()) + 1)
    if len(long) <= CLASSES:
        share = np.arange(len(long))
    first = np.flatnonzero(np.r_[True, share[1:] != share[:-1]])
    return long[np.r_[first[1:], len(long)] - 1], long[first], np.add.reduceat(need[long], first)


def fractional(need: np.ndarray, capacity: int, rounds: int = ROUNDS) -> tuple[dict[tuple[int, ...], float], float]:
    """(weights of configurations of classes that cover the long pieces, a lower bound of the program).

    The covering program's dual asks for prices of lengths under which no configuration is worth over one.  Every round
    prices configurations by the knapsack program and takes about best ones, within a share QUOTA of each row's need,
    which bounds the width; then each price falls by the factor exp(-step) to the power of the share of its quota that
    was covered.  Steps shrink from round to round.  Short pieces are one further row: what a configuration leaves
    free is worth their price a token.  The average of the later rounds' configurations is the fractional solution;
    prices, scaled by what the dearest configuration is worth to the shortest length of each class, are feasible
    and give the bound.
    """
    top, low, rows = _classes(need, capacity)
    tokens = int((need * np.arange(capacity + 1)).sum())
    if not len(top):
        return {}, tokens / capacity
    b = rows.astype(np.float64)
    sand = float((need[: capacity // SMALL] * np.arange(capacity // SMALL)).sum())
    lengths, sizes = top.tolist(), top.astype(np.float64)
    y, z = sizes / capacity, 1 / capacity if sand else 0.0
    taken: dict[tuple[int, ...], float] = {}
    covered, bound = np.zeros(len(top)), tokens / capacity
    mean, mean_z, burn = np.zeros(len(top)), 0.0, rounds // 4

    for t in range(rounds):
        step = FIRST_STEP / (1 + t / SLOWER)
        value = y - z * sizes
        best = knapsack(top, value, capacity)
        worth = value + best[capacity - top]
        slack = NEAR * step * (best[capacity] + z * capacity)  # a configuration may lack so much of the dearest one
        quota = QUOTA * b
        open_ = np.arange(len(top))  # rows with quota left, shortest first
        dust = grains = QUOTA * sand
        for k in np.argsort(-worth, kind="stable").tolist():
            lacks = best[capacity] - worth[k]
            if lacks > slack:
                break
            if quota[k] <= 1e-9 * b[k]:
                continue
            items, room = {k: 1}, capacity - lengths[k]
            while room >= lengths[open_[0]]:  # the next item by what the rest of the room is worth then, among rows with quota
                fits = open_[: np.searchsorted(sizes[open_], room, "right")]
                then = value[fits] + best[room - top[fits]]
                i = int(then.argmax())
                if then[i] < 1e-12 or (loss := best[room] - then[i]) + lacks > slack:
                    break
                x = int(fits[i])
                lacks += loss
                items[x] = items.get(x, 0) + 1
                room -= lengths[x]
            if lacks + best[room] > slack:
                continue
            names, n = np.fromiter(items, np.int64), np.fromiter(items.values(), np.float64)
            times = float((quota[names] / n).min())
            quota[names] -= times * n
            if (quota[names] <= 1e-9 * b[names]).any():
                open_ = np.flatnonzero(quota > 1e-9 * b)
                if not len(open_):
                    open_ = np.array([len(top) - 1])
            dust = max(0.0, dust - times * room)
            if t >= burn:
                name = tuple(sorted(x for x, c in items.items() for _ in range(c)))
                taken[name] = taken.get(name, 0.0) + times
        quota = np.maximum(quota, 0)
        done = 1 - quota / (QUOTA * b)
        y = y * np.exp(-step * done)
        z = z * math.exp(-step * (1 - dust / grains)) if sand else 0.0
        weight = float(b @ y) + sand * z
        y, z = y / weight, z / weight
        if t >= burn:
            covered += done * QUOTA
            mean += y
            mean_z += z
        if t % 20 == 19 or t == rounds - 1:
            for p, q in ((y, z), (mean, mean_z)):
                if p.any():
                    dearest = knapsack(low, p - q * low, capacity)[capacity]
                    bound = max(bound, (float(b @ p) + sand * q) / (dearest + q * capacity))
    whole = max(1e-9, float(np.average(covered, weights=b * sizes)))
    return {c: w / whole for c, w in taken.items()}, bound


def best_fit(left: np.ndarray, capacity: int, opened: list[tuple[int, list[tuple[int, int]]]] = ()) -> list[tuple[int, list[tuple[int, int]]]]:
    """Pack what is left, longest first, into the least room that holds it: of the sequences opened already, else a new
    one.  Sequences alike are handled as a group."""
    rooms: dict[int, list[list]] = {}
    there = np.zeros(capacity + 1, bool)

    def put(n: int, items: list, room: int) -> None:
        rooms.setdefault(room, []).append([n, items])
        there[room] = True

    for n, items in opened:
        put(n, items, capacity - sum(x * k for x, k in items))
    for x in np.flatnonzero(left)[::-1].tolist():
        n = int(left[x])
        while n:
            room = x + int(there[x:].argmax())
            if there[room]:
                group = rooms[room][-1]
            else:
                room, group = capacity, [n, []]  # new sequences; those not needed are not taken
                rooms.setdefault(room, []).append(group)
                there[room] = True
                group[0] = -(-n // (capacity // x))
            k = min(room // x, n)
            m = min(group[0], n // k)
            group[0] -= m
            if not group[0]:
                rooms[room].pop()
                there[room] = bool(rooms[room])
            put(m, [*group[1], (x, k)], room - k * x)
            n -= m * k
    return [(n, items) for groups in rooms.values() for n, items in groups if items]


def _whole(taken: dict[tuple[int, ...], float], left: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Whole multiples of a fractional solution's configurations within the pieces in left (of a class the longest that are
    left), which are taken out of it.  What rounding leaves of one configuration counts for the next one in order."""
    top, low, _ = _classes(left, capacity)
    cursor, opened, carried = top.tolist(), [], 0.5
    for items, weight in sorted(taken.items()):
        carried += weight * SCALE
        times = int(carried)
        carried -= times
        while times > 0:
            real: dict[int, int] = {}
            for k in items:
                while cursor[k] >= low[k] and left[cursor[k]] <= 0:
                    cursor[k] -= 1
                x = cursor[k]
                while x >= low[k] and left[x] <= real.get(x, 0):
                    x -= 1
                if x < low[k]:
                    break
                real[x] = real.get(x, 0) + 1
            else:
                m = min(times, *(int(left[x]) // n for x, n in real.items()))
                for x, n in real.items():
                    left[x] -= m * n
                opened.append((m, sorted(real.items(), reverse=True)))
                times -= m
                continue
            break
    return opened


def rounded(taken: dict[tuple[int, ...], float], need: np.ndarray, capacity: int, levels: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """A fractional solution rounded.  The pieces that rounding leaves make a smaller program, solved and rounded in turn
    `levels` times; the rest is packed best fit."""
    left = need.copy()
    opened = _whole(taken, left, capacity)
    for _ in range(levels):
        some = fractional(left, capacity, SHORT_RUN)[0]
        if not some:
            break
        opened += _whole(some, left, capacity)
    return best_fit(left, capacity, opened)


def solve(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> Plan:
    """A plan that packs every piece of the histogram: the program's solution rounded, or plain best fit if that has fewer
    sequences.  A short run of the weights comes first; if its plan is not within GAP of its bound, a long one follows.
    Full pieces are sequences of their own and take no part in the program."""
    need = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        need[length] = n
    full, need[capacity] = int(need[capacity]), 0
    count = lambda g: sum(n for n, _ in g)
    bound, plans = 0.0, []
    for n, levels in ((SHORT_RUN, 0), (rounds, LEVELS)):
        taken, least = fractional(need, capacity, n)
        bound = max(bound, least)
        plans += [rounded(taken, need, capacity, levels)] if taken else []
        plans.append(best_fit(need, capacity))
        groups = min(plans, key=count)
        if count(groups) <= (1 + GAP) * math.ceil(bound - 1e-6):
            break
    groups = ([(full, [(capacity, 1)])] if full else []) + groups
    return _runs(groups, count(groups), min(count(groups), full + math.ceil(bound - 1e-6)))


def _runs(groups: list[tuple[int, list[tuple[int, int]]]], sequences: int, bound: int) -> Plan:
    rows, first = [], 0
    for n, items in groups:
        at = 0
        for x, k in items:
            rows.append((x, n * k, k, first, at))
            at += x * k
        first += n
    length, n, copies, sequence, offset = np.array(rows, np.int64).reshape(-1, 5).T
    order = np.argsort(length, kind="stable")
    length, n = length[order], n[order]
    ends = np.cumsum(n)
    new = np.r_[True, length[1:] != length[:-1]] if len(length) else np.zeros(0, bool)
    begins = ends - n
    rank = begins - np.repeat(begins[new], np.diff(np.r_[np.flatnonzero(new), len(length)])) if len(length) else begins
    return Plan(groups, sequences, bound, length, rank, copies[order], sequence[order], offset[order])


def place(pieces: DataFrame, plan: Plan, most: int, capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset.  most: how many pieces the commonest length has.

    Pieces of one length are numbered in salted groups of about GROUP, so a length that a third of all pieces have is
    spread, copies of one document included (a piece's place in its file is in the salt); the numbers of a group follow
    those of the groups before it.  Full pieces need no number: each is a sequence by itself, below zero.
    """
    spark = pieces.sparkSession
    salts = max(1, -(-most // GROUP))
    row = [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
    named = pieces.select("*", row[0].alias("file"), row[1].alias("row"))
    full = named.where(F.col("length") == capacity).withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}).drop("file", "row") if plan.groups and plan.groups[0][1] == [(capacity, 1)] else None
    rest = named.where(F.col("length") != capacity) if full is not None else named
    p = rest.withColumn("salt", F.pmod(F.xxhash64("file", "row"), F.lit(salts)))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32", "file", "row")
    numbered = p.withColumn("within", F.row_number().over(own) - 1)
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = p.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")).select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))  # at most capacity * salts rows
    ranked = numbered.join(groups, ["length", "salt"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("within") + F.col("ahead")).cast("long").alias("rank"))
    wide = most + 1
    table = spark.sparkContext.broadcast((plan.length * wide + plan.rank, plan.rank, plan.copies, plan.sequence, plan.offset))  # runs, not pieces

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rank, copies, sequence, offset = table.value
        for b in batches:
            length, r = b.column(3).to_numpy(), b.column(5).to_numpy()
            k = np.searchsorted(key, length * wide + r, "right") - 1
            i = r - rank[k]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence[k] + i // copies[k]), pa.array(offset[k] + i % copies[k] * length)], [*b.schema.names[:5], "sequence_id", "offset"])

    placed = ranked.mapInArrow(run, PIECES + ", sequence_id long, offset long")
    return placed.unionByName(full) if full is not None else placed


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Pack all documents; one row per piece with its place."""
    pieces = staged(token_pieces(docs, tokenizer, end_id, capacity), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity rows
    return place(pieces, solve(histogram, capacity), max((n for x, n in histogram.items() if x != capacity), default=0), capacity)
