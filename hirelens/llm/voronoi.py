"""Exact top-k inner-product search as a Voronoi join.

Components become integers floor(256 x).  A bounded sample of vectors serves as pivots; every vector belongs to the
cell of its nearest pivot, with its distance from it.  One row a cell summarises the data: the distances of the
k + 1 vectors nearest the pivot.  Queries of one cell have a radius u about its pivot p, so for any vector s near pivot o

    q.s >= p.o - u|o| - (|p| + u)|s - o|        q.s <= min(p.s + u|s|,  p.o + u|o| + (|p| + u)|s - o|)

The summaries' lower bounds give a score that the k-th best of each query of the cell reaches; a vector is
replicated only to groups of cells in which its upper bound reaches that score of some cell.  Each (group, salt, block) is
solved on its own by matrix products, and the partial results are ranked.  A block holds about GROUP queries, so a
cell with a third of them is split; salts split a group's data.

Exactness: scores are integers, products run in a float type that holds them exactly, or in int64.

Edge cases: vectors that are null, empty or hold null or non-finite components, and rows without vec_id, take no part;
shorter vectors count as padded with zeros; a query meets every row but its own (rows that repeat its vec_id
are candidates); fewer than k candidates give as many results; ties go to the smaller vec_id; an empty table gives no
rows; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import staged

PIVOTS, GROUP, CHUNK = 64, 4096, 100_000
#: Room for rounding in the bounds, as a share of their size.
SLACK = 1e-9


def _integers(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 33
        for b in batches:
            ids, column = b.column(0), b.column(1)
            lists = column.cast(pa.list_(pa.float64()))
            width = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
            values = lists.flatten().to_numpy(zero_copy_only=False)  # null components come as NaN
            finite = np.r_[0, np.cumsum(~np.isfinite(values))]
            ends = np.cumsum(width)
            good = (width > 0) & (finite[ends] == finite[ends - width]) & ids.is_valid().to_numpy(zero_copy_only=False)
            whole = np.floor(np.where(np.isfinite(values), values, 0.0) * scale).astype("<i8")
            out = [whole[ends[k] - width[k] : ends[k]].tobytes() for k in np.flatnonzero(good)]
            n = len(out)
            largest = [int(np.abs(np.frombuffer(v, "<i8")).max()) for v in out]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(uid, uid + n)), ids.filter(pa.array(good)).cast(pa.int64()), pa.array(width[good].astype(np.int64)), pa.array(largest, pa.int64()), pa.array(out, pa.binary())], ["uid", "vec_id", "width", "largest", "v"])
            uid += n

    return run


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """uid, vec_id, width, largest (absolute component) and v (little-endian int64) of each row that takes part."""
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(_integers(scale), "uid long, vec_id long, width long, largest long, v binary")


def _matrix(blobs: list[bytes], width: int, dtype) -> np.ndarray:
    if all(len(b) == 8 * width for b in blobs):
        return np.frombuffer(b"".join(blobs), "<i8").reshape(-1, width).astype(dtype)
    out = np.zeros((len(blobs), width), dtype)
    for k, b in enumerate(blobs):
        out[k, : len(b) // 8] = np.frombuffer(b, "<i8")
    return out


def _cells(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest pivot, distance from it) of float64 rows."""
    d = ((pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T).argmin(1)
    return d, np.linalg.norm(x - pivots[d], axis=1)


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of each row that the Column is_query (over vec_id) selects."""
    spark = vectors.sparkSession
    out = "query_id long, rank int, vec_id long, score long"
    whole = staged(integer_vectors(vectors, scale), "vectors")
    facts = whole.agg(F.count(F.lit(1)).alias("n"), F.max("width").alias("width"), F.max("largest").alias("largest"), F.count(F.when(is_query, 1)).alias("queries")).first()
    if not facts["queries"] or facts["n"] < 2:
        return spark.createDataFrame([], out)
    width, most = facts["width"], facts["width"] * facts["largest"] ** 2
    exact = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    chosen = whole.select("v", "uid").orderBy(F.xxhash64("v"), "uid").limit(pivots).collect()  # at most `pivots` rows
    centre = np.unique(_matrix([bytes(r["v"]) for r in chosen], width, np.float64), axis=0)
    cells = len(centre)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cell, far = _cells(_matrix(b.column(2).to_pylist(), width, np.float64), centre)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(far)], ["uid", "vec_id", "v", "is_query", "cell", "far"])

    placed = staged(whole.select("uid", "vec_id", "v", is_query.alias("is_query")).mapInArrow(assign, "uid long, vec_id long, v binary, is_query boolean, cell long, far double"), "cells")

    # Summaries: a row a cell.
    nearest = Window.partitionBy("cell", "salt").orderBy("far")
    few = placed.select("cell", "far", F.pmod("uid", F.lit(64)).alias("salt")).withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= k + 1)
    near = {r["cell"]: sorted(r["d"])[: k + 1] for r in few.groupBy("cell").agg(F.collect_list("far").alias("d")).collect()}  # cells * 64 * (k + 1) numbers
    asked = {r["cell"]: (r["n"], r["u"]) for r in placed.where("is_query").groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("u")).collect()}

    norm = np.linalg.norm(centre, axis=1)
    dots = centre @ centre.T
    radius = np.array([asked.get(c, (0, 0.0))[1] for c in range(cells)])
    least = np.full(cells, -np.inf)
    for c in asked:
        lower = sorted((dots[c, o] - radius[c] * norm[o] - (norm[c] + radius[c]) * d for o, ds in near.items() for d in ds), reverse=True)
        if len(lower) > k:  # one of them may be the query's own row
            least[c] = lower[k] - SLACK * (abs(lower[k]) + 1) - 1e-6

    # Cells go into groups near one another; a cell with more queries than a group holds is split into blocks.
    groups: list[list[int]] = []
    size: list[int] = []
    blocks = np.ones(cells, np.int64)
    todo = sorted(asked, key=lambda c: -asked[c][0])
    while todo:
        seed = todo.pop(0)
        n = asked[seed][0]
        blocks[seed] = -(-n // GROUP)
        own = [seed]
        for c in sorted(todo, key=lambda c: -dots[seed, c]):
            if n + asked[c][0] <= GROUP:
                own.append(c)
                n += asked[c][0]
                todo.remove(c)
        groups.append(own)
        size.append(n)
    group_of = np.zeros(cells, np.int64)
    for g, own in enumerate(groups):
        group_of[own] = g
    # A task's data: at most about CHUNK vectors, and enough tasks for all cores.
    salts = max(math.ceil(facts["n"] / CHUNK), math.ceil(2 * spark.sparkContext.defaultParallelism / len(groups)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A vector goes once to each block of each group some cell of which may need it."""
        asking = np.array(sorted(asked))
        for b in batches:
            x, cell, far = _matrix(b.column(2).to_pylist(), width, np.float64), b.column(3).to_numpy(), b.column(4).to_numpy()
            length = np.linalg.norm(x, axis=1)
            one = x @ centre[asking].T + length[:, None] * radius[asking]
            two = dots[cell][:, asking] + norm[cell][:, None] * radius[asking] + far[:, None] * (norm[asking] + radius[asking])
            need = np.minimum(one, two) * (1 + SLACK * np.sign(np.minimum(one, two))) + 1e-6 >= least[asking]
            uid, vec, v = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2)
            for g in range(len(groups)):
                rows = np.flatnonzero(need[:, group_of[asking] == g].any(1))
                salt = uid[rows] % salts
                for s in np.unique(salt):
                    own = rows[salt == s]
                    rows_of = v.take(pa.array(own)).to_pylist() if all_equal else [x[own].astype("<i8").tobytes()]
                    held = [pa.array([y], pa.binary()) for y in (uid[own].astype("<i8").tobytes(), vec[own].astype("<i8").tobytes(), b"".join(rows_of))]
                    for block in range(int(blocks[groups[g][0]])):  # only a cell alone in its group is split
                        yield pa.RecordBatch.from_arrays([pa.array([g]), pa.array([int(s)]), pa.array([block]), *held], ["group", "salt", "block", "uids", "ids", "v"])

    all_equal = whole.where(F.col("width") != width).isEmpty()
    data = placed.select("uid", "vec_id", "v", "cell", "far").mapInArrow(deal, "group long, salt long, block long, uids binary, ids binary, v binary")
    of_cell = spark.createDataFrame([(c, int(group_of[c]), int(blocks[c])) for c in sorted(asked)], "cell long, group long, blocks long")  # a row a cell
    queries = (
        placed.where("is_query")
        .join(F.broadcast(of_cell), "cell")
        .select("uid", "vec_id", "v", "group", F.pmod(F.xxhash64("uid"), F.col("blocks")).alias("block"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    )

    def solve(key, left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"query_uid": pa.array([], pa.int64()), "query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "uid": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        if not left.num_rows or not right.num_rows:
            return empty
        uid = np.frombuffer(b"".join(left.column("uids").to_pylist()), "<i8")
        ids = np.frombuffer(b"".join(left.column("ids").to_pylist()), "<i8")
        x = np.frombuffer(b"".join(left.column("v").to_pylist()), "<i8").reshape(-1, width).astype(exact)
        order = np.lexsort((uid, ids))  # so that of equal scores the smaller id comes first
        uid, ids, x = uid[order], ids[order], x[order]
        q_uid, q_id = right.column("uid").to_numpy(), right.column("vec_id").to_numpy()
        q = _matrix(right.column("v").to_pylist(), width, exact)
        per = max(1, 8_000_000 // len(x))
        parts = []
        for at in range(0, len(q), per):
            score = (q[at : at + per] @ x.T).astype(np.float64 if exact is not np.int64 else np.int64)
            floor = -np.inf if exact is not np.int64 else np.iinfo(np.int64).min
            row = {int(u): j for j, u in enumerate(uid)} if at == 0 else row  # noqa: F821
            for i in range(len(score)):
                mine = row.get(int(q_uid[at + i]))
                s = score[i]
                if mine is not None:
                    s[mine] = floor
                left_over = len(s) - (mine is not None)
                n = min(k, left_over)
                if not n:
                    continue
                if len(s) > 4 * k:
                    bar = np.partition(s, len(s) - n)[len(s) - n]
                    near_top = np.flatnonzero(s >= bar)
                else:
                    near_top = np.arange(len(s))
                if mine is not None:
                    near_top = near_top[near_top != mine]
                best = near_top[np.lexsort((near_top, -s[near_top] if exact is not np.int64 else ~s[near_top]))][:n]
                parts.append((np.full(len(best), q_uid[at + i]), np.full(len(best), q_id[at + i]), ids[best], uid[best], s[best].astype(np.int64)))
        if not parts:
            return empty
        return pa.table(dict(zip(empty.schema.names, (pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)), strict=True)))

    partial = data.groupBy("group", "salt", "block").cogroup(queries.groupBy("group", "salt", "block")).applyInArrow(solve, "query_uid long, query_id long, vec_id long, uid long, score long")
    rank = Window.partitionBy("query_uid").orderBy(F.col("score").desc(), "vec_id", "uid")
    return partial.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
