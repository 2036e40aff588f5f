"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprint: ASCII lower case, words between ASCII white space, shingles of three words (a shorter text: its whole sequence),
XXH64 with seed 42 of each; a bit is 1 where over half of the shingles have it; no words give zero.

Index: distinct fingerprints in the order of their Gray rank, in which neighbours differ in few bits.  A node covers
FAN children in a row and holds the bits all of them share, less those its parent holds already.  A search adds up
the differing bits from the root down and leaves a whole group once they pass the limit; a group whose free
bits cannot take it past the limit is accepted as a whole.  The range-partitioned order is cut into parts; the
shared bits of the parts (one row a part on the driver) are nodes of the same kind, and a walk down them finds
the other parts that a fingerprint must visit.  A
fingerprint has at most 1 + 64 + 2016 others within two bits, so links of distinct fingerprints cannot grow with the square.

Components: each part reduces its links to a star for each local group, then large-star and small-star
rounds, each written to the shared folder, join the stars until no edge changes.

Edge cases: null and empty texts have no words; fingerprint zero links like any other; equal texts and repeated rows
share a fingerprint and a component; the smallest doc_id names a component, null ones are passed over (a
component of null ids alone has a null id); an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .runtime import cut, drop_staged, staged, texts

SEED, SHINGLE, LIMIT, FAN = 42, 3, 2, 16
#: Shingles counted in one step; searched fingerprints in one step; fingerprints in a part.
AT_ONCE, SEARCHED, PART = 500_000, 1024, 50_000


def fingerprint(text: str | None) -> int:
    """As an unsigned 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.r_[0, ends[:-1] + 1]
    n = len(words) - SHINGLE + 1
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, AT_ONCE):
        some = [digest(joined[a:b], SEED) for a, b in zip(begins[at : min(n, at + AT_ONCE)].tolist(), ends[at + SHINGLE - 1 : min(n, at + AT_ONCE) + SHINGLE - 1].tolist(), strict=True)]
        bits = np.unpackbits(np.array(some, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(total * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and code: the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut(batch):
                codes = np.fromiter((fingerprint(t) for t in part.column(1).to_pylist()), np.uint64, part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(codes.view(np.int64))], ["doc_id", "code"])

    return texts(docs).mapInArrow(run, "doc_id long, code long")


def gray_rank(column):
    """The place of a code in Gray order, as a long that sorts like the unsigned rank."""
    c = F.col(column)
    for shift in (1, 2, 4, 8, 16, 32):
        c = c.bitwiseXOR(F.shiftrightunsigned(c, shift))
    return c.bitwiseXOR(F.lit(-(1 << 63)))


class GrayIndex:
    """Codes (unsigned, distinct, in Gray order) under nodes of FAN children; levels[0] is the top."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # pattern, shared bits, codes per node
        both, either, span = codes, codes, 1
        masks = [np.full(len(codes), ~np.uint64(0))]
        patterns, spans = [codes], [1]
        while len(both) > FAN:
            cuts = np.arange(0, len(both), FAN)
            both, either, span = np.bitwise_and.reduceat(both, cuts), np.bitwise_or.reduceat(either, cuts), span * FAN
            masks.append(~(both ^ either))
            patterns.append(both)
            spans.append(span)
        for k in range(len(masks) - 1, -1, -1):
            own = masks[k]
            if k + 1 < len(masks):
                own = own & ~masks[k + 1][np.arange(len(own)) // FAN]
            free = 64 - np.bitwise_count(masks[k]).astype(np.int64)
            self.levels.append((patterns[k], own, free, spans[k]))

    def search(self, queries: np.ndarray, limit: int = LIMIT) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, first code, last code) of accepted groups, last included; single codes are groups of one."""
        for at in range(0, len(queries), SEARCHED):
            some = queries[at : at + SEARCHED]
            top = len(self.levels[0][0])
            q, node = np.repeat(np.arange(len(some)), top), np.tile(np.arange(top), len(some))
            so_far = np.zeros(len(q), np.uint8)
            for depth, (pattern, own, free, span) in enumerate(self.levels):
                so_far = so_far + np.bitwise_count((some[q] ^ pattern[node]) & own[node])
                alive = so_far <= limit
                q, node, so_far = q[alive], node[alive], so_far[alive]
                whole = so_far + free[node] <= limit
                if whole.any():
                    yield q[whole] + at, node[whole] * span, np.minimum((node[whole] + 1) * span, len(self.codes)) - 1
                if depth + 1 == len(self.levels):
                    break
                q, node, so_far = q[~whole], node[~whole], so_far[~whole]
                q, so_far = np.repeat(q, FAN), np.repeat(so_far, FAN)
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                there = node < len(self.levels[depth + 1][0])
                q, node, so_far = q[there], node[there], so_far[there]


def stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node it reaches over the edges (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = np.minimum(new, new[label])
        while True:
            jump = new[new]
            if (jump == new).all():
                break
            new = jump
        if (new == label).all():
            break
        label = new
    return label


def _local(table: pa.Table) -> pa.Table:
    """Links of one part, as edges from each linked code to the smallest (signed) code it reaches here."""
    own = table.column("own").to_numpy(zero_copy_only=False)
    code = table.column("code").to_numpy().view(np.uint64)
    rank = table.column("rank").to_numpy()
    data = code[own][np.argsort(rank[own])]
    visitors = np.unique(code[~own])
    edges_a, edges_b = [], []
    if len(data):
        index = GrayIndex(data)
        for queries, base in ((data, 0), (visitors, len(data))):
            for q, lo, hi in index.search(queries):
                q = q + base
                edges_a.append(q)
                edges_b.append(lo)
                wide = np.flatnonzero(hi > lo)
                for k in wide[np.unique(np.stack([lo[wide], hi[wide]]), axis=1, return_index=True)[1]] if len(wide) else ():
                    edges_a.append(np.arange(lo[k], hi[k]))
                    edges_b.append(np.arange(lo[k] + 1, hi[k] + 1))
    every = np.r_[data, visitors].view(np.int64)
    order = np.argsort(every, kind="stable")  # so that the smallest node is the smallest code
    place = np.empty(len(every), np.int64)
    place[order] = np.arange(len(every))
    a = place[np.concatenate(edges_a)] if edges_a else np.zeros(0, np.int64)
    b = place[np.concatenate(edges_b)] if edges_b else np.zeros(0, np.int64)
    label = stars(len(every), a, b)
    linked = np.flatnonzero(label != np.arange(len(every)))
    names = every[order]
    return pa.table({"u": names[linked], "v": names[label[linked]]})


def part_tree(both: np.ndarray, either: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Nodes over the parts, from the top: (pattern, shared bits, parts a node spans) of each level."""
    levels, span = [(both, ~(both ^ either), 1)], 1
    while len(both) > 1:
        cuts = np.arange(0, len(both), FAN)
        both, either, span = np.bitwise_and.reduceat(both, cuts), np.bitwise_or.reduceat(either, cuts), span * FAN
        levels.append((both, ~(both ^ either), span))
    return levels[::-1]


def later_parts(tree: list[tuple[np.ndarray, np.ndarray, int]], code: np.ndarray, part: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, part) for parts after a code's own in which a link may be: a walk down the nodes whose shared bits allow one."""
    row, node = np.arange(len(code)), np.zeros(len(code), np.int64)
    for depth, (pattern, shared, span) in enumerate(tree):
        alive = (np.bitwise_count((code[row] ^ pattern[node]) & shared[node]) <= limit) & ((node + 1) * span - 1 > part[row])
        row, node = row[alive], node[alive]
        if depth + 1 < len(tree):
            row, node = np.repeat(row, FAN), (node[:, None] * FAN + np.arange(FAN)).ravel()
            there = node < len(tree[depth + 1][0])
            row, node = row[there], node[there]
    return row, node


def links(codes: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Edges (u > v) over distinct codes that connect what links within `limit` bits connect.  codes: column code."""
    ranked = codes.select("code", gray_rank("code").alias("rank"))
    n = ranked.count()
    parts = max(1, -(-n // PART))  # more parts share fewer bits, so more of them are visited by each code
    placed = staged(ranked.repartitionByRange(parts, "rank").select("code", "rank", F.spark_partition_id().alias("part")), "gray")
    roots = placed.groupBy("part").agg(F.bit_and("code").alias("both"), F.bit_or("code").alias("either")).orderBy("part").collect()  # a row a part
    number = np.array([r["part"] for r in roots], np.int64)
    tree = part_tree(np.array([r["both"] for r in roots], np.int64).view(np.uint64), np.array([r["either"] for r in roots], np.int64).view(np.uint64))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A code goes to its own part, and to later parts whose shared bits allow a link; so each pair meets once."""
        for whole in batches:
            for i in range(0, whole.num_rows, SEARCHED):
                b = whole.slice(i, SEARCHED)
                code, rank, part = b.column(0).to_numpy(), b.column(1).to_numpy(), np.searchsorted(number, b.column(2).to_numpy())
                row, to = later_parts(tree, code.view(np.uint64), part, limit)
                row, to = np.r_[np.arange(len(code)), row], np.r_[part, to]
                yield pa.RecordBatch.from_arrays([pa.array(number[to]), pa.array(code[row]), pa.array(rank[row]), pa.array(to == part[row])], ["target", "code", "rank", "own"])

    return placed.mapInArrow(visit, "target long, code long, rank long, own boolean").groupBy("target").applyInArrow(_local, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(u, v): each node u that is not its component's smallest, and that smallest node v, by large-star and small-star rounds."""

    def mark(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(r)

    e = staged(edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = mark(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u != v").distinct()
        before, e, old = e, staged(small, "edges"), state
        drop_staged(before)  # nothing reads it any more
        state = mark(e)
        if state == old:
            break
    return e


def _rooted(docs: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id and code of every row, root and smallest doc_id of the component of every code)."""
    marked = staged(fingerprints(docs), "simhash")
    codes = staged(marked.groupBy("code").agg(F.min("doc_id").alias("least")), "codes")
    joined = components(links(codes.select("code"), limit))
    root = codes.join(joined.withColumnRenamed("u", "code"), "code", "left").select("code", "least", F.coalesce("v", "code").alias("root"))
    named = root.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked, root.join(named, "root").select("code", "root", "component_id")


def near_duplicates(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id of every row."""
    marked, table = _rooted(docs, limit)
    return marked.join(table, "code").select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row of docs, all columns, for each component: the one of the smallest doc_id, or if it has none any one.

    A doc_id names a row where it occurs once.  Where it repeats or is null, doc_id and fingerprint name the row, and of rows
    alike in both one stays.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])  # so that nothing below can clash
    own_id, text = F.col(f"c{names.index('doc_id')}").cast("long"), f"c{names.index('text')}"
    marked, table = _rooted(docs, limit)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "code")).alias("first")
    kept = staged(marked.join(table, "code").groupBy("root").agg(first).select("first.doc_id", "first.code"), "kept")
    repeated = staged(marked.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id"), "repeated")
    out = plain.join(kept.join(repeated, "doc_id", "left_anti").select("doc_id"), own_id == F.col("doc_id"), "left_semi")
    nameless = kept.join(repeated, "doc_id", "left_semi").unionByName(kept.where(F.col("doc_id").isNull()))
    if nameless.isEmpty():
        return out.toDF(*names)
    place = plain.columns.index(text)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = np.fromiter((fingerprint(t) for t in b.column(place).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(codes.view(np.int64))], [*b.schema.names, "own_code"])

    unclear = plain.join(repeated, own_id == F.col("doc_id"), "left_semi").unionByName(plain.where(own_id.isNull()))
    coded = unclear.mapInArrow(mark, StructType([*plain.schema.fields, StructField("own_code", LongType())]))
    hit = coded.join(nameless, own_id.eqNullSafe(F.col("doc_id")) & (F.col("own_code") == F.col("code")), "left_semi").withColumn("own_id", own_id)
    whole, order = F.struct(*plain.columns), F.xxhash64(*[c for c, t in plain.dtypes if not t.startswith("map")])
    chosen = hit.groupBy("own_id", "own_code").agg(F.min_by(whole, order).alias("row")).select("row.*")  # partial: many rows alike are no hot group
    return out.unionByName(chosen).toDF(*names)
