"""Token-ID output as a content-addressed store.

Ids are written as little-endian unsigned integers.  A rolling hash over the last WINDOW ids cuts each document's
stream where its low bits are zero, so equal passages give equal chunks wherever they stand.  A chunk's address is
the BLAKE2b-128 digest of its bytes; each address is stored once (`chunks`).  `documents` holds the recipes in
ascending doc_id order: the addresses and lengths of a document's chunks and the Merkle root over them.

Reading verifies every chunk against its address and every recipe against its root, and gives each document's
place in the stream and the CRC of its ids.  No document is put together in one place for that: CRC-32 is linear
over GF(2), so each chunk's CRC is multiplied by x^(8 * bytes after it) and the products are added (bit_xor).

Edge cases: null text encodes as empty, so the document holds the end id alone; null doc_id sorts first; repeated
rows are kept, each with its own recipe; an empty table gives an empty store and result; further columns are not
read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .runtime import cut, new_path, texts
from .subwords import encoder

WINDOW = 8
#: Bytes of text encoded in one step.
TEXT = 4_000_000
#: Chunk sizes in ids; the mean is about LEAST + 2**BITS.
LEAST, MOST, BITS = 128, 4096, 9

RAW = "kind string, address binary, uid long, doc_id long, n_ids long, body binary, lengths binary"
RAW_ARROW = pa.schema([("kind", pa.string()), ("address", pa.binary()), ("uid", pa.int64()), ("doc_id", pa.int64()), ("n_ids", pa.int64()), ("body", pa.binary()), ("lengths", pa.binary())])


def marks(ids: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places after which the rolling hash allows a cut.  It looks back WINDOW ids, less than LEAST, so the marks that
    count within a document don't depend on what stands before it."""
    mixed = ids.astype(np.uint32) * np.uint32(0x9E3779B1)
    mixed ^= mixed >> np.uint32(15)
    rolling = mixed.copy()
    for j in range(1, WINDOW):
        rolling[j:] += mixed[:-j] << np.uint32(2 * j)
    return np.flatnonzero((rolling * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits) == 0) + 1


def ends_of(found: list[int], n: int, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks of a stream of n ids with these marks; the last is n."""
    ends, last = [], 0
    for p in found:
        while p - last > most:
            last += most
            ends.append(last)
        if p - last >= least:
            last = p
            ends.append(last)
    while n - last > most:
        last += most
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def cut_points(ids: np.ndarray) -> list[int]:
    return ends_of(marks(ids).tolist(), len(ids))


def address(body: bytes) -> bytes:
    return hashlib.blake2b(body, digest_size=16).digest()


def merkle_root(addresses: list[bytes]) -> bytes:
    """Root of the binary hash tree over the addresses; an odd last node moves up unchanged."""
    level = addresses
    while len(level) > 1:
        pairs = [hashlib.blake2b(b"\x01" + level[i] + level[i + 1], digest_size=16).digest() for i in range(0, len(level) - 1, 2)]
        level = pairs + level[len(level) - len(level) % 2 :]
    return level[0] if level else b""


def _encode(path: str, keeps_space: bool, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, keeps_space)
        uid = TaskContext.get().partitionId() << 33
        end = np.array([end_id], enc.dtype).tobytes()
        width = enc.dtype.itemsize
        for batch in batches:
            for part in cut(batch, most=TEXT):
                rows: list[tuple] = []
                given: set[bytes] = set()  # Spark's own map-side step drops the rest of a task's repeats
                bodies = enc.encode_all([t or "" for t in part.column(1).to_pylist()])
                data = b"".join([body + end for body in bodies])
                sizes = np.fromiter((len(body) // width + 1 for body in bodies), np.int64, len(bodies))
                found = marks(np.frombuffer(data, enc.dtype))
                stops = np.cumsum(sizes)
                between = np.searchsorted(found, np.r_[0, stops], "right")
                for k, (doc_id, n, start) in enumerate(zip(part.column(0).to_pylist(), sizes.tolist(), (stops - sizes).tolist(), strict=True)):
                    ends = ends_of((found[between[k] : between[k + 1]] - start).tolist(), n) if n > LEAST else [n]
                    addresses, lengths, begin = [], [], 0
                    for e in ends:
                        piece = data[(start + begin) * width : (start + e) * width]
                        addresses.append(a := address(piece))
                        lengths.append(e - begin)
                        if a not in given:
                            given.add(a)
                            rows.append(("chunk", a, None, None, e - begin, piece, None))
                        begin = e
                    rows.append(("recipe", uid.to_bytes(8, "big") + merkle_root(addresses), uid, doc_id, n, b"".join(addresses), struct.pack(f"<{len(lengths)}I", *lengths)))
                    uid += 1
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), RAW_ARROW, strict=True)], schema=RAW_ARROW)

    return run


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, keeps_space: bool = True) -> None:
    """Encode docs once and write the store under `path`: chunks, documents and a stream manifest."""
    spark = docs.sparkSession
    raw = texts(docs).mapInArrow(_encode(tokenizer, keeps_space, end_id), RAW)
    # An address is unique to its bytes, and a recipe's to its row: the sort before the shuffle drops a task's repeats.
    once = raw.groupBy("kind", "address").agg(*[F.first(c).alias(c) for c in ("uid", "doc_id", "n_ids", "body", "lengths")])
    once.write.partitionBy("kind").option("compression", "zstd").parquet(f"{path}/raw")
    recipes = read_part(spark, path, "recipe")
    (
        recipes.repartitionByRange(F.col("doc_id").asc_nulls_first(), "uid")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "uid")
        .select(F.spark_partition_id().alias("part"), "doc_id", "uid", F.col("n_ids").alias("n_tokens"), F.substring("address", 9, 16).alias("root"), F.col("body").alias("addresses"), "lengths")
        .write.option("compression", "zstd")
        .parquet(f"{path}/documents")
    )


STORED = "address binary, uid long, doc_id long, n_ids long, body binary, lengths binary"
MANIFEST = "part int, doc_id long, uid long, n_tokens long, root binary, addresses binary, lengths binary"


def read_part(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(STORED + ", kind string").parquet(f"{path}/raw").where(F.col("kind") == kind).drop("kind")


# CRC-32 as polynomials over GF(2), reflected: bit 31 holds x^0.
_POLY = np.uint32(0xEDB88320)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of a and b modulo the CRC polynomial, element by element."""
    a, b, out = a.astype(np.uint32), b.astype(np.uint32), np.zeros(len(a), np.uint32)
    for bit in range(31, -1, -1):
        out ^= b * ((a >> np.uint32(bit)) & np.uint32(1))
        b = (b >> np.uint32(1)) ^ (_POLY * (b & np.uint32(1)))
    return out


def _squares() -> np.ndarray:
    """x^(8 * 2^k) for k = 0 .. 47."""
    x = np.array([1 << 30], np.uint32)  # x^1
    for _ in range(3):
        x = times(x, x)
    out = []
    for _ in range(48):
        out.append(x[0])
        x = times(x, x)
    return np.array(out, np.uint32)


def power(n_bytes: np.ndarray) -> np.ndarray:
    """x^(8 n) modulo the CRC polynomial."""
    n, out, k = n_bytes.astype(np.int64), np.full(len(n_bytes), 1 << 31, np.uint32), 0
    squares = _squares()
    while (n >> k).any():
        odd = np.flatnonzero((n >> k) & 1)
        out[odd] = times(out[odd], np.full(len(odd), squares[k]))
        k += 1
    return out


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(address, n_ids, crc of the ids as 32-bit integers) of each stored chunk, after a check of its address."""
    for batch in batches:
        crcs = []
        for a, n, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if address(body) != a:
                raise ValueError(f"stored chunk {a.hex()} does not match its address")
            crcs.append(zlib.crc32(np.frombuffer(body, f"<u{len(body) // n}").astype("<u4").tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(crcs, pa.int64())], ["address", "n_ids", "crc"])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each chunk of each recipe: uid, address, n_ids and the bytes that follow it in the document."""
    for whole in batches:
        for batch in cut(whole, "addresses"):
            uid, address_of, n, after = [], [], [], []
            for u, root, joined, lengths in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                own = [joined[i : i + 16] for i in range(0, len(joined), 16)]
                if merkle_root(own) != root:
                    raise ValueError(f"recipe {u} does not match its Merkle root")
                sizes = np.frombuffer(lengths, "<u4").astype(np.int64)
                uid.append(np.full(len(own), u, np.int64))
                address_of += own
                n.append(sizes)
                after.append(4 * (sizes.sum() - np.cumsum(sizes)))
            if uid:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(uid)), pa.array(address_of, pa.binary()), pa.array(np.concatenate(n)), pa.array(np.concatenate(after))], ["uid", "address", "n_ids", "after"])


def _shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        crc = times(power(b.column(1).to_numpy()), b.column(2).to_numpy().astype(np.uint32)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(crc), b.column(3)], ["uid", "crc", "n_ids"])


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Per document from the stored files alone: doc_id, start, n_tokens, ids_crc32, n_chunks, root."""
    chunks = read_part(spark, path, "chunk").select("address", "n_ids", "body").mapInArrow(_checked, "address binary, n_ids long, crc long")
    recipes = spark.read.schema(MANIFEST).parquet(f"{path}/documents")
    entries = recipes.select("uid", "root", "addresses", "lengths").mapInArrow(_entries, "uid long, address binary, n_ids long, after long")
    # A passage that many documents share repeats its address on the side of the entries only: AQE can split that.
    joined = entries.join(chunks.select("address", F.col("n_ids").alias("stored"), "crc"), "address", "left")
    whole = (
        joined.select("uid", "after", F.when(F.col("stored") == F.col("n_ids"), F.col("crc")).otherwise(F.raise_error(F.lit("a chunk of a recipe is missing"))).cast("long").alias("crc"), "n_ids")
        .mapInArrow(_shifted, "uid long, crc long, n_ids long")
        .groupBy("uid")
        .agg(F.bit_xor("crc").alias("ids_crc32"), F.sum("n_ids").alias("read_ids"), F.count(F.lit(1)).alias("n_chunks"))
    )
    # The stream's order: one number for each written part, then places within the part.
    totals = sorted((r["part"], r["n"]) for r in recipes.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    before, offsets = 0, []
    for part, n in totals:
        offsets.append((part, before))
        before += n
    base = spark.createDataFrame(offsets, "part int, base long")  # one row for each file part
    order = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "uid").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        recipes.select("part", "doc_id", "uid", "n_tokens", "root")
        .withColumn("ahead", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
        .join(F.broadcast(base), "part")
        .select("uid", "doc_id", (F.col("base") + F.col("ahead")).alias("start"), "n_tokens", "root")
    )
    return (
        placed.join(whole, "uid", "left")
        .withColumn("n_tokens", F.when(F.col("read_ids") == F.col("n_tokens"), F.col("n_tokens")).otherwise(F.raise_error(F.lit("a document's chunks are missing")).cast("long")))
        .select("doc_id", "start", "n_tokens", "ids_crc32", "n_chunks", F.lower(F.hex("root")).alias("merkle_root"))
    )


def read_ids(spark: SparkSession, path: str, doc_ids: list[int]) -> dict[int, list[int]]:
    """The ids of a few named documents, put together from their recipes (for spot reads and tests)."""
    out: dict[int, list[int]] = {}
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/documents").where(F.col("doc_id").isin(doc_ids)).collect()
    need = {r["addresses"][i : i + 16] for r in rows for i in range(0, len(r["addresses"]), 16)}
    wanted = spark.createDataFrame([(bytearray(a),) for a in need], "address binary")
    got = {bytes(r["address"]): (r["n_ids"], bytes(r["body"])) for r in read_part(spark, path, "chunk").join(F.broadcast(wanted), "address").collect()}
    for r in rows:
        a = bytes(r["addresses"])
        out[r["doc_id"]] = [int(x) for i in range(0, len(a), 16) for n, body in [got[a[i : i + 16]]] for x in np.frombuffer(body, f"<u{len(body) // n}")]
    return out


def store_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Write the store (by default in the session's shared folder) and return what it reads back."""
    path = path or new_path(docs.sparkSession, "tokens")
    write_store(docs, path, tokenizer, end_id)
    return read_store(docs.sparkSession, path)
