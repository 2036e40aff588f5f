"""Shared plumbing of the training-data operators: durable stage tables, byte-bounded Arrow batches, hashing."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts handed to one vectorised step of a Python worker, in characters.
BATCH_CHARS = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share.  Where the session names none, one is made and set if this machine is all there
    is (a local master); on a cluster it is an error, since executors would each write to their own disk."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="hirelens-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/hirelens-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: the lineage ends there, whatever executors are lost later."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Remove the files behind a staged() frame that no later step reads."""
    spark = df.sparkSession
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def texts(docs: DataFrame) -> DataFrame:
    """The two columns operators on documents read; whatever else the table has cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def cut(batch: pa.RecordBatch, column: str = "text", most: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold at most `most` bytes together, or a single longer text."""
    lengths = pc.binary_length(batch.column(batch.schema.get_field_index(column))).to_pylist()
    begin = total = 0
    for i, n in enumerate(lengths):
        n = n or 0
        if total and total + n > most:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if begin < len(lengths):
        yield batch.slice(begin)


def by_batch(f: Callable[[pa.RecordBatch], pa.RecordBatch], column: str = "text", most: int = BATCH_CHARS):
    """A mapInArrow function that applies f to byte-bounded slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut(batch, column, most):
                if part.num_rows:
                    yield f(part)

    return run


def fold(column: str, parts: int):
    """crc32 of a key as text, modulo parts; null keys give null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(parts)


def labelled_sample(docs: DataFrame, labels: DataFrame, value, per_value: dict, parts: int, out: int, longest: int) -> list:
    """Rows (doc_id, text, value) to fit on: at most per_value[v] rows of each value v, none from the held-out fold.

    The sample is the rows of least xxhash64(doc_id) among the labels, so it is deterministic, bounded, and
    independent of the layout.  Texts over `longest` characters aren't fitted on (they are scored all the same).
    Several labels of one document: the greatest value holds.
    """
    graded = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), value.cast("int").alias("value"))
        .where(F.col("doc_id").isNotNull() & F.col("value").isNotNull() & (fold("doc_id", parts) != out))
        .groupBy("doc_id")
        .agg(F.max("value").alias("value"))
    )
    chosen = None
    for v, n in per_value.items():
        part = graded.where(F.col("value") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        chosen = part if chosen is None else chosen.unionByName(part)
    # A repeated doc_id counts once, by its smallest text, before anything reaches the driver.
    rows = (
        texts(docs)
        .join(F.broadcast(chosen), "doc_id")  # at most sum(per_value) rows
        .where(F.length("text") <= longest)
        .groupBy("doc_id", "value")
        .agg(F.min("text").alias("text"))
        .select("doc_id", "text", "value")
        .collect()
    )
    return sorted(rows, key=lambda r: r["doc_id"])
