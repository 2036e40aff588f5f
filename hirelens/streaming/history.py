"""History as a stream of batches, and event windows (the windows are an extension).

A history folder holds postings in buckets by a hash of their URL, and versions: small files that name, for each bucket,
the folder with its rows.  A batch rewrites only the buckets its URLs fall in and then puts down the next version, so a
reader sees a whole version or the one before.  A version is named for its number, the stream (from its checkpoint) and
the batch: a batch that runs again finds its version and does nothing, and a new checkpoint goes on from the newest one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import KEEP_DAYS, merged, parsed
from ..schema import COLUMNS, LAST, ORD, POSTING_SCHEMA, URL

BUCKETS = 64


def _fs(spark: SparkSession, folder: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, f"{folder}/versions")
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().startswith("v-")) if fs.exists(p) else []


def _manifest(spark: SparkSession, folder: str) -> dict:
    names = _versions(spark, folder)
    return json.loads("\n".join(r["value"] for r in spark.read.text(f"{folder}/versions/{names[-1]}").collect())) if names else {"today": None, "buckets": {}}


def bucket(count: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(URL), F.lit(count)).cast("int")


def _rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.schema(POSTING_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], POSTING_SCHEMA)


def current(spark: SparkSession, folder: str) -> DataFrame:
    """The newest whole version.  Rows that expired since their bucket was last written are left out."""
    m = _manifest(spark, folder)
    rows = _rows(spark, list(m["buckets"].values()))
    return rows if m["today"] is None else rows.where(~F.coalesce(parsed(F.col(LAST)) < F.date_sub(parsed(F.lit(m["today"])), KEEP_DAYS), F.lit(False)))


def upsert_batch(spark: SparkSession, folder: str, fresh: DataFrame, today: str, stream: str, batch: int) -> None:
    """Writes the buckets that a batch touches beside the old ones, then the next version."""
    names, mark = _versions(spark, folder), f"-{stream}-{batch:012d}"
    if any(n.endswith(mark) for n in names):
        return
    m = _manifest(spark, folder)
    fresh = fresh.where(F.col(URL) != "")
    touched = sorted(r[0] for r in fresh.select(bucket()).distinct().collect())  # at most BUCKETS
    old = _rows(spark, [m["buckets"][str(k)] for k in touched if str(k) in m["buckets"]])
    data = f"{folder}/data/{uuid.uuid4().hex}"
    merged(old, fresh, today).withColumn("bucket", bucket()).repartition(max(1, len(touched)), "bucket").write.partitionBy("bucket").parquet(data)
    fs, p = _fs(spark, data)
    written = {s.getPath().getName().split("=", 1)[1]: s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().startswith("bucket=")}
    buckets = {k: v for k, v in m["buckets"].items() if int(k) not in touched} | written
    number = int(names[-1].split("-")[1]) + 1 if names else 0
    _, tmp = _fs(spark, f"{folder}/versions/_{uuid.uuid4().hex}")
    _, to = _fs(spark, f"{folder}/versions/v-{number:012d}{mark}")
    out = fs.create(tmp, True)
    out.write(bytearray(json.dumps({"today": today, "buckets": buckets}).encode()))
    out.close()
    if not fs.rename(tmp, to):
        raise OSError(f"could not put down version {to.toString()}")


def stream_history(postings: DataFrame, folder: str, checkpoint: str, today: str) -> StreamingQuery:
    """postings: a streaming frame of the 14 columns and the order."""
    spark = postings.sparkSession

    def write(df: DataFrame, batch: int) -> None:
        stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]  # a checkpoint keeps its id
        upsert_batch(spark, folder, df, today, stream, batch)

    return postings.select(*COLUMNS, ORD).writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()


def tumbling(events: DataFrame, width: str = "1 hour", late: str | None = None) -> DataFrame:
    """Counts and sums by type and window; with a watermark on a stream."""
    e = events.withWatermark("ts", late) if late else events
    return e.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str | None = None) -> DataFrame:
    e = events.withWatermark("ts", late) if late else events
    return e.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), "n")
