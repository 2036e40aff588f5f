"""The queries of this folder: one per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, langid, matroska, ordinal, packing, simhash, token_store, toxicity, voronoi, wfst


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def grades(labels: DataFrame) -> DataFrame:
    """Graded ratings from the two marks: 0 low quality, 1 fair but toxic, 2 fair and clean."""
    quality, toxic = F.coalesce(F.col("quality"), F.lit(0)), F.coalesce(F.col("toxic"), F.lit(0))
    return labels.select("doc_id", F.when(quality < 1, 0).when(toxic > 0, 1).otherwise(2).alias("grade"))


def op1_voronoi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_sentencepiece_wfst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wfst.encode(_table(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"))


def op3_chat_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(_table(spark, sf_dir, "conversations"))


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_documents(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op5_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_quality_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal.rate(_table(spark, sf_dir, "documents"), grades(_table(spark, sf_dir, "labels")), [0, 1, 2])


def op7_language_hd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op8_toxicity_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_packing_lp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op10_media_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matroska.media_features(_table(spark, sf_dir, "documents"))


def media_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packet table of every document's media, summed up by document."""
    packets = matroska.packet_table(matroska.store_media(_table(spark, sf_dir, "documents")))
    size = F.col("byte_end") - F.col("byte_start")
    return packets.groupBy("doc_id").agg(F.count(F.lit(1)).alias("packets"), F.countDistinct("track").alias("tracks"), F.max("time_ns").alias("last_ns"), F.sum(size).alias("bytes"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_voronoi_topk, op2_sentencepiece_wfst, op3_chat_collapse, op4_token_store, op5_simhash_gray, op6_quality_ordinal, op7_language_hd, op8_toxicity_bigru, op9_packing_lp, op10_media_matroska, media_packets)}

ORACLES: dict[str, str] = {
    "op1_voronoi_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.e, d.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op3_chat_collapse": chat.ORACLE,
    "media_packets": """
WITH p AS (SELECT doc_id, CAST(greatest(1, ceil(strlen(coalesce(text, '')) / 192.0)) AS BIGINT) AS n FROM documents)
SELECT doc_id, CAST(sum(n) AS BIGINT) AS packets, CAST(1 AS BIGINT) AS tracks, max(n - 1) * 24000000 AS last_ns, CAST(sum(n) * 192 AS BIGINT) AS bytes FROM p GROUP BY doc_id
""",
}
