"""A training-corpus pipeline of four stages over `documents`.

toxicity    drops documents that the recurrent network scores 0.5 or more
language    drops documents without letters, or whose best cosine is under what held-out texts of that language and of as
            many distinct trigrams reach, or under LEAST_COSINE
near-dedup  keeps the smallest doc_id of each SimHash component
packing     places the pieces of every document left in sequences of 4096 tokens

Each stage reads all its predecessor kept; between stages rows are written as Parquet and read again.

A null or empty text, or one without letters, passes toxicity by its score and goes at language.  Rows without a doc_id
are scored and compared like others; repeated rows are copies, of which near-dedup keeps one.  Ties in near-dedup go to
the smallest doc_id.  Texts are read whole at any length.  Further columns pass all stages but the last untouched,
whatever their names; an empty table gives an empty one.  With no labels of a kind no model is learned: no text is toxic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelens.llm import langid, packing, simhash, toxicity
from hirelens.llm.runtime import staged

#: The least gate, for texts of few trigrams; longer ones face a gate set from held-out texts (langid.calibrate).
LEAST_COSINE = 0.05


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs, LEAST_COSINE)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", remove_toxic), ("language_id", keep_languages), ("simhash_near_dedup", remove_near_duplicates), ("best_fit_packing", pack)]

#: Trained models and tokenizers have no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, name)
    return docs
