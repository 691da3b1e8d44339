"""A corpus pipeline: documents pass five stages, each written as Parquet and read by the next.

Each stage works on every document that the one before kept. The first four drop documents and keep the columns of `documents`; the last
gives each document that is left its tokens. A stage keeps rows that have a null id, as it keeps others, by their text alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import bpe, dartminhash, decontaminate, quality, toxicity
from tallyforge.llm.shared import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dartminhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token_ids and their digests; the digest of the decoded text is of what token_ids say."""
    path = bpe.default_path()
    return docs.select("doc_id", bpe.encoded(F.col("text"), path).alias("d")).select("doc_id", "d.*")


STAGES = [("toxicity", drop_toxic), ("quality classifier", drop_poor), ("MinHash near-dedup", drop_near_duplicates), ("benchmark decontamination", drop_contaminated), ("BPE encoding and decoding", encode)]

#: The learned stages and the tokens can't be told in SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage{i}")
    return docs
