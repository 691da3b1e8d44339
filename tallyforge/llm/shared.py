"""What the operators of this subpackage share: tables, the shared folder, words, folds, samples."""

from __future__ import annotations

import ctypes
import functools
import glob
import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a text to bytes of its words: A-Z become a-z, what is not of a word becomes a space. UTF-8 bytes from 0x80 belong to
#: words, so the words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of a text are those of its bytes.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(raw: bytes | None) -> list[bytes]:
    """The lower-cased words of a UTF-8 text; none of null."""
    return raw.translate(WORD_BYTES).split() if raw else []


def in_parts(texts: list[list[bytes]], most: int):
    """Stretches [a, b) of the texts with about `most` words each."""
    a, n = 0, 0
    for b, t in enumerate(texts):
        if n and n + len(t) > most:
            yield a, b
            a, n = b, 0
        n += len(t)
    if a < len(texts):
        yield a, len(texts)


def slices(batch: pa.RecordBatch, column: int, rows: int = 500, size: int = 4_000_000):
    """A batch in parts of at most so many rows, and so many bytes of text if a row alone has no more: what a task makes of them (lists of words
    take some ten times the text) is in memory for one part at a time."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.binary())), 0).to_pylist()
    a = n = 0
    for b, k in enumerate(sizes):
        if b > a and (b - a >= rows or n + k > size):
            yield batch.slice(a, b - a)
            a, n = b, 0
        n += k
    if a < len(sizes):
        yield batch.slice(a)


@functools.cache
def one_thread() -> None:
    """Products of this worker run in one thread: Spark has a task for each core, and threads of a library that wait for each other would only
    take cores from other tasks. Where numpy brings no such library of its own, nothing is changed."""
    for path in glob.glob(os.path.join(os.path.dirname(np.__file__), "..", "numpy.libs", "*openblas*")):
        library = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir of the session. Only where that is unset and all of Spark
    is one process (as in tests) a temporary folder of this machine is taken; on a cluster that would lose tables, so it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not hasattr(shared_dir, "own"):
        shared_dir.own = tempfile.mkdtemp(prefix="spark-")
    return shared_dir.own


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet into the shared folder and read again: lineage ends at files that outlive any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes the files of stored() tables that nothing reads any more: all that came of them is stored itself."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fold(column: str, folds: int):
    """crc32 of the id as text, modulo folds."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def sampled(ids: DataFrame, column: str, most: int, seed: int = 7) -> DataFrame:
    """Rows of a small-rowed table, `most` or a little more of them: all if there are fewer, else those whose hashed id falls below
    the share wanted. Alike on every run and every partitioning; nothing is gathered but the count."""
    there = ids.count()
    if there <= most:
        return ids
    limit = int(most / there * 1_000_000)
    return ids.where(F.pmod(F.xxhash64(F.lit(seed), F.col(column)), F.lit(1_000_000)) < limit)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, folds: int = 4, held: int = 2) -> DataFrame:
    """(doc_id, text, label) of at most about `most` labelled documents outside the held-out fold, as a table in the shared folder.

    One label counts for a document (the largest, if rows disagree); null ids, null labels and other values than 0 and 1 are left
    out. The ids of the sample are bounded by `most` and so broadcast; texts are not shuffled."""
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (fold("doc_id", folds) != held)).groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    ids = sampled(known, "doc_id", most)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    return stored(rows, f"sample-{label}")
