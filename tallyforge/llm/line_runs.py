"""Operator 11: lines that many documents share, by levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at its ends and with A-Z lower-cased; keys of LEAST code points or more count, as 16 bytes
of BLAKE2b. A run is a table of (key, docs, last, seen), in buckets of the key and sorted by it: in how many documents of its batch a key stands,
the largest doc_id among them, and whether an older run has it. A batch is joined with the runs bucket by bucket (merge joins; neither side
moves again, as all are dealt out alike), which tells its fresh keys, and adds its own run at level 0. A level that holds two runs is
compacted into one run of the next level, so there are few runs however many batches came, and a key is written again once a level.

All rows of a document are in one batch, so counts of batches add up. Once all batches are in, keys that MOST documents or more hold lose their
lines but for those in the largest doc_id. Lines meet these keys in a join whose hot keys Spark splits (one side has one row a key), and texts meet
their own keys only.

Defined cases: null and the empty text are one empty line; empty and short lines stay; texts of any length are read whole; a line that repeats in one
document counts once for it, and all its places are dropped or kept alike; rows of one doc_id are one document; rows without an id hold lines, but
are no document, and lose the lines of keys that MOST documents hold; other columns aren't looked at; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import shared_dir, slices, stored

LEAST = 20  # code points of a key
MOST = 3  # documents from which a key's lines go
BATCHES = 4  # of a whole table

BLANK = b" \t\n\x0b\x0c\r"
SMALL = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
KEYS = "doc_id bigint, key binary"


def key_of(line: bytes, least: int = LEAST) -> bytes | None:
    """The key of a line; None if it is too short."""
    line = line.strip(BLANK)
    if len(line) < least or len(line) < 4 * least and sum(b & 0xC0 != 0x80 for b in line) < least:
        return None
    return hashlib.blake2b(line.translate(SMALL), digest_size=16).digest()


def line_keys(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, key) of each document's long lines, each key once a row."""

    def each(batches):
        for batch in batches:
            for part in slices(batch, 1):
                ids, keys = [], []
                for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    own = {k for x in (text or b"").split(b"\n") if (k := key_of(x, least))}
                    ids += [i] * len(own)
                    keys += own
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], ["doc_id", "key"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary")).mapInArrow(each, KEYS)


class LineRuns:
    """Levelled runs in the shared folder, the oldest on the highest level. Each run is a bucketed table, so that joins and compactions move nothing
    that is stored. (They are joins and no unions: Spark 4.1 takes a union of bucketed tables for co-located where it isn't.)"""

    def __init__(self, spark: SparkSession, buckets: int | None = None):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.home = f"{shared_dir(spark).rstrip('/')}/line-runs-{uuid.uuid4().hex}"
        self.levels: list[list[str]] = []

    def write(self, run: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        run.write.format("parquet").bucketBy(self.buckets, "key").sortBy("key").option("path", f"{self.home}/{name}").saveAsTable(name)
        return name

    def runs(self) -> list[str]:
        return [name for level in reversed(self.levels) for name in level]

    def drop(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.home}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def merged(self, older: str, newer: str) -> DataFrame:
        """Two runs as one, by a merge join of their buckets. A key that both have was seen before only if the older run says so."""
        a, b = self.spark.table(older).alias("a"), self.spark.table(newer).alias("b")
        return a.join(b, F.col("a.key") == F.col("b.key"), "full").select(
            F.coalesce("a.key", "b.key").alias("key"),
            (F.coalesce("a.docs", F.lit(0)) + F.coalesce("b.docs", F.lit(0))).alias("docs"),
            F.greatest("a.last", "b.last").alias("last"),
            F.coalesce("a.seen", "b.seen").alias("seen"),
        )

    def compact(self, level: int) -> None:
        """Two runs of a level become one run of the next."""
        older, newer, *rest = self.levels[level]
        if level + 1 == len(self.levels):
            self.levels.append([])
        self.levels[level + 1].append(self.write(self.merged(older, newer)))
        self.levels[level] = rest
        self.drop(older, newer)

    def add(self, keys: DataFrame) -> DataFrame:
        """Adds a batch of (doc_id, key) as a run of its own and gives that run, whose `seen` tells which keys older runs have; it is to be read
        before the next add, which may compact it. The documents of a batch are in no other batch."""
        for level in range(len(self.levels)):
            if len(self.levels[level]) > 1:
                self.compact(level)
        run = keys.groupBy("key").agg(F.count_distinct("doc_id").alias("docs"), F.max("doc_id").alias("last")).withColumn("seen", F.lit(False))
        for name in self.runs():
            older = self.spark.table(name).select("key", F.lit(True).alias("there"))
            run = run.join(older, "key", "left").select("key", "docs", "last", (F.col("seen") | F.coalesce("there", F.lit(False))).alias("seen"))
        name = self.write(run)
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(name)
        return self.spark.table(name)

    def shared(self, most: int = MOST) -> DataFrame:
        """(key, last) of the keys that `most` documents or more hold, over all batches. Runs are merged until two are left."""
        while len(names := self.runs()) > 2:
            self.levels = [[self.write(self.merged(*names[-2:]))], names[:-2]]
            self.drop(*names[-2:])
        rows = self.merged(*names) if len(names) == 2 else self.spark.table(names[0])
        return rows.where(F.col("docs") >= most).select("key", "last")


def fresh_lines(docs: DataFrame, runs: LineRuns, least: int = LEAST) -> DataFrame:
    """Adds a batch of documents to the runs and gives (doc_id, key) of its lines that no earlier batch has: the batch's keys without those of the runs."""
    keys = stored(line_keys(docs, least), "line-keys")
    return keys.join(runs.add(keys).where("seen").select("key"), "key", "left_anti").select("doc_id", "key")


def cleaned(text, gone, least: int = LEAST):
    """A column of struct<n_lines, n_dropped, kept>: a text column without the lines whose keys are in an array column (null: none)."""

    def each(texts: pa.Array, keys: pa.Array) -> pa.Array:
        n, dropped, kept = [], [], []
        for t, k in zip(texts, keys, strict=True):
            lines, k = (t.as_py() or b"").split(b"\n"), set(k.as_py() or ())
            left = [x for x in lines if key_of(x, least) not in k] if k else lines
            n.append(len(lines))
            dropped.append(len(lines) - len(left))
            kept.append(b"\n".join(left))
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary())], ["n_lines", "n_dropped", "kept"])

    return F.arrow_udf(each, "n_lines bigint, n_dropped bigint, kept binary")(text.cast("binary"), gone)


def dedup_lines(docs: DataFrame, least: int = LEAST, most: int = MOST, batches: int = BATCHES) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) of each row, `kept` being the text's other lines as UTF-8."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/line-keys-{uuid.uuid4().hex}"
    line_keys(docs, least).withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches))).write.partitionBy("batch").parquet(path)
    keys = spark.read.schema(f"{KEYS}, batch bigint").parquet(path)
    runs = LineRuns(spark)
    for b in range(batches):
        runs.add(keys.where(F.col("batch") == b))
    common = stored(runs.shared(most), "line-keys-shared")
    runs.drop(*runs.runs())
    gone = keys.join(common, "key").where(~F.col("doc_id").eqNullSafe(F.col("last"))).groupBy("doc_id").agg(F.collect_set("key").alias("gone")).withColumnRenamed("doc_id", "of")
    texts = docs.select("doc_id", "text")
    met = texts.join(gone, texts["doc_id"].cast("bigint").eqNullSafe(gone["of"]), "left")
    return met.select("doc_id", cleaned(F.col("text"), F.col("gone"), least).alias("d")).select("doc_id", "d.*")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of each row."""
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


#: Keys themselves stand in for their hashes.
ORACLE = """
WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT row_no, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM docs),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT k.doc_id, count(*) AS n_lines, count(c.key) FILTER (k.doc_id IS DISTINCT FROM c.last) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (c.key IS NULL OR k.doc_id IS NOT DISTINCT FROM c.last), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c USING (key) GROUP BY row_no, k.doc_id
"""
