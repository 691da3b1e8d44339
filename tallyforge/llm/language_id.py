"""Operator 5: language by a string kernel.

The kernel of two texts is a blended spectrum: the number of character n-grams of 1 to 4 letters that both hold, over the root of the
product of the numbers either holds. Landmarks (texts of every language) give the Nystroem features, in which one ridge regression a
language is solved. A batch's scores are presences by landmarks by weights; as both products are linear, the second is taken once, which
leaves a weight for each language and n-gram of the landmarks, and a batch is scored by one product of its sparse presences with those.

n-grams are told exactly: letters are numbered (those of the landmarks first, then a batch's others), and four numbers of 16 bits make the
n-gram's own. A text is scored in stretches of about 1,000 characters, whose scores are averaged, so that long texts are read to their end
and the work grows with the characters alone. There is no shuffle; each partition scores its own texts.
The fit sees a sample of at most about `most` documents a language outside the held-out fold. Every value of lang is learned: where there are
more than LANGUAGES, in blocks of so many, each against samples of all, and each block is one more pass whose best language of a document
and sum are joined at the end.

Defined cases: null texts and texts without a letter are `und` with score 0; null languages are not learned; without any language
all is `und`; of equal scores the language whose name sorts first; ids that are null are never learned from; repeated rows give repeated
rows; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .shared import fold as fold_of
from .shared import one_thread, stored

MOST_A_LANGUAGE = 600  # documents learned from, about
LANDMARKS = 192
STRETCH = 1000
LANGUAGES = 32  # of a block
TOGETHER = 64  # stretches that are multiplied at once
GRAMS = (1, 2, 3, 4)
LETTER = np.array([chr(c).isalpha() for c in range(0x10000)])
SMALL = np.array([ord(chr(c).lower()[0]) for c in range(0x10000)], np.uint32)


def stretches(text: str | None) -> list[np.ndarray]:
    """Folded characters of a text in stretches: small letters, one space for what lies between words; none without a letter."""
    if not text:
        return []
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if (codes > 0xFFFF).any():
        letter = np.fromiter((chr(c).isalpha() for c in codes.tolist()), bool, len(codes))
        codes = np.where(codes > 0xFFFF, codes, SMALL[np.minimum(codes, 0xFFFF)])
    else:
        letter, codes = LETTER[codes], SMALL[codes]
    if not letter.any():
        return []
    codes = np.where(letter, codes, 32).astype(np.uint64)
    codes = codes[letter | np.append(True, letter[:-1])]  # the first of what lies between two words
    n = max(1, round(len(codes) / STRETCH))
    return np.array_split(codes, n)


class Grams:
    """The n-grams of the landmarks: their letters, numbered from 1, and the n-grams' own numbers in ascending order."""

    def __init__(self, landmarks: list[np.ndarray]):
        self.letters = np.unique(np.concatenate(landmarks)) if landmarks else np.zeros(0, np.uint64)
        own = self.numbers(landmarks)
        self.grams, at = np.unique(np.concatenate(own), return_inverse=True) if own else (np.zeros(0, np.uint64), np.zeros(0, int))
        self.presence = np.zeros((len(self.grams), len(own)), np.uint8)  # of an n-gram in a landmark
        self.presence[at, np.repeat(np.arange(len(own)), list(map(len, own)))] = 1
        self.sizes = np.array(list(map(len, own)))

    def numbers(self, parts: list[np.ndarray]) -> list[np.ndarray]:
        """The distinct n-grams of each stretch, in ascending order of their numbers."""
        codes = np.concatenate(parts)
        new = np.setdiff1d(codes, self.letters)
        if len(new) + len(self.letters) >= 1 << 16:  # more letters than 16 bits hold: some stretches at a time, as one has far fewer
            half = len(parts) // 2
            return self.numbers(parts[:half]) + self.numbers(parts[half:])
        alphabet = np.concatenate([self.letters, new])
        order = np.argsort(alphabet)
        own = (order[np.searchsorted(alphabet, codes, sorter=order)] + 1).astype(np.uint64)
        out, a = [], 0
        for p in parts:
            c, found = own[a : a + len(p)], []
            a += len(p)
            for n in GRAMS:
                g = c if n == 1 else (g[:-1] << np.uint64(16)) | c[n - 1 :] if len(g) > 1 else g[:0]
                found.append(g)
            g = np.sort(np.concatenate(found))
            out.append(g[np.append(True, g[1:] != g[:-1])])
        return out

    def shared(self, parts: list[np.ndarray]):
        """(stretch, n-gram of the landmarks, weight) of the sparse presences of some stretches, and how many each stretch has."""
        own = self.numbers(parts)
        sizes = np.array(list(map(len, own)))
        all_ = np.concatenate(own)
        at = np.minimum(np.searchsorted(self.grams, all_), max(0, len(self.grams) - 1))
        there = self.grams[at] == all_ if len(self.grams) else np.zeros(len(all_), bool)
        return np.repeat(np.arange(len(parts)), sizes)[there], at[there], sizes

    def kernels(self, parts: list[np.ndarray]) -> np.ndarray:
        """Kernel of each stretch with each landmark."""
        row, gram, sizes = self.shared(parts)
        used, column = np.unique(gram, return_inverse=True)
        presence = np.zeros((len(parts), len(used)), np.float32)
        presence[row, column] = 1
        return presence @ self.presence[used].astype(np.float32) / np.sqrt(sizes[:, None] * self.sizes[None, :])


@dataclass
class Languages:
    """Some languages: the landmarks' n-grams, and a weight for each of them and each language; the constant stands apart."""

    names: list[str]
    grams: Grams | None = None
    weights: np.ndarray | None = None
    constant: np.ndarray | None = None

    def scores(self, parts: list[np.ndarray]) -> np.ndarray:
        """Of each stretch and language."""
        row, gram, sizes = self.grams.shared(parts)
        out = np.zeros((len(parts), len(self.names)))
        first = np.flatnonzero(np.diff(row, prepend=-1))
        if len(first):
            out[row[first]] = np.add.reduceat(self.weights[gram], first, axis=0)
        return out / np.sqrt(sizes)[:, None] + self.constant

    def means(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(mean score of each text and language, stretches of each text). Stretches are scored TOGETHER at a time, so memory is bounded for
        texts of any length."""
        totals, count = np.zeros((len(texts), len(self.names))), np.zeros(len(texts))
        parts: list[np.ndarray] = []
        of: list[int] = []

        def flush():
            np.add.at(totals, of, self.scores(parts))
            parts.clear()
            of.clear()

        for i, t in enumerate(texts):
            own = stretches(t)
            count[i] = len(own)
            for p in own:
                parts.append(p)
                of.append(i)
                if len(parts) == TOGETHER:
                    flush()
        if parts:
            flush()
        return totals / np.maximum(1, count)[:, None], count


def sampled_languages(docs: DataFrame, most: int) -> tuple[list[str], DataFrame | None]:
    """(names, sample (k, text)): every language outside the held-out fold, and about `most` documents of each, whole, by hashed id."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & (fold_of("doc_id", 5) != 0))
    there = known.groupBy("lang").agg(F.count("*").alias("n")).collect()  # a row for each language
    if not there:
        return [], None
    names = sorted(r["lang"] for r in there)
    number = {x: i for i, x in enumerate(names)}
    shares = docs.sparkSession.createDataFrame([(r["lang"], number[r["lang"]], min(1.0, most / r["n"])) for r in there], "lang string, k int, share double")
    chosen = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1_000_000)) < F.col("share") * 1_000_000
    return names, stored(known.select("doc_id", "lang", "text").join(F.broadcast(shares), "lang").where(chosen).select("k", "text"), "languages")


def learn(sample: DataFrame, names: list[str], block: range, landmarks: int = LANDMARKS, ridge: float = 1e-3) -> Languages:
    """A classifier of some of the languages (numbers in `block`) against all. Landmarks are the stretches of the least hashes of each
    language of the block. Each task sums its products of features, a matrix of landmarks by landmarks for each language; Spark adds the tasks' matrices
    up row by row, and the driver gets one matrix a language, however many tasks there are."""
    spark = sample.sparkSession
    each = max(2, landmarks // len(block))

    def marks(batches):
        found: dict[int, list[tuple[int, bytes]]] = {}
        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found[k] = sorted({*found.get(k, ()), *((zlib.crc32(p.tobytes()), p.tobytes()) for p in stretches(text))})[:each]
        rows = [{"k": k, "hash": h, "codes": c} for k, own in found.items() for h, c in own]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("k", pa.int32()), ("hash", pa.int64()), ("codes", pa.binary())]))

    first = W.partitionBy("k").orderBy("hash", "codes")
    own = sample.where(F.col("k").between(block[0], block[-1]))
    rows = own.mapInArrow(marks, "k int, hash bigint, codes binary").distinct().withColumn("at", F.row_number().over(first)).where(F.col("at") <= each).orderBy("k", "at").collect()
    found = [names[k] for k in sorted({r["k"] for r in rows})]
    if not rows:
        return Languages([])
    chosen = [np.frombuffer(r["codes"], np.uint64) for r in rows]
    grams = Grams(chosen)
    values, vectors = np.linalg.eigh(grams.kernels(chosen).astype(np.float64))
    kept = values > 1e-6 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])  # landmark kernels to Nystroem features
    held = spark.sparkContext.broadcast((grams, root))  # of LANDMARKS stretches, or two for each language of a block

    def products(batches):
        """Of each language: the sum of products of features (with a 1 as the last, so sums and number of stretches are in it, too)."""
        one_thread()
        grams_, root_ = held.value
        size = root_.shape[1] + 1
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own, total = stretches(text), sums.setdefault(k, np.zeros((size, size)))
                for a in range(0, len(own), TOGETHER):
                    x = grams_.kernels(own[a : a + TOGETHER])
                    f = np.hstack([x.astype(np.float64) @ root_, np.ones((len(x), 1))])
                    total += f.T @ f
        for k, x in sums.items():
            yield rows_of({(k, i): line for i, line in enumerate(x)})

    def rows_of(lines: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(lines) + 1) * size, pa.int32()), pa.array(np.concatenate(list(lines.values()))))
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in lines], pa.int32()), pa.array([i for _, i in lines], pa.int32()), flat], ["k", "i", "sums"])

    def added(batches):
        """One row for each language and row of its matrix, of those that meet here."""
        lines: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            values = batch.column(2).flatten().to_numpy().reshape(-1, size)
            for k, i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), values, strict=True):
                lines[k, i] = lines[k, i] + x if (k, i) in lines else x.copy()
        if lines:
            yield rows_of(lines)

    size = int(kept.sum()) + 1
    gram, target = np.zeros((size, size)), np.zeros((size, len(found)))
    by: dict[int, np.ndarray] = {}
    schema = "k int, i int, sums array<double>"
    for r in sample.mapInArrow(products, schema).repartition("k", "i").mapInArrow(added, schema).toLocalIterator():
        by.setdefault(r["k"], np.zeros((size, size)))[r["i"]] = r["sums"]
    for k, own in by.items():
        if own[-1, -1]:
            gram += own / own[-1, -1]  # languages count alike
            target -= own[:, -1:] / own[-1, -1]
            if names[k] in found:
                target[:, found.index(names[k])] += 2 * own[:, -1] / own[-1, -1]
    w = np.linalg.solve(gram + ridge / 100 * np.eye(size), target)
    return Languages(found, grams, ((grams.presence / np.sqrt(grams.sizes)[None, :]) @ (root @ w[:-1])).astype(np.float32), w[-1])


PREDICTED = "lang_pred string, best double, total double"


def predictor(held):
    """An Arrow function of a text to its best language among a broadcast block's, that one's mean, and the sum of exponentials of all."""

    def predict(texts: pa.Array) -> pa.Array:
        model = held.value
        means, count = model.means(texts.to_pylist())
        total, best = np.exp(3 * means).sum(1), means.argmax(1)
        lang = [model.names[b] if n else None for b, n in zip(best.tolist(), count.tolist(), strict=True)]
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(means.max(1)), pa.array(total)], ["lang_pred", "best", "total"])

    return F.arrow_udf(predict, PREDICTED)


def identify(docs: DataFrame, most: int = MOST_A_LANGUAGE, languages: int = LANGUAGES) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each document."""
    spark = docs.sparkSession
    held_out = F.coalesce(fold_of("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    names, sample = sampled_languages(docs, most)
    models = [m for a in range(0, len(names), languages) if (m := learn(sample, names, range(a, min(a + languages, len(names))))).names]
    if not models:
        return docs.select("doc_id", held_out, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    if len(models) == 1:
        rows = docs.select("doc_id", held_out, predictor(spark.sparkContext.broadcast(models[0]))(F.col("text")).alias("p"))
    else:
        base, found = stored(docs.select("doc_id", held_out, "text").withColumn("row", F.monotonically_increasing_id()), "numbered"), []
        for m in models:
            held = spark.sparkContext.broadcast(m)
            found.append(stored(base.select("row", predictor(held)(F.col("text")).alias("p")).select("row", "p.*"), "found"))
            held.destroy()
        first = F.min(F.when(F.col("lang_pred").isNotNull(), F.struct((-F.col("best")).alias("b"), "lang_pred")))
        merged = reduce(DataFrame.union, found).groupBy("row").agg(first.alias("f"), F.sum("total").alias("total"))
        merged = merged.select("row", F.struct(F.col("f.lang_pred").alias("lang_pred"), (-F.col("f.b")).alias("best"), "total").alias("p"))
        rows = base.select("row", "doc_id", "held_out").join(merged, "row")
    score = F.when(F.col("p.lang_pred").isNotNull(), F.exp(3 * F.col("p.best")) / F.col("p.total")).otherwise(0.0)
    return rows.select("doc_id", "held_out", F.coalesce("p.lang_pred", F.lit("und")).alias("lang_pred"), score.alias("score"))
