"""Operator 13: phrases whose words stand together more often than they would by chance, for each language.

Tasks gather word ids of some million words and a language into a shard, with a break between pieces. Prefix doubling in numpy ranks all places by their
next 1, 2, 4 and so on words; sorted by rank they are the shard's suffix array, and the words that a place has in common with the one before are its
LCP. A stretch of the array where no LCP is under n is an interval, its size the count of one n-gram, so a shard emits each distinct n-gram once, with
its count. Spark adds up the shards' counts by (lang, phrase).

A phrase can't be more frequent than what it holds, so counting goes in three steps: words; pairs of words that are frequent; 3 to 5 words whose pairs
are frequent. What is frequent is told to the tasks as a bit map of hashes (`Filter`): 16 bits a key, MOST_BITS at most, built and merged in Spark. The map
rules out only what can't be frequent; what it lets pass by chance is counted as well, and dropped by its count. So where the map is too
small for the corpus more is shuffled, and the result is the same.

Cuts, scores and the rule about longer phrases are joins on phrases; the products are exact decimals. The first rows of a language are found in two
steps, so no task sees all its phrases.

Defined cases: null and empty texts have no words; lang null is `und`; a text is one shard's at least, however long; repeated rows count each
time; other columns aren't looked at; an empty table gives no rows; a language with no phrase of LEAST occurrences has none.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import release, slices, stored

LONGEST = 5  # words of a phrase
LEAST = 100  # occurrences of a phrase
FIRST = 2000  # rows of a language
SHARD = 2_000_000  # words, about
MOST_BITS = 1 << 28  # of a filter: 32 MB
SALTS = 64

#: A-Z become a-z, what ends a piece a line feed, a tab a space. `.` is then in no word, and marks the end of a piece.
BYTES = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))
END = b"."

#: A cut's score; counts of up to some 10^15 words stay within 38 digits.
EXACT = "cast((1000 * cast(a as decimal(38, 0)) * n) div (cast(l as decimal(38, 0)) * r) as bigint)"

COUNTS = "lang string, words int, phrase string, f bigint"


def pieces_of(raw: bytes) -> list[bytes]:
    """The words of a text, with END where a piece ends."""
    return raw.translate(BYTES).replace(b"\n", b" . ").split()


class Ids(dict):
    """Numbers of words in the order they are met; END has 0."""

    def __init__(self):
        super().__init__({END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = (first ^ (first >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + second
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


class Filter:
    """Bits of the hashes of frequent keys. Only what has its bit set can be frequent."""

    def __init__(self, bits: int, blocks: list[tuple[int, bytes]]):
        self.bits = np.uint64(bits)
        self.map = np.zeros(bits // 8, np.uint8)
        for n, block in blocks:
            self.map[n * len(block) : (n + 1) * len(block)] = np.frombuffer(block, np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes & (self.bits - np.uint64(1))).astype(np.int64)
        return (self.map[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def filter_of(frequent: DataFrame, count: int) -> Filter:
    """The filter of (lang, words, phrase) rows of one or two words. Blocks of 32,768 bits are made by Spark's bit map aggregate; their number, and so what
    the driver reads, has the bound of MOST_BITS."""

    def hashed(lang: pa.Array, phrase: pa.Array) -> pa.Array:
        out = np.zeros(len(lang), np.uint64)
        for i, (a, b) in enumerate(zip(lang.to_pylist(), phrase.to_pylist(), strict=True)):
            h = word_hashes(b.encode().split(b" "), a)
            out[i] = h[0] if len(h) == 1 else pair_hashes(h[:1], h[1:])[0]
        return pa.array((out & np.uint64(bits - 1)).astype(np.int64))

    bits = min(MOST_BITS, max(1 << 15, 1 << math.ceil(math.log2(16 * max(count, 1)))))
    at = F.arrow_udf(hashed, "bigint")("lang", "phrase")
    rows = frequent.select((at + 1).alias("at")).groupBy(F.bitmap_bucket_number("at").alias("n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("block")).collect()
    return Filter(bits, [(r["n"] - 1, bytes(r["block"])) for r in rows])


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Places sorted by their next `depth` words at least, by prefix doubling; what is beyond the end is 0, as a break."""
    rank, k = ids.astype(np.int64), 1
    while k < depth:
        after = np.zeros_like(rank)
        after[:-k] = rank[k:] if k < len(rank) else after[:-k]
        _, rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + after, return_inverse=True)
        k *= 2
    return np.argsort(rank, kind="stable")


def intervals(ids: np.ndarray, reach: np.ndarray, low: int, high: int):
    """(n, places, counts) of the distinct n-grams for n from low to high; reach: how many words of a phrase may begin at a place."""
    order = suffix_array(ids, high)
    order = order[reach[order] >= low]
    if not len(order):
        return
    padded = np.r_[ids, np.zeros(high, ids.dtype)]
    same, lcp = np.ones(len(order), bool), np.zeros(len(order), np.int64)
    same[0] = False
    for k in range(high):
        same[1:] &= padded[order[1:] + k] == padded[order[:-1] + k]
        lcp += same
    for n in range(low, high + 1):
        keep = reach[order] >= n  # all of an interval or none of it: what a place reaches within n words is told by these words
        starts = np.flatnonzero(lcp < n)
        counts = np.add.reduceat(keep, starts, dtype=np.int64)
        yield n, order[starts[counts > 0]], counts[counts > 0]


def shard_counts(words: list[bytes], ids: np.ndarray, lang: str, low: int, high: int, single: Filter | None, double: Filter | None):
    """Arrow batches of COUNTS of one shard and language."""
    reach = np.zeros(len(ids) + 1, np.int64)
    ok = ids > 0
    if single:
        hashes = word_hashes(words, lang)
        fine = single.has(hashes)
        fine[0] = False
        ok &= fine[ids]
    here = ok[:-1] & ok[1:]  # whether a phrase may go on from a place to the next
    if double and here.any():
        at = np.flatnonzero(here)
        here[at] = double.has(pair_hashes(hashes[ids[at]], hashes[ids[at + 1]]))
    last = len(ids) - 1
    stops = np.flatnonzero(~np.r_[here, False])  # places from which no phrase goes on
    reach = np.where(ok, np.minimum(stops[np.searchsorted(stops, np.arange(last + 1))] - np.arange(last + 1) + 1, high), 0)
    texts = pa.array(words, pa.binary()).cast(pa.string())
    for n, places, counts in intervals(ids, reach, low, high):
        for a in range(0, len(places), 100_000):
            part = places[a : a + 100_000]
            columns = [texts.take(pa.array(ids[part + k])) for k in range(n)]
            phrase = pc.binary_join_element_wise(*columns, " ") if n > 1 else columns[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]).take(pa.array(np.zeros(len(part), np.int32))), pa.array(np.full(len(part), n, np.int32)), phrase, pa.array(counts[a : a + 100_000])], ["lang", "words", "phrase", "f"]
            )


def counted(docs: DataFrame, low: int, high: int, single=None, double=None, size: int = SHARD) -> DataFrame:
    """(lang, words, phrase, f) of all phrases of low to high words that the filters (broadcast) let pass, added up over all shards."""

    def each(batches):
        shard: dict[str, tuple[Ids, list[np.ndarray]]] = {}
        n = 0

        def flush():
            for lang, (ids, parts) in shard.items():
                yield from shard_counts(list(ids), np.concatenate(parts), lang, low, high, single and single.value, double and double.value)
            shard.clear()

        for batch in batches:
            for part in slices(batch, 1):
                for lang, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    tokens = pieces_of(raw)
                    if not tokens:
                        continue
                    ids, parts = shard.setdefault(lang, (Ids(), []))
                    tokens.append(END)
                    parts.append(np.fromiter(map(ids.__getitem__, tokens), np.int32, len(tokens)))
                    n += len(tokens)
                if n >= size:
                    yield from flush()
                    n = 0
        yield from flush()

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("raw")).mapInArrow(each, COUNTS)
    return rows.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, size: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """Tables (lang, words, phrase, f) of all phrases with f >= least, and (lang, n) of all words."""
    spark: SparkSession = docs.sparkSession
    words = stored(counted(docs, 1, 1, size=size), "words")
    totals = stored(words.groupBy("lang").agg(F.sum("f").alias("n")), "words-of-langs")
    found = [stored(words.where(F.col("f") >= least), "phrases-1")]
    release(words)
    single = spark.sparkContext.broadcast(filter_of(found[0], found[0].count()))
    if longest > 1:
        found.append(stored(counted(docs, 2, 2, single, size=size).where(F.col("f") >= least), "phrases-2"))
    if longest > 2:
        double = spark.sparkContext.broadcast(filter_of(found[1], found[1].count()))
        found.append(stored(counted(docs, 3, longest, single, double, size).where(F.col("f") >= least), "phrases-3"))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows, totals


def collocations(docs: DataFrame, least: int = LEAST, first: int | None = FIRST, longest: int = LONGEST, size: int = SHARD) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the `first` phrases of each language (None: all)."""
    frequent, totals = frequent_phrases(docs, least, longest, size)
    whole = F.col("phrase")
    cuts = (
        frequent.where("words > 1")
        .select("lang", "words", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
        .withColumn("left", F.expr("substring_index(phrase, ' ', k)"))
        .withColumn("right", F.expr("substring_index(phrase, ' ', k - words)"))
    )
    of = frequent.select("lang", whole.alias("part"), F.col("f").alias("of"))
    cuts = cuts.join(of.withColumnsRenamed({"part": "left", "of": "l"}), ["lang", "left"]).join(of.withColumnsRenamed({"part": "right", "of": "r"}), ["lang", "right"])
    cuts = stored(cuts.join(F.broadcast(totals), "lang"), "cuts")  # a row for each language
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(F.expr(EXACT).alias("score"), "k", "l", "r")).alias("c"))
    # a phrase that is as frequent as a longer one has such a one with one word more, of which it is the first or last cut
    inside = cuts.where((F.col("k") == F.col("words") - 1) & (F.col("l") >= F.col("a"))).select("lang", F.col("left").alias("phrase"), (F.col("l") == F.col("a")).alias("hidden"))
    inside = inside.unionByName(cuts.where(F.col("k") == 1).select("lang", F.col("right").alias("phrase"), (F.col("r") == F.col("a")).alias("hidden"))).where("hidden").select("lang", "phrase").distinct()
    kept = best.join(inside, ["lang", "phrase"], "left_anti").select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if first is not None:
        salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
        kept = kept.withColumn("in_salt", F.row_number().over(salted)).where(F.col("in_salt") <= first)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    if first is not None:
        ranked = ranked.where(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: All phrases are counted, with no filter and no bit maps.
ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sized AS (SELECT lang, w, unnest(range(1, 6)) AS words FROM words),
placed AS (SELECT lang, w, words, unnest(range(1, len(w) - words + 2)) AS i FROM sized),
counts AS (SELECT lang, words, w[i:i + words - 1] AS p, count(*) AS f FROM placed GROUP BY ALL),
totals AS (SELECT lang, sum(f)::HUGEINT AS n FROM counts WHERE words = 1 GROUP BY lang),
candidates AS (SELECT * FROM counts WHERE words > 1 AND f >= 100),
cuts AS (SELECT c.lang, c.words, c.p, c.f AS a, k FROM (SELECT *, unnest(range(1, words)) AS k FROM candidates) c),
scored AS (
  SELECT c.lang, c.p, c.a, c.k, l.f AS l, r.f AS r, n, (1000::HUGEINT * c.a * n) // (l.f::HUGEINT * r.f) AS score
  FROM cuts c JOIN counts l ON l.lang = c.lang AND l.p = c.p[1:k] JOIN counts r ON r.lang = c.lang AND r.p = c.p[k + 1:] JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
parts AS (SELECT lang, f, p[i:j] AS p FROM (SELECT lang, f, p, i, unnest(range(i + 1, words + 1)) AS j FROM (SELECT *, unnest(range(1, words)) AS i FROM candidates)) WHERE j - i + 1 < len(p)),
hidden AS (SELECT DISTINCT b.lang, b.p FROM best b JOIN parts q ON q.lang = b.lang AND q.p = b.p AND 100 * q.f >= 100 * b.a),
ranked AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM best b WHERE NOT EXISTS (SELECT 1 FROM hidden h WHERE h.lang = b.lang AND h.p = b.p))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked QUALIFY rank <= 2000
"""
