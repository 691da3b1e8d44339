"""Operator 7: near duplicates by DartMinHash signatures.

A document is the weighted set of its five-word shingles (weight 1 each for the set similarity of the contract, or their counts).
Darts fall on every element's weight axis as a Poisson process along the rank axis, made by hashing the element, so equal elements
get equal darts. A dart below the element's weight counts; each coordinate of the signature keeps its earliest dart. Two signatures
agree in a coordinate with a probability that is the weighted Jaccard similarity. Darts are thrown up to the rank where every
coordinate should have one, and further for documents that lack one.

Equal texts are one class before anything else. Coordinates are joined in bands: classes that share a band are compared with the
smallest of that band, exactly, on their shingles. Members of a band that ended up in other components than its smallest are then
compared with the rest of the band, so that a link between two classes of a band is found or follows from others. Exact bounds (sizes,
distances to the smallest, bit maps of the shingles) leave few of those pairs, so that the rows of a large group grow with the group,
not its square. With BANDS bands of ROWS a pair at the threshold shares none with probability
(1 - 0.8**5)**28, 1.5 in 100,000, and a closer pair less often.

A class is told by the 128-bit hash of its words and has a number of its own, so an id that stands on several texts is a document of each.
With weights="count" an element is a shingle's first, second... occurrence, and the decision is the weighted Jaccard similarity, too.

Defined cases: null texts, and texts without words, stand alone; texts of fewer than five words are one shingle; rows of the same id
and text are one document, and of rows that are equal in both one is kept; an id on several texts has a row for each, in the group of that
text; if these are the group's smallest, one of the texts is kept; rows with a null id stand alone, as nothing can name them; extra
columns are not looked at.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .shared import in_parts, slices, stored, words_of

WIDTH = 5
SIMILAR = 0.8
BANDS, ROWS = 28, 5
MARKS = 32  # 64-bit numbers of a document's bit map
HOT, SHARES = 256, 1000  # a key with more rows than HOT and more than a SHARES-th of all work is dealt out; so at most SHARES are
FEW_IDS = 1_000_000  # ids (some 10 MB) up to which they are broadcast to find their texts
BATCH_WORDS = 200_000  # words of the texts that are hashed together
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit ones."""
    return (x >> U(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


def shingles(texts: list[list[bytes]], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, count) of the distinct shingles of some documents, in the order of document and shingle."""
    sizes = np.array([len(t) for t in texts], np.int64)
    total = int(sizes.sum())
    words = np.fromiter((h for t in texts for h in map(xxhash.xxh3_64_intdigest, t)), np.uint64, total)
    words = np.concatenate([words, np.zeros(width, np.uint64)])
    doc = np.repeat(np.arange(len(texts)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(total)  # words up to the document's end
    h = np.zeros(total, np.uint64)
    for i in range(width):
        h = mixed(h * U(0x9E3779B97F4A7C15) + np.where(left > i, words[i : total + i], U(0)) + U(i + 1))
    whole = left >= np.minimum(width, np.repeat(sizes, sizes))
    doc, h = doc[whole], h[whole]
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    first = np.ones(len(h), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(first)
    return doc[at], h[at], np.diff(np.append(at, len(h)))


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, k: int, seed: int = 1) -> np.ndarray:
    """The earliest dart of each coordinate, as a number, for documents 0 to n_docs - 1 (row by row); documents without elements get
    zeros."""
    out = np.zeros((n_docs, k), np.uint64)
    if not len(doc):
        return out
    # the weight axis in stretches [0, 1), [1, 2), [2, 4)...: an element has those that begin below its weight
    cells = 1 + np.maximum(0, np.ceil(np.log2(np.maximum(weight, 1)))).astype(np.int64)
    row = np.repeat(np.arange(len(doc)), cells)
    cell = np.arange(len(row)) - np.repeat(np.cumsum(cells) - cells, cells)
    low = np.where(cell > 0, 2.0 ** (cell - 1), 0.0)
    wide = np.where(cell > 0, low, 1.0)
    base = mixed(element[row] ^ mixed(cell.astype(np.uint64) + U(seed * 1000 + 1)))
    doc_, weight_ = doc[row], weight[row].astype(np.float64)
    total = np.bincount(doc, weight, n_docs)
    reach = np.where(total > 0, k * (math.log(k) + 2) / np.maximum(total, 1e-300), 0.0)
    step = np.zeros(len(row), np.uint64)
    rank = -np.log(unit(mixed(base + U(1)))) / wide
    best_rank = np.full(n_docs * k, np.inf)
    best = np.zeros(n_docs * k, np.uint64)
    there = np.unique(doc)
    alive = np.arange(len(row))
    while len(alive):
        at = alive
        got: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(at := at[rank[at] <= reach[doc_[at]]]):
            dart = mixed(base[at] + (step[at] * U(2) + U(2)) * U(0xD1342543DE82EF95))
            height = low[at] + wide[at] * unit(mixed(dart ^ U(0xA0761D6478BD642F)))
            good = height < weight_[at]
            coordinate = ((dart >> U(20)) % U(k)).astype(np.int64)
            got.append((doc_[at][good] * k + coordinate[good], rank[at][good], dart[good]))
            step[at] += U(1)
            rank[at] -= np.log(unit(mixed(base[at] + step[at] * U(2) + U(1)))) / wide[at]
        if got:
            place, r, d = (np.concatenate(x) for x in zip(*got, strict=True))
            order = np.lexsort((r, place))
            place, r, d = place[order], r[order], d[order]
            first = np.ones(len(place), bool)
            first[1:] = place[1:] != place[:-1]
            place, r, d = place[first], r[first], d[first]
            nearer = r < best_rank[place]
            best_rank[place[nearer]], best[place[nearer]] = r[nearer], d[nearer]
        lacking = np.isinf(best_rank.reshape(n_docs, k)[there]).any(1)
        there = there[lacking]
        if not len(there):
            break
        mark = np.zeros(n_docs, bool)
        mark[there] = True
        alive = alive[mark[doc_[alive]]]
        reach[there] *= 2
    return best.reshape(n_docs, k)


def banded(sign: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A number for each band of each signature."""
    h = np.zeros((len(sign), bands), np.uint64)
    for i in range(rows):
        h = mixed(h * U(0x9E3779B97F4A7C15) + sign[:, i : bands * rows : rows])
    return mixed(h + np.arange(1, bands + 1, dtype=np.uint64)[None, :])


SKETCH = "doc_id bigint, same binary, n_shingles bigint, bands array<bigint>"


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, weights: str = "set") -> DataFrame:
    """(doc_id, same: 128-bit hash of the words or null, n_shingles, bands) of each document, in its row's order."""

    def each(batches):
        for batch in (part for batch in batches for part in slices(batch, 1)):
            texts = [words_of(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            sizes, keys = [], []
            for a, b in in_parts(texts, BATCH_WORDS):
                doc, h, n = shingles(texts[a:b])
                sign = signatures(doc, h, np.ones(len(n)) if weights == "set" else n.astype(float), b - a, bands * rows)
                keys.append(banded(sign, bands, rows).astype(np.int64))
                sizes.append(np.bincount(doc, None if weights == "set" else n, b - a).astype(np.int64))
            same = list(map(same_words, texts))
            flat = np.concatenate(keys).ravel() if keys else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * bands), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(same, pa.binary()), pa.array(np.concatenate(sizes) if sizes else [], pa.int64()), lists], ["doc_id", "same", "n_shingles", "bands"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(each, SKETCH)


def marks(doc: np.ndarray, h: np.ndarray, n_docs: int) -> np.ndarray:
    """A bit map of each document's shingles, as MARKS numbers."""
    out = np.zeros((n_docs, MARKS), np.uint64)
    np.bitwise_or.at(out, (doc, ((h >> U(6)) % U(MARKS)).astype(np.int64)), U(1) << (h & U(63)))
    return out


def shingle_lists(docs: DataFrame, weights: str = "set") -> DataFrame:
    """(doc_id, same, shingles, marks) of each document; a shingle's further occurrences are elements of their own where counts weigh."""

    def each(batches):
        for batch in (part for batch in batches for part in slices(batch, 1)):
            texts = [words_of(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for a, b in in_parts(texts, BATCH_WORDS):
                doc, h, n = shingles(texts[a:b])
                if weights == "count":
                    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    doc, h = np.repeat(doc, n), np.repeat(h, n) ^ np.where(nth > 0, mixed(nth.astype(np.uint64)), U(0))
                ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=b - a))]).astype(np.int32)
                bits = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * MARKS), pa.array(marks(doc, h, b - a).astype(np.int64).ravel()))
                same = pa.array([same_words(t) for t in texts[a:b]], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), same, pa.ListArray.from_arrays(pa.array(ends), pa.array(h.astype(np.int64))), bits], ["doc_id", "same", "shingles", "marks"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(each, "doc_id bigint, same binary, shingles array<bigint>, marks array<bigint>")


def same_words(words: list[bytes]) -> bytes | None:
    """What tells texts of the same words."""
    return xxhash.xxh3_128_digest(b" ".join(words)) if words else None


def can_be_similar(n: Column, a: Column, m: Column, b: Column, similar: float) -> Column:
    """Whether sets of n and m elements with these bit maps can be that similar. A bit that one has and the other lacks stands for one
    element at least that is not shared, so the bound is never below the similarity."""
    only = lambda x, y: reduce(lambda s, t: s + t, [F.bit_count(x[i].bitwiseAND(F.bitwise_not(y[i]))) for i in range(MARKS)])
    shared = F.least(n - only(a, b), m - only(b, a))
    return shared >= similar * (n + m - shared) - 1e-9


def dealt(rows: DataFrame, values: DataFrame, on: str, by: str, sizes: DataFrame, work: Column | None = None) -> DataFrame:
    """rows joined with values on a key. Keys of many rows have their values at several places, and their rows are dealt out over these by a
    hash of `by`, so that no task gets all rows of a key. sizes (on, n) has the number of rows of each key that may have many; work is
    what a key costs (its rows if not given). Keys that are dealt out are at most SHARES, by their definition: the driver may hold them."""
    work = F.col("n") if work is None else work
    total = sizes.agg(F.sum(work)).first()[0] or 0
    places = F.least(F.ceil(work * SHARES / F.lit(max(total, 1))), F.ceil(F.col("n") / HOT)).cast("int")
    hot = sizes.where((F.col("n") > HOT) & (work * SHARES > total)).select(on, places.alias("places"))
    found = hot.collect()
    if not found:
        return rows.join(values, on)
    few = F.broadcast(rows.sparkSession.createDataFrame(found, hot.schema))
    rows = rows.join(few, on, "left").withColumn("place", F.pmod(F.xxhash64(by), F.coalesce("places", F.lit(1))).cast("int")).drop("places")
    values = values.join(few, on, "left").withColumn("place", F.explode(F.sequence(F.lit(0), F.coalesce("places", F.lit(1)) - 1))).drop("places")
    return rows.join(values, [on, "place"]).drop("place")


def compared(lists: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, j): the Jaccard similarity of each distinct pair of classes, from their shingles. Each pair gets the shingles of b first, which
    most pairs share with no other; pairs of a class that stands first in many are dealt out."""
    pairs = stored(pairs, "pairs")
    with_b = pairs.join(lists.select(F.col("node").alias("b"), F.col("shingles").alias("own")), "b")
    both = dealt(with_b, lists.select(F.col("node").alias("a"), "shingles"), "a", "b", pairs.groupBy("a").agg(F.count("*").alias("n")))
    shared = F.size(F.array_intersect("own", "shingles"))
    return both.select("a", "b", (shared / (F.size("own") + F.size("shingles") - shared)).alias("j"))


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of some documents. Few ids, by their count, are broadcast, and no text is shuffled; else both sides are."""
    few = ids.count() <= FEW_IDS
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def links(docs: DataFrame, classes: DataFrame, similar: float = SIMILAR, weights: str = "set") -> DataFrame:
    """Links (a, b) between the numbers of classes (node, same, id, n_shingles, bands): enough of them to connect what all pairs within bands would connect.

    Distance (1 - similarity) is a metric. So of two members of a band whose distances to its smallest member are known to differ by
    more than a link's, neither needs to be compared with the other."""
    far = 1 - similar + 1e-9
    keys = classes.select(F.col("node").alias("id"), "n_shingles", F.explode("bands").alias("key"))
    first = keys.groupBy("key").agg(F.min(F.struct("id", "n_shingles")).alias("c"), F.max("id").alias("last"), F.count("*").alias("n")).where("c.id < last")
    first = stored(first.select("key", F.col("c.id").alias("c"), F.col("c.n_shingles").alias("n_c"), "n"), "firsts")
    shared = stored(dealt(keys, first.drop("n"), "key", "id", first).select("key", "id", "n_shingles", "c", "n_c"), "bands")
    wanted = stored(classes.select("node", "same", F.col("id").alias("doc_id")).join(shared.select(F.col("id").alias("node")).distinct(), "node", "left_semi"), "ids")
    found = shingle_lists(texts_of(docs, wanted.select("doc_id").distinct()), weights).join(wanted, ["doc_id", "same"])
    lists = stored(found.select("node", "shingles", "marks"), "shingles")
    if lists.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").head(1):  # repeated rows
        lists = stored(lists.groupBy("node").agg(F.first("shingles").alias("shingles"), F.first("marks").alias("marks")), "shingles")
    size_bound = lambda m, n: F.least(m, n) / F.greatest(m, n)  # noqa: E731  no two such sets are more similar
    pairs = shared.where((F.col("id") != F.col("c")) & (size_bound(F.col("n_shingles"), F.col("n_c")) >= 1 - far)).select(F.col("c").alias("a"), F.col("id").alias("b")).distinct()
    tested = stored(compared(lists, pairs), "tested")
    found = tested.where(F.col("j") >= 1 - far).select("a", "b")
    of = components(found)
    own, of_c = of.select(F.col("node").alias("id"), F.col("component").alias("k")), of.select(F.col("node").alias("c"), F.col("component").alias("k_c"))
    placed = shared.join(tested.select(F.col("a").alias("c"), F.col("b").alias("id"), "j"), ["c", "id"], "left").join(own, "id", "left").join(of_c, "c", "left")
    least = F.when(F.col("id") == F.col("c"), 0.0).otherwise(1 - F.coalesce("j", size_bound(F.col("n_shingles"), F.col("n_c"))))
    most = F.when(F.col("id") == F.col("c"), 0.0).otherwise(F.coalesce(1 - F.col("j"), F.lit(1.0)))
    placed = stored(placed.select("key", "id", "n_shingles", "c", F.coalesce("k", "id").alias("k"), F.coalesce("k_c", "c").alias("k_c"), least.alias("least"), most.alias("most")), "placed")
    mixed = placed.join(placed.where("k <> k_c").select("key").distinct(), "key", "left_semi").join(lists.select(F.col("node").alias("id"), "marks"), "id")
    mixed = stored(mixed, "mixed")
    apart = mixed.where("k <> k_c").select("key", F.col("id").alias("a"), F.col("n_shingles").alias("n_a"), F.col("k").alias("k_a"), F.col("least").alias("least_a"), F.col("most").alias("most_a"), F.col("marks").alias("marks_a"))
    other = mixed.where("id <> c").select("key", F.col("id").alias("b"), "n_shingles", F.col("k").alias("k_b"), (F.col("k") != F.col("k_c")).alias("apart"), "least", "most", "marks")
    can = (size_bound(F.col("n_a"), F.col("n_shingles")) >= 1 - far) & (F.col("least_a") - F.col("most") <= far) & (F.col("least") - F.col("most_a") <= far)
    can = can & can_be_similar(F.col("n_a"), F.col("marks_a"), F.col("n_shingles"), F.col("marks"), similar)
    new = (F.col("k_a") != F.col("k_b")) & (~F.col("apart") | (F.col("a") < F.col("b")))
    sizes = mixed.groupBy("key").agg(F.count_if(F.col("id") != F.col("c")).alias("n"), F.count_if(F.col("k") != F.col("k_c")).alias("n_apart"))
    rest = dealt(other, apart, "key", "b", sizes, F.col("n") * F.col("n_apart")).where(new & can)
    rest = stored(rest.select("a", "b").distinct(), "rest")
    return found.union(compared(lists, rest).where(F.col("j") >= 1 - far).select("a", "b")) if rest.head(1) else found


def grouped(docs: DataFrame, similar: float = SIMILAR, bands: int = BANDS, rows: int = ROWS, weights: str = "set") -> DataFrame:
    """doc_id, same (hash of the words or null), n_copies, component_id, kept of each document."""
    own = stored(sketches(docs, bands, rows, weights), "sketches")
    named = own.where(F.col("same").isNotNull() & F.col("doc_id").isNotNull())
    classes = named.groupBy("same").agg(F.min("doc_id").alias("id"), F.count("*").alias("n_copies"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    of = stored(components(links(docs, classes, similar, weights)), "components")
    joined = classes.select("same", "id", "n_copies", "node").join(of, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = joined.groupBy("component").agg(F.min(F.struct("id", "node")).alias("first"))
    groups = dealt(joined, first, "component", "node", of.groupBy("component").agg(F.count("*").alias("n")))
    groups = groups.select("same", "n_copies", F.col("first.id").alias("component_id"), (F.col("first.node") == F.col("node")).alias("chosen"))
    out = dealt(named.select("doc_id", "same"), groups, "same", "doc_id", classes.select("same", F.col("n_copies").alias("n")))
    out = out.select("doc_id", "same", "n_copies", "component_id", (F.col("chosen") & (F.col("doc_id") == F.col("component_id"))).alias("kept"))
    rest = own.where(F.col("same").isNull() | F.col("doc_id").isNull()).select("doc_id", "same", F.lit(1).cast("bigint").alias("n_copies"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return out.union(rest)


def near_duplicates(docs: DataFrame, similar: float = SIMILAR, bands: int = BANDS, rows: int = ROWS, weights: str = "set") -> DataFrame:
    """doc_id, n_copies (rows of the same words), component_id (smallest doc_id of its group of near duplicates), kept."""
    return grouped(docs, similar, bands, rows, weights).drop("same")


def keep_one(docs: DataFrame, similar: float = SIMILAR, weights: str = "set") -> DataFrame:
    """docs with one document of each group of near duplicates, with their own columns. Where ids are repeated, rows are told by id and
    words, and of rows that are equal in both one stays."""
    of = grouped(docs, similar, weights=weights)
    known = docs.where("doc_id is not null")
    if not known.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").head(1):
        return docs.join(of.where(~F.col("kept")).select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    told = "same"
    while told in docs.columns:
        told += "_"
    hashed = F.arrow_udf(lambda texts: pa.array([same_words(words_of(t)) or b"" for t in texts.cast(pa.binary()).to_pylist()], pa.binary()), "binary")
    gone = of.where(~F.col("kept")).select("doc_id", F.coalesce("same", F.lit(b"")).alias(told)).distinct()
    out = known.withColumn(told, hashed(F.col("text"))).join(gone, ["doc_id", told], "left_anti").dropDuplicates(["doc_id", told])
    return out.select(*docs.columns).union(docs.where("doc_id is null"))


#: The same rows by comparing all documents that share a shingle.
ORACLE = """
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ') AS g FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i) WHERE len(w) > 0 AND doc_id IS NOT NULL),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
half AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE k >= 0.8 * (x.n + y.n - k) - 1e-9),
link AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach AS (WITH RECURSIVE r(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM r JOIN link l ON r.b = l.a) SELECT a, min(b) AS least FROM r GROUP BY a),
c AS (SELECT doc_id, CASE WHEN len(w) > 0 AND doc_id IS NOT NULL THEN count(*) OVER (PARTITION BY array_to_string(w, ' '), doc_id IS NULL) ELSE 1 END AS n_copies FROM d)
SELECT doc_id, CAST(n_copies AS BIGINT) AS n_copies, least(doc_id, coalesce(least, doc_id)) AS component_id, coalesce(doc_id <= coalesce(least, doc_id), true) AS kept
FROM c LEFT JOIN reach ON reach.a = doc_id
"""
