"""Operator 2: benchmark decontamination with suffix arrays of the training text.

The documents of an Arrow batch are dealt into shards of some megabytes. A shard's words become numbers (0: no word of the
benchmark), and its suffix array holds every place from which at least as many benchmark words follow as the shortest item needs: no
other suffix can match. All test suffixes (one at each word of each item) are searched together by binary search, a word deeper each
round, to the depth of a window, which leaves the range of suffixes that begin with that window: its locations. A longest verbatim match
is a run of windows that follow each other in document and item, so its length is not bounded by the search. The document words that
windows cover are hit, and documents of too many are removed.

Texts stay where they are read: no shuffle. A benchmark of up to about BLOCK_WORDS words is one block, the only thing broadcast. A larger one
is dealt into blocks by hashed id; driver and workers hold one at a time, each block is a pass over the documents, and what a pass found
(rows with hits alone) is joined to the documents at the end.

Defined cases: null and empty texts have no words and are clean; items without words are never found; items with fewer words than a
window are windows of their own; rows of the benchmark with a null id are left out, since they cannot be named; an id with several
texts is found if any is; repeated documents give repeated rows; other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import slices, stored, words_of

WINDOW = 13
BLOCK_WORDS = 1_000_000


class TestBlock:
    """Some items of a benchmark: their words, numbered from 1, and the windows to be found."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.names, words, starts, need = [], [], [], []
        for name, text in items:
            own = words_of(text)
            if not own:
                continue
            first = len(words)
            words += [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in own]
            # every suffix of the item is a test suffix; one that is long enough begins a window
            whole = min(window, len(own))
            need += [whole if i <= len(own) - whole else 0 for i in range(len(own))]
            starts += [len(self.names)] * (len(words) - first)
            self.names.append(name)
        self.words = np.array(words, np.int32)  # of all items, one after another
        self.item = np.array(starts, np.int32)  # of each test suffix
        self.need = np.array(need, np.int32)  # words of its window, 0 if it has none
        ends = np.searchsorted(self.item, np.arange(len(self.names)), "right") if len(self.names) else np.empty(0, int)
        self.left = (ends[self.item] - np.arange(len(words))).astype(np.int32) if len(words) else np.empty(0, np.int32)  # words up to the item's end
        self.shortest = int(self.need[self.need > 0].min()) if len(words) else 0


class Shard:
    """Suffix array over the words of some documents; a 0 stands between two documents and for every word that no item has."""

    def __init__(self, texts: list[list[bytes]], block: TestBlock):
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.sizes + 1)])[:-1]
        numbers = np.zeros(int((self.sizes + 1).sum()) + block.window, np.int32)
        get = block.vocabulary.get
        for at, words in zip(self.begin.tolist(), texts, strict=True):
            if words:
                numbers[at : at + len(words)] = np.fromiter(map(get, words, repeat(0)), np.int32, len(words))
        self.numbers = numbers
        # how many words follow each place before the next 0
        zero = np.flatnonzero(numbers == 0)
        places = np.flatnonzero(numbers)
        run = zero[np.searchsorted(zero, places)] - places
        long_enough = run >= max(1, block.shortest)
        # a suffix ends at the next 0, so what must be ranked is the rest of the stretches that hold a place
        in_run = np.repeat(long_enough[(starts := np.flatnonzero(np.diff(places, prepend=-2) > 1))], np.diff(np.append(starts, len(places))))
        self.array = self.sort(places[long_enough], places[in_run], block.window)

    def sort(self, places: np.ndarray, near: np.ndarray, depth: int) -> np.ndarray:
        """Places in the order of their first `depth` words, by doubling: from the ranks of 1, 2, 4... words come those of twice as
        many. `near` are the places of all words that these suffixes hold."""
        if not len(places):
            return places
        rank, wide = self.numbers.astype(np.int64), 1
        while wide < depth:
            after = np.where(near + wide < len(rank), rank[np.minimum(near + wide, len(rank) - 1)], 0)
            key = rank[near] * (int(rank.max()) + 1) + after
            rank = np.zeros_like(rank)
            rank[near] = np.unique(key, return_inverse=True)[1] + 1
            wide *= 2
        return places[np.argsort(rank[places], kind="stable")]

    def search(self, block: TestBlock) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each test suffix: how many words of it occur here at the longest, up to a window, and the range of the suffix array
        that has them."""
        n, tests = len(self.array), len(block.words)
        low, high, depth = np.zeros(tests, np.int64), np.full(tests, n, np.int64), np.zeros(tests, np.int32)
        alive = np.arange(tests) if n else np.arange(0)
        for d in range(block.window):
            alive = alive[block.left[alive] > d]
            if not len(alive):
                break
            wanted = block.words[alive + d]
            first = self.bound(low[alive], high[alive], wanted, d, False)
            last = self.bound(first, high[alive], wanted, d, True)
            found = last > first
            alive = alive[found]
            low[alive], high[alive], depth[alive] = first[found], last[found], d + 1
        return depth, low, high

    def bound(self, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, d: int, after: bool) -> np.ndarray:
        """Binary search in each range for the first suffix whose word d is not below (after: is above) the wanted one."""
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            mid = (low + high) // 2
            word = self.numbers[self.array[np.minimum(mid, len(self.array) - 1)] + d]
            right = open_ & ((word <= wanted) if after else (word < wanted))
            low = np.where(right, mid + 1, low)
            high = np.where(open_ & ~right, mid, high)
        return low

    def windows(self, block: TestBlock) -> tuple[np.ndarray, np.ndarray]:
        """(place, test suffix) of every occurrence of a window."""
        depth, low, high = self.search(block)
        whole = np.flatnonzero((block.need > 0) & (depth >= block.need))
        many = high[whole] - low[whole]
        at = self.array[np.repeat(low[whole], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
        return at, np.repeat(whole, many)

    def matches(self, block: TestBlock) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, test suffix, words) of every longest verbatim match of a window's length at least: one that neither begins a word earlier
        nor ends a word later. They are in the order of places."""
        at, test = self.windows(block)
        if not len(at):
            return at, test, test
        order = np.lexsort((at, at - test, block.item[test]))
        at, test = at[order], test[order]
        first = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(test, prepend=-2) != 1) | (np.diff(block.item[test], prepend=-1) != 0))
        words = np.diff(np.append(first, len(at))) - 1 + block.need[test[first]]
        order = np.argsort(at[first], kind="stable")
        return at[first][order], test[first][order], words[order]


def numbered(benchmark: DataFrame, block_words: int) -> tuple[DataFrame, int]:
    """(items (i, text, block), number of blocks)."""
    items = benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("i"), "text")
    words = items.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+|[A-Z]+")).cast("bigint"))).first()[0] or 0
    many = max(1, -(-words // block_words))
    return items.withColumn("block", F.pmod(F.xxhash64("i"), F.lit(many)).cast("int")), many


def block_of(items: DataFrame, number: int, window: int) -> TestBlock:
    """One block, which the driver holds until it is broadcast."""
    return TestBlock([(r["i"], (r["text"] or "").encode()) for r in items.where(F.col("block") == number).orderBy("i", "text").select("i", "text").toLocalIterator()], window)


MATCH = "doc_word int, item_id string, item_word int, n_words int"
HITS = f"n_words bigint, hit array<int>, items array<string>, matches array<struct<{', '.join(x.replace(' ', ':') for x in MATCH.split(', '))}>>"
FOUND = pa.schema([("n_words", pa.int64()), ("hit", pa.list_(pa.int32())), ("items", pa.list_(pa.string())), ("matches", pa.list_(pa.struct([("doc_word", pa.int32()), ("item_id", pa.string()), ("item_word", pa.int32()), ("n_words", pa.int32())])))])


def scanner(held):
    """An Arrow function of a text to its hits by a broadcast block."""

    def scan(texts: pa.Array) -> pa.Array:
        block = held.value
        count: list[int] = []
        hit: list = [[]] * len(texts)
        items: list = [[]] * len(texts)
        matches: list = [[]] * len(texts)
        for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]), 0, len(texts)):
            words, a = [words_of(t) for t in part.column(0).cast(pa.binary()).to_pylist()], len(count)
            count += map(len, words)
            if not block.shortest:
                continue
            shard = Shard(words, block)
            at, test, n = shard.matches(block)
            docs = np.searchsorted(shard.begin, at, "right") - 1
            item_word = test - np.searchsorted(block.item, block.item[test]) if len(test) else test
            edges = np.flatnonzero(np.diff(docs, prepend=-1, append=-1))
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                d = int(docs[i])
                own = at[i:j] - int(shard.begin[d])
                cover = np.zeros(int(shard.sizes[d]) + 1, np.int32)
                np.add.at(cover, own, 1)
                np.add.at(cover, own + n[i:j], -1)
                names = [block.names[x] for x in block.item[test[i:j]].tolist()]
                hit[a + d] = np.flatnonzero(np.cumsum(cover)[:-1] > 0).tolist()
                items[a + d] = sorted(set(names))
                matches[a + d] = [dict(zip(("doc_word", "item_id", "item_word", "n_words"), x, strict=True)) for x in zip(own.tolist(), names, item_word[i:j].tolist(), n[i:j].tolist(), strict=True)]
        columns = [pa.array(x, f.type) for x, f in zip((count, hit, items, matches), FOUND, strict=True)]
        return pa.StructArray.from_arrays(columns, fields=list(FOUND))

    return F.arrow_udf(scan, HITS)


def hits(docs: DataFrame, benchmark: DataFrame, column: str = "hits", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs with a column struct<n_words, hit: numbers of the hit words, items: ids of the items with an occurring window, matches: longest
    verbatim matches and where they are>."""
    spark = docs.sparkSession
    items, many = numbered(benchmark, block_words)
    if many == 1:
        return docs.withColumn(column, scanner(spark.sparkContext.broadcast(block_of(items, 0, window)))(F.col("text")))
    row = column + "_row"
    base, found = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), []
    for number in range(many):
        held = spark.sparkContext.broadcast(block_of(items, number, window))
        own = base.select(row, scanner(held)(F.col("text")).alias("h"))
        found.append(stored(own.where((F.size("h.hit") > 0) | F.lit(number == 0)).select(row, "h.*"), "found"))
        held.destroy()
    each = reduce(DataFrame.union, found)
    merged = each.groupBy(row).agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit")))).alias("hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("matches"))).alias("matches"),
    )
    return base.join(merged.select(row, F.struct("n_words", "hit", "items", "matches").alias(column)), row).drop(row)


def contaminated(h):
    """The rule of the contract for a column made by hits()."""
    return (F.size(h["hit"]) > 0) & (F.size(h["hit"]) * 20 >= h["n_words"])


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the contaminated documents, with their own columns."""
    column = "hits"
    while column in docs.columns:
        column += "_"
    return hits(docs, benchmark, column).where(~contaminated(F.col(column))).drop(column)


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, doc_word, item_id, item_word, n_words) of each longest verbatim match between a document and an item."""
    return hits(docs.select("doc_id", "text"), benchmark, "h", window, block_words).select("doc_id", F.explode("h.matches").alias("m")).select("doc_id", "m.*")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each document, and the words of its longest verbatim match and the place
    of the first such (0 and null where there is none)."""
    h = F.col("h")
    longest = F.array_max(F.transform(h["matches"], lambda m: F.struct(m["n_words"].alias("n"), (-m["doc_word"]).alias("at"))))
    return hits(docs.select("doc_id", "text"), benchmark, "h").select(
        "doc_id",
        h["n_words"].alias("n_words"),
        F.size(h["hit"]).cast("bigint").alias("n_hit"),
        F.size(h["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(h["items"]), ","), 256).alias("items_sha256"),
        contaminated(h).alias("contaminated"),
        F.coalesce(longest["n"], F.lit(0)).cast("bigint").alias("longest_match"),
        (-longest["at"]).cast("bigint").alias("longest_at"),
    )


ORACLE = """
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
wins AS (SELECT item_id, i AS j, least(13, len(w)) AS n, array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS s
  FROM items, LATERAL (SELECT unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM wins),
grams AS (SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s FROM words, sizes, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i) WHERE len(w) >= n),
found AS (SELECT DISTINCT doc_id, i, j, n, item_id FROM grams JOIN wins USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s FROM found GROUP BY doc_id),
runs AS (SELECT doc_id, min(i) - 1 AS spot, count(*) + n - 1 AS k FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, item_id, n, i - j ORDER BY i) AS g FROM found) GROUP BY doc_id, item_id, n, i - j, g),
longest AS (SELECT doc_id, max(k) AS k, arg_min(spot, (-k) * 1000000000 + spot) AS spot FROM runs GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
  CAST(coalesce(longest.k, 0) AS BIGINT) AS longest_match, CAST(longest.spot AS BIGINT) AS longest_at
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN longest USING (doc_id)
"""
