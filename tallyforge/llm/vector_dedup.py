"""Operator 10: near-duplicate vectors by products of quantised tiles.

Vectors are brought to length 1 in double precision and quantised to 8-bit integers with one scale a vector; what that loses is kept
as a bound of its own (the length of the residual). A tile multiplies the integers of two blocks; by Cauchy-Schwarz the true cosine
lies within scale times scale times that product, plus or minus |residual a| + |residual b| + |residual a||residual b|. Only pairs whose upper bound
reaches the threshold are recomputed in double precision, so none is lost and none is linked below it.

Equal vectors are one class before anything else, so copies cost a count. Not every pair of blocks meets. Classes are dealt to cells by
their nearest of some pivots; a vector linked to one of a cell lies near the plane between the two pivots, so that vector goes to that
cell too, as a guest (the exact bound below). Each cell is cut into stripes, and each pair of stripes of a cell that holds a home vector is
dealt out as one piece of work, which multiplies the tiles of its blocks of BLOCK vectors. A vector is shuffled once for each stripe that its own
meets, so stripes grow with the cell, from one block to WIDE or to STRIPE_BYTES, once there are SIDES of them. In a tile a row gets its number
of links and a place in the tile's own components; pairs are never written. So what a tile writes is as long as its sides, in the
densest group too. The links of a tile's components join in graph.components().

How many cells is chosen by the comparisons they would take, judged by how many cells a sample of vectors would be a guest of (the
sample decides on speed alone). Where vectors are so spread out that all would be guests everywhere, one cell is best, and all of its
pairs of blocks meet in tiles: the work is then that of all pairs of distinct vectors.

Defined cases: vectors that are null, of length 0, or hold a null or non-finite component link with nothing; vectors of different dimensions
never link; rows of the same vec_id are each a vector, and the result has a row for each; a null vec_id gets null links' component and is
kept; labels and other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .shared import one_thread, release, stored

SIMILAR = 0.95
PIVOTS = (1, 16, 64, 256, 1024)  # numbers of cells to choose from
BLOCK = 4096  # vectors of a tile's side
ROWS = 512  # rows of a tile multiplied at once
SIDES = 200  # stripes of a cell before they become wider than a block: some 20,000 pairs
WIDE = 16  # blocks of a stripe at most
STRIPE_BYTES = 1 << 28  # a stripe in double precision, at most (a block at least)
MOST_TASKS = 20_000  # tasks that tiles are dealt to; beyond that a task has several
SAMPLE = 2000  # vectors by which the number of cells is chosen


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(8-bit integers, scales, lengths of what is lost) of rows of length 1."""
    scale = np.maximum(np.abs(x).max(1), 1e-300) / 127.0
    q = np.rint(x / scale[:, None])
    lost = np.linalg.norm(x - q * scale[:, None], axis=1) * (1 + 1e-12) + 1e-15
    return q.astype(np.int8), scale, lost


def linked(a: np.ndarray, b: np.ndarray, similar: float):
    """Rows of a and of b (each of length 1) with at least that cosine, some pairs (i, j) at a time. Products of 8-bit integers are exact in
    single precision for up to 1,000 dimensions at a time (127 * 127 * 1,000 < 2**24). A first sieve takes the largest bound of some rows,
    with room for its own rounding; then each pair has its own bounds. Pairs whose bounds leave it open are recomputed in double precision."""
    qb, sb, lb = quantised(b)
    qb, sb32 = qb.astype(np.float32), sb.astype(np.float32)
    most_b = lb.max(initial=0.0)
    for s in range(0, len(a), ROWS):
        qa, sa, la = quantised(a[s : s + ROWS])
        product = np.zeros((len(qa), len(b)), np.float32 if a.shape[1] <= 1000 else np.float64)
        for d in range(0, a.shape[1], 1000):
            product += qa[:, d : d + 1000].astype(np.float32) @ qb[:, d : d + 1000].T
        least = similar - la.max(initial=0.0) * (1 + most_b) - most_b
        scaled = product * sb32[None, :]
        rows, columns = np.nonzero(scaled >= (least / sa - 1e-5 * np.abs(least / sa))[:, None].astype(np.float32))
        for k in range(0, len(rows), 1 << 16):
            i, j = rows[k : k + (1 << 16)], columns[k : k + (1 << 16)]
            value, bound = product[i, j].astype(np.float64) * sa[i] * sb[j], la[i] * (1 + lb[j]) + lb[j] + 1e-9
            yes, open_ = value - bound >= similar, np.flatnonzero((value - bound < similar) & (value + bound >= similar))
            yes[open_] = np.einsum("ij,ij->i", a[s + i[open_]], b[j[open_]]) >= similar
            yield i[yes] + s, j[yes]


def spread(link: np.ndarray) -> np.ndarray:
    """Component of each row and then each column of a block of links: the first place among those it is joined with. Each component is
    followed from its first row; a row and a column are looked through once."""
    n, m = link.shape
    across = np.ascontiguousarray(link.T)
    out = np.arange(n + m)
    left, above = link.any(1), np.ones(m, bool)
    for r in range(n):
        if not left[r]:
            continue
        rows = np.array([r])
        while len(rows):
            out[rows], left[rows] = r, False
            columns = np.flatnonzero(link[rows].any(0) & above)
            out[n + columns], above[columns] = r, False
            rows = np.flatnonzero(across[columns].any(0) & left)
    return out


def ones(raw: list[bytes], d: int, kind: str) -> np.ndarray:
    """Rows of length 1, in double precision, of stored vectors."""
    x = np.frombuffer(b"".join(raw), kind).reshape(-1, d).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # so that squares neither vanish nor overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cleaned(vectors: DataFrame, kind: str) -> DataFrame:
    """(key, vec_id, d, same, x): the numbers of each vector as bytes, their hash of 128 bits, and a key of its own; d is null for those that
    link with nothing."""

    def each(batches):
        for batch in batches:
            lists = batch.column(2)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            numbers = lists.flatten().fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(kind)
            ends = np.cumsum(sizes)
            among = lambda x, ends=ends, sizes=sizes: (c := np.append(0, np.cumsum(x)))[ends] - c[ends - sizes]
            good = (sizes > 0) & (among(~np.isfinite(numbers)) == 0) & (among(numbers != 0) > 0)
            raw = numbers[np.repeat(good, sizes)].tobytes()
            edges = np.append(0, np.cumsum(sizes * good)) * numbers.itemsize
            same = [xxhash.xxh3_128_digest(raw[a:b]) if b > a else None for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            x = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(edges.astype(np.int32).tobytes()), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int32(), mask=~good), pa.array(same, pa.binary()), x], ["key", "vec_id", "d", "same", "x"])

    rows = vectors.select(F.monotonically_increasing_id().alias("key"), F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<float>" if kind == "<f4" else "array<double>").alias("embedding"))
    return rows.mapInArrow(each, "key bigint, vec_id bigint, d int, same binary, x binary")


def guests(x: np.ndarray, p: np.ndarray, similar: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each row, and the cells (home too) where a row linked to it can be at home.

    Let x be at home with p, y with q, and both linked. Then y.q - y.p = (y - x).(q - p) + x.q - x.p <= |y - x| |q - p|, as x is at
    least as near to p as to q; and |y - x| <= sqrt(2 - 2 * similar). So y is a guest of p if y.q - y.p is no more than that."""
    near = x @ p.T
    home = near.argmax(1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * (p @ p.T)))
    guest = near.max(1)[:, None] - near <= apart[home] * math.sqrt(2 - 2 * similar) + 1e-9
    guest[np.arange(len(x)), home] = True
    return home, guest


def dealt(vectors: DataFrame, pivots: dict[int, np.ndarray], similar: float, kind: str) -> DataFrame:
    """(cell, home, key, m, d, x): each class in its home cell, and in those that it is a guest of."""
    held = vectors.sparkSession.sparkContext.broadcast(pivots)  # 1,024 vectors a dimension at most

    def each(batches):
        one_thread()
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for d in np.unique(dims).tolist():
                part = batch.take(pa.array(np.flatnonzero(dims == d)))
                raw = part.column(3).to_pylist()
                for a in range(0, len(raw), 1024):
                    home, guest = guests(ones(raw[a : a + 1024], d, kind), held.value[d], similar)
                    rows, cells = np.nonzero(guest)
                    taken = part.slice(a, 1024).take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([pa.array(cells + (d << 20), pa.int64()), pa.array(cells == home[rows]), *taken.columns], ["cell", "home", "key", "m", "d", "x"])

    return vectors.select("key", "m", "d", "x").mapInArrow(each, "cell bigint, home boolean, key bigint, m bigint, d int, x binary")


EMPTY = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("root", pa.int64())]).empty_table()


def tile(x: np.ndarray, key: np.ndarray, home: np.ndarray, m: np.ndarray, left: np.ndarray, right: np.ndarray, similar: float) -> pa.Table:
    """(key, n, root) of the linked rows of two blocks, or of one block if `right` is `left`."""
    link, count = np.zeros((len(left), len(right)), bool), np.zeros(len(left) + len(right))
    for i, j in linked(x[left], x[right], similar):
        a, b = left[i], right[j]
        # both at home here, or the one of the smaller key: else the link is another cell's
        mine = (home[a] & home[b] | np.where(key[a] < key[b], home[a], home[b])) & (key[a] != key[b])
        i, j, a, b = i[mine], j[mine], a[mine], b[mine]
        link[i, j] = True
        count[: len(left)] += np.bincount(i, m[b], len(left))
        if right is not left:
            count[len(left) :] += np.bincount(j, m[a], len(right))
    keys = np.concatenate([key[left], key[right]])
    root = keys[spread(link)]
    kept = (count > 0) | (root != keys)
    return pa.table({"key": keys[kept], "n": count[kept].astype(np.int64), "root": root[kept]})


def tiles(placed: DataFrame, similar: float, block: int, kind: str, sides: int = SIDES) -> DataFrame:
    """(key, n, root): links of each class within a tile, and a class of its component there. A link belongs to the cell that is
    home to its class of the smaller key, so it is counted once."""
    sizes = placed.groupBy("cell").agg(F.sum(F.col("home").cast("bigint")).alias("homes"), F.sum((~F.col("home")).cast("bigint")).alias("guests"))
    room = F.expr(f"{STRIPE_BYTES} div ({block} * 8 * greatest(shiftright(cell, 20), 1))")  # the dimension is the cell's upper part
    wide = F.greatest(F.least(F.expr(f"(homes + guests) div {block * sides}"), room, F.lit(WIDE)), F.lit(1))
    parts = lambda n: F.ceil(F.col(n) / (F.col("wide") * block)).cast("int")
    sizes = stored(sizes.withColumn("wide", wide).select("cell", parts("homes").alias("hb"), parts("guests").alias("gb")).where("hb > 0"), "blocks")
    many = sizes.agg(F.sum(F.expr("hb * (hb + 1L) div 2 + hb * gb"))).first()[0] or 1
    cut = placed.join(F.broadcast(sizes), "cell")  # at most the largest of PIVOTS cells a dimension
    # stripes of a cell: 0 to hb - 1 at home, hb to hb + gb - 1 guests; a home stripe meets itself and every later one
    own = F.when(F.col("home"), F.pmod(F.xxhash64("key"), F.col("hb"))).otherwise(F.col("hb") + F.pmod(F.xxhash64("key"), F.greatest("gb", F.lit(1)))).cast("int")
    cut = cut.withColumn("own", own)
    last = F.col("hb") + F.col("gb")
    as_left = F.when(F.col("home"), F.transform(F.sequence(F.col("own"), last - 1), lambda j: F.struct(F.col("own").alias("i"), j.alias("j"), F.lit(0).alias("side")))).otherwise(F.array())
    as_right = F.when(F.least(F.col("own"), F.col("hb")) > 0, F.transform(F.sequence(F.lit(0), F.least(F.col("own"), F.col("hb")) - 1), lambda i: F.struct(i.alias("i"), F.col("own").alias("j"), F.lit(1).alias("side")))).otherwise(F.array())
    meet = cut.select("cell", "home", "key", "m", "d", "x", F.explode(F.concat(as_left, as_right)).alias("t")).select("cell", "t.i", "t.j", "t.side", "home", "key", "m", "d", "x")

    def pair(t: pa.Table) -> pa.Table:
        one_thread()
        d, side = t.column("d")[0].as_py(), t.column("side").to_numpy()
        x = np.empty((t.num_rows, d))
        for a in range(0, t.num_rows, block):
            x[a : a + block] = ones(t.column("x").slice(a, block).to_pylist(), d, kind)
        key, home, m = t.column("key").to_numpy(), t.column("home").to_numpy(zero_copy_only=False), t.column("m").to_numpy().astype(np.float64)
        cut = lambda rows: np.array_split(rows, max(1, round(len(rows) / block)))
        left = cut(np.flatnonzero(side == 0))
        if t.column("i")[0].as_py() == t.column("j")[0].as_py():
            met = [(a, b) for p, a in enumerate(left) for b in left[p:]]
        else:
            met = [(a, b) for b in cut(np.flatnonzero(side == 1)) for a in left]
        return pa.concat_tables([EMPTY, *(tile(x, key, home, m, a, b, similar) for a, b in met)])

    return meet.repartition(min(int(many), MOST_TASKS), "cell", "i", "j").groupBy("cell", "i", "j").applyInArrow(pair, "key bigint, n bigint, root bigint")


def chosen_pivots(vectors: DataFrame, similar: float, kind: str, numbers=PIVOTS) -> dict[int, np.ndarray]:
    """Pivots of each dimension: of the vectors of the least hashes the first few distinct ones, as many as leave a sample of SAMPLE vectors
    the fewest comparisons."""
    out = {}
    for r in vectors.groupBy("d").count().collect():  # a row for each dimension
        rows = vectors.where(F.col("d") == r["d"]).select("x").orderBy(F.xxhash64("x")).limit(SAMPLE + max(numbers)).collect()
        x = ones(list(dict.fromkeys(bytes(q["x"]) for q in rows)), r["d"], kind)
        best = None
        for n in sorted({min(n, len(x)) for n in numbers}):
            _, guest = guests(x[-SAMPLE:], x[:n], similar)
            work = (guest.sum(1).mean() - 0.5) / n  # of a vector: half of its home cell, and every cell where it is a guest
            if best is None or work < 0.9 * best[0]:
                best = (work, n)
        out[r["d"]] = x[: best[1]]
    return out


def near_duplicates(vectors: DataFrame, similar: float = SIMILAR, pivots=PIVOTS, block: int = BLOCK, sides: int = SIDES) -> DataFrame:
    """vec_id, n_links, component_id, kept of each vector."""
    spark = vectors.sparkSession
    kind = "<f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"
    clean = stored(cleaned(vectors, kind), "vectors")
    whole = clean.where("d is not null")
    classes = stored(whole.groupBy("d", "same").agg(F.min("key").alias("key"), F.count("*").alias("m"), F.min("vec_id").alias("least"), F.first("x").alias("x")), "classes")
    found = chosen_pivots(classes, similar, kind, pivots)
    if found:
        placed = stored(dealt(classes, found, similar, kind), "cells")
        sides = stored(tiles(placed, similar, block, kind, sides), "tiles")
        release(placed)
        counts = sides.groupBy("key").agg(F.sum("n").alias("n"))
        of = components(sides.where("key <> root").select(F.col("key").alias("a"), F.col("root").alias("b")))
    else:
        counts = spark.createDataFrame([], "key bigint, n bigint")
        of = spark.createDataFrame([], "node bigint, component bigint")
    group = classes.select("same", "key", "m", "least").join(of.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    first = group.groupBy("component").agg(F.min("least").alias("component_id"))
    group = group.join(counts, "key", "left").join(first, "component").select("same", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).cast("bigint").alias("n_links"), "component_id")
    out = whole.select("vec_id", "same").join(group, "same").select("vec_id", "n_links", "component_id")
    out = out.union(clean.where("d is null").select("vec_id", F.lit(0).cast("bigint"), "vec_id"))
    return out.select("vec_id", "n_links", F.when(F.col("vec_id").isNotNull(), F.col("component_id")).alias("component_id"), F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


ORACLE = """
WITH v AS (SELECT row_number() OVER () AS k, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT k, vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(e) > 0 AND list_sum(list_transform(e, lambda x: x * x)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.k <> b.k AND len(a.e) = len(b.e) AND list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.95),
reach AS (WITH RECURSIVE r(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM r JOIN link l ON r.b = l.a) SELECT a, min(b) AS least FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id, vec_id <= coalesce(least, vec_id) AS kept
FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN reach ON reach.a = vec_id
"""
