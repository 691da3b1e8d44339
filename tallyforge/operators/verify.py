"""Checks of what was stored against its sources."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import numbers_equal


def bag_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of a that b lacks, duplicates counted."""
    return a.exceptAll(b)


def tolerance_counts(a: Column, b: Column, df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(numbers_equal(a, b)).alias("eq"), F.count("*").alias("n"))


def reconcile(source: DataFrame, stored: DataFrame, group: list[str], exact: list[str], numbers: list[str], blanked: list[str] = (), tolerance: float = 1e-9) -> DataFrame:
    """(group..., code, n): how the rows of a source and a store match, as bags.

    MATCHED rows agree in all columns, numbers up to a share of the larger one (`tolerance`; of 0, up to itself). Of the rest, a stored row that
    differs from a source row in blanks alone, where the source has something, is LEGACY_BLANKED; any of `numbers` and `blanked` may be
    so. Others are MISSING (source only) or FABRICATED (store only).

    What is equal to the last digit cancels out first, in one aggregation over both sides. Only what is left, as distinct rows with their
    counts, meets row by row, within its group and exact columns (ids): a healthy store has few such rows, and copies are one row."""
    columns = [*group, *exact, *numbers, *blanked]
    one = lambda df, n: df.select(*columns, F.lit(n).alias("_n"))
    both = one(source, 1).union(one(stored, -1)).groupBy(*columns).agg(F.sum(F.when(F.col("_n") > 0, 1).otherwise(0)).alias("_a"), F.sum(F.when(F.col("_n") < 0, 1).otherwise(0)).alias("_b"))
    same = both.groupBy(*group).agg(F.sum(F.least("_a", "_b")).alias("n")).where("n > 0").select(*group, F.lit("MATCHED").alias("code"), "n")
    left = both.where("_a <> _b").select(*group, *exact, *[F.col(c).cast("double").alias(c) for c in numbers], *[F.col(c).cast("string").alias(c) for c in blanked], (F.col("_a") - F.col("_b")).alias("_over"))
    block = F.struct(*group, *exact)
    rest = left.select(*group, F.to_json(block, {"ignoreNullFields": "false"}).alias("_block"), F.array(*[F.col(c) for c in numbers]).cast("array<double>").alias("_x"), F.array(*map(F.col, blanked)).cast("array<string>").alias("_t"), "_over")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in left.select(*group).schema)

    def match(batches):
        import pyarrow as pa

        types = None
        counts: dict[tuple, int] = {}
        block, of, rows = None, (), ([], [], [])

        def finish():
            for code, n in residue(*rows, tolerance).items() if rows[0] else ():
                counts[(*of, code)] = counts.get((*of, code), 0) + n
            for r in rows:
                r.clear()

        def out():
            columns = [pa.array([k[i] for k in counts], t) for i, t in enumerate([*types, pa.string()])]
            made = pa.RecordBatch.from_arrays([*columns, pa.array(counts.values(), pa.int64())], [*group, "code", "n"])
            counts.clear()
            return made

        # rows of a block follow each other, over the end of a batch too
        for batch in batches:
            types = [batch.schema.field(g).type for g in group]
            for *own, b, over, x, t in zip(*(batch.column(c).to_pylist() for c in [*group, "_block", "_over", "_x", "_t"]), strict=True):
                if b != block:
                    finish()
                    block, of = b, own
                for r, v in zip(rows, (over, x, t), strict=True):
                    r.append(v)
            if len(counts) > 10_000:
                yield out()
        finish()
        if counts:
            yield out()

    found = rest.repartition("_block").sortWithinPartitions("_block").mapInArrow(match, f"{schema}, code string, n bigint")
    return same.union(found).groupBy(*group, "code").agg(F.sum("n").cast("bigint").alias("n")).where("n > 0")


def residue(over: list[int], numbers: list[list], texts: list[list], tolerance: float) -> dict[str, int]:
    """Counts by code of the rows of one block: `over` is how many more the source has of a row (fewer: negative). As many stored rows as can be are
    matched with equal source rows; of the rest, as many as can be with such as they are blank of. Both are maximum flows between rows with
    their counts, so no row is given to one partner while another one needs it; who can be whose partner is found by buckets of texts and blanks, and
    within them by a sorted number, not by comparing all."""
    source, store = {i: n for i, n in enumerate(over) if n > 0}, {i: -n for i, n in enumerate(over) if n < 0}
    texts = [["" if t is None or not str(t).strip() else t for t in row] for row in texts]
    out = {}
    for code, blanks in (("MATCHED", False), ("LEGACY_BLANKED", True)):
        out[code] = most_matched(source, store, partners(source, store, numbers, texts, tolerance, blanks)) if source and store else 0
    return out | {"MISSING": sum(source.values()), "FABRICATED": sum(store.values())}


def partners(source: dict[int, int], store: dict[int, int], numbers: list[list], texts: list[list], tolerance: float, blanks: bool) -> list[tuple]:
    """Edges (stored row, source row) of rows that agree, or with `blanks` agree where the stored row isn't blank. Where no number says more, all of a
    bucket go through one hub, (stored row, hub) and (hub, source row), a hub being a tuple."""
    from bisect import bisect_left, bisect_right
    from collections import defaultdict

    close = lambda x, y: x == y or (x is not None and y is not None and abs(x - y) <= tolerance * (1 if x == 0 or y == 0 else max(abs(x), abs(y))))
    patterns = defaultdict(list)
    for j in store:
        patterns[tuple(x is not None or not blanks for x in numbers[j]), tuple(bool(t) or not blanks for t in texts[j])].append(j)
    edges = []
    for n, (pattern, rows) in enumerate(patterns.items()):
        places, shown = [k for k, x in enumerate(pattern[0]) if x], [k for k, x in enumerate(pattern[1]) if x]
        bucket = lambda i, places=places, shown=shown: (*(numbers[i][k] is None for k in places), *(texts[i][k] for k in shown))
        here, there = defaultdict(list), defaultdict(list)
        for j in rows:
            here[bucket(j)].append(j)
        for i in source:
            if (b := bucket(i)) in here:
                there[b].append(i)
        for m, (b, found) in enumerate(there.items()):
            given = [k for k in places if numbers[found[0]][k] is not None]
            if not given:
                edges += [(j, (n, m)) for j in here[b]] + [((n, m), i) for i in found]
                continue
            best = max(given, key=lambda k: len({numbers[i][k] for i in found}))
            found.sort(key=lambda i: numbers[i][best])
            values = [numbers[i][best] for i in found]
            for j in here[b]:
                x = numbers[j][best]
                reach = 2 * tolerance * max(abs(x), 1)
                edges += [(j, i) for i in found[bisect_left(values, x - reach) : bisect_right(values, x + reach)] if all(close(numbers[i][k], numbers[j][k]) for k in given)]
    return edges


def most_matched(source: dict[int, int], store: dict[int, int], edges: list[tuple]) -> int:
    """The largest flow from stored rows to source rows over edges (see partners), which is taken from the counts of both; by levels and blocking flows."""
    from collections import deque

    START, END = object(), object()
    room: dict = {}
    ways: dict = {}

    def link(a, b, n):
        for x, y, k in ((a, b, n), (b, a, 0)):
            if (x, y) not in room:
                room[x, y] = 0
                ways.setdefault(x, []).append(y)
            room[x, y] += k

    stored, sources = {a for a, _ in edges if not isinstance(a, tuple)}, {b for _, b in edges if not isinstance(b, tuple)}
    for j in stored:
        link(START, ("j", j), store[j])
    for i in sources:
        link(("i", i), END, source[i])
    total = sum(store[j] for j in stored)
    for a, b in edges:
        link(("h", a) if isinstance(a, tuple) else ("j", a), ("h", b) if isinstance(b, tuple) else ("i", b), total)
    flow = 0
    while edges:
        level, queue = {START: 0}, deque([START])
        while queue:
            a = queue.popleft()
            for b in ways[a]:
                if room[a, b] and b not in level:
                    level[b] = level[a] + 1
                    queue.append(b)
        if END not in level:
            break
        at, path = dict.fromkeys(level, 0), [START]
        while path:
            a = path[-1]
            if a is END:
                n = min(room[x, y] for x, y in zip(path, path[1:], strict=False))
                for x, y in zip(path, path[1:], strict=False):
                    room[x, y] -= n
                    room[y, x] += n
                flow += n
                path = [START]
                continue
            while at[a] < len(ways[a]) and not (room[a, b := ways[a][at[a]]] and level.get(b) == level[a] + 1):
                at[a] += 1
            if at[a] < len(ways[a]):
                path.append(ways[a][at[a]])
            else:
                path.pop()
                if path:
                    at[path[-1]] += 1
    for j in stored:
        store[j] = room[START, ("j", j)]
    for i in sources:
        source[i] = room[("i", i), END]
    for side in (source, store):
        for k in [k for k, n in side.items() if not n]:
            del side[k]
    return flow


def reconcile_windows(source: DataFrame, stored: DataFrame, group: list[str], day: str, exact: list[str], numbers: list[str], blanked: list[str] = (), tolerance: float = 1e-9) -> DataFrame:
    """As reconcile by group and day, for tables whose days are assigned anew on the way: a group that fails on some day is matched again over all
    of its days together, and then has null for the day."""
    daily = reconcile(source, stored, [*group, day], exact, numbers, blanked, tolerance)
    fails = daily.where(is_defect(F.col("code"))).select(*group).distinct()
    pooled = reconcile(source.join(fails, group, "left_semi"), stored.join(fails, group, "left_semi"), group, exact, numbers, blanked, tolerance)
    kind = daily.schema[day].dataType
    return daily.join(fails, group, "left_anti").select(*group, day, "code", "n").union(pooled.select(*group, F.lit(None).cast(kind).alias(day), "code", "n"))


#: Up to so many columns `closest` looks rows up by all sets of columns.
FEW_COLUMNS = 6


def token(c: str) -> Column:
    """A value as text, in which null differs from all others."""
    return F.when(F.col(c).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(c).cast("string")))


def closest(residue: DataFrame, source: DataFrame, group: list[str], id_: str, columns: list[str], hot: int = 1000) -> DataFrame:
    """(group..., id, source_id, equal): for each left-over row the source row of its group with most equal columns (null equals null; of several the
    largest id), and their number; (null, 0) in a group without source rows. Of any size: no pairs of a whole group are made.

    The largest set of columns in which any source row agrees with a row is the answer, so with few columns each set is an index: a row for each combination of
    values with its largest id. Both sides meet in it once for each set, whatever number of rows share a value. Sets grow with 2 to the number of
    columns; with more than FEW_COLUMNS see closest_of_many_columns, which takes `hot`."""
    if len(columns) > FEW_COLUMNS:
        return closest_of_many_columns(residue, source, group, id_, columns, hot)
    names = [f"_{k}" for k in range(len(columns))]
    of = lambda df, name: df.select(*group, F.col(id_).alias(name), *[token(c).alias(n) for c, n in zip(columns, names, strict=True)])
    a, b = of(residue, "id"), of(source, "source_id").join(residue.select(*group).distinct(), group, "left_semi")
    # of a source row, the values that are asked for; rows that have the same are one
    for n in names:
        b = b.join(a.select(*group, n).distinct().withColumn(f"{n}asked", F.lit(True)), [*group, n], "left")
    b = b.select(*group, "source_id", *[F.when(F.col(f"{n}asked"), F.col(n)).otherwise("").alias(n) for n in names])
    b = b.groupBy(*group, *names).agg(F.max("source_id").alias("source_id"))
    sets = [[k for k in range(len(names)) if i >> k & 1] for i in range(1 << len(names))]
    one = lambda i, s: F.struct(F.lit(i).alias("_set"), *[(F.col(n) if k in s else F.lit("")).alias(n) for k, n in enumerate(names)])
    asked = a.select(*group, "id", F.explode(F.array(*[one(i, s) for i, s in enumerate(sets)])).alias("_s")).select(*group, "id", "_s.*")
    own = F.array(*[F.when(reduce(lambda x, y: x & y, [F.col(names[k]) != "" for k in s], F.lit(True)), one(i, s)) for i, s in enumerate(sets)])
    held = b.select(*group, "source_id", F.explode(F.array_compact(own)).alias("_s")).select(*group, "source_id", "_s.*")
    held = held.groupBy(*group, "_set", *names).agg(F.max("source_id").alias("source_id"), F.lit(True).alias("_there"))
    found = asked.join(held, [*group, "_set", *names], "left")
    best = found.groupBy(*group, "id").agg(F.max(F.when(F.col("_there"), F.struct(F.bit_count("_set").alias("equal"), "source_id"))).alias("_b"))
    return best.select(*group, "id", F.col("_b.source_id").alias("source_id"), F.coalesce("_b.equal", F.lit(0)).alias("equal"))


def closest_of_many_columns(residue: DataFrame, source: DataFrame, group: list[str], id_: str, columns: list[str], hot: int = 1000) -> DataFrame:
    """As closest, for any number of columns.

    An inverted index of (group, column, value) has the source rows of each value that a left-over row asks for. Values of at most `hot` rows bring their rows,
    which are compared in all columns. What isn't found so shares only more frequent values, so a row that has more equal columns than frequent
    values is settled. Of the others, each distinct combination of frequent values meets once each one that source rows have: how many these are the
    data say, so with many columns of many frequent values this is work of all pairs of combinations."""
    row = [*group, "id"]
    a = residue.select(*group, F.col(id_).alias("id"), F.array(*map(token, columns)).alias("_x"))
    b = source.join(residue.select(*group).distinct(), group, "left_semi").select(*group, F.col(id_).alias("source_id"), F.array(*map(token, columns)).alias("_y"))
    asked = a.select(*row, "_x", F.posexplode("_x").alias("_c", "_v"))
    held = b.select(*group, "source_id", "_y", F.posexplode("_y").alias("_c", "_v"))
    value = [*group, "_c", "_v"]
    sizes = held.select(*value).join(asked.select(*value).distinct(), value, "left_semi").groupBy(*value).agg(F.count("*").alias("_n"))
    same = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False)).cast("int")), F.lit(0), lambda n, k: n + k)
    best = lambda df: df.groupBy(*row).agg(F.max(F.struct("equal", "source_id")).alias("_b"))

    rare, common = sizes.where(F.col("_n") <= hot).select(*value), sizes.where(F.col("_n") > hot).select(*value)
    near = best(asked.join(rare, value).join(held.join(rare, value), value).select(*row, "source_id", same(F.col("_x"), F.col("_y")).alias("equal")))
    frequent = asked.join(common, value).groupBy(*row).agg(F.collect_set("_c").alias("_often"))
    open_ = a.join(frequent, row).join(near, row, "left").where(F.coalesce("_b.equal", F.lit(0)) <= F.size("_often"))
    open_ = open_.select(*row, F.transform("_x", lambda x, k: F.when(F.array_contains("_often", k), x)).alias("_x"))
    # of a source row, its frequent values alone; rows that have the same are one
    parts = held.join(common, value).groupBy(*group, "source_id", "_y").agg(F.collect_set("_c").alias("_cs"))
    parts = parts.select(*group, "source_id", F.transform("_y", lambda y, k: F.when(F.array_contains("_cs", k), y)).alias("_y")).groupBy(*group, "_y").agg(F.max("source_id").alias("source_id"))
    pairs = open_.select(*group, "_x").distinct().join(parts, group).groupBy(*group, "_x").agg(F.max(F.struct(same(F.col("_x"), F.col("_y")).alias("equal"), "source_id")).alias("_b"))
    far = open_.join(pairs, [*group, "_x"]).select(*row, "_b")
    none = best(a.select(*row).join(b.groupBy(*group).agg(F.max("source_id").alias("source_id")), group).withColumn("equal", F.lit(0)))
    found = near.union(far).union(none).groupBy(*row).agg(F.max("_b").alias("_b"))
    return a.select(*row).distinct().join(found, row, "left").select(*row, F.col("_b.source_id").alias("source_id"), F.coalesce("_b.equal", F.lit(0)).alias("equal"))


def issue_code(differing: Column, ids: list[str], blank: Column) -> Column:
    """Code of a stored row by the columns (an array) in which it differs from the nearest source row: none, only blanks, only ids, or others; null
    columns: no row is near."""
    only_ids = F.forall(differing, lambda c: c.isin(ids) | F.lit(False))
    return F.when(differing.isNull(), "VALUE_MISMATCH").when(F.size(differing) == 0, F.lit(None)).when(blank, "LEGACY_BLANKED").when(only_ids, "LONG_ID_LOSS").otherwise("VALUE_MISMATCH")


#: Columns that every fact table must have, and those that need no catalog entry. Fixed values.
NEEDED = ["业务日期", "_scope_id", "_batch_id"]
UNLISTED = ["业务日期", "数据平台", "数据表", "采集时间", "渠道口径", "门店标准ID"]


def presence(columns: DataFrame, catalog: DataFrame, coverage: DataFrame, facts: DataFrame) -> DataFrame:
    """(code, table, column, day): needed columns (table, column) that a table lacks, columns without a catalog entry (table, column), and days of facts
    (table, day) without a coverage row."""
    none = F.lit(None).cast("string")
    wanted = columns.select("table").distinct().withColumn("column", F.explode(F.array(*map(F.lit, NEEDED))))
    lacking = wanted.join(columns, ["table", "column"], "left_anti").select(F.lit("SCHEMA_MISSING_COLUMN").alias("code"), "table", "column", none.alias("day"))
    shown = columns.where(~F.col("column").startswith("_") & ~F.col("column").isin(UNLISTED))
    unlisted = shown.join(catalog, ["table", "column"], "left_anti").select(F.lit("CATALOG_MISSING_COLUMN"), "table", "column", none)
    uncovered = facts.select("table", "day").distinct().join(coverage.select("table", "day"), ["table", "day"], "left_anti").select(F.lit("COVERAGE_MISSING"), "table", none, F.col("day").cast("string"))
    return lacking.union(unlisted).union(uncovered)


def is_defect(code: Column) -> Column:
    return ~code.isin("MATCHED", "LEGACY_BLANKED", "SOURCE_MISSING")


def fingerprint(df: DataFrame) -> DataFrame:
    """(n, hash): rows, and a sum of row hashes that no order changes."""
    return df.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("hash"))


def hash_sample(df: DataFrame, seed: str, keys: list[Column], n: int) -> DataFrame:
    """The n rows of the least seeded hashes: the same on every run."""
    return df.orderBy(F.sha2(F.concat_ws("|", F.lit(seed), *[k.cast("string") for k in keys]), 256)).limit(n)


def batch_days(df: DataFrame, cell: Column, day: str) -> DataFrame:
    """(bad, sample): cells whose days are not just the batch's own, and the first of them."""
    from ..functions.cells import days_in

    wrong = (clean_days := days_in(cell)) != F.array(F.lit(day))
    return df.agg(F.count_if(wrong).alias("bad"), F.min(F.when(wrong, F.array_join(clean_days, ","))).alias("sample"))


def all_on_day(df: DataFrame, cell: Column, day: str) -> DataFrame:
    """(ok): every non-blank date is the day, and there is one."""
    from ..functions.cells import blank_to_null, compact_date

    d = F.when(blank_to_null(cell).isNotNull(), compact_date(cell))
    return df.agg((F.coalesce(F.bool_and(d == day), F.lit(False)) & (F.count(d) > 0)).alias("ok"))


def blank_keys(df: DataFrame, keys: list[str], optional: list[str] = ()) -> DataFrame:
    """(missing, empty): rows that lack a key which is not optional, and rows that lack all."""
    from ..functions.cells import is_blank

    lacks = [is_blank(F.col(c)).cast("int") for c in keys if c not in optional]
    every = [is_blank(F.col(c)).cast("int") for c in keys]
    return df.agg(F.count_if(F.greatest(*lacks, F.lit(0)) > 0).alias("missing"), F.count_if(F.least(*every, F.lit(1)) > 0).alias("empty"))


def faults_of_headers(files: DataFrame, header: str, baseline: list[str]) -> DataFrame:
    """files with (place, found_name, wanted) for each place where an ordered header (an array column) differs from its baseline; null is no column."""
    pairs = F.arrays_zip(F.col(header).alias("found_name"), F.array(*map(F.lit, baseline)).alias("wanted"))
    each = files.select(*files.columns, F.posexplode(pairs).alias("place", "_p"))
    return each.select(*files.columns, "place", "_p.found_name", "_p.wanted").where(~F.col("found_name").eqNullSafe(F.col("wanted")))


def acceptance(files: DataFrame, baseline: list[str], evidence: DataFrame, encodings: tuple[str, ...] = ("gbk", "utf-8-sig")) -> DataFrame:
    """One row for each raw file (binaryFile rows: path, content): (path, bytes, sha256, width, n_rows, faults). Faults: zero_bytes; unreadable in every encoding;
    header_order, the header isn't the baseline in its order; width, a row has more cells than the header; no_evidence, nothing but a header, and no
    evidence (path) that the day has no data."""
    from ..sources.readers import table_rows, text_or_none

    def each(contents: pa.Array) -> pa.Array:
        out = []
        for raw in contents:
            text = text_or_none(raw.as_py() or b"", encodings)
            rows = list(table_rows(text)) if text is not None else []
            out.append({"read": text is not None, "header": [c.strip() for c in rows[0]] if rows else None, "widest": max(map(len, rows[1:]), default=0), "n_rows": max(len(rows) - 1, 0)})
        return pa.array(out, pa.struct([("read", pa.bool_()), ("header", pa.list_(pa.string())), ("widest", pa.int32()), ("n_rows", pa.int64())]))

    told = F.arrow_udf(each, "read boolean, header array<string>, widest int, n_rows bigint")("content")
    rows = files.select("path", F.length("content").alias("bytes"), F.sha2("content", 256).alias("sha256"), told.alias("t"))
    rows = rows.join(evidence.select("path").distinct().withColumn("_proof", F.lit(True)), "path", "left")
    wanted, empty = F.array(*map(F.lit, baseline)), F.col("bytes") == 0
    there = F.col("t.read") & ~empty
    faults = [("zero_bytes", empty), ("unreadable", ~F.col("t.read")), ("header_order", there & ~F.col("t.header").eqNullSafe(wanted)), ("width", there & (F.col("t.widest") > F.size(F.coalesce("t.header", F.array().cast("array<string>"))))), ("no_evidence", there & (F.col("t.n_rows") == 0) & F.col("_proof").isNull())]
    return rows.select("path", "bytes", "sha256", F.size("t.header").alias("width"), F.col("t.n_rows").alias("n_rows"), F.array_compact(F.array(*[F.when(bad, F.lit(n)) for n, bad in faults])).alias("faults"))


def processing_state(df: DataFrame, key: str, changed: Column, complete: Column) -> DataFrame:
    return df.groupBy(key).agg(F.when(F.bool_or(changed), "blocked").when(F.bool_and(complete), "ready").otherwise("pending").alias("state"))
