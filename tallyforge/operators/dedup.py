"""Revisions of records: newest batch, last known values, folds, running numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.cells import RENAMES, clean, output_name

SUFFIXED = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}-(?U:\w+)$"


def newest_batch(df: DataFrame, keys: list[str], batch: str | Column) -> DataFrame:
    """All rows of each key's newest batch; duplicates within that batch stay, and so do the rows of a key without any batch."""
    b = F.col(batch) if isinstance(batch, str) else batch
    return df.withColumn("_newest", F.max(b).over(W.partitionBy(*keys))).where(b.eqNullSafe(F.col("_newest"))).drop("_newest")


def batch_order(tag: Column) -> Column:
    """Order of a batch tag: its day, then whether it has a suffix (a month's batch comes after the day's). Days are 2026-08-31, 2026-08-31-month or
    20260831; what is none of these comes first of all."""
    text = clean(tag)
    known = text.rlike(r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{8})$") | text.rlike(SUFFIXED)
    day = F.when(known, F.substring(F.replace(text, F.lit("-"), F.lit("")), 1, 8).try_cast("int"))
    return F.struct(F.coalesce(day, F.lit(0)).alias("day"), text.rlike(SUFFIXED).cast("int").alias("suffix"))


def exact_fold(df: DataFrame, same: list[str], order: list[str]) -> DataFrame:
    """The first row of those that agree in some columns."""
    rest = [c for c in df.columns if c not in same]
    if not rest:
        return df.distinct()
    # an aggregate, which is summed up before the shuffle, as a window is not
    first = df.groupBy(*same).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return first.select(*[F.col(c) if c in same else F.col(f"_r.{c}").alias(c) for c in df.columns])


def keep_last(df: DataFrame, same: list[str], order: str) -> DataFrame:
    """The last row of those that agree, with the place of the first as _first. A row without a place comes before all others."""
    values = [c for c in df.columns if c not in same]
    place = F.expr(order) if isinstance(order, str) else order
    last = F.max_by(F.struct(*values), F.struct(place.isNotNull(), place)).alias("_r") if values else None
    out = df.groupBy(*same).agg(*([last] if values else []), F.min(order).alias("_first"))
    return out.select(*same, *[F.col(f"_r.{c}").alias(c) for c in values], "_first")


def coalesce_merge(df: DataFrame, keys: list[str], columns: list[str], order: Column, present=None) -> DataFrame:
    """For each key and column the last value that is present (by default: neither null nor blank), in the order of batches and rows. A column
    without any present value keeps its first."""
    known = present or (lambda c: clean(F.col(c)) != "")
    return df.groupBy(*keys).agg(*[F.coalesce(F.max_by(F.col(c), F.when(known(c), order)), F.min_by(F.col(c), order)).alias(c) for c in columns])


def running_number(df: DataFrame, keys: list[str], order: list[str], name: str = "seq") -> DataFrame:
    """Numbers from 1 within each key, so that genuine duplicates keep identities of their own."""
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("int"))


def snapshot_number(df: DataFrame, order: list[str], name: str = "seq") -> DataFrame:
    """Numbers from 1 over a whole snapshot, in a fixed order: ranges of the order are numbered on their own, then moved by what precedes them, so
    no task holds more than its range."""
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    at = parts.withColumn("_at", F.row_number().over(W.partitionBy("_part").orderBy(*order)))
    sizes = at.groupBy("_part").agg(F.count("*").alias("_n"))  # a row for each range
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("_part", "_before")
    return at.join(F.broadcast(before), "_part").withColumn(name, (F.col("_at") + F.col("_before")).cast("int")).drop("_part", "_at", "_before")


def after_sale_kind(c: Column) -> Column:
    """What a batch marker cell holds: nothing, a day, a day with a suffix, or text that belongs elsewhere; rows are never dropped for it."""
    text = clean(c)
    return F.when(text == "", "unknown").when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), "aligned").when(text.rlike(SUFFIXED), "batch_marker").otherwise("misplaced")


def mark_after_sale(df: DataFrame, column: str, flag: str = "_售后列段疑错位") -> DataFrame:
    """With a flag, 1 where the marker cell is misplaced or unknown."""
    return df.withColumn(flag, F.when(after_sale_kind(F.col(column)).isin("misplaced", "unknown"), "1").otherwise("0"))


def kind_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(after_sale_kind(F.col(column)).alias("kind")).agg(F.count("*").alias("n"))


def dropped_ledger(dropped: DataFrame, kept: DataFrame, keys: list[str], columns: list[str], batch: str | None = None, reason: str = "superseded") -> DataFrame:
    """Rows that gave way to a kept one: (keys, reason, batch, kept_batch, changes), the changes being columns in which the dropped row has
    something else than the kept one, with both values."""
    of = [batch] if batch else []
    a, b = dropped.select(*keys, *[F.col(c).alias(f"old_{c}") for c in {*columns, *of}]), kept.select(*keys, *[F.col(c).alias(f"new_{c}") for c in {*columns, *of}])
    text = lambda c: clean(F.col(c))
    pair = lambda c: F.struct(F.lit(c).alias("column"), text(f"old_{c}").alias("old"), text(f"new_{c}").alias("new"))
    changes = F.filter(F.array(*map(pair, columns)), lambda x: (x["old"] != "") & (x["old"] != x["new"]))
    tags = [F.col(f"old_{batch}").alias("batch"), F.col(f"new_{batch}").alias("kept_batch")] if batch else []
    return a.join(b, keys).select(*keys, F.lit(reason).alias("reason"), *tags, changes.alias("changes"))


def superseded(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """All but the newest row of each key."""
    return df.withColumn("_at", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(order)))).where("_at > 1").drop("_at")


def renamed(df: DataFrame, renames: dict[str, str] = RENAMES) -> DataFrame:
    """With the platforms' column names made one, and changes of rates marked as points."""
    return df.withColumnsRenamed({c: output_name(c, renames) for c in df.columns})


def without_blank_rows(df: DataFrame) -> DataFrame:
    """Rows that have something in some cell."""
    return df.where(F.greatest(*[(clean(F.col(f"`{c}`")) != "").cast("int") for c in df.columns], F.lit(0)) > 0)


def align(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns by name: those that are missing become empty, others go."""
    return df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in columns])


def union_columns(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both with the columns of both; text that is missing is empty."""
    return a.unionByName(b, allowMissingColumns=True).na.fill("")


def replace_batch(master: DataFrame, batch: DataFrame, tag: str, value: str) -> DataFrame:
    """The master with one batch's rows replaced by new ones."""
    return union_columns(master.where(~F.col(tag).eqNullSafe(F.lit(value))), batch.withColumn(tag, F.lit(value)))
