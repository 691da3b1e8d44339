"""Read-only questions about a store: what is there, how far it reaches, where a row came from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.reports import table_status
from ..sources.store import DAY, SCOPE, Store, classified, classify_column, pending_columns, with_lineage


def store_list(master: DataFrame, id_: str | None = None) -> DataFrame:
    return (master if id_ is None else master.where(F.col("id").cast("string") == str(id_))).orderBy("id")


def matching(df: DataFrame, where: dict[str, object] | None = None, first=None, last=None, pending: tuple[str, ...] = (), n: int = 20, day: str = DAY) -> DataFrame:
    """Rows that match (values, or lists of them; a range of days), n of them in a fixed order, without columns of the store's own; pending
    metrics are null. All conditions are such as reach the scan."""
    for c, v in (where or {}).items():
        df = df.where(F.col(c).isin(list(v)) if isinstance(v, list | tuple) else F.col(c) == v)
    if first is not None:
        df = df.where(F.col(day) >= first)
    if last is not None:
        df = df.where(F.col(day) <= last)
    shown = [c for c in df.columns if not c.startswith("_")]
    return df.orderBy(*[c for c in dict.fromkeys((day, SCOPE, *shown)) if c in df.columns]).limit(n).select(*[F.lit(None).cast("string").alias(c) if c in pending else F.col(c) for c in shown])


def audited(df: DataFrame, scope: str = SCOPE) -> DataFrame:
    """(n_rows, no_scope) of a table, in one row."""
    lacks = F.count_if(F.trim(F.coalesce(F.col(scope).cast("string"), F.lit(""))) == "") if scope in df.columns else F.lit(0).cast("bigint")
    return df.agg(F.count("*").alias("n_rows"), lacks.alias("no_scope"))


class Catalog:
    def __init__(self, store: Store):
        self.store = store

    def tables(self) -> list[str]:
        return sorted(self.store.current()["tables"])

    def columns(self, table: str) -> list[tuple[str, str | None, str, str | None]]:
        return [(c, *classify_column(c)) for c in self.store.read(table).columns if not c.startswith("_")]

    def listing(self) -> DataFrame:
        """(table, column, unit, status, source) of all columns of all tables, but for the store's own."""
        state = self.store.current()
        rows = [(t, f["name"]) for t in sorted(state["tables"]) for f in state["schemas"][t]["fields"] if not f["name"].startswith("_")]
        return classified(self.store.spark.createDataFrame(rows, "`table` string, `column` string"), F.col("column"))

    def status(self, table: str) -> DataFrame:
        return table_status(self.store.read(table), F.col(DAY))

    def coverage(self, table: str, n: int = 5) -> DataFrame:
        """The newest coverage rows of a table."""
        return self.store.read("_coverage").where(F.col("table") == table).orderBy(F.desc(DAY)).limit(n)

    def batches(self, n: int = 5) -> list[str]:
        """The newest batches, the last first."""
        return self.store.current()["batches"][::-1][:n]

    def stores(self, id_: str | None = None, table: str = "_store_master") -> DataFrame:
        """The stores, or the one with an id, by id."""
        return store_list(self.store.read(table), id_)

    def get(self, table: str, where: dict[str, object] | None = None, first: str | None = None, last: str | None = None, pending: tuple[str, ...] = (), n: int = 20) -> DataFrame:
        """Rows that match, in a fixed order, without columns of the store's own; pending metrics are null."""
        return matching(self.store.read(table), where, first, last, pending, n)

    def lineage(self, rows: DataFrame, lineage: DataFrame, order: str) -> DataFrame:
        """rows with the first source of their day and scope."""
        return with_lineage(rows, lineage, [DAY, SCOPE], order, ["source"])

    def audit(self) -> DataFrame:
        """(table, n_rows, no_scope, lost, pending) of every table, in one job: `lost` are partitions that the state names and that have no files, `pending` the
        columns whose meaning is open."""
        state = self.store.current()
        rows = []
        for t in sorted(state["tables"]):
            lost = sum(not x for x in self.store.files(t, state).values())
            pending = F.array(*map(F.lit, pending_columns([f["name"] for f in state["schemas"][t]["fields"]]))).cast("array<string>")
            rows.append(audited(self.store.read(t, at=state)).select(F.lit(t).alias("table"), "n_rows", "no_scope", F.lit(lost).alias("lost"), pending.alias("pending")))
        return reduce(DataFrame.unionAll, rows)

    def overview(self, table: str, n: int = 5) -> DataFrame:
        """(n_rows, last_day, days, coverage, batches) of a table: its status, its newest coverage rows as (day, status), and the newest batches."""
        newest_ = self.coverage(table, n).agg(F.reverse(F.array_sort(F.collect_list(F.struct(F.col(DAY).cast("string").alias("day"), "status")))).alias("coverage"))
        return self.status(table).crossJoin(newest_).withColumn("batches", F.array(*map(F.lit, self.batches(n))))
