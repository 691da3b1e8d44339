"""A versioned store of Parquet tables: whole groups are replaced, a batch becomes visible at once, and nothing is half written.

Each attempt to write a batch has a folder of its own, `<root>/<table>/b=<batch>.<random>`, cut into partitions by day and scope where the table has
them, with only the partitions that it touches. `<root>/state/<number>.json` names, for every table, the attempt that holds each of its partitions;
readers take the newest. A state is written under another name and then renamed to the next number, which fails if that number is there: so a batch is
seen whole or not at all, and a writer that stalls has published nothing.

A writer that lost the race takes the newest state and checks that no partition that it rewrites, and no schema, has changed since the state that it began
from; then it publishes on top of it, else it is refused (Conflict). Its files are its own, so nothing that is published is touched. What no state names
any more, an attempt that was refused or a partition that was rewritten, is deleted by sweep(). Files are reached through Spark's own file system
layer; where a rename isn't atomic (some object stores), one writer at a time may publish.
"""

from __future__ import annotations

import json
import math
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY, SCOPE = "业务日期", "_scope_id"
KEEP_DAYS = 365
GRACE = 86_400  # seconds for which sweep() leaves files and states that a writer or reader may still need
FILE_BYTES = 128 << 20  # of a compacted file, about
ESCAPED = "\"#%'*/:=?\\\x7f{[]^"  # characters that Spark escapes in the names of partitions
WHOLE = ""  # the partition of tables that have none


class Conflict(ValueError):
    """A write that the store refuses."""


def group_replace(old: DataFrame, new: DataFrame, groups: DataFrame, day: str = DAY, scope: str | None = SCOPE) -> DataFrame:
    """old without the (scope, day) groups that are rewritten, and all of new. groups names those of new and those that have no data now,
    which are so cleared. All groups of a batch are given at once: a later group never deletes what an earlier one wrote."""
    keys = [day, *([scope] if scope else [])]
    hit = groups.select(*keys).union(new.select(*keys)).distinct()
    return old.join(hit, keys, "left_anti").unionByName(new, allowMissingColumns=True)


def retained(df: DataFrame, day: str, today, days: int = KEEP_DAYS) -> DataFrame:
    """Rows from `days` before today on; rows without a day (or with what is none), and future ones, stay."""
    d = F.col(day).try_cast("date")
    return df.where(d.isNull() | (d >= F.date_sub(today, days)))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def snapshot_replace(old: DataFrame | None, new: DataFrame, end: str) -> DataFrame:
    """new in place of old, whatever the scopes; refused if its window ends before the stored one. An empty snapshot replaces."""
    if old is not None and new.head(1):
        stored = [r[0] for r in old.select(end).distinct().limit(2).collect()]
        if len(stored) > 1:
            raise Conflict(f"the stored snapshot has several ends: {stored}")
        newest = new.agg(F.max(end)).first()[0]
        if stored and newest < stored[0]:
            raise Conflict(f"a snapshot of {newest} is older than the stored one of {stored[0]}")
    return new


#: What a column's name says of its unit, and of one that is still open. Fixed values.
MONEY = ["金额", "销售额", "收入", "毛利", "补贴", "退款", "费", "损失"]
OPEN = ["未决", "待核"]


def classify_column(name: str) -> tuple[str | None, str, str | None]:
    """(unit, status, source) of a column by its name: money before rates before points; an open one has no source yet."""
    unit = "元" if any(w in name for w in MONEY) else "比率" if "率" in name or "%" in name else "百分点" if name.endswith("_pp") else None
    return (unit, "pending", None) if any(w in name for w in OPEN) else (unit, "formal", "原件直取")


def classified(columns: DataFrame, name) -> DataFrame:
    """columns with unit, status and source by their names (a Column), as classify_column has them."""
    has = lambda words: F.greatest(*[F.contains(name, F.lit(w)).cast("int") for w in words], F.lit(0)) == 1
    unit = F.when(has(MONEY), "元").when(has(["率", "%"]), "比率").when(name.endswith("_pp"), "百分点")
    return columns.select("*", unit.alias("unit"), F.when(has(OPEN), "pending").otherwise("formal").alias("status"), F.when(~has(OPEN), "原件直取").alias("source"))


def pending_columns(names: list[str]) -> list[str]:
    """Columns whose meaning is still open, by their names."""
    return [c for c in names if classify_column(c)[1] == "pending"]


def covered_groups(new: DataFrame, groups: DataFrame, day: str = DAY, scope: str = SCOPE) -> DataFrame:
    """(day, scope) that a batch rewrites: the days its rows have, or the group's own where a scope has no rows at all."""
    there = new.select(day, scope).where(F.trim(F.col(day).cast("string")) != "").distinct()
    return there.union(groups.select(day, scope).join(there.select(scope).distinct(), scope, "left_anti").select(day, scope)).distinct()


class Store:
    """Tables under one root. read() never writes; apply() and replace() publish a batch: prepare() writes its files, publish() makes them visible."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        p = self._path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _children(self, path: str) -> list[tuple[str, bool, int, float]]:
        """(name, whether a folder, bytes, time of writing) of what lies in a folder."""
        fs, p = self._fs(path)
        if not fs.exists(p):
            return []
        return [(x.getPath().getName(), x.isDirectory(), x.getLen(), x.getModificationTime() / 1000) for x in fs.listStatus(p)]

    def _states(self) -> list[tuple[int, float]]:
        """(number, time of writing) of the states, newest first."""
        found = [(int(name.removesuffix(".json")), at) for name, _, _, at in self._children(f"{self.root}/state") if name.endswith(".json") and not name.startswith(".")]
        return sorted(found, reverse=True)

    def _load(self, number: int) -> dict:
        fs, p = self._fs(f"{self.root}/state/{number:012d}.json")
        file = fs.open(p)
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(file)))
        finally:
            file.close()

    def _newest(self) -> tuple[int, dict]:
        states = self._states()
        return (states[0][0], self._load(states[0][0])) if states else (0, {"batches": [], "tables": {}, "schemas": {}})

    def current(self) -> dict:
        """{"batches": [...], "tables": {name: {partition: attempt}}, "schemas": {...}} as readers see it."""
        return self._newest()[1]

    def _create(self, number: int, state: dict) -> bool:
        """Publishes a state under its number; False if the number is taken."""
        fs, p = self._fs(f"{self.root}/state/.{uuid.uuid4().hex}")
        out = fs.create(p, False)
        out.write(bytearray(json.dumps(state, ensure_ascii=False).encode()))
        out.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), self.spark._jsc.hadoopConfiguration())
        never = self.spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        never[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        target = self._path(f"{self.root}/state/{number:012d}.json")
        try:
            context.rename(p, context.makeQualified(target), never)
        except Exception:
            if not fs.exists(target):
                raise
            fs.delete(p, False)
            return False
        return True

    def read(self, table: str, only: DataFrame | None = None, at: dict | None = None) -> DataFrame | None:
        """A table, or those of its partitions that hold the groups (day, scope) of `only`, in one scan; at: a state of current()."""
        state = at or self.current()
        parts = state["tables"].get(table)
        if parts is None:
            return None
        if only is not None:
            wanted = set(self._keys(only))
            parts = {k: v for k, v in parts.items() if k in wanted}
        return self._scan(table, parts, state)

    def _scan(self, table: str, parts: dict[str, str], state: dict) -> DataFrame:
        from pyspark.sql.types import StructType

        schema = StructType.fromJson(state["schemas"][table])
        if not parts:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/{table}"
        own = [f"{base}/b={attempt}/{k}" if k else f"{base}/b={attempt}" for k, attempt in parts.items()]
        return self.spark.read.option("basePath", base).schema(schema).parquet(*own).select(*[f"`{f.name}`" for f in schema])

    def _cut(self, columns: list[str]) -> list[str]:
        return [c for c in (DAY, SCOPE) if c in columns] if DAY in columns and len(columns) > 2 else []

    def _keys(self, groups: DataFrame) -> list[str]:
        """Folders of the groups of a batch, as Spark names them: they are as few as the groups that a batch touches."""
        name = lambda v: "__HIVE_DEFAULT_PARTITION__" if v is None or v == "" else "".join(f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 32 else c for c in str(v))
        columns = [c for c in (DAY, SCOPE) if c in groups.columns]
        return ["/".join(f"{c}={name(r[c])}" for c in columns) for r in groups.select(*columns).distinct().collect()]

    def apply(self, batch: str, changes: dict[str, DataFrame], keys: dict[str, list[str]] | None = None) -> bool:
        """Publishes new contents of some tables together. A batch that was published before changes nothing and gives False; an error in
        any write, or a row whose key is blank, leaves readers with what they had."""
        return self.replace(batch, {t: (df, None) for t, df in changes.items()}, keys)

    def replace(self, batch: str, changes: dict[str, tuple[DataFrame, DataFrame | None]], keys: dict[str, list[str]] | None = None, at: dict | None = None) -> bool:
        """As apply, but of a table given with groups (day, scope) only those partitions are rewritten, and those that its rows have; a group
        without rows is cleared. All other partitions stay where they are. at: the state that the changes were made from, if they hold
        anything that was read."""
        change = self.prepare(batch, changes, keys, at)
        return change is not None and self.publish(change)

    def prepare(self, batch: str, changes: dict[str, tuple[DataFrame, DataFrame | None]], keys: dict[str, list[str]] | None = None, at: dict | None = None) -> dict | None:
        """Writes a batch's files, which nobody sees, and checks its keys in what was written. None if the batch was published before."""
        base = at or self.current()
        if batch in base["batches"]:
            return None
        schemas, attempt, own = base["schemas"], f"{batch}.{uuid.uuid4().hex[:12]}", {}
        for table, (df, _) in changes.items():
            if table in schemas and (new := sorted(set(df.columns) - {f["name"] for f in schemas[table]["fields"]})):
                raise Conflict(f"{table}: new columns {new}")
        for table, (df, groups) in changes.items():
            if table in schemas and groups is not None:
                df = df.select(*[F.col(f["name"]) if f["name"] in df.columns else F.lit(None).cast(f["type"]).alias(f["name"]) for f in schemas[table]["fields"]])
            by = self._cut(df.columns)
            df.write.partitionBy(*by).parquet(f"{self.root}/{table}/b={attempt}")
            there = self._folders(table, attempt, len(by))
            cleared = None if groups is None or not by else sorted({*self._keys(groups), *there})
            schema = schemas[table] if groups is not None and table in schemas else json.loads(df.schema.json())
            own[table] = {"there": there, "cleared": cleared, "schema": schema}
        for table, columns in (keys or {}).items():
            self._check(table, columns, self._scan(table, dict.fromkeys(own[table]["there"], attempt), {"schemas": {table: own[table]["schema"]}}))
        return {"batch": batch, "attempt": attempt, "base": base, "tables": own}

    def _check(self, table: str, keys: list[str], df: DataFrame) -> None:
        """Refuses rows without a key."""
        blank = {c: n for c, n in df.agg(*[F.count_if(F.trim(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) == "").alias(c) for c in keys]).first().asDict().items() if n}
        if blank:
            raise Conflict(f"{table}: rows without a key: {blank}")

    def publish(self, change: dict) -> bool:
        """Makes a prepared batch visible, on top of what others have published since; Conflict if they touched what it rewrites."""
        base, own = change["base"], change["tables"]
        while True:
            number, now = self._newest()
            if change["batch"] in now["batches"]:
                return False
            tables, schemas = dict(now["tables"]), dict(now["schemas"])
            for table, x in own.items():
                before, since = base["tables"].get(table, {}), now["tables"].get(table, {})
                touched = x["cleared"] if x["cleared"] is not None else before.keys() | since.keys()
                if base["schemas"].get(table) != now["schemas"].get(table) or any(before.get(k) != since.get(k) for k in touched):
                    raise Conflict(f"{table}: another batch was published meanwhile")
                kept = {} if x["cleared"] is None else {k: v for k, v in since.items() if k not in set(x["cleared"])}
                tables[table] = kept | dict.fromkeys(x["there"], change["attempt"])
                schemas[table] = x["schema"]
            if self._create(number + 1, {"batches": [*now["batches"], change["batch"]], "tables": tables, "schemas": schemas}):
                return True

    def _folders(self, table: str, attempt: str, depth: int) -> list[str]:
        """Partitions that an attempt wrote."""
        out = [WHOLE]
        for _ in range(depth):
            out = [f"{k}/{name}".lstrip("/") for k in out for name, folder, _, _ in self._children(f"{self.root}/{table}/b={attempt}/{k}".rstrip("/")) if folder]
        return out

    def files(self, table: str, at: dict | None = None) -> dict[str, list[int]]:
        """Bytes of each file of each partition of a table."""
        parts = (at or self.current())["tables"].get(table, {})
        found = {k: self._children(f"{self.root}/{table}/b={attempt}/{k}".rstrip("/")) for k, attempt in parts.items()}
        return {k: [size for name, folder, size, _ in x if not folder and name[0] not in "_."] for k, x in found.items()}

    def compact(self, batch: str, tables: list[str], file_bytes: int = FILE_BYTES) -> dict[str, int]:
        """Rewrites partitions that lie in more files than their bytes need, each into as few as that; gives how many partitions that were. Rows and all other
        partitions stay as they are; a batch that touches these partitions meanwhile makes it a Conflict, and can be followed by another try."""
        state, changes, done = self.current(), {}, {}
        for table in tables:
            files = self.files(table, state)
            need = {k: max(1, math.ceil(sum(x) / file_bytes)) for k, x in files.items()}
            loose = {k: need[k] for k, x in files.items() if len(x) > need[k]}
            if not loose:
                continue
            df = self._scan(table, {k: state["tables"][table][k] for k in loose}, state)
            by = self._cut(df.columns)
            groups = df.select(*by).distinct() if by else None
            if by and max(loose.values()) == 1:
                df = df.repartition(min(len(loose), 2000), *by)
            elif by:
                # bins: a partition of n files is dealt out to n of them
                bins = self.spark.createDataFrame(list(loose.items()), "`_k` string, `_n` int")
                at = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), self._named(F.col(c))) for c in by])
                df = df.withColumn("_k", at).join(F.broadcast(bins), "_k").withColumn("_bin", F.pmod(F.xxhash64(*df.columns), F.col("_n")))
                df = df.repartition(min(sum(loose.values()), 2000), *by, "_bin").drop("_k", "_n", "_bin")
            else:
                df = df.repartition(loose[WHOLE])
            changes[table], done[table] = (df, groups), len(loose)
        if changes:
            self.replace(batch, changes, at=state)
        return done

    @staticmethod
    def _named(c):
        """A column's value as Spark names its partition folder."""
        text = F.when(c.isNull() | (c.cast("string") == ""), F.lit("__HIVE_DEFAULT_PARTITION__")).otherwise(c.cast("string"))
        for x in ["%", *[x for x in ESCAPED if x != "%"]]:
            text = F.replace(text, F.lit(x), F.lit(f"%{ord(x):02X}"))
        return text

    def sweep(self, grace: float = GRACE, keep: int = 1) -> int:
        """Deletes attempts that no kept state names, and states that are neither among the newest `keep` nor younger than `grace` seconds; what was written
        within `grace` stays in any case, as a writer may be about to publish it. Gives the number of partition folders and attempts that went."""
        now, states = time.time(), self._states()
        kept = [number for i, (number, at) in enumerate(states) if i < keep or now - at < grace]
        named: dict[str, set[tuple[str, str]]] = {}
        for number in kept:
            for table, parts in self._load(number)["tables"].items():
                named.setdefault(table, set()).update((attempt, k) for k, attempt in parts.items())
        for number, _ in states:
            if number not in kept:
                fs, p = self._fs(f"{self.root}/state/{number:012d}.json")
                fs.delete(p, False)
        gone = 0
        for table, folder, _, _ in self._children(self.root):
            if not folder or table == "state":
                continue
            live = named.get(table, set())
            attempts = {attempt for attempt, _ in live}
            for name, _, _, at in self._children(f"{self.root}/{table}"):
                attempt, where = name.removeprefix("b="), f"{self.root}/{table}/{name}"
                if now - at < grace:
                    continue
                if attempt not in attempts:
                    doomed = [where]
                else:
                    depth = max(k.count("/") + 1 if k else 0 for a, k in live if a == attempt)
                    doomed = [f"{where}/{k}" for k in self._folders(table, attempt, depth) if (attempt, k) not in live]
                for path in doomed:
                    fs, p = self._fs(path)
                    fs.delete(p, True)
                gone += len(doomed)
        return gone

    def purge(self, batch: str, tables: list[str], today, dry_run: bool = False) -> dict[str, int]:
        """Rows that retention takes from each table; they go unless it is a dry run. Only partitions of days that go are touched."""
        state = self.current()
        frames = {t: df for t in tables if (df := self.read(t, at=state)) is not None and DAY in df.columns}
        old = {t: df.where(F.col(DAY).try_cast("date") < F.date_sub(today, KEEP_DAYS)) for t, df in frames.items()}
        gone = {t: df.count() for t, df in old.items()}
        if not dry_run and any(gone.values()):
            self.replace(batch, {t: (df.limit(0), old[t].select(*[c for c in (DAY, SCOPE) if c in df.columns]).distinct()) for t, df in frames.items() if gone[t]}, at=state)
        return gone

    def maintain(self, batch: str, to: str, tables: list[str], today, dry_run: bool = False, grace: float = GRACE) -> dict:
        """Backup, preview, purge, compaction, sweep: {"backup", "expired", "compacted", "swept"}. A dry run only previews."""
        from .writers import backup

        preview = self.purge(batch, tables, today, dry_run=True)
        if dry_run:
            return {"backup": None, "expired": preview, "compacted": {}, "swept": 0}
        saved = backup(self, to)
        gone = self.purge(batch, tables, today)
        return {"backup": saved, "expired": gone, "compacted": self.compact(f"{batch}-compact", tables), "swept": self.sweep(grace)}


def coverage_rows(groups: DataFrame, batch: str, facts: DataFrame | None = None) -> DataFrame:
    """A coverage row for each group of a batch (table, day, scope, status), loaded or not, with the number of its rows (table, day, scope)."""
    out = groups.select("table", DAY, SCOPE, "status", F.lit(batch).alias("batch"))
    if facts is None:
        return out
    n = facts.groupBy("table", DAY, SCOPE).agg(F.count("*").alias("rows"))
    return out.join(n, ["table", DAY, SCOPE], "left").withColumn("rows", F.coalesce("rows", F.lit(0)))


def lineage_rows(groups: DataFrame, batch: str) -> DataFrame:
    """A lineage row for each source file (an array of path and sha256) of each group."""
    return groups.select("table", DAY, SCOPE, F.lit(batch).alias("batch"), F.explode("files").alias("f")).select("table", DAY, SCOPE, "batch", F.col("f.path").alias("path"), F.col("f.sha256").alias("sha256"))


def with_lineage(rows: DataFrame, lineage: DataFrame, keys: list[str], order: str, take: list[str]) -> DataFrame:
    """rows with the first lineage entry of their keys."""
    first = lineage.groupBy(*keys).agg(*[F.min_by(c, order).alias(c) for c in take])
    return rows.join(first, keys, "left")


def legacy_hashes(old: DataFrame, files: DataFrame) -> DataFrame:
    """(path, sha256, noted): of old source entries (path, sha256) only hashes of 64 hexadecimal digits count; for the others the hash of the file
    itself, where it is among binaryFile rows (path, content), else null, with what stood there."""
    valid = F.lower(F.trim("sha256")).rlike("^[0-9a-f]{64}$")
    entries = old.select("path", F.when(valid, F.lower(F.trim("sha256"))).alias("_known"), F.when(~F.coalesce(valid, F.lit(False)), F.col("sha256")).alias("noted")).distinct()
    own = files.select("path", F.sha2("content", 256).alias("_own"))
    return entries.join(own, "path", "left").select("path", F.coalesce("_known", "_own").alias("sha256"), "noted")


def legacy_prepared(old: DataFrame, managed: list[str], table: str, platform: str, day: str) -> DataFrame:
    """Rows of an old fact table for a batch: without the old store's own columns, with source columns, and with each row's own day (rows without
    one stay, without a day: none is borrowed from another table)."""
    kept = old.select(*[c for c in old.columns if c not in managed and c != DAY])
    d = F.date_format(F.to_date(F.regexp_replace(F.substring(F.trim(F.col(day).cast("string")), 1, 10), "[-/.]", ""), "yyyyMMdd"), "yyyy-MM-dd") if day in kept.columns else F.lit(None).cast("string")
    return kept.withColumn(DAY, d).withColumn("数据平台", F.lit(platform)).withColumn("数据表", F.lit(table))


def cleanup_plan(raw: DataFrame, master: DataFrame, today, keep: int, day: str = "day") -> DataFrame:
    """Raw files that may go: of days that the master has, older than those to keep."""
    return raw.join(master.select(day).distinct(), day, "left_semi").where(F.col(day) < F.date_sub(today, keep))


def tag_legacy(df: DataFrame, tag: str) -> DataFrame:
    return df if tag in df.columns else df.withColumn(tag, F.lit("legacy"))
