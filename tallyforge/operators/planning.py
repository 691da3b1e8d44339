"""What should be there and isn't: calendars, gaps, gates, tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import task_key


def calendar(spark, first: str, last: str, name: str = "dt") -> DataFrame:
    return spark.sql(f"SELECT explode(sequence(DATE '{first}', DATE '{last}')) AS {name}")


def window_days(day: Column, days: int, offset: int = 1) -> Column:
    """The `days` days that end `offset` days before a day, as an array."""
    return F.sequence(F.date_sub(day, offset + days - 1), F.date_sub(day, offset))


def gap_days(df: DataFrame, group: str, day: Column) -> DataFrame:
    """(group, dt): days between each group's first and last that it has no row of."""
    present = df.select(F.col(group), day.alias("dt")).distinct()
    spans = present.groupBy(group).agg(F.min("dt").alias("lo"), F.max("dt").alias("hi"))
    return spans.select(group, F.explode(F.sequence("lo", "hi")).alias("dt")).join(present, [group, "dt"], "left_anti")


def recent_gaps(present: DataFrame, day: str, today: Column, days: int = 30, most: int = 10) -> DataFrame:
    """(n, first): number of missing days of the last `days`, and the first `most` of them."""
    wanted = present.sparkSession.range(1).select(F.explode(window_days(today, days)).alias(day))
    missing = wanted.join(present.select(day).distinct(), day, "left_anti")
    return missing.agg(F.count("*").alias("n"), F.slice(F.sort_array(F.collect_list(day)), 1, most).alias("first"))


def expand_tasks(tables: DataFrame, days: DataFrame) -> DataFrame:
    """(table, day, channel) tasks: each daily table for each day and each of its channels (an array, null if it has none); a rolling
    table once, for its last day. Both tables are small plans."""
    channels = F.explode(F.when(F.size(F.coalesce("channels", F.array().cast("array<string>"))) > 0, F.col("channels")).otherwise(F.array(F.lit(None).cast("string")))).alias("channel")
    every = F.broadcast(days.agg(F.sort_array(F.collect_set("day")).alias("_days")))  # one row, of a calendar's days
    own = F.when(F.col("kind") == "snapshot", F.slice("_days", -1, 1)).otherwise(F.col("_days"))
    return tables.join(every, F.lit(True)).where(F.size("_days") > 0).withColumn("day", F.explode(own)).select("table", "day", channels)


def plan_gaps(tasks: DataFrame, ledger: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """Tasks (task_key first) that the ledger has not completed, then the targets; of one key the first."""
    left = tasks.join(ledger.where(F.col("status").isin("validated", "no_data")).select("task_key"), "task_key", "left_anti")
    out = left.withColumn("_at", F.lit(0)).unionByName(targets.withColumn("_at", F.lit(1))) if targets is not None else left.withColumn("_at", F.lit(0))
    rest = [c for c in tasks.columns if c != "task_key"]
    return out.groupBy("task_key").agg(*[F.min_by(c, "_at").alias(c) for c in rest])


def targeted(tasks: DataFrame, days: list[str], today: Column) -> DataFrame:
    """The tasks of some days with a flag: future (refused), unsupported (a snapshot whose window ends on another day) or planned."""
    state = F.when(F.col("day") > today, "future").when((F.col("kind") == "snapshot") & ~F.col("window_end").cast("string").isin(days), "unsupported").otherwise("planned")
    return tasks.where(F.col("day").cast("string").isin(days)).withColumn("state", state)


def gap_status(tasks: DataFrame, ledger: DataFrame) -> DataFrame:
    """(status, n) of tasks; those that the ledger lacks are not_collected."""
    return tasks.join(ledger.select("task_key", "status"), "task_key", "left").groupBy(F.coalesce("status", F.lit("not_collected")).alias("status")).agg(F.count("*").alias("n"))


def gate(df: DataFrame, key: str, complete: Column, blocked: Column) -> DataFrame:
    """(key, st): complete if every row is, else blocked if any row is, else partial."""
    state = F.when(F.count("*") == F.count_if(complete), "complete").when(F.count_if(blocked) > 0, "blocked").otherwise("partial")
    return df.groupBy(key).agg(state.alias("st"))


def summary(results: DataFrame) -> DataFrame:
    """Counts of a manifest by status, in one row."""
    of = lambda s: F.count_if(F.col("status") == s)
    return results.agg(F.count("*").alias("total"), of("validated").alias("validated"), of("no_data").alias("no_data"), of("failed").alias("failed"), of("blocked").alias("blocked"))


def plan_faults(plan: DataFrame, required: list[str], identity: list[str]) -> DataFrame:
    """(missing, repeated, wrong_key): rows without a required field, keys used twice, keys that their identity doesn't give."""
    missing = F.count_if(F.greatest(*[F.col(c).isNull().cast("int") for c in required], F.lit(0)) > 0)
    return plan.agg(missing.alias("missing"), (F.count("task_key") - F.countDistinct("task_key")).alias("repeated"), F.count_if(F.col("task_key") != task_key(*[F.col(c) for c in identity])).alias("wrong_key"))


def one_to_one(tasks: DataFrame, results: DataFrame, identity: list[str]) -> DataFrame:
    """(task_key, fault) where tasks and results don't match one to one in key and identity."""
    a = tasks.groupBy("task_key").agg(F.count("*").alias("_n"), *[F.first(c).alias(f"_{c}") for c in identity])
    b = results.groupBy("task_key").agg(F.count("*").alias("_m"), *[F.first(c).alias(f"__{c}") for c in identity])
    differs = F.greatest(*[(~F.col(f"_{c}").eqNullSafe(F.col(f"__{c}"))).cast("int") for c in identity], F.lit(0)) > 0
    fault = F.when(F.col("_m").isNull(), "no result").when(F.col("_n").isNull(), "no task").when((F.col("_n") > 1) | (F.col("_m") > 1), "repeated").when(differs, "identity")
    return a.join(b, "task_key", "full_outer").select("task_key", fault.alias("fault")).where("fault is not null")


def insert_if_absent(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new whose key old doesn't have; repeats within new stay."""
    return new.join(old.select(*keys).distinct(), keys, "left_anti")


def newest_task_above(tasks: DataFrame, seen: DataFrame, id_: str, order: str) -> DataFrame:
    """The latest task that was not there before, in one row."""
    fresh = tasks.join(seen.select(id_), id_, "left_anti")
    return fresh.agg(F.max_by(F.struct(*fresh.columns), order).alias("t")).where("t is not null").select("t.*")


def task_name(day: Column, start: Column, rolling: Column) -> Column:
    text = lambda c: F.date_format(c, "yyyyMMdd")
    return F.when(rolling, F.concat_ws("-", text(start), text(day))).otherwise(text(day))


def resume(tasks: DataFrame, results: DataFrame, attempts: int = 3) -> DataFrame:
    """Tasks to run again, as they were: without a complete result, and tried fewer times than allowed."""
    last = results.groupBy("task_key").agg(F.count("*").alias("_tries"), F.max(F.col("status").isin("validated", "no_data")).alias("_done"))
    return tasks.join(last, "task_key", "left").where(~F.coalesce("_done", F.lit(False)) & (F.coalesce("_tries", F.lit(0)) < attempts)).drop("_tries", "_done")


def next_step(status_: Column, code: Column, tries: Column, committed: Column, attempts: int = 3) -> Column:
    """What to do with a task: skip what is committed or complete, stop for a change of structure or a sign-in, retry while tries are left."""
    stop = code.isin("structure_changed", "login_required", "header_mismatch")
    return F.when(committed, "skip").when(status_.isin("validated", "no_data"), "skip").when(F.coalesce(stop, F.lit(False)), "stop").when(tries < attempts, "retry").otherwise("give_up")


def source_of(available: DataFrame, order: list[str]) -> DataFrame:
    """(day, kind, path) of the first kind of source in the order that has rows, for each day; days whose sources are all empty are left
    out, and so fail what needs them."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("kind"))
    return available.where((F.col("n_rows") > 0) & (rank > 0)).groupBy("day").agg(F.min_by(F.struct("kind", "path"), rank).alias("s")).select("day", "s.kind", "s.path")


def outside_window(df: DataFrame, days: Column, first: str, last: str) -> DataFrame:
    """Rows of which some day (an array of yyyyMMdd) lies outside a window."""
    return df.where(F.exists(days, lambda d: (d < first) | (d > last)))


def missing_options(used: DataFrame, existing: DataFrame, field: str, value: str) -> DataFrame:
    """(field, missing): for each field the values in use (one, or an array of them) that it has no option for, sorted; fields that lack none are left out. Null
    and empty values need no option."""
    kind = used.schema[value].dataType.typeName()
    each = F.explode(value) if kind == "array" else F.col(value)
    wanted = used.select(field, each.alias(value)).where(F.col(value) != "").distinct()
    lacking = wanted.join(existing.select(field, value).distinct(), [field, value], "left_anti")
    return lacking.groupBy(field).agg(F.array_sort(F.collect_set(value)).alias("missing"))


def merged_options(old: Column, new: Column) -> Column:
    """The old options in their order, then the new ones sorted."""
    return F.array_union(old, F.array_sort(new))
