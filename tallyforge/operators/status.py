"""Health of files and runs, and streaks of success."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.cells import days_in, strict_date


def best_streak(df: DataFrame, key: str, order: str, success: Column, failure: Column) -> DataFrame:
    """(key, best): the most successes without a failure between; other rows change nothing. Failures so far are the islands, so a
    count in each is all that is needed."""
    runs = df.withColumn("_island", F.count_if(failure).over(W.partitionBy(key).orderBy(order)))
    return runs.groupBy(key, "_island").agg(F.count_if(success).alias("run")).groupBy(key).agg(F.max("run").alias("best"))


def current_streak(df: DataFrame, key: str, order: str, success: Column, failure: Column, needed: int = 3, promoted: Column | None = None) -> DataFrame:
    """(key, streak, eligible): successes since the last failure; who was promoted once is not eligible again."""
    last = F.max(F.when(failure, F.col(order))).over(W.partitionBy(key))
    since = df.withColumn("_last", last).groupBy(key).agg(F.count_if(success & (F.col("_last").isNull() | (F.col(order) > F.col("_last")))).alias("streak"), F.bool_or(F.lit(False) if promoted is None else promoted).alias("_promoted"))
    return since.withColumn("eligible", (F.col("streak") >= needed) & ~F.coalesce("_promoted", F.lit(False))).drop("_promoted")


def file_health(files: DataFrame, now: Column, least: int = 100, hours: int = 48) -> DataFrame:
    """state of files (path, length, modificationTime) as binaryFile lists them: missing, too small, stale or ok."""
    age = (F.unix_timestamp(now) - F.unix_timestamp("modificationTime")) / 3600
    return files.withColumn("state", F.when(F.col("length").isNull(), "missing").when(F.col("length") < least, "too_small").when(age > hours, "stale").otherwise("ok"))


def run_health(status: Column, day: Column, today: Column, written: Column | None = None) -> Column:
    """success or failed for a run of today. A run without a day is judged by when its file was written: today is a success; else unknown."""
    by_file = F.when(day.isNull() & (written.cast("date") == today), "success") if written is not None else F.lit(None)
    return F.coalesce(by_file, F.when(~day.eqNullSafe(today), "unknown").when(status == "ok", "success").otherwise("failed"))


def status_summary(df: DataFrame, name: str, status: str, streak: str, promoted: str, needed: int = 3) -> DataFrame:
    """(success, failed, unknown, failed_names, ready) in one row. Names of the failed, and of those with streaks long enough that are not
    promoted yet; a report's few names, sorted."""
    ready = (F.col(streak) >= needed) & ~F.col(promoted)
    names = lambda c: F.array_sort(F.collect_list(F.when(c, F.col(name))))
    return df.agg(*[F.count_if(F.col(status) == s).alias(s) for s in ("success", "failed", "unknown")], names(F.col(status) == "failed").alias("failed_names"), names(ready).alias("ready"))


def newest_dated(files: DataFrame, path: str = "path") -> DataFrame:
    """(path, day): the file with the latest date in its name, whatever its own time, in one row; files without a date don't count."""
    day = strict_date(F.try_element_at(days_in(F.substring_index(path, "/", -1)), F.lit(1)))
    return files.select(F.col(path).alias("path"), day.alias("day")).where("day is not null").agg(F.max(F.struct("day", "path")).alias("f")).where("f is not null").select("f.path", "f.day")


def mapped(c: Column, names: dict[str, str], otherwise: str) -> Column:
    """A fixed mapping; what it lacks becomes the last."""
    out = F.lit(otherwise)
    for k, v in names.items():
        out = F.when(c == k, v).otherwise(out)
    return out
