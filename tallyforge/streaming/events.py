"""Streams of events: windows with allowed lateness, sessions, revisions into a store, streaks as state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LATE = "7 days"


def event_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 100) -> DataFrame:
    """Parquet files as they come; ts becomes a timestamp that can carry a watermark."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_counts(events: DataFrame, size: str = "1 day", slide: str | None = None, late: str = LATE) -> DataFrame:
    """Events and value by window and type; a window is dropped from state once it is older than the lateness allows."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    out = events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
    return out.select(F.col("w.start").alias("start"), "event_type", "n", "value")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    out = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def deduplicated(events: DataFrame, keys: list[str], late: str = LATE) -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def streaks(events: DataFrame, failures: list[str], successes: list[str], ttl: str | None = None, late: str = LATE) -> DataFrame:
    """(user_id, streak, best) after each trigger: successes since the last failure and the most so far, in order of event_id. With a ttl (as
    "30 days"), a user without events for so long, by the watermark, is forgotten and begins anew."""
    keep = pd.Timedelta(ttl) if ttl else None

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        streak, best = state.get if state.exists else (0, 0)
        rows = pd.concat(batches).sort_values("event_id")
        for kind in rows["event_type"]:
            streak = 0 if kind in failures else streak + (kind in successes)
            best = max(best, streak)
        state.update((streak, best))
        if keep is not None:
            last = int(rows["ts"].max().timestamp() * 1000)
            state.setTimeoutTimestamp(max(last + int(keep.total_seconds() * 1000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"user_id": [key[0]], "streak": [streak], "best": [best]})

    rows = events.withWatermark("ts", late) if ttl else events
    timeout = GroupStateTimeout.EventTimeTimeout if ttl else GroupStateTimeout.NoTimeout
    return rows.select("user_id", "event_id", "event_type", "ts").groupBy("user_id").applyInPandasWithState(step, "user_id long, streak long, best long", "streak long, best long", "update", timeout)


class Held:
    """What happens to a user's events: they are held by event_id until the watermark has passed them, and then taken in order of time, so it doesn't matter
    in which trigger or how often an event came. Held events are a list with one entry for what came at once, so a call of the state is one for a user and
    trigger, not for an event; the run of successes and the best one are a value. A user has one timer, for the first event that is held, or, if none is,
    for the end of `ttl` without events, when the user is forgotten. A class for transformWithStateInPandas."""

    def __init__(self, failures: list[str], successes: list[str], ttl_ms: int | None):
        self.failures, self.successes, self.ttl_ms = failures, successes, ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "ids array<long>, times array<long>, kinds array<string>")
        self.run = handle.getValueState("run", "streak long, best long, last long, n long, timer long")

    def now(self) -> tuple[int, int, int, int, int]:
        return self.run.get() or (0, 0, -1, 0, -1)

    def timed(self, old: int, new: int) -> int:
        """Puts the user's timer from one time to another; -1 is none."""
        if old != new:
            if old >= 0:
                self.handle.deleteTimer(old)
            if new >= 0:
                self.handle.registerTimer(new)
        return new

    def handleInputRows(self, key, rows, timerValues):
        streak, best, last, n, timer = self.now()
        ids, times, kinds = [], [], []
        for part in rows:
            for own, c in ((ids, "event_id"), (times, "ms"), (kinds, "event_type")):
                own += part[c].tolist()
        self.held.appendValue((ids, times, kinds))
        first = min(times)
        waits = timer if 0 <= timer < first and timer != self.end(last, n) else first
        if timer != max(waits, 0):
            self.run.update((streak, best, last, n, self.timed(timer, max(waits, 0))))
        return iter([])

    def end(self, last: int, n: int) -> int:
        return last + self.ttl_ms if self.ttl_ms is not None and n else -1

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """The events that the watermark has passed, in order; or the end of a user who has been away for too long."""
        streak, best, last, n, timer = self.now()
        mark = timerValues.getCurrentWatermarkInMs()
        first = {}
        for entry in self.held.get():
            for i, at, kind in zip(*entry, strict=True):
                first.setdefault(i, (at, i, kind))  # of an event that came twice the first
        held = sorted(first.values())
        due = [x for x in held if x[0] <= mark]
        if len(due) == len(held):
            self.held.clear()
        elif due:
            times, ids, kinds = map(list, zip(*held[len(due) :], strict=True))
            self.held.put([(ids, times, kinds)])
        for at, _, kind in due:
            if self.ttl_ms is not None and n and at > last + self.ttl_ms:
                streak = best = n = 0
            streak = 0 if kind in self.failures else streak + (kind in self.successes)
            best, last, n = max(best, streak), max(last, at), n + 1
        over = self.ttl_ms is not None and n > 0 and len(due) == len(held) and mark >= last + self.ttl_ms
        if over:
            self.run.clear()
        else:
            self.run.update((streak, best, last, n, self.timed(-1, held[len(due)][0] if len(due) < len(held) else self.end(last, n))))
        if due or over:
            yield pd.DataFrame({"user_id": [key[0]], "at": [last], "streak": [streak], "best": [best], "n": [n], "forgotten": [over]})

    def close(self) -> None:
        pass


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_rocks(spark: SparkSession) -> SparkSession:
    """A session beside this one whose streams keep their state in RocksDB, as transformWithState needs it."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    for k in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(k, spark.conf.get(k))
    return own


def ordered_streaks(events: DataFrame, failures: list[str], successes: list[str], ttl: str | None = None, late: str = LATE) -> DataFrame:
    """(user_id, at, streak, best, n, forgotten) each time that the watermark passes events of a user: the run of successes up to `at`, by time and event_id
    whatever the order in which they came. Events that come twice while they are held count once; those that come after the lateness are dropped. With a
    ttl, a user without events for so long is forgotten, with a last row that says so. The session has RocksDB state (with_rocks)."""
    from pyspark.sql.streaming import StatefulProcessor

    kind = type("HeldProcessor", (Held, StatefulProcessor), {})
    ttl_ms = int(pd.Timedelta(ttl).total_seconds() * 1000) if ttl else None
    rows = events.withWatermark("ts", late).select("user_id", "event_id", "event_type", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"), "ts")
    schema = "user_id long, at long, streak long, best long, n long, forgotten boolean"
    return rows.groupBy("user_id").transformWithStateInPandas(kind(failures, successes, ttl_ms), schema, "Append", "EventTime")


def collected_or_not(plan: DataFrame, results: DataFrame, within: str = "1 day", late: str = "1 day") -> DataFrame:
    """(task, due, at, status) of each planned task: `collected` with the time of its result, if one comes within `within` after it was due, else
    `not_collected` once the watermark says that none can come any more. plan: (task, due), results: (task, at), both streams; a result that comes after
    the lateness doesn't count. State of both sides is dropped as the watermark passes it."""
    p = plan.withWatermark("due", late).alias("p")
    r = results.withWatermark("at", late).select(F.col("task").alias("r_task"), "at").alias("r")
    hit = (F.col("task") == F.col("r_task")) & (F.col("at") >= F.col("due")) & (F.col("at") <= F.col("due") + F.expr(f"interval {within}"))
    return p.join(r, hit, "leftOuter").select("task", "due", "at", F.when(F.col("at").isNull(), "not_collected").otherwise("collected").alias("status"))


def gathered(stream: DataFrame, mode: str, to: str, keys: list[str] | None = None) -> DataFrame:
    """What a stream has said once all that is there is read, over all its micro-batches: the last result in `complete` mode, the last row of each key in
    `update` mode, all rows in `append` mode. Each micro-batch has a folder by its number, so one that runs again after a failure replaces its own."""
    spark = stream.sparkSession

    def keep(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{to}/out/b={number}")

    q = stream.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", f"{to}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.read.schema(stream.schema.add("b", "long")).option("basePath", f"{to}/out").parquet(f"{to}/out")
    if mode == "complete":
        return rows.where(F.col("b") == F.lit(rows.agg(F.max("b")).first()[0])).drop("b")
    if mode == "update":
        last = F.max_by(F.struct(*[c for c in stream.columns if c not in keys]), "b").alias("r")
        return rows.groupBy(*keys).agg(last).select(*keys, "r.*")
    return rows.drop("b")


def into_store(stream: DataFrame, store, table: str, merge, checkpoint: str, groups=None, tries: int = 5):
    """Each micro-batch is a batch of the store, by its number: one that was published before a restart isn't published again.

    merge(old, new) gives the new contents. Where groups(new) names the (day, scope) groups that a micro-batch revises, old is only their
    partitions, and no other is rewritten; without it the whole table is. If another writer revises the same partitions meanwhile, the
    micro-batch is merged anew with what it left."""
    from ..sources.store import Conflict

    def publish(df: DataFrame, number: int) -> None:
        df.persist()  # it is read for its groups, for its rows, and by merge
        touched = groups(df) if groups else None
        for i in range(tries):
            state = store.current()
            try:
                store.replace(f"{table}-{number}", {table: (merge(store.read(table, touched, state), df), touched)}, at=state)
                break
            except Conflict:
                if i + 1 == tries:
                    raise
        df.unpersist()

    return stream.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
