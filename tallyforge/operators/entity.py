"""Stores of several platforms: matching, names, versions, aliases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import clean, store_name


def first_present(*columns: Column) -> Column:
    return F.coalesce(*[F.when(clean(c) != "", clean(c)) for c in columns])


def id_map(master: DataFrame, id_: str, ids: str, order: str) -> DataFrame:
    """(ext_id, id): each of a record's outer ids; of several records with one, the last."""
    return master.select(id_, order, F.explode(ids).alias("ext_id")).groupBy("ext_id").agg(F.max_by(id_, F.struct(order, id_)).alias("id"))


def _names(master: DataFrame, id_: str, names: list[Column]) -> DataFrame:
    return master.select(F.col(id_).alias("id"), F.explode(F.array(*names)).alias("name")).where("name <> ''")


def name_index(master: DataFrame, id_: str, names: list[Column]) -> DataFrame:
    """(name, id) of names that one record has; ambiguous ones are left out."""
    return _names(master, id_, names).groupBy("name").agg(F.min("id").alias("id"), F.max("id").alias("_last")).where("id = _last").drop("_last")


def name_conflicts(master: DataFrame, id_: str, names: list[Column]) -> DataFrame:
    """(name, n, ids) of names that several records have."""
    return _names(master, id_, names).groupBy("name").agg(F.countDistinct("id").alias("n"), F.array_sort(F.collect_set("id")).alias("ids")).where("n > 1")


def cascade_match(rows: DataFrame, ids: DataFrame, names: DataFrame, ext_id: Column, name: Column, found: str = "sid", own_id: Column | None = None) -> DataFrame:
    """rows with the id of their record: by outer id where there is one, else by own_id where there is one, and only then by name where there is neither. An
    id that misses never falls back to what comes after it; a blank id is none. own_id is an id of a column that may hold a record's own id or an
    outer one: one that no outer id has counts if it is the id of a record that ids or names know. ids (ext_id, id) and names (name, id) have
    a row for a key."""
    present = lambda c: F.when(clean(c) != "", clean(c))
    own = present(own_id) if own_id is not None else F.lit(None).cast("string")
    keyed = rows.withColumn("_ext", present(ext_id)).withColumn("_own", F.when(F.col("_ext").isNull(), own)).withColumn("_ext", F.coalesce("_ext", "_own")).withColumn("_name", F.when(F.col("_ext").isNull(), store_name(present(name))))
    out = keyed.join(ids.select(F.col("ext_id").cast("string").alias("_ext"), F.col("id").alias("_by_id")), "_ext", "left")
    out = out.join(names.select(F.col("name").alias("_name"), F.col("id").alias("_by_name")), "_name", "left")
    by_id = F.col("_by_id")
    if own_id is not None:
        known = ids.select("id").union(names.select("id")).distinct().select(F.col("id").cast("string").alias("_own"), F.col("id").alias("_known"))
        out = out.join(known, "_own", "left")
        by_id = F.coalesce("_by_id", "_known")
    return out.withColumn(found, F.when(F.col("_ext").isNotNull(), by_id).otherwise(F.col("_by_name"))).drop("_ext", "_own", "_name", "_by_id", "_by_name", "_known")


def unmatched(rows: DataFrame, known: DataFrame, key: str, known_key: str, reason: Column) -> DataFrame:
    """(ident, reason, n) of keys without a record, most frequent first by the caller's order."""
    missing = rows.join(known, rows[key] == known[known_key], "left_anti")
    return missing.groupBy(F.col(key).cast("string").alias("ident"), reason.alias("reason")).agg(F.count("*").alias("n"))


def four_state_diff(before: DataFrame, after: DataFrame, id_: str = "id", name: str = "nm") -> DataFrame:
    """(id, state): added, inactive (gone), renamed (by normalised names) or unchanged."""
    a, b = before.select(F.col(id_), F.col(name).alias("_a")), after.select(F.col(id_), F.col(name).alias("_b"))
    state = F.when(F.col("_in_a").isNull(), "added").when(F.col("_in_b").isNull(), "inactive").when(store_name(F.col("_a")) != store_name(F.col("_b")), "renamed").otherwise("unchanged")
    return a.withColumn("_in_a", F.lit(1)).join(b.withColumn("_in_b", F.lit(1)), id_, "full_outer").select(id_, state.alias("state"))


def apply_versions(before: DataFrame, after: DataFrame, day: Column) -> DataFrame:
    """The next master (id, name, aliases, status, first_seen, last_seen): an old name joins the aliases, records that are gone stay inactive."""
    a = before.select("id", *[F.col(c).alias(f"_{c}") for c in ("name", "aliases", "status", "first_seen", "last_seen")])
    both = a.join(after.select("id", "name").withColumn("_now", F.lit(True)), "id", "full_outer")
    old = F.coalesce("_aliases", F.array().cast("array<string>"))
    renamed = F.col("_now") & F.col("_name").isNotNull() & (store_name(F.col("_name")) != store_name(F.col("name")))
    now = F.coalesce("_now", F.lit(False))
    return both.select(
        "id",
        F.coalesce("name", "_name").alias("name"),
        F.when(renamed, F.array_union(old, F.array("_name"))).otherwise(old).alias("aliases"),
        F.when(now, "active").otherwise("inactive").alias("status"),
        F.coalesce("_first_seen", day).alias("first_seen"),
        F.when(now, day).otherwise(F.col("_last_seen")).alias("last_seen"),
    )


def store_status(c: Column, inactive: list[str]) -> Column:
    """active unless the code is one of those that close a store; unknown codes are active."""
    return F.when(clean(c).isin(inactive), "inactive").otherwise("active")


def aligned_lists(lists: list[Column], channel: Column, wanted: str, between: str = ",") -> Column:
    """Of comma lists aligned by place: an array of structs c0, c1... for the places whose channel is the wanted one."""
    split = [F.transform(F.split(c, between), lambda x: clean(x)).alias(f"c{i}") for i, c in enumerate(lists)]
    zipped = F.arrays_zip(*split, F.transform(F.split(channel, between), lambda x: clean(x)).alias("channel"))
    return F.filter(zipped, lambda x: x["channel"] == wanted)


def channel_ids(channels: Column, wanted: int) -> Column:
    """Distinct outer ids of a record's channel list [{channelId, id}] for one channel."""
    return F.array_distinct(F.transform(F.filter(channels, lambda c: c["channelId"] == wanted), lambda c: c["id"].cast("string")))


#: What is read of a directory page. A fixed value.
PAGE = "data struct<list:array<struct<storeId:string,storeName:string,storeStatus:int,channelStores:array<struct<channelId:int,channelPoiId:string,channelPoiName:string>>>>>"


def directory_rows(pages: DataFrame, channel: int, day: str, inactive: list[str] = ("2",)) -> DataFrame:
    """(id, name, status, ids, names, seen) of each store of directory pages (value: a page's JSON), with its distinct ids and names in one channel; stores
    without an id, and pages that are broken, have none."""
    stores = pages.select(F.explode(F.from_json("value", PAGE)["data"]["list"]).alias("s")).select("s.*")
    own = F.filter("channelStores", lambda c: c["channelId"] == channel)
    of = lambda field: F.coalesce(F.array_distinct(F.filter(F.transform(own, lambda c: clean(c[field])), lambda x: x != "")), F.array().cast("array<string>"))
    rows = stores.select(clean(F.col("storeId")).alias("id"), clean(F.col("storeName")).alias("name"), store_status(F.col("storeStatus").cast("string"), list(inactive)).alias("status"), of("channelPoiId").alias("ids"), of("channelPoiName").alias("names"), F.lit(day).alias("seen"))
    return rows.where("id <> ''")


def exceptions(ledger: DataFrame, prefix: str = "SG-", scope: str = "own_channel_only") -> DataFrame:
    """Ledger rows (ext_id, name) as records of their own scope, which version diffs leave out."""
    return ledger.select(F.concat(F.lit(prefix), F.col("ext_id")).alias("id"), "name", F.array("ext_id").alias("ids"), F.lit(scope).alias("scope"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def in_scope(master: DataFrame, scope: str = "both") -> DataFrame:
    """Records that version diffs look at: exceptions have a scope of their own."""
    return master.where(F.col("scope").eqNullSafe(F.lit(scope)))


def identities(header: Column, known: list[str]) -> Column:
    """Columns of a header (an array of names) that tell a store; a table without any has no stores."""
    return F.array_intersect(header, F.array(*map(F.lit, known)))


def legacy_stores(old: DataFrame) -> DataFrame:
    """(id, name, aliases) of an older master (id, name, alias, other_name): rows without an id go, the other platform's name stands in for a
    missing one, else it joins the aliases; of several rows of an id the last by name."""
    name = F.coalesce(F.when(clean(F.col("name")) != "", clean(F.col("name"))), clean(F.col("other_name")))
    alias = F.when(clean(F.col("alias")) != "", clean(F.col("alias")))
    other = F.when((clean(F.col("other_name")) != "") & (clean(F.col("other_name")) != name), clean(F.col("other_name")))
    rows = old.where(clean(F.col("id")) != "").select(clean(F.col("id")).alias("id"), name.alias("name"), F.array_compact(F.array(alias, other)).alias("aliases"))
    return rows.groupBy("id").agg(F.max(F.struct("name", "aliases")).alias("r")).select("id", "r.name", "r.aliases")
