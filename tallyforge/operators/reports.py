"""Reports: totals, rollups, funnels, rankings, histograms, changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.cells import clean, column_name, compact_date


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b; 0 where b is 0 or null."""
    return F.coalesce(F.try_divide(a.cast("double"), F.nullif(b.cast("double"), F.lit(0.0))), F.lit(0.0))


def distinct_with_null(c: Column) -> Column:
    """Distinct values, null counted as one."""
    return F.count_distinct(c) + F.max(F.when(c.isNull(), 1).otherwise(0))


def totals(df: DataFrame, sums: list[str], store: str) -> DataFrame:
    """Sums with null as 0, and distinct stores with null as one."""
    return df.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums], distinct_with_null(F.col(store)).alias("stores"))


def net(income: Column, *costs: Column) -> Column:
    """Income less costs, null as 0."""
    out = F.coalesce(income, F.lit(0))
    for c in costs:
        out = out - F.coalesce(c, F.lit(0))
    return out


def store_rollup(df: DataFrame, key: str, amount: str, net_column: str, orders: str) -> DataFrame:
    out = df.groupBy(key).agg(F.sum(amount).alias("amount"), F.sum(net_column).alias("net"), F.sum(orders).alias("orders"))
    return out.withColumn("ticket", safe_ratio(F.col("amount"), F.col("orders"))).withColumn("margin", safe_ratio(F.col("net"), F.col("amount")))


def product_rollup(df: DataFrame, key: str, quantity: str, amount: str, category: str, order: str) -> DataFrame:
    """Quantity, amount and the last category seen."""
    return df.groupBy(key).agg(F.sum(quantity).alias("qty"), F.sum(amount).alias("amt"), F.max_by(category, order).alias("category"))


def product_stats(df: DataFrame, key: str, quantity: Column, amount: Column, store: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(quantity).cast("bigint").alias("qty"), F.sum(amount).alias("amt"), F.count_distinct(store).alias("stores"))


def funnel(df: DataFrame, by: Column, steps: dict[str, Column], user: str) -> DataFrame:
    """Rows of each step by group, and distinct users."""
    return df.groupBy(by).agg(*[F.count_if(c).alias(name) for name, c in steps.items()], F.count_distinct(user).alias("users"))


def scores(df: DataFrame, score: str, low: float = 2) -> DataFrame:
    """Mean of the scores there are, their number, and rows of a low score; a score of 0 counts as 5, as a missing one does."""
    value = F.when(F.col(score).isNull() | (F.col(score) == 0), 5).otherwise(F.col(score))
    return df.agg(F.avg(score).alias("mean"), F.count(score).alias("n"), F.count_if(value <= low).alias("low"))


def top_categories(df: DataFrame, column: str, order: str, k: int = 5) -> DataFrame:
    """The k most frequent values, ties by first appearance."""
    return df.groupBy(column).agg(F.count("*").alias("n"), F.min(order).alias("_first")).orderBy(F.desc("n"), "_first").limit(k).drop("_first")


def rate_min_volume(df: DataFrame, key: str, hit: Column, least: int = 10) -> DataFrame:
    """Share of rows that are hits, for keys with enough rows."""
    out = df.groupBy(key).agg(F.count("*").alias("total"), F.count_if(hit).alias("cancelled")).where(F.col("total") >= least)
    return out.withColumn("rate", F.round(F.col("cancelled") / F.col("total").cast("double"), 6))


def order_summary(orders: DataFrame, status: str, done: str, gone: str, amount: Column, store: str, product: Column) -> DataFrame:
    """Orders, completed and cancelled ones, amount, stores and products."""
    return orders.agg(F.count("*").alias("total"), F.count_if(F.col(status) == done).alias("completed"), F.count_if(F.col(status).contains(gone)).alias("cancelled"), F.sum(amount).alias("amount"), F.count_distinct(store).alias("stores"), F.count_distinct(product).alias("products"))


def first_nonzero(*columns: Column) -> Column:
    """The first value that is neither null nor 0, else 0."""
    return F.coalesce(*[F.nullif(c, F.lit(0).cast("double")) for c in columns], F.lit(0).cast("double"))


def completion(df: DataFrame, key: str, done: Column) -> DataFrame:
    out = df.groupBy(key).agg(F.count("*").alias("total"), F.count_if(done).alias("completed"))
    return out.withColumn("rate", F.round(100 * safe_ratio(F.col("completed"), F.col("total")), 1))


def hour_histogram(df: DataFrame, hour: Column, amount: Column | None = None) -> DataFrame:
    """(hour, n, share, amount) for all 24 hours: 0 where nothing happened, share in percent of all, to one place."""
    hours = df.sparkSession.range(24).select(F.col("id").alias("hour"))
    found = df.groupBy(hour.cast("bigint").alias("hour")).agg(F.count("*").alias("n"), F.sum(F.lit(0.0) if amount is None else amount).alias("amount"))
    total = found.agg(F.sum("n").alias("total"))
    out = hours.join(F.broadcast(found), "hour", "left").join(F.broadcast(total), F.lit(True))  # 24 rows and one
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    return out.select("hour", n.alias("n"), F.round(100 * safe_ratio(n, F.col("total")), 1).alias("share"), F.round(F.coalesce("amount", F.lit(0.0)), 2).alias("amount"))


def day_over_day(df: DataFrame, day: Column, value: Column) -> DataFrame:
    """(d, v, prev, chg): a day's value against the calendar day before; null where that day has none or 0."""
    daily = df.groupBy(day.alias("d")).agg(F.sum(value).alias("v"))
    before = daily.select(F.date_add("d", 1).alias("d"), F.col("v").alias("prev"))
    change = F.try_divide((F.col("v") - F.col("prev")).cast("double"), F.nullif(F.col("prev").cast("double"), F.lit(0.0)))
    return daily.join(before, "d", "left").select("d", "v", "prev", F.round(change, 6).alias("chg"))


def topk_share(df: DataFrame, key: str, value: Column, k: int = 10) -> DataFrame:
    """(key, v, rn, share): the k largest sums with rank and share of all. The sums are taken once; only k rows are ranked."""
    sums = df.groupBy(key).agg(F.sum(value).alias("v"))
    total = sums.agg(F.sum("v").alias("tot"))
    top = sums.orderBy(F.desc("v"), key).limit(k)
    ranked = top.withColumn("rn", F.row_number().over(W.orderBy(F.desc("v"), key)))
    return ranked.join(F.broadcast(total), F.lit(True)).select(key, "v", "rn", F.round(F.col("v").cast("double") / F.col("tot").cast("double"), 6).alias("share"))


def with_total(df: DataFrame, label: str, text: str, sums: list[str]) -> DataFrame:
    """The rows and one more with the sums, labelled as the total, in one pass; rows that agree in all else are one."""
    return subtotals(df, [[c for c in df.columns if c not in sums], []], {c: F.sum(c) for c in sums}, {label: text}).select(*df.columns)


def subtotals(df: DataFrame, levels: list[list[str]], aggregates: dict[str, Column], labels: dict[str, str]) -> DataFrame:
    """Aggregates at several levels (lists of columns) in one pass, by grouping sets; a column that a level adds up over has its label there, or null."""
    by = list(dict.fromkeys(c for level in levels for c in level)) or list(labels)
    rows = df.groupingSets([[F.col(c) for c in level] for level in levels], *by).agg(*[a.alias(n) for n, a in aggregates.items()], *[F.grouping(c).alias(f"_over_{c}") for c in by])
    shown = [F.when(F.col(f"_over_{c}") == 1, F.lit(labels[c])).otherwise(F.col(c)).alias(c) if c in labels else F.col(c) for c in by]
    return rows.select(*shown, *aggregates)


def daily_sets(df: DataFrame, day: str, id_: str) -> DataFrame:
    """(day, bucket, ids): the distinct ids (whole numbers from 0) of each day as bit maps, which can be united over any span of days."""
    at = F.col(id_).cast("bigint") + 1
    rows = df.where(F.col(id_).isNotNull()).select(day, F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("_at"))
    return rows.groupBy(day, "bucket").agg(F.bitmap_construct_agg("_at").alias("ids"))


def distinct_over(sets: DataFrame, spans: DataFrame, day: str, by: list[str]) -> DataFrame:
    """(by..., n): exact numbers of distinct ids over spans of days (by..., first, last), from the bit maps of daily_sets alone."""
    s = F.broadcast(spans)
    inside = sets.join(s, (sets[day] >= s["first"]) & (sets[day] <= s["last"]))
    return inside.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("ids")).alias("_n")).groupBy(*by).agg(F.sum("_n").alias("n"))


def less_fixed(c: Column, amount: float = 0.5) -> Column:
    """A commission less a fixed amount, to four places; blanks stay null."""
    return F.round(c.try_cast("double") - amount, 4)


def flags(rules: list[tuple[str, Column]], most: int) -> Column:
    """Texts of the rules that hold, at most so many."""
    return F.slice(F.array_compact(F.array(*[F.when(c, F.lit(text)) for text, c in rules])), 1, most)


def items_summary(items: Column, n: int = 3) -> Column:
    """The first n items (structs of name and count) as nameXcount, names of 20 letters at most, and how many there are in all, if more."""
    text = F.transform(F.slice(items, 1, n), lambda i: F.concat(F.left(F.coalesce(i["name"], F.lit("")), F.lit(20)), F.lit("x"), F.coalesce(i["count"].cast("string"), F.lit("0"))))
    return F.concat(F.array_join(text, "; "), F.when(F.size(items) > n, F.concat(F.lit(" 等"), F.size(items).cast("string"), F.lit("件"))).otherwise(""))


def group_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def table_status(df: DataFrame, day: Column) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.max(day).alias("last_day"), F.count_distinct(day).alias("days"))


def table_summary(df: DataFrame, day: str, batch: str) -> DataFrame:
    """(n_rows, n_columns, first_day, last_day, days, batches) of a table, in one row; batches: the batch dates in it, in order."""
    return df.agg(F.count("*").alias("n_rows"), F.lit(len([c for c in df.columns if not c.startswith("_")])).alias("n_columns"), F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count_distinct(day).alias("days"), F.array_sort(F.collect_set(batch)).alias("batches"))


def coverage(master: DataFrame, facts: DataFrame, key: str, fact_key: str, row_key: str) -> DataFrame:
    """(key, status, row_cnt): no_data for records without facts."""
    n = facts.groupBy(F.col(fact_key).alias(key)).agg(F.count(row_key).alias("row_cnt"))
    return master.select(key).join(n, key, "left").select(key, F.when(F.coalesce("row_cnt", F.lit(0)) == 0, "no_data").otherwise("validated").alias("status"), F.coalesce("row_cnt", F.lit(0)).cast("bigint").alias("row_cnt"))


def net_by(df: DataFrame, key: str, income: str, costs: list[str]) -> DataFrame:
    """Income less costs for each key, null as 0."""
    return df.groupBy(key).agg(F.sum(net(F.col(income), *map(F.col, costs))).alias("net"))


def channels(df: DataFrame, key: str, sums: list[str]) -> DataFrame:
    """Sums for each channel, null as 0, the first sum's largest first."""
    return df.groupBy(F.coalesce(key, F.lit("")).alias(key)).agg(*[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in sums]).orderBy(F.desc(sums[0]), key)


def refunds(df: DataFrame, amount: str, problems: DataFrame) -> DataFrame:
    """(refunded, n, problems) in one row: sum of what was paid back, null as 0, its orders, and problem orders."""
    paid = df.agg(F.coalesce(F.sum(amount), F.lit(0)).alias("refunded"), F.count("*").alias("n"))
    return paid.join(problems.agg(F.count("*").alias("problems")), F.lit(True))  # one row each


def full_report(orders: DataFrame, status: str, done: str, gone: str, fen: str, store: str, metrics: DataFrame, amount: str) -> DataFrame:
    """(metric, value) of the whole report: orders, completed and cancelled ones, amount in yuan of fen, active stores (blank is none), stores with
    metrics, and the sum of their amounts, which are text with thousands; what is no number counts as nothing."""
    o = orders.agg(
        F.count("*").cast("double").alias("orders"),
        F.count_if(F.col(status) == done).cast("double").alias("completed"),
        F.count_if(F.col(status).contains(gone)).cast("double").alias("cancelled"),
        F.round(F.coalesce(F.sum(fen), F.lit(0)).cast("double") / 100, 2).alias("amount"),
        F.count_distinct(F.nullif(F.col(store).cast("string"), F.lit(""))).cast("double").alias("active_stores"),
    )
    number = F.replace(F.trim(amount), F.lit(","), F.lit("")).try_cast("decimal(28,4)")
    m = metrics.agg(F.count("*").cast("double").alias("covered_stores"), F.round(F.coalesce(F.sum(number), F.lit(0)).cast("double"), 2).alias("store_amount"))
    one = o.join(m, F.lit(True))  # one row each
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in one.columns])
    return one.select(F.explode(pairs).alias("p")).select("p.*")


def top_stores(orders: DataFrame, brand: Column, store: str, fen: str, k: int = 10, unknown: str = "未知") -> DataFrame:
    """(store, orders, amount): the k stores of a brand with most orders, and their amounts in yuan."""
    rows = orders.where(brand).groupBy(F.coalesce(store, F.lit(unknown)).alias("store")).agg(F.count("*").alias("orders"), (F.coalesce(F.sum(fen), F.lit(0)).cast("double") / 100).alias("amount"))
    return rows.orderBy(F.desc("orders"), "store").limit(k)


def split_range(df: DataFrame, column: str, first, last) -> tuple[DataFrame, DataFrame]:
    """Rows within a range and those outside it; nulls are outside."""
    inside = F.coalesce(F.col(column).between(first, last), F.lit(False))
    return df.where(inside), df.where(~inside)


def on_day(df: DataFrame, column: str, day: str) -> DataFrame:
    """Rows whose date, however it is written, is the day (yyyyMMdd)."""
    return df.where(compact_date(F.col(column)) == day)


def summary_flag(df: DataFrame, column: str, value: str = "汇总", flag: str = "_是否汇总行") -> DataFrame:
    """With a flag, 1 on a table's own total rows: those with the value in the column (named with either kind of parentheses)."""
    at = next((c for c in df.columns if column_name(c) == column_name(column)), None)
    return df.withColumn(flag, F.lit(0) if at is None else (clean(F.col(f"`{at}`")) == value).cast("int"))


def without_summaries(df: DataFrame, flag: str = "_是否汇总行") -> DataFrame:
    """Rows that may be summed."""
    return df.where(F.col(flag) == 0)


def path_counts(df: DataFrame, path: str, status: str) -> DataFrame:
    """(path, success, failed, skipped) of a run."""
    return df.groupBy(path).agg(*[F.count_if(F.col(status) == s).alias(s) for s in ("success", "failed", "skipped")])


def newest(df: DataFrame, by: list[str], then: list[str], n: int = 5) -> DataFrame:
    """The n newest rows, in a fixed order."""
    return df.orderBy(*map(F.desc, by), *then).limit(n)
