"""Each operator as a query over the tables of a folder, and the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cells, texts
from ..operators import dedup, entity, planning, reports, status, verify
from ..sources import store
from .registry import ORACLES, QUERIES, query  # noqa: F401

day = lambda c: F.col(c).cast("date")
money = lambda c: F.col(c).cast("decimal(18,2)")


# -- revisions ---------------------------------------------------------------------------------------------------------------------------------


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM (
  SELECT *, max(l_shipdate) OVER (PARTITION BY l_orderkey, l_linenumber) AS m FROM lineitem) t WHERE l_shipdate = m""")
def newest_batch(t):
    return dedup.newest_batch(t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"), ["l_orderkey", "l_linenumber"], "l_shipdate")


@query("""SELECT user_id, event_type, max_by(value, event_id) FILTER (WHERE event_id % 3 <> 0) AS last_value,
  max_by(ts, event_id) AS last_ts, count(*) AS n FROM events GROUP BY user_id, event_type""")
def coalesce_merge(t):
    e = t("events").withColumn("last_value", F.when(F.col("event_id") % 3 != 0, F.col("value"))).withColumn("last_ts", F.col("ts"))
    merged = dedup.coalesce_merge(e, ["user_id", "event_type"], ["last_value", "last_ts"], F.col("event_id"))
    return merged.join(e.groupBy("user_id", "event_type").agg(F.count("*").alias("n")), ["user_id", "event_type"])


@query("""SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS INT) AS seq FROM lineitem""")
def seq_no(t):
    return dedup.running_number(t("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]).select("l_orderkey", "l_linenumber", "seq")


@query("""SELECT l_returnflag, l_linestatus, l_quantity, l_discount, l_tax, l_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linestatus, l_quantity, l_discount, l_tax
  ORDER BY l_orderkey, l_linenumber, l_shipdate, l_partkey) rn FROM lineitem) t WHERE rn = 1""")
def exact_fold(t):
    same = ["l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax"]
    return dedup.exact_fold(t("lineitem"), same, ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey"]).select(*same, "l_orderkey")


@query("""SELECT user_id, event_type, max(event_id) AS event_id, max_by(value, event_id) AS value, min(event_id) AS first_id FROM events GROUP BY user_id, event_type""")
def keep_last(t):
    e = t("events").select("user_id", "event_type", "value", "event_id")
    return dedup.keep_last(e, ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id", "value", F.col("_first").alias("first_id"))


@query("""SELECT kind, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' WHEN o_orderkey % 5 < 3 THEN 'aligned'
  WHEN o_orderkey % 5 = 3 THEN 'batch_marker' ELSE 'misplaced' END AS kind FROM orders) t GROUP BY kind""")
def after_sale_kinds(t):
    d = F.date_format("o_orderdate", "yyyy-MM-dd")
    k = F.col("o_orderkey") % 5
    return dedup.kind_counts(t("orders").select(F.when(k == 0, " ").when(k < 3, d).when(k == 3, F.concat(d, F.lit("-month"))).otherwise(F.col("o_orderpriority")).alias("cell")), "cell")


@query("""SELECT l_orderkey, l_linenumber, l_shipdate FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC) rn
  FROM lineitem) t WHERE rn > 1""")
def superseded(t):
    return dedup.superseded(t("lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate").select("l_orderkey", "l_linenumber", "l_shipdate")


@query("""SELECT c_custkey, o.c_acctbal AS old, o.c_acctbal + 1 AS new FROM customer o WHERE c_custkey % 4 = 0""")
def drop_ledger(t):
    c = t("customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    new = c.withColumn("c_acctbal", F.when(F.col("c_custkey") % 4 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    led = dedup.dropped_ledger(c, new, ["c_custkey"], ["c_acctbal", "c_mktsegment"])
    return led.select("c_custkey", F.explode("changes").alias("x")).select("c_custkey", F.col("x.old").cast("double").alias("old"), F.col("x.new").cast("double").alias("new"))


# -- stores ------------------------------------------------------------------------------------------------------------------------------------

def part_name():
    return [F.lower(F.trim(F.concat_ws(" ", "p_name", "p_brand")))]


@query("""SELECT lower(trim(concat(p_name, ' ', p_brand))) AS name, min(p_partkey) AS id FROM part
  GROUP BY lower(trim(concat(p_name, ' ', p_brand))) HAVING count(DISTINCT p_partkey) = 1""")
def name_index(t):
    return entity.name_index(t("part"), "p_partkey", part_name())


@query("""SELECT lower(trim(concat(p_name, ' ', p_brand))) AS name, count(DISTINCT p_partkey) AS n FROM part
  GROUP BY lower(trim(concat(p_name, ' ', p_brand))) HAVING count(DISTINCT p_partkey) > 1""")
def name_conflicts(t):
    return entity.name_conflicts(t("part"), "p_partkey", part_name()).select("name", "n")


@query("""SELECT coalesce(p.id, q.id) AS id, CASE WHEN p.id IS NULL THEN 'added' WHEN q.id IS NULL THEN 'inactive'
  WHEN p.nm <> q.nm THEN 'renamed' ELSE 'unchanged' END AS state
  FROM (SELECT c_custkey AS id, c_name AS nm FROM customer WHERE c_custkey % 10 <> 0) p FULL OUTER JOIN
  (SELECT c_custkey AS id, CASE WHEN c_custkey % 11 = 0 THEN concat(c_name, 'X') ELSE c_name END AS nm FROM customer WHERE c_custkey % 7 <> 0) q ON p.id = q.id""")
def four_state_diff(t):
    c = t("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nm"))
    after = c.where("id % 7 <> 0").withColumn("nm", F.when(F.col("id") % 11 == 0, F.concat("nm", F.lit("X"))).otherwise(F.col("nm")))
    return entity.four_state_diff(c.where("id % 10 <> 0"), after)


@query("""SELECT coalesce(p.id, q.id) AS id, coalesce(q.nm, p.nm) AS name, CASE WHEN p.nm <> q.nm THEN p.nm ELSE '' END AS aliases,
  CASE WHEN q.id IS NULL THEN 'inactive' ELSE 'active' END AS status, CASE WHEN p.id IS NULL THEN DATE '2026-01-02' ELSE DATE '2026-01-01' END AS first_seen,
  CASE WHEN q.id IS NULL THEN DATE '2026-01-01' ELSE DATE '2026-01-02' END AS last_seen
  FROM (SELECT c_custkey AS id, c_name AS nm FROM customer WHERE c_custkey % 10 <> 0) p FULL OUTER JOIN
  (SELECT c_custkey AS id, CASE WHEN c_custkey % 11 = 0 THEN concat(c_name, 'X') ELSE c_name END AS nm FROM customer WHERE c_custkey % 7 <> 0) q ON p.id = q.id""")
def alias_append(t):
    c = t("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    after = c.where("id % 7 <> 0").withColumn("name", F.when(F.col("id") % 11 == 0, F.concat("name", F.lit("X"))).otherwise(F.col("name")))
    one = F.lit("2026-01-01").cast("date")
    before = c.where("id % 10 <> 0").select("id", "name", F.array().cast("array<string>").alias("aliases"), F.lit("active").alias("status"), one.alias("first_seen"), one.alias("last_seen"))
    return entity.apply_versions(before, after, F.lit("2026-01-02").cast("date")).select("id", "name", F.array_join("aliases", ",").alias("aliases"), "status", "first_seen", "last_seen")


@query("""WITH k AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS VARCHAR) END AS mid,
  CASE WHEN event_id % 3 <> 2 THEN concat('NAME_', CAST(user_id % 25 AS VARCHAR)) END AS nm FROM events),
  im AS (SELECT CAST(s_suppkey AS VARCHAR) AS mid, s_suppkey AS sid FROM supplier),
  ni AS (SELECT replace(n_name, 'NATION', 'NAME') AS nm, 1000 + n_nationkey AS sid FROM nation WHERE n_nationkey % 5 <> 0)
  SELECT k.event_id, CASE WHEN k.mid IS NOT NULL THEN im.sid WHEN k.nm IS NOT NULL THEN ni.sid END AS sid
  FROM k LEFT JOIN im ON k.mid = im.mid LEFT JOIN ni ON k.mid IS NULL AND k.nm = ni.nm""")
def cascade_match(t):
    ids = entity.id_map(t("supplier").withColumn("ids", F.array(F.col("s_suppkey").cast("string"))), "s_suppkey", "ids", "s_name")
    names = t("nation").where("n_nationkey % 5 <> 0").select(F.replace("n_name", F.lit("NATION"), F.lit("NAME")).alias("name"), (F.lit(1000) + F.col("n_nationkey")).cast("bigint").alias("id"))
    ext = F.when(F.col("event_id") % 3 == 0, F.col("user_id").cast("string"))
    name = F.when(F.col("event_id") % 3 != 2, F.concat(F.lit("NAME_"), (F.col("user_id") % 25).cast("string")))
    return entity.cascade_match(t("events").select("event_id", "user_id"), ids, names, ext, name).select("event_id", "sid")


@query("""SELECT ident, reason, count(*) AS n FROM (SELECT CAST(e.user_id AS VARCHAR) AS ident, CASE WHEN e.user_id >= 120 THEN 'not in master' ELSE 'placeholder' END AS reason
  FROM events e LEFT JOIN supplier s ON e.user_id = s.s_suppkey WHERE s.s_suppkey IS NULL) t GROUP BY ident, reason""")
def unmatched(t):
    return entity.unmatched(t("events").select("user_id"), t("supplier").select("s_suppkey"), "user_id", "s_suppkey", F.when(F.col("user_id") >= 120, "not in master").otherwise("placeholder"))


@query("""SELECT o_custkey, array_to_string(list_sort(list(CAST(o_orderkey AS VARCHAR))), ',') AS ids, CAST(count(*) AS BIGINT) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey""")
def channel_lists(t):
    o = t("orders").groupBy("o_custkey").agg(F.array_join(F.collect_list(F.col("o_orderkey").cast("string")), ",").alias("ids"), F.array_join(F.collect_list("o_orderpriority"), ",").alias("channels"))
    hit = entity.aligned_lists([F.col("ids")], F.col("channels"), "1-URGENT")
    own = o.select("o_custkey", F.transform(hit, lambda x: x["c0"]).alias("x")).where(F.size("x") > 0)
    return own.select("o_custkey", F.array_join(F.array_sort("x"), ",").alias("ids"), F.size("x").cast("bigint").alias("n"))


# -- plans and gates -----------------------------------------------------------------------------------------------------------------------------


@query("""WITH b AS (SELECT o_orderpriority p, min(CAST(o_orderdate AS DATE)) lo, max(CAST(o_orderdate AS DATE)) hi FROM orders GROUP BY o_orderpriority),
  cal AS (SELECT p, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) dt FROM b)
  SELECT cal.p, cal.dt FROM cal ANTI JOIN orders o ON o.o_orderpriority = cal.p AND CAST(o.o_orderdate AS DATE) = cal.dt""")
def gap_days(t):
    return planning.gap_days(t("orders").select(F.col("o_orderpriority").alias("p"), "o_orderdate"), "p", day("o_orderdate"))


@query("""SELECT o_custkey, CASE WHEN count(*) = count(CASE WHEN o_orderstatus IN ('F', 'O') THEN 1 END) THEN 'complete'
  WHEN count(CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 1 END) > 0 THEN 'blocked' ELSE 'partial' END AS st FROM orders GROUP BY o_custkey""")
def gate(t):
    return planning.gate(t("orders"), "o_custkey", F.col("o_orderstatus").isin("F", "O"), (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"))


@query("""SELECT o.o_orderkey, o.o_custkey FROM orders o WHERE o.o_orderkey % 2 = 1 AND NOT EXISTS (SELECT 1 FROM orders x
  WHERE x.o_custkey = o.o_custkey AND x.o_orderkey % 2 = 0 AND CAST(x.o_orderdate AS DATE) = CAST(o.o_orderdate AS DATE))""")
def insert_if_absent(t):
    o = t("orders").select("o_orderkey", "o_custkey", day("o_orderdate").alias("d"))
    return planning.insert_if_absent(o.where("o_orderkey % 2 = 1"), o.where("o_orderkey % 2 = 0"), ["o_custkey", "d"]).select("o_orderkey", "o_custkey")


@query("""SELECT status, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'not_collected' WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'validated' END AS status FROM orders) t GROUP BY status""")
def gap_status(t):
    o = t("orders").select(F.col("o_orderkey").alias("task_key"), F.when(F.col("o_orderstatus") == "P", "failed").otherwise("validated").alias("status"))
    return planning.gap_status(o.select("task_key"), o.where("task_key % 3 <> 0"))


@query("""SELECT o_orderkey AS task_key, o_orderpriority AS kind FROM orders WHERE o_orderkey % 3 = 0 OR o_orderstatus = 'P'""")
def plan_gaps(t):
    o = t("orders").select(F.col("o_orderkey").alias("task_key"), F.col("o_orderpriority").alias("kind"), F.when(F.col("o_orderstatus") == "P", "failed").otherwise("validated").alias("status"))
    return planning.plan_gaps(o.select("task_key", "kind"), o.where("task_key % 3 <> 0").select("task_key", "status"))


@query("""SELECT n_name AS "table", CAST(DATE '2026-01-01' + CAST(i AS INT) AS DATE) AS day, CASE WHEN n_nationkey % 2 = 0 THEN c END AS channel
  FROM nation, range(3) r(i), (VALUES ('a'), ('b')) v(c) WHERE (n_nationkey % 2 = 0 OR c = 'a') AND (n_nationkey % 5 <> 0 OR i = 2)""")
def job_expansion(t):
    n = t("nation").select(F.col("n_name").alias("table"), F.when(F.col("n_nationkey") % 5 == 0, "snapshot").otherwise("daily").alias("kind"), F.when(F.col("n_nationkey") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).alias("channels"))
    return planning.expand_tasks(n, planning.calendar(n.sparkSession, "2026-01-01", "2026-01-03", "day"))


@query("""SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS validated, CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS BIGINT) AS no_data,
  CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS BIGINT) AS failed, CAST(0 AS BIGINT) AS blocked FROM orders""")
def manifest_summary(t):
    return planning.summary(t("orders").select(status.mapped(F.col("o_orderstatus"), {"F": "validated", "O": "no_data", "P": "failed"}, "failed").alias("status")))


@query("""SELECT o_orderkey AS task_key, CASE WHEN o_orderkey % 7 = 0 THEN 'no result' ELSE 'identity' END AS fault FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0""")
def one_to_one(t):
    o = t("orders").select(F.col("o_orderkey").alias("task_key"), F.col("o_custkey").alias("who"))
    r = o.where("task_key % 7 <> 0").withColumn("who", F.when(F.col("task_key") % 11 == 0, -F.col("who") - 1).otherwise(F.col("who")))
    return planning.one_to_one(o, r, ["who"])


@query("""SELECT user_id, max(run) AS best FROM (SELECT user_id, count(CASE WHEN event_type IN ('click', 'purchase', 'signup') THEN 1 END) OVER (PARTITION BY user_id, g ORDER BY event_id) AS run
  FROM (SELECT *, count(CASE WHEN event_type = 'error' THEN 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM events) a) b GROUP BY user_id""")
def streak(t):
    return status.best_streak(t("events"), "user_id", "event_id", F.col("event_type").isin("click", "purchase", "signup"), F.col("event_type") == "error")


@query("""SELECT user_id, count(*) FILTER (WHERE event_type IN ('click', 'purchase', 'signup') AND (m IS NULL OR event_id > m)) AS streak,
  count(*) FILTER (WHERE event_type IN ('click', 'purchase', 'signup') AND (m IS NULL OR event_id > m)) >= 3 AS eligible
  FROM events LEFT JOIN (SELECT user_id AS u, max(event_id) AS m FROM events WHERE event_type = 'error' GROUP BY 1) x ON u = user_id GROUP BY user_id""")
def current_streak(t):
    return status.current_streak(t("events"), "user_id", "event_id", F.col("event_type").isin("click", "purchase", "signup"), F.col("event_type") == "error")


# -- reports -------------------------------------------------------------------------------------------------------------------------------------


@query("""SELECT h.range AS hour, count(e.event_id) AS n, round(100.0 * count(e.event_id) / (SELECT count(*) FROM events), 1) AS share, round(coalesce(sum(e.value), 0), 2) AS amount FROM range(24) h LEFT JOIN events e ON hour(e.ts + INTERVAL 8 HOURS) = h.range GROUP BY 1""")
def hour_hist(t):
    return reports.hour_histogram(t("events"), F.hour(F.col("ts") + F.expr("INTERVAL 8 HOURS")), F.col("value"))


@query("""WITH r AS (SELECT CAST(o_orderdate AS DATE) d, sum(CAST(o_totalprice AS DECIMAL(18,2))) v FROM orders GROUP BY CAST(o_orderdate AS DATE))
  SELECT a.d, a.v, b.v AS prev, round(CAST(a.v - b.v AS DOUBLE) / nullif(CAST(b.v AS DOUBLE), 0), 6) AS chg FROM r a LEFT JOIN r b ON b.d = a.d - INTERVAL '1' DAY""")
def day_over_day(t):
    return reports.day_over_day(t("orders"), day("o_orderdate"), money("o_totalprice"))


@query("""SELECT c_custkey, v, CAST(rn AS INT) AS rn, round(CAST(v AS DOUBLE) / CAST(tot AS DOUBLE), 6) AS share FROM (
  SELECT c_custkey, v, row_number() OVER (ORDER BY v DESC, c_custkey) rn, sum(v) OVER () tot FROM (
  SELECT o_custkey AS c_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) v FROM orders GROUP BY o_custkey) x) y WHERE rn <= 10""")
def topk_share(t):
    return reports.topk_share(t("orders").withColumn("c_custkey", F.col("o_custkey")), "c_custkey", money("o_totalprice"))


@query("""SELECT l_suppkey, count(*) AS total, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS cancelled,
  round(count(CASE WHEN l_returnflag = 'R' THEN 1 END) / CAST(count(*) AS DOUBLE), 6) AS rate FROM lineitem GROUP BY l_suppkey HAVING count(*) >= 10""")
def rate_min_volume(t):
    return reports.rate_min_volume(t("lineitem"), "l_suppkey", F.col("l_returnflag") == "R")


@query("""SELECT CAST(ts AS DATE) AS d, count(CASE WHEN event_type = 'view' THEN 1 END) AS views, count(CASE WHEN event_type = 'click' THEN 1 END) AS clicks,
  count(CASE WHEN event_type = 'purchase' THEN 1 END) AS purchases, count(DISTINCT user_id) AS users FROM events GROUP BY CAST(ts AS DATE)""")
def funnel(t):
    is_ = lambda k: F.col("event_type") == k
    return reports.funnel(t("events"), day("ts").alias("d"), {"views": is_("view"), "clicks": is_("click"), "purchases": is_("purchase")}, "user_id")


@query("""SELECT event_type, n FROM (SELECT event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY event_type) t ORDER BY n DESC, f LIMIT 3""")
def top_categories(t):
    return reports.top_categories(t("events"), "event_type", "event_id", 3)


@query("""SELECT p.p_name, CAST(sum(l.l_quantity) AS BIGINT) AS qty, sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS amt, count(DISTINCT l.l_suppkey) AS stores
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY p.p_name""")
def product_stats(t):
    rows = t("lineitem").select("l_partkey", "l_quantity", "l_extendedprice", "l_suppkey").join(t("part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    return reports.product_stats(rows, "p_name", F.col("l_quantity"), money("l_extendedprice"), "l_suppkey")


@query("""SELECT l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(12,2)) - CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))
  - CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2))) AS net FROM lineitem GROUP BY l_suppkey""")
def net_income(t):
    price, rate = F.col("l_extendedprice").cast("decimal(12,2)"), lambda c: F.col(c).cast("decimal(4,2)")
    rows = t("lineitem").select("l_suppkey", price.alias("income"), (price * rate("l_discount")).alias("a"), (price * rate("l_tax")).alias("b"))
    return reports.net_by(rows, "l_suppkey", "income", ["a", "b"])


@query("""SELECT o.o_orderkey, c.c_mktsegment AS unit, CASE WHEN c.c_mktsegment = 'MACHINERY' THEN NULL ELSE CAST(o.o_totalprice AS DECIMAL(18,2)) END AS value
  FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey""")
def lineage_enrich(t):
    c = t("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("unit"), F.lit(1).alias("at"))
    return store.with_lineage(t("orders").select("o_orderkey", "o_custkey", "o_totalprice"), c, ["o_custkey"], "at", ["unit"]).select("o_orderkey", "unit", F.when(~F.col("unit").eqNullSafe(F.lit("MACHINERY")), money("o_totalprice")).alias("value"))


@query("""SELECT c.c_custkey, CASE WHEN count(o.o_orderkey) = 0 THEN 'no_data' ELSE 'validated' END AS status, count(o.o_orderkey) AS row_cnt
  FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey""")
def coverage(t):
    return reports.coverage(t("customer"), t("orders"), "c_custkey", "o_custkey", "o_orderkey")


@query("""SELECT l_orderkey, concat(array_to_string(list_slice(a, 1, 3), '; '), CASE WHEN len(a) > 3 THEN concat(' 等', CAST(len(a) AS VARCHAR), '件') ELSE '' END) AS s
  FROM (SELECT l_orderkey, list(concat(left(concat('product number ', CAST(l_partkey AS VARCHAR)), 20), 'x', CAST(CAST(l_quantity AS INT) AS VARCHAR)) ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS a FROM lineitem GROUP BY l_orderkey) t""")
def item_summary(t):
    items = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity")))
    rows = t("lineitem").groupBy("l_orderkey").agg(items.alias("x"))
    return rows.select("l_orderkey", reports.items_summary(F.transform("x", lambda i: F.struct(F.concat(F.lit("product number "), i["l_partkey"].cast("string")).alias("name"), i["l_quantity"].cast("int").alias("count")))).alias("s"))


@query("""SELECT s_nationkey, sum(CAST(s_acctbal AS DECIMAL(18,2))) AS amount, count(*) AS orders, round(CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS ticket FROM supplier GROUP BY s_nationkey""")
def store_rollup(t):
    rows = t("supplier").select("s_nationkey", money("s_acctbal").alias("a"), money("s_acctbal").alias("n"), F.lit(1).cast("bigint").alias("o"))
    return reports.store_rollup(rows, "s_nationkey", "a", "n", "o").select("s_nationkey", "amount", "orders", F.round("ticket", 6).alias("ticket"))


@query("""SELECT sum(CAST(value AS DECIMAL(18,2))) AS v, count(DISTINCT u) + max(CASE WHEN u IS NULL THEN 1 ELSE 0 END) AS stores
  FROM (SELECT value, CASE WHEN user_id % 10 <> 0 THEN user_id END AS u FROM events) t""")
def brand_totals(t):
    rows = t("events").select(money("value").alias("v"), F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("u"))
    return reports.totals(rows, ["v"], "u").select("v", F.col("stores").cast("bigint").alias("stores"))


@query("""SELECT round(avg(s), 6) AS mean, count(s) AS n, count(*) FILTER (WHERE s BETWEEN 1 AND 2) AS low FROM (SELECT CASE WHEN event_id % 7 <> 6 THEN event_id % 6 END AS s FROM events) t""")
def low_scores(t):
    rows = t("events").select(F.when(F.col("event_id") % 7 != 6, F.col("event_id") % 6).alias("s"))
    return reports.scores(rows, "s").select(F.round("mean", 6).alias("mean"), "n", "low")


@query("""SELECT count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS completed, count(*) FILTER (WHERE o_orderstatus LIKE '%P%') AS cancelled,
  sum(CAST(CASE WHEN o_orderkey % 4 = 0 THEN o_custkey ELSE o_orderkey END AS DECIMAL(18,2))) AS amount, count(DISTINCT o_custkey) AS stores, count(DISTINCT o_orderpriority) AS products FROM orders""")
def order_summary(t):
    o = t("orders")
    amount = reports.first_nonzero(F.when(F.col("o_orderkey") % 4 == 0, F.lit(0.0)).otherwise(F.col("o_orderkey").cast("double")), F.col("o_custkey").cast("double")).cast("decimal(18,2)")
    amount = F.when((F.col("o_orderkey") % 4 != 0) & (F.col("o_orderkey") == 0), F.lit(0).cast("decimal(18,2)")).otherwise(amount)
    return reports.order_summary(o, "o_orderstatus", "F", "P", amount, "o_custkey", F.col("o_orderpriority"))


@query("""SELECT o_orderpriority, count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS completed, round(100.0 * count(*) FILTER (WHERE o_orderstatus = 'F') / CAST(count(*) AS DOUBLE), 1) AS rate FROM orders GROUP BY 1""")
def completion_rate(t):
    return reports.completion(t("orders"), "o_orderpriority", F.col("o_orderstatus") == "F")


@query("""SELECT event_type, count(*) AS n FROM events GROUP BY 1 UNION ALL SELECT 'total', count(*) FROM events""")
def total_row(t):
    return reports.with_total(reports.group_counts(t("events"), "event_type"), "event_type", "total", ["n"])


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_tax - 0.5, 4) AS c FROM lineitem""")
def commission(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", reports.less_fixed(F.col("l_tax").cast("string")).alias("c"))


@query("""SELECT c_mktsegment, concat_ws(',', CASE WHEN count(*) > 290 THEN 'many' END, CASE WHEN avg(c_acctbal) > 4500 THEN 'rich' END) AS f FROM customer GROUP BY 1""")
def rule_flags(t):
    a = t("customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.avg("c_acctbal").alias("b"))
    return a.select("c_mktsegment", F.array_join(reports.flags([("many", F.col("n") > 290), ("rich", F.col("b") > 4500)], 3), ",").alias("f"))


# -- checks --------------------------------------------------------------------------------------------------------------------------------------


@query("""SELECT l_orderkey, l_linenumber FROM lineitem EXCEPT ALL SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey % 5 <> 0""")
def bag_diff(t):
    a = t("lineitem")
    return verify.bag_difference(a.select("l_orderkey", "l_linenumber"), a.where("l_partkey % 5 <> 0").select("l_orderkey", "l_linenumber"))


@query("""SELECT o_orderpriority AS g, code, count(*) AS n FROM (SELECT o_orderpriority, CASE WHEN o_orderkey % 10 = 0 THEN 'MISSING' WHEN o_orderkey % 10 = 1 THEN 'LEGACY_BLANKED' ELSE 'MATCHED' END AS code FROM orders
  UNION ALL SELECT o_orderpriority, 'FABRICATED' FROM orders WHERE o_orderkey % 50 = 3) t GROUP BY 1, 2""")
def reconcile(t):
    o = t("orders").select(F.col("o_orderpriority").alias("g"), F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"), F.col("o_orderstatus").alias("s"))
    kept = o.where("k % 10 <> 0").withColumn("s", F.when(F.col("k") % 10 == 1, F.lit("")).otherwise(F.col("s")))
    made = o.where("k % 50 = 3").withColumn("v", F.col("v") + 1)
    return verify.reconcile(o, kept.union(made), ["g"], ["k"], ["v"], ["s"])


@query("""SELECT count(CASE WHEN o_orderkey % 5 = 1 THEN 1 WHEN o_orderkey % 5 <> 0 AND abs(a - b) <= 1e-9 * greatest(abs(a), abs(b)) THEN 1 END) AS eq, count(*) AS n
  FROM (SELECT o_orderkey, o_totalprice AS a, CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice + 0.01 ELSE o_totalprice * (1 + 1e-12) END AS b FROM orders) t""")
def tolerance_eq(t):
    a, k = F.col("o_totalprice"), F.col("o_orderkey") % 5
    b = F.when(F.col("o_orderkey") % 4 == 0, a + 0.01).otherwise(a * (1 + 1e-12))
    return verify.tolerance_counts(F.when(k < 2, 0.0).otherwise(a), F.when(k == 0, 1e-8).when(k == 1, 1e-10).otherwise(b), t("orders"))


@query("""SELECT o_orderkey FROM orders ORDER BY sha256(concat('20261001|', CAST(o_orderkey AS VARCHAR))) LIMIT 50""")
def hash_sample(t):
    return verify.hash_sample(t("orders").select("o_orderkey"), "20261001", [F.col("o_orderkey")], 50)


@query("""SELECT count(*) AS missing, 0 AS empty FROM orders WHERE o_orderkey % 9 = 0""")
def blank_keys(t):
    rows = t("orders").select(F.when(F.col("o_orderkey") % 9 == 0, "--").otherwise("x").alias("a"), F.col("o_orderpriority").alias("b"))
    return verify.blank_keys(rows, ["a", "b"]).select("missing", F.col("empty").cast("int").alias("empty"))


@query("""SELECT o_custkey, CASE WHEN bool_or(o_orderstatus = 'P') THEN 'blocked' WHEN bool_and(o_orderstatus = 'F') THEN 'ready' ELSE 'pending' END AS state FROM orders GROUP BY 1""")
def processing_state(t):
    return verify.processing_state(t("orders"), "o_custkey", F.col("o_orderstatus") == "P", F.col("o_orderstatus") == "F")


@query("""SELECT o_orderkey, concat(strftime(o_orderdate, '%Y%m%d'), CASE WHEN o_orderkey % 2 = 1 THEN concat(',', strftime(o_orderdate + to_days(1), '%Y%m%d')) ELSE '' END) AS days,
  CAST(o_orderdate + to_days(CAST(o_orderkey % 2 AS INT)) AS DATE) AS last FROM orders""")
def text_dates(t):
    d = F.col("o_orderdate").cast("date")
    text = F.concat(F.date_format(d, "yyyyMMdd"), F.lit("-"), F.date_format(F.date_add(d, (F.col("o_orderkey") % 2).cast("int")), "yyyyMMdd"))
    return t("orders").select("o_orderkey", F.array_join(cells.days_in(text), ",").alias("days"), cells.last_day(text).alias("last"))


# -- storage ---------------------------------------------------------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, d, v FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) d, CAST(o_totalprice AS DECIMAL(18,2)) v FROM orders) o
  WHERE d NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderkey % 100 = 0)
  UNION ALL SELECT o_orderkey, CAST(o_orderdate AS DATE), CAST(o_totalprice * 2 AS DECIMAL(18,2)) FROM orders WHERE o_orderkey % 100 = 0""")
def group_replace(t):
    o = t("orders").select("o_orderkey", day("o_orderdate").alias("d"), "o_totalprice")
    new = o.where("o_orderkey % 100 = 0").select("o_orderkey", "d", (F.col("o_totalprice") * 2).cast("decimal(18,2)").alias("v"))
    return store.group_replace(o.select("o_orderkey", "d", money("o_totalprice").alias("v")), new, new.select("d"), "d", None)


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey % 10 < 3 OR CAST(o_orderdate AS DATE) >= DATE '2001-08-02' - INTERVAL '365' DAY""")
def retention(t):
    k = F.col("o_orderkey") % 10
    rows = t("orders").withColumn("d", F.when(k == 0, "").when(k == 1, F.lit(None)).when(k == 2, "unknown").otherwise(day("o_orderdate").cast("string")))
    return store.retained(rows, "d", F.lit("2001-08-02").cast("date")).select("o_orderkey")


@query("""SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 6 <> 0 UNION ALL SELECT c_custkey, 0.0 FROM customer WHERE c_custkey % 6 = 0""")
def keyed_upsert(t):
    c = t("customer").select("c_custkey", "c_acctbal")
    return store.upsert(c, c.where("c_custkey % 6 = 0").withColumn("c_acctbal", F.lit(0.0)), ["c_custkey"])


# -- cells, texts, messages ----------------------------------------------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, CASE k WHEN 0 THEN 'blank' WHEN 1 THEN 'percent' WHEN 3 THEN 'number' WHEN 4 THEN 'number' WHEN 5 THEN 'duration' WHEN 6 THEN 'incomparable' ELSE 'text' END AS kind,
  CASE k WHEN 1 THEN round(o_orderkey / 10000.0, 6) WHEN 3 THEN o_orderkey % 1000 * 1000.0 WHEN 4 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) WHEN 5 THEN CAST(o_orderkey AS DOUBLE) END AS number,
  CASE k WHEN 0 THEN '' WHEN 2 THEN concat('top', CAST(o_orderkey AS VARCHAR), '%') WHEN 6 THEN '不可比' END AS text FROM (SELECT *, o_orderkey % 7 AS k FROM orders) x""")
def parse_cell(t):
    k, s = F.col("o_orderkey"), lambda c: c.cast("string")
    cell = F.when(k % 7 == 0, "--").when(k % 7 == 1, F.concat(s((k / 100).cast("decimal(12,2)")), F.lit("%"))).when(k % 7 == 2, F.concat(F.lit("top"), s(k), F.lit("%"))).when(k % 7 == 3, F.concat(s(k % 1000), F.lit(",000")))
    cell = cell.when(k % 7 == 4, s(money("o_totalprice"))).when(k % 7 == 5, F.concat(s(k), F.lit("天"))).otherwise("∞")
    return t("orders").select("o_orderkey", cells.parse_cell(cell).alias("p")).select("o_orderkey", "p.kind", F.round(F.col("p.number").cast("double"), 6).alias("number"), "p.text")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d FROM orders""")
def strict_dates(t):
    k, d = F.col("o_orderkey") % 3, F.col("o_orderdate")
    text = F.when(k == 0, F.date_format(d, "yyyyMMdd")).when(k == 1, F.date_format(d, " yyyy-MM-dd ")).otherwise("20260230")
    return t("orders").select("o_orderkey", cells.strict_date(text).alias("d"))


@query("""SELECT page_id, sha256(regexp_replace(regexp_replace(html, '(?s)<script[^>]*>.*?</script>', '', 'g'), '(?s)<style[^>]*>.*?</style>', '', 'g')) AS h FROM pages""")
def strip_tags(t):
    return t("pages").select("page_id", F.sha2(texts.strip_tags(F.col("html"), ["script", "style"]), 256).alias("h"))


@query("""SELECT conv_id, turn, left(trim(text), 800) AS t FROM conversations WHERE role = 'user' AND length(trim(text)) >= 2 AND turn % 5 <> 4 AND turn % 7 <> 6""")
def msg_digest(t):
    c, n = t("conversations").where("role = 'user'"), F.col("turn")
    text = F.when(n % 5 == 4, F.concat(F.lit("Outcome Policy "), F.col("text"))).otherwise(F.concat(F.lit("<cwd a>x\n</cwd> "), F.col("text"), F.lit("<environment_context>")))
    rows = c.select("conv_id", "turn", text.alias("t"), F.when(n % 7 != 6, "2026-01-01T00:00:00Z").alias("ts"))
    return texts.own_messages(rows, "t", "ts").select("conv_id", "turn", "t")


@query("""SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY event_type""")
def json_k(t):
    return t("events").groupBy("event_type").agg(F.sum(F.get_json_object("props", "$.k").cast("bigint")).alias("k"))


@query("""SELECT p_partkey, CASE WHEN p_size BETWEEN 10 AND 30 AND p_partkey % 7 <> 0 THEN 'in' ELSE 'out' END AS side FROM part""")
def range_split(t):
    rows = t("part").withColumn("p_size", F.when(F.col("p_partkey") % 7 != 0, F.col("p_size")))
    inside, outside = reports.split_range(rows, "p_size", 10, 30)
    return inside.select("p_partkey", F.lit("in").alias("side")).union(outside.select("p_partkey", F.lit("out")))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN '--' ELSE concat('¥', format('{:,.2f}', CAST(s_suppkey * 1000 + 0.27 AS DOUBLE))) END AS money, CASE WHEN s_suppkey % 5 = 0 THEN '--' ELSE printf('%+.1f%%', CAST(s_suppkey - 50 AS DOUBLE) + 0.27) END AS change,
  CASE WHEN s_suppkey % 5 = 0 THEN '--' ELSE printf('%.1f%%', CAST(s_suppkey AS DOUBLE) + 0.27) END AS share, ['周日', '周一', '周二', '周三', '周四', '周五', '周六'][CAST(dayofweek(DATE '2026-01-01' + CAST(s_suppkey AS INT)) AS INT) + 1] AS weekday FROM supplier""")
def formats(t):
    k = F.col("s_suppkey")
    some = lambda c: F.when(k % 5 != 0, c)
    return t("supplier").select("s_suppkey", cells.money_text(some(k * 1000 + 0.27)).alias("money"), cells.change_text(some((k - 50 + 0.27) / 100)).alias("change"), cells.share_text(some((k + 0.27) / 100)).alias("share"), cells.weekday_name(F.date_add(F.lit("2026-01-01").cast("date"), k.cast("int"))).alias("weekday"))


from . import cell_queries, store_queries  # noqa: E402, F401  they register theirs
