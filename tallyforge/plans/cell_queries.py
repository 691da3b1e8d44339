"""Cells, names, dates, texts and headers as queries over the tables of a folder, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import cells, texts
from ..operators import dedup, entity, planning, reports, status, verify
from ..sources import readers, store, workbooks
from .registry import query

key = lambda: F.col("o_orderkey")
day = lambda c: F.col(c).cast("date")
text = lambda c: c.cast("string")


def one_of(k, *values):
    """The value at the place of k modulo their number."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for i, v in enumerate(values):
        out = out.when(k % len(values) == i, v)
    return out


# -- values ------------------------------------------------------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, CASE o_orderkey % 8 WHEN 4 THEN 'x' WHEN 5 THEN '暂无' WHEN 6 THEN 'none' ELSE '' END AS v FROM orders""")
def placeholders(t):
    return t("orders").select("o_orderkey", cells.placeholder_to_blank(one_of(key(), F.lit(" N/A "), F.lit("无"), F.lit("–"), F.lit("不适用"), F.lit(" x　"), F.lit("暂无"), F.lit("none"), F.lit(None))).alias("v"))


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 3 THEN strftime(o_orderdate + INTERVAL 1 DAY, '%Y%m%d') WHEN 4 THEN NULL WHEN 5 THEN '20260230' ELSE strftime(o_orderdate, '%Y%m%d') END AS day FROM orders""")
def lenient_days(t):
    d = F.col("o_orderdate").cast("date")
    shape = lambda c, f: F.date_format(c, f)
    cell = one_of(key(), shape(d, " yyyyMMdd "), shape(d, "yyyy-MM-dd"), shape(d, "yyyy-MM-dd'T'00:00:00"), F.concat(shape(d, "yyyyMMdd -"), shape(F.date_add(d, 1), " yyyyMMdd")), F.when(key() % 4 == 0, shape(d, "yyyy-MM-ddx")).otherwise("汇总"), F.lit("20260230"))
    return t("orders").select("o_orderkey", cells.lenient_day(cell).alias("day"))


@query("""SELECT o_orderkey, concat('19754069635', CAST(10000000 + o_orderkey AS VARCHAR)) AS v FROM orders WHERE o_orderkey % 3 <> 2""")
def long_numbers(t):
    cell = one_of(key(), F.concat(F.lit("19754069635"), text(key() + 10_000_000)), F.concat(F.lit(" 19754069635"), text(key() + 10_000_000), F.lit("　")), F.concat(text(key()), F.lit("e3")))
    return t("orders").select("o_orderkey", text(cells.parse_number(cell).cast("decimal(38,0)")).alias("v")).where("v is not null")


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'number' WHEN 1 THEN 'blank' WHEN 2 THEN 'number' WHEN 3 THEN 'number' ELSE 'text' END AS kind, CASE o_orderkey % 5 WHEN 0 THEN o_orderkey * 1.0 WHEN 3 THEN o_orderkey * 1.0 END AS number,
  CASE o_orderkey % 5 WHEN 1 THEN '' WHEN 2 THEN concat(repeat('9', 27), CAST(o_orderkey AS VARCHAR)) WHEN 4 THEN concat('a', chr(160), CAST(o_orderkey AS VARCHAR)) END AS text, CASE o_orderkey % 5 WHEN 0 THEN o_orderkey * 1.0 WHEN 3 THEN o_orderkey * 1.0 END AS money FROM orders""")
def odd_spaces_and_long_numbers(t):
    """Cells with spaces of all kinds around them, with a wide space within, and whole numbers beyond any decimal."""
    k = text(key())
    wide = F.concat(F.substring(k, 1, 1), F.lit("　"), F.substring(k, 2, 20))
    cell = one_of(key(), F.concat(F.lit("\u00a0\u2003"), k, F.lit("\u2009\x1f")), F.lit("\u00a0\u3000--\u202f"), F.concat(F.lit("\ufeff00"), F.lit("9" * 27), k), wide, F.concat(F.lit("\u2028a\u00a0"), k))
    typed = cells.parse_cell(cell)
    return t("orders").select("o_orderkey", typed["kind"].alias("kind"), typed["number"].cast("double").alias("number"), typed["text"].alias("text"), cells.round_money(F.when(key() % 5 != 2, cell)).cast("double").alias("money"))


@query("""SELECT o_orderkey, CASE k WHEN 0 THEN round(o_orderkey / 10000.0, 6) END AS share, CASE k WHEN 1 THEN round(o_orderkey / 100.0, 6) END AS points, CASE WHEN k IN (2, 3) THEN round(o_orderkey / 100.0, 6) END AS duration
  FROM (SELECT *, o_orderkey % 5 AS k FROM orders) t""")
def units(t):
    n = text((key() / 100).cast("decimal(12,2)"))
    cell = one_of(key(), F.concat(n, F.lit("%")), F.concat(n, F.lit("PP")), F.concat(n, F.lit("分钟")), F.concat(n, F.lit("天")), F.concat(F.lit("约"), n, F.lit("秒")))
    d = lambda c: F.round(c.cast("double"), 6)
    return t("orders").select("o_orderkey", d(cells.parse_percent(cell)).alias("share"), d(cells.parse_points(cell)).alias("points"), d(cells.parse_duration(cell)).alias("duration"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE CAST((o_orderkey + 5) // 10 AS DOUBLE) / 100 END AS v FROM orders""")
def cents(t):
    n = text((key() / 1000).cast("decimal(12,3)"))
    return t("orders").select("o_orderkey", cells.round_money(F.when(key() % 4 == 3, F.concat(n, F.lit("元"))).otherwise(n)).cast("double").alias("v"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderkey * 1000.0 WHEN 1 THEN o_orderkey / 2.0 END AS num, CASE o_orderkey % 4 WHEN 0 THEN concat(CAST(o_orderkey AS VARCHAR), 'e3') WHEN 1 THEN
  CASE WHEN o_orderkey % 2 = 1 THEN concat(CAST(o_orderkey // 2 AS VARCHAR), '.5') ELSE CAST(o_orderkey // 2 AS VARCHAR) END WHEN 2 THEN concat('00', CAST(o_orderkey AS VARCHAR)) ELSE CAST(o_orderkey AS VARCHAR) END AS shown FROM orders""")
def lenient_numbers(t):
    cell = one_of(key(), F.concat(text(key()), F.lit("e3")), text((key() / 2).cast("decimal(12,1)")), F.concat(F.lit("00"), text(key())), F.concat(text(key()), F.lit(".0")))
    return t("orders").select("o_orderkey", F.when(key() % 4 < 2, cells.lenient_float(cell)).alias("num"), cells.number_for_export(cell).alias("shown"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderkey / 10000.0 WHEN 1 THEN o_orderkey / 1000.0 WHEN 2 THEN o_orderkey * 1000.0 END AS v FROM orders""")
def displayed_numbers(t):
    cell = one_of(key(), F.concat(text((key() / 100).cast("decimal(12,2)")), F.lit("%")), F.concat(text(key()), F.lit("E-3")), F.concat(text(key()), F.lit(",000 元")), F.concat(F.lit("约"), text(key())))
    return t("orders").select("o_orderkey", cells.decimal_of_display(cell).cast("double").alias("v"))


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 1 THEN o_orderkey % 40 <> 7 WHEN 5 THEN false ELSE true END AS same FROM orders""")
def comparable_cells(t):
    n = (key() % 40 * 10).cast("decimal(12,2)")
    share, signed = text((n / 100).cast("decimal(12,4)")), F.concat(text(n), F.lit("%"))
    cases = [
        ("占比(%)", text(n), share),
        ("金额", F.concat(text(n), F.lit("元")), text(F.when(key() % 40 == 7, n + 1).otherwise(n))),
        ("下单率", signed, share),
        ("数量", F.lit("1.38e-17"), F.lit("0")),
        ("备注", F.lit("--"), F.lit(None)),
        ("订单编号", F.concat(F.lit("0"), text(key())), text(key())),
    ]
    parts = [t("orders").where(key() % 6 == i).select("o_orderkey", (cells.comparable(a, name, "source") == cells.comparable(b, name, "store")).alias("same")) for i, (name, a, b) in enumerate(cases)]
    return entity.union_all(parts)


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN concat(CAST(o_orderkey AS VARCHAR), '.0') ELSE concat('a', CAST(o_orderkey AS VARCHAR)) END AS k FROM orders""")
def legacy_keys(t):
    return t("orders").select("o_orderkey", cells.legacy_number_key(one_of(key(), F.concat(text(key()), F.lit(".00")), F.concat(F.lit(" a"), text(key())))).alias("k"))


@query("""SELECT o_orderkey, left(sha1(CAST(o_custkey AS VARCHAR)), 12) AS h, concat(CAST(o_custkey AS VARCHAR), '||', o_orderpriority, '#', left(sha1(concat(CAST(o_custkey AS VARCHAR), '||', o_orderpriority)), 12)) AS task FROM orders""")
def keys_of_tasks(t):
    return t("orders").select("o_orderkey", cells.short_hash(text(F.col("o_custkey"))).alias("h"), cells.task_key(F.col("o_custkey"), F.lit(None), F.col("o_orderpriority")).alias("task"))


# -- dates ---------------------------------------------------------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (0, 1) THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END AS iso,
  CASE WHEN o_orderkey % 5 = 4 THEN '100234' ELSE strftime(o_orderdate, '%Y%m%d') END AS compact,
  CASE o_orderkey % 5 WHEN 0 THEN concat(strftime(o_orderdate, '%Y%m%d'), '000000') WHEN 1 THEN concat(strftime(o_orderdate, '%Y%m%d'), '091502') ELSE '99999999999999' END AS sort_key FROM orders""")
def date_cells(t):
    d = F.col("o_orderdate")
    cell = one_of(key(), F.date_format(d, "yyyyMMdd"), F.concat(F.date_format(d, "yyyy/MM/dd"), F.lit(" 09:15:02")), F.date_format(d, "'on 'yyyy'年'M'月'd'日'"), F.concat(F.lit("第"), F.date_format(d, "yyyyMMdd")), F.lit("100234"))
    return t("orders").select("o_orderkey", cells.date_prefix(cell).alias("iso"), cells.compact_date(cell).alias("compact"), cells.date_sort_key(cell).alias("sort_key"))


@query("""SELECT o_orderkey FROM orders WHERE strftime(o_orderdate, '%Y%m%d') = '19950315'""")
def rows_on_a_day(t):
    d = F.col("o_orderdate")
    rows = t("orders").withColumn("cell", one_of(key(), F.date_format(d, "yyyyMMdd"), F.date_format(d, "yyyy-M-d"), F.date_format(d, "yyyy-MM-dd 00:00:00")))
    return reports.on_day(rows, "cell", "19950315").select("o_orderkey")


@query("""SELECT o_orderkey, CAST(date_trunc('month', CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH) AS DATE) AS first, CAST(date_trunc('month', o_orderdate) - INTERVAL 1 DAY AS DATE) AS last,
  CAST(CAST(o_orderdate AS DATE) - 30 AS DATE) AS from_, CAST(CAST(o_orderdate AS DATE) - 1 AS DATE) AS to_ FROM orders""")
def months_and_windows(t):
    (a, b), (c, d) = cells.previous_month(day("o_orderdate")), cells.rolling_window(day("o_orderdate"), 30)
    return t("orders").select("o_orderkey", a.alias("first"), b.alias("last"), c.alias("from_"), d.alias("to_"))


@query("""SELECT event_id, CAST(hour(ts + INTERVAL 8 HOURS) AS INT) AS h, strftime(ts + INTERVAL 8 HOURS, '%Y-%m-%d %H:%M:%S') AS local, strftime(ts + INTERVAL 8 HOURS, '%Y-%m-%d %H:%M:%S') AS iso,
  epoch_ms(CAST(CAST(ts AS DATE) AS TIMESTAMP) - INTERVAL 8 HOURS) AS first, epoch_ms(CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 16 HOURS) - 1 AS last FROM events""")
def local_times(t):
    at = F.col("ts").cast("timestamp")
    ms = F.unix_millis(at)
    iso = F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    return t("events").select("event_id", cells.local_hour(ms).alias("h"), cells.local_time(ms).alias("local"), F.date_format(cells.local_iso_time(iso), "yyyy-MM-dd HH:mm:ss").alias("iso"), cells.to_epoch_millis(day("ts")).alias("first"), cells.to_epoch_millis(day("ts"), end=True).alias("last"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN concat(strftime(o_orderdate - INTERVAL 29 DAY, '%Y%m%d'), '-', strftime(o_orderdate, '%Y%m%d')) ELSE strftime(o_orderdate, '%Y%m%d') END AS name FROM orders""")
def task_names(t):
    return t("orders").select("o_orderkey", planning.task_name(day("o_orderdate"), F.date_sub("o_orderdate", 29), key() % 2 == 0).alias("name"))


@query("""SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) - 3, '%Y%m%d') AS lo, strftime(CAST(o_orderdate AS DATE) - 2, '%Y%m%d') AS hi, CAST(2 AS BIGINT) AS n FROM orders""")
def window_bounds(t):
    days = planning.window_days(day("o_orderdate"), 2, 2)
    f = lambda c: F.date_format(c, "yyyyMMdd")
    return t("orders").select("o_orderkey", f(F.array_min(days)).alias("lo"), f(F.array_max(days)).alias("hi"), F.size(days).cast("bigint").alias("n"))


@query("""SELECT count(*) FILTER (WHERE o_orderkey % 50 = 0) AS bad, min(strftime(o_orderdate, '%Y%m%d')) FILTER (WHERE o_orderkey % 50 = 0) AS sample FROM orders""")
def days_of_a_batch(t):
    cell = F.when(key() % 50 == 0, F.date_format("o_orderdate", "yyyyMMdd")).otherwise("2026-01-05")
    return verify.batch_days(t("orders"), cell, "20260105")


@query("""SELECT o_orderpriority, o_orderpriority <> '1-URGENT' AS ok FROM orders GROUP BY 1""")
def all_on_a_day(t):
    o, out = t("orders"), []
    for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"):
        cell = F.when(key() % 3 == 0, "--").when((key() % 3 == 1) & (F.col("o_orderpriority") == "1-URGENT"), "2026-01-06").otherwise("2026-01-05 09:00")
        rows = o.where(F.col("o_orderpriority") == p)
        out.append(verify.all_on_day(rows, cell, "20260105").select(F.lit(p).alias("o_orderpriority"), "ok"))
    return entity.union_all(out).join(o.select("o_orderpriority").distinct(), "o_orderpriority", "left_semi")


@query("""SELECT o_orderkey FROM orders WHERE NOT (o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1999-12-31')""")
def outside_a_window(t):
    return planning.outside_window(t("orders"), cells.days_in(F.date_format("o_orderdate", "yyyyMMdd")), "19960101", "19991231").select("o_orderkey")


# -- names, columns, headers -----------------------------------------------------------------------------------------------------------------------


@query("""SELECT c_custkey, concat('甲.乙店(', CAST(c_custkey AS VARCHAR), ')') AS name, CAST(c_custkey AS VARCHAR) AS short, CAST(c_custkey AS VARCHAR) AS last FROM customer""")
def store_names(t):
    k = text(F.col("c_custkey"))
    name = F.concat(F.lit("　甲·乙店（"), k, F.lit("） "))
    return t("customer").select("c_custkey", cells.store_name(name).alias("name"), cells.short_name(F.concat(F.lit("品牌店（"), k, F.lit("）")), ["品牌店（"]).alias("short"), cells.last_segment(F.concat(F.lit("a||b||"), k)).alias("last"))


@query("""SELECT c_custkey AS "门店", c_acctbal AS "转化率_环比波动_pp", c_nationkey AS "人数_环比波动", c_mktsegment AS "品类" FROM customer""")
def renamed_columns(t):
    c = t("customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment").toDF("门店名称", "转化率_环比波动", "人数_环比波动", "一级品类")
    return dedup.renamed(c)


#: The columns of a table as rows of a given one: what a file's header would be.
def headers(t):
    """(table, place, column): columns as files of several kinds would have them, by supplier."""
    k = F.col("s_suppkey")
    names = F.when(k % 3 == 0, F.array(F.lit("id"), F.lit("展示订单号"), F.lit("金额"))).when(k % 3 == 1, F.array(F.lit("id"), F.lit("展示订单号"), F.lit("售后类型"))).otherwise(F.array(F.lit("x"), F.concat(F.lit("退款率"), F.when(k % 2 == 0, "_未决").otherwise(""))))
    return t("supplier").select(F.col("s_name").alias("table"), k.alias("k"), F.posexplode(names).alias("place", "column"))


@query("""WITH n AS (SELECT *, row_number() OVER (ORDER BY n_regionkey, n_nationkey) - 1 AS place, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS k FROM nation)
  SELECT place, CASE WHEN n_regionkey <> 2 THEN concat(r_name, '_', n_name) WHEN k = 1 THEN r_name ELSE n_name END AS name FROM n JOIN region ON r_regionkey = n_regionkey""")
def two_layer_header(t):
    """A sheet whose top row has a merged cell a region, and nations below; the first nation of region 2 has no name of its own."""
    n = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    place = (F.row_number().over(Window.orderBy("n_regionkey", "n_nationkey")) - 1).alias("place")
    k = F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")).alias("k")
    n = n.select("n_regionkey", "r_name", "n_name", place, k)
    tops = F.transform(F.array_sort(F.collect_list(F.struct("place", F.when(F.col("k") == 1, F.col("r_name")).otherwise("").alias("x")))), lambda r: r["x"])
    lows = F.transform(F.array_sort(F.collect_list(F.struct("place", F.when((F.col("k") == 1) & (F.col("n_regionkey") == 2), "").otherwise(F.col("n_name")).alias("x")))), lambda r: r["x"])
    spans = n.groupBy("n_regionkey").agg(F.min("place").alias("left"), F.max("place").alias("right")).agg(F.collect_list(F.struct(F.lit(0).alias("top"), "left", F.lit(0).alias("bottom"), "right")).alias("merged"))
    rows = n.agg(F.array(tops, lows).alias("rows")).select(F.posexplode("rows").alias("row", "cells")).crossJoin(spans)
    return workbooks.header_names(rows.select(F.lit("p").alias("_path"), "row", "cells", F.when(F.col("row") == 0, F.col("merged")).alias("merged")), 2).select("place", "name")


@query("""SELECT s_suppkey, s_suppkey % 3 = 0 AS orders, s_suppkey % 3 = 1 AS refunds, CASE WHEN s_suppkey % 3 = 2 THEN 'x' ELSE 'id' END AS identity FROM supplier""")
def header_signatures(t):
    columns = headers(t).groupBy("k").agg(F.collect_set("column").alias("c"))
    kind = lambda must, never=(): readers.signed(F.col("c"), must, never)
    return columns.select(F.col("k").alias("s_suppkey"), kind(["展示订单号"], ["售后类型"]).alias("orders"), kind(["展示订单号", "售后类型"]).alias("refunds"), F.array_join(entity.identities(F.col("c"), ["id", "x"]), ",").alias("identity"))


@query("""WITH h AS (SELECT s_name, unnest(CASE s_suppkey % 3 WHEN 0 THEN ['id', '展示订单号', '金额'] WHEN 1 THEN ['id', '展示订单号', '售后类型'] ELSE ['x', CASE WHEN s_suppkey % 2 = 0 THEN '退款率_未决' ELSE '退款率' END] END) AS name FROM supplier)
  SELECT s_name AS "table", name, CASE WHEN name IN ('金额', '退款率', '退款率_未决') THEN '元' END AS unit, CASE WHEN name LIKE '%未决' THEN 'pending' ELSE 'formal' END AS status, CASE WHEN name NOT LIKE '%未决' THEN '原件直取' END AS source FROM h""")
def column_classes(t):
    return store.classified(headers(t), F.col("column")).select("table", F.col("column").alias("name"), "unit", "status", "source")


@query("""SELECT o_orderkey, '' AS missing, o_custkey FROM orders""")
def aligned_columns(t):
    return dedup.align(t("orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_orderkey", "missing", "o_custkey"])


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey % 4 <> 0""")
def without_blank_rows(t):
    rows = t("orders").select(F.when(key() % 4 != 0, text(key())).otherwise(" 　").alias("o_orderkey"), F.when(key() % 4 == 0, "").alias("b"))
    return dedup.without_blank_rows(rows).select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"))


@query("""SELECT l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount FROM lineitem GROUP BY 1""")
def sums_without_summaries(t):
    l = t("lineitem").select(text(F.col("l_suppkey")).alias("门店（一）"), F.col("l_extendedprice").cast("decimal(18,2)").alias("v"))  # noqa: E741
    total = l.groupBy().agg(F.sum("v").cast("decimal(18,2)").alias("v")).select(F.lit("汇总 ").alias("门店（一）"), "v")
    rows = reports.without_summaries(reports.summary_flag(l.union(total), "门店(一)"))
    return rows.groupBy(F.col("门店（一）").try_cast("bigint").alias("l_suppkey")).agg(F.sum("v").alias("amount"))


@query("""SELECT o_orderkey, '门店经营' AS table_, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def provenance(t):
    path = F.concat(F.lit("file:/x/门店经营_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".csv"))
    return readers.table_name(readers.business_day(t("orders").withColumn("_path", path), "day"), "table_").select("o_orderkey", "table_", "day")


# -- texts -----------------------------------------------------------------------------------------------------------------------------------------


@query("""SELECT conv_id, turn, concat('a', chr(10), text) AS t FROM conversations WHERE turn % 3 = 0 UNION ALL SELECT conv_id, turn, text FROM conversations WHERE turn % 3 = 1 UNION ALL SELECT conv_id, turn, concat('[', text) FROM conversations WHERE turn % 3 = 2""")
def message_contents(t):
    n, s = F.col("turn"), F.col("text")
    part = lambda kind, x: F.struct(F.lit(kind).alias("type"), x.alias("text"))
    parts = F.to_json(F.array(part("text", F.lit("a")), part("tool_result", s), part("input_text", s)))
    whole = F.expr("substring(to_json(named_struct('v', text)), 6)")
    raw = F.when(n % 3 == 0, parts).when(n % 3 == 1, F.left(whole, F.length(whole) - 1)).otherwise(F.concat(F.lit("["), s))
    return t("conversations").select("conv_id", "turn", texts.content_text(raw).alias("t"))


@query("""SELECT conv_id, turn, turn % 4 = 0 OR trim(text) = '' AS system FROM conversations""")
def system_messages(t):
    return t("conversations").select("conv_id", "turn", texts.is_system(F.when(F.col("turn") % 4 == 0, F.concat(F.lit("x Base Risk Taxonomy "), F.col("text"))).otherwise(F.col("text"))).alias("system"))


@query("""SELECT CAST(ts + INTERVAL 8 HOURS AS DATE) AS day, count(*) AS n FROM events GROUP BY 1""")
def messages_by_day(t):
    rows = t("events").select(F.concat(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("at"))
    return texts.messages_by_day(rows.union(rows.limit(1).select(F.lit("no time"))), "at")


@query("""SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '%URG%' OR o_orderpriority LIKE '%LOW%' AND o_orderpriority NOT LIKE '%5%'""")
def allowed_texts(t):
    return t("orders").where(texts.allowed(F.col("o_orderpriority"), ["urg", "low"], ["5"])).select("o_orderkey")


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'inactive' ELSE 'active' END AS status, CASE c_custkey % 5 WHEN 0 THEN 'unknown' WHEN 1 THEN 'success' WHEN 2 THEN 'success' WHEN 3 THEN 'unknown' ELSE 'failed' END AS run FROM customer""")
def codes_and_runs(t):
    k, today = F.col("c_custkey"), F.lit("2026-01-05").cast("date")
    of = F.when(k % 5 == 0, F.date_sub(today, 1)).when(k % 5 > 2, F.when(k % 5 == 4, today)).when(k % 5 == 1, today)
    written = F.when(k % 5 == 2, F.lit("2026-01-05 07:00:00").cast("timestamp"))
    return t("customer").select("c_custkey", entity.store_status(F.when(k % 4 == 0, " 2").otherwise("1"), ["2", "3"]).alias("status"), status.run_health(F.when(k % 5 == 1, "ok").otherwise("error"), of, today, written).alias("run"))
