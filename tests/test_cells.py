"""Cells to values, and what must never happen: a blank becoming 0, a long id going through a float, a label read as a number."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import cells, texts


def value(spark, build, *texts_):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts_)], "i int, t string")
    return [r[0] for r in rows.select(build(F.col("t")), "i").orderBy("i").collect()]


CASES = [
    (lambda c: cells.parse_cell(c)["number"].cast("double"), ["-", "--", "", " 　", "∞", "NaN", "1,234.5", "12.3%", "top80%商品", "2.10pp", "35.4分", "3天", "1e3", "-7"], [None, None, None, None, None, None, 1234.5, 0.123, None, 2.1, 35.4, 3.0, None, -7.0]),
    (lambda c: cells.parse_cell(c)["text"], ["-", "∞", "top80%商品", "7"], ["", "不可比", "top80%商品", None]),
    (lambda c: cells.parse_cell(c)["number"].cast("decimal(38,0)").cast("string"), ["1975406963517038625", "1975406963517038626"], ["1975406963517038625", "1975406963517038626"]),
    (lambda c: cells.parse_cell(c, money=True)["text"], ["2353.5899999999997", "35%", "--"], ["2353.59", "", ""]),
    (lambda c: cells.parse_cell(c, percent_header=True)["number"].cast("double"), ["8", "8%", "x"], [0.08, None, None]),
    (cells.round_money, ["2.345", "-2.345", "1,000", "x", "--"], [Decimal("2.35"), Decimal("-2.35"), Decimal("1000.00"), None, None]),
    (cells.parse_integer, ["12345678901234567890", "1.5", ""], [Decimal("12345678901234567890"), None, None]),
    (cells.display_cell, [" a ", "-", "inf"], ["a", "", "不可比"]),
    (cells.date_prefix, ["20260801", "2026-08-01 12:00", "2026/08/01", "2026.08.01", "2026-8-1", "100234", "n/a"], ["2026-08-01"] * 4 + ["", "", ""]),
    (cells.compact_date, ["2026-08-01 09:00", "on 2026年8月1日", "20260801-20260831", "x"], ["20260801", "20260801", "20260801", "x"]),
    (lambda c: cells.strict_date(c).cast("string"), ["20260230", "2026-02-28", "28-02-2026"], [None, "2026-02-28", None]),
    (cells.days_in, ["20260801-20260803", "2026-08-01", "none"], [["20260801", "20260803"], ["20260801"], []]),
    (lambda c: cells.last_day(c).cast("string"), ["20260801-20260831", "x"], ["2026-08-31", None]),
    (cells.date_sort_key, ["2026-08-01 09:05:07", "2026-08-01", "?"], ["20260801090507", "20260801000000", "99999999999999"]),
    (cells.store_name, [" 店（一）　店 ", "F·L．X  y", None], ["店(一)店", "F.L.X  y", ""]),
    (cells.last_segment, ["a||b||c", "a"], ["c", "a"]),
    (lambda c: cells.shortened(c, 3), ["abcd", "abc"], ["abc…", "abc"]),
    (cells.number_for_export, ["3.0", "3.5", "007", "x"], ["3", "3.5", "007", "x"]),
    (cells.placeholder_to_blank, ["N/A", "无", "–", "不适用", "none", "暂无", "a"], ["", "", "", "", "none", "暂无", "a"]),
    (cells.lenient_float, ["1e3", "1,000", "--", ".5"], [1000.0, None, None, 0.5]),
    (lambda c: cells.decimal_of_display(c).cast("double"), ["1.5e-7", "12%", "35秒", "x"], [1.5e-7, 0.12, 35.0, None]),
    (lambda c: cells.money_text(c.try_cast("double")), ["1234.5", None], ["¥1,234.50", "--"]),
    (lambda c: cells.change_text(c.try_cast("double")), ["0.248", None], ["+24.8%", "--"]),
    (lambda c: texts.strip_tags(c, ["script"]), ["a<script x>\n1</script>b"], ["ab"]),
    (texts.content_text, ['"hi"', '[{"type":"text","text":"a"},{"type":"tool_result","text":"no"},{"type":"input_text","text":"b"}]', "plain", "[draft] plain"], ["hi", "a\nb", "plain", "[draft] plain"]),
    (texts.message_text, ["a<cwd x>\n1</cwd> <environment_context>b "], ["a b"]),
    (texts.is_system, ["", "Base Risk Taxonomy of", "my own"], [True, True, False]),
    (cells.untabbed, ["\t\tx ", "NaN", None], ["x", "", ""]),
    (lambda c: cells.short_name(c, ["店（"]), ["店（一）", "(b)"], ["一", "b"]),
    (lambda c: texts.allowed(c, ["shop"], ["test"]), ["My SHOP", "shop TEST", "x", None], [True, False, False, False]),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_cells(spark, case):
    build, given, want = CASES[case]
    assert value(spark, build, *given) == want


#: name, source cell, stored cell, whether they are the same.
SIDES = [
    ("占比(%)", "8.16", "0.0816", True),
    ("占比(%)", "8.16%", "0.0816", True),
    ("占比（%）", "100.00", "1", True),
    ("缺货退款率", "4.17%", "0.04", True),
    ("商品毛利率", "0.7848605577689243", "0.78", True),
    ("金额", "2353.5899999999997", "2353.59", True),
    ("金额", "1,234.005元", "1234.01", True),
    ("数量", "1.3877787807814457e-17", "0", True),
    ("时长", "35.40秒", "35.4", True),
    ("波动", "2.10pp", "2.1", True),
    ("备注", "--", "", True),
    ("订单编号", "00123", "123", False),
    ("商品SKU码", "1975406963517038625", "1975406963517038626", False),
    ("数量", "5", "6", False),
]


def test_comparable_sides(spark):
    for name, a, b, same in SIDES:
        x, y = spark.range(1).select(cells.comparable(F.lit(a), name, "source"), cells.comparable(F.lit(b), name, "store")).first()
        assert (x == y) == same, (name, a, b, x, y)


def test_names():
    assert cells.output_name("门店名称") == "门店" and cells.output_name("转化率_环比波动") == "转化率_环比波动_pp" and cells.output_name("人数_环比波动") == "人数_环比波动"


def test_times_and_keys(spark):
    row = spark.range(1).select(
        cells.to_epoch_millis(F.lit("2026-08-01").cast("date")), cells.to_epoch_millis(F.lit("2026-08-01").cast("date"), end=True),
        cells.local_hour(F.lit(1785513600000)), cells.local_time(F.lit(1785513600000)), cells.task_key(F.lit("a"), F.lit(None), F.lit(3)), cells.weekday_name(F.lit("2026-01-05").cast("date")),
        cells.numbers_equal(F.lit(1.0), F.lit(1.0 + 1e-12)), cells.numbers_equal(F.lit(0.0), F.lit(1e-12)), cells.numbers_equal(F.lit(0.0), F.lit(1e-8)),
    ).first()
    assert row[0] == 1785513600000 and row[1] - row[0] == 86_399_999 and row[2] == 0 and row[3] == "2026-08-01 00:00:00"
    assert row[4].startswith("a||3#") and len(row[4]) == 17 and row[5] == "周一" and row[6] and row[7] and not row[8]


def test_column_names_without_marks_and_wide_parentheses():
    assert cells.column_name("\ufeff 商品（单） ") == "商品(单)" and cells.column_name("a (b)") == "a (b)" and cells.column_name("　x　") == "x"
