"""Text cells to typed values: Column builders only, so that all of it stays in generated JVM code.

Blank cells are never 0; values that can't be compared (infinities and the like) become null with a flag of their own; ids stay text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings of an empty cell, of a value that can't be compared, and of a placeholder. Fixed values.
BLANKS = ["", "-", "--"]
NOT_COMPARABLE = ["∞", "-∞", "inf", "-inf", "infinity", "nan", "null", "none"]
PLACEHOLDERS = ["", "-", "--", "—", "–", "无", "不适用", "未知", "unknown", "null", "NULL", "None", "nan", "NaN", "N/A", "n/a", "/"]
INCOMPARABLE = "不可比"

#: Twenty-six digits before the point, twelve after it.
EXACT = "decimal(38,12)"
NUMBER = r"^-?[0-9]+(\.[0-9]+)?$"
GROUPED = r"^-?[0-9]{1,3}(,[0-9]{3})+(\.[0-9]+)?$"


#: White space of every kind: what Unicode calls so, the four separators of ASCII, and the byte order mark. Fixed values.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"


def clean(c: Column) -> Column:
    """Null to empty; white space of every kind off both ends."""
    return F.btrim(F.coalesce(c.cast("string"), F.lit("")), F.lit(SPACES))


def named(c: Column, f) -> Column:
    """f of a value that f uses often: it stands in the plan once."""
    return F.element_at(F.transform(F.array(c), f), 1)


def is_blank(c: Column) -> Column:
    return clean(c).isin(BLANKS)


def blank_to_null(c: Column) -> Column:
    text = clean(c)
    return F.when(~text.isin(BLANKS), text)


def placeholder_to_blank(c: Column) -> Column:
    text = clean(c)
    return F.when(text.isin(PLACEHOLDERS), F.lit("")).otherwise(text)


def not_comparable(c: Column) -> Column:
    return F.lower(clean(c)).isin(NOT_COMPARABLE)


def is_number(c: Column) -> Column:
    """The whole cell is a plain or a thousands-grouped decimal; an exponent is none."""
    return clean(c).rlike(NUMBER) | clean(c).rlike(GROUPED)


def parse_number(c: Column, to: str = EXACT) -> Column:
    """The number of a cell that is nothing else; exact, so that long ids keep their last digits. What has more than 26 digits before the point has no place
    in `to`; whole_number() has its text."""
    return _number_in(clean(c), to)


def _number_in(text: Column, to: str = EXACT) -> Column:
    """parse_number of a clean text; wide spaces within it don't count."""
    narrow = F.replace(text, F.lit("　"), F.lit(""))
    return F.when(narrow.rlike(NUMBER) | narrow.rlike(GROUPED), F.replace(narrow, F.lit(","), F.lit("")).try_cast(to))


def whole_number(c: Column) -> Column:
    """The digits of a whole number of any length, without idle zeros, as text."""
    return _whole_in(clean(c))


def _whole_in(text: Column) -> Column:
    narrow = F.replace(text, F.lit("　"), F.lit(""))
    plain = F.replace(narrow, F.lit(","), F.lit(""))
    digits = F.regexp_replace(F.regexp_replace(plain, r"^(-?)0+(?=[0-9])", "$1"), "^-0$", "0")
    return F.when(narrow.rlike(r"^-?[0-9]+$") | narrow.rlike(r"^-?[0-9]{1,3}(,[0-9]{3})+$"), digits)


def parse_integer(c: Column) -> Column:
    """Exact whole numbers of up to 38 digits."""
    text = F.regexp_replace(clean(c), ",", "")
    return F.when(text.rlike(r"^-?[0-9]{1,38}$"), text.try_cast("decimal(38,0)"))


def _with_unit(c: Column, unit: str, scale: float = 1.0) -> Column:
    found = F.regexp_extract(c, rf"^(-?[0-9]+(?:\.[0-9]+)?){unit}$", 1)
    value = F.when(found != "", found.try_cast(EXACT))
    return value if scale == 1.0 else (value / F.lit(int(scale))).cast(EXACT)


def parse_percent(c: Column) -> Column:
    """8.16% to 0.0816; a label that merely ends in a percent sign is no number."""
    return _with_unit(clean(c), "%", 100.0)


def parse_points(c: Column) -> Column:
    """2.10pp to 2.10: percentage points keep their unit's size."""
    return _with_unit(clean(c), "(?:pp|PP)")


def parse_duration(c: Column) -> Column:
    """A number of seconds, minutes, hours or days as written; the unit is dropped, not converted."""
    return _with_unit(clean(c), "(?:秒|分钟|分|小时|时|天)")


def round_money(c: Column) -> Column:
    """Half up to two places; what is no number becomes null."""
    return F.round(parse_number(c, "decimal(38,10)"), 2).cast("decimal(38,2)")


def parse_cell(c: Column, money: bool = False, percent_header: bool = False) -> Column:
    """Typed value of a cell: struct<kind, number, text>. Blank and incomparable cells have no number; a column of a percent header has
    hundredths of plain numbers and blanks for all else, one of money has cents and blanks; else the whole cell tells: percent,
    points, duration, number, or text as it is. A whole number that is too long for `number` has its digits as text."""
    return named(clean(c), lambda text: _typed(text, money, percent_header))


def _typed(text: Column, money: bool, percent_header: bool) -> Column:
    c, blank, number = text, F.lit("").cast("string"), _number_in(text)
    of = lambda kind, value=None, shown=None: F.struct(F.lit(kind).alias("kind"), (F.lit(None) if value is None else value).cast(EXACT).alias("number"), (F.lit(None) if shown is None else shown).cast("string").alias("text"))
    out = F.when(text.isin(BLANKS), of("blank", None, blank)).when(F.lower(text).isin(NOT_COMPARABLE), of("incomparable", None, F.lit(INCOMPARABLE)))
    if percent_header:
        return out.when(number.isNotNull(), of("percent", number / 100)).otherwise(of("blank", None, blank))
    if money:
        cents = F.round(_number_in(text, "decimal(38,10)"), 2).cast("decimal(38,2)")
        return out.when(number.isNotNull(), of("money", cents, cents)).otherwise(of("blank", None, blank))
    for kind, value in (("percent", parse_percent(c)), ("points", parse_points(c)), ("duration", parse_duration(c)), ("number", number)):
        out = out.when(value.isNotNull(), of(kind, value))
    return out.when(_whole_in(text).isNotNull(), of("number", None, _whole_in(text))).otherwise(of("text", None, text))


def display_cell(c: Column) -> Column:
    """The text view of a cell: blank spellings to empty, incomparable ones to one word."""
    return F.when(is_blank(c), F.lit("")).when(not_comparable(c), F.lit(INCOMPARABLE)).otherwise(clean(c))


def lenient_float(c: Column) -> Column:
    """A float or null; commas make it null."""
    text = clean(c)
    return F.when(text.rlike(r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$"), text.try_cast("double"))


#: Units that a displayed number may carry; and what a name says of a column: ids, money. Fixed values.
UNITS = "秒|分钟|分|小时|时|天|日|元|块|%|次|单|人|个|件|笔|km|米|m|g|kg|ml|L"
ID_NAMES = ["编号", "SKU"]
MONEY_NAMES = ["金额", "销售额", "收入", "毛利", "补贴", "退款", "费", "损失", "价"]
FINE = "decimal(38,18)"


def without_unit(c: Column) -> Column:
    """A displayed number without its unit; other text as it is."""
    body = F.regexp_extract(c, rf"^(-?[0-9]+(?:,[0-9]{{3}})*(?:\.[0-9]+)?)\s*(?:{UNITS})$", 1)
    return F.when(body != "", F.replace(body, F.lit(","), F.lit(""))).otherwise(c)


def decimal_of_display(c: Column) -> Column:
    """Decimal of a displayed number: exponent, thousands, percent sign and a unit behind it are understood. It never goes through a float."""
    text = F.regexp_replace(clean(c), ",", "")
    share = F.regexp_extract(text, r"^(-?[0-9]+(?:\.[0-9]+)?)%$", 1)
    plain = without_unit(text)
    whole = plain.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$")
    return F.when(share != "", (share.try_cast("decimal(38,16)") / 100).cast(FINE)).when(whole, plain.try_cast(FINE))


def numbers_equal(a: Column, b: Column, tolerance: float = 1e-9) -> Column:
    """Equal up to a share of the larger; where one is 0, up to the tolerance itself."""
    off = F.abs(a - b)
    return F.when((a == 0) | (b == 0), off <= tolerance).otherwise(off <= F.lit(tolerance) * F.greatest(F.abs(a), F.abs(b)))


def decimal_text(c: Column) -> Column:
    """A decimal without idle zeros, and without an exponent."""
    return F.when(c == 0, "0").otherwise(F.regexp_replace(F.replace(F.format_number(c, 18), F.lit(","), F.lit("")), r"\.?0+$", ""))


def comparable(c: Column, name: str, side: str, ids: list[str] = ()) -> Column:
    """The text by which a stored and a source cell are compared. Ids stay as they are. A percent sign divides by 100, once; under a header
    with (%), a bare number does too, on the source's side. Rates and money are rounded to two places, half up; residues of floats below
    5e-7 are 0; points and units lose their sign; other text stays."""
    return named(clean(c), lambda text: _comparable(text, name, side, ids))


def _comparable(text: Column, name: str, side: str, ids: list[str]) -> Column:
    blank = text.isin([*PLACEHOLDERS, "∞", "-∞"])
    if name in ids or any(x in name for x in ID_NAMES):
        return F.when(text.isin(PLACEHOLDERS), "").otherwise(text)
    signed = text.rlike(r"^-?[0-9]+(\.[0-9]+)?%$")
    points = F.regexp_extract(text, r"^(-?[0-9]+(?:\.[0-9]+)?)(?i:pp)$", 1)
    value = F.when(points != "", points.try_cast(FINE)).otherwise(decimal_of_display(text))
    if any(x in name for x in ("%)", "％)", "%）", "％）")):
        if side == "source":
            value = named(value, lambda v: F.when(signed, v).otherwise((v / 100).cast(FINE)))
    elif "率" in name or any(x in name for x in MONEY_NAMES):
        value = F.round(value, 2)
    tiny = F.lit("0.0000005").cast(FINE)
    shown = named(value, lambda v: decimal_text(F.when(text.rlike("[eE]") & (F.abs(v) < tiny), F.lit(0).cast(FINE)).otherwise(v)))
    return F.when(blank, "").otherwise(F.coalesce(shown, text))


# -- dates ---------------------------------------------------------------------------------------------------------------------------------

DATE = r"^([0-9]{4})[-/.]?([0-9]{2})[-/.]?([0-9]{2})"
LOOSE_DATE = r"([0-9]{4})[-/年.]([0-9]{1,2})[-/月.]([0-9]{1,2})"


def date_prefix(c: Column) -> Column:
    """yyyy-MM-dd of a cell that begins with a date of eight digits, with or without signs between; else blank."""
    text = clean(c)
    return F.when(text.rlike(DATE), F.concat_ws("-", *[F.regexp_extract(text, DATE, i) for i in (1, 2, 3)])).otherwise("")


def compact_date(c: Column) -> Column:
    """yyyyMMdd of the first date in a cell, whatever the signs between and however few digits month and day have; else the first eight digits
    in a row; else the cell."""
    text = clean(c)
    part = lambda i, n: F.lpad(F.regexp_extract(text, LOOSE_DATE, i), n, "0")
    return F.when(text.rlike(LOOSE_DATE), F.concat(part(1, 4), part(2, 2), part(3, 2))).when(text.rlike("[0-9]{8}"), F.regexp_extract(text, "[0-9]{8}", 0)).otherwise(text)


def strict_date(c: Column) -> Column:
    """A date that exists, or null: the 30th of February is none."""
    text = F.regexp_replace(clean(c), "^([0-9]{4})([0-9]{2})([0-9]{2})$", "$1-$2-$3")
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), text.try_cast("date"))


def days_in(c: Column) -> Column:
    """The distinct days named in a cell as yyyyMMdd, in order of appearance."""
    text = F.regexp_replace(clean(c), r"([0-9]{4})[-/.]([0-9]{2})[-/.]([0-9]{2})", "$1$2$3")
    return F.array_distinct(F.regexp_extract_all(text, F.lit("([0-9]{8})"), F.lit(1)))


def last_day(c: Column) -> Column:
    """The last date in a cell: the end of a range."""
    return strict_date(F.element_at(F.when(F.size(days_in(c)) > 0, days_in(c)).otherwise(F.array(F.lit(""))), -1))


def lenient_day(c: Column) -> Column:
    """yyyyMMdd of a cell that is a day of eight digits, a day with dashes, alone or before a time, or a range of days of eight digits, whose end counts; null
    for anything else. Whether there is such a day isn't asked."""
    text = clean(c)
    dashed = F.replace(F.regexp_extract(text, r"^([0-9]{4}-[0-9]{2}-[0-9]{2})([ T]|$)", 1), F.lit("-"), F.lit(""))
    found = [F.regexp_extract(text, "^[0-9]{8}$", 0), F.regexp_extract(text, r"^[0-9]{8}\s*-\s*([0-9]{8})$", 1), dashed]
    return F.coalesce(*[F.nullif(d, F.lit("")) for d in found])


def date_sort_key(c: Column) -> Column:
    """Fourteen digits that sort as the moment a cell names; unknown ones last."""
    digits = F.regexp_replace(date_prefix(c), "[^0-9]", "")
    rest = F.regexp_replace(F.regexp_extract(clean(c), DATE + r"(.*)$", 4), "[^0-9]", "")
    return F.when(clean(c).rlike(DATE), F.rpad(F.substring(F.concat(F.substring(digits, 1, 8), rest), 1, 14), 14, "0")).otherwise(F.lit("99999999999999"))


def to_epoch_millis(day: Column, zone: str = "Asia/Shanghai", end: bool = False) -> Column:
    """Milliseconds of the first or the last moment of a day in a zone."""
    first = F.unix_millis(F.to_utc_timestamp(day.cast("timestamp"), zone))
    return first + F.lit(86_399_999) if end else first


def local_hour(millis: Column, zone: str = "Asia/Shanghai") -> Column:
    return F.hour(F.from_utc_timestamp(F.timestamp_millis(millis), zone))


def local_time(millis: Column, zone: str = "Asia/Shanghai") -> Column:
    return F.date_format(F.from_utc_timestamp(F.timestamp_millis(millis), zone), "yyyy-MM-dd HH:mm:ss")


def local_iso_time(c: Column, zone: str = "Asia/Shanghai") -> Column:
    """Local time of an ISO timestamp; null if it is none."""
    return F.from_utc_timestamp(F.try_to_timestamp(clean(c)), zone)


def previous_month(day: Column) -> tuple[Column, Column]:
    first = F.add_months(F.trunc(day, "month"), -1)
    return first, F.last_day(first)


def rolling_window(day: Column, days: int) -> tuple[Column, Column]:
    """The `days` days before a day."""
    return F.date_sub(day, days), F.date_sub(day, 1)


# -- names, formats, keys --------------------------------------------------------------------------------------------------------------------


def store_name(c: Column) -> Column:
    """No white space around, no wide spaces, full-width parentheses and middle dots to half-width ones. Nothing else: names are never guessed."""
    return clean(F.translate(clean(c), "（）·．　", "().."))


def column_name(name: str) -> str:
    """A column's name without a byte order mark or white space around it, and with half-width parentheses."""
    return name.strip("\ufeff").strip().replace("（", "(").replace("）", ")").strip()


def short_name(c: Column, prefixes: list[str] = ()) -> Column:
    """A store's name without brand prefixes and parentheses."""
    out = c.cast("string")
    for p in prefixes:
        out = F.replace(out, F.lit(p), F.lit(""))
    return F.translate(out, "（）()", "")


def untabbed(c: Column) -> Column:
    """A migrated cell: no value is blank, leading tabs and white space go."""
    return F.when(F.lower(clean(c)).isin("nan"), "").otherwise(clean(c))


#: Names that several platforms give to one column, and what they become. Fixed values.
RENAMES = {
    "一级品类": "品类",
    "商品信息": "商品名称",
    "门店名称": "门店",
    "店铺名称": "门店",
    "商家名称": "门店",
    "日期": "业务日期",
    "开始日期": "业务日期",
    "开始时间": "业务日期",
    "评价提交日期": "业务日期",
}
CHANGE = "_环比波动"


def output_name(name: str, renames: dict[str, str] = RENAMES) -> str:
    """A column's name after the renames; changes of rates are points and say so."""
    new = renames.get(name, name)
    return f"{new}_pp" if name.endswith(CHANGE) and "率" in name.removesuffix(CHANGE) else new


def last_segment(c: Column, between: str = "||") -> Column:
    """What follows the last separator."""
    return F.substring_index(c, between, -1)


def shortened(c: Column, n: int, mark: str = "…") -> Column:
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit(mark))).otherwise(c)


def money_text(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("¥"), F.format_number(c, 2)), F.lit("--"))


def change_text(c: Column) -> Column:
    return F.when(c.isNull(), "--").otherwise(F.format_string("%+.1f%%", c * 100))


def share_text(c: Column) -> Column:
    return F.when(c.isNull(), "--").otherwise(F.format_string("%.1f%%", c * 100))


def weekday_name(day: Column) -> Column:
    names = ["周一", "周二", "周三", "周四", "周五", "周六", "周日"]
    return F.element_at(F.array(*map(F.lit, names)), F.weekday(day) + 1)


def number_for_export(c: Column) -> Column:
    """A whole number, or a float that is whole and below 1e15, as an integer's text; other numbers as they are; text stays."""
    text = clean(c)
    value = text.try_cast("double")
    whole = text.rlike(NUMBER) & (value == F.floor(value)) & (F.abs(value) < 1e15)
    return F.when(text.rlike(r"^-?[0-9]+$"), text).when(whole, value.cast("bigint").cast("string")).otherwise(text)


def short_hash(c: Column) -> Column:
    return F.substring(F.sha1(c), 1, 12)


def task_key(*parts: Column) -> Column:
    """Identity of a task: its fields joined, and a hash of them."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(joined, F.lit("#"), short_hash(joined))


def legacy_number_key(c: Column) -> Column:
    """Dedup key that reads numbers as floats. It damages long ids: for comparison with old data only."""
    return F.coalesce(parse_number(c, "double").cast("string"), clean(c))
