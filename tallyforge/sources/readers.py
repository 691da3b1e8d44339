"""Readers of report files: text tables of several encodings, nested orders, message logs. Workbooks are in `workbooks`."""

from __future__ import annotations

import functools
import io
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A character that GBK gives for a UTF-8 byte order mark. Fixed value.
MOJIBAKE = "锛"


def decoded(raw: bytes, order: tuple[str, ...] = ("gbk", "utf-8-sig")) -> str:
    """Text of a file in the first encoding that reads it without the tell-tale of a wrong one; the last one replaces what it can't read."""
    for name in order[:-1]:
        try:
            text = raw.decode(name)
        except UnicodeDecodeError:
            continue
        if MOJIBAKE not in text:
            return text.removeprefix("﻿")
    return raw.decode(order[-1], "replace").removeprefix("﻿")


def text_or_none(raw: bytes, order: tuple[str, ...] = ("gbk", "utf-8-sig")) -> str | None:
    """Text of a file in the first encoding that reads it; null where none does."""
    for name in order:
        try:
            return raw.decode(name).removeprefix("﻿")
        except UnicodeDecodeError:
            continue
    return None


def raw_tables(files: DataFrame, encodings: tuple[str, ...] = ("gbk", "utf-8-sig")) -> DataFrame:
    """(path, header, rows) of text tables among binaryFile rows, cells as they are; header and rows are null where a file can't be read in any of
    the encodings, or has no row. A file is one row, so these are small files; raw_rows gives theirs one by one."""

    def rows(batches):
        import pandas as pd

        for pdf in batches:
            for path, raw in zip(pdf["path"], pdf["content"], strict=True):
                text = text_or_none(bytes(raw), encodings)
                own = list(table_rows(text)) if text is not None else []
                yield pd.DataFrame([(path, [c.strip() for c in own[0]] if own else None, own[1:] if own else None)], columns=["path", "header", "rows"])

    return files.select("path", "content").mapInPandas(rows, "path string, header array<string>, rows array<array<string>>")


def raw_rows(files: DataFrame, encodings: tuple[str, ...] = ("gbk", "utf-8-sig"), most: int = 10_000) -> DataFrame:
    """(path, header, row) of each row below the header of text tables among binaryFile rows, cells as they are; files that can't be read in any of the
    encodings have none. Of a file its text is held, but only `most` of its rows at once."""
    kinds = {"path": pa.string(), "header": pa.list_(pa.string()), "row": pa.list_(pa.string())}

    def rows(batches):
        for batch in batches:
            for path, raw in zip(batch.column("path"), batch.column("content"), strict=True):
                text = text_or_none(raw.as_py() or b"", encodings)
                own = table_rows(text or "")
                header = [c.strip() for c in next(own, [])]
                while part := list(itertools.islice(own, most)):
                    columns = [path.as_py()] * len(part), [header] * len(part), part
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds))

    return files.select("path", "content").mapInArrow(rows, "path string, header array<string>, row array<string>")


def table_rows(text: str) -> Iterator[list[str]]:
    import csv

    for row in csv.reader(io.StringIO(text)):
        if any(c.strip() for c in row):
            yield row


def csv_table(spark: SparkSession, paths: list[str], columns: list[str], header_rows: int = 1, encodings: tuple[str, ...] = ("gbk", "utf-8-sig")) -> DataFrame:
    """All cells as text, with the file's name. Files are read whole by executors, one record each, as the encoding is told by all of its
    bytes; blank rows go, short rows are padded, extra cells dropped. Only the listed paths are read, never what else is there."""

    def rows(batches):
        import pandas as pd

        for pdf in batches:
            for path, raw in zip(pdf["path"], pdf["content"], strict=True):
                own = [r + [""] * (len(columns) - len(r)) for r in table_rows(decoded(bytes(raw), encodings))][header_rows:]
                yield pd.DataFrame([[path, i, *r[: len(columns)]] for i, r in enumerate(own)], columns=["_path", "_seq", *columns])

    schema = "_path string, _seq bigint, " + ", ".join(f"`{c}` string" for c in columns)
    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(rows, schema)


def encodings_of(spark: SparkSession, paths: list[str], encodings: tuple[str, ...] = ("gbk", "utf-8-sig")) -> DataFrame:
    """(path, encoding, quoted) of text tables, from a scan that is split like any other: the first encoding in which all lines can be read without the
    tell-tale of a wrong one, else the last; quoted: a quoted cell goes over the end of a line. (No encoding here has a line feed within a character.)"""

    def each(lines: pa.Array) -> pa.Array:
        found = [[] for _ in encodings[:-1]]
        odd = []
        for raw in lines.to_pylist():
            odd.append(raw.count(b'"') % 2 == 1)
            for out, name in zip(found, encodings, strict=False):
                try:
                    out.append(MOJIBAKE not in raw.decode(name))
                except UnicodeDecodeError:
                    out.append(False)
        return pa.StructArray.from_arrays([pa.array(odd, pa.bool_()), *[pa.array(x, pa.bool_()) for x in found]], ["odd", *[f"e{i}" for i in range(len(found))]])

    n = len(encodings) - 1
    flags = F.arrow_udf(each, "odd boolean" + "".join(f", e{i} boolean" for i in range(n)))(F.col("value").cast("binary"))
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), flags.alias("f"))
    fits = F.coalesce(*[F.when(F.bool_and(f"f.e{i}"), F.lit(name)) for i, name in enumerate(encodings[:-1])], F.lit(encodings[-1]))
    return lines.groupBy("path").agg(fits.alias("encoding"), F.bool_or("f.odd").alias("quoted"))


def text_table(spark: SparkSession, paths: list[str], columns: list[str], header_rows: int = 1, encodings: tuple[str, ...] = ("gbk", "utf-8-sig")) -> DataFrame:
    """As csv_table, for tables of any size: a first scan tells each file's encoding, a second one reads it, and both split large files among tasks. Rows have the
    place where their part of the file begins (_block) and their number in it (_seq). Files with cells that go over several lines are read whole."""
    known = encodings_of(spark, paths, encodings).collect()  # a row for each listed path
    of = {r["path"]: r["encoding"] for r in known if not r["quoted"]}
    whole = [r["path"] for r in known if r["quoted"]]

    def rows(batches):
        import csv

        at: dict[tuple[str, int], int] = {}
        for batch in batches:
            out: list[list] = []
            for path, block, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = raw.decode(of[path], "replace").removeprefix("\ufeff")
                cells = next(csv.reader([text]), [])
                if any(c.strip() for c in cells):
                    at[path, block] = n = at.get((path, block), -1) + 1
                    if block or n >= header_rows:
                        out.append([path, block, n, *(cells + [""] * (len(columns) - len(cells)))[: len(columns)]])
            kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * len(columns)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["_path", "_block", "_seq", *columns])

    schema = "_path string, _block bigint, _seq bigint, " + ", ".join(f"`{c}` string" for c in columns)
    found = spark.createDataFrame([], schema)
    if of:
        lines = spark.read.text([p for p in of]).select(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.col("value").cast("binary"))
        found = lines.mapInArrow(rows, schema)
    if whole:
        found = found.unionByName(csv_table(spark, whole, columns, header_rows, encodings).withColumn("_block", F.lit(0).cast("bigint")))
    return found


def daily_files(paths: list[str], table: str) -> list[str]:
    """Those of the listed files that hold a table's days: its name, an underscore and a day; copies of single channels (`_ch` and what follows) aren't."""
    own = re.compile(rf"(^|/){re.escape(table)}_[0-9]{{4}}-?[0-9]{{2}}-?[0-9]{{2}}(?!.*_ch)[^/]*$")
    return [p for p in paths if own.search(p)]


def business_day(df: DataFrame, name: str = "业务日期") -> DataFrame:
    """With the day in the file's name, as table_20260801.csv or table_2026-08-01.csv."""
    return df.withColumn(name, F.regexp_replace(F.regexp_extract("_path", r"([0-9]{4}-?[0-9]{2}-?[0-9]{2})[^/]*$", 1), r"^([0-9]{4})-?([0-9]{2})-?([0-9]{2})$", "$1-$2-$3"))


def table_name(df: DataFrame, name: str = "数据表") -> DataFrame:
    """With the table in the file's name: what precedes the day."""
    return df.withColumn(name, F.regexp_extract("_path", r"([^/]*?)_?[0-9]{4}-?[0-9]{2}-?[0-9]{2}[^/]*$", 1))


def raw_place(df: DataFrame) -> DataFrame:
    """With batch and place (table, day and, if any, scope) of raw files in their own folders, as writers.raw_path lays them out."""
    return df.withColumn("batch", F.regexp_extract("_path", "/raw/([^/]+)/([^/]+)/[^/]+$", 1)).withColumn("place", F.regexp_extract("_path", "/raw/([^/]+)/([^/]+)/[^/]+$", 2))


def file_kind(df: DataFrame) -> DataFrame:
    """binaryFile rows with kind: a workbook begins with PK."""
    return df.withColumn("kind", F.when(F.substring("content", 1, 2) == F.lit(b"PK"), "xlsx").otherwise("csv"))


ORDERS = "orders array<struct<orderId:string,storeName:string,createTime:bigint,orderStatusDesc:string,actualPayAmt:double,bizReceiveAmt:double,productList:array<struct<skuId:string,spuId:string,skuName:string,count:int,totalPayAmount:double>>>>"


def order_rows(files: DataFrame) -> DataFrame:
    """One row for each product of each order of nested order files (value: a file's text); an order without products has one row."""
    nested = files.select(F.from_json("value", ORDERS).alias("f")).select(F.explode("f.orders").alias("o"))
    return nested.select("o.*", F.explode_outer("o.productList").alias("p")).drop("productList").select("*", "p.*").drop("p")


def orders(spark: SparkSession, path: str) -> DataFrame:
    return order_rows(spark.read.text(path, wholetext=True))


def message_rows(lines: DataFrame) -> DataFrame:
    """(ts, role, content) of chat logs with a JSON object a line (value), in the dialects that put the message at the top, in `message` or in
    `payload`; lines that are none are left out. content is text, or JSON of its parts."""
    get = lambda p: F.get_json_object("value", p)
    rows = lines.where(F.try_parse_json("value").isNotNull()).select(
        get("$.timestamp").alias("ts"),
        F.coalesce(get("$.payload.role"), get("$.message.role"), get("$.role"), get("$.type")).alias("role"),
        F.coalesce(get("$.payload.content"), get("$.message.content"), get("$.content")).alias("content"),
    )
    return rows.where("content is not null")


#: Where each dialect of a log has its messages: what tells a line of it (path: value), the paths of its time, of its role (or the role itself), and of its
#: content. Fixed values.
DIALECTS = {
    "item": ({"$.type": "response_item", "$.payload.type": "message"}, ["$.payload.timestamp", "$.timestamp"], "$.payload.role", "$.payload.content"),
    "event": ({"$.type": "event_msg", "$.payload.type": "user_message"}, ["$.timestamp"], "user", "$.payload.content"),
    "wrapped": ({"$.type": None, "$.message.content": None}, ["$.timestamp"], "$.type", "$.message.content"),
    "plain": ({"$.role": None, "$.content": None}, ["$.timestamp", "$.created_at"], "$.role", "$.content"),
}


def dialect_rows(lines: DataFrame) -> DataFrame:
    """(dialect, ts, role, content) of chat logs with a JSON object a line (value): each line is parsed once, as VARIANT, and read by the paths of the first of
    DIALECTS that it fits; lines that are broken or fit none are left out. content is text, or JSON of its parts."""
    at = lambda path: F.try_variant_get("v", path, "string")
    rows = lines.select(F.try_parse_json("value").alias("v")).where("v is not null")
    kind, fields = F.lit(None).cast("string"), {"ts": [], "role": [], "content": []}
    for name, (marks, times, role, content) in reversed(DIALECTS.items()):
        fits = [at(p).isNotNull() if v is None else F.coalesce(at(p) == v, F.lit(False)) for p, v in marks.items()]
        kind = F.when(functools.reduce(lambda a, b: a & b, fits), name).otherwise(kind)
        for k, v in (("ts", F.coalesce(*map(at, times))), ("role", at(role) if role.startswith("$") else F.lit(role)), ("content", at(content))):
            fields[k].append((name, v))
    rows = rows.select(kind.alias("dialect"), "v").where("dialect is not null")
    pick = lambda k: functools.reduce(lambda out, x: F.when(F.col("dialect") == x[0], x[1]).otherwise(out), fields[k], F.lit(None).cast("string")).alias(k)
    return rows.select("dialect", pick("ts"), pick("role"), pick("content")).where("content is not null")


def message_log(spark: SparkSession, path: str) -> DataFrame:
    return message_rows(spark.read.text(path))


def signed(header: Column, must: list[str], never: list[str] = ()) -> Column:
    """Whether a header (an array of names) is of a kind of table: all of its own columns are there, and none of another's; a kind without own columns has
    no tables."""
    words = lambda names: F.array(*map(F.lit, names)).cast("array<string>")
    return F.lit(bool(must)) & (F.size(F.array_except(words(must), header)) == 0) & ~F.coalesce(F.arrays_overlap(header, words(never)), F.lit(False))
