"""Workbooks: rows of sheets as they are pulled from the XML, and headers of several layers as a DataFrame job over the cells of all files."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
SPANS = "array<struct<top:int,left:int,bottom:int,right:int>>"
ROWS = f"_path string, row int, cells array<string>, merged {SPANS}"


def place_of(ref: str) -> tuple[int, int]:
    """Row and column, from 0, of a reference as B3."""
    letters, digits = re.match(r"([A-Z]+)(\d+)", ref).groups()
    column = 0
    for c in letters:
        column = 26 * column + ord(c) - 64
    return int(digits) - 1, column - 1


def strings(book: zipfile.ZipFile) -> list[str]:
    """The texts that cells name by number."""
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as f:
        for _, e in ElementTree.iterparse(f):
            if e.tag == f"{MAIN}si":
                out.append("".join(t.text or "" for t in e.iter(f"{MAIN}t")))
                e.clear()
    return out


def pulled(raw: bytes, sheet: int = 1, last: int | None = None) -> Iterator[tuple[int, list[str]]]:
    """(row from 0, cells as text) of a sheet up to row `last`; one row is held at a time, and nothing behind the last one is read."""
    with zipfile.ZipFile(io.BytesIO(raw)) as book:
        known = strings(book)
        with book.open(f"xl/worksheets/sheet{sheet}.xml") as f:
            data, n = None, 0
            for event, e in ElementTree.iterparse(f, ("start", "end")):
                if event == "start":
                    data = e if e.tag == f"{MAIN}sheetData" else data
                    continue
                if e.tag != f"{MAIN}row":
                    continue
                n = int(e.get("r", n + 1))
                if last is not None and n - 1 > last:
                    return
                cells: list[str] = []
                for c in e.iterfind(f"{MAIN}c"):
                    at = place_of(c.get("r"))[1] if c.get("r") else len(cells)
                    cells += [""] * (at - len(cells))
                    value = c.find(f"{MAIN}v")
                    text = "".join(t.text or "" for t in c.iter(f"{MAIN}t")) if c.get("t") == "inlineStr" else "" if value is None else value.text or ""
                    cells.append(known[int(text)] if c.get("t") == "s" and text else text)
                yield n - 1, cells
                data.clear()


def spans(raw: bytes, sheet: int = 1) -> list[tuple[int, int, int, int]]:
    """The merged ranges of a sheet: top, left, bottom, right. They stand behind the rows, which are passed over."""
    with zipfile.ZipFile(io.BytesIO(raw)) as book, book.open(f"xl/worksheets/sheet{sheet}.xml") as f:
        out, data = [], None
        for event, e in ElementTree.iterparse(f, ("start", "end")):
            if event == "start" and e.tag == f"{MAIN}sheetData":
                data = e
            elif event == "end" and e.tag == f"{MAIN}row":
                data.clear()
            elif event == "end" and e.tag == f"{MAIN}mergeCell":
                first, _, second = e.get("ref").partition(":")
                out.append((*place_of(first), *place_of(second or first)))
        return out


def rows_of(path: str, raw: bytes, sheet: int, first: int, last: int | None, size: int = 10_000) -> Iterator[pa.RecordBatch]:
    """ROWS of a sheet in batches; the merged ranges are with row 0."""
    kinds = pa.list_(pa.struct([(x, pa.int32()) for x in ("top", "left", "bottom", "right")]))
    batch: list[tuple] = []

    def made():
        out = pa.RecordBatch.from_arrays([pa.array([path] * len(batch)), pa.array([b[0] for b in batch], pa.int32()), pa.array([b[1] for b in batch], pa.list_(pa.string())), pa.array([b[2] for b in batch], kinds)], ["_path", "row", "cells", "merged"])
        batch.clear()
        return out

    for n, cells in pulled(raw, sheet, last):
        if n >= first:
            batch.append((n, cells, [dict(zip(("top", "left", "bottom", "right"), s, strict=True)) for s in spans(raw, sheet)] if n == 0 else None))
        if len(batch) >= size:
            yield made()
    if batch:
        yield made()


def sheet_rows(files: DataFrame, sheet: int = 1, last: int | None = None) -> DataFrame:
    """ROWS of the workbooks among binaryFile rows (path, content), from any store that Spark reads."""

    def each(batches):
        for batch in batches:
            for path, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield from rows_of(path, raw.as_py(), sheet, 0, last)

    return files.select("path", "content").mapInArrow(each, ROWS)


class SheetSource(DataSource):
    """`spark.read.format("sheet")`: ROWS of workbooks, a partition each. Options: paths (one a line, of any file system that Arrow knows), sheet.
    Conditions on `row` are pushed into the parser, which stops behind the last row that is wanted."""

    @classmethod
    def name(cls) -> str:
        return "sheet"

    def schema(self) -> str:
        return ROWS

    def reader(self, schema) -> DataSourceReader:
        return SheetReader(self.options["paths"].split("\n"), int(self.options.get("sheet", "1")))


def sheets(spark, paths: list[str], sheet: int = 1) -> DataFrame:
    """ROWS of workbooks by the data source, with conditions on `row` pushed into it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SheetSource)
    return spark.read.format("sheet").option("paths", "\n".join(paths)).option("sheet", sheet).load()


class SheetReader(DataSourceReader):
    def __init__(self, paths: list[str], sheet: int):
        self.paths, self.sheet, self.first, self.last = paths, sheet, 0, None

    def pushFilters(self, filters):
        """Takes what bounds `row`; Spark keeps the rest."""
        for f in filters:
            column, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if column == ("row",) and isinstance(f, LessThan | LessThanOrEqual | EqualTo):
                top = value - isinstance(f, LessThan)
                self.last = top if self.last is None else min(self.last, top)
            if column == ("row",) and isinstance(f, GreaterThan | GreaterThanOrEqual | EqualTo):
                self.first = max(self.first, value + isinstance(f, GreaterThan))
            if column != ("row",) or not isinstance(f, LessThan | LessThanOrEqual | EqualTo | GreaterThan | GreaterThanOrEqual):
                yield f

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        path = partition.value
        where, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:/") else (fs.LocalFileSystem(), path)
        with where.open_input_stream(name) as f:
            yield from rows_of(path, f.read(), self.sheet, self.first, self.last)


def header_names(rows: DataFrame, layers: int) -> DataFrame:
    """(_path, place, name) of each column of each sheet of ROWS, from its first `layers` rows.

    A cell of a merged range says what its first cell says. Lower layers in which, as written, only one text stands tell columns nothing apart, and are
    left out. A column is called by its layers, joined with `_`, the same text in a row once; a column without any is col and its place. Where a merged range
    of the top row has a text, the texts below it that differ from its own are its members: as many as it is wide are called range_member; fewer
    take the places behind its first column, which has the range's own name."""
    head = rows.where(F.col("row") < layers)
    width = head.groupBy("_path").agg(F.max(F.size("cells")).alias("width"))
    grid = width.select("_path", F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("place")).crossJoin(F.broadcast(rows.sparkSession.range(layers).select(F.col("id").cast("int").alias("row"))))
    written = head.select("_path", "row", F.posexplode("cells").alias("place", "text")).withColumn("text", F.trim("text")).where("text <> ''")
    ranges = head.where("row = 0").select("_path", F.explode("merged").alias("m")).select("_path", "m.*")
    at = ["_path", "row", "place"]
    over = ranges.join(written, (ranges["_path"] == written["_path"]) & (ranges["top"] == written["row"]) & (ranges["left"] == written["place"])).select(ranges["_path"], "top", "left", "bottom", "right", "text")
    covered = over.select("_path", F.explode(F.sequence("top", F.least("bottom", F.lit(layers - 1)))).alias("row"), "left", "right", "text").select("_path", "row", F.explode(F.sequence("left", "right")).alias("place"), F.col("text").alias("above"))
    said = grid.join(written, at, "left").join(covered, at, "left").select(*at, F.coalesce("above", "text").alias("text"))
    idle = written.where("row > 0").groupBy("_path", "row").agg(F.count_distinct("text").alias("n")).where("n = 1").select("_path", "row")
    layered = said.join(idle, ["_path", "row"], "left_anti").groupBy("_path", "place").agg(F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("row", "text")))).alias("said"))
    texts = F.transform("said", lambda x: x["text"])
    once = F.filter(texts, lambda x, i: (i == 0) | (x != F.get(texts, i - 1)))
    plain = layered.select("_path", "place", F.when(F.size("said") > 0, F.array_join(once, "_")).otherwise(F.concat(F.lit("col"), F.col("place").cast("string"))).alias("name"))
    group = over.where((F.col("top") == 0) & (F.col("right") > F.col("left")))
    below = said.where("row = 1").select("_path", "place", F.col("text").alias("member")).where("member is not null")
    inside = group.join(below, "_path").where((F.col("place") >= F.col("left")) & (F.col("place") <= F.col("right")) & (F.col("member") != F.col("text")))
    members = Window.partitionBy("_path", "left").orderBy("place")
    named = inside.select("_path", "left", "right", "text", "member", F.row_number().over(members).alias("k"), F.count("*").over(Window.partitionBy("_path", "left")).alias("n"))
    full = F.col("n") == F.col("right") - F.col("left") + 1
    given = named.select("_path", (F.col("left") + F.col("k") - F.when(full, 1).otherwise(0)).alias("place"), F.when(full, F.concat_ws("_", "text", "member")).otherwise(F.col("member")).alias("given"))
    given = given.union(named.where(~full & (F.col("k") == 1)).select("_path", "left", "text"))
    # a member that would stand outside its range has no column there
    name = F.trim(F.translate(F.coalesce("given", "name"), "（）", "()"))
    return plain.join(given, ["_path", "place"], "left").select("_path", "place", name.alias("name"))


def sheet_table(rows: DataFrame, columns: list[str], layers: int = 1) -> DataFrame:
    """_path and the columns of these names of the sheets of ROWS, as text: "" where a sheet hasn't one or a row is short, rows without content left out."""
    names = header_names(rows, layers).groupBy("_path").agg(F.array_sort(F.collect_list(F.struct("place", "name"))).alias("named"))
    body = rows.where((F.col("row") >= layers) & F.exists("cells", lambda x: F.trim(x) != "")).select("_path", "cells").join(names, "_path")
    of = lambda c: F.coalesce(F.get("cells", F.get(F.filter("named", lambda x: x["name"] == c), F.lit(0))["place"]), F.lit(""))
    return body.select("_path", *[of(c).alias(c) for c in columns])
