"""Sinks: text tables for spreadsheets, Markdown reports, dated copies, and the check of what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

BOM = "﻿"


class NotWritten(ValueError):
    """What was read back is not what was to be written."""


def raw_path(root: str, batch: str, table: str, day: str, scope: str | None = None) -> str:
    """Place of a raw file: batches and scopes never overwrite each other."""
    return f"{root.rstrip('/')}/raw/{batch}/{table}_{day}" + (f"_{scope}" if scope else "")


def text_table(df: DataFrame, path: str, files: int = 1) -> None:
    """UTF-8 text tables with a header; its first name carries the byte order mark that spreadsheet programs look for. Every part file
    has its own header. `files` is 1 for reports, which are small; more for anything else."""
    first = df.columns[0]
    cells = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])
    cells.withColumnRenamed(first, BOM + first).coalesce(files).write.mode("overwrite").option("emptyValue", "").csv(path, header=True, encoding="UTF-8")


def workbook(df: DataFrame, path: str, merged: list[str] = (), header: list[list[str]] | None = None) -> None:
    """A report as a workbook of one sheet: header rows (the column names, if none are given), merged ranges, and the rows of df as text. Rows come to the
    driver one partition at a time, as a sheet is one file; for reports."""
    import io
    import zipfile
    from xml.sax.saxutils import escape

    kinds = "http://schemas.openxmlformats.org/package/2006/content-types"
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel, office = "http://schemas.openxmlformats.org/package/2006/relationships", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    xml = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    row = lambda values: "<row>" + "".join(f'<c t="inlineStr"><is><t xml:space="preserve">{escape("" if v is None else str(v))}</t></is></c>' for v in values) + "</row>"
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
        part = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        z.writestr("[Content_Types].xml", f'{xml}<Types xmlns="{kinds}"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{part}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{part}.worksheet+xml"/></Types>')
        z.writestr("_rels/.rels", f'{xml}<Relationships xmlns="{rel}"><Relationship Id="r1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'{xml}<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="1" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'{xml}<Relationships xmlns="{rel}"><Relationship Id="r1" Type="{office}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        with z.open("xl/worksheets/sheet1.xml", "w") as f:
            f.write(f'{xml}<worksheet xmlns="{main}"><sheetData>{"".join(map(row, header or [df.columns]))}'.encode())
            for values in df.toLocalIterator():
                f.write(row(values).encode())
            cells = "".join(f'<mergeCell ref="{m}"/>' for m in merged)
            f.write(f"</sheetData>{f'<mergeCells>{cells}</mergeCells>' if cells else ''}</worksheet>".encode())
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(raw.getvalue()))
    out.close()


def markdown(df: DataFrame, most: int = 100) -> str:
    """A report table of at most `most` rows, in the order of df; where df has more, a last line says that they are left out."""
    rows = df.limit(most + 1).collect()
    more = [["…"] * len(df.columns)] if len(rows) > most else []
    text = lambda v: "--" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = [df.columns, ["-"] * len(df.columns), *[[text(v) for v in r] for r in rows[:most]], *more]
    return "\n".join("| " + " | ".join(line) + " |" for line in lines)


def written(df: DataFrame, path: str, tag: str | None = None, value: str | None = None) -> int:
    """Writes Parquet and reads it back: the rows that went in, by number and by a hash that no order changes, and the batch's tag among them. Gives the number of
    rows. What went in is counted by the write itself, so the source is read once, and what was written once."""
    return checked(df, path, tag, value)["n"]


def checked(df: DataFrame, path: str, tag: str | None = None, value: str | None = None) -> dict:
    """As written, with {"n", "hash"}."""
    marks = [F.count("*").alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("hash"), (F.count_if(F.col(tag) == value) if tag else F.count("*")).alias("tagged")]
    seen = Observation()
    df.observe(seen, *marks).write.mode("overwrite").parquet(path)
    went, back = seen.get, df.sparkSession.read.schema(df.schema).parquet(path).agg(*marks).first().asDict()
    if went != back or (tag and back["n"] and not back["tagged"]):
        raise NotWritten(f"{path}: {back} of {went}")
    return {"n": back["n"], "hash": back["hash"]}


def dated_copy(df: DataFrame, root: str, day: str) -> str:
    """A copy of a small master table under its day."""
    path = f"{root.rstrip('/')}/snapshot_date={day}"
    df.write.mode("overwrite").parquet(path)
    return path


def backup(store, to: str) -> dict[str, dict]:
    """Copies of the current version of every table, each read back: {table: {rows, hash}}, the hash being that of all rows in any order. Also
    written beside the copies, as manifest."""
    out, state = {}, store.current()
    for t in state["tables"]:
        back = checked(store.read(t, at=state), f"{to.rstrip('/')}/{t}")
        out[t] = {"rows": back["n"], "hash": str(back["hash"])}
    rows = [(t, x["rows"], x["hash"]) for t, x in out.items()]
    if rows:
        store.spark.createDataFrame(rows, "`table` string, rows bigint, hash string").coalesce(1).write.mode("overwrite").json(f"{to.rstrip('/')}/manifest")
    return out
