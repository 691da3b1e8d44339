"""Operator 4: WARC derivatives: a metadata and a plain-text conversion record for each response record.

A response keeps its own record id, headers and digests; both derivatives name it in WARC-Refers-To, carry its target, date and payload
digest in their headers, and have an id of their own that is a hash of the response's id and their type, so that a second run makes
the same records. Pages are independent of each other: no shuffle, and some megabytes of pages, or one longer page, in memory at a time.

Archives are read record by record; bodies in chunks and compressed bodies are undone, and the charset is the header's or the page's own.

Defined cases: a null page is an empty payload; a null address leaves out the target header; a page without text converts to an empty
block; repeated rows give repeated records of the same ids, and rows that are equal in id, address and page are such, in whatever order; extra columns are not looked at.
"""

from __future__ import annotations

import base64
import codecs
import gzip
import hashlib
import html
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import slices

VERSION = "WARC/1.1"
HELD = 4_000_000  # bytes of pages whose records are made before they leave a task; a longer page is held alone
DATE = "1970-01-01T00:00:00Z"  # of pages whose table has no date
#: Elements that run to their end tag, or to the end of the page; those that are left out if they end; those that begin a new line. Fixed values.
RAW, HIDDEN = {"script", "style"}, {"noscript", "template", "svg"}
BLOCK = set("p div br li ul ol h1 h2 h3 h4 h5 h6 tr table section article header footer nav aside blockquote pre hr dd dt dl form main".split())
LINKING = {"a", "img", "link", "script", "iframe"}
MARK = re.compile(r"<(?:(!--)|([/!?]?)([a-zA-Z][a-zA-Z0-9]*))")
END = {name: re.compile(rf"</{name}\s*>", re.I) for name in (*RAW, *HIDDEN, "head", "title")}
VALUE = r"\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))"
LANGUAGE, CHARSET, LINK = (re.compile(rf"\b({name}){VALUE}", re.I) for name in ("lang", "charset", "href|src"))


def digest(raw: bytes) -> str:
    """A labelled digest as archives write it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(chr(0).join(parts).encode()).digest()[:16], version=4)}>"


def value(m: re.Match) -> str:
    return html.unescape(next(x for x in m.groups()[1:] if x is not None))


def scanned(page: str) -> tuple[str, list[tuple[str, str]]]:
    """(text, fields of a metadata record) of a page, in one pass from its first tag to its last, so in time in proportion to its length.

    The text is without tags, comments, scripts, styles, the head and hidden elements; a line for each block, entities resolved. An unclosed
    comment is text; an unclosed or self-closed hidden element, and an unclosed head, are ordinary tags. The fields are title, language
    and charset, and links in the order of the page."""
    out: list[str] = []
    facts: dict[str, str] = {}
    links: list[tuple[str, str]] = []
    endless: set[str] = set()
    i = head = 0  # the place read to, and the end of the head
    while m := MARK.search(page, i):
        j = m.start()
        if i >= head:
            out.append(page[i:j])
        if m[1]:
            k = -1 if "--" in endless else page.find("-->", j + 4)
            if k < 0:
                endless.add("--")
            if i >= head:
                out.append("<!--" if k < 0 else " ")
            i = k + 3 if k >= 0 else j + 4
            continue
        k = page.find(">", m.end())
        if k < 0:  # no tag ends from here on
            i = j
            break
        name, tag = m[3].lower(), page[m.end() : k]
        if i >= head and name in BLOCK and m[2] in ("", "/"):
            out.append("\n")
        i = k + 1
        if m[2]:
            continue
        if name == "html" and "language" not in facts and (found := LANGUAGE.search(tag)):
            facts["language"] = value(found)
        elif name == "meta" and "charset" not in facts and (found := CHARSET.search(tag)):
            facts["charset"] = re.match(r"[\w-]*", value(found))[0]
        elif name in LINKING and (found := LINK.search(tag)):
            links.append(("outlink", f"{value(found)} {'L' if name == 'a' else 'E'} {name}/@{found[1].lower()}"))
        if name not in END or name in endless or (tag.endswith("/") and name in HIDDEN) or (name == "title" and "title" in facts):
            continue
        end = END[name].search(page, i)
        if name in RAW:
            i = end.end() if end else len(page)
        elif not end:
            endless.add(name)
        elif name == "title":
            facts["title"] = " ".join(html.unescape(page[i : end.start()]).split())
        elif name == "head":
            head = max(head, end.end())
        else:
            i = end.end()
        if name in RAW | HIDDEN and i >= head and end:
            out.append(" ")
    if i >= head:
        out.append(page[i:])
    lines = (" ".join(x.split()) for x in html.unescape("".join(out)).split("\n"))
    return "\n".join(x for x in lines if x), [(k, facts[k]) for k in ("title", "language", "charset") if k in facts] + links


def plain_text(page: str) -> str:
    return scanned(page)[0]


def unchunked(raw: bytes) -> bytes:
    """The body of a message in chunks; what is no chunk ends it."""
    out, i = [], 0
    while (end := raw.find(b"\r\n", i)) >= 0:
        try:
            n = int(raw[i:end].split(b";")[0], 16)
        except ValueError:
            break
        if n <= 0:
            break
        out.append(raw[end + 2 : end + 2 + n])
        i = end + 4 + n
    return b"".join(out) if out else raw


def decoded(payload: bytes, fields: dict[str, str]) -> str:
    """Text of a payload by its header: transfer and content encoding undone (as it is if it can't be), then the charset of the header, else
    of the page's first kilobyte, else UTF-8."""
    if "chunked" in fields.get("transfer-encoding", "").lower():
        payload = unchunked(payload)
    encoding = fields.get("content-encoding", "").lower()
    for bits in {"gzip": (31,), "x-gzip": (31,), "deflate": (15, -15)}.get(encoding, ()):
        try:
            payload = zlib.decompressobj(bits).decompress(payload)
            break
        except zlib.error:
            continue
    found = re.search(r"charset\s*=\s*[\"']?([\w-]+)", fields.get("content-type", ""), re.I) or re.search(r"<meta[^<>]{0,200}\bcharset\s*=\s*[\"']?([\w-]+)", payload[:1024].decode("latin-1"), re.I)
    try:
        name = codecs.lookup(found[1]).name if found else "utf-8"
        return payload.decode(name, "replace")
    except (LookupError, UnicodeError):
        return payload.decode("utf-8", "replace")


def rendered(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as it stands in a file."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers if v)
    return f"{VERSION}\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def response(page_id: object, url: str | None, page: str | None, date: str = DATE) -> tuple[list[tuple[str, str]], bytes]:
    """Headers and block of the response record of a page that was kept without one."""
    payload = (page or "").encode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", str(page_id), url or "", digest(payload))), ("WARC-Target-URI", url or ""), ("WARC-Date", date)]
    return [*headers, ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block)), ("Content-Type", "application/http; msgtype=response")], block


def derived(headers: list[tuple[str, str]], block: bytes) -> list[tuple[list[tuple[str, str]], bytes]]:
    """The metadata and the conversion record of a response record."""
    of = {k.lower(): v for k, v in headers}
    http, _, payload = block.partition(b"\r\n\r\n")
    lines = [(k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in http.decode("latin-1").split("\r\n")[1:]) if k]
    text, found = scanned(decoded(payload, dict(lines)))
    source, url, date = of.get("warc-record-id", ""), of.get("warc-target-uri", ""), of.get("warc-date", "")
    paid = of.get("warc-payload-digest") or digest(payload)
    fields = [("source-payload-digest", paid), ("source-block-digest", of.get("warc-block-digest") or digest(block)), *((f"source-http-{k}", v) for k, v in lines), *found]
    bodies = [("metadata", "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields).encode()), ("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace"))]
    out = []
    for kind, content, body in bodies:
        own = [("WARC-Type", kind), ("WARC-Record-ID", record_id(kind, source)), ("WARC-Refers-To", source), ("WARC-Target-URI", url), ("WARC-Date", date), ("WARC-Refers-To-Target-URI", url), ("WARC-Refers-To-Date", date), ("WARC-Payload-Digest", digest(body) if kind == "conversion" else ""), ("WARC-Block-Digest", digest(body)), ("Content-Type", content)]
        out.append((own, body))
    return out


def parsed(raw: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Headers and block of each record of a file, plain or gzipped by record, one after another. A record without a readable length has no
    block; reading goes on with the next line that begins a record."""
    file = gzip.GzipFile(fileobj=io.BytesIO(raw)) if raw[:2] == b"\x1f\x8b" else io.BytesIO(raw)
    while line := file.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers = []
        while (line := file.readline().rstrip(b"\r\n")) != b"":
            k, _, v = line.decode("utf-8", "replace").partition(":")
            headers.append((k.strip(), v.strip()))
        n = {k.lower(): v for k, v in headers}.get("content-length", "")
        yield [(k, v) for k, v in headers if k.lower() != "content-length"], file.read(int(n)) if n.isdecimal() else b""


RECORD = "record_type string, record_id string, refers_to string, target_uri string, date string, headers array<struct<name:string,value:string>>, source_payload_digest string, block_digest string, content_length bigint, block binary, record binary"
ROW = pa.schema([("record_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("headers", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))), ("source_payload_digest", pa.string()), ("block_digest", pa.string()), ("content_length", pa.int64()), ("block", pa.binary()), ("record", pa.binary())])


def row(headers: list[tuple[str, str]], block: bytes, paid: str) -> dict:
    of = dict(headers)
    return {"record_type": of["WARC-Type"], "record_id": of["WARC-Record-ID"], "refers_to": of.get("WARC-Refers-To"), "target_uri": of.get("WARC-Target-URI") or None, "date": of.get("WARC-Date"), "headers": [{"name": k, "value": v} for k, v in headers if v], "source_payload_digest": paid, "block_digest": of.get("WARC-Block-Digest"), "content_length": len(block), "block": block, "record": rendered(headers, block)}


def derivatives(pages: DataFrame, id_column: str = "page_id") -> DataFrame:
    """Two records, metadata and conversion, for each page (id, url, html), with the page's id."""

    def each(batches):
        for batch in batches:
            for part in slices(batch, 2, 256, HELD):
                ids, rows = [], []
                for i, url, page in zip(*(part.column(c).to_pylist() for c in range(3)), strict=True):
                    headers, block = response(i, url, page)
                    paid = dict(headers)["WARC-Payload-Digest"]
                    rows += [row(h, b, paid) for h, b in derived(headers, block)]
                    ids += [i, i]
                made = pa.RecordBatch.from_pylist(rows, ROW)
                yield pa.RecordBatch.from_arrays([pa.array(ids, part.column(0).type), *made.columns], ["page_id", *ROW.names])

    kind = pages.schema[id_column].dataType.simpleString()
    return pages.select(id_column, "url", "html").mapInArrow(each, f"page_id {kind}, {RECORD}")


def from_files(files: DataFrame) -> DataFrame:
    """Two records for each response in archive files as Spark's binaryFile source reads them (path, content). A file is one row, so it may
    have 2 GB at most (archives are usually cut at one), and a task holds a file's bytes; its records are read one at a time."""

    def each(batches):
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                rows, held = [], 0
                for headers, block in parsed(raw or b""):
                    of = {k.lower(): v for k, v in headers}
                    if of.get("warc-type", "").lower() == "response":
                        paid = of.get("warc-payload-digest") or digest(block.partition(b"\r\n\r\n")[2])
                        rows += [row(h, b, paid) for h, b in derived(headers, block)]
                        held += len(block)
                    if len(rows) >= 512 or held >= HELD:
                        yield pa.RecordBatch.from_pylist(rows, ROW)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, ROW)

    return files.select("content").mapInArrow(each, RECORD)


def report(pages: DataFrame) -> DataFrame:
    """The records of all pages, with digests in place of their contents."""
    return derivatives(pages).select("page_id", "record_type", "record_id", "refers_to", "target_uri", "source_payload_digest", "block_digest", "content_length", F.sha2("block", 256).alias("block_sha256"), F.sha2("record", 256).alias("record_sha256"))
