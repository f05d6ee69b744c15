"""Web archives: metadata and plain-text records derived from responses.

Each response gives a ``metadata`` and a ``conversion`` record. Both refer to the response by
its record id and repeat its target, its date and its digests; the conversion holds the page's
text, the metadata its title, language, status, links and source headers.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as entities
import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.llm.batches import map_texts, small_batches

VERSION = "WARC/1.1"
#: Date of records whose response states none.
NO_DATE = "1970-01-01T00:00:00Z"
#: Bytes read from an archive file at once.
CHUNK = 1 << 20
#: Elements whose content is no text, and elements that end a line.
_RAW = {
    name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I | re.A)
    for name in ("script", "style", "noscript", "template", "svg")
}
#: Those of them that take the rest of the page where they are not closed, as HTML parsers do.
_TO_END = ("script", "style")
_BLOCK = frozenset(
    "address article aside blockquote br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr li main nav ol p pre section table td th title tr ul".split()
)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)|<[!?]")
_HREF = re.compile(r"""\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", re.I)
_LANG = re.compile(r"""\blang\s*=\s*["']?([A-Za-z-]+)""", re.I)
_SPACE = re.compile(r"[^\S\n]+")

RECORD = (
    "page_id {kind}, warc_type string, record_id string, refers_to string, target_uri string, "
    "date string, content_type string, length long, block_digest string, "
    "payload_digest string, headers array<struct<name:string,value:string>>, block binary"
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    """An id that depends on what the record is made of, so that reruns agree."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(parts))}>"


def page_text(page: str) -> tuple[str, str, str, list[str]]:
    """(text, title, language, links) of an HTML page, in one pass over it.

    Scripts, styles and comments are left out, as is what follows one that is never closed. So
    are closed noscript, template and svg elements; one that is never closed loses its tag only.
    Block elements end a line; character references are resolved.
    """
    out: list[str] = []
    links: list[str] = []
    title, lang, at = "", "", 0
    title_from = -1
    unclosed: set[str] = set()
    while at < len(page):
        found = _TAG.search(page, at)
        if not found:
            out.append(page[at:])
            break
        out.append(page[at:found.start()])
        name = (found.group(2) or "").lower()
        if not name:
            if page.startswith("<!--", found.start()):
                end = page.find("-->", found.end())
                at = len(page) if end < 0 else end + 3
            else:
                end = page.find(">", found.end())
                at = len(page) if end < 0 else end + 1
            continue
        end = page.find(">", found.end())
        if end < 0:
            break
        attributes = page[found.end():end]
        at = end + 1
        closing = found.group(1)
        if name == "title":
            if closing and title_from >= 0 and not title:
                title = "".join(out[title_from:])
            title_from = -1 if closing else len(out)
        if name == "html" and not lang and (hit := _LANG.search(attributes)):
            lang = hit.group(1)
        if name == "a" and not closing and (hit := _HREF.search(attributes)):
            links.append(entities.unescape(hit.group(1).strip("\"'")))
        if name in _BLOCK:
            out.append("\n")
        if name in _RAW and not closing and name not in unclosed:
            raw = _RAW[name].search(page, at)
            if raw:
                end = page.find(">", raw.end())
                at = len(page) if end < 0 else end + 1
            elif name in _TO_END:
                break
            else:
                unclosed.add(name)
    lines = (_SPACE.sub(" ", x).strip() for x in entities.unescape("".join(out)).split("\n"))
    flat = " ".join(entities.unescape(title).split())
    return "\n".join(x for x in lines if x), flat, lang, links


def _record(page_id, kind, rid, refers, uri, date, content_type, block, payload, headers) -> dict:
    return {
        "page_id": page_id, "warc_type": kind, "record_id": rid, "refers_to": refers,
        "target_uri": uri, "date": date, "content_type": content_type, "length": len(block),
        "block_digest": digest(block), "payload_digest": payload,
        "headers": [{"name": n, "value": v} for n, v in headers], "block": block,
    }


def _response(page_id, url: str | None, page: str | None) -> dict:
    payload = (page or "").encode("utf-8", "replace")
    headers = [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]
    head = "HTTP/1.1 200 OK\r\n" + "".join(f"{n}: {v}\r\n" for n, v in headers) + "\r\n"
    return _record(
        page_id, "response", record_id("response", str(page_id), url or "", digest(payload)),
        None, url, NO_DATE, "application/http; msgtype=response", head.encode() + payload,
        digest(payload), headers,
    )


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """(status line, headers, body) of an HTTP response; a block without a head is all body."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/"):
        return "", [], block
    lines = head.decode("iso-8859-1").split("\r\n")
    pairs = [x.partition(":") for x in lines[1:] if ":" in x]
    return lines[0], [(n.strip(), v.strip()) for n, _, v in pairs], body


def _charset(headers: list[tuple[str, str]]) -> str:
    for n, v in headers:
        if n.lower() == "content-type" and "charset=" in v.lower():
            name = v.lower().partition("charset=")[2].split(";")[0].strip("\"' ")
            try:
                "".encode(name)
                return name
            except LookupError:
                return "utf-8"
    return "utf-8"


def derived(response: dict) -> list[dict]:
    """The metadata and the conversion record of a response."""
    status, headers, body = split_http(response["block"] or b"")
    text, title, lang, links = page_text(body.decode(_charset(headers), "replace"))
    rid, uri = response["record_id"], response["target_uri"]
    date = response["date"] or NO_DATE
    source = response["payload_digest"] or digest(body)
    kept = [
        ("WARC-Refers-To-Target-URI", uri or ""), ("WARC-Refers-To-Date", date),
        ("WARC-Source-Block-Digest", response["block_digest"] or digest(response["block"] or b"")),
        ("WARC-Source-Payload-Digest", source),
    ]
    kept = [(n, v) for n, v in kept if v]

    def clean(value: str) -> str:
        return " ".join(value.split())

    fields = [("status", status), ("title", title), ("language", lang)]
    fields += [(f"source-{n.lower()}", v) for n, v in headers] + [("outlink", x) for x in links]
    meta = "".join(f"{n}: {clean(v)}\r\n" for n, v in fields if clean(v)).encode("utf-8", "replace")
    plain = text.encode("utf-8", "replace")
    convert = record_id("conversion", rid, digest(plain))
    return [
        _record(response["page_id"], "metadata", record_id("metadata", rid, digest(meta)), rid,
                uri, date, "application/warc-fields", meta, None,
                [*kept, ("WARC-Concurrent-To", convert)]),
        _record(response["page_id"], "conversion", convert, rid, uri, date,
                "text/plain; charset=utf-8", plain, digest(plain), kept),
    ]


def _arrow(kind: str) -> pa.Schema:
    ids = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    s = pa.string()
    pair = pa.list_(pa.struct([("name", s), ("value", s)]))
    return pa.schema([
        ("page_id", ids), ("warc_type", s), ("record_id", s), ("refers_to", s),
        ("target_uri", s), ("date", s), ("content_type", s), ("length", pa.int64()),
        ("block_digest", s), ("payload_digest", s), ("headers", pair), ("block", pa.binary()),
    ])


def responses(pages: DataFrame) -> DataFrame:
    """A response record for each row of ``pages(page_id, url, html)``.

    Other columns are left out. A null page is empty, a null url gives a record without target.
    Repeated rows give equal records, an empty table none.
    """
    rows = pages.select("page_id", "url", "html")
    kind = rows.schema["page_id"].dataType.simpleString()
    schema = _arrow(kind)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [_response(r["page_id"], r["url"], r["html"]) for r in batch.to_pylist()], schema
        )

    return map_texts(rows, "html", work, RECORD.format(kind=kind))


def derive(records: DataFrame) -> DataFrame:
    """The metadata and conversion records of the responses in ``records``; others give none.

    A response without a block, or whose block is no HTTP message, is treated as a page without
    headers. Missing dates and digests are made up for. Scans and derives in one pass, without
    a shuffle.
    """
    kind = records.schema["page_id"].dataType.simpleString()
    schema = _arrow(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                found = [d for r in batch.slice(at, 64).to_pylist() for d in derived(r)]
                yield pa.RecordBatch.from_pylist(found, schema)

    small_batches(records.sparkSession)
    rows = records.where("warc_type = 'response'").select(*schema.names)
    return rows.mapInArrow(run, RECORD.format(kind=kind))


def member(record: dict) -> bytes:
    """A record as a gzip member; members on end are an archive file."""
    named = [
        ("WARC-Type", record["warc_type"]), ("WARC-Record-ID", record["record_id"]),
        ("WARC-Date", record["date"] or NO_DATE), ("WARC-Target-URI", record["target_uri"]),
        ("WARC-Refers-To", record["refers_to"]),
        ("WARC-Block-Digest", record["block_digest"]),
        ("WARC-Payload-Digest", record["payload_digest"]),
    ]
    if record["warc_type"] != "response":
        named += [(h["name"], h["value"]) for h in record["headers"] or []]
    named += [("Content-Type", record["content_type"]), ("Content-Length", str(record["length"]))]
    head = "".join(f"{n}: {v}\r\n" for n, v in named if v)
    data = f"{VERSION}\r\n{head}\r\n".encode() + record["block"] + b"\r\n\r\n"
    return gzip.compress(data, 6, mtime=0)


def parse(stream, page_id=None) -> Iterator[dict]:
    """The records of an archive, compressed or not, one after the other."""
    if stream.read(2) == b"\x1f\x8b":
        stream.seek(0)
        stream = gzip.GzipFile(fileobj=stream)
    else:
        stream.seek(0)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        named: list[tuple[str, str]] = []
        while (line := stream.readline().rstrip(b"\r\n")):
            n, _, v = line.decode("utf-8", "replace").partition(":")
            named.append((n.strip(), v.strip()))
        of = {n.lower(): v for n, v in named}
        block = stream.read(int(of.get("content-length") or 0))
        kind = of.get("warc-type", "")
        known = {"warc-type", "warc-record-id", "warc-date", "warc-target-uri", "warc-refers-to",
                 "warc-block-digest", "warc-payload-digest", "content-type", "content-length"}
        headers = split_http(block)[1] if kind == "response" else [
            (n, v) for n, v in named if n.lower() not in known
        ]
        yield _record(
            page_id, kind, of.get("warc-record-id"), of.get("warc-refers-to"),
            of.get("warc-target-uri"), of.get("warc-date"), of.get("content-type"), block,
            of.get("warc-payload-digest"), headers,
        )


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of archive files; ``page_id`` is null. Blocks' digests are computed anew."""
    schema = _arrow("bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                part, size = [], 0
                for record in parse(pa.BufferReader(content.as_buffer())):
                    part.append(record)
                    size += record["length"]
                    if size > CHUNK:
                        yield pa.RecordBatch.from_pylist(part, schema)
                        part, size = [], 0
                yield pa.RecordBatch.from_pylist(part, schema)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, RECORD.format(kind="bigint"))


def write_warc(records: DataFrame, folder: str) -> DataFrame:
    """Writes one archive file per partition to a folder that all executors mount.

    A file gets its name when it is complete, so a task that is run again leaves one file.
    Returns (file, records, bytes).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        name = os.path.join(folder, f"part-{TaskContext.get().partitionId():05d}.warc.gz")
        part, count, size = f"{name}.{uuid.uuid4().hex}.part", 0, 0
        with open(part, "wb") as out:
            for batch in batches:
                for record in batch.to_pylist():
                    size += out.write(member(record))
                    count += 1
        os.replace(part, name)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([count], type=pa.int64()),
             pa.array([size], type=pa.int64())], names=["file", "records", "bytes"],
        )

    return records.select(*_arrow("bigint").names).mapInArrow(
        run, "file string, records long, bytes long"
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return derive(responses(pages)).withColumn(
        "headers", F.to_json("headers")
    ).withColumn("block", F.decode("block", "utf-8"))
