"""WARC derivatives: linked metadata and plain-text conversion records from responses.

Each response record gives two records that refer to it by its id: ``metadata`` with the
source's HTTP headers, digests and what the page says of itself, and ``conversion``
with its text. Digests are SHA-1 in base 32, as WARC tools write them. Records are
text, so Spark's own text writer makes the files (``write_warc``).
"""

from __future__ import annotations

import base64
import hashlib
import gzip
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = "WARC/1.1"
END = "\r\n\r\n"  # behind every record
DATE = "2024-01-01T00:00:00Z"  # of responses whose capture time is not known

#: Elements whose content is no text, and elements that begin a new line. A head hides
#: nothing of its own: its end may be left out, and only its title is text.
HIDDEN = "script|style|template|noscript|textarea|svg|title"
TO_END = {"!", "script", "style", "template", "textarea", "title"}  # without an end (! is a comment) the page ends in them
BLOCKS = (
    "address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr|li|main|"
    "nav|ol|p|pre|section|table|td|th|tr|ul"
)
TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title\s*>|$)", re.I | re.S)
LANGUAGE = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
UNSEEN = re.compile(rf"<!--|<({HIDDEN})(?=[\s/>])[^>]*>", re.I)
CLOSING = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in HIDDEN.split("|")}
CLOSING["!"] = re.compile(r"-->|(?<!<!)--!>")
BREAK = re.compile(rf"</?(?:{BLOCKS})\b[^>]*>", re.I)
TAG = re.compile(r"</?[A-Za-z!?][^>]*(?:>|$)")
BLANKS = re.compile(r"[^\S\n]+")

FIELDS = (
    "record_id string, warc_type string, refers_to string, refers_to_target_uri string, refers_to_date string, "
    "target_uri string, date string, content_type string, block_digest string, source_payload_digest string, "
    "content_length long, header string, block string"
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def shown(page: str) -> str:
    """The page with a blank for each comment and hidden element, whichever begins first."""
    parts, at, place, open_ = [], 0, 0, set()
    while found := UNSEEN.search(page, place):
        name, place = (found[1] or "!").lower(), found.end()
        if name in open_ or (name == "svg" and found[0].endswith("/>")):
            continue
        end = CLOSING[name].search(page, place if found[1] else place - 2)  # <!--> is a whole comment
        if end is None and name not in TO_END:
            open_.add(name)  # ends before what follows; only its tag goes
            continue
        parts.append(page[at : found.start()])
        at = place = len(page) if end is None else end.end()
    return " ".join([*parts, page[at:]])


def plain_text(page: str) -> str:
    """The visible text, a line for each block: hidden elements go, entities are resolved."""
    page = shown(page)
    page = html.unescape(TAG.sub("", BREAK.sub("\n", page.replace("\r", " ").replace("\n", " "))))
    lines = (BLANKS.sub(" ", line).strip() for line in page.split("\n"))
    return "\n".join(line for line in lines if line)


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records of a table of pages: page_id, record_id, target_uri, date, http_header, payload.

    A null page has an empty payload. The id depends on page_id and url alone.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    name = F.md5(F.concat_ws("\n", F.col("page_id").cast("string"), F.col("url")))
    marks = F.regexp_replace(name, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")
    header = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body)
    )
    return pages.select(
        "page_id", marks.alias("record_id"), F.col("url").alias("target_uri"), F.lit(date).alias("date"),
        header.alias("http_header"), body.alias("payload"),
    )


def record_header(fields: dict[str, str | int | None]) -> str:
    """The header of a record; fields without a value are left out, line ends in values become blanks."""
    lines = [f"{name}: {' '.join(str(value).split())}" for name, value in fields.items() if value is not None]
    return "\r\n".join([VERSION, *lines])


def derive(record: dict) -> tuple[dict, dict]:
    """The metadata and the conversion record of one response."""
    source, uri, date = record["record_id"], record["target_uri"], record["date"]
    page, http = record["payload"] or "", record["http_header"] or ""
    payload = page.encode()
    whole = (http + END).encode() + payload
    ids = {
        kind: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source} {kind}')}>" for kind in ("metadata", "conversion")
    }
    title, language = TITLE.search(page), LANGUAGE.search(page)
    text = plain_text(page)
    lines = [
        f"sourcePayloadDigest: {digest(payload)}", f"sourceBlockDigest: {digest(whole)}", f"sourceContentLength: {len(whole)}",
        f"conversionRecord: {ids['conversion']}", f"conversionWords: {len(text.split())}",
    ]
    if title:
        lines.append(f"title: {' '.join(html.unescape(TAG.sub('', title[1])).split())}")
    if language:
        lines.append(f"language: {language[1]}")
    lines += [f"sourceHeader: {' '.join(line.split())}" for line in http.splitlines() if line.strip()]
    blocks = {"metadata": "\r\n".join([*lines, ""]), "conversion": text}
    kinds = {"metadata": "application/warc-fields", "conversion": "text/plain; charset=utf-8"}
    found = []
    for kind, block in blocks.items():
        data = block.encode()
        row = {
            "record_id": ids[kind], "warc_type": kind, "refers_to": source, "refers_to_target_uri": uri,
            "refers_to_date": date, "target_uri": uri, "date": date, "content_type": kinds[kind],
            "block_digest": digest(data), "source_payload_digest": digest(payload), "content_length": len(data),
        }
        row["header"] = record_header(
            {
                "WARC-Type": kind, "WARC-Record-ID": ids[kind], "WARC-Date": date, "WARC-Target-URI": uri,
                "WARC-Refers-To": source, "WARC-Refers-To-Target-URI": uri, "WARC-Refers-To-Date": date,
                "WARC-Block-Digest": row["block_digest"], "Content-Type": kinds[kind], "Content-Length": len(data),
            }
        )
        found.append(row | {"block": block})
    return tuple(found)


def derivatives(records: DataFrame, key: str | None = None) -> DataFrame:
    """Two rows per response record: its metadata and its conversion, with header and block.

    ``records`` has record_id, target_uri, date, http_header and payload (text); nulls are
    allowed: an empty payload converts to an empty text, a null header has no lines,
    other nulls leave their header fields out. ``key`` names a column to carry along.
    Repeated records give repeated derivatives; other columns are not read.
    """
    schema = T.StructType(
        ([records.schema[key]] if key else []) + T._parse_datatype_string(FIELDS).fields
    )
    names = ["record_id", "target_uri", "date", "http_header", "payload"]

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [name for name in schema.fieldNames() if name != key]
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                rows = [row for record in part.select(names).to_pylist() for row in derive(record)]
                columns = [pa.array([row[name] for row in rows], pa.int64() if name == "content_length" else pa.string()) for name in own]
                if key:
                    twice = pa.array([i // 2 for i in range(len(rows))], pa.int64())
                    columns.insert(0, part.column(key).take(twice))
                yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return records.select(*([key] if key else []), *names).mapInArrow(convert, schema)


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records (header, block) as WARC files, one a task."""
    lines = records.select(F.concat("header", F.lit(END), "block").alias("value"))
    lines.write.option("lineSep", END).option("compression", compression).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """header and block of every record of the files of ``write_warc``, compressed by gzip or not.

    A folder without such files, and a file that ends within a record, fail.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column("content"):
                data, at, rows = value.as_buffer().to_pybytes(), 0, []
                if data[:2] == b"\x1f\x8b":
                    data = gzip.decompress(data)
                while at < len(data):
                    end = data.index(END.encode(), at)
                    header = data[at:end].decode()
                    size = int(re.search(r"^Content-Length: (\d+)\r?$", header, re.M)[1])
                    block = data[end + 4 : end + 4 + size]
                    if len(block) < size:
                        raise ValueError(f"a record ends after {len(block)} of {size} bytes")
                    rows.append((header, block.decode()))
                    at = end + 8 + size
                headers, blocks = zip(*rows, strict=True) if rows else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(headers, pa.string()), pa.array(blocks, pa.string())], ["header", "block"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{txt,txt.gz}").load(path)
    if files.select("path").isEmpty():
        raise ValueError(f"no WARC files in {path}")
    return files.select("content").mapInArrow(parse, "header string, block string")
