"""Derivatives of WARC responses: a metadata and a plain-text conversion record each.

Both refer to the response by WARC-Refers-To, with its target URI and date. The metadata
record keeps the response's WARC and HTTP headers and its digests, and names
title, language, links and the conversion that belongs to it. The conversion record holds the
visible text of the page, a line for each block. Record numbers are derived from
the response's number, so a repeated run gives equal records.

A response with null or empty content gives metadata without HTTP fields and an empty
conversion; content that is no HTML gives an empty conversion; a head that does not
end is all head. Bytes that are not valid in the charset are replaced. Null
headers are left out. Rows with equal record_id give equal identifiers, each row its own
pair. Columns other than those of a response are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from altigrid.llm.common import small_batches
from altigrid.llm.html_blocks import blocks, decoded as references

# No search runs past the next "<", so pages of unclosed tags take linear time.
_TITLE, _TITLE_END = re.compile(r"<title\b[^<>]*>", re.I), re.compile("</title", re.I)
_LANGUAGE = re.compile(r"<html\b[^<>]*?(?<![\w-])lang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.I)
_LINK = re.compile(r"<a\b[^<>]*?(?<![\w-])href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)
RECORD = (
    "warc_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
    "block_digest string, payload_digest string, source_block_digest string, source_payload_digest string, block binary, record binary"
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records (record_id, target_uri, date, content) of a table of pages (page_id, url, html)."""
    html = F.coalesce("html", F.lit(""))
    mark = F.md5(F.concat_ws("\x1f", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit("")), html))
    cut = [F.substring(mark, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"))
    return pages.select(
        F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">")).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(date).alias("date"), F.encode(F.concat(head, html), "utf-8").alias("content"),
    )


def _name(record_id: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{kind} {record_id}'.encode()).digest(), version=3)}>"


def split_http(content: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and body of an HTTP response."""
    head, _, body = content.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    pairs = [(k.strip(), v.strip()) for k, colon, v in (x.partition(":") for x in lines[1:]) if colon]
    return lines[0], pairs, body


def decoded(body: bytes, content_type: str) -> str:
    found = _CHARSET.search(content_type) or _CHARSET.search(body[:2048].decode("ascii", "replace"))
    try:
        return body.decode(found[1] if found else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def _line(text: str) -> str:
    return references(text).strip()


def _title(page: str) -> list[str]:
    """The text of the first title that has an end, if there is one."""
    begin = _TITLE.search(page)
    end = begin and _TITLE_END.search(page, begin.end())
    return [page[begin.end():end.start()]] if end else []


def record_bytes(kind: str, record_id: str, headers: list[tuple[str, str | None]], content_type: str, block: bytes) -> bytes:
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id), *headers, ("Content-Type", content_type), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {_line(v) if k != 'WARC-Target-URI' else v}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.0\r\n" + head.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def derivatives(record_id: str | None, target_uri: str | None, date: str | None, content: bytes | None) -> list[tuple]:
    """The metadata and the conversion row of one response."""
    content, source = content or b"", record_id or ""
    status, headers, body = split_http(content)
    kind = next((v for k, v in headers if k.lower() == "content-type"), "")
    is_html = "html" in kind.lower() or (not kind and b"<" in body[:512])
    page = decoded(body, kind) if is_html else ""
    text = "".join(b.text + "\n" for b in blocks(page)).encode("utf-8", "replace")
    metadata_id, conversion_id = _name(source, "metadata"), _name(source, "conversion")
    block_digest, payload_digest = digest(content), digest(body)
    fields: list[tuple[str, str]] = [("source-record-id", source), ("source-block-digest", block_digest), ("source-payload-digest", payload_digest), ("conversion-id", conversion_id)]
    fields += [("http-status", status)] * bool(status) + [(f"http-header-{k.lower()}", v) for k, v in headers]
    fields += [("title", _line(t)) for t in _title(page)]
    fields += [("language", m[1]) for m in [_LANGUAGE.search(page)] if m]
    fields += [("outlink", _line(next(filter(None, m), ""))) for m in _LINK.findall(page)]
    metadata = "".join(f"{k}: {_line(v)}\r\n" for k, v in fields).encode("utf-8", "replace")
    linked = [("WARC-Target-URI", target_uri), ("WARC-Date", date), ("WARC-Refers-To", record_id), ("WARC-Refers-To-Target-URI", target_uri), ("WARC-Refers-To-Date", date)]
    out = []
    for warc_type, own, content_type, block in (
        ("metadata", metadata_id, "application/warc-fields", metadata), ("conversion", conversion_id, "text/plain; charset=utf-8", text)
    ):
        mark = digest(block)
        more = [("WARC-Block-Digest", mark), ("WARC-Payload-Digest", mark), ("WARC-Source-Payload-Digest", payload_digest)]
        raw = record_bytes(warc_type, own, [*linked, *more], content_type, block)
        out.append((warc_type, own, record_id, target_uri, date, content_type, mark, mark, block_digest, payload_digest, block, raw))
    return out


def derive(responses: DataFrame) -> DataFrame:
    """Two rows (see RECORD) per response: its metadata and its conversion record, with the bytes of each."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string()] * 10 + [pa.binary()] * 2
        names = [f.split()[0] for f in RECORD.split(", ")]
        for batch in small_batches(batches, "content"):
            columns = [batch.column(c).to_pylist() for c in ("record_id", "target_uri", "date", "content")]
            rows = [r for source in zip(*columns) for r in derivatives(*source)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return responses.select("record_id", "target_uri", "date", "content").mapInArrow(build, RECORD)


def write_records(records: DataFrame, path: str) -> None:
    """Derived records as gzipped WARC files (they are UTF-8 text)."""
    text = F.decode(F.col("record"), "utf-8")
    records.select(F.substring(text, F.lit(1), F.length(text) - 4).alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of such files again: headers (map) and block."""
    raw = spark.read.option("lineSep", "\r\n\r\nWARC/1.0\r\n").text(path).where("value <> ''")
    whole = F.regexp_replace(F.regexp_replace("value", "^WARC/1.0\r\n", ""), "\r\n\r\n$", "")
    head = F.substring_index("whole", "\r\n\r\n", 1)
    return raw.select(whole.alias("whole")).select(
        F.map_from_entries(F.transform(F.split(head, "\r\n"), lambda h: F.struct(F.substring_index(h, ": ", 1), F.regexp_replace(h, "^[^:]*: ", "")))).alias("headers"),
        F.expr("substring(whole, length(substring_index(whole, '\r\n\r\n', 1)) + 5)").alias("block"),
    )
