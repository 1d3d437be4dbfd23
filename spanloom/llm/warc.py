"""WARC derivatives: each response gives a metadata record and a plain-text conversion record that refer to it.

Both keep the source's record id (``WARC-Refers-To``), target, date and digests; ids of derived records follow from
the source's id, so a repeated run gives the same records. Records are written by Spark's text writer, whose
separator is the two line ends that close a record, and read back by their ``Content-Length``.

Cases: a NULL page is an empty payload and gives an empty text; a NULL url leaves the target out; equal pages under
two ids are records of their own, repeated rows are repeated records; an empty table gives no records; unclosed or
odd markup never stops a task; very long pages are converted whole; further columns are not looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from .common import shuffle_files_released, slices

VERSION = "WARC/1.1"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the namespace of URLs
_SILENT = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b.*?(?:</\1\s*>|\Z)|<!\w[^>]*>", re.S | re.I)
_BREAK = re.compile(r"</?(?:p|div|br|hr|h[1-6]|li|ul|ol|dl|dt|dd|tr|td|th|table|article|section|header|footer|nav|main|aside|blockquote|pre|form|title|head|body)\b[^>]*>", re.I)
_TAG = re.compile(r"<[/a-zA-Z][^>]*>?")
_BLANKS, _LINES = re.compile(r"[^\S\n]+"), re.compile(r" ?\n[ \n]*")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title", re.S | re.I)
_LINK = re.compile(r"""<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_CHARSET = re.compile(r"""<meta\b[^>]*?charset\s*=\s*["']?([\w-]+)""", re.I)
_LANG = re.compile(r"""<html\b[^>]*?\blang\s*=\s*["']?([\w-]+)""", re.I)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def one_line(value: str) -> str:
    """A header or field value: control characters would end its line."""
    return re.sub(r"[\x00-\x20\x7f\x85  ]+", " ", value).strip()


def plain_text(page: str) -> str:
    """The visible text: no scripts, styles or comments; a line for each block; entities resolved."""
    text = _TAG.sub("", _BREAK.sub("\n", _SILENT.sub(" ", page)))
    if "&" in text:
        text = html.unescape(text)
    return _LINES.sub("\n", _BLANKS.sub(" ", text.replace("\r", "\n"))).strip()


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without the two line ends that close it."""
    named = [("WARC-Type", kind), *headers, ("WARC-Block-Digest", digest(block)), ("Content-Length", str(len(block)))]
    return "".join([VERSION, "\r\n", *[f"{k}: {v}\r\n" for k, v in named if v], "\r\n"]).encode() + block


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of a file, by their lengths."""
    at = 0
    while at < len(data):
        if data.startswith(b"\r\n", at):
            at += 2
            continue
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"No record begins at byte {at}.")
        headers = dict(line.split(": ", 1) for line in lines)
        at = end + 4 + int(headers["Content-Length"])
        yield headers, data[end + 4 : at]


def responses(pages: DataFrame, date: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, record_id, target_uri, date, http_headers, payload`` of captured pages, one response each."""
    payload = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    name = F.sha1(F.concat_ws("\n", F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("-")), F.coalesce(F.col(f"`{url_col}`"), F.lit("")), F.sha1(payload)))
    parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    record_id = F.concat(F.lit("<urn:uuid:"), parts[0], F.lit("-"), parts[1], F.lit("-5"), parts[2], F.lit("-a"), parts[3], F.lit("-"), parts[4], F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(payload).cast("string"))
    return pages.select(F.col(f"`{id_col}`").cast("bigint").alias("page_id"), record_id.alias("record_id"), F.col(f"`{url_col}`").alias("target_uri"), F.lit(date).alias("date"), http.alias("http_headers"), payload.alias("payload"))


def derived(source: DataFrame) -> DataFrame:
    """``value``: the text of a metadata and of a conversion record for each response."""

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "payload"):
            out = []
            for page_id, own, uri, date, http, page in zip(*[part[c].to_pylist() for c in ("page_id", "record_id", "target_uri", "date", "http_headers", "payload")], strict=True):
                payload_digest, block_digest = digest(page.encode()), digest(f"{http}\r\n\r\n{page}".encode())
                uri = one_line(uri or "")
                conversion_id, metadata_id = (f"<urn:uuid:{uuid.uuid5(_NAMESPACE, own + kind)}>" for kind in ("conversion", "metadata"))
                text = plain_text(page)
                title, charset, lang = (m.group(1) if (m := p.search(page)) else "" for p in (_TITLE, _CHARSET, _LANG))
                status, *lines = http.split("\r\n")
                links = list(dict.fromkeys(one_line(html.unescape(a or b or c)) for a, b, c in _LINK.findall(page)))
                fields = [
                    ("sourceRecordID", own), ("sourcePayloadDigest", payload_digest), ("sourceBlockDigest", block_digest), ("sourceDate", date),
                    ("sourcePageID", "" if page_id is None else str(page_id)), ("httpStatus", status), *[("httpHeader", h) for h in lines],
                    ("title", one_line(html.unescape(title))), ("charset", charset), ("language", lang), ("conversionRecordID", conversion_id), ("conversionDigest", digest(text.encode())), *[("outlink", x) for x in links],
                ]
                shared = [("WARC-Refers-To", own), ("WARC-Target-URI", uri), ("WARC-Date", date)]
                out.append(record("metadata", [("WARC-Record-ID", metadata_id), *shared, ("Content-Type", "application/warc-fields")], "".join(f"{k}: {v}\r\n" for k, v in fields if v).encode()))
                refers = [("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", date), ("WARC-Source-Payload-Digest", payload_digest), ("WARC-Source-Page-ID", "" if page_id is None else str(page_id))]
                out.append(record("conversion", [("WARC-Record-ID", conversion_id), *shared, *refers, ("Content-Type", "text/plain; charset=utf-8")], text.encode()))
            yield pa.RecordBatch.from_arrays([pa.array([x.decode() for x in out], pa.string())], ["value"])

    return source.mapInArrow(build, "value string")


def write_records(records: DataFrame, path: str, records_per_file: int = 10_000) -> None:
    """Compressed files; each is read by one task, so their size is bounded."""
    with shuffle_files_released(records.sparkSession):
        records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``record_type, record_id, refers_to, target_uri, date, page_id, source_digest, block_digest, content_length, digest_ok, block`` of all records below ``path``."""
    fields = ["record_type", "record_id", "refers_to", "target_uri", "date", "source_digest", "block_digest"]
    names = ["WARC-Type", "WARC-Record-ID", "WARC-Refers-To", "WARC-Target-URI", "WARC-Date", "WARC-Source-Payload-Digest", "WARC-Block-Digest"]

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                data = content.as_py()
                found = list(parse_records(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data))
                for at in range(0, len(found), 1000):
                    rows = found[at : at + 1000]
                    columns = [pa.array([h.get(n) for h, _ in rows], pa.string()) for n in names]
                    pages, sources = [], []
                    for h, block in rows:
                        own = dict(x.split(": ", 1) for x in block.decode().split("\r\n", 6)[:6] if ": " in x) if h["WARC-Type"] == "metadata" else {}
                        page = h.get("WARC-Source-Page-ID") or own.get("sourcePageID")
                        pages.append(int(page) if page else None)
                        sources.append(h.get("WARC-Source-Payload-Digest") or own.get("sourcePayloadDigest"))
                    columns[5] = pa.array(sources, pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(pages, pa.int64()), pa.array([len(b) for _, b in rows], pa.int64()), pa.array([digest(b) == h["WARC-Block-Digest"] for h, b in rows]), pa.array([b.decode() for _, b in rows], pa.string())],
                        [*fields, "page_id", "content_length", "digest_ok", "block"],
                    )

    schema = ", ".join([*[f"{c} string" for c in fields], "page_id bigint, content_length bigint, digest_ok boolean, block string"])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(parse, schema)


def record_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
