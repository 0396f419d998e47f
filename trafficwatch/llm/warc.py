"""WARC derivatives: responses -> linked metadata and plain-text conversion records.

A *response* row is one captured page: record id (if the source has one), target URI,
capture date, the HTTP response as bytes (headers, empty line, payload) and the digests that
its source states. Rows come from a table of pages (:func:`responses`) or from the
response records of an archive (:func:`captured`). Each gives its response record, byte by byte, and

* a ``metadata`` record (application/warc-fields) with title, declared language,
  character set, counts and outgoing links, and
* a ``conversion`` record (text/plain) with the page's visible text.

Both carry their own WARC-Record-ID, WARC-Refers-To (the response's id) with the refers-to
target URI and date, the response's source headers (as WARC-Source-* fields of the
metadata body), the response's payload digest and their own block digest. Digests of the
source are kept as they are. Ids follow from the content, so a repeated or retried run
makes the same records. Only the conversion text is decoded, by the declared charset.

Files: :func:`write_warc` writes records as gzip members, one record each, into a
table of archive blocks that Spark writes; :func:`read_warc` parses such blocks back.
"""
from __future__ import annotations

import base64
import codecs
import functools
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficwatch.llm.base import map_batches, record, scratch_path, slices

VERSION = "WARC/1.1"
#: Date of captures whose source states none (fixed, so records are reproducible).
CAPTURED = "2024-01-01T00:00:00Z"
#: Bytes of records per archive block (a larger record is a block of its own).
BLOCK_BYTES = 512 << 10
#: Bytes of archive blocks that a task writing or reading a file holds at once, or one larger block.
GROUP_BYTES = 4 << 20
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122 URL namespace
_RECORD_TYPE = ("record_id string, type string, target_uri string, date string, refers_to string, "
                "refers_to_target_uri string, refers_to_date string, content_type string, "
                "block_digest string, payload_digest string, content_length long, block binary")
_RECORD = pa.schema([("page_id", pa.int64()), *((n, pa.string()) for n in (
    "record_id", "type", "target_uri", "date", "refers_to", "refers_to_target_uri", "refers_to_date",
    "content_type", "block_digest", "payload_digest")), ("content_length", pa.int64()), ("block", pa.binary())])

_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_BREAK = re.compile(r"</?(?:p|div|br|li|ul|ol|tr|table|h[1-6]|section|article|header|footer|nav|main|aside|"
                    r"blockquote|pre|title|body|head|html|hr|form|dl|dt|dd|figure)\b[^>]*>", re.I)
_TAG = re.compile(r"</?[A-Za-z!?][^>]*>")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.I)
_CHARSET = re.compile(r"<meta\b[^>]*?\bcharset\s*=\s*[\"']?([A-Za-z0-9_:.-]+)", re.I)
_LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)


def shown(page: str) -> str:
    """The page without comments, scripts, styles and templates."""
    return _HIDDEN.sub(" ", page)


def visible_text(page: str) -> str:
    """Text of a page: what is :func:`shown`, a line per block element, entities
    decoded, blanks joined, empty lines dropped."""
    return _lines(shown(page))


def _lines(shown_page: str) -> str:
    text = html.unescape(_TAG.sub("", _BREAK.sub("\n", shown_page)))
    return "\n".join(line for line in (" ".join(part.split()) for part in text.split("\n")) if line)


def links(page: str, base: str) -> list[str]:
    """Absolute targets of the page's anchors, first occurrences in page order."""
    return _links(shown(page), base)


#: A path on the same host that needs no resolving.
_PLAIN_PATH = re.compile(r"/(?!/)[^\s.;?#\\]*", re.A)


def _links(shown_page: str, base: str) -> list[str]:
    raw = dict.fromkeys(a or b or c for a, b, c in _LINK.findall(shown_page))
    found: dict[str, None] = {}
    try:
        parts = urlsplit(base)
        host = f"{parts.scheme}://{parts.netloc}" if parts.scheme in ("http", "https") and parts.netloc else None
    except ValueError:  # not a URL
        host = None
    for written in raw:
        target = html.unescape(written).strip()
        if host and _PLAIN_PATH.fullmatch(target):
            found[host + target] = None
        elif target and not target.startswith(("#", "javascript:", "mailto:")):
            try:
                found[urljoin(base, target)] = None
            except ValueError:
                continue
    return list(found)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def agrees(label: str, block: bytes) -> bool:
    """Does a digest label (``algorithm:value``, base 32 or hex) fit the block? A label of an
    unknown algorithm cannot be checked and is taken as it is."""
    name, _, value = label.partition(":")
    if label.startswith("sha1:"):
        return value == digest(block)[5:] or value.lower() == hashlib.sha1(block).hexdigest()
    if (name := name.lower().replace("-", "")) not in ("md5", "sha1", "sha256", "sha512"):
        return True
    own = hashlib.new(name, block)
    return value.lower() in (own.hexdigest(), base64.b32encode(own.digest()).decode().rstrip("=").lower())


_HTTP_CHARSET = re.compile(rb"^content-type:[^\r\n]*?charset\s*=\s*[\"']?([A-Za-z0-9_:.-]+)", re.I | re.M)
_META_CHARSET = re.compile(rb"<meta\b[^>]*?\bcharset\s*=\s*[\"']?([A-Za-z0-9_:.-]+)", re.I)


@functools.lru_cache(1024)
def _codec(name: bytes) -> str:
    try:
        return codecs.lookup(name.decode("ascii")).name
    except LookupError:
        return "utf-8"


def decoded(headers: bytes, payload: bytes) -> str:
    """The payload as text, by the charset of its HTTP headers or else of its first 2 KB; UTF-8
    if none or an unknown one is declared. Bytes that do not fit become U+FFFD."""
    found = _HTTP_CHARSET.search(headers) or _META_CHARSET.search(payload, 0, 2048)
    try:
        return payload.decode(_codec(found.group(1)) if found else "utf-8", "replace")
    except (LookupError, ValueError):  # a codec that gives no text
        return payload.decode("utf-8", "replace")


def record_id(kind: str, *parts: str) -> str:
    """A name-based UUID URN."""
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, chr(0).join((kind, *parts)))}>"


def _field(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split())


def metadata_block(page: str, size: int, outlinks: list[str], http_headers: bytes, text_size: int) -> bytes:
    def first(pattern: re.Pattern) -> str | None:
        match = pattern.search(page)
        return _field(html.unescape(match.group(1))) if match else None

    fields = [("title", first(_TITLE)), ("languages-declared", first(_LANG)), ("charset-declared", first(_CHARSET)),
              ("html-length", str(size)), ("text-length", str(text_size)),
              *(("WARC-Source-Header", _field(line)) for line in http_headers.decode("latin-1").split("\r\n") if line),
              *(("outlink", _field(link)) for link in outlinks)]
    return "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None).encode()


#: The header of pages whose table states none.
PAGE_HEADER = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def responses(pages: DataFrame) -> DataFrame:
    """Response rows of a (page_id, url, html) table. A null url or page counts as empty;
    rows that repeat a page have the same record id."""
    none = F.lit(None).cast("string")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), none.alias("record_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("target_uri"), F.lit(CAPTURED).alias("date"),
        F.concat(F.lit(PAGE_HEADER), F.coalesce(F.col("html").cast("string"), F.lit(""))).cast("binary").alias("block"),
        none.alias("block_digest"), none.alias("payload_digest"))


def captured(records: DataFrame) -> DataFrame:
    """Response rows of the response records of an archive; ids, bytes and digests are kept."""
    return records.where("type = 'response'").select(
        "page_id", "record_id", "target_uri", "date", "block", "block_digest", "payload_digest")


def derive(responses_: DataFrame) -> DataFrame:
    """Three records per response row (page_id, record_id, target_uri, date, block, block_digest,
    payload_digest): response, metadata, conversion, each with its WARC fields and block.

    A null record_id is made from URI, date and payload digest, a null digest from its bytes. A
    block without an empty line is all headers. Rows are independent: repeated rows give
    repeated records, an empty payload an empty conversion block, a null block counts as empty,
    an empty table gives no records. Other columns are not read.
    """
    return map_batches(responses_.select(*_RESPONSE), _derived, f"page_id long, {_RECORD_TYPE}", text="block")


_RESPONSE = ("page_id", "record_id", "target_uri", "date", "block", "block_digest", "payload_digest")


def _derived(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The records of a batch of response rows."""
    yield record(_RECORD, *zip(*_derived_rows(batch), strict=True))


def _derived_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The records of a batch of response rows, each a tuple in the order of its schema."""
    for page_id, given, uri, date, response, of_block, of_payload in zip(
            *(c.to_pylist() for c in batch.columns), strict=True):
        response, uri = response or b"", uri or ""
        headers, _, payload = response.partition(b"\r\n\r\n")
        of_payload = of_payload or digest(payload)
        source = given or record_id("response", uri, date, of_payload)
        content = shown(decoded(headers, payload))
        converted = _lines(content).encode("utf-8", "replace")
        described = metadata_block(content, len(payload), _links(content, uri), headers, len(converted))
        yield (page_id, source, "response", uri, date, None, None, None, "application/http; msgtype=response",
               of_block or digest(response), of_payload, len(response), response)
        for kind, content_type, block in (("metadata", "application/warc-fields", described),
                                          ("conversion", "text/plain; charset=utf-8", converted)):
            own = digest(block)
            yield (page_id, record_id(kind, source, own), kind, uri, date, source, uri, date,
                   content_type, own, of_payload, len(block), block)


_FIELDS = (("WARC-Type", "type"), ("WARC-Record-ID", "record_id"), ("WARC-Target-URI", "target_uri"),
           ("WARC-Date", "date"), ("WARC-Refers-To", "refers_to"),
           ("WARC-Refers-To-Target-URI", "refers_to_target_uri"), ("WARC-Refers-To-Date", "refers_to_date"),
           ("Content-Type", "content_type"), ("WARC-Block-Digest", "block_digest"),
           ("WARC-Payload-Digest", "payload_digest"))


def record_bytes(row: dict) -> bytes:
    """One WARC record."""
    head = "".join(f"{name}: {_field(row[key])}\r\n" for name, key in _FIELDS if row[key] is not None)
    return f"{VERSION}\r\n{head}Content-Length: {len(row['block'])}\r\n\r\n".encode() + row["block"] + b"\r\n\r\n"


#: Compressed bytes that a member is given at once.
_STEP = 64 << 10


def members(data: bytes) -> Iterator[bytes]:
    """The gzip members of an archive block, one after the other, each byte read once."""
    view, at = memoryview(data), 0
    while at < len(view):
        member, parts = zlib.decompressobj(wbits=31), []
        while not member.eof and at < len(view):
            parts.append(member.decompress(view[at:at + _STEP]))
            at += len(view[at:at + _STEP])
        if not member.eof:
            raise ValueError("truncated gzip member")
        at -= len(member.unused_data)
        yield b"".join(parts)


def parse_records(data: bytes) -> Iterator[dict]:
    """Records of uncompressed WARC bytes; raises ValueError where they are damaged."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n") if end >= 0 else [""]
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        size = int(fields["Content-Length"])
        block = data[end + 4:end + 4 + size]
        if len(block) != size or data[end + 4 + size:end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"truncated WARC record at byte {at}")
        if "WARC-Block-Digest" in fields and not agrees(fields["WARC-Block-Digest"], block):
            raise ValueError(f"block digest differs at byte {at}")
        yield {key: fields.get(name) for name, key in _FIELDS} | {"content_length": size, "block": block}
        at = end + 8 + size


def write_warc(records: DataFrame, path: str) -> None:
    """Writes records to a table of archive blocks (page_ids, warc): each block is a run
    of gzip members, one record each, that any WARC reader can read on its own."""
    _written(records.select(*_RECORD.names).mapInArrow(_packed, "page_ids array<long>, warc binary"), path)


def write_derivatives(responses_: DataFrame, path: str) -> None:
    """:func:`write_warc` of the :func:`derive`-d records, in one pass of each task over its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _blocks(dict(zip(_RECORD.names, row, strict=True)) for batch in batches
                       for piece in slices(batch, "block", BLOCK_BYTES) for row in _derived_rows(piece))

    _written(responses_.select(*_RESPONSE).mapInArrow(run, "page_ids array<long>, warc binary"), path)


def _written(blocks: DataFrame, path: str) -> None:
    """Writes archive blocks in row groups of about :data:`GROUP_BYTES`, a page for each block. By
    default Parquet first looks at the size of what it holds after 100 rows, here hundreds of MB,
    and compresses and reads that as one page; the blocks are compressed already."""
    (blocks.write.option("compression", "none").option("parquet.block.size", GROUP_BYTES)
     .option("parquet.page.size.row.check.min", 1).option("parquet.page.size.row.check.max", 1).parquet(path))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archive blocks of batches of records."""
    return _blocks(row for batch in batches for piece in slices(batch, "block", BLOCK_BYTES)
                   for row in piece.to_pylist())


def _blocks(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    """Archive blocks of records, one a batch."""
    schema = pa.schema([("page_ids", pa.list_(pa.int64())), ("warc", pa.binary())])
    ids, packed, held = [], [], 0
    for row in rows:
        if ids and held + len(row["block"]) > BLOCK_BYTES:
            yield record(schema, [ids], [b"".join(packed)])
            ids, packed, held = [], [], 0
        ids.append(row["page_id"])
        packed.append(zlib.compress(record_bytes(row), 1, wbits=31))
        held += len(row["block"])
    if ids:
        yield record(schema, [ids], [b"".join(packed)])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of :func:`write_warc`, parsed and with their block digests checked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data in zip(*batch.columns, strict=True):
                rows = [r for member in members(data.as_buffer()) for r in parse_records(member)]
                yield record(_RECORD, ids.as_py(), *([r[name] for r in rows] for name in _RECORD.names[1:]))

    return spark.read.parquet(path).select("page_ids", "warc").mapInArrow(run, f"page_id long, {_RECORD_TYPE}")


def derivative_report(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Builds the pages' derivative archive (by default in the shared scratch folder),
    reads it back and returns its records, each with its block's SHA-256 instead of the block."""
    path = path or scratch_path(pages.sparkSession, "warc")
    write_derivatives(responses(pages), path)
    return read_warc(pages.sparkSession, path).withColumn("block_sha256", F.sha2("block", 256)).drop("block")
