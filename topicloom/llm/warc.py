"""WARC derivatives: from response records, linked metadata records (JSON) and plain-text conversion records.

A derived record keeps the target URI and date of its source, names it in WARC-Refers-To (with -Target-URI and -Date) and has
digests of its own; the metadata hold all WARC and HTTP headers of the source, its digests as found and as computed, and
the id of the conversion record. Files are written by Spark's text writer: a record ends with two line ends, which
are the writer's line separator, so any number of tasks can write and a lost one is written again."""

from __future__ import annotations

import base64
import gzip
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from hashlib import sha1

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the namespace of URLs
RECORDS_PER_FILE = 20_000
CHUNK_BYTES = 8 << 20  # of records that a task hands on at a time
PAGE = "X-Page-ID"  # the header of a response that names its page
FIELDS = "kind string, record_id string, refers_to string, target_uri string, block_digest string, block string"

_comment = re.compile(r"<!--.*?(?:-->|$)", re.S)
_blocks = r"(?:p|div|br|li|ul|ol|tr|table|h[1-6]|article|section|header|footer|nav|blockquote|pre|td|th)\b"
_inert = r"(?><(title|script|style|noscript|template)\b.*?</\{}\s*>)"  # a part of a head whose content is no markup
# A head ends at its end tag; where that is left out, before the body, a block element or whatever else is no part of a head.
_hidden = re.compile(
    r"<(script|style|noscript|template)\b.*?(?:</\1\s*>|$)|<head\b[^>]*(?:>|$)"
    rf"(?:(?>(?:[^<]+|{_inert.format(2)}|(?!</head\b|<body\b|<{_blocks})<)*)</head\s*>|(?>(?:\s+|{_inert.format(3)}|<(?:meta|link|base)\b[^>]*>)*))",
    re.S | re.I,
)
_break = re.compile(rf"</?{_blocks}[^>]*>", re.I)
_tag = re.compile(r"<[/!?]?[a-zA-Z][^>]*>|<[!?][^>]*>")
_title = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_link = re.compile(r"<a\b[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)", re.I)
_charset = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    """The name-based UUID (version 5) of the parts."""
    h = bytearray(sha1(SPACE.bytes + "|".join(parts).encode("utf-8", "replace")).digest()[:16])
    h[6], h[8] = h[6] & 0x0F | 0x50, h[8] & 0x3F | 0x80
    x = h.hex()
    return f"<urn:uuid:{x[:8]}-{x[8:12]}-{x[12:16]}-{x[16:20]}-{x[20:]}>"


def assemble(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without its two closing line ends. Line ends in a value become blanks."""
    own = "".join([f"{k}: {re.sub(r'[\r\n]+', ' ', v) if chr(10) in v or chr(13) in v else v}\r\n" for k, v in headers])
    return f"WARC/1.1\r\n{own}Content-Length: {len(block)}\r\n\r\n".encode("utf-8", "replace") + block


def headers_of(lines: bytes) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for line in lines.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and out:  # a folded line
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            k, v = line.split(":", 1)
            out.append((k.strip(), v.strip()))
    return out


def parse(data: bytes, at: int = 0) -> tuple[list[tuple[str, str]], bytes, int] | None:
    """(headers, block, place after the record) of the record at ``at``; None where there is no whole one."""
    split = data.find(b"\r\n\r\n", at)
    if split < 0 or not data.startswith(b"WARC/", at):
        return None
    headers = headers_of(data[data.find(b"\r\n", at) + 2 : split])
    length = next((v for k, v in headers if k.lower() == "content-length"), "")
    if not length.isdigit() or split + 4 + int(length) > len(data):
        return None
    stop = split + 4 + int(length)
    return headers, data[split + 4 : stop], stop + (4 if data.startswith(b"\r\n\r\n", stop) else 0)


def get(headers: list[tuple[str, str]], name: str, default: str = "") -> str:
    return next((v for k, v in headers if k.lower() == name.lower()), default)


def first_of(headers: list[tuple[str, str]]) -> dict[str, str]:
    """The first value of each header by its name in lower case."""
    return {k.lower(): v for k, v in reversed(headers)}


def body_of(headers: dict[str, str], body: bytes) -> bytes:
    """The entity of an HTTP response: chunks joined, compression undone. What cannot be undone stays as it is."""
    try:
        if headers.get("transfer-encoding", "").lower() == "chunked":
            out, at = [], 0
            while (stop := body.find(b"\r\n", at)) >= 0 and (size := int(body[at:stop].split(b";")[0], 16)):
                out.append(body[stop + 2 : stop + 2 + size])
                at = stop + 4 + size
            body = b"".join(out)
        how = headers.get("content-encoding", "").lower()
        if how in ("gzip", "x-gzip"):
            return gzip.decompress(body)
        return zlib.decompress(body) if how == "deflate" else body
    except (ValueError, OSError, zlib.error, EOFError):
        return body


def plain_text(page: str) -> str:
    """Visible text of an HTML page: lines by block elements, without blank ones."""
    page = _hidden.sub(" ", _comment.sub(" ", page))
    page = html.unescape(_tag.sub("", _break.sub("\n", page)))
    return "\n".join(line for line in (" ".join(x.split()) for x in page.split("\n")) if line)


def respond(page_id: object, url: str | None, page: str | None, date: str = DATE) -> tuple[str, bytes]:
    """(record id, response record) of a page."""
    payload = (page or "").encode("utf-8", "replace")
    own = digest(payload)
    name = record_id("response", str(page_id), url or "", own)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    some = [(k, v) for k, v in (("WARC-Target-URI", url), (PAGE, None if page_id is None else str(page_id))) if v]
    rest = [("WARC-Payload-Digest", own), ("WARC-Block-Digest", digest(block)), ("Content-Type", "application/http; msgtype=response")]
    return name, assemble([("WARC-Type", "response"), ("WARC-Record-ID", name), ("WARC-Date", date), *some, *rest], block)


def derive(record: bytes | None) -> list[tuple[str, str, bytes]]:
    """(kind, record id, record) of the metadata and, for text, the conversion of a response record. Nothing for a null, for
    a damaged record and for one of another type."""
    found = parse(record or b"")
    if found is None:
        return []
    headers, block, _ = found
    named = first_of(headers)
    if named.get("warc-type", "").lower() != "response":
        return []
    source, uri, date = (named.get(k, "") for k in ("warc-record-id", "warc-target-uri", "warc-date"))
    head, _, raw = block.partition(b"\r\n\r\n")
    status, _, lines = head.partition(b"\r\n")
    http = headers_of(lines)
    of_http = first_of(http)
    body = body_of(of_http, raw)
    content = of_http.get("content-type", "text/html")
    kind = content.split(";")[0].strip().lower()
    charset = _charset.search(content)
    about: dict = {}
    text = None
    if kind.startswith("text/") or kind.endswith(("html", "xml")):
        try:
            page = body.decode(charset[1] if charset else "utf-8", "replace")
        except LookupError:
            page = body.decode("utf-8", "replace")
        if kind.endswith(("html", "xml")):
            text, title = plain_text(page), _title.search(page)
            about = {"title": " ".join(html.unescape(title[1]).split()) if title else None, "links": [html.unescape(x) for x in _link.findall(page)]}
        else:
            text = page
    refers = [("WARC-Date", date or DATE), ("WARC-Refers-To", source)]
    refers += [("WARC-Target-URI", uri), ("WARC-Refers-To-Target-URI", uri)] if uri else []
    refers += [("WARC-Refers-To-Date", date)] if date else []
    out, conversion = [], None
    if text is not None:
        conversion, data = record_id("conversion", source), text.encode("utf-8", "replace")
        own = [("WARC-Block-Digest", digest(data)), ("Content-Type", "text/plain; charset=utf-8")]
        out.append(("conversion", conversion, assemble([("WARC-Type", "conversion"), ("WARC-Record-ID", conversion), *refers, *own], data)))
    meta = {
        "source": {"warc": headers, "status": status.decode("utf-8", "replace"), "http": http},
        "payload": {"stated": named.get("warc-payload-digest") or None, "computed": digest(raw), "length": len(raw)},
        "conversion": conversion,
        **about,
    }
    name, data = record_id("metadata", source), json.dumps(meta, ensure_ascii=False).encode("utf-8", "replace")
    own = [("WARC-Block-Digest", digest(data)), ("Content-Type", "application/json")]
    out.append(("metadata", name, assemble([("WARC-Type", "metadata"), ("WARC-Record-ID", name), *refers, *own], data)))
    return out


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """``pages`` (page_id, url, html, ...) as (page_id, record_id, record). A null page is an empty payload, a null URL leaves
    the target out; rows that repeat are the same record."""

    @F.arrow_udf("record_id string, record binary")
    def run(ids: pa.Array, urls: pa.Array, bodies: pa.Array) -> pa.Array:
        made = [respond(*row, date) for row in zip(ids.to_pylist(), urls.to_pylist(), bodies.to_pylist())]
        return pa.StructArray.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.binary())], ["record_id", "record"])

    return pages.select("page_id", run("page_id", "url", "html").alias("r")).select("page_id", "r.*")


def derivatives(records: DataFrame, record_col: str = "record") -> DataFrame:
    """(kind, record_id, record) of all derived records of ``records``; damaged and other records yield none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[str, str, bytes]] = []
        held = 0
        for batch in batches:
            for at in range(batch.num_rows):
                made = derive(batch.column(0)[at].as_py())
                rows += made
                held += sum(len(r) for _, _, r in made)
                if held >= CHUNK_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)

    return records.select(F.col(record_col).alias("record")).mapInArrow(run, "kind string, record_id string, record string")


def _batch(rows: list[tuple[str, str, bytes]]) -> pa.RecordBatch:
    kinds, ids, records = zip(*rows)
    columns = [pa.array(kinds, pa.string()), pa.array(ids, pa.string()), pa.array(records, pa.binary()).cast(pa.string())]
    return pa.record_batch(columns, ["kind", "record_id", "record"])


def write_files(derived: DataFrame, path: str) -> None:
    """Write derived records as gzip WARC files of at most RECORDS_PER_FILE records."""
    out = derived.select(F.col("record").alias("value")).write.option("lineSep", END).option("compression", "gzip")
    out.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _records(pieces: Iterable[tuple[int, bytes]]) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """(headers, block) of the records in the pieces (file, bytes) of files, in their order. Holds one record at a time."""
    held: list[bytes] = []
    size = wanted = 0
    last = None

    def broken(at: bytes) -> ValueError:
        return ValueError(f"no record at {at[:60]!r}")

    for file, piece in pieces:
        if held and file != last:
            raise broken(held[0])
        last = file
        if not held and not (piece := piece.lstrip(b"\r\n")):
            continue  # line ends between records
        held.append(piece)
        size += len(piece)
        if size < wanted:
            continue
        data, at = b"".join(held), 0
        while at < len(data):
            found = parse(data, at)
            if found is None:
                break
            yield found[0], found[1]
            at = found[2]
            while data[at : at + 1] in (b"\r", b"\n"):
                at += 1
        rest = data[at:]
        held, size, wanted = [rest] if rest else [], len(rest), 0
        if rest:
            split = rest.find(b"\r\n\r\n")
            length = get(headers_of(rest[:split]), "Content-Length") if split >= 0 else "0"
            if not rest.startswith(b"WARC/"[: len(rest)]) or not length.isdigit():
                raise broken(rest)
            wanted = split + 4 + int(length) if split >= 0 else 0
    if held:
        raise broken(held[0])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def pieces() -> Iterator[tuple[int, bytes]]:
        for batch in batches:
            files = batch.column(0).to_pylist()
            for at, file in enumerate(files):
                yield file, batch.column(1)[at].as_py()

    names = ("warc-type", "warc-record-id", "warc-refers-to", "warc-target-uri", "warc-block-digest")
    rows, held = [], 0
    for headers, block in _records(pieces()):
        named = first_of(headers)
        stated = named.get("warc-block-digest")
        if stated and stated != digest(block):
            raise ValueError(f"{named.get('warc-record-id')} does not agree with its digest")
        rows.append([named.get(n) or None for n in names] + [block.decode("utf-8", "replace")])
        held += len(block)
        if held >= CHUNK_BYTES or len(rows) == 5000:
            yield _read_batch(rows)
            rows, held = [], 0
    if rows:
        yield _read_batch(rows)


def _read_batch(rows: list[list[str | None]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, pa.string()) for c in zip(*rows)], ["kind", "record_id", "refers_to", "target_uri", "block_digest", "block"])


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(kind, record_id, refers_to, target_uri, block_digest, block) of the records in WARC files, gzip (named ``.gz``) or plain. Raises
    ValueError for a file that breaks off or a block that does not agree with its digest.

    A gzip file is read as a stream, cut at its empty lines, by one task that puts its records together again; a task
    holds one record and a batch, never a file. A plain file is one value, so it has to stay below 2 GB."""
    options = spark.read.option("recursiveFileLookup", "true")
    stream = options.option("lineSep", END).option("pathGlobFilter", "*.gz").text(path)
    pieces = stream.select(F.xxhash64(F.input_file_name()).alias("file"), F.concat("value", F.lit(END)).cast("binary").alias("piece"))
    whole = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "{*[!z],*[!g]z,*[!.]gz}").format("binaryFile").load(path)
    whole = whole.filter("length > 0").select(F.xxhash64("path").alias("file"), F.col("content").alias("piece"))
    return pieces.mapInArrow(_read, FIELDS).unionByName(whole.mapInArrow(_read, FIELDS))
