"""WARC derivatives: from response records to linked metadata and conversion records.

Every response yields a metadata record (``application/warc-fields``) that
keeps the source's WARC and HTTP headers, its digests, and title and links of
the page; and, if its payload is text, a conversion record with the page as
plain text, a line per block. Both point to the response by WARC-Refers-To,
keep its target and date, and get ids that follow from the response's id, so
a repeated task writes the same records.
"""

from __future__ import annotations

import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_out, arrow_rows
from .htmltext import INLINE, Tree

EOL = "\r\n"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the standard's namespace for URLs
#: Elements whose content is not shown.
_UNSEEN = frozenset("script style noscript template iframe svg textarea title".split())
#: What holds no title and no links: comments, scripts, styles and raw text.
_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|textarea)\b.*?(?:</\1\s*>|\Z)", re.I | re.S)
_TITLE = re.compile(r"<title[^>]*>(.*?)</title\s*>", re.S | re.I)
_HREF = re.compile(r"<a\b[^>]*?\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_CHARSET = re.compile(rb"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("\n", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def as_responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """(page_id, record): each page as a WARC response record. Repeated rows get the same record id."""
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    block = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.octet_length(body).cast("string"), F.lit(EOL * 2), body)
    with_block = pages.select("page_id", F.col("url").cast("string").alias("url"), body.alias("body"), block.alias("block"))
    target = F.when(F.col("url").isNull(), F.lit("")).otherwise(F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]", " "), F.lit(EOL)))
    head = F.concat(F.lit(f"WARC/1.1{EOL}WARC-Type: response{EOL}WARC-Record-ID: "), _uuid(F.col("page_id"), F.col("url"), F.sha2(F.col("body").cast("binary"), 256)),
                    F.lit(f"{EOL}WARC-Date: {date}{EOL}"), target, F.lit(f"Content-Type: application/http; msgtype=response{EOL}WARC-Block-Digest: sha256:"),
                    F.sha2(F.col("block").cast("binary"), 256), F.lit(f"{EOL}WARC-Payload-Digest: sha256:"), F.sha2(F.col("body").cast("binary"), 256),
                    F.lit(f"{EOL}Content-Length: "), F.octet_length("block").cast("string"), F.lit(EOL * 2))
    return with_block.select("page_id", F.concat(head, F.col("block"), F.lit(EOL * 2)).cast("binary").alias("record"))


def _fields(raw: bytes) -> list[tuple[str, str]]:
    """Header fields, continuation lines joined."""
    out: list[tuple[str, str]] = []
    for line in raw.decode("utf-8", "replace").split(EOL):
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            name, value = line.split(":", 1)
            out.append((name.strip(), value.strip()))
    return out


def _get(fields: list[tuple[str, str]], name: str) -> str | None:
    return next((v for k, v in fields if k.lower() == name), None)


def _dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        stop = body.find(b"\r\n", at)
        size = int(body[at:stop].split(b";")[0], 16) if stop >= 0 else 0
        if not size:
            return b"".join(out)
        out.append(body[stop + 2:stop + 2 + size])
        at = stop + 4 + size


def _gunzipped(body: bytes) -> bytes:
    """All members of a gzip payload; zeros behind the last are padding."""
    out = []
    while body.strip(b"\0"):
        reader = zlib.decompressobj(31)
        out.append(reader.decompress(body))
        if not reader.eof:
            raise zlib.error("the coded payload ends early")
        body = reader.unused_data
    return b"".join(out)


def _inflated(body: bytes) -> bytes:
    """A deflate payload, with a zlib header or, as some servers send it, without."""
    for kind in (15, -15):
        reader = zlib.decompressobj(kind)
        try:
            out = reader.decompress(body)
        except zlib.error:
            continue
        if reader.eof:
            return out
    raise zlib.error("no whole deflate payload")


def _decoded(fields: list[tuple[str, str]], body: bytes) -> bytes:
    if "chunked" in (_get(fields, "transfer-encoding") or "").lower():
        body = _dechunked(body)
    codings = [c.strip() for c in (_get(fields, "content-encoding") or "").lower().split(",")]
    for coding in reversed([c for c in codings if c not in ("", "identity")]):  # the last was applied last
        if coding in ("gzip", "x-gzip"):
            body = _gunzipped(body)
        elif coding == "deflate":
            body = _inflated(body)
        else:
            raise ValueError(f"unknown coding {coding}")
    return body


def plain_text(page: str) -> str:
    """A page's text, a line per block, white space collapsed."""
    t = Tree(page, _UNSEEN, INLINE | _UNSEEN)
    unseen = [False] * len(t.tag)
    for e in range(1, len(t.tag)):
        unseen[e] = t.tag[e] == "head" or unseen[t.parent[e]]
    page = "".join("\n" if text is None else re.sub(r"\s+", " ", text) for e, text in t.pieces if text is None or not unseen[e])
    lines = (" ".join(line.split()) for line in html.unescape(page).split("\n"))
    return "\n".join(line for line in lines if line)


def _digest(algorithm: str, data: bytes) -> str | None:
    try:
        return hashlib.new(algorithm, data).hexdigest()
    except (ValueError, TypeError):
        return None


def _same_digest(stated: str, data: bytes) -> bool:
    """Whether a stated digest (hex or base 32) holds; one of an unknown algorithm is taken on trust."""
    import base64

    algorithm, _, value = stated.partition(":")
    found = _digest(algorithm, data)
    return found is None or value.lower() == found or value.upper().rstrip("=") == base64.b32encode(bytes.fromhex(found)).decode().rstrip("=")


def _record(kind: str, source: list[tuple[str, str]], content_type: str, block: bytes) -> tuple:
    refers = _get(source, "warc-record-id") or ""
    name = f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{kind} of {refers}')}>"
    digest = f"sha256:{hashlib.sha256(block).hexdigest()}"
    head = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Refers-To", refers), ("WARC-Date", _get(source, "warc-date")),
            ("WARC-Target-URI", _get(source, "warc-target-uri")), ("Content-Type", content_type), ("WARC-Block-Digest", digest), ("Content-Length", str(len(block)))]
    raw = "WARC/1.1" + EOL + "".join(f"{k}: {v}{EOL}" for k, v in head if v is not None) + EOL
    return name, kind, refers, _get(source, "warc-target-uri"), len(block), digest, raw.encode() + block + b"\r\n\r\n"


def derive_record(record: bytes | None) -> list[tuple]:
    """(record_id, record_type, refers_to, target_uri, content_length,
    block_digest, record, source_digest, status) of one record's derivatives."""
    head, gap, rest = (record or b"").partition(b"\r\n\r\n")
    version, _, raw = head.partition(b"\r\n")
    source = _fields(raw)
    if gap and version.startswith(b"WARC/") and (_get(source, "warc-type") or "response") != "response":
        return []
    size = _get(source, "content-length") or ""
    if not gap or not version.startswith(b"WARC/") or not size.isdigit() or int(size) > len(rest) or not _get(source, "warc-record-id"):
        return [(*_record("metadata", source, "application/warc-fields", f"status: malformed{EOL}".encode()), None, "malformed")]
    block = rest[:int(size)]
    http_head, _, body = block.partition(b"\r\n\r\n")
    status_line, _, http_raw = http_head.partition(b"\r\n")
    http = _fields(http_raw)
    stated = _get(source, "warc-block-digest"), _get(source, "warc-payload-digest")
    status = "ok" if all(d is None or _same_digest(d, data) for d, data in zip(stated, (block, body), strict=True)) else "digest-mismatch"
    lines = [("status", status), ("http-status-line", status_line.decode("latin-1"))]
    lines += [(f"source-{k}", v) for k, v in source] + [(f"source-http-{k}", v) for k, v in http]
    kind, text = (_get(http, "content-type") or "").split(";")[0].strip().lower(), None
    if status == "ok" and (kind.startswith("text/") or kind in ("application/xhtml+xml", "")):
        try:
            payload = _decoded(http, body)
            charset = _CHARSET.search((_get(http, "content-type") or "").encode()) or _CHARSET.search(payload[:2048])
            try:
                page = payload.decode(charset[1].decode() if charset else "utf-8", "replace")
            except LookupError:
                page = payload.decode("utf-8", "replace")
            if kind in ("text/plain",):
                text = page
            else:
                text = plain_text(page)
                page = _HIDDEN.sub(" ", page)
                title = _TITLE.search(page)
                if title:
                    lines.append(("title", " ".join(html.unescape(title[1]).split())))
                lines += [("outlink", " ".join(html.unescape(a or b or c).split())) for a, b, c in _HREF.findall(page)]
        except (ValueError, zlib.error):
            status = "undecodable"
            lines[0] = ("status", status)
    fields = "".join(f"{k}: {v}{EOL}" for k, v in lines).encode()
    out = [(*_record("metadata", source, "application/warc-fields", fields), stated[1], status)]
    if text is not None:
        out.append((*_record("conversion", source, "text/plain", text.encode("utf-8", "replace")), stated[1], status))
    return out


def derive(responses: DataFrame, record_col: str = "record") -> DataFrame:
    """record_id, record_type, refers_to, target_uri, content_length,
    block_digest, record, source_digest, status of all derivatives.

    A null or malformed record yields a metadata record with status
    ``malformed``; one whose digests differ, or whose payload cannot be
    decoded, yields its metadata record with that status and no conversion.
    Records of other types, and payloads that are no text, yield no
    conversion. An empty payload has an empty conversion. Repeated records
    yield repeated derivatives with equal ids. Other columns are ignored; an
    empty table gives no rows.
    """
    names = ("record_id", "record_type", "refers_to", "target_uri", "content_length", "block_digest", "record", "source_digest", "status")
    kinds = {"content_length": pa.int64(), "record": pa.binary()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return arrow_out(schema, (r for (record,) in arrow_rows(batches) for r in derive_record(record)), weight=lambda r: len(r[6]))

    return responses.select(F.col(record_col).alias("record")).mapInArrow(run, ", ".join(f"{n} {'long' if n == 'content_length' else 'binary' if n == 'record' else 'string'}" for n in names))
