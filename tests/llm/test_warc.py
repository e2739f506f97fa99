import gzip
import hashlib
import zlib
from collections import Counter

import pytest

from ledgerstar.llm import warc


def parse(raw):
    """Independent reader: one whole record."""
    head, _, rest = bytes(raw).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    n = int(fields["Content-Length"])
    assert lines[0] == "WARC/1.1" and rest[n:] == b"\r\n\r\n"
    assert fields["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(rest[:n]).hexdigest()
    return fields, rest[:n].decode()


def response(body, http="HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Own: 1", more=(), kind="response"):
    block = http.encode() + b"\r\n\r\n" + body
    head = [("WARC-Type", kind), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Date", "2020-01-01T00:00:00Z"), ("WARC-Target-URI", "http://a/"), *more, ("Content-Length", len(block))]
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


HTML = "<html><head><title>A &amp; B</title><script>x</script></head><body><p>One <b>two</b>\n three</p>four<br>é &lt;<a class=k href='/x?a&amp;b'>l</a></body></html>"


def test_linked_records():
    meta, conv = warc.derive_record(response(HTML.encode(), more=[("WARC-Payload-Digest", "sha1:" + hashlib.sha1(HTML.encode()).hexdigest())]))
    fields, block = parse(conv[6])
    assert block == "One two three\nfour\né <l"
    assert fields["WARC-Type"] == "conversion" and fields["WARC-Refers-To"] == "<urn:uuid:1>" and fields["WARC-Target-URI"] == "http://a/"
    assert fields["WARC-Date"] == "2020-01-01T00:00:00Z" and fields["Content-Type"] == "text/plain"
    fields, block = parse(meta[6])
    assert fields["WARC-Type"] == "metadata" and fields["WARC-Refers-To"] == "<urn:uuid:1>" and fields["WARC-Record-ID"] != conv[0]
    for line in ("status: ok", "title: A & B", "outlink: /x?a&b", "source-http-X-Own: 1", "source-WARC-Record-ID: <urn:uuid:1>", "http-status-line: HTTP/1.1 200 OK"):
        assert line in block.split("\r\n")
    assert any(x.startswith("source-WARC-Payload-Digest: sha1:") for x in block.split("\r\n"))


def test_codings_and_charsets():
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\n"
    body = "<p>é</p>".encode("latin-1")
    plain = lambda r: parse(warc.derive_record(r)[1][6])[1]
    assert plain(response(body, http.rstrip())) == "é"
    assert plain(response(gzip.compress(body), http + "Content-Encoding: gzip")) == "é"
    assert plain(response(b"3\r\n<p>\r\n1;x=y\r\n\xe9\r\n0\r\n\r\n", http + "Transfer-Encoding: chunked")) == "é"
    assert plain(response(b"<meta charset=iso-8859-1><p>\xe9", "HTTP/1.1 200 OK\r\nContent-Type: text/html")) == "é"
    assert plain(response(b"a\n b", "HTTP/1.1 200 OK\r\nContent-Type: text/plain")) == "a\n b"
    assert plain(response(b"")) == ""


def test_members_raw_deflate_and_stacked_codings():
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Encoding: "
    plain = lambda r: parse(warc.derive_record(r)[1][6])[1]
    two = gzip.compress(b"<p>one</p>") + gzip.compress(b"<p>two</p>")
    assert plain(response(two, http + "gzip")) == plain(response(two + b"\0" * 8, http + "gzip")) == "one\ntwo"
    raw = zlib.compressobj(wbits=-15)
    raw = raw.compress(b"<p>x</p>") + raw.flush()
    assert plain(response(raw, http + "deflate")) == plain(response(zlib.compress(b"<p>x</p>"), http + "deflate")) == "x"
    assert plain(response(gzip.compress(zlib.compress(b"x")), http + "deflate, gzip")) == "x"
    assert plain(response(b"x", http + "identity")) == "x"
    for body, coding in ((b"x", "br"), (b"x", "zstd"), (gzip.compress(b"x"), "br, gzip"), (raw[:-3], "deflate"), (gzip.compress(b"x") + gzip.compress(b"y")[:-4], "gzip")):
        (only,) = warc.derive_record(response(body, http + coding))
        assert only[8] == "undecodable"


def test_no_links_from_comments_and_scripts():
    page = b"<!-- <a href=/1>x</a><title>no</title> --><script>'<a href=/2>'</script><title>T</title><a href=/3>y</a><!-- <a href=/4>"
    block = parse(warc.derive_record(response(page))[0][6])[1].split("\r\n")
    assert [x for x in block if x.startswith(("title", "outlink"))] == ["title: T", "outlink: /3"]


@pytest.mark.parametrize("record,status", [(None, "malformed"), (b"", "malformed"), (b"WARC/1.0\r\nContent-Length: 99\r\n\r\nx", "malformed"), (b"junk\r\n\r\njunk", "malformed"),
                                           (response(b"x", more=[("WARC-Block-Digest", "sha1:AAAA")]), "digest-mismatch"),
                                           (response(b"x", "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Encoding: gzip"), "undecodable"),
                                           (response(b"x", "HTTP/1.1 200 OK\r\nContent-Type: image/png"), "ok")])
def test_only_metadata(record, status):
    (only,) = warc.derive_record(record)
    assert only[1] == "metadata" and only[8] == status and f"status: {status}" in parse(only[6])[1]


def test_other_types_yield_nothing():
    assert warc.derive_record(response(b"x", kind="request")) == []


def test_pages(spark):
    rows = [(1, "http://a/", HTML, 0), (1, "http://a/", HTML, 0), (None, None, None, 1), (2, "u\r\nv", "", 1), (3, "http://b/", "<p>" + "x " * 300_000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record int")
    got = warc.derive(warc.as_responses(pages)).collect()
    assert len(got) == 2 * len(rows) and {r.status for r in got} == {"ok"}
    texts = Counter(parse(r.record)[1] for r in got if r.record_type == "conversion")
    assert texts == Counter(["One two three\nfour\né <l"] * 2 + ["", ""] + [" ".join(["x"] * 300_000)])
    sources = {r.refers_to for r in got}
    assert len(sources) == 4 and all(sum(r.refers_to == s for r in got) in (2, 4) for s in sources)
    bodies = {"sha256:" + hashlib.sha256((h or "").encode()).hexdigest() for _, _, h, _ in rows}
    assert {r.source_digest for r in got} == bodies
    assert warc.derive(warc.as_responses(pages.where("page_id = 9"))).count() == 0


@pytest.mark.parametrize("page,want", [("<html><head><title>T</title><body><p>Whole article</p></body></html>", "Whole article"),
                                       ("<head><meta x><p>a</p>b", "a\nb"), ("<p>a<svg class=i />b</p><p>c</p>", "ab\nc"), ("a<svg><text>no</text></svg>b", "ab"),
                                       ("a<iframe src=x>b<p>c", "ab\nc"), ("a<template><p>b", "a\nb"), ("a<script>b<p>c", "a"), ("a<!-- b <p>c", "a"),
                                       ("a<canvas>b</canvas>", "a\nb")])
def test_text_after_omitted_end_tags(page, want):
    assert warc.plain_text(page) == want
