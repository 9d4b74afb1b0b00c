"""Sound records of other writers are read, damaged ones told."""

import base64
import hashlib
import struct

import pytest
import zstandard

from spillway.llm import warc

BODY = b"caf\xc3\xa9 " * 30


def raw(kind, block, *more, length=None):
    head = [f"WARC-Type: {kind}", "WARC-Record-ID: <urn:x:1>", "WARC-Date: 2020-02-02T02:02:02Z", f"Content-Length: {len(block) if length is None else length}", *more]
    return b"WARC/1.0\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def b32(x):
    return "sha1:" + base64.b32encode(hashlib.sha1(x).digest()).decode()


HTTP = "Content-Type: application/http; msgtype=response"
CHUNKED = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + b"%x;x=1\r\n" % 50 + BODY[:50] + b"\r\n" + b"%X\r\n" % (len(BODY) - 50) + BODY[50:] + b"\r\n0\r\n\r\n"
SENT = CHUNKED.partition(b"\r\n\r\n")[2]

SOUND = [
    (raw("warcinfo", b"software: x\r\n\r\ny", "Content-Type: application/warc-fields"), b"software: x\r\n\r\ny"),
    (raw("metadata", b"", "Content-Type: text/plain"), b""),
    (raw("resource", BODY, "Content-Type: text/html", "WARC-Block-Digest: " + b32(BODY)), BODY),
    (raw("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "Content-Type: application/http; msgtype=request"), b""),
    (raw("response", b"HTTP/1.1 200 OK\r\nX: 1\r\n\r\n" + BODY, HTTP), BODY),
    (raw("response", CHUNKED, HTTP, "WARC-Payload-Digest: " + b32(BODY)), BODY),
    (raw("response", CHUNKED, HTTP, "WARC-Payload-Digest: " + b32(SENT)), BODY),
    (raw("response", b"HTTP/1.1 200 OK\r\n\r\n" + BODY, HTTP, "WARC-Payload-Digest: sha256:" + hashlib.sha256(BODY).hexdigest().upper()), BODY),
    (raw("response", b"HTTP/1.1 200 OK\r\n\r\n" + BODY, HTTP, "WARC-Payload-Digest: blake9:" + "a" * 9), BODY),
    (raw("response", b"HTTP/1.1 200 OK\r\nContent-Length: 999\r\n\r\n" + BODY, HTTP, "WARC-Truncated:", " length"), BODY),
    (raw("response", b"com. 60 IN A 192.0.2.1", "Content-Type: text/dns"), b"com. 60 IN A 192.0.2.1"),
]


@pytest.mark.parametrize("record, payload", SOUND)
def test_sound(record, payload):
    got = warc.parsed(record)
    assert got[-1] is None and got[6] == payload and got[5] == len(payload) and got[0] == "<urn:x:1>"


def test_digest_of_a_record_that_states_none():
    assert warc.parsed(SOUND[4][0])[4] == hashlib.sha1(BODY).hexdigest()
    assert warc.parsed(SOUND[7][0])[4] == hashlib.sha256(BODY).hexdigest()


def test_revisits():
    where = "WARC-Refers-To-Target-URI: http://a/"
    assert warc.parsed(raw("revisit", b"", where))[4:] == (None, None, None, None)
    assert warc.parsed(raw("revisit", b"HTTP/1.1 200 OK\r\nContent-Length: 7\r\n\r\n", where, HTTP))[5:] == (7, None, None)
    assert warc.parsed(raw("revisit", b""))[-1] == "revisit"
    assert warc.parsed(raw("revisit", b"HTTP/1.1 200 OK\r\n\r\nbody", where, HTTP))[-1] == "revisit"


@pytest.mark.parametrize("record, why", [
    (raw("resource", BODY, "WARC-Block-Digest: " + b32(b"x")), "block digest"),
    (raw("response", CHUNKED, HTTP, "WARC-Payload-Digest: " + b32(b"x")), "payload digest"),
    (raw("response", b"HTTP/1.1 200 OK\r\nContent-Length: 9\r\n\r\n" + BODY, HTTP), "payload length"),
    (raw("response", b"HTTP/1.1 200 OK\r\nContent-Length: x\r\n\r\n" + BODY, HTTP), "block"),
    (raw("response", b"no headers", HTTP), "block"),
    (raw("response", b"HTTP/1.1 200 OK\r\n\r\n" + BODY, HTTP, "WARC-Payload-Digest: sha1:!!"), "digest"),
    (raw("metadata", BODY, length=3), "block length"),
])
def test_damaged(record, why):
    assert warc.parsed(record)[-1] == why


def test_an_archive_of_another_writer(spark):
    """Dictionary stored as it is, frames without a stated size, no dictionary at all, empty and null contents."""
    pack = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(BODY * 4, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False)
    one = struct.pack("<II", warc.DICTIONARY_FRAME, len(BODY) * 4) + BODY * 4 + b"".join(pack.compress(r) for r, _ in SOUND)
    two = b"".join(zstandard.ZstdCompressor().compress(r) for r, _ in SOUND)
    files = spark.createDataFrame([("a", one), ("b", two), ("c", b""), ("d", None)], "path string, content binary")
    got = warc.read_archives(files).collect()
    assert all(r.error is None for r in got)
    for name in "ab":
        assert [bytes(r.payload) for r in got if r.path == name] == [p for _, p in SOUND]
    assert warc.read_archives(files.limit(0)).count() == 0


def test_edges_of_pages(spark):
    kind = "page_id long, url string, html string, size int, digest string, body string"
    big = "b" * 1500
    pages = spark.createDataFrame([(1, None, big, 1, "x", "y"), (1, "u", big, 2, "x", "y"), (None, None, None, None, None, None), (2, "u", "é" * (1 << 20), 0, "", "")], kind)
    got = sorted((r.record_id, r.record_type, r.payload_bytes) for r in warc.read_archives(warc.write_archives(warc.with_revisits(pages))).collect())
    assert got == [("<urn:page:1>", "response", 1500)] * 2 + [("<urn:page:2>", "response", 2 << 20), ("<urn:page:>", "response", 0)]
    assert warc.read_archives(warc.write_archives(warc.with_revisits(pages.limit(0)))).count() == 0
