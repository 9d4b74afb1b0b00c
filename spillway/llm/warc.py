"""WARC archives compressed with Zstandard: writing them, and a reader that checks them.

Layout of an archive: one skippable frame that holds the dictionary (raw or
itself compressed), then one frame per record. Archives travel as rows
(``path``, ``content``), as ``spark.read.format("binaryFile")`` gives them, so the
reader takes files from any store that Spark can read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from spillway.llm.common import arrow_map, utf8

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
ALGORITHMS = ("md5", "sha1", "sha256", "sha384", "sha512")

#: Texts below this size are never written as revisits.
SMALL = 1000
#: An archive is closed once it holds so many compressed bytes.
ARCHIVE_BYTES = 4 << 20
#: The dictionary is trained on the first payloads of an archive, up to these bounds.
SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 200, 20_000, 16 << 10
STEP = 64 << 10

RECORD = "path string, record_id string, record_type string, target string, refers_to string, payload_digest string, payload_bytes long, payload binary, error string"


def with_revisits(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", least: int = SMALL) -> DataFrame:
    """``pages`` with ``digest``, ``size`` and ``refers_to``.

    Of rows with equal payloads (null: empty) of at least ``least`` bytes, the
    largest id is the response; ``refers_to`` is that id for the others and null
    for it. Rows that repeat the largest id are all responses; a null id is smallest.
    Other columns are left out; an empty table gives an empty one, and that no archives.
    """
    own = pages.select(F.col(id_col).alias("id"), F.col("url").alias("url"), F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("body"))
    own = own.withColumn("digest", F.sha1("body")).withColumn("size", F.octet_length("body").cast("long"))
    first = own.where(F.col("size") >= least).groupBy("digest").agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return own.join(first.select("digest", "first"), "digest", "left").select(
        "id", "url", "body", "digest", "size", F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    )


def write_archives(rows: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives (``path``, ``content``) of the rows of ``with_revisits``; each task writes its own."""

    def run(batches):
        name, n, held, size, pack = TaskContext.get().partitionId(), 0, [], 0, None
        for b in batches:
            bodies = utf8(b.column("body"))
            for i, (key, url, digest, refers) in enumerate(zip(*(b.column(c).to_pylist() for c in ("id", "url", "digest", "refers_to")))):
                if pack is None:
                    dictionary = train(bodies[i : i + SAMPLES])
                    head, pack = leading_frame(dictionary), zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
                    held, size = [head], len(head)
                held.append(pack.compress(record(key, url, digest, bodies[i], refers)))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield archive(name, n, held)
                    n, pack = n + 1, None
        if pack is not None:
            yield archive(name, n, held)

    return arrow_map(rows.select("id", "url", "body", "digest", "refers_to"), run, "path string, content binary")


def archive(name: int, n: int, frames: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f"part-{name:05d}-{n:05d}.warc.zst"]), pa.array([b"".join(frames)])], ["path", "content"])


def train(bodies: list[bytes]) -> zstandard.ZstdCompressionDict:
    samples = [x[:SAMPLE_BYTES] for x in bodies if x]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except (zstandard.ZstdError, ValueError):  # too few or too small samples to train on: they serve as they are
        return zstandard.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES] or VERSION * 2, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def leading_frame(dictionary: zstandard.ZstdCompressionDict) -> bytes:
    body = zstandard.ZstdCompressor().compress(dictionary.as_bytes())
    return struct.pack("<II", DICTIONARY_FRAME, len(body)) + body


def record(key, url: str | None, digest: str, body: bytes, refers_to) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body)
    block = http + (body if refers_to is None else b"")
    head = [
        ("WARC-Type", kind), ("WARC-Record-ID", urn(key)), ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url or "")),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        head += [("WARC-Refers-To", urn(refers_to)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def urn(key) -> str:
    return "<urn:page:" + ("" if key is None else str(key)) + ">"


def read_archives(archives: DataFrame) -> DataFrame:
    """Records of archives given as (``path``, ``content``), one row each, of any type and any writer.

    ``payload_digest`` is the stated digest in hex, without its label (null for a revisit that states none), else the
    SHA-1 of the payload; a revisit has no payload, its size is null unless its HTTP headers tell it. ``error`` says what is wrong with a record (its other columns hold what could
    be read) or with the rest of an archive; it is null for a sound record. A null
    or empty content gives no row.
    """

    def run(batches):
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                held, size = [], 0
                for one in records(content or b""):
                    held.append((path, *one))
                    size += len(one[6] or b"")
                    if size > 8 << 20:
                        yield rows_of(held)
                        held, size = [], 0
                if held:
                    yield rows_of(held)

    return arrow_map(archives.select("path", "content"), run, RECORD)


NAMES = [x.split()[0] for x in RECORD.split(", ")]
TYPES = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in RECORD.split(", ")]


def rows_of(held: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), TYPES)], NAMES)


def broken(why: str) -> tuple:
    return (None,) * 7 + (why,)


def records(content: bytes):
    """Each frame's record as (id, type, target, refers to, digest, payload bytes, payload, error)."""
    at, unpack = 0, zstandard.ZstdDecompressor()
    if len(content) >= 8 and struct.unpack_from("<I", content)[0] == DICTIONARY_FRAME:
        at = 8 + struct.unpack_from("<I", content, 4)[0]
        raw = content[8:at]
        try:
            raw = unpack.decompress(raw) if raw[:4] == ZSTD_MAGIC else raw
            unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
        except zstandard.ZstdError as e:
            yield broken(f"dictionary: {e}")
            return
    while at < len(content):
        frame, out = unpack.decompressobj(), []
        try:
            while not frame.eof and at < len(content):
                out.append(frame.decompress(content[at : at + STEP]))
                at += min(STEP, len(content) - at) - len(frame.unused_data)
        except zstandard.ZstdError as e:
            yield broken(f"frame: {e}")
            return
        if not frame.eof:
            yield broken("frame: cut off")
            return
        yield parsed(b"".join(out))


def headers(lines: list[bytes]) -> dict[str, str]:
    """Named fields in lower case; a line that begins with a blank goes on with the one before it."""
    whole: list[bytes] = []
    for x in lines:
        if whole and x[:1] in (b" ", b"\t"):
            whole[-1] += b" " + x.strip()
        else:
            whole.append(x)
    pairs = (x.partition(b":") for x in whole)
    return {k.strip().lower().decode("latin-1"): v.strip().decode("utf-8", "replace") for k, _, v in pairs}


def stated(digest: str) -> tuple[str, str] | None:
    """Algorithm and lower-case hex of a labelled digest, given in base 32 or hex; None if it can't be read."""
    name, _, value = digest.partition(":")
    name = name.lower().replace("-", "")
    if name not in ALGORITHMS:
        return None
    size = hashlib.new(name).digest_size
    try:
        if len(value) == 2 * size:
            return name, bytes.fromhex(value).hex()
        raw = base64.b32decode(value.upper() + "=" * (-len(value) % 8))
    except ValueError:
        return None
    return (name, raw.hex()) if len(raw) == size else None


def unchunked(body: bytes) -> bytes | None:
    """The entity behind a chunked transfer encoding; None if it isn't one."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].partition(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            return None
        n, at = int(size, 16), end + 2
        if n == 0:
            return b"".join(out)
        if body[at + n : at + n + 2] != b"\r\n":
            return None
        out.append(body[at : at + n])
        at += n + 2


def parsed(raw: bytes) -> tuple:
    """One record. Its payload is the entity of an HTTP message, without a transfer encoding, or else the whole block.

    Digests and an HTTP length are held against the record only where it states them. A digest of an
    algorithm that isn't known is handed on unread.
    """
    head, gap, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not gap or not first.startswith(b"WARC/1."):
        return broken("no record header")
    have = headers(lines)
    key, kind, refers = have.get("warc-record-id"), have.get("warc-type"), have.get("warc-refers-to")
    said = (key, kind, have.get("warc-target-uri"), refers, None)
    if missing := [x for x in REQUIRED if x not in have]:
        return (*said, None, None, f"missing: {', '.join(missing)}")
    if not have["content-length"].isdecimal() or len(rest) != int(have["content-length"]) + 4 or not rest.endswith(b"\r\n\r\n"):
        return (*said, None, None, "block length")
    block, cut = rest[:-4], "warc-truncated" in have
    if (why := mismatch(have.get("warc-block-digest"), block)) is not None:
        return (*said, None, None, f"block {why}")
    message = kind in ("response", "request", "revisit") and have.get("content-type", "application/http").lower().startswith("application/http")
    bodies, length = [block], None
    if message and block:
        http, gap, body = block.partition(b"\r\n\r\n")
        if not gap and not cut:
            return (*said, None, None, "block")
        fields = headers(http.split(b"\r\n")[1:])
        length, bodies = fields.get("content-length"), [body]
        if length is not None and not length.isdecimal():
            return (*said, None, None, "block")
        # Some writers take the digest of the body as it was sent, so both forms may agree with it.
        if fields.get("transfer-encoding", "").lower() == "chunked":
            length, plain = None, unchunked(body)
            if plain is not None:
                bodies.insert(0, plain)
    digest = have.get("warc-payload-digest")
    known = stated(digest) if digest is not None else None
    named = known[1] if known else digest
    if kind == "revisit":
        size = int(length) if length is not None else None
        points = refers is not None or "warc-refers-to-target-uri" in have
        return (*said[:4], named, size, None, "revisit" if bodies[-1] or not points else why_not(digest, known))
    body = bodies[0]
    if length is not None and int(length) != len(body) and kind == "response" and not cut:
        return (*said[:4], named, int(length), body, "payload length")
    faults = [mismatch(digest, x) for x in bodies]
    return (*said[:4], named or hashlib.sha1(body).hexdigest(), len(body), body, None if None in faults or cut else f"payload {faults[0]}" if known else faults[0])


def why_not(digest: str | None, known: tuple[str, str] | None) -> str | None:
    """A digest of a known algorithm that cannot be read is an error, one of another algorithm is not."""
    label = (digest or "").partition(":")[0].lower().replace("-", "")
    return "digest" if known is None and label in ALGORITHMS else None


def mismatch(digest: str | None, body: bytes) -> str | None:
    """What is wrong with a stated digest of ``body``, if anything."""
    if digest is None:
        return None
    known = stated(digest)
    if known is None:
        return why_not(digest, known)
    return None if hashlib.new(known[0], body).hexdigest() == known[1] else "digest"
