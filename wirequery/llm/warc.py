"""WARC archives: a native writer with revisit records, and a salvage reader.

Writer: each row becomes one WARC/1.1 record as a string expression; Spark's text sink with the record separator as line
separator writes the archives, several bounded files a task. Of rows with equal payloads of at least `min_bytes` bytes the
one with the smallest key is a response, the others are revisits that refer to it; smaller ones are all responses. A null
payload is empty; a null URL leaves the field out; control characters in URLs are percent-encoded. Rows that share both
key and payload are all responses if that key is the smallest. Rows with null keys are responses unless a row with a key
has the same payload.

Reader: records are parsed by version line, header block, Content-Length, closing blank lines and payload digest, in
plain files and in gzip members. After a failed check it searches for the next valid member or version line, goes on
there, and reports the bytes between as a gap. The same search runs inside a gzip member, over what inflates of it: records
before and after a damaged one are kept, and so are those before the place where a member is cut off. Of a member that fails
its own check only records whose payload digest is right are kept. Rows of one member share its offset and length and are told
apart by their place in the inflated bytes; a damaged member is reported as a gap too. Digests of unknown algorithms aren't
checked. Each file is held in one task, and one inflated member; the writer keeps files to FILE bytes on average.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, small

FILE = 16 << 20
END = "\r\n\r\n"
URN = "urn:wirequery:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1, from five hex digits to four letters at a time."""
    h = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(h, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write pages as plain WARC files into path."""
    rows = pages.select(F.col(key).cast("string").alias("id"), F.col(key).alias("k"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("body"))
    rows = rows.withColumn("size", F.octet_length("body").cast("long")).withColumn("digest", base32_sha1(F.col("body").cast("binary")))
    digests = cut(rows.groupBy("digest").agg(F.min("k").alias("first"), F.count(F.lit(1)).alias("n"), F.first("size").alias("size")), "digests")
    n, total = digests.agg(F.sum("n"), F.sum(F.col("n") * (F.col("size") + 600))).first()
    again = digests.filter((F.col("n") > 1) & (F.col("size") >= min_bytes) & F.col("first").isNotNull()).select("digest", "first")
    rows = rows.join(small(again), "digest", "left").withColumn("revisit", F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("k")))
    name = lambda c: F.concat(F.lit(f"<{URN}"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    line = lambda field, c: F.concat(F.lit(f"{field}: "), c, F.lit("\r\n"))
    safe = F.when(F.col("url").rlike(r"[\x00-\x20\x7f]"), F.array_join(F.transform(F.split("url", ""), lambda c: F.when(c.rlike(r"[\x00-\x20\x7f]"), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c)), "")).otherwise(F.col("url"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END))
    size = F.octet_length(http) + F.when(F.col("revisit"), 0).otherwise(F.col("size"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")), line("WARC-Record-ID", name(F.col("id"))),
        F.coalesce(line("WARC-Target-URI", safe), F.lit("")), line("WARC-Date", F.lit(date)), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(F.col("revisit"), F.concat(line("WARC-Refers-To", name(F.col("first"))), line("WARC-Profile", F.lit(PROFILE)), line("WARC-X-Payload-Length", F.col("size").cast("string")))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", size.cast("string")), F.lit("\r\n"), http,
    )
    out = rows.select(F.concat(head, F.when(F.col("revisit"), "").otherwise(F.col("body"))).alias("value"))
    out.write.option("lineSep", END).option("maxRecordsPerFile", max(1, int(FILE * (n or 1) / (total or 1)))).text(path)


_FIELD = re.compile(rb"([!-9;-~]+):[ \t]*(.*)")
_VERSION = re.compile(rb"WARC/[01]\.\d+\r?\n")
_START = re.compile(rb"WARC/[01]\.\d+\r?\n|\x1f\x8b\x08")


_GZIP = b"\x1f\x8b\x08"
#: Bytes inflated at a time: what follows a member is copied for at most so many.
PIECE = 1 << 14
ALGORITHMS = ("md5", "sha1", "sha256", "sha384", "sha512")


class Bad(Exception):
    """A failed check; `end` is where the record would have ended, if known; `rows` what is left of a damaged member."""

    def __init__(self, reason: str, end: int | None = None, rows: list[dict] | None = None):
        super().__init__(reason)
        self.end, self.rows = end, rows or []


def is_digest(given: str, payload: bytes) -> bool | None:
    """Whether a digest in base32 or hex is the payload's; None if there is none or its algorithm isn't known."""
    name, _, value = given.rpartition(":")
    name = (name or "sha1").lower().replace("-", "")
    if not value or name not in ALGORITHMS:
        return None
    digest = hashlib.new(name, payload).digest()
    if len(value) == 2 * len(digest):
        return value.lower() == digest.hex()
    return value.upper().rstrip("=") == base64.b32encode(digest).decode().rstrip("=")


def parse(data, pos: int) -> tuple[dict, int]:
    """(record, end) of the plain record at pos; raises Bad."""
    m = _VERSION.match(data, pos)
    if not m:
        raise Bad("no version line")
    stop = data.find(b"\r\n\r\n", m.end() - 2)
    if stop < 0:
        raise Bad("header has no end")
    fields: dict[str, str] = {}
    for raw in bytes(data[m.end() : stop]).split(b"\r\n"):
        f = _FIELD.fullmatch(raw)
        if not f:
            raise Bad("malformed header line")
        fields.setdefault(f[1].decode("ascii").lower(), f[2].decode("utf-8", "replace").strip())
    if not fields.get("content-length", "").isdigit():
        raise Bad("no Content-Length")
    begin = stop + 4
    end = begin + int(fields["content-length"])
    if end + 4 > len(data):
        raise Bad("truncated block")
    if data[end : end + 4] != b"\r\n\r\n":
        raise Bad("block is not followed by blank lines")
    kind, block = fields.get("warc-type", ""), bytes(data[begin:end])
    payload = block
    if "application/http" in fields.get("content-type", ""):
        cut_ = block.find(b"\r\n\r\n")
        payload = block[cut_ + 4 :] if cut_ >= 0 else b""
    given = fields.get("warc-payload-digest", "")
    right = is_digest(given, payload) if kind != "revisit" else None
    if right is False:
        raise Bad("payload digest differs", end + 4)
    given, digest = given.removeprefix("sha1:"), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    length = int(fields["warc-x-payload-length"]) if kind == "revisit" and fields.get("warc-x-payload-length", "").isdigit() else len(payload)
    return {
        "type": kind, "record_id": fields.get("warc-record-id"), "uri": fields.get("warc-target-uri"), "date": fields.get("warc-date"),
        "payload_digest": given or None if kind == "revisit" else digest, "payload_bytes": length, "refers_to": fields.get("warc-refers-to"), "payload": payload, "checked": bool(right),
    }, end + 4


def inflate(data: bytes, pos: int) -> tuple[bytes, int, str | None]:
    """(bytes, end, reason) of the gzip member at pos; the reason is None if it is whole, else the bytes are those before
    the damage."""
    view, parts, z, at = memoryview(data), [], zlib.decompressobj(31), pos
    try:
        while not z.eof and at < len(data):
            parts.append(z.decompress(view[at : at + PIECE]))
            at = min(at + PIECE, len(data))
    except zlib.error as e:  # the failed piece once more, as far as it goes
        z = zlib.decompressobj(31)
        parts = [z.decompress(view[pos:at])]
        try:
            for k in range(at, min(at + PIECE, len(data))):
                parts.append(z.decompress(view[k : k + 1]))
        except zlib.error:
            pass
        return b"".join(parts), at, f"gzip: {e}"
    return b"".join(parts), at - len(z.unused_data), None if z.eof else "truncated gzip member"


def _record(data: bytes, pos: int) -> tuple[list[dict], int]:
    record, end = parse(data, pos)
    return [record], end


def _at(data: bytes, pos: int) -> tuple[list[dict], int]:
    """The rows of the gzip member or the plain record at pos; raises Bad."""
    if data[pos : pos + 3] != _GZIP:
        return _record(data, pos)
    inner, end, reason = inflate(data, pos)
    rows = [r | {"inner_offset": a, "inner_length": b - a} for a, b, found in _walk(inner, _record, _VERSION) for r in found]
    records = [r for r in rows if r["type"] != "gap"]
    if reason:
        raise Bad(reason, None, [r for r in records if r["checked"] or reason.startswith("truncated")])
    if rows and not records:
        raise Bad(rows[0]["reason"], end)
    return rows, end


def _walk(data: bytes, at: Callable[[bytes, int], tuple[list[dict], int]], start: re.Pattern) -> Iterator[tuple[int, int, list[dict]]]:
    """(offset, end, rows) of the parts of data, in order and without holes; rows of type gap where a check fails."""
    pos = 0
    while pos < len(data):
        try:
            found, end = at(data, pos)
            yield pos, end, found
            pos = end
            continue
        except Bad as e:
            reason, tail, saved = str(e), e.end, e.rows
        nxt = len(data)
        if tail is not None and (tail == len(data) or start.match(data, tail)):
            nxt = tail  # the record is bad, its frame is not
        else:
            for m in start.finditer(data, pos + 1):
                try:
                    at(data, m.start())
                except Bad as e:
                    if e.end is None and not e.rows:  # not even a frame
                        continue
                nxt = m.start()
                break
        yield pos, nxt, [*saved, {"type": "gap", "reason": reason}]
        pos = nxt


def salvage(data: bytes) -> Iterator[dict]:
    """Records and gaps of an archive, in order; every byte belongs to a record, a member or a gap."""
    for pos, end, rows in _walk(data, _at, _START):
        for r in rows:
            yield r | {"offset": pos, "length": end - pos}


FIELDS = {"file": "string", "offset": "bigint", "length": "bigint", "inner_offset": "bigint", "inner_length": "bigint", "type": "string", "reason": "string", "record_id": "string", "uri": "string", "date": "string", "payload_digest": "string", "payload_bytes": "bigint", "refers_to": "string"}


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Records of all archives under path, and rows of type `gap` with their reason for bytes that no check let through."""
    fields = FIELDS | ({"payload": "binary"} if payloads else {})
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                rows: list[dict] = []
                for r in salvage(content.as_buffer().to_pybytes()):
                    rows.append(r | {"file": name.as_py()} if payloads else {k: v for k, v in r.items() if k != "payload"} | {"file": name.as_py()})
                    if len(rows) >= 256:
                        yield pa.RecordBatch.from_arrays([pa.array([x.get(k) for x in rows], kinds[t]) for k, t in fields.items()], list(fields))
                        rows = []
                yield pa.RecordBatch.from_arrays([pa.array([x.get(k) for x in rows], kinds[t]) for k, t in fields.items()], list(fields))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(run, ", ".join(f"{k} {t}" for k, t in fields.items()))
