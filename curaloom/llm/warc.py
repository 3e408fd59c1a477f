"""WARC archives: written and read sequentially, one gzip member per record.

Records frame an HTTP response by Content-Length and carry block and payload digests (SHA-256); equal
payloads are stored once, further ones as revisits of identical payload digest. The reader decompresses
incrementally, takes exactly the announced length, and verifies digests and the end of every record.

Archives lie in the folder that all executors share; a task writes a file of its own name and only the
manifest of committed tasks names files, so a lost or repeated task leaves nothing that is read.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaloom.llm import runtime

LEAST_SHARED = 100
#: Repeated payloads are broadcast up to so many digests (48 bytes each); beyond, pages are told by narrow joins.
BROADCAST_ROWS = 1_000_000
#: Archives are read by tasks of about so many compressed bytes.
READ_BYTES = 64 << 20
CHUNK = 1 << 16
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:x-page:"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_HTTP_LENGTH = re.compile(rb"\r\nContent-Length:[ \t]*([0-9]+)[ \t]*\r\n", re.IGNORECASE)


class WarcError(ValueError):
    """An archive that breaks the format or a digest."""


def _id(page: int | None) -> str:
    return f"<{_URN}{'null' if page is None else page}>"


def _page(uri: str | None) -> int | None:
    name = uri.strip("<>").removeprefix(_URN) if uri else "null"
    return None if name == "null" else int(name)


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False) -> bytes:
    """One record as a gzip member; a revisit leaves the payload out."""
    digest = hashlib.sha256(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _id(page),
        "WARC-Date": DATE,
        "WARC-Target-URI": _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url or f"{_URN}{page}"),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if revisit:
        head |= {"WARC-Refers-To": _id(refers_to), "WARC-Profile": PROFILE}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return gzip.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n", LEVEL, mtime=0)


class _Member:
    """The decompressed bytes of one gzip member, taken piece by piece from a stream."""

    def __init__(self, stream, rest: bytes):
        self._stream, self._zip, self._fed, self._have = stream, zlib.decompressobj(31), rest, b""

    def _more(self) -> bool:
        if self._zip.eof:
            return False
        data = self._zip.unconsumed_tail or self._fed or self._stream.read(CHUNK)
        self._fed = b""
        if not data:
            raise WarcError("truncated member")
        self._have += self._zip.decompress(data, CHUNK)
        return True

    def until(self, mark: bytes, most: int = 1 << 20) -> bytes:
        while (at := self._have.find(mark)) < 0:
            if len(self._have) > most or not self._more():
                raise WarcError("header without end")
        out, self._have = self._have[:at], self._have[at + len(mark) :]
        return out

    def exactly(self, n: int) -> bytes:
        parts, left = [], n
        while left > len(self._have):
            parts.append(self._have)
            left -= len(self._have)
            self._have = b""
            if not self._more():
                raise WarcError("record shorter than its Content-Length")
        parts.append(self._have[:left])
        self._have = self._have[left:]
        return b"".join(parts)

    def close(self) -> bytes:
        """Checks that the member ends here; what the stream gave beyond it."""
        while self._more():
            if self._have:
                break
        if self._have:
            raise WarcError("record longer than its Content-Length")
        return self._zip.unused_data


def records(stream) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """(headers with lower-case names, payload, its full length) of every record of an archive; raises WarcError.

    The length is that of the HTTP response; of a revisit its headers alone are stored, and they announce it.
    """
    rest = b""
    while rest or (rest := stream.read(CHUNK)):
        member = _Member(stream, rest)
        version, *lines = member.until(b"\r\n\r\n").decode().split("\r\n")
        if not version.startswith("WARC/1."):
            raise WarcError("no record here")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        block = member.exactly(int(head["content-length"]))
        if member.exactly(4) != b"\r\n\r\n":
            raise WarcError("no end of record")
        rest = member.close()
        if f"sha256:{hashlib.sha256(block).hexdigest()}" != head["warc-block-digest"]:
            raise WarcError("block digest")
        http, _, payload = block.partition(b"\r\n\r\n")
        announced = _HTTP_LENGTH.search(http + b"\r\n")
        if announced is None:
            raise WarcError("no Content-Length in the response")
        if head["warc-type"] == "response" and (f"sha256:{hashlib.sha256(payload).hexdigest()}" != head["warc-payload-digest"] or len(payload) != int(announced[1])):
            raise WarcError("payload digest or length")
        yield head, payload, int(announced[1])


def _planned(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, refers_to, revisit: which page each payload is stored with.

    What repeats is found on narrow rows (page_id, digest). Few repeated payloads are broadcast; of many, the pages
    that repeat one are listed first, and payloads are joined with that list by page and digest, so a payload that
    very many pages share is never one key of a shuffle of payloads.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.when(F.length("payload") >= LEAST_SHARED, F.unhex(F.sha2("payload", 256))))
    shared = rows.where("digest is not null").select("page_id", "digest")
    groups = shared.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null").select("digest", "first")
    groups = runtime.written(groups, "payloads")
    if groups.count() <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(groups), "digest", "left")
    else:
        listed = shared.join(groups, "digest").groupBy("page_id", "digest").agg(F.min("first").alias("first"))
        listed = runtime.written(listed, "repeats").select(F.col("page_id").alias("p"), F.col("digest").alias("d"), "first")
        joined = rows.join(listed, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "payload", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes every row of pages (page_id, url, html) to archives in folder, by default in the shared one.

    Returns the manifest (path, n_records, n_bytes), written beside them. Null html is an empty payload.
    Of equal payloads of LEAST_SHARED bytes or more, rows of the smallest page_id are responses, all others revisits.
    """
    spark = pages.sparkSession
    runtime.bound_batches(spark)
    folder = folder or runtime.fresh_path(spark, "warc")

    def run(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        name = f"{base}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        n = size = 0
        with store.open_output_stream(name) as out:
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    member = record(*row)
                    out.write(member)
                    n += 1
                    size += len(member)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64()), pa.array([size], pa.int64())], names=["path", "n_records", "n_bytes"])

    plan = _planned(pages).select("page_id", "url", "payload", "refers_to", "revisit")
    return runtime.written(plan.mapInArrow(run, "path string, n_records long, n_bytes long"), "manifest")


def read_archives(manifest: DataFrame, folder: str | None = None) -> DataFrame:
    """page_id, url, record_type, payload, payload_bytes, digest, refers_to of every record of the manifest's archives, verified.

    Tasks read whole archives, about READ_BYTES of them each where there are many.
    """
    spark = manifest.sparkSession
    root = folder or runtime.shared_folder(spark)

    def run(batches):
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(root)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(path) as stream:
                    for head, payload, length in records(stream):
                        rows.append((_page(head["warc-record-id"]), head["warc-target-uri"], head["warc-type"], payload, length, head["warc-payload-digest"].partition(":")[2], _page(head.get("warc-refers-to"))))
                        held += len(payload)
                        if held > 1 << 22:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    size = manifest.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n")).first()
    tasks = max(1, min(size["files"], max(spark.sparkContext.defaultParallelism, -(-size["n"] // READ_BYTES))))
    kinds = "page_id long, url string, record_type string, payload binary, payload_bytes long, digest string, refers_to long"
    return manifest.repartition(tasks).select("path").mapInArrow(run, kinds)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]
    names = ["page_id", "url", "record_type", "payload", "payload_bytes", "digest", "refers_to"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def summary(read: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to; a revisit's length is the one that its own headers announce."""
    return read.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")
