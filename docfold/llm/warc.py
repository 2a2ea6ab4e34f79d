"""WARC archives: one gzip member per record, written by partition and read back sequentially.

Writing: payloads are deduplicated by SHA-1. Of rows with equal payloads of at least `min_bytes`, the one with the
smallest page_id is stored as `response`, the others as `revisit` records (profile identical-payload-digest, HTTP headers
only). Rows tied on the smallest page_id are all responses. A null page_id is never the smallest unless a group has
no other; then all its rows are responses. A null html is an empty payload, a null url is left out.

Reading: a task streams an archive in blocks, inflates one member at a time, frames the record by Content-Length and
hashes the payload as it passes. Memory per task is one read block plus one payload. `problem` tells what is wrong
with a record (bad framing, digest mismatch, truncated member) and is null for a sound one.

Archives go to a folder that all executors share. A task's archive counts only once the task has returned its name, so
those left by lost or repeated attempts are ignored. An empty table makes no archives and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.llm import shared

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1 << 18
ARCHIVE_BYTES = 1 << 30
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, records long, archive_bytes long"
RECORD = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
          "payload binary, problem string")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """The bytes of one record, not yet compressed."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    lines += [f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class Reader:
    """Records of one archive, in order. `source` has read(n)."""

    def __init__(self, source) -> None:
        self.source = source
        self.ahead = b""

    def _raw(self) -> bytes:
        got, self.ahead = self.ahead, b""
        return got or self.source.read(BLOCK)

    def members(self) -> Iterator[Iterator[bytes]]:
        """For each gzip member, its inflated bytes in blocks."""
        while first := self._raw():
            self.ahead = first
            blocks = self._inflated()
            yield blocks
            for _ in blocks:  # whatever the caller left
                pass

    def _inflated(self) -> Iterator[bytes]:
        z = zlib.decompressobj(31)
        while not z.eof:
            if not (got := self._raw()):
                raise EOFError("truncated member")
            while True:
                if out := z.decompress(got, BLOCK):
                    yield out
                got = z.unconsumed_tail
                if not got or z.eof:
                    break
        self.ahead = z.unused_data

    def __iter__(self) -> Iterator[dict]:
        members = self.members()
        while True:
            try:
                blocks = next(members, None)
                if blocks is None:
                    return
                yield parse(blocks)
            except (EOFError, zlib.error) as e:  # nothing after this point can be framed
                yield {"problem": f"unreadable member: {e}"}
                return


def _headers(text: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in text.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def _page(urn: str) -> int | None:
    m = re.search(r"urn:x-page:(-?\d+)>", urn)
    return int(m[1]) if m else None


def parse(blocks: Iterator[bytes]) -> dict:
    """One record from the inflated blocks of its member."""
    held = b""
    while b"\r\n\r\n" not in held:
        more = next(blocks, None)
        if more is None:
            return {"problem": "no end of the record's headers"}
        held += more
    head, _, held = held.partition(b"\r\n\r\n")
    h = _headers(head)
    if not head.startswith(b"WARC/1.") or not h.get("content-length", "").isdigit():
        return {"problem": "not a record with a length"}
    left, whole = int(h["content-length"]), hashlib.sha1()
    body, parts, http = hashlib.sha1(), [], None
    start = b""
    while left:
        if not held and not (held := next(blocks, b"")):
            return {"problem": "record shorter than its length"}
        got, held = held[:left], held[left:]
        left -= len(got)
        whole.update(got)
        if http is None:
            start += got
            if b"\r\n\r\n" in start:
                top, _, got = start.partition(b"\r\n\r\n")
                http = _headers(top)
            else:
                continue
        body.update(got)
        parts.append(got)
    held += b"".join(blocks)
    wrong = []
    if held != b"\r\n\r\n":
        wrong.append("record longer than its length")
    as_text = lambda s: "sha1:" + base64.b32encode(s.digest()).decode()
    if h.get("warc-block-digest") not in (None, as_text(whole)):
        wrong.append("block digest differs")
    revisit = h.get("warc-type") == "revisit"
    stated = (http or {}).get("content-length", "")
    if not stated.isdigit() or not revisit and int(stated) != sum(map(len, parts)):
        wrong.append("payload length differs")
    if not revisit and h.get("warc-payload-digest") not in (None, as_text(body)):
        wrong.append("payload digest differs")
    return {"page_id": _page(h.get("warc-record-id", "")), "url": h.get("warc-target-uri"), "record_type": h.get("warc-type"),
            "refers_to": _page(h.get("warc-refers-to", "")) if revisit else None,
            "payload_bytes": int(stated) if stated.isdigit() else None,
            "payload_digest": h.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else as_text(body)[5:],
            "payload": None if revisit else b"".join(parts), "problem": ", ".join(wrong) or None}


def plan(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload (bytes), first: the page_id to refer to, null for a response."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.when(F.octet_length("payload") >= min_bytes, F.sha1("payload")))
    firsts = (rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
              .where("n > 1 AND first IS NOT NULL").select("digest", "first"))
    return (rows.join(firsts, "digest", "left")
            .select("page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("first")))


def write(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write archives under `folder`, a path or URI that every executor can open. Returns the manifest: path, records, archive_bytes."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        name, out, records, size = "", None, 0, 0

        def done():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [name], "records": [records], "archive_bytes": [size]})

        for b in batches:
            for page_id, url, payload, first in zip(*(b.column(i).to_pylist() for i in range(4))):
                if out is None:
                    name = f"{base}/{uuid.uuid4().hex}.warc.gz"
                    out, records, size = store.open_output_stream(name, compression=None), 0, 0
                data = member(record(page_id, url, payload, first, first is not None, date))
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return shared.written(plan(pages, min_bytes).mapInArrow(task, MANIFEST), "warc-manifest")


def read(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Records of the archives that `manifest` names; one archive per task. Without `payloads` that column is null."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(folder)
        names = [x.partition(" ")[0] for x in RECORD.split(", ")]
        schema = pa.schema([(n, pa.int64() if t == "long" else pa.binary() if t == "binary" else pa.string())
                            for n, t in (x.split(" ") for x in RECORD.split(", "))])

        def batch(rows):
            return pa.RecordBatch.from_pydict({n: [r.get(n) for r in rows] for n in names}, schema=schema)

        for b in batches:
            for path in b.column(0).to_pylist():
                rows, size = [], 0
                with store.open_input_stream(path, compression=None) as source:
                    for r in Reader(source):
                        if not payloads:
                            r.pop("payload", None)
                        rows.append(r)
                        size += len(r.get("payload") or b"") + 200
                        if size > 4 << 20:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)

    paths = manifest.select("path")
    return paths.repartition(max(1, manifest.count())).mapInArrow(task, RECORD)


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write `pages` to archives in the shared folder and read every record back, without payloads."""
    folder = shared.new_path(spark, "warc")
    folder = folder if "://" in folder or not folder.startswith("file:") else "file://" + folder.removeprefix("file:")
    return read(write(pages, folder, min_bytes), folder, payloads=False)
