"""WARC archives: a writer with revisit records, and a splittable reader.

Each record is one gzip member. The reader deals out byte ranges of the files; a task looks for the
gzip magic in its range, accepts a candidate only if it inflates to a complete WARC header, and owns
the records that start inside the range, reading on past its end for the last one. From an accepted
member the next start is known, so magic is searched only at a range's start and after damage.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.llm.shared import file_system, maybe_broadcast, scratch_path, stored

MAGIC = b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RANGE_BYTES = 16 << 20
CHUNK = 1 << 20


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int) -> str:
    return f"<urn:x-page:{page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member; a revisit has no payload but the length and digest of it."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode("utf-8") + block + b"\r\n\r\n") + packer.flush()


def verdicts(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(digest, winner) of payloads of at least ``min_bytes`` that more than one row has."""
    sized = pages.select("page_id", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("size")).filter(F.col("size") >= min_bytes)
    return sized.groupBy("digest").agg(F.max("page_id").alias("winner"), F.count("*").alias("n")).filter("n > 1").select("digest", "winner")


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write one record per row below ``folder``; returns a stored manifest (path, bytes, records).

    Of rows with equal payloads of at least ``min_bytes`` bytes, those with the largest id are responses
    and the others revisit them. Null html counts as empty; null ids are written as ``None`` and never
    chosen while another id exists. A task that is run again writes another file, and only files in
    the manifest count.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("payload"))
    shared = stored(verdicts(rows, min_bytes), "payloads")
    judged = rows.withColumn("digest", F.sha1("payload")).join(maybe_broadcast(shared, 80), "digest", "left")
    judged = judged.select("page_id", "url", F.encode("payload", "UTF-8").alias("payload"), "winner")

    def write(batches):
        store, path = file_system(folder)
        store.create_dir(path, recursive=True)
        task = TaskContext.get()
        name, sink, size, n = None, None, 0, 0
        for batch in batches:
            for page, url, payload, winner in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if sink is None:
                    name = f"part-{task.partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    sink = store.open_output_stream(f"{path}/{name}", compression=None)
                data = record(page, url, payload, payload_digest(payload), winner, winner is not None and winner != page)
                sink.write(data)
                size, n = size + len(data), n + 1
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([size], pa.int64()), pa.array([n], pa.int64())], names=["path", "bytes", "records"])

    return stored(judged.mapInArrow(write, "path string, bytes long, records long"), "manifest")


class Ranged:
    """Bytes of a file by offset, read in chunks: at least ``least`` bytes, fewer only at the file's end."""

    def __init__(self, source, size: int):
        self.source, self.size, self.at, self.data = source, size, 0, b""

    def read(self, at: int, n: int = CHUNK, least: int = 1) -> bytes:
        lo = at - self.at
        if not 0 <= lo < len(self.data) or (lo + least > len(self.data) and self.at + len(self.data) < self.size):
            self.source.seek(at)
            self.at, self.data, lo = at, self.source.read(max(n, CHUNK)), 0
        return self.data[lo : lo + n]


def member(data: Ranged, at: int) -> tuple[bytes, int] | None:
    """The whole content and end of the gzip member at ``at`` if it is a WARC record, else None."""
    inflate, parts, checked, got = zlib.decompressobj(31), [], False, 0
    try:
        while not inflate.eof:
            raw = data.read(at)
            if not raw:
                return None
            parts.append(inflate.decompress(raw))
            got += len(parts[-1])
            at += len(raw) - len(inflate.unused_data)
            if not checked and (got >= 8 or inflate.eof):
                if not b"".join(parts)[:8].startswith(b"WARC/1."):
                    return None
                checked = True
    except zlib.error:
        return None
    content = b"".join(parts)
    return (content, at) if checked and 0 < content.find(b"\r\n\r\n") else None


def records_in(source, size: int, start: int, stop: int):
    """(offset, headers, block) of the records that start in ``start..stop``."""
    data, at = Ranged(source, size), start
    while at < stop:
        found = member(data, at) if data.read(at, len(MAGIC), len(MAGIC)) == MAGIC else None
        if found is None:
            window = data.read(at + 1, CHUNK, len(MAGIC))
            if not window:
                return
            k = window.find(MAGIC)
            # Magic may lie across two windows: two bytes are looked at again.
            at += 1 + k if k >= 0 else max(1, len(window) - 1)
            continue
        content, end = found
        head, _, rest = content.partition(b"\r\n\r\n")
        headers = {}
        for line in head.split(b"\r\n")[1:]:
            key, _, value = line.partition(b":")
            headers[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        length = headers.get("content-length", "")
        yield at, headers, rest[: int(length)] if length.isdigit() else rest.removesuffix(b"\r\n\r\n")
        at = end


def _page_of(name: str | None) -> int | None:
    m = re.fullmatch(r"<urn:x-page:(-?[0-9]+)>", name or "")
    return int(m[1]) if m else None


def read_archives(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of archives given as (path, bytes), in ranges of ``range_bytes``.

    Returns path, offset, page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload
    (null for a revisit, whose length and digest are those its headers give). Damaged members are
    passed over up to the next valid one.
    """
    spark = files.sparkSession
    ranges = files.select("path", F.col("bytes").alias("size"), F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))).alias("start"))
    ranges = ranges.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1), F.xxhash64("path", "start"))
    schema = T.StructType([
        T.StructField("path", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()), T.StructField("payload", T.BinaryType()),
    ])
    arrow = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])

    def read(batches):
        rows, held = [], 0
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, name = file_system(path)
                with store.open_input_file(name) as source:
                    for at, headers, block in records_in(source, size, start, min(size, start + range_bytes)):
                        kind = headers.get("warc-type")
                        http, _, payload = block.partition(b"\r\n\r\n")
                        if kind == "response":
                            length, digest = len(payload), payload_digest(payload)
                        else:
                            m = re.search(rb"(?i)^content-length:\s*([0-9]+)", http, re.M)
                            length, digest, payload = int(m[1]) if m else None, headers.get("warc-payload-digest", "").removeprefix("sha1:"), None
                        rows.append((path, at, _page_of(headers.get("warc-record-id")), headers.get("warc-target-uri"), kind, _page_of(headers.get("warc-refers-to")), length, digest, payload))
                        held += len(block)
                        if held > 16 << 20 or len(rows) >= 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return ranges.select("path", "size", "start").mapInArrow(read, schema)


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes) of all archives below a folder, listed by Spark."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", "true").load(folder).select("path", F.col("length").alias("bytes"))


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives and read them back: one row per page.

    Null html is an empty payload; repeated rows of the chosen id are all responses; an empty table
    gives no archive and no rows.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    manifest = write_archives(pages, folder, min_bytes=min_bytes)
    return read_archives(manifest.select("path", "bytes")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
