"""WARC archives: write with an index first, then coalesced byte-range reads.

Method.  Equal payloads are found by an aggregate over digests; one record per
group is a response, the others are revisits.  Every task appends gzip members
to archive files of bounded size and returns an index row per record (file,
offset, length, URL, digest).  A read selects index rows, sorts them by file
and offset, joins neighbours to ranges of bounded size, fetches each range with
one read and takes the records out of it.

Archives lie under the shared folder, reached through pyarrow's file systems
(local or mounted paths, HDFS, S3, GCS).  A file is named by the attempt that
wrote it and only committed index rows name files, so lost executors leave
unreferenced files at most.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from paylake.config import scratch_dir

from .common import materialize, pick, slices

ARCHIVE_BYTES = 128 << 20  # an archive file is closed beyond this
RANGE_BYTES = 4 << 20      # most bytes of one coalesced read (a larger record is read alone)
GAP_BYTES = 64 << 10       # unselected bytes that a read may span
TASK_BYTES = 16 << 20      # records that a task reads, about
SLICE_BYTES = 4 << 20      # payloads written at a time
MIN_REVISIT = 1000

_INDEX = ("page_id bigint, url string, digest string, record_type string, file string, offset bigint, "
          "length bigint")
_RECORD = ("page_id bigint, url string, record_type string, payload_digest string, payload_bytes bigint, "
           "refers_to bigint, payload binary")


def _filesystem(uri: str):
    from pyarrow import fs

    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def _header_text(value) -> str:
    """A header value on one line: control characters and % as %XX."""
    return re.sub(r"[\x00-\x20%\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def warc_record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record; page ids travel as URNs, a missing id or URL has no header."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_text(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    number = lambda k: int(m[1]) if (m := re.search(r"urn:page:(-?\d+)", fields.get(k, ""))) else None
    url = fields.get("WARC-Target-URI")
    url = None if url is None else re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)) if int(m[1], 16) <= 0x20 or m[1] in ("25", "7F") else m[0], url)
    return {"page_id": number("WARC-Record-ID"), "url": url, "record_type": fields["WARC-Type"], "payload_digest": digest,
            "payload_bytes": size, "refers_to": number("WARC-Refers-To"), "payload": None if revisit else payload}


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _write_pass(folder: str, limit: int):
    def run(batches):
        system, root = _filesystem(folder)
        system.create_dir(root, recursive=True)
        out, name, at = None, None, 0
        context = TaskContext.get()
        try:
            for batch in (part for whole in batches for part in slices(whole, "html", SLICE_BYTES)):
                index = []
                for x in batch.to_pylist():
                    payload = (x["html"] or "").encode()
                    digest = x["digest"]
                    data = _member(warc_record(x["page_id"], x["url"], payload, digest, x["refers_to"]))
                    if out is None or at and at + len(data) > limit:
                        if out is not None:
                            out.close()
                        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.gz"
                        out, at = system.open_output_stream(f"{root}/{name}", compression=None), 0
                    out.write(data)
                    index.append({"page_id": x["page_id"], "url": x["url"], "digest": digest,
                                  "record_type": "response" if x["refers_to"] is None else "revisit",
                                  "file": name, "offset": at, "length": len(data)})
                    at += len(data)
                yield pa.RecordBatch.from_pylist(index, schema=pa.schema(
                    [("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string()),
                     ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))
        finally:
            if out is not None:
                out.close()
    return run


def write_warc(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
               folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> tuple[DataFrame, str]:
    """Write one record per row; returns (index, archive folder).

    Of equal payloads of at least 1000 bytes the one with the largest page_id is
    the response and the others refer to it; rows that share that page_id too
    are responses, as are rows without a page_id when the whole group has none.
    Null html counts as empty; an empty table writes no archive.
    """
    folder = folder or scratch_dir(pages.sparkSession, "warc")
    mine = pick(pages, page_id=page_id, url=url, html=html).select(F.col("page_id").cast("bigint").alias("page_id"),
                                                                   "url", "html")
    mine = mine.withColumns({"digest": F.sha1(F.coalesce("html", F.lit("")).cast("binary")),
                             "size": F.octet_length(F.coalesce("html", F.lit("")))})
    same = (mine.where(F.col("size") >= MIN_REVISIT).groupBy("digest", "size")
            .agg(F.max("page_id").alias("largest"), F.count("*").alias("n")).where("n > 1").drop("n"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest")).alias("refers_to")
    linked = (mine.where(F.col("size") >= MIN_REVISIT).join(same, ["digest", "size"], "left")
              .select("page_id", "url", "html", "digest", refers))
    # smaller payloads, however many are alike, are no part of that join
    linked = linked.unionAll(mine.where(F.col("size") < MIN_REVISIT)
                             .select("page_id", "url", "html", "digest", F.lit(None).cast("bigint")))
    index = linked.mapInArrow(_write_pass(folder, archive_bytes), _INDEX)
    return materialize(index, "warc-index"), folder


def read_ranges(index: DataFrame, range_bytes: int = RANGE_BYTES, gap: int = GAP_BYTES) -> DataFrame:
    """Selected index rows -> (file, first, size, cuts): one row per coalesced read.

    A file is cut on a grid of range_bytes, so no group holds more than its
    records; inside a cell, gaps wider than ``gap`` start a new range.
    """
    cell = index.select("file", "offset", "length", F.floor(F.col("offset") / F.lit(range_bytes)).alias("cell")).distinct()
    order = Window.partitionBy("file", "cell").orderBy("offset")
    ends = F.lag(F.col("offset") + F.col("length")).over(order)
    cell = cell.withColumn("jump", F.when(F.col("offset") - ends > gap, 1).otherwise(0))
    cell = cell.withColumn("run", F.sum("jump").over(order))
    return cell.groupBy("file", "cell", "run").agg(
        F.min("offset").alias("first"), (F.max(F.col("offset") + F.col("length")) - F.min("offset")).alias("size"),
        F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("cuts")).select("file", "first", "size", "cuts")


def _read_pass(folder: str):
    def run(batches):
        system, root = _filesystem(folder)
        open_name, source = None, None
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                            ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()),
                            ("payload", pa.binary())])
        for batch in batches:
            for x in batch.to_pylist():
                if x["file"] != open_name:
                    open_name, source = x["file"], system.open_input_file(f"{root}/{x['file']}")
                source.seek(x["first"])
                data = source.read(x["size"])
                found = []
                for cut in x["cuts"]:
                    a = cut["offset"] - x["first"]
                    found.append(parse_record(zlib.decompress(data[a: a + cut["length"]], 31)))
                yield pa.RecordBatch.from_pylist(found, schema=schema)
    return run


def read_warc(index: DataFrame, folder: str, range_bytes: int = RANGE_BYTES, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The records that the given index rows name, read by sorted ranges; payloads
    of responses are checked against their digests, revisits have none.  There is
    a task for every ``task_bytes`` of records."""
    size = index.agg(F.sum("length")).first()[0] or 0
    ranges = read_ranges(index, range_bytes).repartitionByRange(1 + int(size // task_bytes), "file", "first")
    return ranges.sortWithinPartitions("file", "first").mapInArrow(_read_pass(folder), _RECORD)


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, read all records back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    index, folder = write_warc(pages)
    return read_warc(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
