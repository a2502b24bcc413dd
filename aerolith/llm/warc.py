"""WARC archives: written with an index, read back by coalesced byte ranges.

Writing: each task appends gzip members, one per record, to an archive of its own and returns an index row per record with
file, offset, length, URL and payload digest. The index is a table in the shared folder. A task that runs again writes
an archive of another name, and only the rows of the attempt that counts enter the index, so that lost executors leave no
half-read records.

Reading: index rows of the selected records are dealt by (file, stretch of the file), sorted by offset, and neighbours
are merged into ranges of bounded size; each range is one read. A file is never read as a whole by one task.

Records with equal payloads of at least MIN_REVISIT bytes: the one with the smallest page_id is the response, the others are
revisits that refer to it and carry no payload. Smaller payloads are always responses.

Scale: equal payloads meet as 32-byte digests, aggregated on the map side; pages are joined to the digests that occur
more than once by a plain left join whose hot keys adaptive execution splits. Memory of a task: one Arrow batch and one range.

Defined cases: a null html is an empty payload; a null url gives a record without target URI and returns as null; an empty
url stays empty. Line breaks and other control characters in a url are percent-encoded in the record's header; the index
keeps the url as it is. A null page_id is never the smallest unless all are null. Rows that repeat both page_id and payload are responses all, as
none has a smaller page_id. Empty tables give an empty index and result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, table, text_of, work_dir

MIN_REVISIT = 100
#: A task begins another archive beyond so many bytes.
ARCHIVE_BYTES = 1 << 30
#: Records of one stretch of a file are read by one task.
STRETCH_BYTES = 32 << 20
#: Ranges are merged over gaps of so many bytes, up to ranges of so many bytes (one larger record is a range of its own).
GAP_BYTES, RANGE_BYTES = 64 << 10, 8 << 20

_INDEX = "page_id long, url string, record_type string, refers_to long, file string, offset long, length long, payload_bytes long, payload_digest string"
_RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record, not compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>", "WARC-Date: 2024-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of one record that is not compressed; payload is None for a revisit."""
    head, rest = data.split(b"\r\n\r\n", 1)
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if len(block) != int(fields["Content-Length"]) or not rest.endswith(b"\r\n\r\n"):
        raise ValueError(f"record {fields.get('WARC-Record-ID')} is cut off")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    revisit = fields["WARC-Type"] == "revisit"
    number = lambda key: None if fields[key][10:-1] == "None" else int(fields[key][10:-1])
    return {"page_id": number("WARC-Record-ID"), "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To") if revisit else None, "payload_bytes": size, "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"), "payload": None if revisit else payload}


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        task, out, at, name = TaskContext.get(), None, 0, ""
        fs.create_dir(path, recursive=True)
        try:
            for batch in batches:
                rows = []
                for r in batch.to_pylist():
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{task.partitionId():06d}-{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{path}/{name}", compression=None)
                    payload = (r["html"] or "").encode()
                    revisit = r["record_type"] == "revisit"
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    member = packer.compress(record_bytes(r["page_id"], r["url"], payload, r["payload_digest"], r["refers_to"], revisit)) + packer.flush()
                    out.write(member)
                    rows.append({"page_id": r["page_id"], "url": r["url"], "record_type": r["record_type"], "refers_to": r["refers_to"], "file": name, "offset": at, "length": len(member), "payload_bytes": len(payload), "payload_digest": r["payload_digest"]})
                    at += len(member)
                yield pa.RecordBatch.from_pylist(rows, schema=_schema(_INDEX))
        finally:
            if out is not None:
                out.close()

    return write


def decide(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, payload_digest, record_type, refers_to) of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text_of("html").alias("html"))
    rows = rows.withColumn("payload_digest", F.sha2("html", 256))
    seen = pages.select(F.col("page_id").cast("long").alias("page_id"), text_of("html").alias("html")).filter(F.octet_length("html") >= MIN_REVISIT)
    twice = seen.select("page_id", F.sha2("html", 256).alias("payload_digest")).groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(twice, "payload_digest", "left").select("page_id", "url", "html", "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first_id")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the archives to folder/archives and the index to folder/index; returns the index."""
    spark = pages.sparkSession
    ship(spark)
    decide(pages).mapInArrow(_writer(f"{folder}/archives"), _INDEX).write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def coalesced(ranges: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[int]]]:
    """(offset, length, positions in the list) of reads that cover (offset, length) ranges sorted by offset."""
    begin = end = 0
    own: list[int] = []
    for k, (offset, length) in enumerate(ranges):
        if own and (offset - end > GAP_BYTES or max(end, offset + length) - begin > RANGE_BYTES):
            yield begin, end - begin, own
            own = []
        if not own:
            begin = end = offset
        own.append(k)
        end = max(end, offset + length)
    if own:
        yield begin, end - begin, own


def _reader(folder: str, with_payload: bool):
    schema = _schema(_RECORD + (", payload binary" if with_payload else ""))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        name, file = None, None
        try:
            for batch in batches:
                rows = batch.to_pylist()
                k = 0
                while k < len(rows):
                    j = k
                    while j < len(rows) and rows[j]["file"] == rows[k]["file"]:
                        j += 1
                    if name != rows[k]["file"]:
                        if file is not None:
                            file.close()
                        name = rows[k]["file"]
                        file = fs.open_input_file(f"{path}/{name}")
                    part = rows[k:j]
                    for begin, length, own in coalesced([(r["offset"], r["length"]) for r in part]):
                        data = memoryview(file.read_at(length, begin))
                        got = []
                        for i in own:
                            r = part[i]
                            x = parse_record(zlib.decompress(data[r["offset"] - begin : r["offset"] - begin + r["length"]], 31))
                            if x["payload"] is not None and hashlib.sha256(x["payload"]).hexdigest() != x["payload_digest"]:
                                raise ValueError(f"{name}: the payload at {r['offset']} does not match its digest")
                            got.append(x | {"url": r["url"]})
                        yield pa.RecordBatch.from_pylist(got, schema=schema)
                    k = j
        finally:
            if file is not None:
                file.close()

    return read


def read_records(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that the index rows name, checked against their digests."""
    ship(index.sparkSession)
    stretch = F.floor(F.col("offset") / STRETCH_BYTES)
    dealt = index.select("file", "offset", "length", "url").withColumn("stretch", stretch).repartition("file", "stretch").sortWithinPartitions("file", "offset").drop("stretch")
    return dealt.mapInArrow(_reader(f"{folder}/archives", with_payload), _RECORD + (", payload binary" if with_payload else ""))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "warc")
    index = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_records(index, folder, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
r AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM r WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT r.page_id, CAST(r.payload_bytes AS BIGINT) AS payload_bytes, r.payload_digest,
       CASE WHEN f.first_id IS NULL OR f.first_id IS NOT DISTINCT FROM r.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first_id IS DISTINCT FROM r.page_id THEN f.first_id END AS refers_to
FROM r LEFT JOIN f ON r.payload_digest = f.payload_digest AND r.payload_bytes >= 100
"""
