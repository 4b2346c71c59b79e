"""Deterministic sharded WARC writer and reader.

Writing: records are range-sorted by id (as text) and digest, each partition writes files that roll
over at a compressed size, one gzip member per record, with headers and digests
regenerated from the payload.  A file is written under a temporary name of its
task attempt and renamed when complete; its final name and its bytes depend on
the rows alone, so a repeated or speculative task puts the same file in place.
The manifest (one row per file) is written last by Spark's own committer;
readers open the files it names and no others.

Equal payloads of at least ``min_bytes`` are stored once: the record of the
smallest id is the response, the others are revisits of it.  Which rows are
revisits is found on digests alone; that narrow table then meets the pages in
the same range sort, so the payloads are shuffled once.

Tasks write through ``pyarrow.fs`` to the folder's own file system, which must
be one that all executors share.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import written

FILE_BYTES = 64 << 20
PART_BYTES = 32 << 20        # of payloads, for a task
SAMPLED_KEYS = 50            # for each partition, on the driver
MIN_REVISIT_BYTES = 100
RECORD_DATE = "2000-01-01T00:00:00Z"      # records carry no fetch time; a fixed date keeps files reproducible
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
MANIFEST_SCHEMA = "file string, records long, bytes long, sha256 string, first_id string, last_id string"
READ_SCHEMA = ("page_id string, record_type string, payload_bytes long, payload_digest string, refers_to string, "
               "url string, payload binary")


def record_uuid(page_id: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, page_id)}>"


def target_uri(url: str | None, page_id: str) -> str:
    return quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else f"urn:page:{quote(page_id)}"


def gzip_member(head: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record as a gzip member (no time stamp inside)."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*head, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def response_record(page_id: str, url: str | None, payload: bytes, digest: str) -> bytes:
    block = HTTP_HEAD % len(payload) + payload
    return gzip_member([
        ("WARC-Type", "response"), ("WARC-Record-ID", record_uuid(page_id)), ("WARC-Date", RECORD_DATE),
        ("WARC-Target-URI", target_uri(url, page_id)), ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Page-Id", page_id),
        ("Payload-Length", str(len(payload))), ("Content-Type", "application/http; msgtype=response")], block)


def revisit_record(page_id: str, url: str | None, size: int, digest: str, refers_to: str) -> bytes:
    block = HTTP_HEAD % size
    return gzip_member([
        ("WARC-Type", "revisit"), ("WARC-Record-ID", record_uuid(page_id)), ("WARC-Date", RECORD_DATE),
        ("WARC-Target-URI", target_uri(url, page_id)), ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("WARC-Profile", PROFILE),
        ("WARC-Refers-To", record_uuid(refers_to)), ("Page-Id", page_id), ("Refers-To-Page-Id", refers_to),
        ("Payload-Length", str(size)), ("Content-Type", "application/http; msgtype=response")], block)


class _RollingFiles:
    """Files of one task: open under a temporary name, renamed when full or at the end."""

    def __init__(self, folder: str, limit: int) -> None:
        self.fs, self.root = pafs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        self.partition, self.attempt = context.partitionId(), context.taskAttemptId()
        self.limit, self.number, self.out = limit, 0, None
        self.fs.create_dir(f"{self.root}/_temporary", recursive=True)

    def add(self, page_id: str, record: bytes) -> Iterator[tuple]:
        if self.out is not None and self.size + len(record) > self.limit:
            yield self.close()
        if self.out is None:
            self.name = f"part-{self.partition:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.root}/_temporary/{self.name}.{self.attempt}"
            self.out = self.fs.open_output_stream(self.temporary, compression=None)
            self.sha, self.size, self.records, self.first = hashlib.sha256(), 0, 0, page_id
            self._put(gzip_member([
                ("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_uuid(self.name)), ("WARC-Date", RECORD_DATE),
                ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        self._put(record)
        self.records, self.last = self.records + 1, page_id

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def close(self) -> tuple:
        self.out.close()
        self.fs.move(self.temporary, f"{self.root}/{self.name}")
        self.out, self.number = None, self.number + 1
        return self.name, self.records, self.size, self.sha.hexdigest(), self.first, self.last


def _partition_of(keys: DataFrame, part_bytes: int):  # noqa: ANN202
    """(number of partitions, their number as a function of id and digest) for the range sort of the records.

    The bounds come from a sample that the rows' own hashes pick, about
    ``SAMPLED_KEYS`` per partition, so no order or partitioning of the rows changes them.
    """
    mix = F.xxhash64("_id", "_digest")
    n, size = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("_bytes"), F.lit(0))).first()
    parts = max(1, -(-size // part_bytes))
    every = max(1, n // (SAMPLED_KEYS * parts))
    found = sorted((r[0] is not None, r[0] or "", r[1]) for r in
                   keys.where(F.pmod(mix, F.lit(every)) == 0).select(F.col("_id").cast("string"), "_digest").distinct().collect()) if parts > 1 else []
    bounds = keys.sparkSession.sparkContext.broadcast([found[k * len(found) // parts] for k in range(1, parts)] if found else [])

    @F.pandas_udf("int")
    def part(page_id, digest):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series([bisect_right(bounds.value, (i is not None, i or "", d)) for i, d in zip(page_id, digest, strict=True)], dtype="int32")

    return parts, part


def write_warc(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_bytes: int = MIN_REVISIT_BYTES, file_bytes: int = FILE_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """Write every row as a record below ``folder`` and return the manifest (one row per file).

    A task gets about ``part_bytes`` of payloads (at least one file), cut by id
    and digest, so a hot id is cut as well.  Rows alone decide the
    cuts, the order and the bytes: the same rows in any order and partitioning give the same files.

    Defined cases: a null payload counts as empty; payloads shorter than
    ``min_bytes`` are always responses; a row whose id is null is always a
    response (written with an empty id); of repeated rows with the smallest id
    each is a response; an empty table gives an empty manifest; a null url
    becomes a ``urn:page:`` address; extra columns are ignored.
    """
    pages = df.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"),
                      F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("_payload"))
    keys = written(pages.select("_id", F.sha2("_payload", 256).alias("_digest"), F.octet_length("_payload").alias("_bytes")), "warc_digests")
    digests = keys.where(f"_id is not null and _bytes >= {min_bytes}").drop("_bytes")
    firsts = digests.groupBy("_digest").agg(F.min("_id").alias("_first"), F.max("_id").alias("_other")).where("_first < _other")
    revisits = (digests.join(firsts.select("_digest", "_first"), "_digest").where("_id > _first")
                .select("_id", F.lit(None).cast("string").alias("_url"), F.lit(None).cast("binary").alias("_payload"),
                        "_digest", F.col("_first").cast("string").alias("_refers")))
    parts, part = _partition_of(keys, part_bytes)
    records = (pages.withColumns({"_digest": F.sha2("_payload", 256), "_refers": F.lit(None).cast("string")})
               .unionByName(revisits)
               .repartitionById(parts, part(F.col("_id").cast("string"), F.col("_digest")))
               .sortWithinPartitions(F.col("_id").cast("string"), "_digest", F.col("_payload").isNotNull(), "_url")   # revisit notes before the page
               .withColumn("_id", F.col("_id").cast("string")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, done = _RollingFiles(folder, file_bytes), []
        notes: dict[str, str] = {}
        noted = None
        for batch in batches:
            for page_id, url, payload, digest, refers in zip(*(c for c in batch.columns), strict=True):
                page_id, refers = page_id.as_py() or "", refers.as_py()
                if noted != page_id:
                    notes, noted = {}, page_id
                if refers is not None:
                    notes[digest.as_py()] = refers
                    continue
                payload, digest = payload.as_py(), digest.as_py()
                first = notes.get(digest)
                record = (response_record(page_id, url.as_py(), payload, digest) if first is None
                          else revisit_record(page_id, url.as_py(), len(payload), digest, first))
                done.extend(files.add(page_id, record))
        if files.out is not None:
            done.append(files.close())
        names = ["file", "records", "bytes", "sha256", "first_id", "last_id"]
        yield pa.RecordBatch.from_pylist([dict(zip(names, d, strict=True)) for d in done], schema=pa.schema([
            ("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string()),
            ("first_id", pa.string()), ("last_id", pa.string())]))

    manifest = f"{folder}/_manifest"
    records.mapInArrow(run, MANIFEST_SCHEMA).write.parquet(manifest)
    return df.sparkSession.read.schema(MANIFEST_SCHEMA).parquet(manifest)


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:  # noqa: ANN001
    """The gzip members of a stream, one at a time."""
    engine, parts = zlib.decompressobj(31), []
    while data := stream.read(chunk):
        while data:
            parts.append(engine.decompress(data))
            data = b""
            if engine.eof:
                yield b"".join(parts)
                data, engine, parts = engine.unused_data, zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the archive ends inside a record")


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a record's length differs from its header")
    return fields, block


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Every record of the archives that the manifest names; digests are checked against the payloads read.

    Ids come back as text (an empty one for a null id).  ``payloads=False``
    leaves the payload column null.
    """
    files = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{folder}/_manifest").select("file", "sha256", "records")
    n_files = files.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("page_id", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("refers_to", pa.string()), ("url", pa.string()), ("payload", pa.binary())])
        store, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for file, records in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                rows, held, seen = [], 0, 0
                with store.open_input_stream(f"{root}/{file}", compression=None) as stream:
                    for raw in members(stream):
                        fields, block = parse_record(raw)
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        seen += 1
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        size = int(fields["Payload-Length"])
                        if fields["WARC-Type"] == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
                            raise ValueError(f"{file}: the payload of page {fields['Page-Id']} differs from its digest")
                        rows.append({"page_id": fields["Page-Id"], "record_type": fields["WARC-Type"], "payload_bytes": size,
                                     "payload_digest": digest, "refers_to": fields.get("Refers-To-Page-Id"),
                                     "url": fields["WARC-Target-URI"], "payload": payload if payloads else None})
                        held += len(payload) if payloads else 0
                        if len(rows) == 2000 or held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if seen != records:
                    raise ValueError(f"{file}: {seen} records read, {records} in the manifest")
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.repartition(max(1, n_files), "file").mapInArrow(run, READ_SCHEMA)
