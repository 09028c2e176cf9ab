"""WARC archives: deterministic sharded writer with a manifest, and its reader.

Pages are range-sorted by id into shards whose bounds depend on the pages only
(quantiles of the ids with the smallest hashes), each shard is written by one
task as gzip members, one record each, into files that roll at ``roll_bytes``
compressed. Headers, digests and record ids are regenerated from the page, the
date is a parameter, so equal pages give equal bytes.

Files are written under temporary names that carry the task attempt. Only the
rows of successful attempts reach the staged list of files; those are renamed
(a repeated rename finds the file in place) and the manifest appears last, by
one rename. Readers only see what the manifest names. A lost executor costs a
rewrite of its shards under other temporary names.

Of pages with equal payloads the smallest id keeps the payload; the others are
revisit records. Which those are is found on narrow rows (id, digest) and sorted
into the shards beside the pages, so a payload is shuffled once, and a payload
that a third of all pages share meets nowhere.

Defined results: a null payload is empty; null ids sort first and are never
referred to unless all copies lack an id; rows that repeat id and payload are
one response and revisits of it; a null url gives ``urn:page:<id>``; line ends
and control characters in a url are percent-encoded; an empty table gives an
empty manifest. Stores are reached through ``pyarrow.fs`` (local and shared
mounts, HDFS, S3).
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recsort.llm.common import shuffle_partitions, staged

ROLL_BYTES = 64 << 20
SHARD_BYTES = 128 << 20
SAMPLE = 20  # ids per shard bound
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record(page_id: int | None, url: str | None, payload: bytes, n_bytes: int, sha1: bytes, first: int | None, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record, uncompressed."""
    def urn(i: int | None) -> str:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{i} {sha1.hex()}')}>"

    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode() + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", urn(page_id)), ("WARC-Date", date),
            ("WARC-Target-URI", target), ("WARC-Payload-Digest", "sha1:" + base32(sha1)),
            ("WARC-Block-Digest", "sha1:" + base32(hashlib.sha1(block).digest())), ("Content-Type", "application/http;msgtype=response"),
            ("Content-Length", str(len(block)))]
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", urn(first))] + [("X-Refers-To-Page-Id", str(first))] * (first is not None)
    return "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


class _Files:
    """The files of one shard, rolled by compressed size."""

    def __init__(self, store: pafs.FileSystem, folder: str, shard: int, attempt: str, roll_bytes: int):
        self.store, self.folder, self.shard, self.attempt, self.roll = store, folder, shard, attempt, roll_bytes
        self.part, self.out, self.listed = 0, None, []

    def write(self, data: bytes) -> None:
        if self.out is None:
            self.temporary = f"{self.shard:06d}-{self.part:04d}-{self.attempt}"
            self.out, self.size, self.records, self.sha = self.store.open_output_stream(f"{self.folder}/{self.temporary}"), 0, 0, hashlib.sha256()
        press = zlib.compressobj(6, zlib.DEFLATED, 31)  # no file name, no time stamp
        member = press.compress(data) + press.flush()
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)
        self.records += 1
        if self.size >= self.roll:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.listed.append((f"pages-{self.shard:06d}-{self.part:04d}.warc.gz", self.temporary, self.records, self.size, self.sha.hexdigest()))
            self.part, self.out = self.part + 1, None


FILES = "name string, temporary string, records bigint, bytes bigint, sha256 string"


def _search(bounds: list[int], x: Column) -> Column:
    """How many of the ascending ``bounds`` lie below ``x`` (0 for null), by bisection."""
    if not bounds:
        return F.lit(0)
    steps, known = F.sequence(F.lit(1), F.lit(len(bounds).bit_length())), F.lit(bounds)

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        below = (s["lo"] < s["hi"]) & F.coalesce(F.get(known, mid) < x, F.lit(False))
        return F.struct(F.when(below, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(below | (s["lo"] >= s["hi"]), s["hi"]).otherwise(mid).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    return F.aggregate(steps, start, halve, lambda s: s["lo"])


def write_archives(pages: DataFrame, out_dir: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_bytes: int = 0, roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES, date: str = DATE) -> None:
    """Write every row of ``pages`` to ``out_dir`` (a new folder of the shared store) and commit."""
    spark = pages.sparkSession
    src = pages.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                       F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).cast("binary").alias("payload")) \
        .withColumn("digest", F.unhex(F.sha1("payload"))).withColumn("n_bytes", F.octet_length("payload").cast("bigint"))
    narrow = staged(src.select("id", "digest", "n_bytes"), "warc-digests")
    heads = narrow.filter(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    heads = heads.filter("n > 1").select("digest", "first").checkpoint()
    copies = narrow.join(heads, "digest").select("id", "digest", "first").distinct()

    total = narrow.agg(F.sum("n_bytes")).first()[0] or 0
    shards = max(shuffle_partitions(spark), -(-total // shard_bytes))
    picked = sorted(r[0] for r in narrow.filter("id IS NOT NULL").select("id").orderBy(F.xxhash64("id"), "id").limit(SAMPLE * shards).collect())
    bounds = sorted({picked[len(picked) * k // shards] for k in range(1, shards)}) if picked else []
    none = F.lit(None)
    rows = src.select("id", "digest", F.lit(1).alias("kind"), none.cast("bigint").alias("first"), "url", "payload", "n_bytes").unionByName(
        copies.select("id", "digest", F.lit(0).alias("kind"), "first", none.cast("string").alias("url"), none.cast("binary").alias("payload"), none.cast("bigint").alias("n_bytes")))
    rows = rows.withColumn("shard", _search(bounds, F.col("id"))).repartition(shards, "shard") \
        .sortWithinPartitions("shard", "id", "digest", "kind", "url")

    store, root = pafs.FileSystem.from_uri(out_dir)
    job = f"{root}/_temporary-{uuid.uuid4().hex[:12]}"
    store.create_dir(job, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, _ = pafs.FileSystem.from_uri(out_dir)
        attempt, files, listed, head, used = uuid.uuid4().hex[:12], None, [], None, False
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                part = batch.slice(k, 200)
                for r in zip(*(part.column(c).to_pylist() for c in ("shard", "id", "digest", "kind", "first", "url", "payload", "n_bytes")), strict=True):
                    shard, page_id, sha1, kind, first, url, payload, n_bytes = r
                    if kind == 0:
                        head, used = (page_id, sha1, first), False
                        continue
                    if files is None or files.shard != shard:
                        if files:
                            files.close()
                            listed += files.listed
                        files = _Files(own, job, shard, attempt, roll_bytes)
                    copied = head is not None and head[:2] == (page_id, sha1)
                    revisit = copied and (used or page_id != head[2])
                    used = used or copied
                    files.write(record(page_id, url, b"" if revisit else payload, n_bytes, sha1, head[2] if revisit else None, revisit, date))
        if files:
            files.close()
            listed += files.listed
        cols = list(zip(*listed, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()),
                                          pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.string())], [c.split()[0] for c in FILES.split(", ")])

    written = staged(rows.mapInArrow(write, FILES), "warc-files")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, _ = pafs.FileSystem.from_uri(out_dir)
        for batch in batches:
            for name, temporary in zip(batch.column("name").to_pylist(), batch.column("temporary").to_pylist(), strict=True):
                there = own.get_file_info([f"{job}/{temporary}", f"{root}/{name}"])
                if there[0].type != pafs.FileType.NotFound:
                    own.move(f"{job}/{temporary}", f"{root}/{name}")
                elif there[1].type == pafs.FileType.NotFound:
                    raise FileNotFoundError(f"{job}/{temporary}")
            yield batch

    names = [c.split()[0] for c in FILES.split(", ")]
    done = staged(written.mapInArrow(commit, FILES), "warc-committed").orderBy("name")
    with store.open_output_stream(f"{job}/manifest") as out:
        for r in done.toLocalIterator():
            out.write((json.dumps({c: r[c] for c in names if c != "temporary"}) + "\n").encode())
    store.move(f"{job}/manifest", f"{root}/manifest.jsonl")
    store.delete_dir(job)


def _records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each gzip member of an archive."""
    left = b""
    while True:
        left = left or stream.read(1 << 20)
        if not left:
            return
        unzip, data = zlib.decompressobj(31), []
        while not unzip.eof:
            if not left and not (left := stream.read(1 << 20)):
                raise ValueError("archive ends within a record")
            data.append(unzip.decompress(left))
            left = unzip.unused_data
        whole = b"".join(data)
        head, _, rest = whole.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield fields, rest[:int(fields["Content-Length"])]


RECORDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_archives(spark: SparkSession, out_dir: str, with_payload: bool = False) -> DataFrame:
    """One row per record of the committed files; digests and lengths are checked against the bytes."""
    manifest = spark.read.schema("name string, bytes bigint").json(f"{out_dir}/manifest.jsonl")
    files = manifest.repartition(shuffle_partitions(spark), "name")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(out_dir)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows: list[tuple] = []
                with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for fields, block in _records(stream):
                        rows.append(_row(name, fields, block, with_payload))
                        if len(rows) == 500:
                            yield _batch(rows, with_payload)
                            rows = []
                if rows:
                    yield _batch(rows, with_payload)

    return files.select("name").mapInArrow(parse, RECORDS + (", payload binary" if with_payload else ""))


def _row(name: str, fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != length or base32(hashlib.sha1(payload).digest()) != digest):
        raise ValueError(f"{name}: payload of {fields['WARC-Record-ID']} does not match its headers")
    if base32(hashlib.sha1(block).digest()) != fields["WARC-Block-Digest"].removeprefix("sha1:"):
        raise ValueError(f"{name}: block of {fields['WARC-Record-ID']} does not match its digest")
    number = lambda k: int(fields[k]) if k in fields else None
    row = (number("X-Page-Id"), fields["WARC-Target-URI"], length, digest, fields["WARC-Type"], number("X-Refers-To-Page-Id"))
    return row + (payload,) * with_payload


def _batch(rows: list[tuple], with_payload: bool) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [c.split() for c in (RECORDS + (", payload binary" if with_payload else "")).split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], [n for n, _ in fields])
