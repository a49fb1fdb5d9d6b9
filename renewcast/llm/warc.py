"""A deterministic sharded WARC writer, and the reader of what it has written.

Records are sorted by page id and dealt to shards by ranges of it.  The bounds come from a sample of ids
chosen by their hash, so the same pages give the same shards whoever runs which task.  A shard is a series of
files: a file is rolled once it has ``roll_bytes`` compressed bytes.  Every record is a gzip member of its
own; its headers (lengths, payload and block digests, record id) are made anew from the payload.  Files are
written under temporary names that carry the task attempt and renamed when whole; each shard then commits a
manifest of its files, also by rename, and the driver commits ``manifest.json`` last, which lists the shards'
manifests.  Readers only read what the manifests name, so leftovers of lost or repeated attempts are never
seen, and a repeated attempt writes the same bytes under the same names.

Of the records with equal payloads of at least ``revisit_from`` bytes, the one with the largest page id is
the response and the others revisit it (equal ids: the first by url, nulls first).  Smaller ones are all
responses.  A null payload is an empty one.  Rows without a page id are written first, each a response that
nothing refers to.  An empty table gives an archive without files.  Further columns are ignored.  A folder takes one
archive: a name that is taken keeps its file.
"""
from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renewcast.llm.shared import join_hot, materialise, scratch

ROLL_BYTES, SHARD_BYTES, SAMPLE = 64 << 20, 256 << 20, 8192
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or not path.startswith("file:") else "file://" + path[5:])


def put(fs, temp: str, path: str) -> None:
    """Give a whole file its name.  Where another attempt has been there before, its file has the same bytes and stays:
    not every store renames onto a name that is taken."""
    from pyarrow.fs import FileType

    taken = lambda: fs.get_file_info(path).type != FileType.NotFound
    if not taken():
        try:
            return fs.move(temp, path)
        except OSError:
            if not taken():
                raise
    fs.delete_file(temp)


def _commit(fs, path: str, attempt: str, data: bytes) -> None:
    temp = f"{path}.{attempt}.tmp"
    with fs.open_output_stream(temp) as f:
        f.write(data)
    put(fs, temp, path)


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(kind: str, *parts) -> str:
    h = hashlib.md5("\0".join([kind, *map(str, parts)]).encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def _record(page_id, url, payload: bytes, refers_to) -> bytes:
    digest = _digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id('page', page_id, url, digest)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{_digest(block)}", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _bounds(pages: DataFrame, page_id: str, shards: int, rows: int) -> list:
    """Upper bounds of the shards' ids, the same for the same pages."""
    ids = pages.select(F.col(page_id).alias("p")).where("p IS NOT NULL")
    some = ids.where(F.pmod(F.xxhash64("p"), F.lit(max(1, rows // SAMPLE))) == 0).groupBy("p").agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect() if shards > 1 else []
    weight = np.cumsum([r["n"] for r in some]) if some else np.zeros(0)
    at = np.searchsorted(weight, weight[-1] * np.arange(1, shards) / shards) if some else []
    return sorted({some[i]["p"] for i in at})


def write_warc(pages: DataFrame, folder: str, prefix: str = "pages", page_id: str = "page_id", url: str = "url", html: str = "html", revisit_from: int = 0, roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES, level: int = 6) -> DataFrame:
    """Write the archive; returns its files (shard, file, records, bytes), as committed."""
    spark = pages.sparkSession
    pages = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    size = pages.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("payload")).alias("b")).first()
    shards = max(1, -(-(size["b"] or 0) // shard_bytes), min(spark.sparkContext.defaultParallelism, (size["b"] or 0) >> 23))
    bounds = _bounds(pages, "page_id", shards, size["n"])
    shard = F.size(F.filter(F.array(*(F.lit(b) for b in bounds)).cast("array<bigint>"), lambda b: b < F.col("page_id"))) if bounds else F.lit(0)
    # Who refers to whom, by digest; these rows are small and travel with the pages to their shards.  One payload (an empty
    # one, say) may be that of a third of all pages.
    keys = materialise(pages.where(F.octet_length("payload") >= revisit_from).select("page_id", F.sha1("payload").alias("sha1")).where("page_id IS NOT NULL"), "warc-keys")
    several = materialise(keys.groupBy("sha1").agg(F.max("page_id").alias("to"), F.count(F.lit(1)).alias("copies")).where("copies > 1"), "warc-copies")
    marks = join_hot(keys, several, "sha1").select("page_id", F.lit(None).cast("string").alias("url"), F.unhex("sha1").alias("payload"), "to").distinct()
    rows = pages.withColumn("to", F.lit(None).cast("long")).unionByName(marks).withColumn("shard", F.coalesce(shard, F.lit(0)).cast("int"))
    dealt = rows.repartitionById(len(bounds) + 1, "shard").sortWithinPartitions("shard", "page_id", F.col("to").isNull(), "url", "payload")

    def write(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        attempt, fs, where = f"{context.taskAttemptId()}-{context.attemptNumber()}", None, None
        current, files, out, name, written, records = None, [], None, None, 0, 0
        revisits, page, answered = {}, None, set()

        def roll():
            nonlocal out, written, records
            if out is not None:
                out.close()
                put(fs, f"{where}/{name}.{attempt}.tmp", f"{where}/{name}")
                files.append({"shard": current, "file": name, "records": records, "bytes": written})
                out, written, records = None, 0, 0

        def finish():
            if current is not None:
                roll()
                _commit(fs, f"{where}/{prefix}-{current:05d}.manifest.json", attempt, json.dumps(files).encode())

        done = []
        for batch in batches:
            for p, u, payload, to, s in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if fs is None:
                    fs, where = filesystem(folder)
                    fs.create_dir(where, recursive=True)
                if s != current:
                    finish()
                    done += files
                    current, files = s, []
                if p != page:
                    page, revisits, answered = p, {}, set()
                if to is not None:
                    revisits[payload] = to
                    continue
                to = revisits.get(hashlib.sha1(payload).digest()) if p is not None and revisits else None
                if to == p and p is not None and payload not in answered:
                    answered.add(payload)
                    to = None
                if out is None:
                    name = f"{prefix}-{s:05d}-{len(files):05d}.warc.gz"
                    out = fs.open_output_stream(f"{where}/{name}.{attempt}.tmp", compression=None)
                member = gzip.compress(_record(p, u, payload, to), level, mtime=0)
                out.write(member)
                written += len(member)
                records += 1
                if written >= roll_bytes:
                    roll()
        finish()
        done += files
        yield pa.RecordBatch.from_pylist(done, schema=pa.schema([("shard", pa.int32()), ("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    files = materialise(dealt.select("page_id", "url", "payload", "to", "shard").mapInArrow(write, "shard int, file string, records long, bytes long"), "warc-files")
    fs, where = filesystem(folder)
    fs.create_dir(where, recursive=True)
    shards = sorted(r["shard"] for r in files.select("shard").distinct().collect())
    _commit(fs, f"{where}/manifest.json", "driver", json.dumps({"shards": [f"{prefix}-{s:05d}.manifest.json" for s in shards]}).encode())
    return files


def _members(f, block: int = 1 << 20):
    """The records of a file of gzip members, one at a time."""
    d, held, parts = zlib.decompressobj(31), b"", []
    while True:
        raw = held or f.read(block)
        held = b""
        if not raw:
            if parts:
                raise ValueError("a record is cut off")
            return
        parts.append(d.decompress(raw))
        if d.eof:
            yield b"".join(parts)
            held, d, parts = d.unused_data, zlib.decompressobj(31), []


def parse_record(raw: bytes) -> tuple[dict, bytes, dict]:
    """(WARC headers, payload, HTTP headers)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(headers["Content-Length"])]
    if lines[0] != "WARC/1.1" or len(block) != int(headers["Content-Length"]) or rest[len(block):] != b"\r\n\r\n" or "sha1:" + _digest(block) != headers["WARC-Block-Digest"]:
        raise ValueError("a record is damaged")
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, payload, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, url, payload (null for revisits), payload_bytes, payload_digest, record_type, refers_to of every
    record that the manifests name.  Damaged records raise an error."""
    fs, where = filesystem(folder)
    with fs.open_input_stream(f"{where}/manifest.json", compression=None) as f:
        shards = json.loads(f.read())["shards"]
    names = spark.createDataFrame([(s,) for s in shards], "name string").repartition(max(1, min(len(shards), spark.sparkContext.defaultParallelism))) if shards else spark.createDataFrame([], "name string")

    def files(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, where = filesystem(folder)
                with fs.open_input_stream(f"{where}/{name}", compression=None) as f:
                    yield pa.record_batch([pa.array([x["file"] for x in json.loads(f.read())], pa.string())], names=["file"])

    def read(batches):
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, where = filesystem(folder)
                rows, size = [], 0
                with fs.open_input_stream(f"{where}/{name}", compression=None) as f:
                    for raw in _members(io.BufferedReader(f) if not hasattr(f, "read") else f):
                        h, payload, http = parse_record(raw)
                        digest, kind = h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"]
                        if kind == "response" and _digest(payload) != digest:
                            raise ValueError("a payload is damaged")
                        number = lambda k: int(h[k]) if k in h else None  # noqa: E731,B023
                        rows.append((number("X-Page-ID"), h.get("WARC-Target-URI"), payload if kind == "response" else None, int(http["Content-Length"]), digest, kind, number("X-Refers-To-Page-ID")))
                        size += len(raw)
                        if size > 8 << 20:
                            yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    listed = names.mapInArrow(files, "file string").repartition(spark.sparkContext.defaultParallelism)
    return listed.mapInArrow(read, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op3_warc(spark, sf_dir: str) -> DataFrame:
    """Write all pages as an archive in the shared folder and read it back."""
    folder = scratch(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_warc(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
