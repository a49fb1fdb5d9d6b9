"""Token counts of flat token files: a scan for end-of-document identifiers.

A token file is a bare sequence of fixed-width little-endian ids, documents one after another, each closed
by the separator; no index comes with it.  ``scan_counts`` cuts the files into blocks of equal length, finds
the separators of each block with one vectorised comparison, and stitches documents that cross blocks: with
each block's number of separators and the place after its last one, a prefix scan over the block summaries
tells every block the number of its first document and where the document that runs into it began.  Blocks are
read in parallel wherever they lie.  Only summaries, four numbers a block, are ordered, in two levels: within
spans of ``SPAN`` blocks, and the spans of a file; what each block found meets its summary again by a join.

A file that doesn't end with a separator ends with an open document, which counts (closed = false) if it has
any token.  Empty files hold no documents; two separators in a row hold an empty one; a folder without files
gives no rows.  Writing: null and empty texts are documents without tokens, repeated rows and ids are written
row by row (ties of ids stay apart by file and number), texts of any length are one document, columns besides id
and text are ignored whatever their names, and an empty table writes no file.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from renewcast.llm.bpe import TOKENIZER, Coder
from renewcast.llm.shared import materialise, scratch
from renewcast.llm.textkernel import texts

BLOCK, SPAN = 4 << 20, 4096
SEPARATOR = 49407


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, separator: int = SEPARATOR, width: int = 2) -> DataFrame:
    """Encode docs(doc_id, text) into one flat file a partition; returns (path, doc_no, doc_id), what the
    n-th document of a file is.  A file gets its name once it is whole."""

    def write(batches):
        import os

        from pyspark import TaskContext

        coder, fs, where, done = Coder(tokenizer, plain=True), None, None, 0
        name = f"{folder}/tokens-{TaskContext.get().partitionId():06d}.bin"
        temp = f"{name}.{TaskContext.get().taskAttemptId()}-{os.getpid()}.tmp"
        out = None
        for batch in batches:
            for first, data, off in texts(batch.column(1)):
                if out is None:
                    fs, where = _filesystem(temp)
                    fs.create_dir(where.rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(where)
                raw, o = data.tobytes(), off.tolist()
                ids, edge = coder.step([raw[a:b] for a, b in zip(o[:-1], o[1:])])
                n = len(o) - 1
                flat = np.full(len(ids) + n, separator, f"<u{width}")
                flat[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(edge))] = ids
                out.write(flat.tobytes())
                yield pa.record_batch([pa.array([name] * n, pa.string()), pa.array(np.arange(done, done + n)), batch.column(0).slice(first, n)], names=["path", "doc_no", "doc_id"])
                done += n
        if out is not None:
            out.close()
            fs.move(where, _filesystem(name)[1])

    return docs.select("doc_id", "text").mapInArrow(write, "path string, doc_no long, doc_id long")


def blocks(spark: SparkSession, folder: str, width: int = 2, block: int = BLOCK) -> DataFrame:
    """(path, block, start, bytes) of every token file in a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder).select("path", "length").where("length > 0")
    size = max(width, block - block % width)
    return files.select("path", F.expr(f"explode(sequence(0L, (length - 1) div {size}))").alias("block"), "length").select(
        "path", "block", (F.col("block") * size).alias("start"), F.least(F.lit(size), F.col("length") - F.col("block") * size).alias("bytes"))


def scan_counts(spark: SparkSession, folder: str, separator: int = SEPARATOR, width: int = 2, block: int = BLOCK, span: int = SPAN) -> DataFrame:
    """(path, doc_no, first_token, n_tokens, closed) of each document of the files in a folder."""
    todo = blocks(spark, folder, width, block)

    def scan(batches):
        for batch in batches:
            for path, k, start, size in zip(*(batch.column(c).to_pylist() for c in range(4))):
                fs, where = _filesystem(path)
                with fs.open_input_file(where) as f:
                    raw = np.frombuffer(f.read_at(size, start), f"<u{width}")
                place = np.flatnonzero(raw == separator)
                last = int(place[-1]) + 1 if len(place) else 0
                yield pa.record_batch([pa.array([path]), pa.array([k], pa.int64()), pa.array([start // width], pa.int64()), pa.array([len(place)], pa.int64()), pa.array([len(raw)], pa.int64()), pa.array([last], pa.int64()), pa.array([place], pa.list_(pa.int64()))],
                                      names=["path", "block", "first", "n", "tokens", "last", "places"])

    found = materialise(todo.repartition(F.col("path"), F.col("block")).mapInArrow(scan, "path string, block long, first long, n long, tokens long, last long, places array<long>"), "blocks")
    # Where the document that runs into a block began: after the last separator of any earlier block.
    summary = found.select("path", "block", F.expr(f"block div {span}").alias("span"), "n", F.when(F.col("n") > 0, F.col("first") + F.col("last")).alias("after"))
    total, latest = (lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))), (lambda c, w: F.coalesce(F.max(c).over(w), F.lit(0)))
    before = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    spans = summary.groupBy("path", "span").agg(F.sum("n").alias("n"), F.max("after").alias("after"), F.max("block").alias("most"))
    over, w = before("path", "span"), Window.partitionBy("path")
    spans = spans.select("path", "span", total("n", over).alias("docs"), latest("after", over).alias("open"), F.max("most").over(w).alias("end"))
    inner = before("path", "span", "block")
    scanned = summary.select("path", "span", "block", total("n", inner).alias("docs_before"), latest("after", inner).alias("open_at"))
    scanned = scanned.join(spans, ["path", "span"]).select("path", "block", (F.col("docs_before") + F.col("docs")).alias("docs_before"), F.greatest("open_at", "open").alias("open_at"), (F.col("block") == F.col("end")).alias("end"))
    stitched = found.join(scanned, ["path", "block"])
    ended = stitched.select("path", "docs_before", "first", "open_at", "places", F.posexplode("places").alias("i", "place")).select(
        "path", (F.col("docs_before") + F.col("i")).alias("doc_no"),
        F.when(F.col("i") == 0, F.col("open_at")).otherwise(F.col("first") + F.expr("get(places, i - 1)") + 1).alias("first_token"), (F.col("first") + F.col("place")).alias("stop"), F.lit(True).alias("closed"))
    rest = stitched.where("end").select("path", (F.col("docs_before") + F.col("n")).alias("doc_no"), F.when(F.col("n") > 0, F.col("first") + F.col("last")).otherwise(F.col("open_at")).alias("first_token"), (F.col("first") + F.col("tokens")).alias("stop"), F.lit(False).alias("closed")).where("stop > first_token")
    return ended.unionByName(rest).select("path", "doc_no", "first_token", (F.col("stop") - F.col("first_token")).alias("n_tokens"), "closed")


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    """Token files of all documents, counted by a scan: doc_id, n_tokens."""
    folder = scratch(spark, "tokens")
    which = materialise(write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder), "token-docs")
    tail = lambda c: F.substring_index(c, "/", -1)
    counts = scan_counts(spark, folder) if which.limit(1).count() else None
    if counts is None:
        return which.select("doc_id", F.lit(0).cast("long").alias("n_tokens"))
    # Both sides grow with the corpus: neither is broadcast.
    return which.select(tail("path").alias("file"), "doc_no", "doc_id").hint("merge").join(counts.select(tail("path").alias("file"), "doc_no", "n_tokens"), ["file", "doc_no"]).select("doc_id", "n_tokens")
