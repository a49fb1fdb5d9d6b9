"""Substring dedup: word windows that also start in an earlier document are removed.

A window is ``window`` consecutive words of one document; a word goes if a window that covers it also starts
in a document with a smaller id.  Two passes over the text:

1. Every window chooses an anchor, the smallest hash of its ``gram``-word grams.  Equal windows choose equal
   anchors, and neighbours mostly choose the same one, so anchors are about a sixteenth of the windows.  A
   count-min sketch over the (document, anchor) pairs, merged from the partitions' sketches, overestimates
   in how many documents a window's anchor, and so the window, can occur.
2. Only windows whose anchor is estimated repeated are grouped exactly.  A run of windows with one anchor is
   a segment.  Equal segments are grouped first (partial aggregation takes care of hot groups); the windows
   themselves are compared only between the different segments of one anchor.  A segment that a large part of all
   occurrences have is decided by a broadcast of bounded size instead of in one task.

Windows are compared by 64-bit hashes within their anchor's 64-bit hash.  Nulls and empty texts have no
words.  Rows that share an id count as one document's pieces: none of them is earlier than the other, and
windows don't cross them.  Rows without an id are never earlier than another row and lose nothing.  Columns
besides id and text are ignored.  An empty table gives no rows.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewcast.llm import countmin
from renewcast.llm.shared import join_hot, materialise, text_bytes
from renewcast.llm.textkernel import _P2, SPACE, U, anchors, cover, mix, prefix_hash, ranges, row_bounds, span_hash, texts, word_hashes, word_spans

GRAM = 20
_WORD = ~SPACE


def _segments(column, window: int, gram: int):
    for first, data, off in texts(column):
        start, end, row = word_spans(data, off, _WORD)
        bound = row_bounds(row, len(off) - 1)
        items = word_hashes(data, start, end)
        anchor, p, count, _ = anchors(items, row, bound, gram, window)
        yield first, items, row, bound, anchor, p, count


def _found(docs: DataFrame, window: int, gram: int, bits) -> DataFrame:
    bits = docs.sparkSession.sparkContext.broadcast(bits)

    def scan(batches):
        for batch in batches:
            ids, hashes = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            for first, items, row, bound, anchor, p, count in _segments(batch.column(1), window, gram):
                keep = countmin.repeated(bits.value, anchor)
                anchor, p, count = anchor[keep], p[keep], count[keep]
                total, down = prefix_hash(mix(items + U(1)), _P2)
                w = ranges(p, count)
                yield pa.record_batch([
                    pa.array(anchor.view(np.int64)), pa.array((span_hash(total, down, p, p + count + window - 1) ^ count.astype(U)).view(np.int64)),
                    pa.array(ids[first + row[p]]), pa.array(hashes[first + row[p]]), pa.array((p - bound[row[p]]).astype(np.int32)), pa.array(count.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)).astype(np.int32)), pa.array(span_hash(total, down, w, w + window).view(np.int64))),
                ], names=["anchor", "segment", "doc_id", "text_hash", "at", "n", "windows"])

    return docs.mapInArrow(scan, "anchor long, segment long, doc_id long, text_hash long, at int, n int, windows array<long>")


def removed_segments(docs: DataFrame, window: int = 50, gram: int = GRAM) -> DataFrame:
    """doc_id, text_hash (xxhash64 of the row's text), at (first window, by word), n and mask (bit j: window at + j is
    to go), for docs(doc_id, text)."""
    if gram > window or window - gram + 1 > 62:
        raise ValueError("a window holds 1 to 62 grams")
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).where("doc_id IS NOT NULL AND text IS NOT NULL")

    def keys(batch):
        for _, _, row, _, anchor, p, _ in _segments(batch.column(1), window, gram):
            if len(p):
                pairs = np.unique(np.rec.fromarrays([row[p], anchor]))
                yield pairs.f1.copy()

    about = text_bytes(docs) // 6 * 2 // (window - gram + 2)
    bits = countmin.build(docs, keys, countmin.blocks_for(about))
    found = materialise(_found(docs, window, gram, bits), "windows")
    # Equal segments are one piece, with its windows as any of them has them.
    pieces = materialise(found.groupBy("anchor", "segment", "n").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("copies"), F.first("windows").alias("windows")), "pieces")
    parts = pieces.drop("windows")
    several = parts.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("anchor")
    each = pieces.join(several, "anchor", "left_semi").select("anchor", "segment", "n", "first_doc", F.posexplode("windows").alias("j", "window"))
    least = each.groupBy("anchor", "window").agg(F.min("first_doc").alias("least"))
    late = each.join(least, ["anchor", "window"]).where("least < first_doc").groupBy("anchor", "segment", "n").agg(F.expr("bit_or(shiftleft(1L, j))").alias("mask"))
    decided = materialise(parts.join(late, ["anchor", "segment", "n"], "left").where("copies > 1 OR mask IS NOT NULL"), "decided")
    return (join_hot(found.select("doc_id", "text_hash", "at", "anchor", "segment", "n"), decided, "anchor", "segment", "n")
            .select("doc_id", "text_hash", "at", "n", F.when(F.col("doc_id") > F.col("first_doc"), F.expr("shiftleft(1L, n) - 1")).otherwise(F.coalesce("mask", F.lit(0))).alias("mask")).where("mask <> 0"))


def substring_dedup(docs: DataFrame, window: int = 50, gram: int = GRAM) -> DataFrame:
    """One row a document: doc_id, n_words, n_removed, kept (words joined by one space), kept_sha256."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    # By the row's text too: rows that share an id lose what is theirs, and equal ones list it once.
    gone = removed_segments(docs, window, gram).groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("at", "n", "mask")).alias("gone"))

    def apply(batches):
        for batch in batches:
            ids, gone = batch.column(0), batch.column(2)
            for first, data, off in texts(batch.column(1)):
                start, end, row = word_spans(data, off, _WORD)
                bound = row_bounds(row, len(off) - 1)
                out = []
                for i in range(len(off) - 1):
                    s, e = start[bound[i]:bound[i + 1]], end[bound[i]:bound[i + 1]]
                    n, segments = len(s), gone[first + i].as_py() or ()
                    keep = np.ones(n, bool)
                    if segments:
                        at, count, mask = (np.array([x[k] for x in segments], np.int64) for k in ("at", "n", "mask"))
                        w = ranges(np.zeros(len(at), np.int64), count)
                        of = np.repeat(np.arange(len(at)), count)
                        w = (w + at[of])[(mask[of] >> w) & 1 == 1]
                        keep = ~cover(n, w, w + window)
                    raw = data[off[i]:off[i + 1]].tobytes()
                    s, e = (s - off[i])[keep], (e - off[i])[keep]
                    kept = b" ".join([raw[a:b] for a, b in zip(s.tolist(), e.tolist())])
                    out.append((n, int(n - keep.sum()), kept.decode("utf-8", "replace"), hashlib.sha256(kept).hexdigest()))
                cols = list(zip(*out))
                yield pa.record_batch([ids.slice(first, len(out)), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string())], names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    return docs.join(gone, ["doc_id", "text_hash"], "left").select("doc_id", "text", "gone").mapInArrow(apply, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_words", "n_removed", "kept_sha256")
