"""Alignment of two tokenizers' tokens by the bytes they stand for, and how often ids are linked in the corpus.

A text is encoded by a byte-level BPE (A, of a space and the text) and by a sentence-piece BPE (B, of the text, which
adds that space).  A transducer reads both token sequences: its state is which side leads and by which bytes (the
dangling suffix); the other side's next token shortens that suffix, uses it up, or overtakes it and leads in turn.
Transitions are remembered by (suffix, token); an empty suffix closes a group.  A token whose bytes contradict the
suffix ends the reading: such texts (the piece model rewrites some) have no tokens, like null and empty ones.

Each document's links, the pairs of tokens that end together, are kept as distinct id pairs with their numbers; they
are counted over the corpus by partial sums, and a second pass over the kept pairs (not the texts) adds up what the
corpus says of them.  The counts are broadcast only up to ``TABLE`` pairs; beyond that they are joined by a shuffle in
which every pair is dealt over ``SALT`` tasks, as a frequent pair may be in most documents.

Repeated rows, and rows that share an id or have none, are rows of their own and count each.  Columns besides id and
text are ignored whatever their names; an empty table gives no rows.  Long texts are read whole.
"""
from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewcast.llm.bytebpe import ByteBpe
from renewcast.llm.shared import materialise
from renewcast.llm.textkernel import texts

PIECES = "piece_bpe_32k.model"
#: Remembered transitions a worker; pairs in a broadcast; tasks a pair is dealt over; links summed at a time.
MEMORY, TABLE, SALT, TOGETHER = 1 << 20, 1 << 22, 32, 1 << 22


class Pieces:
    """The sentence-piece side."""

    def __init__(self, model: str = PIECES):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        n = self.model.get_piece_size()
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(self.model.id_to_piece(list(range(n))))]

    def encode(self, many: list[str]) -> list[list[int]]:
        return self.model.encode(many, num_threads=1)


class Transducer:
    """Nodes are (side whose token comes next, what the other side leads by, token -> node).  At the start node, with
    nothing dangling, A's token comes next."""

    def __init__(self, a_bytes: list[bytes], b_bytes: list[bytes], memory: int = MEMORY):
        self.bytes, self.memory = (a_bytes, b_bytes), memory
        self.start = (0, b"", {})
        self.forget()

    def forget(self) -> None:
        self.start[2].clear()
        self.nodes = {(0, b""): self.start}
        self.known = 0

    def step(self, node, token: int):
        """The node after a token; none if its bytes contradict."""
        side, lead, _ = node
        own = self.bytes[side][token]
        if node is self.start:
            key = (1, own)
        elif lead.startswith(own):
            key = (side, lead[len(own):])
        elif own.startswith(lead):
            key = (1 - side, own[len(lead):])
        else:
            return None
        if not key[1]:
            return self.start
        if self.known >= self.memory:
            self.forget()
        return self.nodes.setdefault(key, (*key, {}))

    def groups(self, a: list[int], b: list[int]):
        """(tokens of A, tokens of B) up to the end of each group; none if the two don't stand for the same bytes."""
        start, node, i, j = self.start, self.start, 0, 0
        ends_a, ends_b = [], []
        try:
            while True:
                side, _, table = node
                if side:
                    token = b[j]
                    j += 1
                elif node is start and i == len(a):
                    break
                else:
                    token = a[i]
                    i += 1
                after = table.get(token)
                if after is None:
                    after = self.step(node, token)
                    if after is None:
                        return None
                    table[token] = after
                    self.known += 1
                if after is start:
                    ends_a.append(i)
                    ends_b.append(j)
                node = after
        except IndexError:
            # One side has ended inside a group.
            return None
        return (ends_a, ends_b) if j == len(b) else None


def written(a: list[str], b: list[str], ends_a: list[int], ends_b: list[int]) -> str:
    """``a1,a2|b1;a3|b2,b3`` of ids as text."""
    out, i, j = [], 0, 0
    for x, y in zip(ends_a, ends_b):
        out.append(a[i] + "|" + b[j] if x - i == 1 == y - j else ",".join(a[i:x]) + "|" + ",".join(b[j:y]))
        i, j = x, y
    return ";".join(out)


_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs binary, times binary"


def aligned(docs: DataFrame, groups: bool = False) -> DataFrame:
    """One row a document: doc_id, numbers of tokens and groups, the groups' digest (and with ``groups`` their text),
    and its distinct links: ``pairs`` (a * 2**32 + b as little-endian 64-bit integers) and ``times`` (32-bit)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches):
        left, right = ByteBpe(plain=True), Pieces()
        machine = Transducer(left.bytes, right.bytes)
        name_a, name_b = [str(k) for k in range(len(left.bytes))], [str(k) for k in range(len(right.bytes))]
        for batch in batches:
            for first, data, off in texts(batch.column(1)):
                raw, o = data.tobytes(), off.tolist()
                many = [raw[p:q].decode() for p, q in zip(o[:-1], o[1:])]
                rows = []
                for text, b in zip(many, right.encode(many)):
                    a = left.encode(" " + text) if text else []
                    ends = machine.groups(a, b) if a and b"".join(map(left.bytes.__getitem__, a)) == b" " + text.encode() else None
                    if ends is None:
                        rows.append((0, 0, 0, "", b"", b"", ""))
                        continue
                    where = written([name_a[k] for k in a], [name_b[k] for k in b], *ends)
                    ends_a, ends_b = (np.array(e, np.int64) - 1 for e in ends)
                    pairs, times = np.unique((np.array(a, np.int64)[ends_a] << 32) + np.array(b, np.int64)[ends_b], return_counts=True)
                    rows.append((len(a), len(b), len(ends_a), hashlib.sha256(where.encode()).hexdigest(), pairs.astype("<i8").tobytes(), times.astype("<i4").tobytes(), where if groups else ""))
                cols = list(zip(*rows))
                kinds = [pa.int64()] * 3 + [pa.string(), pa.binary(), pa.binary()] + [pa.string()] * groups
                yield pa.record_batch([batch.column(0).slice(first, len(rows)), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times", *["groups"] * groups])

    return docs.mapInArrow(run, _ALIGNED + (", groups string" if groups else ""))


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, count, best): how many links of the corpus a pair has, and whether no pair with its B id has more."""

    def add(batches):
        held, n = [], 0

        def summed():
            pair, times = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(pair, kind="stable")
            pair, times = pair[order], times[order]
            first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
            return pair[first], np.add.reduceat(times, first)

        for batch in batches:
            pair, times = (np.frombuffer(b"".join(batch.column(k).to_pylist()), kind) for k, kind in ((0, "<i8"), (1, "<i4")))
            if len(pair):
                held.append((pair, times.astype(np.int64)))
                n += len(pair)
            if n >= TOGETHER:
                held = [summed()]
                n = len(held[0][0])
                if n >= TOGETHER // 2:
                    yield pa.record_batch([pa.array(x) for x in held.pop()], names=["pair", "count"])
                    n = 0
        if held:
            yield pa.record_batch([pa.array(x) for x in summed()], names=["pair", "count"])

    counts = rows.select("pairs", "times").mapInArrow(add, "pair long, count long").groupBy("pair").agg(F.sum("count").alias("count"))
    counts = materialise(counts, "pair-counts")
    # B's ids are no more than its vocabulary.
    most = counts.groupBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b")).agg(F.max("count").alias("most"))
    return counts.join(F.broadcast(most), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)) == F.col("b")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def scored(rows: DataFrame, counts: DataFrame, table: int = TABLE) -> DataFrame:
    """rows of ``aligned`` (written ones) with n_links, n_best and count_sum instead of their pairs."""
    keep = [c for c in rows.columns if c not in ("pairs", "times")]
    names = [*keep, "n_links", "n_best", "count_sum"]
    if counts.count() <= table:
        got = counts.toArrow()
        pair, count, best = (got.column(k).to_numpy() for k in range(3))
        order = np.argsort(pair)
        shared = rows.sparkSession.sparkContext.broadcast((pair[order], count[order], best[order]))

        def look(batches):
            known, number, top = shared.value
            for batch in batches:
                raw = batch.column(batch.schema.get_field_index("pairs")).to_pylist()
                pair, times = np.frombuffer(b"".join(raw), "<i8"), np.frombuffer(b"".join(batch.column(batch.schema.get_field_index("times")).to_pylist()), "<i4").astype(np.int64)
                at = np.searchsorted(known, pair)
                edge = np.append(0, np.cumsum([len(x) // 8 for x in raw]))
                sums = []
                for x in (times, times * top[at], times * number[at]) if len(known) else [np.zeros(0, np.int64)] * 3:
                    total = np.append(0, np.cumsum(x))
                    sums.append(pa.array(total[edge[1:]] - total[edge[:-1]]))
                yield pa.record_batch([*(batch.column(batch.schema.get_field_index(c)) for c in keep), *sums], names=names)

        return rows.mapInArrow(look, ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep), "n_links long, n_best long, count_sum long"]))
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "aligned-rows")

    def each(batches):
        for batch in batches:
            raw = batch.column(1).to_pylist()
            n = [len(x) // 8 for x in raw]
            yield pa.record_batch([pa.array(np.repeat(batch.column(0).to_numpy(), n)), pa.array(np.frombuffer(b"".join(raw), "<i8")), pa.array(np.frombuffer(b"".join(batch.column(2).to_pylist()), "<i4"))], names=["row", "pair", "times"])

    links = rows.select("row", "pairs", "times").mapInArrow(each, "row long, pair long, times int").withColumn("salt", F.pmod("row", F.lit(SALT)).cast("int"))
    dealt = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    sums = links.join(dealt, ["pair", "salt"]).groupBy("row").agg(F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.join(sums, "row", "left").select(*keep, zero("n_links"), zero("n_best"), zero("count_sum"))


def align(docs: DataFrame, groups: bool = False, table: int = TABLE) -> DataFrame:
    """One row a document: doc_id, n_a, n_b, n_groups, groups_sha256, n_links, n_best, count_sum (and with ``groups`` the
    groups themselves)."""
    rows = materialise(aligned(docs, groups), "aligned")
    return scored(rows, pair_counts(rows), table)


def op13_alignment(spark, sf_dir: str) -> DataFrame:
    out = align(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
