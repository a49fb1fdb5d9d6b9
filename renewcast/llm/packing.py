"""Best-fit packing of documents into sequences of a fixed number of tokens, in rounds over sorted tables.

A document is its ids and a closing id.  Documents that are longer than a sequence are cut into pieces of a whole
sequence, what is over coming first.  Packing goes by rounds, each of which is one pass of Spark over the pieces that
have no place yet and the sequences with room (gaps):

1. Sequences are opened for the longest pieces: at first as many as the tokens need at least, later for what no gap
   can hold any more.
2. A gap that could hold several of the longest piece is dealt into that many equal parts.
3. Pieces and parts are sorted by size together (by range, ties by a hash), and swept: every part takes the longest
   piece before it that no part between them takes, as a bracket closes the last open one.  The sweep is made within
   each range first.  What it leaves, closing brackets before opening ones, is matched over the ranges by their counts
   alone, and by rank within them.
4. Matched pieces are placed, and gaps shrink by what they took.

Rounds end when all pieces have a place; each opens a sequence or places a piece, usually most of what fits: a
simulation of the rounds packs check_s's 66,866 pieces into 33,815 sequences (best-fit decreasing in one task: 33,807).  The driver has counts by
piece length (no more than a sequence's tokens) and by range.

Null and empty texts are pieces of the closing id alone.  Ties of length, repeated rows and rows that share an id or
have none are pieces of their own; texts of any length are cut as above; other columns are ignored whatever their
names; an empty table gives no rows.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renewcast.llm.bytebpe import ByteBpe
from renewcast.llm.shared import materialise, scratch
from renewcast.llm.textkernel import texts

CAPACITY, CLOSE = 2048, 0
#: A round's pieces are those of at least so many percent of the longest.
BAND = 50
#: Rows of a range of the sweep; classes by hash of pieces of one length, of which whole ones are opened.
RANGE, CLASSES = 1 << 16, 4096


def cut(n: int, capacity: int) -> list[int]:
    """Where the pieces of a document of n tokens begin, and its end."""
    first = n - (n - 1) // capacity * capacity
    return [0, *range(first, n + 1, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, close: int = CLOSE, ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece, with ``ids`` also its ids (little-endian, 32 bits)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches):
        coder = ByteBpe(plain=False)
        for batch in batches:
            for first, data, off in texts(batch.column(1)):
                raw, o = data.tobytes(), off.tolist()
                row, out = [], []
                for i, (p, q) in enumerate(zip(o[:-1], o[1:])):
                    tokens = np.array([*coder.encode(raw[p:q].decode()), close], "<u4")
                    edge = cut(len(tokens), capacity)
                    for k, (a, b) in enumerate(zip(edge[:-1], edge[1:])):
                        own = tokens[a:b].tobytes()
                        row.append(first + i)
                        out.append((k, a, b - a, zlib.crc32(own), own if ids else b""))
                cols = list(zip(*out))
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * ids
                yield pa.record_batch([batch.column(0).take(pa.array(row)), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * ids])

    return docs.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if ids else ""))


def sweep(item: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bracket matching of a sorted run; item tells pieces (opening) from parts of gaps (closing).  Returns the places
    of matched pieces and of their parts, of the parts left over, and of the pieces left over (the last one first)."""
    level = np.cumsum(np.where(item, 1, -1)) + ~item
    order = np.lexsort((np.arange(len(item)), level))
    a, b = order[:-1], order[1:]
    pair = (level[a] == level[b]) & item[a] & ~item[b]
    left = np.ones(len(item), bool)
    left[a[pair]] = left[b[pair]] = False
    return a[pair], b[pair], np.flatnonzero(left & ~item), np.flatnonzero(left & item)[::-1]


def _swept(batches):
    from pyspark import TaskContext

    held = [pa.Table.from_batches([b]) for b in batches]
    if not held:
        return
    table = pa.concat_tables(held).combine_chunks()
    item, key, slot = (table[c].to_numpy() for c in ("item", "key", "slot"))
    p, g, closing, opening = sweep(item)
    part = TaskContext.get().partitionId()
    none = lambda n: np.full(n, -1, np.int64)
    rows = [(none(len(p)), key[p], key[g], slot[g], none(len(p))), (np.full(len(closing), part), none(len(closing)), key[closing], slot[closing], np.arange(len(closing))), (np.full(len(opening), part), key[opening], none(len(opening)), none(len(opening)), np.arange(len(opening)))]
    yield pa.record_batch([pa.array(np.concatenate(x), pa.int64()) for x in zip(*rows)], names=["part", "piece_key", "seq", "slot", "rank"])


def across(counts: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(range of the pieces, first rank, range of the parts, first rank, number) of what is matched over ranges, from
    each range's (number, parts left over, pieces left over) in order."""
    stack, out = [], []
    for part, closing, opening in sorted(counts):
        done = 0
        while done < closing and stack:
            other, first, rest = stack.pop()
            n = min(rest, closing - done)
            out.append((other, first, part, done, n))
            done += n
            if n < rest:
                stack.append((other, first + n, rest - n))
        if opening:
            stack.append((part, 0, opening))
    return out


def match(state: DataFrame, longest: int, shortest: int, total: int) -> DataFrame:
    """(item, seq, slot): what each part of a gap takes.  state(item, key, size) has pieces, by item and length,
    and gaps, by sequence and room; of both, those of at least ``shortest`` take part, ``total`` rows in all."""
    spark = state.sparkSession
    some = state.where(F.col("size") >= shortest)
    k = F.when(F.col("item"), 1).otherwise(F.greatest(F.floor(F.col("size") / longest), F.lit(1))).cast("int")
    parts = some.withColumn("k", k).withColumn("slot", F.explode(F.expr("sequence(0L, k - 1L)")))
    size = F.floor(F.col("size") / F.col("k")) + F.when(F.col("slot") < F.col("size") % F.col("k"), 1).otherwise(0)
    rows = parts.select(size.alias("size"), "item", "key", "slot")
    # Pieces stand before parts of the same size.
    order = [F.col("size"), (~F.col("item")), F.xxhash64("key", "slot"), F.col("key"), F.col("slot")]
    dealt = rows.repartitionByRange(max(8, total // RANGE + 1), *order).sortWithinPartitions(*order)
    found = materialise(dealt.select("item", "key", "slot").mapInArrow(_swept, "part long, piece_key long, seq long, slot long, rank long"), "swept")
    here = found.where("part < 0").select(F.col("piece_key").alias("item"), "seq", "slot")
    counts = found.where("part >= 0").groupBy("part").agg(F.sum((F.col("piece_key") < 0).cast("int")).alias("closing"), F.sum((F.col("piece_key") >= 0).cast("int")).alias("opening")).collect()
    runs = across([tuple(r) for r in counts])
    if not runs:
        return here
    runs = spark.createDataFrame([(i, *r) for i, r in enumerate(runs)], "run int, a long, a0 long, b long, b0 long, n long")
    opening = found.where("part >= 0 AND piece_key >= 0").join(F.broadcast(runs), (F.col("part") == F.col("a")) & (F.col("rank") >= F.col("a0")) & (F.col("rank") < F.col("a0") + F.col("n"))).select("run", (F.col("rank") - F.col("a0")).alias("k"), F.col("piece_key").alias("item"))
    closing = found.where("part >= 0 AND piece_key < 0").join(F.broadcast(runs), (F.col("part") == F.col("b")) & (F.col("rank") >= F.col("b0")) & (F.col("rank") < F.col("b0") + F.col("n"))).select("run", (F.col("rank") - F.col("b0")).alias("k"), "seq", "slot")
    return here.unionByName(opening.join(closing, ["run", "k"]).select("item", "seq", "slot"))


def longest_items(items: DataFrame, n: int, lengths: dict[int, int]) -> DataFrame:
    """The n longest of items; ``lengths`` counts them by length.  Of the last length's, whole classes by hash are
    taken, and of the last class its smallest."""
    for at in sorted(lengths, reverse=True):
        if n <= lengths[at]:
            break
        n -= lengths[at]
    longer, same = items.where(F.col("length") > at), items.where(F.col("length") == at)
    if n == lengths[at]:
        return longer.unionByName(same)
    same = same.withColumn("c", F.pmod(F.xxhash64("item"), F.lit(CLASSES)))
    for c, k in sorted((r["c"], r["count"]) for r in same.groupBy("c").count().collect()):
        if n < k:
            break
        n -= k
    some = same.where(F.col("c") == c).withColumn("i", F.row_number().over(Window.partitionBy("c").orderBy("item"))).where(F.col("i") <= n)
    return longer.unionByName(same.where(F.col("c") < c).drop("c")).unionByName(some.drop("c", "i"))


def place(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(item, seq, turn, slot) of all items(item, length), lengths of 1 to capacity; a sequence bears the number of
    the item that opened it, and its items stand in the order of turn and slot."""
    spark, folder = items.sparkSession, scratch(items.sparkSession, "placed")

    def put(rows: DataFrame, turn: int) -> DataFrame:
        """Places found in a turn go to a folder of their own, so that all are read by one scan."""
        rows.select("item", "seq", "slot").write.option("compression", "zstd").parquet(f"{folder}/turn={turn}")
        return spark.read.schema("item long, seq long, slot long").parquet(f"{folder}/turn={turn}")

    alone = lambda rows: rows.select("item", F.col("item").alias("seq"), F.lit(0).cast("long").alias("slot"))
    put(alone(items.where(F.col("length") == capacity)), 0)
    state = items.where(F.col("length") < capacity).select(F.lit(True).alias("item"), F.col("item").alias("key"), F.col("length").alias("size"))
    turn = 0
    while True:
        sizes: dict[bool, dict[int, int]] = {True: {}, False: {}}
        for r in state.groupBy("item", "size").count().collect():
            sizes[r["item"]][r["size"]] = r["count"]
        lengths, gaps = sizes[True], sizes[False]
        if not lengths:
            break
        turn += 1
        room, least = max(gaps, default=0), max(1, max(lengths) * BAND // 100)
        band = {n: k for n, k in lengths.items() if n >= least}
        over = {n: k for n, k in band.items() if n > room}
        if over:
            # One sequence for each piece over half of one, and as many as the tokens need.
            need = sum(n * k for n, k in (over if turn > 1 else lengths).items())
            opened = min(sum(over.values()), max(sum(k for n, k in over.items() if 2 * n > capacity), -(-need // capacity)))
            pieces_left = state.where("item").select(F.col("key").alias("item"), F.col("size").alias("length"))
            new = put(alone(longest_items(pieces_left, opened, lengths)), turn).select(F.lit(True).alias("item"), F.col("item").alias("key"), F.lit(True).alias("opens"))
            both = state.join(new, ["item", "key"], "left")
            opens = F.coalesce("opens", F.lit(False))
            state = materialise(both.select((F.col("item") & ~opens).alias("item"), "key", F.when(opens, capacity - F.col("size")).otherwise(F.col("size")).alias("size")), "packing")
            continue
        longest, shortest = max(band), min(band)
        parts = sum(k * max(n // longest, 1) for n, k in gaps.items() if n >= shortest)
        taken = put(match(state, longest, shortest, sum(band.values()) + parts), turn)
        size = state.where("item").where(F.col("size") >= shortest).select(F.col("key").alias("item"), F.col("size").alias("length"))
        taken = taken.join(size, "item").select("item", "seq", "length")
        less = taken.select(F.lit(True).alias("item"), F.col("item").alias("key"), "length").unionByName(taken.select(F.lit(False).alias("item"), F.col("seq").alias("key"), "length"))
        less = less.groupBy("item", "key").agg(F.sum("length").alias("less"))
        state = materialise(state.join(less, ["item", "key"], "left").select("item", "key", (F.col("size") - F.coalesce("less", F.lit(0))).alias("size")).where("size > 0"), "packing")
    return spark.read.schema("item long, seq long, slot long, turn int").parquet(folder)


def pack(docs: DataFrame, capacity: int = CAPACITY, close: int = CLOSE, ids: bool = False) -> DataFrame:
    """Rows of ``pieces`` with sequence_id and offset, the piece's place there."""
    rows = materialise(pieces(docs, capacity, close, ids).withColumn("item", F.monotonically_increasing_id()), "pieces")
    # A sequence holds no more pieces than tokens.
    w = Window.partitionBy("seq").orderBy("turn", "slot", "item")
    where = place(rows.select("item", "length"), capacity).join(rows.select("item", "length"), "item").select("item", F.col("seq").alias("sequence_id"), (F.sum("length").over(w) - F.col("length")).alias("offset"))
    return rows.join(where, "item").drop("item")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, of ``pack(..., ids=True)``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select("sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def op12_packing(spark, sf_dir: str) -> DataFrame:
    out = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
