"""N-gram Jaccard join of documents, size-aware: subsets of small sets, inverted lists of large ones.

A document's set holds its distinct ``gram``-word shingles (lower-cased A-Z; fewer words: the whole sequence
as one), as 64-bit hashes.  Two sets link if 100 * intersection >= percent * union.  Equal sets are one node;
the graph of the nodes is cut into components.

Small sets (light, up to a boundary): sets of a and b shingles link if they share a subset of
need(a, b) = ceil(percent * (a + b) / (100 + percent)) shingles, so each enumerates its subsets of the sizes
that its partners can need.  All sets with a subset in common link to the smallest of them where its need
allows; a link between two others implies theirs to the smallest, so nothing more is paired.

Large sets (heavy) are found by inverted lists of shingles.  All shingles have one order, from rare to frequent
(levels of a merged count-min sketch, then a hash), and linked sets share one of the first n - ceil(percent * n /
100) + 1 shingles of each.  Only lists of these are made, and none of a shingle that the sketch, which never
underestimates, holds to be in one set.  A set with enough shingles of its own is thus in no list at all.  Lists
are scanned in rounds: every set is compared, exactly, with the most central set (the one in the most and longest
lists) of the lists it is in, and what links is merged; up to ``ROUNDS`` times, for lists that still hold several
components.  Then the members of different components in a list are compared by sketches, which bound from below
in how many shingles sets differ, and those that may link exactly.  A large group of near copies thus costs a
comparison or a few for each copy, and no link is lost.

The boundary is where the total of subsets written and lists scanned is least for the sizes at hand; sets of
at least percent % of it are in the inverted lists too, for links across.

Null and wordless texts have empty sets, linked with nothing: their component is their own id.  Repeated rows
and ids are treated row by row.  Rows without an id belong to the component of their set but never name it
(alone, it is null).  Other columns are ignored.  An empty table gives no rows.
"""
from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from renewcast.llm import countmin
from renewcast.llm.components import components
from renewcast.llm.shared import materialise, text_bytes, whole_groups
from renewcast.llm.textkernel import _P1, SPACE, U, mix, prefix_hash, ranges, row_bounds, span_hash, texts, word_hashes, word_spans

#: What reading, pairing and checking an entry of an inverted list costs, in subsets written.
SCAN, MOST_LIGHT, ROUNDS, SKETCH, CELL = 16, 24, 2, 256, 1024
#: Counts that part frequent shingles from rarer ones; cells of the sketch a shingle, and blocks of them at most.  The
#: sketch need not be sharp: a set is left out as soon as its first shingles, a fifth or so, are known to be its own.
LEVELS, CELLS, BLOCKS = (16,), 0.5, 1 << 12
_WORD = ~SPACE
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Sizes:
    """What sets of given sizes need of each other."""

    def __init__(self, percent: int, light: int):
        self.percent, self.light = percent, light
        self.first = max(1, -(-percent * (light + 1) // 100))

    def prefix(self, n):
        """How many of its first shingles a heavy set of n has lists for."""
        return n + (-self.percent * n // 100) + 1

    def need(self, a: int, b: int) -> int:
        return -(-self.percent * (a + b) // (100 + self.percent))

    def subsets(self, n: int) -> list[int]:
        """Sizes of the subsets that a light set of n enumerates."""
        return sorted({c for b in range(1, self.light + 1) if min(n, b) * 100 >= self.percent * max(n, b) and (c := self.need(n, b)) <= min(n, b)})

    def cost(self, count: dict[int, int]) -> int:
        return sum(k * (sum(comb(n, c) for c in self.subsets(n)) if n <= self.light else 0) + k * (SCAN * self.prefix(n) if n >= self.first else 0) for n, k in count.items())


def choose_boundary(docs: DataFrame, percent: int, gram: int) -> int:
    """The cheapest boundary, from the counts of short texts by size (an estimate without repeated shingles)."""
    short = docs.where(F.octet_length("text") < 40 * (MOST_LIGHT + gram)).select((F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) - gram + 1).alias("n"))
    count = {r["n"]: r["count"] for r in short.where(F.col("n").between(1, 2 * MOST_LIGHT)).groupBy("n").count().collect()}
    return min(range(MOST_LIGHT + 1), key=lambda b: (Sizes(percent, b).cost(count), b))


def sets(data: np.ndarray, off: np.ndarray, gram: int):
    """(shingles, row of each, first of each row): the distinct shingles of each row, in order."""
    data = _LOWER[data]
    start, end, row = word_spans(data, off, _WORD)
    rows = len(off) - 1
    bound = row_bounds(row, rows)
    words = word_hashes(data, start, end)
    total, down = prefix_hash(words, _P1)
    n = np.diff(bound)
    count = np.where(n >= gram, n - gram + 1, np.minimum(n, 1))
    at = ranges(bound[:-1], count)
    of = np.repeat(np.arange(rows), count)
    h = span_hash(total, down, at, np.minimum(at + gram, bound[of + 1]))
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    keep = np.append(True, (h[1:] != h[:-1]) | (of[1:] != of[:-1])) if len(h) else np.zeros(0, bool)
    h, of = h[keep], of[keep]
    return h, of, row_bounds(of, rows)


def _set_ids(h, of, rows):
    ids = np.zeros(rows, U)
    np.add.at(ids, of, mix(h + U(0x5BF03635)))
    return mix(ids)


def prefixes(h, of, bound, sizes: Sizes, bits):
    """(row, shingle) of the inverted lists of the heavy sets; bits: the sketch's levels."""
    n = np.diff(bound)
    heavy = np.flatnonzero(n >= sizes.first)
    at = ranges(bound[heavy], n[heavy])
    h, of = h[at], of[at]
    level = sum(countmin.repeated(b, h).astype(np.int8) for b in bits)
    order = np.lexsort((mix(h), level, of))
    place = np.arange(len(order)) - np.repeat(np.append(0, np.cumsum(n[heavy]))[:-1], n[heavy])
    keep = order[(place < np.repeat(sizes.prefix(n[heavy]), n[heavy])) & (level[order] > 0)]
    return of[keep], h[keep]


def subsets(h, bound, sizes: Sizes):
    """(row, key, size) of the subsets of the light sets."""
    n = np.diff(bound)
    rows, keys, counts = [], [], []
    for size in range(1, sizes.light + 1):
        r = np.flatnonzero(n == size)
        if len(r):
            x = mix(h[bound[r][:, None] + np.arange(size)] + U(0x2545F491))
            for c in sizes.subsets(size):
                pick = np.array(list(combinations(range(size), c)))
                k = mix(x[:, pick].sum(axis=2, dtype=U) + U(c))
                rows.append(np.repeat(r, len(pick)))
                keys.append(k.ravel())
                counts.append(np.full(k.size, c, np.int32))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, np.int32)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(counts)


def _lists(row, rows, *columns):
    order = np.argsort(row, kind="stable")
    edge = pa.array(np.searchsorted(row[order], np.arange(rows + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(edge, pa.array(c[order].view(np.int64) if c.dtype == U else c[order])) for c in columns]


def _scan(docs: DataFrame, gram: int, sizes: Sizes, bits, carry=()) -> DataFrame:
    carried = docs.select(*carry).schema
    bits = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            for first, data, off in texts(batch.column(1)):
                h, of, bound = sets(data, off, gram)
                rows = len(off) - 1
                row, key = prefixes(h, of, bound, sizes, bits.value)
                light = subsets(h, bound, sizes)
                yield pa.record_batch([
                    batch.column(0).slice(first, rows), pa.array(_set_ids(h, of, rows).view(np.int64)), pa.array(np.diff(bound).astype(np.int32)),
                    *_lists(row, rows, key), *_lists(light[0], rows, light[1], light[2]),
                    *(batch.column(2 + i).slice(first, rows) for i in range(len(carry))),
                ], names=["doc_id", "node", "n", "lists", "subsets", "sizes", *carry])

    own = T.StructType.fromDDL("doc_id long, node long, n int, lists array<long>, subsets array<long>, sizes array<int>")
    return docs.mapInArrow(run, T.StructType([*own.fields, *carried.fields]))


def _shingles(docs: DataFrame, gram: int, nodes: DataFrame) -> DataFrame:
    """(node, shingles, sketch) of the given nodes: a scan behind a bit filter of their ids."""
    about = nodes.count()
    bits = countmin.build(nodes, lambda b: iter([b.column(0).to_numpy().view(U)]), countmin.blocks_for(about, 12), least=1)
    bits = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            for _, data, off in texts(batch.column(1)):
                h, of, bound = sets(data, off, gram)
                ids = _set_ids(h, of, len(off) - 1)
                r = np.flatnonzero(countmin.repeated(bits.value, ids) & (np.diff(bound) > 0))
                _, one = np.unique(ids[r], return_index=True)
                r = r[one]
                if len(r):
                    size = np.diff(bound)[r]
                    own = h[ranges(bound[r], size)]
                    x = mix(own + U(0x7F4A7C15))
                    content = np.zeros(len(r) * SKETCH, U)
                    np.add.at(content, np.repeat(np.arange(len(r)), size) * SKETCH + (x % U(SKETCH)).astype(np.int64), mix(x))
                    sketch = (mix(content) >> U(56)).astype(np.uint8)
                    yield pa.record_batch([pa.array(ids[r].view(np.int64)), pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array(own.view(np.int64))),
                                           pa.FixedSizeBinaryArray.from_buffers(pa.binary(SKETCH), len(r), [None, pa.py_buffer(sketch)]).cast(pa.binary())], names=["node", "shingles", "sketch"])

    found = docs.mapInArrow(run, "node long, shingles array<long>, sketch binary")
    return found.groupBy("node").agg(F.first("shingles").alias("shingles"), F.first("sketch").alias("sketch"))


def _candidates(rest: DataFrame, percent: int) -> DataFrame:
    """(a, b): members of one list, of different components, whose sketches don't rule a link out.

    A sketch has a byte for each of SKETCH parts of the set; sets differ in at least as many shingles as
    sketches do in bytes.  Lists of more than CELL members are compared in cells of two chunks of them.
    """
    counts = rest.groupBy("key").agg(F.count(F.lit(1)).alias("k")).select("key", F.ceil(F.col("k") / CELL).cast("int").alias("g"))
    chunked = rest.join(counts, "key").withColumn("chunk", F.pmod(F.xxhash64("node"), "g").cast("int"))
    cells = chunked.select("key", "node", "n", "component", "sketch", "chunk", F.explode(F.expr("sequence(0, g - 1)")).alias("j"))
    cells = cells.select(F.xxhash64("key", F.least("chunk", "j"), F.greatest("chunk", "j")).alias("at"), "key", (F.col("chunk") != F.col("j")).alias("across"), "chunk", "node", "n", "component", "sketch")

    def compare(batches):
        for table in whole_groups(batches):
            at, chunk, across = (table[c].to_numpy(zero_copy_only=False) for c in ("at", "chunk", "across"))
            node, n, part = (table[c].to_numpy() for c in ("node", "n", "component"))
            s = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, SKETCH)
            edge = np.append(np.flatnonzero(np.append(True, at[1:] != at[:-1])), len(at))
            left, right = [], []
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                for i in range(a, b):
                    # Each pair of a cell once; pairs of one chunk belong to the chunk's own cell.
                    j = np.arange(i + 1, b)
                    j = j[(part[j] != part[i]) & (np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * percent) & ((chunk[j] != chunk[i]) | (across[i] == False))]  # noqa: E712
                    if len(j):
                        j = j[(s[j] != s[i]).sum(axis=1) <= (n[i].astype(np.int64) + n[j]) * (100 - percent) // (100 + percent)]
                        left.append(np.full(len(j), node[i]))
                        right.append(node[j])
            if left:
                x, y = np.concatenate(left), np.concatenate(right)
                x, y = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
                yield pa.record_batch([pa.array(x), pa.array(y)], names=["a", "b"])

    return cells.repartition("at").sortWithinPartitions("at").mapInArrow(compare, "a long, b long")


def _distances(pairs: DataFrame, shingles: DataFrame) -> DataFrame:
    """pairs(a, b) with inter and total (union)."""
    left, right = (shingles.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("inter"), (F.size("sa") + F.size("sb")).alias("sum"))
    return both.select("a", "b", "inter", (F.col("sum") - F.col("inter")).alias("total"))


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of lists that hold several components, with the list's most central one."""
    marked = members.select("key", "node", "n", "central").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lists = marked.groupBy("key").agg(F.max(F.struct("central", "node", "n", "component")).alias("head"), F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most").select("key", "head")
    return marked.join(lists, "key")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels after more links."""
    return materialise(components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links.select("a", "b"))), "components")


def jaccard_join(docs: DataFrame, percent: int = 85, gram: int = 4, light: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, node (set), component (of linked sets, by a node), component_id and the columns of
    ``carry`` for docs(doc_id, text)."""
    wide, docs = docs.select("doc_id", "text", *carry), docs.select("doc_id", "text")
    if light is None:
        light = choose_boundary(docs, percent, gram)
    sizes = Sizes(percent, light)
    fits = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * percent

    def keys(batch):
        for _, data, off in texts(batch.column(1)):
            h, _, bound = sets(data, off, gram)
            n = np.diff(bound)
            yield h[ranges(bound[:-1], np.where(n >= sizes.first, n, 0))]

    bits = countmin.build(docs, keys, min(BLOCKS, countmin.blocks_for(text_bytes(docs) // 6, CELLS)), more=LEVELS)
    rows = materialise(_scan(wide, gram, sizes, bits, carry), "sets")
    del bits
    nodes = materialise(rows.where("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.min("doc_id").alias("first_doc"), F.first("lists").alias("lists"), F.first("subsets").alias("subsets"), F.first("sizes").alias("sizes")), "nodes")
    # Light: all sets with a subset in common, to the smallest.
    each = nodes.where(F.size("subsets") > 0).select("node", "n", F.explode(F.arrays_zip("subsets", "sizes")).alias("s")).select("node", "n", F.col("s.subsets").alias("key"), F.col("s.sizes").alias("c"))
    least = each.groupBy("key", "c").agg(F.min(F.struct("n", "node")).alias("to"), F.count(F.lit(1)).alias("k")).where("k > 1")
    light_links = (each.join(least, ["key", "c"]).where((F.col("node") != F.col("to.node")) & fits(F.col("n"), F.col("to.n")) & (F.ceil((F.col("n") + F.col("to.n")) * percent / (100 + percent)) <= F.col("c")))
                   .select(F.col("to.node").alias("a"), F.col("node").alias("b")).distinct())
    # Heavy: each member against the most central one of its lists, then again where lists are still mixed.
    entries = nodes.where(F.size("lists") > 0).select("node", "n", F.explode(F.array_distinct("lists")).alias("key"))
    sizes_of = entries.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    members = materialise(entries.join(sizes_of, "key"), "entries")
    central = members.groupBy("node").agg(F.sum("k").alias("central"))
    members = materialise(members.join(central, "node").select("key", "node", "n", "central"), "members")
    shingles = materialise(_shingles(docs, gram, central.select("node")), "shingles")
    linked = F.col("inter") * 100 >= F.col("total") * percent
    # Labels stand for all links so far, and lists of one component stay so: each round takes what the last one left.
    labels, mixed, known = materialise(components(light_links), "components"), members, None
    for _ in range(ROUNDS):
        mixed = materialise(_mixed(mixed, labels), "mixed")
        asked = mixed.where((F.col("component") != F.col("head.component")) & fits(F.col("n"), F.col("head.n"))).select(F.col("head.node").alias("a"), F.col("node").alias("b"), F.col("head.central").alias("central"))
        if known is not None:
            asked = asked.join(known.select("a", "b"), ["a", "b"], "left_anti")
        asked = materialise(asked.groupBy("b").agg(F.max_by("a", F.struct("central", "a")).alias("a")), "asked")
        if not asked.limit(1).count():
            break
        found = materialise(_distances(asked, shingles), "distances")
        known = found if known is None else known.unionByName(found)
        labels = _merged(labels, found.where(linked))
    else:
        mixed = materialise(_mixed(mixed, labels), "mixed")
    # Members of different components, where nothing rules a link out.
    if mixed.limit(1).count():
        pairs = _candidates(mixed.select("key", "node", "n", "component").join(shingles.select("node", "sketch"), "node"), percent).distinct()
        if known is not None:
            pairs = pairs.join(known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
        more = materialise(_distances(materialise(pairs, "pairs"), shingles).where(linked).select("a", "b"), "links")
        if more.limit(1).count():
            labels = _merged(labels, more)
    named = nodes.select("node", "first_doc").join(labels, "node", "left").select("node", "first_doc", F.coalesce("component", "node").alias("component"))
    names = named.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    # Nodes that are alone keep their own first document; the others ask their component.
    by_node = named.join(names, "component").select("node", "component", "component_id")
    return rows.select("doc_id", "node", F.col("n").cast("long").alias("n_shingles"), *carry).join(by_node, "node", "left").select("doc_id", "n_shingles", "node", *carry, "component", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op6_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")
