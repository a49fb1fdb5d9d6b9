"""Benchmark decontamination by a generalised suffix automaton of the test items.

Texts are lower-cased (A-Z) and cut into words, which are runs of letters and digits or any bytes beyond
ASCII.  A window is ``window`` consecutive words of an item, or a shorter item as a whole.  Documents are
streamed through the automaton of all items, which tracks the longest match that ends at each word; where it
reaches a window, the window's words are hit.  The words in between are skipped without a step: a match needs
every pair of neighbouring words to be a pair of some item, which is looked up for whole batches at once.

A span (maximal run of hit words) is removed if it has at least ``span_limit`` words; a document whose hit
words make up more than ``coverage_limit`` of its words is marked ``dropped`` and loses its whole text.

The automaton is built on the driver and broadcast.  It holds ``BLOCK_WORDS`` item words at most: larger
benchmarks are dealt into blocks by hash, and the documents pass through one block's automaton after another.
Null or wordless texts and items have no words and hit nothing.  Rows are treated one by one, so repeated
rows and ids each get their result; columns of documents are kept (names clashing with the added ones are
replaced).  An empty benchmark hits nothing.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from renewcast.llm.textkernel import U, cover, mix, row_bounds, texts, word_hashes, word_spans

BLOCK_WORDS = 1 << 17
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = True
ALNUM[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: The same words for Spark's SQL, over a text lower-cased by LOWER_SQL.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_words(column: str):
    return F.filter(F.split(F.translate(F.coalesce(F.col(column), F.lit("")), UPPER, SMALL), SEPARATORS), lambda w: w != "")


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self, window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, words: list[int]) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w)

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return cur

    def _clone(self, p: int, w: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        c = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = c
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = c
            p = link[p]
        return c

    def _holder(self, state: int, n: int) -> int:
        """The state of the last n words of a state's longest string."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def close(self, items: list[tuple[object, list[int]]]) -> None:
        """Mark the states at which windows end: state -> [(words, items)]."""
        self.marks: dict[int, dict[int, set]] = {}
        for item, words in items:
            n = min(self.window, len(words))
            for state, length, i in self.walk(words):
                if length >= n and i + 1 >= n and (len(words) >= self.window or i + 1 == len(words)):
                    self.marks.setdefault(self._holder(state, n), {}).setdefault(n, set()).add(item)
        # The nearest marked state on the way up, itself included.
        self.up = [-1] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.up[s] = s if s in self.marks else self.up[self.link[s]]

    def walk(self, words):
        """(state, longest match, place) after each word."""
        nxt, link, length = self.next, self.link, self.length
        s = n = 0
        for i, w in enumerate(words):
            while s and w not in nxt[s]:
                s = link[s]
                n = length[s]
            s2 = nxt[s].get(w)
            if s2 is not None:
                s, n = s2, n + 1
            yield s, n, i

    def hits(self, words):
        """(first word, words, items, longest match) of each window that ends in words."""
        for s, n, i in self.walk(words):
            m = self.up[s]
            while m > 0:
                for size, items in self.marks[m].items():
                    if size <= n:
                        yield i + 1 - size, size, items, n
                m = self.up[self.link[m]]


class Matcher:
    """An automaton with the tables by which batches are searched."""

    def __init__(self, items: list[tuple[object, str]], window: int):
        hashed = []
        for item, text in items:
            raw = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
            start, end, _ = word_spans(raw, np.array([0, len(raw)]), ALNUM)
            if len(start):
                hashed.append((item, word_hashes(raw, start, end)))
        self.words = np.unique(np.concatenate([h for _, h in hashed])) if hashed else np.zeros(0, U)
        coded = [(item, np.searchsorted(self.words, h)) for item, h in hashed]
        pairs = [c[:-1] * len(self.words) + c[1:] for _, c in coded]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        self.least = min([window, *(len(c) for _, c in coded)])
        self.automaton = Automaton(window)
        coded = [(item, c.tolist()) for item, c in coded]
        for _, c in coded:
            self.automaton.add(c)
        self.automaton.close(coded)

    def search(self, hashes: np.ndarray, row: np.ndarray):
        """(word, words, items, longest match) of all windows in the rows' words."""
        if not len(self.words) or not len(hashes):
            return
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        known = self.words[at] == hashes
        joined = np.zeros(len(hashes), bool)
        both = np.flatnonzero(known[1:] & known[:-1] & (row[1:] == row[:-1])) + 1
        if len(self.pairs) and len(both):
            code = at[both - 1] * len(self.words) + at[both]
            k = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            joined[both[self.pairs[k] == code]] = True
        begin = np.flatnonzero(known & ~joined)
        end = np.flatnonzero(known & ~np.append(joined[1:], False)) + 1
        for k in np.flatnonzero(end - begin >= self.least):
            a = int(begin[k])
            for first, n, items, longest in self.automaton.hits(at[a:end[k]].tolist()):
                yield a + first, n, items, longest


ADDED = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("longest", T.IntegerType()), T.StructField("spans", T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("n", T.IntegerType())]))), T.StructField("items", T.ArrayType(T.StringType()))])


def _blocks(benchmark: DataFrame, item_id: str, text: str, limit: int):
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.size(lower_words("text"))).alias("n")).first()["n"] or 0
    n = max(1, -(-total // limit))
    for k in range(n):
        yield k == n - 1, [(r["item"], r["text"]) for r in items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()]


def find(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs with n_words, n_hit, longest (match, in words), spans (hit words: at, n) and items (ids as strings)."""
    return _find(docs, benchmark, window, text, item_id, item_text, block_words)


def _find(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS, finish=None, more: tuple = ()) -> DataFrame:
    """finish: what makes the columns ``more`` of a batch of results, within the last pass."""
    names = ADDED.fieldNames()
    out = docs.drop(*names, *(f.name for f in more))
    kept = out.columns
    for k, (last, items) in enumerate(_blocks(benchmark, item_id, item_text, block_words)):
        out = _pass(out, Matcher(items, window), text, k > 0, finish if last else None, more if last else ())
    return out.select(*kept, *names, *(f.name for f in more))


def _pass(docs: DataFrame, matcher: Matcher, text: str, again: bool, finish, more) -> DataFrame:
    matcher = docs.sparkSession.sparkContext.broadcast(matcher)
    names = ADDED.fieldNames()
    plain = [f for f in docs.schema.fields if f.name not in names]
    at = [f.name for f in plain].index(text)
    docs = docs.select(*(f.name for f in plain), *names) if again else docs

    def run(batches):
        for batch in batches:
            for first, data, off in texts(batch.column(at)):
                data = LOWER[data]
                start, end, row = word_spans(data, off, ALNUM)
                n = len(off) - 1
                bound = row_bounds(row, n)
                begin, size, items, longest = [], [], {}, {}
                for a, k, found, length in matcher.value.search(word_hashes(data, start, end), row):
                    r = int(row[a])
                    begin.append(a)
                    size.append(k)
                    items.setdefault(r, set()).update(found)
                    longest[r] = max(longest.get(r, 0), length)
                rows = batch.slice(first, n)
                if again:
                    for r, (spans, before, long) in enumerate(zip(*(rows.column(len(plain) + k).to_pylist() for k in (3, 4, 2)))):
                        if spans:
                            begin += [int(bound[r]) + s["at"] for s in spans]
                            size += [s["n"] for s in spans]
                            items.setdefault(r, set()).update(before)
                            longest[r] = max(longest.get(r, 0), long)
                hit = cover(len(row), np.array(begin, np.int64), np.array(begin, np.int64) + np.array(size, np.int64))
                counts = np.add.reduceat(np.append(hit, False).astype(np.int64), np.minimum(bound[:-1], len(hit))) * (np.diff(bound) > 0)
                head = hit.copy()
                head[1:] &= ~hit[:-1] | (row[1:] != row[:-1])
                tail = hit.copy()
                tail[:-1] &= ~hit[1:] | (row[1:] != row[:-1])
                head, tail = np.flatnonzero(head), np.flatnonzero(tail)
                edge = np.searchsorted(row[head], np.arange(n + 1)) if len(head) else np.zeros(n + 1, np.int64)
                spans = pa.StructArray.from_arrays([pa.array((head - bound[row[head]]).astype(np.int32)), pa.array((tail - head + 1).astype(np.int32))], names=["at", "n"])
                result = pa.record_batch([
                    *rows.columns[:len(plain)], pa.array(np.diff(bound)), pa.array(counts), pa.array([longest.get(r, 0) for r in range(n)], pa.int32()),
                    pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), spans), pa.array([sorted(items.get(r, ())) for r in range(n)], pa.list_(pa.string())),
                ], names=[*(f.name for f in plain), *names])
                yield pa.record_batch([*result.columns, *finish(result)], names=[*result.schema.names, *(f.name for f in more)]) if finish else result

    return docs.mapInArrow(run, T.StructType([*plain, *ADDED.fields, *more]))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, span_limit: int = 1, coverage_limit: float = 0.5, text: str = "text", **how) -> DataFrame:
    """The documents with the result columns of ``find``, ``clean`` (the text without the removed spans) and ``dropped``."""
    more = (T.StructField("clean", T.StringType()), T.StructField("dropped", T.BooleanType()))

    def cut(batch):
        column, dropped = [], []
        for t, s, n, k in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (text, "spans", "n_words", "n_hit"))):
            drop = bool(n and k > coverage_limit * n)
            s = [x for x in s if x["n"] >= span_limit]
            if drop:
                t = ""
            elif s:
                raw = t.encode()
                start, end, _ = word_spans(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), ALNUM)
                parts, last = [], 0
                for x in s:
                    parts.append(raw[last:start[x["at"]]])
                    last = int(end[x["at"] + x["n"] - 1])
                t = b"".join([*parts, raw[last:]]).decode()
            column.append(t)
            dropped.append(drop)
        return pa.array(column, pa.string()), pa.array(dropped, pa.bool_())

    return _find(docs, benchmark, window, text, finish=cut, more=more, **how)


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", F.sort_array("items")), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
