"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Examples are labelled documents, rows of equal text being one example with all their labels.  Terms are words
(runs of letters, digits or bytes beyond ASCII; A-Z lower-cased), known by 64-bit hashes.  A term weighs
(1 + log count) * idf * z in a text: idf counts all documents, and z, the root of the log-likelihood ratio of
the term's presence and the label among the examples, says how much the term is about the label.  No term of
the examples is left out; one that no example has can add to no product and has no known z, so it weighs 0.

The index has a posting list for each term: (example, weight) in blocks of ``BLOCK`` examples, and for each
block the largest weight in it.  A text's bound for a block is the sum of its terms' weights times these
largest weights.  The ``FIRST`` blocks with the greatest bounds are scored from their postings, then all
blocks whose bound reaches the k-th best similarity so far; no other block can hold one of the k nearest, so
the result is exact.  Texts go through this some at a time.  An example of the very same text has no vote.

Votes weigh 1 / (distance + ``SOFT``), times how many labelled rows an example of its label stands for, with
the share of the label as a prior of weight ``PRIOR``.  Raw votes become scores by a monotone fit (pool
adjacent violators) on the examples, which are answered by Spark as all texts are.  Texts without a known term
get the fitted share of examples like them.  Evidence is the nearest examples, their labels and similarities.

Bounds (parameters): at most ``sample`` / 2 labelled rows of each label, chosen by hash, and at most ``size``
bytes of their texts make the examples; the index is bounded by these, is put together on the driver and
broadcast.  All else covers every document and whole texts.  Null and empty texts have no terms.  Repeated rows
are scored row by row; labels that are repeated or contradict each other count one by one; null labels count
for nothing.  Ties of similarity go to the example earlier in the index.  Without usable examples of both kinds
every score is the share of the label, 0 if there is none.  Other columns of the documents are kept, but those
with the result's names are replaced; an empty table gives no rows.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from renewcast.llm.decontaminate import ALNUM, LOWER
from renewcast.llm.shared import materialise
from renewcast.llm.textkernel import U, ranges, row_bounds, texts, word_hashes, word_spans

SAMPLE, SIZE, K = 4096, 64 << 20, 15
BLOCK, FIRST, SOFT, PRIOR = 64, 6, 0.1, 1.0
#: Postings that texts answered together may ask for.
STEP = 1 << 20
#: Lists of more than an eighth of the examples are rows; those of more than a thirty-second as long as rows are no more
#: than so many, and bytes.
ROWS, ROW_BYTES = 1 << 11, 1 << 24
_SPLIT = 1 << 12


def terms_of(data: np.ndarray, off: np.ndarray):
    """(row, term, count) of a step's texts, ordered by row and term."""
    data = LOWER[data]
    start, end, row = word_spans(data, off, ALNUM)
    h = word_hashes(data, start, end)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))) if len(h) else np.zeros(0, np.int64)
    return row[new], h[new], np.diff(np.append(new, len(h)))


def digest(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def association(a: np.ndarray, b: np.ndarray, pos: int, neg: int) -> np.ndarray:
    """Root of the log-likelihood ratio of presence (a of pos, b of neg) and label."""
    n, out = pos + neg, np.zeros(len(a))
    for o, r, c in ((a, a + b, pos), (b, a + b, neg), (pos - a, n - a - b, pos), (neg - b, n - a - b, neg)):
        some = o > 0
        out[some] += o[some] * np.log(o[some] * n / (r[some] * c))
    return np.sqrt(np.maximum(2 * out, 0))


class Index:
    """Terms with their factors, posting lists in blocks with largest weights, and the examples' labels."""

    def __init__(self, hashes: np.ndarray, factor: np.ndarray, examples: list[tuple], weight: tuple[float, float] = (1.0, 1.0)):
        """hashes: the terms, sorted; factor: idf * z of each; examples: (id, digest, rows labelled 0, rows labelled 1,
        terms' places, counts); weight: how many labelled rows one of label 0 or 1 stands for."""
        self.hashes, self.factor = hashes, factor.astype(np.float32)
        known, self.bare = [], []
        for e in examples:
            w = (1 + np.log(e[5])) * factor[e[4]] if len(e[4]) else np.zeros(0)
            norm = np.sqrt((w * w).sum())
            known.append((e, w / norm)) if norm > 0 else self.bare.append(e)
        # Examples that share their heaviest term stand in neighbouring blocks.
        known.sort(key=lambda x: (int(x[0][4][np.argmax(x[1])]), x[0][0]))
        self.n = len(known)
        self.ids = np.array([e[0] for e, _ in known], np.int64)
        self.no, self.yes = (np.array([e[2 + y] * weight[y] for e, _ in known], float) for y in (0, 1))
        self.place: dict[bytes, int] = {e[1]: j for j, (e, _) in enumerate(known)}
        self.blocks = max(1, -(-self.n // BLOCK))
        term = np.concatenate([e[4] for e, _ in known]) if known else np.zeros(0, np.int64)
        who = np.repeat(np.arange(self.n), [len(w) for _, w in known])
        w = np.concatenate([w for _, w in known]) if known else np.zeros(0)
        order = np.lexsort((who, term))
        term, self.who, self.weight = term[order], who[order].astype(np.int32), w[order].astype(np.float32)
        code = term * self.blocks + self.who // BLOCK
        first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
        self.post = np.append(first, len(code))
        self.block = (code[first] % self.blocks).astype(np.int32)
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0, np.float32)
        self.list = np.searchsorted(term[first], np.arange(len(hashes) + 1))
        # Long lists as rows of weights, and of largest weights by block: nothing of them is walked.
        length = np.bincount(term, minlength=len(hashes))
        most = max(np.count_nonzero(length > self.n / 8), min(ROWS, ROW_BYTES // (4 * self.blocks * BLOCK)))
        long = np.argsort(-length, kind="stable")[:most]
        long = np.sort(long[length[long] > self.n / 32])
        self.row = np.full(len(hashes), -1, np.int32)
        self.row[long] = np.arange(len(long))
        self.rows, self.tops = np.zeros((len(long), self.blocks * BLOCK), np.float32), np.zeros((len(long), self.blocks), np.float32)
        own, head = self.row[term] >= 0, self.row[term[first]]
        self.rows[self.row[term[own]], self.who[own]] = self.weight[own]
        self.tops[head[head >= 0], self.block[head >= 0]] = self.most[head >= 0]
        self.size = np.diff(self.post).astype(np.int32)
        self.count = np.where(self.row >= 0, 0, np.diff(self.list))
        self.work = np.where(self.row >= 0, 0, length) + self.count
        total = [sum(e[2 + y] * weight[y] for e in examples) for y in (0, 1)]
        self.share = total[1] / sum(total) if sum(total) else 0.0
        self.x, self.y, self.plain = np.array([0.0, 1.0]), np.array([0.0, 1.0]), self.share
        if sum(total):
            self.plain = (sum(e[3] * weight[1] for e in self.bare) + self.share) / (sum(e[2] * weight[0] + e[3] * weight[1] for e in self.bare) + 1)

    def vectors(self, data, off):
        """(row, term, weight) of a step's texts, unit length by row."""
        row, h, count = terms_of(data, off)
        z = np.zeros(0, np.int64)
        if not len(row) or not len(self.hashes):
            return z, z, np.zeros(0, np.float32)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        ok = (self.hashes[at] == h) & (self.factor[at] > 0)
        row, at = row[ok], at[ok]
        w = (1 + np.log(count[ok])) * self.factor[at]
        norm = np.sqrt(np.bincount(row, w * w, len(off)))
        return row, at, (w / norm[row]).astype(np.float32)

    def nearest(self, row, term, weight, k: int, skip=None):
        """Of each row that occurs: (rows, examples (-1: none), similarities), by falling similarity, ties by place.
        skip: by row, an example that doesn't count (-1: none)."""
        rows, first = np.unique(row, return_index=True)
        ends = np.append(first, len(row))
        work = np.append(0, np.cumsum(self.work[term]))[ends]
        edge, who, best = 0, [np.zeros((0, k), np.int64)], [np.zeros((0, k))]
        while edge < len(rows):
            stop = min(len(rows), edge + 256, max(edge + 1, int(np.searchsorted(work, work[edge] + STEP, "right")) - 1))
            part = slice(ends[edge], ends[stop])
            of = np.repeat(np.arange(stop - edge), np.diff(ends[edge:stop + 1]))
            found = self._nearest(stop - edge, of, term[part], weight[part], k, np.full(stop - edge, -1) if skip is None else skip[rows[edge:stop]])
            who.append(found[0])
            best.append(found[1])
            edge = stop
        return rows, np.concatenate(who), np.concatenate(best)

    def _nearest(self, m, of, term, weight, k: int, skip):
        width = self.blocks * BLOCK
        count = self.count[term]
        entry = ranges(self.list[term], count)
        ask = np.zeros((m, len(self.rows)), np.float32)
        long = self.row[term] >= 0
        ask[of[long], self.row[term[long]]] = weight[long]
        of, weight, block = np.repeat(of, count), np.repeat(weight, count), self.block[entry]
        bound = np.bincount(of * self.blocks + block, weight * self.most[entry], m * self.blocks).reshape(m, self.blocks) + ask @ self.tops
        # Where a block isn't visited, this stays below its bound, up to the last digits of both.
        similar = (ask @ self.rows).astype(float).ravel()
        visit = np.zeros((m, self.blocks), bool)
        if self.blocks > FIRST:
            np.put_along_axis(visit, np.argpartition(-bound, FIRST, axis=1)[:, :FIRST], True, axis=1)
        else:
            visit[:] = True
        seen = np.zeros_like(visit)
        while True:
            at = np.flatnonzero(visit[of, block])
            size = self.size[entry[at]]
            p = ranges(self.post[entry[at]], size)
            similar += np.bincount(np.repeat(of[at], size) * width + self.who[p], np.repeat(weight[at], size) * self.weight[p], m * width)
            seen |= visit
            own = np.flatnonzero(skip >= 0)
            similar[own * width + skip[own]] = 0
            table = similar.reshape(m, width)
            least = np.partition(table, width - k, axis=1)[:, width - k] if width > k else np.zeros(m)
            visit = ~seen & (bound > 0) & (bound * (1 + 1e-4) >= least[:, None])
            if not visit.any():
                break
        some = np.argpartition(-table, k, axis=1)[:, :k] if width > k else np.tile(np.arange(width), (m, 1))
        # Of examples as similar as the k-th, those earlier in the index.
        least = np.take_along_axis(table, some, 1).min(axis=1)
        tied = np.flatnonzero((least > 0) & ((table == least[:, None]).sum(axis=1) > (np.take_along_axis(table, some, 1) == least[:, None]).sum(axis=1)))
        for i in tied:
            some[i] = np.lexsort((np.arange(width), -table[i]))[:k]
        value = np.take_along_axis(table, some, 1)
        order = np.lexsort((some, -value), axis=1)
        who, best = np.full((m, k), -1), np.zeros((m, k))
        n = some.shape[1]
        who[:, :n], best[:, :n] = np.take_along_axis(some, order, 1), np.take_along_axis(value, order, 1)
        who[best <= 0] = -1
        return who, best

    def votes(self, who, similarity):
        w = np.where(who >= 0, 1 / (1 - np.minimum(similarity, 1) + SOFT), 0)
        yes, no = (w * self.yes[who]).sum(axis=1), (w * self.no[who]).sum(axis=1)
        unit = (self.yes.sum() + self.no.sum()) / max(1, self.n)
        return (yes + PRIOR * unit * self.share) / (yes + no + PRIOR * unit)

    def answer(self, data, off, k: int):
        """(rows with a known term, their nearest examples, similarities, raw votes) of a step's texts."""
        if not self.n:
            return np.zeros(0, np.int64), np.zeros((0, k), np.int64), np.zeros((0, k)), np.zeros(0)
        raw = data.tobytes()
        same = np.array([self.place.get(digest(raw[a:b]), -1) for a, b in zip(off[:-1].tolist(), off[1:].tolist())], np.int64)
        rows, who, best = self.nearest(*self.vectors(data, off), k, same)
        some = (who >= 0).any(axis=1)
        rows, who, best = rows[some], who[some], best[some]
        return rows, who, best, self.votes(who, best)

    def calibrate(self, raw: np.ndarray, no: np.ndarray, yes: np.ndarray) -> None:
        """Fit scores to the labels of the examples, each answered by the others: raw votes, weights of both labels."""
        order = np.argsort(raw, kind="stable")
        pools: list[list[float]] = []
        for x, y, w in zip(raw[order].tolist(), yes[order].tolist(), (no + yes)[order].tolist()):
            pools.append([y, w, x, x])
            while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
                a = pools.pop()
                pools[-1] = [pools[-1][0] + a[0], pools[-1][1] + a[1], pools[-1][2], a[3]]
        if pools:
            # Shares are drawn a little to the prior, so that no score is entirely sure.
            self.x = np.array([v for p in pools for v in (p[2], p[3])])
            self.y = np.maximum.accumulate([(p[0] + self.share) / (p[1] + 1) for p in pools for _ in range(2)])

    def score(self, raw):
        return np.clip(np.interp(raw, self.x, self.y), 0, 1)


def _examples(docs: DataFrame, labels: DataFrame, sample: int, size: int) -> DataFrame:
    """(doc_id, no, yes, text) of the chosen labelled documents, equal texts in one row."""
    usable = labels.where("label IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", F.col("label").cast("int").alias("label"), F.xxhash64("doc_id").alias("turn"))
    chosen = [usable.where(F.col("label") == y).orderBy("turn", "doc_id").limit(sample // 2) for y in (0, 1)]
    ids = F.broadcast(materialise(chosen[0].unionByName(chosen[1]), "labels"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(ids, "doc_id").groupBy("text").agg(
        F.min("turn").alias("turn"), F.min("doc_id").alias("doc_id"), F.sum(1 - F.col("label")).alias("no"), F.sum("label").alias("yes"))
    before = F.coalesce(F.sum(F.octet_length("text")).over(Window.orderBy("turn", "doc_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return materialise(rows.withColumn("before", before).where(F.col("before") < size).select("doc_id", "no", "yes", "text"), "examples")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, k: int = K, size: int = SIZE) -> Index:
    """labels(doc_id, label): what to learn from; docs(doc_id, text): all documents."""
    examples = _examples(docs, labels, sample, size)

    def features(batches):
        for batch in batches:
            for first, data, off in texts(batch.column(3)):
                row, term, count = terms_of(data, off)
                edge, n, raw, o = pa.array(row_bounds(row, len(off) - 1).astype(np.int32)), len(off) - 1, data.tobytes(), off.tolist()
                yield pa.record_batch([*batch.slice(first, n).columns[:3], pa.array([digest(raw[a:b]) for a, b in zip(o[:-1], o[1:])], pa.binary()),
                                       pa.ListArray.from_arrays(edge, pa.array(term.view(np.int64))), pa.ListArray.from_arrays(edge, pa.array(count.astype(np.int32)))],
                                      names=["doc_id", "no", "yes", "digest", "terms", "counts"])

    found = examples.mapInArrow(features, "doc_id long, no long, yes long, digest binary, terms array<long>, counts array<int>").toArrow().combine_chunks()
    ids, no, yes = (found[c].to_pylist() for c in ("doc_id", "no", "yes"))
    lists = found["terms"].combine_chunks() if len(ids) else pa.array([], pa.list_(pa.int64()))
    sizes = np.diff(lists.offsets.to_numpy()) if len(ids) else np.zeros(0, np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).view(U)
    hashes, place = np.unique(flat, return_inverse=True)
    pos, neg = sum(yes), sum(no)
    a, b = (np.bincount(place, np.repeat(np.array(y, float), sizes), len(hashes)) for y in (yes, no))
    df, n = _frequencies(docs, hashes)
    factor = (np.log((n + 1) / (df + 1)) + 1) * (association(a, b, pos, neg) if pos and neg else np.zeros(len(hashes)))
    total = {r["label"]: r["count"] for r in labels.where("label IN (0, 1) AND doc_id IS NOT NULL").groupBy("label").count().collect()}
    weight = (total.get(0, 0) / max(1, neg), total.get(1, 0) / max(1, pos))
    edge, counts = np.append(0, np.cumsum(sizes)), (found["counts"].combine_chunks().flatten().to_numpy(zero_copy_only=False) if len(ids) else flat)
    digests = found["digest"].to_pylist()
    index = Index(hashes, factor, [(ids[j], digests[j], no[j], yes[j], place[edge[j]:edge[j + 1]], counts[edge[j]:edge[j + 1]]) for j in range(len(ids))], weight)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def others(batches):
        index = shared.value
        for batch in batches:
            no, yes = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2))
            for first, data, off in texts(batch.column(3)):
                rows, _, _, raw = index.answer(data, off, k)
                yield pa.record_batch([pa.array(raw), pa.array(no[first + rows] * weight[0]), pa.array(yes[first + rows] * weight[1])], names=["raw", "no", "yes"])

    if index.n:
        voted = examples.repartition(max(1, examples.sparkSession.sparkContext.defaultParallelism)).mapInArrow(others, "raw double, no double, yes double").toArrow()
        index.calibrate(*(voted[c].to_numpy() for c in ("raw", "no", "yes")))
    return index


def _frequencies(docs: DataFrame, hashes: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs, and their number: counts of each task, added up by pieces."""
    if not len(hashes):
        return np.zeros(0), 0
    shared = docs.sparkSession.sparkContext.broadcast(hashes)

    def count(batches):
        hashes = shared.value
        total = np.zeros(len(hashes) + 1, np.int64)
        for batch in batches:
            total[-1] += batch.num_rows
            for _, data, off in texts(batch.column(0)):
                h = terms_of(data, off)[1]
                at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                total += np.bincount(at[hashes[at] == h], minlength=len(total))
        pieces = range(0, len(total), _SPLIT)
        yield pa.record_batch([pa.array([i // _SPLIT for i in pieces], pa.int32()), pa.array([total[i:i + _SPLIT].tobytes() for i in pieces], pa.binary())], names=["piece", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in table["counts"].to_pylist())
        return pa.table({"piece": table["piece"].slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    merged = docs.select("text").mapInArrow(count, "piece int, counts binary").groupBy("piece").applyInArrow(add, "piece int, counts binary").collect()
    if not merged:
        return np.zeros(len(hashes)), 0
    total = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in sorted(merged, key=lambda r: r["piece"])])
    return total[:-1].astype(float), int(total[-1])


ADDED = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("evidence", T.ArrayType(T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("label", T.IntegerType()), T.StructField("similarity", T.FloatType())])))])


def score(docs: DataFrame, index: Index, text: str = "text", k: int = K) -> DataFrame:
    """docs with score (0 to 1) and evidence (the nearest examples; an example's label is that of most of its rows)."""
    docs = docs.drop(*ADDED.fieldNames())
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        index = shared.value
        label = (index.yes >= index.no).astype(np.int32)
        for batch in batches:
            for first, data, off in texts(batch.column(at)):
                n = len(off) - 1
                out, counts = np.full(n, index.plain), np.zeros(n, np.int64)
                rows, who, best, raw = index.answer(data, off, k)
                out[rows] = index.score(raw)
                counts[rows] = (who >= 0).sum(axis=1)
                flat = who[who >= 0]
                evidence = pa.StructArray.from_arrays([pa.array(index.ids[flat], pa.int64()), pa.array(label[flat]), pa.array(best[who >= 0].astype(np.float32))], names=["doc_id", "label", "similarity"])
                yield pa.record_batch([*batch.slice(first, n).columns, pa.array(out), pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), evidence)], names=[*batch.schema.names, *ADDED.fieldNames()])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *ADDED.fields]))


def held_out(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0


def learn(spark, docs: DataFrame, sf_dir: str) -> Index:
    """From the labelled rows that aren't held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return fit(docs, labels.where(~held_out()).select("doc_id", F.col("toxic").alias("label")))


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score(docs, learn(spark, docs, sf_dir))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
