"""Hard-negative mining by two trees: one over anchors, one over all rows.

Vectors become whole numbers, so scores (inner products) are exact.  Rows are ordered by label and by a code of
hyperplane sides (thresholds from a bounded sample), so that neighbours in the order are alike, and are cut into leaves
of at most ``LEAF`` rows, anchors into leaves of ``ANCHORS``.  ``FAN`` neighbouring nodes make one node above them.  A
node has a centre, a radius and a largest length, and its rows' labels; two nodes' inner products then lie in

    centre . centre -/+ (|a| rc + |c| ra + ra rc), and within -/+ the product of the largest lengths.

Both trees are walked together from their tops, a level a join: each pair of nodes is unfolded into its children's
pairs, and a pair is dropped, with all its anchors at once, when its interval or its labels leave nothing to find:

- positives (same label): the best ``BEAM`` leaves of each anchor leaf are scored first; a pair stays only if it can
  reach the least score that its anchors' last positives have by then;
- negatives (another label): a pair stays only if its interval meets the window from ``low`` percent of the anchors'
  smallest to ``high`` percent of their largest positive score, whose lower end is raised likewise by what the nearest
  leaves hold.

Leaf pairs that stay are scored exactly, row by row.  Of rows with equal vectors and labels only the smallest ids can
ever be returned, so more of them than are asked for (and the anchor itself) go no further than the task they are in;
they still are anchors, each of them.

Rows with a null id, label or vector, or a null or non-finite component (also once scaled) take no part.  Vectors of
each length are a table of their own, as others have no inner product with them.  Ties go to the smaller id; repeated
rows are rows of their own: one is the other's best positive.  Other columns are ignored whatever their names; an empty
table gives no rows.  Scores beyond 64 bits count as the nearest 64-bit number.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renewcast.llm.shared import materialise

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 5, 80, 100
LEAF, ANCHORS, FAN, BEAM, SAMPLE, LEAST_SAMPLE, DEEPEST = 512, 64, 16, 4, 1 << 15, 32, 30
#: Whole numbers up to here are exact in double precision, whatever their order of addition.
EXACT = float(1 << 53)
SLACK = 1e-6
#: Pairs of nodes and of leaves a task.
NODE_PAIRS, LEAF_PAIRS = 1024, 128
LONG = (1 << 63) - 1


def usable(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v array<double> of whole numbers) of the rows that take part, labels changed where 7 divides the id."""
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    v = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.lit(float(scale)) * x)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v")).where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    # floor() of a double is a long; beyond 2**53 every double is whole.
    whole = F.transform("v", lambda x: F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x))
    return rows.select("vec_id", label.alias("label"), whole.alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def products(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products: by floating point while no sum can be rounded, else by Python's numbers; those beyond 64
    bits as the nearest 64-bit number."""
    if not a.size or not c.size:
        return np.zeros((len(a), len(c)))
    if float(np.abs(a).max()) * float(np.abs(c).max()) * a.shape[1] < EXACT:
        return a @ c.T
    whole = lambda x: np.array([[int(y) for y in r] for r in x], object)
    exact = whole(a) @ whole(c).T
    return np.array([[max(-LONG - 1, min(LONG, x)) for x in r] for r in exact], object).reshape(exact.shape)


class Code:
    """Sides of hyperplanes, deepest thresholds first by the sample's medians below each node, then by level."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.planes = rng.standard_normal((depth, sample.shape[1]))
        self.cuts: list[np.ndarray] = []
        at = np.zeros(len(sample), np.int64)
        for plane in self.planes:
            x = sample @ plane
            cuts = np.full(int(at.max(initial=0)) + 1, np.median(x) if len(x) else 0.0)
            if len(cuts) * LEAST_SAMPLE <= len(sample):
                for k in range(len(cuts)):
                    if (at == k).any():
                        cuts[k] = np.median(x[at == k])
                at = at * 2 + (x > cuts[at])
            else:
                cuts = cuts[:1]
            self.cuts.append(cuts)

    def of(self, v: np.ndarray) -> np.ndarray:
        out, node = np.zeros(len(v), np.int64), np.zeros(len(v), np.int64)
        for plane, cuts in zip(self.planes, self.cuts):
            side = v @ plane > cuts[np.minimum(node, len(cuts) - 1)]
            node = node * 2 + side
            out = out * 2 + side
        return out


def ball(v: np.ndarray, weight: np.ndarray | None = None, radius: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    weight = np.ones(len(v)) if weight is None else weight
    centre = (v * weight[:, None]).sum(axis=0) / weight.sum()
    away = np.sqrt(((v - centre) ** 2).sum(axis=1)) + (0 if radius is None else radius)
    return centre, float(away.max(initial=0.0)) * (1 + SLACK)


def _packed(v: np.ndarray) -> bytes:
    """Two bytes a number where they fit, else eight; the first byte tells which."""
    short = np.abs(v).max(initial=0) < 1 << 15
    return (b"s" + v.astype("<i2").tobytes()) if short else (b"l" + v.astype("<f8").tobytes())


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw[1:], "<i2" if raw[:1] == b"s" else "<f8").reshape(n, -1).astype(float)


_LEAF = "ids binary, rows binary, labels binary, v binary, n long, centre binary, radius double, norm double, low_label long, high_label long"
_STATS = ("centre", "radius", "norm", "low_label", "high_label")


def _leaves(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """Leaves (node, and what is in them) of rows(vec_id, row, label, code, v), in the order of label and code; and
    their number."""

    def cut(batches):
        held = None
        def leaf(t):
            v = _matrix(t["v"].combine_chunks() if isinstance(t["v"], pa.ChunkedArray) else t["v"])
            ids, row, labels = (t[c].to_numpy() for c in ("vec_id", "row", "label"))
            order = np.lexsort((row, ids))
            v, ids, row, labels = v[order], ids[order], row[order], labels[order]
            centre, radius = ball(v)
            norm = float(np.sqrt((v ** 2).sum(axis=1)).max(initial=0.0)) * (1 + SLACK)
            return pa.record_batch([pa.array([x]) for x in (ids.astype("<i8").tobytes(), row.astype("<i8").tobytes(), labels.astype("<i8").tobytes(), _packed(v), len(ids), centre.astype("<f8").tobytes(), radius, norm, int(labels.min()), int(labels.max()))],
                                   names=["ids", "rows", "labels", "v", "n", *_STATS])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            while held.num_rows >= size:
                yield leaf(held.slice(0, size))
                held = held.slice(size)
        if held is not None and held.num_rows:
            yield leaf(held)

    order = ["label", "code", "vec_id", "row"]
    parts = max(8, rows.sparkSession.sparkContext.defaultParallelism)
    cut_up = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("vec_id", "row", "label", "v").mapInArrow(cut, _LEAF)
    found = materialise(cut_up.withColumn("at", F.monotonically_increasing_id()), name)
    # A leaf's number is its place: those of the partitions before (as many as the writing job had), and within its own.
    part = F.shiftright("at", 33)
    before, counts = 0, {}
    for r in sorted(found.groupBy(part.alias("p")).count().collect()):
        counts[r["p"]] = before
        before += r["count"]
    if not before:
        return found.withColumn("node", F.lit(0).cast("long")).drop("at"), 0
    first = F.create_map(*[F.lit(x).cast("long") for pair in counts.items() for x in pair])
    return found.withColumn("node", F.element_at(first, part) + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("at"), before


class Tree:
    """levels[k]: rows of (node, kids: first child, and the children's statistics); level 0's child is the leaf itself.
    ``tops`` is the number of nodes of the top level."""

    def __init__(self, leaves: DataFrame, count: int, name: str):
        extra = [c for c in ("least", "window_low", "window_high") if c in leaves.columns]
        self.leaves, self.levels, self.tops = leaves, [], count
        nodes = leaves.select("node", "n", *_STATS, *extra)
        self.levels.append(self._packed(nodes.withColumn("parent", F.col("node")), extra)[0])
        while self.tops > FAN:
            level, nodes = self._packed(nodes.withColumn("parent", F.floor(F.col("node") / FAN)), extra)
            nodes = materialise(nodes, f"{name}-level")
            self.levels.append(materialise(level, f"{name}-kids"))
            self.tops = -(-self.tops // FAN)

    @staticmethod
    def _packed(nodes: DataFrame, extra: list[str]) -> tuple[DataFrame, DataFrame]:
        """(node, its children's statistics side by side), and the nodes' own statistics.  A node has at most FAN
        children, so that this is never more than so many rows a group."""
        one = F.struct("node", "n", *_STATS, *extra)
        kids = nodes.groupBy(F.col("parent").alias("node")).agg(F.sort_array(F.collect_list(one)).alias("kids"))

        def join(batches):
            for batch in batches:
                out = []
                for kid in batch.column(1).to_pylist():
                    c = np.stack([np.frombuffer(k["centre"], "<f8") for k in kid])
                    centre, radius = ball(c, np.array([k["n"] for k in kid], float), np.array([k["radius"] for k in kid]))
                    out.append((sum(k["n"] for k in kid), centre.astype("<f8").tobytes(), radius, max(k["norm"] for k in kid), min(k["low_label"] for k in kid), max(k["high_label"] for k in kid),
                                *((max if e == "window_high" else min)(k[e] for k in kid) for e in extra)))
                cols = list(zip(*out))
                yield pa.record_batch([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.binary(), pa.float64(), pa.float64(), pa.int64(), pa.int64()] + [pa.float64()] * len(extra)))], names=["node", "n", *_STATS, *extra])

        own = kids.mapInArrow(join, "node long, n long, centre binary, radius double, norm double, low_label long, high_label long" + "".join(f", {e} double" for e in extra))
        return kids, own


def _unfold(pairs: DataFrame, anchors: DataFrame, rows: DataFrame, same: bool, bounded: bool) -> DataFrame:
    """The children's pairs (a, c, middle) that stay, of pairs(a, c) of nodes of these levels."""
    both = pairs.join(anchors.select(F.col("node").alias("a"), F.col("kids").alias("ka")), "a").join(rows.select(F.col("node").alias("c"), F.col("kids").alias("kc")), "c")
    both = both.select("ka", "kc").repartition(pairs.count() // NODE_PAIRS + 1)

    def columns(kid):
        value = lambda c: np.array([k[c] for k in kid], float)
        centre = np.stack([np.frombuffer(k["centre"], "<f8") for k in kid])
        return np.array([k["node"] for k in kid]), centre, np.sqrt((centre ** 2).sum(axis=1)), value("radius"), value("norm"), np.array([k["low_label"] for k in kid]), np.array([k["high_label"] for k in kid])

    def meet(batches):
        for batch in batches:
            for ka, kc in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, ca, na, ra, la, a0, a1 = columns(ka)
                c, cc, nc, rc, lc, c0, c1 = columns(kc)
                middle = ca @ cc.T
                wide = (na[:, None] * rc + nc * ra[:, None] + ra[:, None] * rc) * (1 + SLACK) + SLACK
                most = la[:, None] * lc
                high, low = (np.clip(x, -float(LONG), float(LONG)) for x in (np.minimum(middle + wide, most), np.maximum(middle - wide, -most)))
                if same:
                    keep = (a0[:, None] <= c1) & (c0 <= a1[:, None])
                    if bounded:
                        keep &= high >= np.array([k["least"] for k in ka])[:, None] - SLACK
                else:
                    keep = ~((a0 == a1)[:, None] & (c0 == c1) & (a0[:, None] == c0))
                    keep &= (high >= np.array([k["window_low"] for k in ka])[:, None] - SLACK) & (low <= np.array([k["window_high"] for k in ka])[:, None] + SLACK)
                i, j = np.nonzero(keep)
                if len(i):
                    yield pa.record_batch([pa.array(a[i]), pa.array(c[j]), pa.array(middle[i, j])], names=["a", "c", "middle"])

    return both.mapInArrow(meet, "a long, c long, middle double")


def walk(anchors: Tree, rows: Tree, same: bool, beam: int | None = None) -> DataFrame:
    """Pairs (a, c) of leaves that may hold something, or with ``beam`` the so many nearest leaves of each anchor leaf."""
    spark = anchors.leaves.sparkSession
    i, j = len(anchors.levels) - 1, len(rows.levels) - 1
    if beam:
        # Each anchor leaf by itself.
        tops = anchors.leaves.select(F.col("node").alias("a"))
        i = 0
    else:
        tops = spark.range(anchors.tops).select(F.col("id").alias("a"))
    pairs = tops.withColumn("c", F.explode(F.expr(f"sequence(0L, {rows.tops - 1}L)")))
    while True:
        pairs = _unfold(pairs.select("a", "c"), anchors.levels[i], rows.levels[j], same, not beam)
        if beam:
            w = Window.partitionBy("a").orderBy(F.desc("middle"), "c")
            pairs = pairs.withColumn("place", F.row_number().over(w)).where(F.col("place") <= beam)
        pairs = materialise(pairs.select("a", "c"), "pairs")
        if not i and not j:
            return pairs
        i, j = max(0, i - 1), max(0, j - 1)


_BLOB = ("ids", "rows", "labels", "v")


def _both(pairs: DataFrame, anchors: DataFrame, rows: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    a = anchors.select(F.col("node").alias("a"), *(F.col(c).alias(f"a_{c}") for c in _BLOB), *more)
    c = rows.select(F.col("node").alias("c"), *(F.col(x).alias(f"c_{x}") for x in _BLOB))
    # Dealt evenly, so that no task has more than so many leaves at once, even if all anchors meet one leaf.
    return pairs.join(a, "a").join(c, "c").select(*(f"a_{x}" for x in _BLOB), *(f"c_{x}" for x in _BLOB), *more).repartition(pairs.count() // LEAF_PAIRS + 1)


def _open(batch, i: int, side: str):
    get = lambda c: batch.column(batch.schema.get_field_index(f"{side}_{c}"))[i].as_py()
    ids, row, labels = (np.frombuffer(get(c), "<i8") for c in ("ids", "rows", "labels"))
    return ids, row, labels, _unpacked(get("v"), len(ids))


def _first(score: np.ndarray, ok: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's k largest that are ok; the columns stand in the order of ids."""
    value = np.where(ok, score, -np.inf) if score.dtype != object else np.array([[float(x) if o else -np.inf for x, o in zip(r, q)] for r, q in zip(score, ok)])
    if score.dtype == object:
        order = np.array([sorted(range(len(r)), key=lambda j, r=r, q=q: (not q[j], -r[j], j))[:k] for r, q in zip(score, ok)], np.int64).reshape(len(score), -1)
    else:
        order = np.argsort(-value, axis=1, kind="stable")[:, :k]
    good = np.take_along_axis(ok, order, 1)
    at = np.nonzero(good)
    return at[0], order[at]


def _whole(x) -> pa.Array:
    return pa.array(x.astype(np.int64) if x.dtype != object else x.tolist(), pa.int64())


def _positives(pairs: DataFrame, anchors: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(row, anchor_id, positive_id, positive_row, score): the first k of each anchor."""

    def score(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                a_id, a_row, a_label, a = _open(batch, i, "a")
                c_id, c_row, c_label, c = _open(batch, i, "c")
                s = products(a, c)
                x, y = _first(s, (a_label[:, None] == c_label) & (a_row[:, None] != c_row), k)
                if len(x):
                    yield pa.record_batch([pa.array(a_row[x]), pa.array(a_id[x]), pa.array(c_id[y]), pa.array(c_row[y]), _whole(s[x, y])], names=["row", "anchor_id", "positive_id", "positive_row", "score"])

    w = Window.partitionBy("row").orderBy(F.desc("score"), "positive_id", "positive_row")
    found = _both(pairs, anchors, rows).mapInArrow(score, "row long, anchor_id long, positive_id long, positive_row long, score long")
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def _negatives(pairs: DataFrame, anchors: DataFrame, rows: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """(row, place, negative_id, negative_row, score, rank): the first k of each anchor and positive."""

    def score(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                _, a_row, a_label, a = _open(batch, i, "a")
                c_id, c_row, c_label, c = _open(batch, i, "c")
                s = products(a, c)
                best = np.frombuffer(batch.column(batch.schema.get_field_index("best"))[i].as_py(), "<i8").reshape(len(a_row), -1)
                have = np.frombuffer(batch.column(batch.schema.get_field_index("have"))[i].as_py(), "<i8")
                if s.dtype == object or np.abs(best).max(initial=0) > EXACT / 128:
                    s, best = s.astype(object), best.astype(object)
                apart = a_label[:, None] != c_label
                for p in range(best.shape[1]):
                    ok = apart & (have > p)[:, None] & np.asarray((low * best[:, p:p + 1] <= 100 * s) & (100 * s <= high * best[:, p:p + 1]), bool)
                    some = np.flatnonzero(ok.any(axis=1))
                    if len(some):
                        x, y = _first(s[some], ok[some], k)
                        yield pa.record_batch([pa.array(a_row[some[x]]), pa.array(np.full(len(x), p + 1)), pa.array(c_id[y]), pa.array(c_row[y]), _whole(s[some[x], y])], names=["row", "place", "negative_id", "negative_row", "score"])

    w = Window.partitionBy("row", "place").orderBy(F.desc("score"), "negative_id", "negative_row")
    found = _both(pairs, anchors, rows, ("best", "have")).mapInArrow(score, "row long, place long, negative_id long, negative_row long, score long")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _told(leaves: DataFrame, positives: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """Anchor leaves with what is known of their anchors' positives: ``best`` (scores, k a row) and ``have`` (their
    number), the least score that a further positive needs, and the window of negatives."""
    def each(batches):
        for batch in batches:
            rows = [np.frombuffer(x, "<i8") for x in batch.column(1).to_pylist()]
            if rows:
                n = [len(r) for r in rows]
                yield pa.record_batch([pa.array(np.repeat(batch.column(0).to_numpy(), n)), pa.array(np.concatenate([np.arange(k) for k in n]).astype(np.int32)), pa.array(np.concatenate(rows))], names=["node", "i", "row"])

    own = leaves.select("node", "rows").mapInArrow(each, "node long, i int, row long")
    scores = positives.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "score", *(["last"] if "last" in positives.columns else [])))).alias("scores"))
    lists = own.join(scores, "row", "left").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("i", "scores"))).alias("all"))

    def tell(batches):
        for batch in batches:
            out = []
            for rows in batch.column(1).to_pylist():
                best, have = np.zeros((len(rows), k), np.int64), np.zeros(len(rows), np.int64)
                good = []  # A negative score's window is empty.
                for r, x in enumerate(rows):
                    s = x["scores"] or []
                    best[r, :len(s)], have[r] = [y["score"] for y in s], len(s)
                    # A negative must reach the window, and the last one found so far if all are found.
                    good += [(max(float(y["score"]) * low / 100, -np.inf if y.get("last") is None else float(y["last"])), float(y["score"]) * high / 100) for y in s if y["score"] >= 0]
                least = min((float(b[k - 1]) if h == k else -np.inf) for b, h in zip(best, have))
                out.append((best.astype("<i8").tobytes(), have.astype("<i8").tobytes(), least, min((x for x, _ in good), default=np.inf), max((x for _, x in good), default=-np.inf)))
            cols = list(zip(*out))
            yield pa.record_batch([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.float64())))], names=["node", "best", "have", "least", "window_low", "window_high"])

    told = lists.mapInArrow(tell, "node long, best binary, have binary, least double, window_low double, window_high double")
    return leaves.join(told, "node")


def _mine(rows: DataFrame, dim: int, anchor_every: int, positives: int, negatives: int, low: int, high: int) -> DataFrame | None:
    """rows(row, vec_id, label, v), all of one length."""
    w = Window.partitionBy("v", "label").orderBy("vec_id", "row")
    # Of equal rows no more can be returned, even if one of them is the anchor.
    candidates = rows.withColumn("i", F.row_number().over(w)).where(F.col("i") <= max(positives + 1, negatives)).drop("i")
    count = rows.count()
    sampled = candidates.where(F.pmod(F.xxhash64("row"), F.lit(max(1, count // SAMPLE))) == 0).select("v").limit(2 * SAMPLE).toArrow()
    depth = min(DEEPEST, max(0, int(np.ceil(np.log2(max(1, count / LEAF)))) + 2))
    code = rows.sparkSession.sparkContext.broadcast(Code(_matrix(sampled["v"].combine_chunks()).reshape(sampled.num_rows, dim), depth))

    def coded(batches):
        for batch in batches:
            v = _matrix(batch.column(3)).reshape(batch.num_rows, dim)
            yield pa.record_batch([*batch.columns, pa.array(code.value.of(v))], names=["row", "vec_id", "label", "v", "code"])

    encode = lambda x: x.select("row", "vec_id", "label", "v").mapInArrow(coded, "row long, vec_id long, label long, v array<double>, code long")
    leaves, n = _leaves(encode(candidates), LEAF, "leaves")
    anchors, m = _leaves(encode(rows.where(F.col("vec_id") % anchor_every == 0)), ANCHORS, "anchors")
    if not n or not m:
        return None
    tree = Tree(leaves, n, "rows")
    near = walk(Tree(anchors, m, "anchors"), tree, True, BEAM)
    first = _positives(near, anchors, leaves, positives)
    told = materialise(_told(anchors, materialise(first, "first-positives"), positives, low, high), "told")
    good = materialise(_positives(walk(Tree(told, m, "bounded"), tree, True), anchors, leaves, positives), "positives")
    told = materialise(_told(anchors, good, positives, low, high), "told")
    first = _negatives(walk(Tree(told, m, "windows"), tree, False, BEAM), told, leaves, negatives, low, high)
    last = materialise(first.where(F.col("rank") == negatives).select("row", "place", F.col("score").alias("last")), "first-negatives")
    told = materialise(_told(anchors, good.join(last, ["row", "place"], "left"), positives, low, high), "told")
    bad = _negatives(walk(Tree(told, m, "narrow"), tree, False), told, leaves, negatives, low, high)
    out = bad.join(good.select("row", "anchor_id", "positive_id", "place", F.col("score").alias("positive_score")), ["row", "place"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", F.col("score").alias("negative_score"))


def hard_negatives(rows: DataFrame, anchor_every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of embeddings(vec_id, embedding, label)."""
    spark = rows.sparkSession
    good = materialise(usable(rows).withColumn("row", F.monotonically_increasing_id()).withColumn("d", F.size("v")), "vectors")
    parts = [_mine(good.where(F.col("d") == d).drop("d"), d, anchor_every, positives, negatives, low, high) for d in sorted(r["d"] for r in good.select("d").distinct().collect())]
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for part in parts:
        if part is not None:
            out = out.unionByName(part)
    return out


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
