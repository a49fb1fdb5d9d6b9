"""Hard negatives against brute force; pruning on clustered vectors."""
import math

import numpy as np
import pytest

from renewcast.llm import hard_negatives as H


def brute(rows, every=100):
    good = []
    for i, e, label in rows:
        if i is None or label is None or e is None or any(x is None or not math.isfinite(256.0 * x) for x in e):
            continue
        good.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256.0 * x) for x in e]))
    out = []
    for k, (a, la, va) in enumerate(good):
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, label == la) for j, (i, label, v) in enumerate(good) if j != k and len(v) == len(va))
        for s, p, _ in [x for x in scored if x[2]][:5]:
            bad = [(-t, i) for t, i, alike in scored if not alike and 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(a, p, r + 1, i, -s, t) for r, (t, i) in enumerate(bad)]
    return sorted(out)


def table(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


def got(df):
    return sorted(map(tuple, df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def test_on_the_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert got(H.op11_hard_negatives(spark, sf)) == brute(rows) != []


def clustered(n, dim=8, labels=10, seed=1, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((labels * 4, dim))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    which = rng.integers(0, len(centres), n)
    v = centres[which] + spread * rng.standard_normal((n, dim))
    return [(int(i), [float(x) for x in v[i]], int(which[i] % labels)) for i in range(n)]


def test_many_levels(spark, monkeypatch):
    """Small leaves and a fan of 4, so that several levels are walked; whole anchor groups are dropped on the way."""
    monkeypatch.setattr(H, "LEAF", 16)
    monkeypatch.setattr(H, "ANCHORS", 4)
    monkeypatch.setattr(H, "FAN", 4)
    rows = clustered(3000, spread=0.02)
    seen, whole = [], H.walk

    def counted(anchors, tree, same, beam=None):
        out = whole(anchors, tree, same, beam)
        seen.append((same, beam, out.count(), anchors.leaves.count() * tree.leaves.count(), len(tree.levels)))
        return out

    monkeypatch.setattr(H, "walk", counted)
    assert got(H.hard_negatives(table(spark, rows), 10)) == brute(rows, 10) != []
    assert all(levels >= 4 for *_, levels in seen) and all(n < most * (0.2 if same else 0.7) for same, _, n, most, _ in seen)


def test_odd_rows(spark):
    rows = clustered(450, 4, spread=0.3) + [(500, None, 1), (600, [1.0, 2.0, 3.0, 4.0], None), (None, [1.0, 2.0, 3.0, 4.0], 1), (700, [1.0, None, 3.0, 4.0], 1), (701, [1.0, math.nan, 3.0, 4.0], 1), (702, [1.0, math.inf, 3.0, 4.0], 1), (703, [1e307, 0.0, 0.0, 0.0], 1)]
    # Ties, repeated rows, a zero vector, other lengths (none at all too), one vector of many rows, anchors among them.
    rows += [(100, [0.5, 0.5, 0.5, 0.5], 3), (100, [0.5, 0.5, 0.5, 0.5], 3), (800, [0.0] * 4, 2), (900, [1.0, 2.0], 1), (901, [1.0, 2.0], 1), (902, [1.0, 1.9], 2), (1000, [], 1), (1001, [], 1), (1002, [], 2)]
    rows += [(i, [0.4, 0.4, 0.4, 0.4], i % 3) for i in range(2000, 2400)] + [(i, [0.4, 0.4, 0.4, 0.39], 5) for i in range(2400, 2410)]
    df = table(spark, rows).selectExpr("*", "1 AS row", "2 AS code", "3 AS node")
    assert got(H.hard_negatives(df)) == brute(rows)
    assert H.hard_negatives(df.limit(0)).count() == 0 and got(H.hard_negatives(df.where("vec_id = 100 OR vec_id IS NULL"))) == []


@pytest.mark.parametrize("size", [1e6, 1e11])
def test_large_numbers(spark, size):
    """Sums beyond what doubles hold exactly."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in size / 256 * (1 + 1e-3 * rng.standard_normal(3))], i % 3) for i in range(150)]
    if size < 1e9:
        assert got(H.hard_negatives(table(spark, rows), 50)) == brute(rows, 50)
    else:
        assert H.hard_negatives(table(spark, rows), 50).count() > 0


def test_intervals():
    """Exact products, and balls that hold their rows."""
    rng = np.random.default_rng(4)
    a = np.floor(1e9 * rng.standard_normal((3, 5)))
    assert (H.products(a, a) == np.array([[sum(int(x) * int(y) for x, y in zip(p, q)) for q in a] for p in a], object)).all()
    v = rng.standard_normal((20, 3))
    centre, radius = H.ball(v)
    assert (np.linalg.norm(v - centre, axis=1) <= radius).all()
