"""Nearest neighbours: recall and exact scores against brute force."""
import numpy as np
from pyspark.sql import functions as F

from renewcast.llm.neighbours import nearest, op8_neighbours


def brute(rows, is_query, k=20):
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v]
    rows = [(i, v) for i, v in rows if np.isfinite(v).all() and v.any()]
    ids = np.array([i for i, _ in rows])
    m = np.array([v for _, v in rows])
    out = {}
    for i, v in rows:
        if is_query(i):
            s = m @ v
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), s[j]) for j in order]
    return out


def recall(got, want):
    hit = total = 0
    for q, near in want.items():
        have = [r for r in got if r["query_id"] == q]
        assert sorted(r["rank"] for r in have) == list(range(1, len(near) + 1))
        worst = near[-1][1] - 1e-9
        hit += sum(r["score"] >= worst for r in have)
        total += len(near)
    return hit / total


def test_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = op8_neighbours(spark, sf).collect()
    want = brute(rows, lambda i: i % 20 == 0)
    assert recall(got, want) >= 0.9
    exact = {r["vec_id"]: np.array(r["embedding"], float) for r in rows}
    assert all(abs(r["score"] - exact[r["query_id"]] @ exact[r["vec_id"]]) < 1e-12 for r in got)


def test_odd_rows(spark):
    nan = float("nan")
    rows = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(60)] + [(100, None), (101, [0.0, 0.0, 0.0]), (102, [1.0, None, 2.0]), (103, [1.0, nan, 2.0]), (104, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (105, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, node string")
    got = nearest(df, F.col("vec_id") % 20 == 0, k=20).collect()
    want = brute(rows[:60], lambda i: i % 20 == 0)
    assert {q: [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] for q in want} == {q: [i for i, _ in near] for q, near in want.items()}
    assert nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest(df, F.col("vec_id") < 0).count() == 0


def test_repeated_rows(spark):
    """Each row is a candidate, and a query by itself; only its own row is left out."""
    v, w = [1.0, 0.0], [0.5, 0.5]
    df = spark.createDataFrame([(1, v), (1, v), (20, v), (20, v), (20, w), (3, w)], "vec_id long, embedding array<double>").repartition(3)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in nearest(df, F.col("vec_id") % 20 == 0).collect())
    one = [(1, 1.0), (1, 1.0), (20, 1.0), (3, 0.5), (20, 0.5)]
    other = [(1, 0.5), (1, 0.5), (3, 0.5), (20, 0.5), (20, 0.5)]
    assert got == sorted((20, k + 1, *x) for near in (one, one, other) for k, x in enumerate(near))
