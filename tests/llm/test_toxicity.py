"""Toxicity: exactness against brute force, held-out accuracy, odd rows."""
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from renewcast.llm.toxicity import Index, fit, learn, op5_toxicity, score


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"  # the smallest table with enough labelled rows of each language
    got = op5_toxicity(spark, sf)
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    pos, neg = ([r["score"] for r in rows if r["toxic"] == y] for y in (1, 0))
    auc = np.mean([(p > n) + (p == n) / 2 for p in pos for n in neg])
    accuracy = np.mean([r["predicted"] == r["toxic"] for r in rows])
    assert auc > 0.97 and accuracy > 0.97, (auc, accuracy)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got.collect())


def brute_index(docs, labels):
    """Vectors of all labelled texts by plain counting: {text: (vector, labels)}, and how to weigh another text."""
    words = lambda t: Counter(re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode())))
    text_of = dict(docs)
    examples = defaultdict(list)
    for d, y in labels:
        examples[text_of[d] or ""].append(y)
    df = Counter(w for _, t in docs for w in words(t))
    yes, no = Counter(), Counter()
    for t, ys in examples.items():
        for w in words(t):
            yes[w] += sum(ys)
            no[w] += len(ys) - sum(ys)
    pos = sum(sum(ys) for ys in examples.values())
    neg = sum(len(ys) for ys in examples.values()) - pos

    def z(w):
        a, b, n = yes[w], no[w], pos + neg
        cells = [(a, a + b, pos), (b, a + b, neg), (pos - a, n - a - b, pos), (neg - b, n - a - b, neg)]
        return math.sqrt(max(0, 2 * sum(o * math.log(o * n / (r * c)) for o, r, c in cells if o)))

    def vector(t):
        v = {w: (1 + math.log(c)) * (math.log((len(docs) + 1) / (df[w] + 1)) + 1) * z(w) for w, c in words(t).items() if w in yes or w in no}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()} if norm else {}

    return {t: vector(t) for t in examples}, vector


def test_search_is_exact(spark, sf):
    """Similarities of the nearest examples against TF-IDF cosines over whole texts, counted independently."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("toxic").alias("label")).where("label IS NOT NULL")
    rows = [tuple(r) for r in docs.collect()]
    examples, vector = brute_index(rows, [tuple(r) for r in labels.join(docs.select("doc_id"), "doc_id").collect()])
    have = {r["doc_id"]: [e["similarity"] for e in r["evidence"]] for r in score(docs, fit(docs, labels)).collect()}
    for d, t in rows[:250]:
        v = vector(t)
        want = sorted((s for t2, u in examples.items() if t2 != (t or "") and (s := sum(x * u.get(w, 0) for w, x in v.items())) > 1e-9), reverse=True)[:15]
        assert len(want) == len(have[d]) and np.allclose(want, have[d], atol=1e-4), d


def test_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id long, label int")
    assert {r["score"] for r in score(odd, fit(odd, none)).collect()} == {0.0}
    docs = spark.createDataFrame([(i, ("vile foul " if i % 2 else "nice kind ") + f"w{i} some words", "e", 1) for i in range(200)] + [(900, None, "e", 1), (901, "", "e", 1), (None, "vile foul", "e", 1)], "doc_id long, text string, evidence string, term int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(150)] + [(3, None), (None, 1)], "doc_id long, label int")
    out = {r["doc_id"]: r for r in score(docs, fit(docs, labels)).collect()}
    assert all((out[i]["score"] >= 0.5) == (i % 2 == 1) for i in range(200)) and out[None]["score"] > 0.5
    assert out[900]["score"] == out[901]["score"] and out[900]["evidence"] == [] and out[1]["evidence"][0]["label"] == 1
    assert score(docs.limit(0), fit(docs, labels)).count() == 0
    # An example has no vote on its own text: a lone toxic text among others of its words is as clean as they are.
    lone = docs.union(spark.createDataFrame([(1000, "nice kind w1000 some words", "e", 1)], docs.schema))
    assert {r["doc_id"]: r["score"] for r in score(lone, fit(lone, labels.union(spark.createDataFrame([(1000, 1)], labels.schema)))).collect()}[1000] < 0.5
    # A third of all examples are copies of one text, and one text is very long.
    copies = spark.createDataFrame([(i, "vile foul same text" if i < 90 else f"vile foul v{i}") for i in range(120)] + [(i, f"nice kind w{i}") for i in range(120, 239)] + [(239, "nice " + "kind word " * 60000), (240, "vile foul other text")], "doc_id long, text string")
    out = {r["doc_id"]: r["predicted"] for r in score(copies, fit(copies, spark.range(239).select(F.col("id").alias("doc_id"), (F.col("id") < 120).cast("int").alias("label")))).select("doc_id", (F.col("score") >= 0.5).alias("predicted")).collect()}
    assert out[240] and not out[239] and not out[130]


def test_common_terms_are_rows():
    """Terms of more than a thirty-second of the examples are walked neither for bounds nor for products; what is found
    is what all products say."""
    rng = np.random.default_rng(5)
    has = rng.random((640, 60)) < np.array([0.5] * 5 + [0.06] * 20 + [0.01] * 35)
    count = rng.integers(1, 4, has.shape)
    factor = rng.random(60) + 0.1
    index = Index(np.arange(60, dtype=np.uint64), factor, [(i, bytes([i % 256, i // 256]), i % 2, 1 - i % 2, np.flatnonzero(has[i]), count[i][has[i]]) for i in range(640) if has[i].any()])
    often = has.sum(axis=0) > index.n / 32
    assert often.sum() > 15 and not index.count[often].any() and index.count[~often].all()
    dense = np.zeros((index.n, 60))
    for j, i in enumerate(index.ids):
        dense[j][has[i]] = (1 + np.log(count[i][has[i]])) * factor[has[i]]
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    row, term = np.nonzero(dense[:100])
    rows, who, best = index.nearest(row, term, dense[row, term].astype(np.float32), 15)
    want = dense[:100] @ dense.T
    assert list(rows) == list(range(100)) and np.allclose(best, -np.sort(-want, axis=1)[:, :15], atol=1e-6)
    assert np.allclose(best, np.take_along_axis(want, who, 1), atol=1e-6)
