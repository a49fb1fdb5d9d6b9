"""The Jaccard join against brute force."""
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np

from renewcast.llm import countmin
from renewcast.llm.jaccard_join import jaccard_join, op6_jaccard_join


def brute(rows, percent=85, gram=4):
    sets = []
    for d, t in rows:
        raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode())
        w = re.findall(rb"[^\x20\x09-\x0D]+", raw)
        sets.append({tuple(w[i:i + gram]) for i in range(len(w) - gram + 1)} if len(w) >= gram else {tuple(w)} if w else set())
    parent = list(range(len(rows)))
    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    index = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in index[x])
        for j, k in shared.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                parent[find(i)] = find(j)
        for x in s:
            index[x].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    have = got(op6_jaccard_join(spark, sf))
    assert have == brute(rows) and sum(r[0] != r[2] for r in have) > 10


def test_small_and_near_sets(spark, odd):
    rng = random.Random(1)
    rows, d = [], 100
    for size in [*range(3, 34), 60, 150, 400]:
        base = [f"v{rng.randrange(10**6)}" for _ in range(size)]
        for _ in range(5):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 1 + size // 60])):
                k = rng.randrange(3)
                at = rng.choice([0, len(w) - 1, rng.randrange(len(w))])
                if k == 0:
                    w[at] = f"n{rng.randrange(10**6)}"
                elif k == 1 and len(w) > 1:
                    del w[at]
                else:
                    w.insert(at, f"n{rng.randrange(10**6)}")
            rows.append((d, " ".join(w)))
            d += 1
    passage = [f"p{i}" for i in range(60)]
    rows += [(d + i, " ".join([f"a{i}x{j}" for j in range(8)] + passage + [f"b{i}x{j}" for j in range(rng.randrange(12))])) for i in range(40)]
    df = odd.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    want = brute([tuple(r) for r in df.collect()])
    assert got(jaccard_join(df)) == want
    assert got(jaccard_join(df, light=0)) == want
    assert jaccard_join(df.limit(0)).count() == 0


def test_cells_of_a_sketch_take_little_memory():
    """What a worker needs for a full step of keys, and that each cell is sent once or twice."""
    keys = np.random.default_rng(1).integers(0, 1 << 63, countmin._FLUSH, np.int64).astype(np.uint64)
    keys[:1000] = keys[0]
    tracemalloc.start()
    sent = 0
    for batch in countmin._send(keys, 1024):
        sent += sum(map(len, batch["cells"].to_pylist())) // 2
        del batch
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = sum(int(np.minimum(np.unique(countmin.cells(keys, 1024, d), return_counts=True)[1], 2).sum()) for d in range(countmin.DEPTH))
    assert sent == want and most < 80 << 20
