"""Best-fit packing: pieces against the tokenizers library, sequences whole and gapless, few of them."""
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from renewcast.llm import packing as P

ODD_TEXTS = [None, "", " ", "<|endoftext|> inside <|endoftext|>", "é ü ß 漢字 😀  ", "x" * 30000, " " * 40000 + "z", "\n" * 9000, "zero\x00byte", "many words " * 3000, "don't re-do it's 12345", "  a b"]


def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def expected(rows, capacity=2048):
    encode, out = library(), []
    for doc, text in rows:
        ids = encode(text)
        head = len(ids) % capacity or capacity
        edge = [0] + list(range(head if len(ids) > capacity else len(ids), len(ids) + 1, capacity))
        for k, (a, b) in enumerate(zip(edge, edge[1:])):
            out.append((doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return sorted(out, key=str)


def best_fit_decreasing(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fit = [i for i, free in enumerate(bins) if free >= n]
        if fit:
            bins[min(fit, key=bins.__getitem__)] -= n
        else:
            bins.append(capacity - n)
    return len(bins)


def check(got, capacity=2048):
    """Number of sequences, all of them gapless and no longer than the capacity."""
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        parts.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and parts[0][0] == 0 and sum(parts[-1]) <= capacity
    return len(by)


def test_on_the_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = P.op12_packing(spark, sf).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == expected(rows)
    assert check(got) <= best_fit_decreasing([r.length for r in got], 2048) + 1


def test_odd_rows(spark, odd):
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + k, t) for k, t in enumerate(ODD_TEXTS)] + [(100, None), (None, "a")], "doc_id long, text string")).selectExpr("*", "1 AS item", "2 AS length")
    got = P.pack(docs, ids=True)
    rows = got.collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == expected([tuple(r) for r in docs.select("doc_id", "text").collect()])
    n = check(rows)
    whole = {r.sequence_id: np.frombuffer(bytes(r.ids), "<u4") for r in P.sequences(got).collect()}
    assert len(whole) == n and all(zlib.crc32(whole[r.sequence_id][r.offset:r.offset + r.length].tobytes()) == r.ids_crc32 for r in rows)
    assert P.pack(docs.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["equal", "halves", "small", "mixed", "tail", "full"])
def test_few_sequences(spark, kind, monkeypatch):
    """As good as best-fit decreasing within one sequence in a hundred, with many ranges in the sweeps."""
    monkeypatch.setattr(P, "RANGE", 64)
    rng = random.Random(3)
    lengths = {"equal": [40] * 900, "halves": [rng.choice((49, 50, 51)) for _ in range(400)], "small": [rng.randint(1, 4) for _ in range(2000)], "mixed": [rng.randint(1, 100) for _ in range(1500)], "tail": [min(100, int(rng.expovariate(0.05)) + 1) for _ in range(1500)], "full": [100] * 30}[kind]
    items = spark.createDataFrame(list(enumerate(lengths)), "item long, length long")
    got = P.place(items, 100).join(items, "item").collect()
    assert sorted(r.item for r in got) == list(range(len(lengths)))
    used = Counter()
    for r in got:
        used[r.seq] += r.length
    assert max(used.values()) <= 100 and len({(r.seq, r.turn, r.slot) for r in got}) == len(got)
    assert len(used) <= best_fit_decreasing(lengths, 100) * 1.01 + 1


def test_sweep_over_ranges():
    """Ranges apart and over ranges together are the matching of one range."""
    rng = np.random.default_rng(5)
    for _ in range(50):
        item = rng.random(60) < rng.random()
        stack, want = [], set()
        for i, x in enumerate(item):
            if x:
                stack.append(i)
            elif stack:
                want.add((stack.pop(), i))
        got, counts, left = set(), [], {}
        edge = [0, *sorted(rng.integers(0, 61, 4).tolist()), 60]
        for k, (a, b) in enumerate(zip(edge, edge[1:])):
            p, g, closing, opening = P.sweep(item[a:b])
            got |= set(zip((p + a).tolist(), (g + a).tolist()))
            left[k] = (closing + a, opening + a)
            counts.append((k, len(closing), len(opening)))
        for a, a0, b, b0, n in P.across(counts):
            got |= set(zip(left[a][1][a0:a0 + n].tolist(), left[b][0][b0:b0 + n].tolist()))
        assert got == want


def test_cut():
    assert P.cut(1, 4) == [0, 1] and P.cut(4, 4) == [0, 4] and P.cut(5, 4) == [0, 1, 5] and P.cut(8, 4) == [0, 4, 8] and P.cut(11, 4) == [0, 3, 7, 11]
