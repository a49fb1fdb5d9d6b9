"""Word-window and byte-string dedup against brute force."""
import hashlib
import os
import re

import numpy as np
import pyarrow as pa

from renewcast.llm import countmin
from renewcast.llm.induced import Folder
from renewcast.llm.shared import Copies
from renewcast.llm.substring_dedup import op1_substring_dedup, substring_dedup
from renewcast.llm.suffix_dedup import _later, op2_suffix_dedup, suffix_dedup


def brute(rows, split, window, join):
    first = {}
    items = [(d, split(t)) for d, t in rows]
    for d, x in items:
        if d is not None:
            for i in range(len(x) - window + 1):
                k = join(x[i:i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, x in items:
        hit = [False] * len(x)
        for i in range(len(x) - window + 1) if d is not None else ():
            if first[join(x[i:i + window])] < d:
                hit[i:i + window] = [True] * window
        spans = sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit))
        kept = join([y for y, h in zip(x, hit) if not h])
        out.append((d, len(x), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def words(t):
    return re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())


def octets(t):
    return [bytes([b]) for b in (t or "").encode()]


def by_words(rows, window=50):
    return [(d, n, r, h) for d, n, r, _, h in brute(rows, words, window, b" ".join)]


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_words_on_odd_rows(odd):
    got = substring_dedup(odd).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == by_words(rows_of(odd))
    assert substring_dedup(odd.limit(0)).count() == 0


def test_words_on_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = sorted(map(tuple, op1_substring_dedup(spark, sf).collect()), key=str)
    assert got == by_words(rows_of(docs)) and sum(r[2] for r in got) > 0


def test_bytes_on_odd_rows(odd):
    for how in ({}, {"base": 16, "budget": 100}, {"hot": 1}):
        got = suffix_dedup(odd, **how).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
        assert sorted(map(tuple, got), key=str) == brute(rows_of(odd), octets, 50, b"".join)
    assert suffix_dedup(odd.limit(0)).count() == 0


def test_bytes_on_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = sorted(map(tuple, op2_suffix_dedup(spark, sf).collect()), key=str)
    assert got == brute(rows_of(docs), octets, 50, b"".join) and sum(r[2] for r in got) > 0


def test_a_hot_text(spark):
    """Copies of one text beyond what is left to a shuffle (join_hot), and variants of it."""
    base = [f"word{i}" for i in range(70)]
    rows = [(i, " ".join(base)) for i in range(1, 1301)] + [(2000 + i, " ".join(base[:i] + ["other"] + base[i:])) for i in range(3, 60, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, substring_dedup(df).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str) == by_words(rows)
    assert sorted(map(tuple, suffix_dedup(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str) == brute(rows, octets, 50, b"".join)


def test_copies_of_long_passages(spark):
    """Passages of many chunks whole, cut, put together otherwise, in documents with smaller and larger ids, in rows
    that share an id, twice in one document, and with an id below zero."""
    passage = [" ".join(f"{k}w{i * i % 9973}" for i in range(900)) for k in range(3)]
    a, b, c = passage
    rows = [(5, a), (9, a), (7, b + c), (3, c), (8, a[700:5000] + b[100:4000]), (8, c + c), (8, "x" * 300 + a), (-4, b[2000:]), (None, a), (10, a + b + c), (2, "x" * 70)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = suffix_dedup(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, octets, 50, b"".join)


def test_words_of_rows_that_share_an_id(spark):
    """The same rows for words; rows of one id that share nothing, the shorter of which must lose nothing."""
    passage = [" ".join(f"{k}w{i * i % 9973}" for i in range(900)) for k in range(3)]
    a, b, c = passage
    lone = " ".join(f"own{i}" for i in range(200))
    rows = [(5, a), (9, a), (7, b + c), (3, c), (8, a[700:5000] + b[100:4000]), (8, c + c), (8, "x " * 300 + a), (-4, b[2000:]), (None, a), (10, a + b + c), (1, a), (5, lone), (5, "only three words"), (5, a), (5, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, substring_dedup(df).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)
    assert got == by_words(rows) and (5, 200, 0) in [r[:3] for r in got] and (5, 3, 0) in [r[:3] for r in got]


def test_a_full_sketch_lists_no_more(spark, monkeypatch):
    """Far more anchors, each in one document, than the sketches have cells, as a large corpus has: only what two
    documents have is listed, and it is removed."""
    monkeypatch.setattr(countmin, "MAX_BLOCKS", 1)
    listed, write = {}, Copies.write

    def counted(self, df, name):
        out = write(self, df, name)
        listed[name] = out.count()
        return out

    monkeypatch.setattr(Copies, "write", counted)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(d, " ".join(hashlib.sha256(f"{d} {i}".encode()).hexdigest() for i in range(300)) + (passage if d in (7, 50) else "")) for d in range(60)]
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == {d: len(passage) if d == 50 else 0 for d in range(60)}
    assert sum(len(t) for _, t in rows) // 10 > 1 << 16 and 0 < listed["segments"] < 1000 and listed["shared"] < 100


def test_only_repeated_keys_fill_the_bits(spark):
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 63, 400_000, np.int64)
    keys = np.append(keys, keys[:5000])
    df = spark.createDataFrame(pa.table({"key": rng.permutation(keys)})).repartition(4)
    for blocks in (1, 4):
        bits = countmin.several(df, lambda b: iter([b.column(0).to_numpy().view(np.uint64)]), blocks)
        found = countmin.among(bits, keys.view(np.uint64))
        assert found[:5000].all() and found[5000:400_000].mean() < 0.01


def test_shards_in_memory_and_on_disk():
    """Strings of a shard sorted as a sparse suffix array, and all its suffixes on disk."""
    rng = np.random.default_rng(11)
    pieces = [bytes(rng.integers(97, 99, int(n), dtype=np.uint8).tolist()) for n in rng.integers(8, 40, 300)]
    size, doc = np.array([len(x) for x in pieces]), rng.integers(-3, 40, 300)
    text = np.frombuffer(b"\1".join(pieces) + b"\1\0", np.uint8)
    start = np.cumsum(size + 1) - size - 1
    strings = [(x[j:j + 8], int(d)) for x, d in zip(pieces, doc) for j in range(len(x) - 7)]
    least = {}
    for x, d in strings:
        least[x] = min(least.get(x, d), d)
    want = [least[x] < d for x, d in strings]
    for base, on_disk in ((1 << 18, False), (16, True)):
        with Folder() as folder:
            assert _later(text, start, size, doc, 8, folder, base, 100).tolist() == want and bool(os.listdir(folder.path)) == on_disk
    assert 0 < sum(want) < len(want)
