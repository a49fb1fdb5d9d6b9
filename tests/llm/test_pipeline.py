"""The pipeline's rows against brute force, stage by stage."""
import hashlib
import os

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from renewcast.llm.toxicity import learn, score
from test_decontaminate import words
from test_jaccard import brute as groups
from test_line_dedup import brute as lines


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    bad = {r["doc_id"] for r in score(docs, learn(spark, docs, sf)).where("score >= 0.5").collect()}
    left = [(d, r["text"]) for d, r in rows.items() if d not in bad]
    cut = [(d, t) for d, t, _, n in lines(left, 50) if not n or t.strip()]
    leaders = {d for d, n, c in groups(cut, corpus_pipeline.PERCENT, corpus_pipeline.GRAM) if n == 0 or d == c}
    kept = [(d, t) for d, t in cut if d in leaders]
    items = [words(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    grams = {tuple(w[i:i + 10]) for w in items for i in range(max(1, len(w) - 9)) if w}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.no_truncation()
    want = {}
    for d, t in kept:
        w = words(t)
        hit = [False] * len(w)
        for g in grams:
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i:i + len(g)]) == g:
                    hit[i:i + len(g)] = [True] * len(g)
        if sum(hit) > 0.5 * len(w):
            continue
        want[d] = (t, any(hit))
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(got) == set(want) and len(got) < len(rows)
    for d, (t, changed) in want.items():
        g = got[d]
        assert (g["text"] == t) != changed
        ids = tokenizer.encode(g["text"] or "", add_special_tokens=False).ids
        assert g["n_tokens"] == len(ids) and bytes(g["ids"]) == np.array(ids, "<u4").tobytes()
        assert g["decoded_sha256"] == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert g["lang"] == rows[d]["lang"] and (g["n_chars"] == rows[d]["n_chars"] if g["text"] == rows[d]["text"] else g["n_chars"] == len(g["text"]))


@pytest.fixture
def folder(spark, tmp_path):
    """A source whose documents are given; labels and benchmark are those of the small tables."""
    for t in ("labels", "benchmark"):
        os.symlink(f"/root/testdata/sf0.001/{t}.parquet", tmp_path / f"{t}.parquet")

    def of(docs):
        docs.write.parquet(f"{tmp_path}/documents.parquet")
        return str(tmp_path)

    return of


def test_odd_rows(spark, folder):
    known = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    fresh = " ".join(f"odd{i}" for i in range(40))
    odd = [(1000, None, "en", "s", None), (1001, "", None, None, 0), (1002, " \n ", "en", "s", 3), (None, f"{fresh} nobody", "en", None, 1), (1003, "w" * 200_000, "en", "s", 200_000),
           (1004, f"{fresh} twice", "en", "s", 7), (1004, f"{fresh} twice", "en", "s", 7), (1005, f"{fresh} twice", "en", "s", 7), (1006, "one id", "en", "s", 6), (1006, "other text", "en", "s", 10)]
    docs = known.unionByName(spark.createDataFrame(odd, known.schema))
    # Names that stages use for their own columns.
    docs = docs.selectExpr("*", "1 AS score", "'x' AS text_hash", "2 AS n_removed", "true AS dropped", "'y' AS clean", "3 AS component", "4 AS ids")
    got = corpus_pipeline.run(spark, folder(docs))
    assert got.columns == [*corpus_pipeline.COLUMNS, "ids", "n_tokens", "decoded_sha256"]
    rows = sorted((tuple(r) for r in got.where("doc_id >= 1000 OR doc_id IS NULL").select("doc_id", "text", "n_chars", "n_tokens").collect()), key=str)
    left = {(r[0], r[1]): r[2:] for r in rows}
    assert len(left) == len(rows)
    # Texts without words are in no group and stay; of copies the smallest id stays, of equal rows one, and a row without
    # an id comes last in its group; rows that share an id stay apart.
    assert {k[0] for k in left} == {1000, 1001, 1002, 1003, 1004, 1006} and sum(k[0] == 1006 for k in left) == 2
    assert left[1000, None] == (None, 0) and left[1001, ""] == (0, 0) and left[1003, "w" * 200_000][0] == 200_000 and left[1004, f"{fresh} twice"][0] == 7


def test_empty_table(spark, folder):
    none = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    got = corpus_pipeline.run(spark, folder(none))
    assert got.count() == 0 and got.columns == [*corpus_pipeline.COLUMNS, "ids", "n_tokens", "decoded_sha256"]
