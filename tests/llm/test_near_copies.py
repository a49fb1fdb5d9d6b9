"""The pipeline's near-copy stage."""
import corpus_pipeline

from test_jaccard import brute


def table(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def left(spark, rows):
    return sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.near_copies(spark, table(spark, rows), None).collect()), key=str)


def words(name, n):
    return [f"{name}{i}" for i in range(n)]


def test_eighty_percent_of_five_words(spark):
    a, b, c = words("a", 204), words("b", 204), words("c", 204)
    edits = list(b)
    for at in (20, 60, 100, 150):
        edits[at] = f"new{at}"
    # 200 of 244, 180 of 220 and 200 of 255 shingles in common.
    rows = [(1, " ".join(a)), (2, " ".join(a + words("x", 44))), (3, " ".join(b)), (4, " ".join(edits)), (5, " ".join(c)), (6, " ".join(c + words("y", 55)))]
    assert {d for d, n, k in brute(rows, 80, 5) if d == k} == {1, 3, 5, 6}
    assert {d for d, _ in left(spark, rows)} == {1, 3, 5, 6}


def test_tables_leaders(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    want = {d for d, n, k in brute(rows, 80, 5) if n == 0 or d == k}
    assert {d for d, _ in left(spark, rows)} == want


def test_repeated_ids(spark):
    a, b, c, d = (" ".join(words(x, 100)) for x in "abcd")
    rows = [(5, a), (5, b), (6, a + " a"), (7, b + " b"), (3, c), (8, c + " c"), (8, d), (9, d + " d"), (9, d + " d"), (10, ""), (10, None), (10, ""), (11, a), (2, "x y"), (2, "x y"), (None, b), (None, "no id here")]
    assert left(spark, rows) == sorted([(5, a), (5, b), (3, c), (8, d), (10, ""), (10, None), (10, ""), (2, "x y"), (None, "no id here")], key=str)
