"""Decontamination against brute force."""
import hashlib
import re

from pyspark.sql import functions as F

from renewcast.llm.decontaminate import decontaminate, find, op4_decontaminate


def words(t):
    raw = (t or "").encode()
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", raw)


def brute(docs, items, window=10):
    grams = {}
    for item, t in items:
        w = words(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if n else ():
            if len(w) >= window or i == 0:
                grams.setdefault(n, {}).setdefault(tuple(w[i:i + n]), set()).add(str(item))
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = [False] * len(w), set()
        for n, g in grams.items():
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in g:
                    hit[i:i + n] = [True] * n
                    found |= g[tuple(w[i:i + n])]
        out.append((d, len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), any(hit)))
    return sorted(out, key=str)


def digest(df):
    df = df.select("doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.concat_ws(",", F.sort_array("items")), 256), F.col("n_hit") > 0)
    return sorted(map(tuple, df.collect()), key=str)


def test_table(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    got = sorted(map(tuple, op4_decontaminate(spark, sf).collect()), key=str)
    assert got == brute(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect())
    assert sum(r[5] for r in got) > 0
    assert digest(find(docs, items, block_words=300)) == got


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, "b c d e f g h i j k l m"), (3, "x y"), (4, "x y z"), (5, ""), (6, None), (7, "y"), (7, "a a a a a a a a a a a"), (None, "q r")], "item_id long, text string")
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "... A B c D e f, g h i j k l m!", 1), (4, "x y z y", 1), (5, "a a a a a a a a a a a a a q", 1), (5, "a a a a a a a a a x Y w", 1), (6, "b c d e f g h i j x a b c d e f g h i j", 1), (7, "q-r", 1), (None, "xy yx é", 1)], "doc_id long, text string, n_hit int")
    want = brute([(r[0], r[1]) for r in docs.collect()], [tuple(r) for r in items.collect()])
    want = [w for w in want]
    got = digest(find(docs, items))
    fix = lambda rows: [(r[0], r[1], r[2], r[5]) for r in rows]  # noqa: E731  a null id is no text
    assert fix(got) == fix(want)
    assert digest(find(docs, items, block_words=5)) == got
    assert digest(find(docs, items.limit(0))) == brute([(r[0], r[1]) for r in docs.collect()], [])
    assert find(docs.limit(0), items).count() == 0
    clean = {(r["doc_id"], r["text"]): (r["clean"], r["dropped"]) for r in decontaminate(docs, items).collect()}
    assert clean[(3, "... A B c D e f, g h i j k l m!")] == ("", True)
    assert clean[(2, "")] == ("", False) and clean[(1, None)] == (None, False)
    assert decontaminate(docs, items, coverage_limit=1.0).where("doc_id = 3").first()["clean"] == "... !"
