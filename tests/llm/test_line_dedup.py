"""Line dedup against brute force and its SQL."""
import re

import duckdb

from renewcast.llm.line_dedup import OP9_SQL, line_dedup, op9_line_dedup


def brute(rows, min_words):
    docs = []
    for d, t in rows:
        lines = t.split("\n") if t is not None else []
        body = [(i, x, len(re.findall(r"[^\x20\x09-\x0D]+", x))) for i, x in enumerate(lines)]
        docs.append((d, t, lines, [b for b in body if b[2]]))
    first = {}
    def runs(body):
        for a in range(len(body)):
            n = 0
            for b in range(a, len(body)):
                n += body[b][2]
                if n >= min_words:
                    yield a, b, tuple(x[1] for x in body[a:b + 1])
    for d, _, _, body in docs:
        if d is not None:
            for a, b, r in runs(body):
                first[r] = min(first.get(r, d), d)
    out = []
    for d, t, lines, body in docs:
        hit = [False] * len(body)
        if d is not None:
            for a, b, r in runs(body):
                if first[r] < d:
                    hit[a:b + 1] = [True] * (b - a + 1)
        gone = set()
        for k, h in enumerate(hit):
            if h:
                gone.add(body[k][0])
                if k + 1 < len(hit) and hit[k + 1]:
                    gone |= set(range(body[k][0], body[k + 1][0]))
        out.append((d, t if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone)))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "text", "n_lines", "n_removed").collect()), key=str)


def test_odd_rows(spark, odd):
    lines = [f"line number {i} with some words" for i in range(40)]
    rows = [(20, "\n".join(lines[:20])), (21, "x\n" + "\n".join(lines[3:9]) + "\ny y\n\n" + "\n".join(lines[12:15])), (22, "\n\n".join(lines[2:30])), (22, "\n".join(lines[5:40])),
            (23, "\n".join(["same same"] * 30)), (24, "\n".join(["same same"] * 12)), (25, lines[0]), (26, "\n".join(lines[25:28])), (None, "\n".join(lines)), (20, "\n".join(lines[:20]))]
    df = odd.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    for n in (1, 7, 20, 50):
        assert got(line_dedup(df, n)) == brute([tuple(r) for r in df.collect()], n), n
    assert line_dedup(df.limit(0)).count() == 0
    named = line_dedup(df.withColumnRenamed("text", "body").selectExpr("doc_id", "body", "1 AS spans", "2 AS line", "3 AS words"), 7, text="body")
    assert sorted(named.columns) == sorted(["doc_id", "body", "line", "words", "n_lines", "n_removed", "spans"])


def test_table_by_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    columns = ["doc_id", "kept_sha256", "n_lines", "n_removed", "n_spans"]
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({OP9_SQL})").fetchall()
    have = [tuple(r) for r in op9_line_dedup(spark, sf).select(*columns).collect()]
    assert sorted(have) == sorted(want) and sum(r[3] for r in have) > 0


def test_names_of_its_own(spark):
    df = spark.createDataFrame([(i, "a line of words\nanother line here", f"mine{i}", i) for i in range(3)], "doc_id long, text string, _doc string, _text long")
    out = line_dedup(df, 3).orderBy("doc_id").collect()
    assert [(r["_doc"], r["_text"]) for r in out] == [("mine0", 0), ("mine1", 1), ("mine2", 2)] and [r["n_removed"] for r in out] == [0, 2, 2]
