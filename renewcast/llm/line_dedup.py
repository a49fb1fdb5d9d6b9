"""Line dedup: repeated runs of lines, found by a suffix array over line ids; later copies are deleted.

A text is a sequence of lines (ended by newlines); blank lines take no part.  A run of at least ``min_words``
words in whole consecutive lines is repeated if the same lines, one after another, start in a document with a
smaller id; every line in such a run is removed.  Runs are judged on the input, not on what is left.

The suffixes of all line sequences are ranked by distributed prefix doubling: rank k orders them by their
first 2**k lines, being the order of pairs of ranks k - 1; each round names the distinct pairs by a running
sum over range partitions.  Suffixes that are alone with their pair have no repeat that long and leave.
Suffixes that agree on their first m lines lie in one interval of the suffix array with a longest common
prefix of m or more; such an interval is a pair of overlapping ranks k, with 2**k <= m.  A run of min_words
words is a union of its shortest runs of that many words, forwards from each line and backwards from each
line, so the order is needed only as deep as the shortest runs are long (``min_words`` lines at most).
Maximal runs come out as the unions of the intervals' lines.

All steps are DataFrame operations.  Lines are compared by 64-bit hashes, joined along runs.  Nulls stay null
and have no lines; empty and blank texts lose nothing.  Equal rows get equal results; rows that share an id
with different texts are one document's pieces, none earlier than the other.  Rows without an id lose
nothing and are never earlier.  Other columns are kept, whatever their names but those of the result, which
are replaced.  An empty table gives no rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renewcast.llm.shared import join_hot, materialise

WORD = r"[^\x20\x09-\x0D]+"
KEY = ["_doc", "_text"]


def _lines(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """One row for each line that isn't blank: document, hash of the whole text, line number, hash, words."""
    base = docs.select(F.col(doc_id).alias("_doc"), F.xxhash64(text).alias("_text"), F.col(text).alias("t")).where("_doc IS NOT NULL AND t IS NOT NULL")
    rows = base.select("_doc", "_text", F.posexplode(F.split("t", "\n")).alias("line_no", "line"))
    return rows.select("_doc", "_text", "line_no", F.xxhash64("line").alias("line"), F.regexp_count("line", F.lit(WORD)).alias("words")).where("words > 0")


def _runs(lines: DataFrame, min_words: int) -> DataFrame:
    """The lines that occur in several documents, by place among the document's lines, with the lengths (in
    lines) of the shortest runs that begin (m_to) and end (m_from) there, where these hold repeated lines only."""
    lines = materialise(lines, "all-lines")
    counts = materialise(lines.groupBy("line").agg((F.min("_doc") < F.max("_doc")).cast("int").alias("r"), F.count(F.lit(1)).alias("copies")), "line-counts")
    rows = join_hot(lines, counts, "line")
    doc = Window.partitionBy(*KEY)
    by_line = doc.orderBy("line_no")
    rows = rows.select("*", F.row_number().over(by_line).alias("place"), F.sum("words").over(by_line).cast("long").alias("upto"))
    rows = rows.withColumn("begun", F.col("upto") - F.col("words"))
    ahead, back = doc.orderBy("begun").rangeBetween(0, min_words - 1), doc.orderBy("upto").rangeBetween(1 - min_words, 0)

    def shortest(w):
        n = F.count(F.lit(1)).over(w)
        return F.when((F.sum("words").over(w) >= min_words) & (F.sum("r").over(w) == n), n).cast("int")

    return rows.select(*KEY, "place", "line_no", "line", "r", shortest(ahead).alias("m_to"), shortest(back).alias("m_from")).where("r = 1").drop("r")


def _ranked(pairs: DataFrame) -> DataFrame:
    """rank of each pair (a, b) that occurs more than once: the suffixes before it."""
    counts = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = materialise(counts.repartitionByRange("a", "b").select("a", "b", "n", F.spark_partition_id().alias("part")), "pairs")
    sums = dealt.groupBy("part").agg(F.sum("n").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("a", "b")) - F.col("n")
    return dealt.join(F.broadcast(sums), "part").select("a", "b", (F.col("before") + inside).alias("rank"))


def repeated_runs(docs: DataFrame, min_words: int = 50, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(_doc, _text, spans): the maximal runs of lines to delete, first and last line number of each."""
    docs_lines = _lines(docs, text, doc_id).distinct()
    rows = materialise(_runs(docs_lines, min_words), "lines")
    wanted = (rows.select(*KEY, "place", F.col("m_to").alias("m")).where("m IS NOT NULL")
              .union(rows.select(*KEY, (F.col("place") - F.col("m_from") + 1).alias("place"), F.col("m_from").alias("m")).where("m IS NOT NULL")).distinct())
    wanted = materialise(wanted, "wanted")
    longest = wanted.agg(F.max("m").alias("m")).first()["m"] or 0
    level, width, late = rows.select(*KEY, "place", F.col("line").alias("rank")), 1, None
    while width <= longest:
        # Windows of width to 2 width - 1 lines are pairs of overlapping ranks of this level.
        here = wanted.where(F.col("m").between(width, 2 * width - 1))
        ends = level.select(*KEY, F.col("place").alias("last"), F.col("rank").alias("b"))
        pairs = here.withColumn("last", F.col("place") + F.col("m") - width).join(level.withColumnRenamed("rank", "a"), [*KEY, "place"]).join(ends, [*KEY, "last"]).select(*KEY, "place", "m", "a", "b")
        # Each level is a plan of its own: all in one would have the driver hold them, and plan the rest anew, at once.
        pairs = materialise(pairs, "windows")
        least = pairs.groupBy("m", "a", "b").agg(F.min("_doc").alias("least"), F.max("_doc").alias("most")).where("least < most").drop("most")
        found = materialise(pairs.join(least, ["m", "a", "b"]).where("least < _doc").select(*KEY, "place", "m"), "late")
        late = found if late is None else late.unionByName(found)
        if 2 * width <= longest:
            w = Window.partitionBy(*KEY).orderBy("place")
            step = level.select("*", F.lead("rank", width).over(w).alias("b"), F.lead("place", width).over(w).alias("at")).where(F.col("at") == F.col("place") + width)
            step = step.select(*KEY, "place", F.col("rank").alias("a"), "b")
            level = materialise(step.join(_ranked(step), ["a", "b"]).select(*KEY, "place", "rank"), "ranks")
        width *= 2
    if late is None:
        return rows.limit(0).select(*KEY, F.array().cast("array<struct<a:int,b:int>>").alias("spans"))
    # Union of the windows' lines by document: a span ends where no window reaches further.
    doc = Window.partitionBy(*KEY).orderBy("place")
    ends = late.groupBy(*KEY, "place").agg(F.max(F.col("place") + F.col("m") - 1).alias("last"))
    reach = F.max("last").over(doc.rowsBetween(Window.unboundedPreceding, -1))
    spans = ends.select("*", F.when(F.col("place") <= reach + 1, 0).otherwise(1).alias("new")).select("*", F.sum("new").over(doc).alias("span"))
    spans = spans.groupBy(*KEY, "span").agg(F.min("place").alias("place"), F.max("last").alias("last"))
    # From places among lines that aren't blank to line numbers.
    number = rows.select(*KEY, "place", "line_no")
    spans = spans.join(number, [*KEY, "place"]).withColumnRenamed("line_no", "a").drop("place")
    spans = spans.join(number.withColumnRenamed("place", "last"), [*KEY, "last"]).withColumnRenamed("line_no", "b")
    return spans.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans"))


def line_dedup(docs: DataFrame, min_words: int = 50, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs with its text cut, and n_lines, n_removed (blank lines in between included) and spans."""
    found = repeated_runs(docs, min_words, text, doc_id)
    base = docs.drop("n_lines", "n_removed", "spans")
    names = base.columns
    # The rows travel as one column, so that none of theirs can clash with the operator's own.
    joined = base.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col(doc_id).alias("_doc"), F.xxhash64(text).alias("_text")).join(found, KEY, "left")
    body = F.col("row").getField(text)
    lines = F.split(body, "\n")
    out = F.array_join(F.filter(lines, lambda x, i: ~F.exists("spans", lambda s: (s["a"] <= i) & (i <= s["b"]))), "\n")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"] + 1)
    return joined.select(*(F.when(F.col("spans").isNull(), body).otherwise(out).alias(c) if c == text else F.col("row").getField(c).alias(c) for c in names),
                         F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(removed, F.lit(0)).alias("n_removed"), F.coalesce("spans", F.array().cast("array<struct<a:int,b:int>>")).alias("spans"))


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, n_spans, kept_sha256 of every document."""
    out = line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


#: The same in DuckDB, where a run is the text of its lines.
OP9_SQL = r"""
WITH split AS (SELECT DISTINCT doc_id, text, string_split(text, chr(10)) AS ls FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
each AS (SELECT doc_id, text, line_no, ls[line_no] AS line, len(regexp_extract_all(ls[line_no], '[^\x20\x09-\x0D]+')) AS words
         FROM (SELECT doc_id, text, ls, unnest(range(1, len(ls) + 1)) AS line_no FROM split)),
placed AS (SELECT *, row_number() OVER w AS place, sum(words) OVER w AS upto FROM each WHERE words > 0 WINDOW w AS (PARTITION BY doc_id, text ORDER BY line_no)),
lists AS (SELECT doc_id, text, list(line ORDER BY place) AS ls, list(line_no ORDER BY place) AS nos FROM placed GROUP BY doc_id, text),
frames AS (
  SELECT doc_id, text, place AS first, place + count(*) OVER a - 1 AS last, sum(words) OVER a AS total FROM placed
  WINDOW a AS (PARTITION BY doc_id, text ORDER BY upto - words RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION
  SELECT doc_id, text, place - count(*) OVER b + 1, place, sum(words) OVER b FROM placed
  WINDOW b AS (PARTITION BY doc_id, text ORDER BY upto RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
runs AS (SELECT f.doc_id, f.text, first, last, nos, array_to_string(ls[first:last], chr(10)) AS run FROM frames f JOIN lists l ON f.doc_id = l.doc_id AND f.text = l.text WHERE total >= 50),
least AS (SELECT run, min(doc_id) AS least FROM runs GROUP BY run),
late AS (SELECT doc_id, text, first, last, nos FROM runs JOIN least USING (run) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, text, unnest(range(first, last + 1)) AS place FROM late),
islands AS (SELECT doc_id, text, min(place) AS a, max(place) AS b FROM (SELECT *, place - row_number() OVER (PARTITION BY doc_id, text ORDER BY place) AS g FROM gone) GROUP BY doc_id, text, g),
spans AS (SELECT i.doc_id, i.text, l.nos[a] AS a, l.nos[b] AS b FROM islands i JOIN lists l ON i.doc_id = l.doc_id AND i.text = l.text),
cut AS (SELECT doc_id, text, count(*) AS n_spans, sum(b - a + 1) AS n_removed, flatten(list(range(a, b + 1))) AS lines FROM spans GROUP BY doc_id, text)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(CASE WHEN c.lines IS NULL THEN coalesce(d.text, '') ELSE array_to_string([string_split(d.text, chr(10))[i] FOR i IN range(1, len(string_split(d.text, chr(10))) + 1) IF NOT list_contains(c.lines, i)], chr(10)) END) AS kept_sha256
FROM documents d LEFT JOIN cut c ON d.doc_id = c.doc_id AND d.text = c.text
"""
