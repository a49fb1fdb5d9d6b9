"""The corpus pipeline: five stages over ``documents``, each written and reread as the next one's input.

1. toxicity: documents scored 0.5 or more go;
2. line dedup: later copies of repeated runs of lines go from the texts, and texts that they emptied;
3. Jaccard join: of each group of near copies (80 % of shingles of five words), the document with the smallest id stays;
4. benchmark decontamination: spans of benchmark words go from the texts, and documents that are mostly such;
5. BPE: token ids, their number and the digest of what they decode to are added.

Where a stage changes a text, ``n_chars`` follows it.

Null, empty and wordless texts are near copies of nothing, stay as they are and have no tokens.  Rows that share an id
are judged by their texts, each alone; of equal rows one stays, and of copies a row without an id goes first.  Very long
texts are taken whole.  Columns other than those of documents are dropped, whatever their names; an empty table gives no
rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from renewcast.llm.bpe import encode
from renewcast.llm.decontaminate import decontaminate
from renewcast.llm.jaccard_join import jaccard_join
from renewcast.llm.line_dedup import line_dedup
from renewcast.llm.shared import materialise, same_row
from renewcast.llm.toxicity import learn, score

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: What near copies are in this stage; op6's 85 % of four words are its own.
PERCENT, GRAM = 80, 5


def _resized(docs: DataFrame, changed) -> DataFrame:
    return docs.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return score(docs, learn(spark, docs, sf_dir)).where("score < 0.5").select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup(docs).where((F.col("n_removed") == 0) | (F.trim("text") != ""))
    return _resized(out, F.col("n_removed") > 0)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked texts the row with the smallest (id, hash of the text) stays, rows without an id
    last.  Documents without words are in no group and stay; of equal rows, one stays."""
    key = ["doc_id", "text_hash"]
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    groups = jaccard_join(docs, percent=PERCENT, gram=GRAM, carry=("text_hash",)).where("n_shingles > 0").select(*key, "component")
    rows = materialise(groups.groupBy(*key).agg(F.first("component").alias("component"), F.count(F.lit(1)).alias("k")), "grouped")
    first = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("bare"), *key)).alias("first"))
    leaders = materialise(first.select("first.doc_id", "first.text_hash"), "leaders")
    # Most rows stay, so the rows are held against those that go.
    gone = materialise(rows.join(leaders, same_row(rows, leaders, *key), "left_anti").select(*key), "gone")
    kept = docs.join(gone, same_row(docs, gone, *key), "left_anti")
    several = materialise(rows.where("k > 1").join(leaders, same_row(rows, leaders, *key), "left_semi").select(*key), "several")
    if not several.limit(1).count():
        return kept.select(*COLUMNS)
    single = kept.join(several, same_row(kept, several, *key), "left_anti")
    equal = kept.join(several, same_row(kept, several, *key), "left_semi")
    one = equal.withColumn("i", F.row_number().over(Window.partitionBy(*key).orderBy("lang", "source", "n_chars"))).where("i = 1")
    return single.select(*COLUMNS).unionByName(one.select(*COLUMNS))


def clean_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("NOT dropped")
    changed = ~F.col("text").eqNullSafe(F.col("clean"))
    return out.withColumn("n_chars", F.when(changed, F.length("clean").cast("long")).otherwise(F.col("n_chars"))).withColumn("text", F.col("clean")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = encode(docs, decoded="decoded")
    return coded.select(*COLUMNS, "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity), ("line dedup", dedup_lines), ("n-gram Jaccard join", near_copies), ("benchmark decontamination", clean_benchmark), ("BPE encoding and decoding", tokens)]
#: Scores, shingle sets and token ids have no SQL; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
