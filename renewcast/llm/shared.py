"""Session helpers shared by the corpus operators."""
from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``.  Where the session names none, a local one has a
    temporary folder; on a cluster, whose executors would not see it, that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("renewcast.shared.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="renewcast-shared-")
        spark.conf.set("renewcast.shared.dir", found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that lost executors cost no recomputation of
    the lineage above and later readers can prune columns.  The write's shuffle files go with its end instead of
    when the driver happens to collect its garbage.  path: where to, for a copy that is discarded later."""
    spark = df.sparkSession
    path = path or scratch(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a written copy."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class Copies:
    """Written copies of one job, which drops each by its name as soon as nothing that is still to run reads it."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.paths[name] = scratch(self.spark, name)
        return materialise(df, name, self.paths[name])

    def drop(self, *names: str) -> None:
        for name in names:
            discard(self.spark, self.paths.pop(name))


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of text in a table (0 for an empty one)."""
    return docs.agg(F.sum(F.octet_length(column)).alias("b")).first()["b"] or 0


def same_row(left: DataFrame, right: DataFrame, *keys: str):
    """Null-safe equality on ``keys``."""
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


def join_hot(rows: DataFrame, decided: DataFrame, *keys: str, copies: str = "copies", share: int = 1000) -> DataFrame:
    """The inner join of rows with decided, which has one row for each key of theirs and says how many ``copies`` the
    rows hold of it.  Keys that more than 1 / share of all rows have, fewer than ``share``, are broadcast, so that none
    of them fills a task; the others are joined by a shuffle.  Both tables are read several times."""
    total = decided.agg(F.sum(copies).alias("n")).first()["n"] or 0
    limit = max(share, total // share)
    hot, cold = decided.where(F.col(copies) > limit), decided.where(F.col(copies) <= limit)
    if not hot.limit(1).count():
        return rows.join(cold, list(keys))
    apart = rows.join(F.broadcast(hot.select(*keys)), list(keys), "left_anti").join(cold, list(keys))
    return apart.unionByName(rows.join(F.broadcast(hot), list(keys)))


def whole_groups(batches, rows: int = 1 << 16):
    """Tables of about so many rows, cut where ``at`` changes."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            at = table["at"].to_numpy()
            cut = int(np.searchsorted(at, at[-1]))
            if cut:
                yield table.slice(0, cut).combine_chunks()
            table = table.slice(cut).combine_chunks()
            held, n = table.to_batches(), table.num_rows
    if n:
        yield pa.Table.from_batches(held).combine_chunks()
