"""What the operators leave behind, and how large the plans are that the driver holds."""
import os
import time
from urllib.parse import urlparse

from pyspark.sql import functions as F

from renewcast.llm.components import components
from renewcast.llm.line_dedup import repeated_runs
from renewcast.llm.shared import materialise, shared_dir
from renewcast.llm.suffix_dedup import suffix_dedup


def test_written_copies_leave_no_shuffle_files(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in (found.apply(i).getName() for i in range(found.size())) if f.startswith("shuffle_") and f.endswith(".data")}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(key), files()
    out = materialise(spark.range(10000).groupBy((F.col("id") % 100).alias("k")).count(), "counted")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and out.count() == 100 and spark.conf.get(key) == setting


def test_long_runs_make_no_larger_plan(spark):
    """Runs of 40 lines take six levels, none of which is in the result's plan."""
    lines = "\n".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, lines), (2, lines), (3, "x\n" + lines)], "doc_id long, text string")
    found = repeated_runs(df, 40)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") <= 2
    assert sorted((r["_doc"], [tuple(s) for s in r["spans"]]) for r in found.collect()) == [(2, [(0, 59)]), (3, [(1, 60)])]


def test_a_job_drops_its_copies_and_sketches(spark):
    """Of byte dedup only what is to be removed stays written, no sketch stays broadcast, and the texts' plan has no
    join but that with what is removed."""
    shared, temp = urlparse(shared_dir(spark)).path, spark.sparkContext._temp_dir
    text = " ".join(f"w{i * i % 997}" for i in range(400))
    rows = [(1, text), (2, text), (3, "other " + text[100:900]), (4, text[30:300] + "x" + text[50:400])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before, held = set(os.listdir(shared)), set(os.listdir(temp))
    out = suffix_dedup(docs)
    assert [f.split("-")[0] for f in set(os.listdir(shared)) - before] == ["removed"] and not set(os.listdir(temp)) - held
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    assert [r["n_bytes"] > r["n_removed"] > 0 for r in out.orderBy("doc_id").collect()] == [False, False, True, True]


def test_components_end_when_flat(spark):
    """A chain and a star of a large centre; what is flat from the start takes no round and one look."""
    def jobs(rows):
        tracker, group = spark.sparkContext.statusTracker(), f"flat{len(rows)}"
        spark.sparkContext.setJobGroup(group, group)
        got = {tuple(r) for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
        found = len(tracker.getJobIdsForGroup(group))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return got, found

    chain = [(i, i + 1) for i in range(1, 20)] + [(100, i) for i in range(50, 60)] + [(7, 7)]
    got, several = jobs(chain)
    assert got == {(i, 1) for i in range(1, 21)} | {(i, 50) for i in range(50, 60)} | {(100, 50)}
    got, few = jobs([(i, 1) for i in range(2, 9)] + [(1, 3)])
    assert got == {(i, 1) for i in range(1, 9)} and few <= 8 < several
