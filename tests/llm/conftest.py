import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH")) if x)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
         .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


#: Nulls, empties, ties, repeated ids and texts, white space of all kinds.
ODD = [(1, None, "x"), (2, "", "x"), (3, " \t\n", None), (4, "one two three", "y"), (4, "one two three", "y"), (5, "one two three", "y"), (6, "é ü \x0b z", "y"), (None, "one two three", "n")]


@pytest.fixture(scope="session")
def odd(spark):
    long = " ".join(f"w{i % 97}x{i % 13}" for i in range(3000))
    rows = [*ODD, (7, long, "z"), (8, long, "z"), (9, "start here " + long + " and end", "z"), (10, "aaaa" * 200, "z"), (11, "b" + "aaaa" * 90, "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, gone string")
