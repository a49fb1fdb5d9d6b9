"""The licences' joins: what is shuffled and held for them, and odd rows of the source."""
import shutil

import duckdb

from renewcast.plans.oracle import _LICENCES
from renewcast.sources import extract

SF = "/root/testdata/sf0.001"


def test_lines_are_dealt_twice_and_never_sorted(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = extract.extract(spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Both sides of three joins, and the groups.
    assert plan.count("Exchange hashpartitioning") == 7 and "SortMergeJoin" not in plan
    # Prices and texts of the lines are whole numbers and flags before they are dealt.
    assert not [x for x in plan.splitlines() if "Exchange" in x and ("l_extendedprice" in x or "l_returnflag" in x)]


def test_odd_rows(spark, tmp_path, monkeypatch):
    """Nulls in keys and values, keys that nobody has, rows that share a key; more tasks than the session's."""
    monkeypatch.setattr(extract, "TASK_ROWS", 500)
    con, at = duckdb.connect(), str(tmp_path)
    for t in ("nation", "region"):
        shutil.copy(f"{SF}/{t}.parquet", at)
    odd = {"lineitem": {"l_orderkey": 7, "l_partkey": 11, "l_tax": 13, "l_discount": 17, "l_returnflag": 19, "l_linestatus": 23, "l_shipdate": 29, "l_quantity": 31, "l_extendedprice": 37},
           "orders": {"o_orderkey": 41, "o_custkey": 43, "o_orderstatus": 5, "o_orderpriority": 7}, "part": {"p_partkey": 37, "p_type": 5, "p_size": 7, "p_brand": 11}, "customer": {"c_custkey": 17, "c_nationkey": 7, "c_mktsegment": 5}}
    for t, columns in odd.items():
        nulls = ", ".join(f"CASE WHEN i % {n} <> 0 THEN {c} END AS {c}" for c, n in columns.items())
        con.execute(f"CREATE TABLE x AS SELECT *, row_number() OVER () AS i FROM '{SF}/{t}.parquet'")
        # Every tenth row is there twice.
        con.execute(f"COPY (SELECT * EXCLUDE i FROM (SELECT * REPLACE ({nulls}) FROM (FROM x UNION ALL FROM x WHERE i % 10 = 0))) TO '{at}/{t}.parquet'")
        con.execute("DROP TABLE x")
    for t in (*odd, "nation", "region"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at}/{t}.parquet'")
    got = extract.licences(spark, at)
    columns = [c for c in got.columns]
    want = con.execute(f"WITH {_LICENCES} SELECT {', '.join(columns)} FROM lic").fetchall()
    assert len(want) > 1000 and sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.collect())
