"""Every query against its SQL in DuckDB."""
import math
import os

import duckdb
import pytest

from renewcast.operators import passes
from renewcast.plans.covers import COVERS, READS, cover
from renewcast.plans.oracle import _LADDER, SQL, cover_sql, ladder_sql, report_sql
from renewcast.plans.pipeline import steps
from renewcast.plans.queries import CFG, QUERIES, report
from renewcast.plans.reports import REPORTS

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(values):
    def plain(v):
        if isinstance(v, float):
            return None if math.isnan(v) else float(f"{v:.9g}")
        return v

    # Rows stand by what isn't a fraction, so that a last digit doesn't change their places.
    return sorted((tuple(plain(v) for v in r) for r in values), key=lambda r: (str([v for v in r if not isinstance(v, float)]), str(r)))


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle(spark, duck, name):
    got, sql = QUERIES[name](spark, SF), SQL[name]
    if name in _LADDER:
        # The plan depends on the tables; SQL has it as values.
        plan = passes.read_plan(QUERIES["pass_plan"](spark, SF))
        sql = ladder_sql(_LADDER[name], [(p.number, p.name, ",".join(sorted(p.without)), p.merges, p.signed) for p in plan])
    columns = sorted(got.columns)
    assert sorted(d[0] for d in duck.execute(f"DESCRIBE SELECT * FROM ({sql})").fetchall()) == columns
    want = rows(duck.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall())
    have = rows(map(tuple, got.select(*columns).collect()))
    assert len(have) == len(want)
    bad = [(a, b) for a, b in zip(have, want) if not all(x == y or isinstance(x, float) and y is not None and abs(x - y) <= 2e-6 * max(1, abs(y)) for x, y in zip(a, b))]
    assert not bad, bad[:3]


#: Queries without SQL, and the test that looks at their values.
ELSEWHERE = {"collapse_order": "test_evidence", "pass_plan": "test_evidence", "level_groups": "test_evidence", "uplift_bands": "test_evidence", "matured_forecast": "test_evidence", "core_legend": "test_evidence"}


def test_every_query_is_tested():
    assert set(QUERIES) - set(SQL) == set(ELSEWHERE)


def test_one_scan(spark):
    """Plans read what steps have written: none scans the lines' table more than once."""
    for name in ("forecast_rows", "core_table", "series_exam", "risk_levels", "champion_choice", "series_estimate", "blended_rate"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("lineitem") <= 1, name


def compare(duck, got, sql):
    columns = sorted(got.columns)
    have, want = rows(map(tuple, got.select(*columns).collect())), rows(duck.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall())
    return len(have) == len(want) and all(x == y or isinstance(x, float) and y is not None and abs(x - y) <= 2e-6 * max(1, abs(y)) for a, b in zip(have, want) for x, y in zip(a, b))


@pytest.mark.parametrize("name", sorted(COVERS))
def test_covers_of_other_years(spark, duck, name):
    tables = steps(spark, SF, CFG)
    assert compare(duck, cover(name, {t: tables[t] for t in READS}, 1999, 2000), cover_sql(name, current_year=1999, next_year=2000))


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_reports_of_other_months(spark, duck, name):
    assert compare(duck, report(REPORTS[name], steps(spark, SF, CFG)["fine"], 23990), report_sql(name, 23990))
