"""Operators without SQL against brute force: the fit, levels, tails of the tests, bands, marks, the core table."""
import math

import numpy as np
import pytest

from renewcast.config import Config
from renewcast.operators import bootstrap, core, dynamics, levels, maturation, relevance
from renewcast.plans.queries import CFG, QUERIES
from renewcast.sources import database
from renewcast.sources.extract import fine_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fine(spark):
    return fine_table(spark, SF, CFG).cache()


def test_fit(spark):
    rng = np.random.default_rng(3)
    rows = [(str(a), str(b), float(a * 0.1 + b * 0.02 + rng.normal(0, 0.03)), float(rng.integers(1, 50))) for a in range(4) for b in range(5) for _ in range(3)]
    df = spark.createDataFrame(rows, "a string, b string, rate double, w double")

    def brute(cols):
        x = np.column_stack([np.ones(len(rows))] + [[float(r[c] == v) for r in rows] for c in cols for v in sorted({r[c] for r in rows})])
        y, w = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
        fit = x @ np.linalg.lstsq(x * np.sqrt(w)[:, None], y * np.sqrt(w), rcond=None)[0]
        m = np.average(y, weights=w)
        return 1 - (w * (y - fit) ** 2).sum() / (w * (y - m) ** 2).sum()

    eq = relevance.normal_equations(df, ("a", "b"))
    for dims, cols in ((("a", "b"), (0, 1)), (("a",), (0,)), (("b",), (1,))):
        assert relevance.r_squared(eq, dims) == pytest.approx(brute(cols), abs=1e-9)
    order = [tuple(r) for r in relevance.collapse_order(spark, df, ("a", "b")).orderBy("place").collect()]
    assert [o[1] for o in order] == ["b", "a"]
    assert order[0][2] == pytest.approx(brute((0, 1)) - brute((0,)), abs=1e-4)


def test_empty_fit(spark):
    df = spark.createDataFrame([], "a string, rate double, w double")
    with pytest.raises(KeyError):
        relevance.normal_equations(df, ("a",))[0]["", ""]
    assert relevance.r_squared(relevance.normal_equations(df, ("a",)), ("a",)) == 0.0


def test_pass_plan(spark):
    rows = QUERIES["pass_plan"](spark, SF).orderBy("pass").collect()
    assert [r["pass"] for r in rows] == list(range(5)) and rows[0].name == "itself" and rows[2].name == "extra channel"
    assert rows[4].starred == "channel,product,region"


def test_levels(spark, fine):
    row = lambda v, d, r, s: {"value": v, "due_units": d, "ren_units": r, "expected": d * 0.5, "support": s}
    found = [row("2 a", 1000, 500, 40.0), row("10 a", 1000, 505, 40.0), row("x", 1000, 900, 40.0), row("rare", 10, 1, 2.0)]
    got = dict(levels.merge(found, Config()))
    assert got == {"2 a": "2 a + 10 a", "10 a": "2 a + 10 a", "x": "x", "rare": levels.RESIDUAL}
    assert levels.merge([], Config()) == []
    mapping = levels.levels(spark, fine, "product", CFG)
    assert mapping.count() == levels.values(fine, "product", CFG).count()
    assert levels.apply_levels(fine, "product", mapping).count() == fine.count()


def test_tails():
    def brute(f, a, b, n=400_000, top=4000.0):
        # the density's integral over f' = f .. infinity, by the midpoint rule on 1 / (1 + f')
        lo, hi = 0.0, 1 / (1 + f)
        u = lo + (np.arange(n) + 0.5) * (hi - lo) / n
        x = 1 / u - 1
        logc = math.lgamma((a + b) / 2) - math.lgamma(a / 2) - math.lgamma(b / 2) + a / 2 * math.log(a / b)
        return float((np.exp(logc + (a / 2 - 1) * np.log(x) - (a + b) / 2 * np.log1p(a / b * x)) / u**2).sum() * (hi - lo) / n)

    for f, a, b in ((1.0, 11, 20), (3.5, 11, 40), (0.2, 2, 30), (4.0, 1, 22), (9.0, 1, 50), (0.0, 3, 10)):
        got = dynamics.f_tail.func(*(__import__("pandas").Series([float(v)]) for v in (f, a, b)))[0]
        assert got == pytest.approx(brute(max(f, 1e-12), a, b), abs=2e-5)


def test_dynamics(spark):
    rows = QUERIES["dynamics_tests"](spark, SF).collect()
    assert rows and all(0 <= r.p_trend <= 1 and 0 <= r.p_month <= 1 and r.phi >= 0 for r in rows)


def test_bands(fine):
    rows = bootstrap.bands(fine, CFG).collect()
    assert len({r.cell for r in rows}) == len(rows)
    inside = [r.low <= r.uplift <= r.high for r in rows if r.low is not None and r.high - r.low > 1e-4]
    assert inside and sum(inside) / len(inside) > 0.95
    assert all(r.low is None for r in rows if r.origin == "global")


def test_poisson(spark):
    from pyspark.sql import functions as F

    r = spark.range(20_000).select(bootstrap.poisson(F.pmod(F.xxhash64("id"), F.lit(1 << 52)) / float(1 << 52)).alias("n")).agg(F.avg("n").alias("m"), F.var_samp("n").alias("v")).first()
    assert abs(r.m - 1) < 0.05 and abs(r.v - 1) < 0.05


def test_marks_to_come(spark, fine):
    rows = maturation.moves(fine, CFG).collect()
    assert all(0 < r.moved <= 1 and abs(r.to_dormant + r.to_softcancel + r.to_dormant_softcancel - r.moved) < 1e-5 for r in rows)
    before, after = QUERIES["forecast_rows"](spark, SF), QUERIES["matured_forecast"](spark, SF)
    assert after.count() == before.count()
    bad = after.where("abs(final_units - expected_units - delta_units) > 1e-9 OR ((dormant = 1 OR softcancel = 1) AND delta_units <> 0) OR moved_units > due_units")
    assert bad.count() == 0


def test_core(spark, fine):
    rows = QUERIES["core_table"](spark, SF).cache()
    assert rows.select("row_key").distinct().count() == rows.count()
    assert rows.where("source IN ('real', 'second_universe')").groupBy().sum("ren_units").first()[0] == fine.groupBy().sum("ren_units").first()[0]
    want = QUERIES["forecast_rows"](spark, SF).groupBy().sum("expected_units").first()[0]
    assert rows.where("source = 'forecast'").groupBy().sum("expected_units").first()[0] == pytest.approx(want, rel=1e-6)
    assert {r.name for r in core.legend(spark).collect()} <= set(rows.columns)


def test_database(spark, tmp_path):
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", str(tmp_path / "derby.log"))
    url, driver = "jdbc:derby:memory:renew;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    assert database.write_table(spark.range(1000).selectExpr("id", "id * 2 AS twice"), url, "numbers", driver=driver) == 1000
    got = database.read_query(spark, url, 'SELECT "id" AS k, "twice" AS twice FROM numbers WHERE "id" < 500', "K", ("0", "500"), 4, driver=driver)
    assert got.rdd.getNumPartitions() == 4 and got.count() == 500 and got.groupBy().sum("TWICE").first()[0] == 499 * 500
