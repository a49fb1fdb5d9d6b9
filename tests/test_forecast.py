"""The forecast's rates: every open row has one, at its own horizon, with the fallbacks of the reference."""
import math

import pytest

from renewcast.config import Config
from renewcast.operators import backtest as B
from renewcast.plans.queries import CFG, QUERIES
from renewcast.sources.extract import fine_table, units

SF = "/root/testdata/sf0.001"


def logit(p):
    return math.log(p / (1 - p))


def expit(x):
    return 1 / (1 + math.exp(-x))


def test_rates(spark):
    cfg, now = Config(), Config().current
    season = lambda o: 0.3 + 0.05 * (o % 12)
    old = [(o, round(1000 * season(o))) for o in range(now - 36, now)]
    pooled = spark.createDataFrame([("old", o, 1000, r) for o, r in old] + [("young", now - 2, 100, 40), ("young", now - 1, 100, 60), ("thin", now - 1, 100, 50)], "composition string, ord int, due_units long, ren_units long")
    members = spark.createDataFrame([("s1", "old", "uses"), ("s2", "young", "uses"), ("s2", "old", "lends"), ("s5", "thin", "uses")], "fs_id string, composition string, membership string")
    closed = [("s1", "EU", "A", o, 1000, r) for o, r in old] + [("s2", "EU", "A", now - 2, 100, 40), ("s2", "EU", "A", now - 1, 100, 60)]
    ahead = [(s, reg, "A", now + k, due, None) for s, reg, due in (("s1", "EU", 10), ("s2", "EU", 10), ("s3", "EU", 10), ("s4", "NA", 0), ("s5", "NA", 10)) for k in range(9)]
    rows = spark.createDataFrame(closed + ahead, "fs_id string, region string, product string, ord int, due_units long, ren_units long")
    decision = spark.createDataFrame([("old", 1, "T3_ma3"), ("old", 6, "T15_level_seasonal")], "composition string, h int, technique string")
    bands = spark.createDataFrame([("T3_ma3", 1, -1.0, 1.0), ("T3_ma3", 6, -2.0, 2.0)], "technique string, h int, q_low double, q_high double")
    weights = spark.createDataFrame([("s1", 1.0, 0.5, None), ("s2", 0.25, 0.5, 0.8), ("s5", 0.5, 1.0, 0.5)], "fs_id string, z double, own_rate double, reference_rate double")
    got = {(r.fs_id, r.h): r for r in B.forecast(pooled, members, rows, decision, bands, weights, cfg).collect()}
    assert len(got) == len(ahead) and all(r.rate is not None and r.rate_low <= r.rate <= r.rate_high for r in got.values())
    # Seasonal from the second month on: each aims at its own calendar month.
    for h in range(2, 10):
        assert got["s1", h].technique == "T15_level_seasonal" and got["s1", h].rate == pytest.approx(season(now + h - 1), abs=0.01)
    assert got["s1", 1].rate == pytest.approx(expit(sum(logit(r / 1000) for _, r in old[-3:]) / 3))
    young = expit((logit(0.4) + logit(0.6)) / 2 + 0.75 * (logit(0.8) - logit(0.5)))
    assert got["s2", 4].technique == "T3_ma3" and got["s2", 4].rate == pytest.approx(young)
    assert got["s5", 3].rate == pytest.approx(0.5)
    due, ren = sum(r[4] for r in closed), sum(r[5] for r in closed)
    assert got["s3", 1].rate == pytest.approx(ren / due) and got["s3", 1].origin == "cell"
    assert got["s4", 1].rate == pytest.approx(ren / due) and got["s4", 1].origin == "global" and got["s4", 1].expected_units == 0
    se = math.sqrt(got["s1", 5].rate * (1 - got["s1", 5].rate) / 10)
    assert got["s1", 5].rate_high == pytest.approx(min(1, got["s1", 5].rate + 2 * se))


def test_every_open_row(spark):
    fine = fine_table(spark, SF, CFG)
    want = units(fine, CFG).where(f"ord >= {CFG.current}").count()
    got = QUERIES["forecast_rows"](spark, SF).cache()
    assert got.count() == got.select("fs_id", "ord").distinct().count() == want
    assert got.where("rate IS NULL OR rate_low IS NULL OR rate_high IS NULL OR expected_units IS NULL").count() == 0
    assert QUERIES["core_table"](spark, SF).where("source = 'forecast' AND expected_units IS NULL").count() == 0
