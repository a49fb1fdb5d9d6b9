"""The exam of series against a reckoning by hand."""
import math

import pytest
from pyspark.sql import functions as F

from renewcast.config import Config
from renewcast.operators import exam as EX
from renewcast.operators import ladder as L
from renewcast.operators import universe as U


def logit(p):
    return math.log(p / (1 - p))


def expit(x):
    return 1 / (1 + math.exp(-x))


@pytest.fixture(scope="module")
def detail(spark):
    cfg, now = Config(), Config().current
    # s1 has three years, s2 two months before the exam, s3 none; each of them falls due in the exam's last month.
    due = {("s1", o): (100, 40 + o % 12) for o in range(now - 36, now)} | {("s2", now - 9): (50, 20), ("s2", now - 8): (50, 30), ("s2", now - 1): (50, 25), ("s3", now - 1): (20, 5)}
    rows = [(s, "EU", p, 0, 0, 0, "web", "neutro", o, "examen" if o >= cfg.exam else "entrenamiento", d, r) for (s, o), (d, r) in due.items() for p in (["A"] if s != "s3" else ["B"])]
    units = spark.createDataFrame(rows, "fs_id string, region string, product string, dormant int, softcancel int, autorenew int, channel string, sign string, ord int, role string, due_units long, ren_units long")
    pooled = units.where("fs_id <> 's3'").groupBy(F.lit("c").alias("composition"), "ord").agg(F.sum("due_units").alias("due_units"), F.sum("ren_units").alias("ren_units"))
    decision = spark.createDataFrame([("c", 1, "T2_mean")], "composition string, h int, technique string")
    bands = spark.createDataFrame([("T3_ma3", 1, -1.0, 1.0), ("T3_ma3", 6, -2.0, 2.0)], "technique string, h int, q_low double, q_high double")
    weights = spark.createDataFrame([("s1", "c", "region=EU|product=A|sign=neutro", 0.5), ("s2", "c", None, 1.0)], "fs_id string, composition string, reference string, z double")
    out = EX.detail(units, L.patterns(units, cfg), pooled, decision, bands, weights, cfg).cache()
    return due, out, {(r.fs_id, r.ord, r.h, r.method): r for r in out.collect()}


def test_methods(detail):
    due, _, got = detail
    now = Config().current
    real = [(s, o) for s, o in due if o >= Config().exam]
    assert set(got) == {(s, o, h, m) for s, o in real for h in (1, 6) for m in EX.METHODS} and all(r.pred_rate is not None for r in got.values())
    for h, k in ((1, "T2_mean"), (6, "T3_ma3")):
        t, last = now - 1, now - 1 - h
        known = {x: v for x, v in due.items() if x[1] <= last}
        pool = {o: [sum(v[i] for (_, p), v in known.items() if p == o) for i in (0, 1)] for o in sorted({p for _, p in known})}
        y = [logit(r / d) for d, r in pool.values()]
        comp = expit(sum(y) / len(y) if k == "T2_mean" else sum(y[-3:]) / 3)
        assert got["s2", t, h, "framework"].pred_rate == pytest.approx(comp) and got["s2", t, h, "framework"].technique == k
        # The reference has the composition's own months here, so nothing is moved.
        assert got["s1", t, h, "framework"].shift == pytest.approx(0, abs=1e-9) and got["s1", t, h, "framework"].pred_rate == pytest.approx(comp)
        total = [sum(v[i] for v in known.values()) for i in (0, 1)]
        assert got["s3", t, h, "framework"].pred_rate == pytest.approx(total[1] / total[0]) and got["s3", t, h, "raw"].technique == "mandatory_cell"
        s2 = [v for (s, _), v in known.items() if s == "s2"]
        assert got["s2", t, h, "raw"].technique == "own_level" and got["s2", t, h, "raw"].pred_rate == pytest.approx(sum(r for _, r in s2) / sum(d for d, _ in s2))
        mine = [logit(v[1] / v[0]) for (s, o), v in sorted(known.items()) if s == "s1"]
        assert got["s1", t, h, "raw"].pred_rate == pytest.approx(expit(sum(mine) / len(mine) if k == "T2_mean" else sum(mine[-3:]) / 3))
        year = [v for (_, o), v in known.items() if o > last - 12]
        sheet = sum(r for _, r in year) / sum(d for d, _ in year)
        assert got["s1", t, h, "hoja_global"].pred_rate == pytest.approx(sheet) and got["s3", t, h, "hoja_mandatory"].pred_rate == pytest.approx(sheet)
        assert got["s1", t, h, "hoja_global"].in_band is None
        r = got["s1", t, h, "framework"]
        assert r.band_high == pytest.approx(min(1, r.pred_rate + h ** (1 / 6 if h == 1 else math.log(2) / math.log(6)) * math.sqrt(r.pred_rate * (1 - r.pred_rate) / 100)))


def test_sums(detail):
    due, rows, got = detail
    per = {r.fs_id: r for r in EX.per_series(rows).collect()}
    assert sum(r.framework_predictions for r in per.values()) == sum(1 for x in got if x[3] == "framework")
    mine = [r for x, r in got.items() if x[0] == "s1" and x[3] == "raw"]
    assert per["s1"].raw_mae_pp == pytest.approx(sum(abs(r.err_pp) for r in mine) / len(mine))
    real = 2 * sum(v[1] for (_, o), v in due.items() if o >= Config().exam)
    months = EX.by_month(rows).collect()
    assert all(sum(r.real_units for r in months if r.method == m) == real for m in EX.METHODS)
    for r in EX.summary(rows).collect():
        of = [x for k, x in got.items() if k[3] == r.method and k[2] == r.h]
        assert r.wape_series == pytest.approx(sum(abs(x.err_units) for x in of) / sum(x.real_units for x in of))


def test_second_universe_share(spark):
    """A region without last year's month takes its share of the total."""
    cfg, now = Config(), Config().current
    rows = [("EU", 1, o, 100, 10, 10 * 20000) for o in range(now - 24, now)] + [("NA", 1, now - 1, 100, 40, 40 * 20000)] + [("EU", 0, now - 2, 100, 50, 0)]
    fine = spark.createDataFrame(rows, "region string, ts int, ord int, due_units long, ren_units long, ren_value long")
    got = {(r.region, r.origin, r.ord): r for r in U.second_universe(fine, cfg).collect()}
    eu, na = got["EU", U.PROJECTED, now], got["NA", U.PROJECTED, now]
    assert (eu.units, eu.level, eu.by_share) == (10, 1, 0) and na.by_share == 1
    assert na.units == pytest.approx(10 * (70 / 30) * (40 / 160), abs=1e-3) and na.value == pytest.approx(na.units, abs=1e-3)
    assert got["NA", U.REENTRY, now + 12].rate_level == "global" and got["EU", U.REENTRY, now + 12].revenue == pytest.approx(10 / 0.6 * 0.5, abs=1e-3)
