"""Dynamics of series, overlapping segments and the series' backtest against reckonings by hand."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from renewcast.config import Config
from renewcast.operators import dynamics as D
from renewcast.operators import segments as G
from renewcast.operators import series_backtest as B
from renewcast.operators.dynamics import beta_tail

NOW = Config().current
#: Renewed of due by months before the open ones.
SERIES = {
    "still": {k: (100, 40) for k in range(1, 37)},
    "rising": {k: (1000, 900 - 15 * k + (7 if k % 5 else -28)) for k in range(1, 31)},
    "seasonal": {k: (400, 300 if (NOW - k) % 12 in (0, 1) else 200 + k % 3) for k in range(1, 49)},
    "thin": {k: (10, k % 4) for k in range(1, 15)},
    "short": {k: (500, 100) for k in range(1, 6)},
    "new": {},
}


def frame(spark):
    rows = [(s, NOW - k, "neutro", d, r) for s, months in SERIES.items() for k, (d, r) in months.items()] + [("still", NOW - 40, "neutro", 0, 0), ("new", NOW, "neutro", 70, None)]
    return spark.createDataFrame(rows, "fs_id string, ord int, sign string, due_units long, ren_units long").withColumn("due_cents", F.col("due_units") * 100)


def trend(months):
    """Slope in points a year and its p-value by weighted least squares."""
    o = np.array(sorted(NOW - k for k in months))
    d, r = (np.array([months[NOW - x][i] for x in o], float) for i in (0, 1))
    t, y, w = (o - o[0]) / 12, r / d, d / d.mean()
    X = np.column_stack([np.ones_like(t), t])
    A = X.T @ (w[:, None] * X)
    beta = np.linalg.solve(A, X.T @ (w * y))
    rss = (w * (y - X @ beta) ** 2).sum()
    f = beta[1] ** 2 / (rss / (len(y) - 2) * np.linalg.inv(A)[1, 1])
    df = len(y) - 2
    p = beta_tail(np.array([df / (df + f)]), np.array([df / 2]), np.array([0.5]))[0]
    return 100 * beta[1], p


@pytest.fixture(scope="module")
def dynamics(spark):
    units = frame(spark)
    chosen = spark.createDataFrame([(s, "c" if s != "short" else "d") for s in SERIES], "fs_id string, composition string")
    summary = units.where(F.col("ord") < NOW).groupBy("fs_id").agg(F.median(F.when(F.col("due_units") > 0, F.col("due_units").cast("double"))).alias("support"))
    tested = spark.createDataFrame([("c", 1, 0)], "composition string, trend int, seasonal int")
    return G.series_dynamics(chosen, summary, units, tested, Config()).cache()


def test_series_dynamics(dynamics):
    got = {r.fs_id: r for r in dynamics.collect()}
    assert {s: r.measurable for s, r in got.items()} == {"still": "yes", "rising": "yes", "seasonal": "yes", "thin": "low_support", "short": "short_history", "new": "short_history"}
    assert {s: r.months for s, r in got.items()} == {s: len(m) for s, m in SERIES.items()}
    # A rate that never moves has neither trend nor season, whatever the last digits say.
    still = got["still"]
    assert (still.trend, still.p_trend, still.seasonal, still.high, still.low, still.differs) == (0, 1.0, 0, "", "", 0)
    for s in ("rising", "seasonal", "thin"):
        slope, p = trend(SERIES[s])
        assert got[s].trend_pp == pytest.approx(slope, abs=1e-5) and got[s].p_trend == pytest.approx(p, abs=1e-5) and got[s].trend == (np.sign(slope) if p < 0.05 else 0)
    assert got["rising"].trend == 1 and got["rising"].differs == got["rising"].seasonal
    assert (got["seasonal"].seasonal, got["seasonal"].high, got["seasonal"].differs) == (1, "1,2", 1)
    # Too few months for a season; none for anything.
    assert got["thin"].seasonal is None and got["thin"].differs == 0
    assert got["short"].phi is None and got["short"].composition_trend is None and got["new"].own_support == 0


def test_segments_overlap(spark, dynamics):
    rows = [(s, 2, i % 3, 10.0 * i + 1, 10 * i + 2, 3.0 + i, 1, 1, 9.0 * i, 10 * i + 2, 5.0 + i) for i, s in enumerate(SERIES)] + [("unknown", 2, 2, 5.0, 5, 0.0, 2, 2, 5.0, 5, 0.0), ("unused", 0, None, None, None, None, 1, 1, 1.0, 1, 1.0)]
    of = lambda m: ", ".join(f"{m}_{c} {t}" for c, t in (("predictions", "long"), ("in_band", "long"), ("pred_units", "double"), ("real_units", "long"), ("abs_err_units", "double")))
    per = spark.createDataFrame(rows, "fs_id string, " + of("framework") + ", " + of("raw"))
    got = {r.segment: r for r in G.exam_segments(per, dynamics).collect()}
    d = {r.fs_id: r for r in dynamics.collect()}
    sure = {s for s, r in d.items() if r.measurable == "yes"}
    members = {"all": {*SERIES, "unknown"}, "low_phi": {s for s, r in d.items() if r.phi is not None and r.phi <= 1.5}, "high_phi": {s for s, r in d.items() if r.phi is not None and r.phi > 1.5}, "trend": {s for s in sure if d[s].trend}, "no_trend": {s for s in sure if not d[s].trend},
               "seasonal": {s for s in sure if d[s].seasonal == 1}, "not_seasonal": {s for s in sure if d[s].seasonal == 0}, "not_measurable": {*SERIES, "unknown"} - sure}
    assert set(got) == {m for m, who in members.items() if who} and sum(len(x) for x in members.values()) > 2 * len(SERIES)
    for m, who in members.items():
        mine = [r for r in rows if r[0] in who]
        if mine:
            assert got[m].series == len(who) and got[m].predictions == 2 * len(who)
            assert got[m].wape == pytest.approx(sum(r[5] for r in mine) / sum(r[4] for r in mine)) and got[m].bias == pytest.approx(sum(r[3] for r in mine) / sum(r[4] for r in mine) - 1)
            assert got[m].in_band_raw == pytest.approx(sum(r[7] for r in mine) / sum(r[6] for r in mine))
    assert G.exam_segments(per.limit(0), dynamics).count() == 0


def test_portfolio(spark):
    months = {r.ord: r for r in G.portfolio(frame(spark), Config()).collect()}
    assert months[NOW - 1].due_units == sum(m[1][0] for m in SERIES.values() if 1 in m) and NOW - 40 in months and NOW not in months
    row = D.tests(G.portfolio(frame(spark), Config())).first()
    assert row.composition == G.PORTFOLIO and row.months == len(months)


def test_series_backtest(spark):
    """Two series of a composition, one moved to its reference; ties of techniques share a rank."""
    cfg = Config()
    units = spark.createDataFrame([(s, "EU", p, NOW - k, d, r) for s, p, months in (("a", "x", {1: (50, 20), 2: (40, 30), 8: (100, 50)}), ("b", "x", {1: (30, 10), 8: (10, 2)}), ("z", "y", {8: (100, 20)})) for k, (d, r) in months.items()], "fs_id string, region string, product string, ord int, due_units long, ren_units long")
    pooled = units.where("fs_id <> 'z'").groupBy(F.lit("c").alias("composition"), "ord").agg(F.sum("due_units").alias("due_units"), F.sum("ren_units").alias("ren_units"))
    predictions = spark.createDataFrame([("c", NOW - k, h, t, p, "examen") for k in (1, 2) for h in (1, 6) for t, p in (("T2_mean", 0.5), ("T3_ma3", 0.5), ("T3_ma6", 0.25))] + [("c", NOW - 5, 1, "T2_mean", 0.1, "seleccion")], "composition string, ord int, h int, technique string, predicted double, purpose string")
    decision = spark.createDataFrame([("c", 1, "T3_ma6"), ("c", 6, "T2_mean")], "composition string, h int, technique string")
    bands = spark.createDataFrame([("T3_ma3", 1, -1.0, 1.0)], "technique string, h int, q_low double, q_high double")
    weights = spark.createDataFrame([("a", "c", None, 1.0), ("b", "c", "ref", 0.4)], "fs_id string, composition string, reference string, z double")
    patterns = spark.createDataFrame([("a", "c"), ("b", "c"), ("a", "ref"), ("b", "ref"), ("z", "ref")], "fs_id string, pattern string")
    rows = B.detail(predictions, decision, bands, weights, patterns, pooled, units, cfg)
    got = {(r.fs_id, NOW - r.ord, r.h, r.technique): r for r in rows.collect()}
    assert len(got) == rows.count() == 18
    assert got["a", 2, 1, "T2_mean"].pred_rate == 0.5 and got["a", 2, 1, "T2_mean"].chosen == 0 and got["a", 2, 6, "T2_mean"].chosen == 1
    lo = lambda p: math.log(p / (1 - p))
    # Known six months before: 52 of 110 in the composition, 72 of 210 in the reference.
    shift = 0.6 * (lo(72 / 210) - lo(52 / 110))
    b = got["b", 1, 6, "T3_ma6"]
    assert b.shift == pytest.approx(shift) and b.pred_rate == pytest.approx(1 / (1 + math.exp(-(lo(0.25) + shift)))) and b.err_units == pytest.approx(30 * b.pred_rate - 10)
    assert b.band_high == pytest.approx(b.pred_rate + cfg.z90 * math.sqrt(b.pred_rate * (1 - b.pred_rate) / 30))
    top = {(r.fs_id, r.h, r.technique): r for r in B.summary(rows).collect()}
    a = [top["a", 1, t] for t in ("T2_mean", "T3_ma3", "T3_ma6")]
    assert [r.rank for r in a] == [1, 1, 3] and [r.best for r in a] == [1, 1, 0] and {r.chosen_rank for r in a} == {3}
    assert a[0].wape == pytest.approx((abs(25 - 20) + abs(20 - 30)) / 50)
