"""The revaluation report and the marks' diagnosis on small tables, against reckoning by hand."""
import numpy as np
import pytest

from renewcast.config import Config
from renewcast.operators import mark_diagnosis as MD
from renewcast.operators import revaluation as R

CFG = Config()
NOW = CFG.current


def licence(ord=NOW - 1, ratio=200, base=1000, due=1, renewed=True, softcancel=0, newcust=0, percent=5, product="p", ts=0):
    """A licence that pays ratio / 200 of its base."""
    return (ord, "r", product, 0, softcancel, 0, "c", newcust, percent, ts, "1 year", due, base, due if renewed else 0, base * ratio if renewed else 0, base if renewed else 0)


FIELDS = "ord int, region string, product string, dormant int, softcancel int, autorenew int, channel string, newcust int, percent int, ts int, term string, due_units long, due_cents long, ren_units long, ren_value long, base_cents long"


def rows(spark, *licences):
    return R.isolated(spark.createDataFrame(list(licences), FIELDS), CFG)


@pytest.mark.parametrize("seed", range(4))
def test_percentiles_as_interpolated(spark, seed):
    rng = np.random.default_rng(seed)
    u, w = rng.integers(1, 9, 60) / 4.0, rng.integers(1, 50, 60)
    order = np.lexsort((w, u))
    want = [np.interp(q, np.cumsum(w[order]) / w.sum(), u[order]) for q in R.PERCENTILES.values()]
    # Places of any width give the same.
    for width in (0.5, 1.0, 100.0):
        df = spark.createDataFrame([(f"{int(a / width):02d}", float(a), int(b)) for a, b in zip(u, w)], "place string, u double, w long")
        got = R.percentiles(df, R.PERCENTILES).first()
        assert np.allclose([got[k] for k in R.PERCENTILES], want, atol=1e-6)


def test_ties_and_one_row(spark):
    one = spark.createDataFrame([("00", 1.5, 10)], "place string, u double, w long")
    assert set(R.percentiles(one, R.PERCENTILES).first()) == {1.5}
    three = spark.createDataFrame([("00", 1.0, 1), ("01", 2.0, 1), ("01", 2.0, 1)], "place string, u double, w long")
    assert R.percentiles(three, {"p10": 0.1, "p50": 0.5, "p90": 0.9}).first() == (1.0, 1.5, 2.0)


def test_licences_on_an_edge(spark):
    # 0.95, 1, 1.05, 1.1 and 1.2 exactly, for a base whose quotients aren't exact fractions: each opens its band.
    got = {r["band"]: r["base_cents"] for r in R.bands(rows(spark, *(licence(ratio=k, base=3337) for k in (189, 190, 200, 210, 220, 240)))).collect()}
    assert got == dict.fromkeys(R.BANDS, 3337)


def test_population(spark):
    all_rows = rows(spark, licence(), licence(softcancel=1), licence(newcust=1), licence(renewed=False, product="q"), licence(ord=NOW), licence(ts=1), licence(base=0, percent=None))
    assert [tuple(r) for r in R.funnel(all_rows).collect()] == [("renewers", 4, 600000), ("isolated", 2, 400000), ("not_acquired", 1, 200000)]


def test_due_units_are_those_of_the_rows(spark):
    # What did not renew is due in the same row: the series renews one of three.
    valued = R.series(rows(spark, licence(due=1), licence(due=2, renewed=False)))
    top = R.top(valued).first()
    assert (top["units_a_month"], top["rate"], top["uplift"], top["spread"], top["near"]) == (3.0, 0.333333, 1.0, 0.0, 1.0)


def test_floor_or_largest(spark, monkeypatch):
    monkeypatch.setattr(R, "TOP", 1)
    valued = R.series(rows(spark, licence(product="large", base=9000), licence(product="many", due=271), licence(product="few", due=270), licence(product="twice", due=300), licence(product="twice", ord=NOW - 2, due=241)))
    assert {r["fs_id"].split("|")[1]: r["selected"] for r in valued.collect()} == {"large": 1, "many": 1, "few": 0, "twice": 0}


def test_histogram_and_unknown_discounts(spark):
    valued = R.series(rows(spark, licence(product="a", ratio=195), licence(product="b", ratio=300, base=3000, percent=None), licence(product="b", ratio=300)))
    got = {(r["among"], r["from_thousandths"]): (r["series"], r["value_share"]) for r in R.histogram(valued).collect()}
    assert len(got) == 22 and {k: v for k, v in got.items() if v[0]} == {("all", 975): (1, round(195 / 1395, 6)), ("all", 1500): (1, round(1200 / 1395, 6)), ("unknown", 1500): (1, 1.0)}


@pytest.mark.parametrize("ratios, want", [((200,) * 12 + (210,) * 3, (9, 3, 3, "increase")), ((200,) * 12 + (210, 200, 210), (9, 2, 1, "scattered")), ((200,) * 21, (12, 0, 0, "none")), ((200,) * 5, (0, 0, 0, None))])
def test_steps_of_the_path(spark, ratios, want):
    path = R.monthly(rows(spark, *(licence(ord=NOW - len(ratios) + i, ratio=k) for i, k in enumerate(ratios))))
    last = path.orderBy("ord").collect()
    assert [r["above"] is None for r in last[:6]] == [True] * min(6, len(ratios))
    # Of the last twelve months, those with enough before them count: of fifteen months, nine.
    assert tuple(R.verdict(path).first()) == want


def test_claim(spark):
    for ratios, claim in (((200,) * 9 + (260,), "holds"), ((200,) * 7 + (260,) * 3, "fails"), ((200,) * 7 + (212,) * 3, "in_part")):
        r = rows(spark, *(licence(ratio=k) for k in ratios))
        assert R.summary(r, R.series(r)).first()["claim"] == claim


def test_nobody_renews(spark):
    none = rows(spark, licence(renewed=False))
    valued = R.series(none)
    assert none.count() == valued.count() == R.histogram(valued).count() == R.monthly(none).count() == R.by_discount(none).count() == 0
    got = R.summary(none, valued).first()
    assert (got["series"], got["p50"], got["uplift"], got["claim"]) == (0, None, None, None)


def fine(spark, *rows):
    return spark.createDataFrame(rows, "ord int, dormant int, softcancel int, due_units long, due_cents long, ren_units long, ren_value long").selectExpr("*", "0 AS ts")


def added(spark, units="expected_units", *rows):
    return spark.createDataFrame(list(rows), f"ord int, {units} double")


def test_mix_of_marks(spark):
    f = fine(spark,
             # A year ago: half was dormant in the end, of which a tenth renewed; a month later nothing was marked.
             (NOW - 12, 1, 0, 100, 10000, 10, 200000), (NOW - 12, 0, 0, 100, 10000, 80, 1600000), (NOW - 11, 0, 0, 100, 10000, 90, 1800000),
             # Open: today a fifth of the first month is dormant; the second has a combination that no history has.
             (NOW, 1, 0, 20, 2000, None, None), (NOW, 0, 0, 80, 8000, None, None), (NOW + 1, 1, 1, 50, 5000, None, None), (NOW + 6, 1, 0, 10, 1000, None, None))
    past, future = MD.history(f, CFG), MD.ahead(f, added(spark, "expected_units", (NOW + 1, 50.0)), added(spark, "units"), CFG)
    costs = {r["mark"]: (r["share_units"], r["rate_units"], r["rate_value"]) for r in MD.costs(past).collect()}
    assert costs == {"dormant": (0.333333, 0.1, 0.1), "neutral": (0.666667, 0.85, 0.85)}
    got = {r["ord"] - NOW: r for r in MD.effects(past, future).collect()}
    assert (got[0]["today_units"], got[0]["final_units"], got[0]["effect_cents"]) == (0.7, 0.475, -2250.0)
    # The unknown combination counts as unmarked; what isn't there yet too.
    assert (got[1]["today_units"], got[1]["final_units"], got[1]["effect_cents"]) == (0.85, 0.85, 0.0)
    # No such month in the history: today's mix stays.
    assert (got[6]["today_value"], got[6]["final_value"], got[6]["effect_cents"]) == (0.1, 0.1, 0.0)
    shares = {r["ord"] - NOW: r for r in MD.shares(past, future, CFG).collect()}
    assert (shares[0]["h"], shares[0]["today_dormant"], shares[0]["final_dormant"], shares[0]["today_neutral"], shares[0]["extract_share"]) == (1, 0.2, 0.5, 0.8, 1.0)
    assert (shares[1]["today_softcancel"], shares[1]["today_neutral"], shares[1]["final_neutral"], shares[1]["extract_share"]) == (0.5, 0.5, 1.0, 0.5)
    assert shares[6]["final_dormant"] is None
    assert sum(r["effect_cents"] for r in MD.by_year(MD.effects(past, future)).collect()) == -2250.0


def test_history_without_unmarked_rows(spark):
    f = fine(spark, (NOW - 12, 1, 0, 100, 10000, 10, 200000), (NOW, 0, 0, 80, 8000, None, None), (NOW + 1, 1, 0, 80, 8000, None, None))
    got = {r["ord"] - NOW: r for r in MD.effects(MD.history(f, CFG), MD.ahead(f, added(spark), added(spark, "units"), CFG)).collect()}
    assert got[0]["today_units"] is None and got[0]["effect_cents"] is None and got[1]["today_units"] == 0.1
