"""Forecast techniques over a monthly history, as native expressions on arrays of logit rates.

A technique maps the history ``y`` (oldest first), the calendar months ``m`` (1 to 12) and the horizon to a
logit.  Most are weighted sums whose weights depend on the place and the length only.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the smoothers.
HALF_LIFE, SES, HOLT_LEVEL, HOLT_TREND, DAMPING, RECENT, RECENT_K = 3.0, 0.3, 0.3, 0.1, 0.9, 6, 6.0
HW_LEVEL, HW_TREND, HW_SEASON, CYCLE = 0.3, 0.05, 0.2, 12


def weighted(y: Column, weight: Callable[[Column], Column]) -> Column:
    return F.aggregate(F.transform(y, lambda v, i: v * weight(i)), F.lit(0.0), lambda a, v: a + v)


def mean(y: Column) -> Column:
    return weighted(y, lambda i: F.lit(1.0)) / F.size(y)


def last(y: Column, n: int) -> Column:
    return F.slice(y, F.greatest(F.size(y) - n + 1, F.lit(1)), F.lit(n))


def trend_left(h: Column) -> Column:
    """What survives of a damped trend h months ahead."""
    return F.lit(DAMPING) * (1 - F.pow(F.lit(DAMPING), h)) / (1 - DAMPING)


def ewma(y: Column) -> Column:
    w = lambda i: F.pow(F.lit(0.5), (F.size(y) - 1 - i) / HALF_LIFE)
    return weighted(y, w) / F.aggregate(F.transform(y, lambda _, i: w(i)), F.lit(0.0), lambda a, v: a + v)


def ses(y: Column) -> Column:
    return weighted(y, lambda i: F.when(i == 0, 1.0).otherwise(SES) * F.pow(F.lit(1 - SES), F.size(y) - 1 - i))


def theta(y: Column, h: Column) -> Column:
    """Half the least-squares line with its slope damped, half simple smoothing."""
    n = F.size(y)
    middle = (n - 1) / 2.0
    slope = weighted(y, lambda i: (i - middle) * 12 / (n * (n * n - 1.0)))
    line = mean(y) + slope * middle + slope * trend_left(h)
    return (line + ses(y)) / 2


def temporal_credibility(y: Column) -> Column:
    recent = last(y, RECENT)
    z = F.size(recent) / (F.size(recent) + RECENT_K)
    return z * mean(recent) + (1 - z) * mean(y)


def holt_damped(y: Column, h: Column) -> Column:
    start = F.struct(y[0].alias("level"), (y[1] - y[0]).alias("trend"))

    def step(s, v):
        level = HOLT_LEVEL * v + (1 - HOLT_LEVEL) * (s["level"] + DAMPING * s["trend"])
        return F.struct(level.alias("level"), (HOLT_TREND * (level - s["level"]) + (1 - HOLT_TREND) * DAMPING * s["trend"]).alias("trend"))

    return F.aggregate(F.slice(y, F.lit(2), F.size(y)), start, step, lambda s: s["level"] + s["trend"] * trend_left(h))


def _effect(y: Column, m: Column, month: Column) -> Column:
    """A calendar month's mean against all; 0 for a month not seen."""
    own = F.filter(F.arrays_zip(y.alias("y"), m.alias("m")), lambda x: x["m"] == month)
    return F.when(F.size(own) > 0, F.aggregate(own, F.lit(0.0), lambda a, x: a + x["y"]) / F.size(own) - mean(y)).otherwise(0.0)


def level_seasonal(y: Column, m: Column, h: Column) -> Column:
    pairs = F.arrays_zip(last(y, 3).alias("y"), last(m, 3).alias("m"))
    level = F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x["y"] - _effect(y, m, x["m"])) / F.size(pairs)
    return level + _effect(y, m, (F.element_at(m, -1) - 1 + h) % CYCLE + 1)


def holt_winters(y: Column, m: Column, h: Column) -> Column:
    y0, m0 = F.slice(y, 1, CYCLE), F.slice(m, 1, CYCLE)
    season = F.transform(F.sequence(F.lit(1), F.lit(CYCLE)), lambda k: _effect(y0, m0, k))
    start = F.struct(mean(y0).alias("level"), F.lit(0.0).alias("trend"), season.alias("season"))
    rest = F.arrays_zip(F.slice(y, F.lit(CYCLE + 1), F.size(y)).alias("y"), F.slice(m, F.lit(CYCLE + 1), F.size(m)).alias("m"))

    def step(s, x):
        old = F.element_at(s["season"], x["m"])
        level = HW_LEVEL * (x["y"] - old) + (1 - HW_LEVEL) * (s["level"] + DAMPING * s["trend"])
        trend = HW_TREND * (level - s["level"]) + (1 - HW_TREND) * DAMPING * s["trend"]
        new = HW_SEASON * (x["y"] - level) + (1 - HW_SEASON) * old
        return F.struct(level.alias("level"), trend.alias("trend"), F.transform(s["season"], lambda v, k: F.when(k == x["m"] - 1, new).otherwise(v)).alias("season"))

    target = (F.element_at(m, -1) - 1 + h) % CYCLE + 1
    return F.aggregate(rest, start, step, lambda s: s["level"] + s["trend"] * trend_left(h) + F.element_at(s["season"], target))


#: Name -> (months needed, expression of y, m, h), in the order that settles ties.
CATALOGUE = {
    "T2_mean": (1, lambda y, m, h: mean(y)),
    "T3_ma3": (3, lambda y, m, h: mean(last(y, 3))),
    "T3_ma6": (6, lambda y, m, h: mean(last(y, 6))),
    "T4_ewma": (4, lambda y, m, h: ewma(y)),
    "T9_ses": (4, lambda y, m, h: ses(y)),
    "T10_holt_damped": (12, lambda y, m, h: holt_damped(y, h)),
    "T12_theta": (12, lambda y, m, h: theta(y, h)),
    "T14_temporal_cred": (6, lambda y, m, h: temporal_credibility(y)),
    "T15_level_seasonal": (13, level_seasonal),
    "T11_holt_winters": (24, holt_winters),
}
CHALLENGER = "T3_ma3"
