"""The techniques against plain Python, and rules of single operators."""
import math

from pyspark.sql import functions as F

from renewcast import config as C
from renewcast.functions import columns as X
from renewcast.operators.backtest import predict_all
from renewcast.operators.price import increases


def plain(name, y, m, h):
    n, phi = len(y), 0.9
    left = sum(phi ** i for i in range(1, h + 1))
    mean = lambda v: sum(v) / len(v)
    def ses():
        level = y[0]
        for v in y[1:]:
            level = 0.3 * v + 0.7 * level
        return level
    def effect(ys, ms, month):
        own = [v for v, k in zip(ys, ms) if k == month]
        return mean(own) - mean(ys) if own else 0.0
    target = (m[-1] - 1 + h) % 12 + 1
    if name == "T2_mean":
        return mean(y)
    if name in ("T3_ma3", "T3_ma6"):
        return mean(y[-int(name[-1]):])
    if name == "T4_ewma":
        w = [0.5 ** ((n - 1 - i) / 3) for i in range(n)]
        return sum(a * b for a, b in zip(w, y)) / sum(w)
    if name == "T9_ses":
        return ses()
    if name == "T10_holt_damped":
        level, trend = y[0], y[1] - y[0]
        for v in y[1:]:
            old, level = level, 0.3 * v + 0.7 * (level + phi * trend)
            trend = 0.1 * (level - old) + 0.9 * phi * trend
        return level + trend * left
    if name == "T12_theta":
        mid = (n - 1) / 2
        slope = sum((i - mid) * v for i, v in enumerate(y)) / sum((i - mid) ** 2 for i in range(n))
        return (mean(y) + slope * mid + slope * left + ses()) / 2
    if name == "T14_temporal_cred":
        return 0.5 * mean(y[-6:]) + 0.5 * mean(y)
    if name == "T15_level_seasonal":
        return mean([v - effect(y, m, k) for v, k in list(zip(y, m))[-3:]]) + effect(y, m, target)
    season = [effect(y[:12], m[:12], k) for k in range(1, 13)]
    level, trend = mean(y[:12]), 0.0
    for v, k in list(zip(y, m))[12:]:
        old, level = level, 0.3 * (v - season[k - 1]) + 0.7 * (level + phi * trend)
        trend = 0.05 * (level - old) + 0.95 * phi * trend
        season[k - 1] = 0.2 * (v - level) + 0.8 * season[k - 1]
    return level + trend * left + season[target - 1]


def test_techniques(spark):
    y = [math.sin(i * 1.7) + 0.05 * i for i in range(30)]
    ords = [24000 + i for i in range(30)]
    rows = spark.createDataFrame([(n, h, [(o, v) for o, v in zip(ords[:n], y[:n])]) for n in (1, 3, 5, 12, 13, 24, 30) for h in (1, 6)], "n int, h int, seen array<struct<ord:int,y:double>>")
    least = {"T2_mean": 1, "T3_ma3": 3, "T3_ma6": 6, "T4_ewma": 4, "T9_ses": 4, "T10_holt_damped": 12, "T12_theta": 12, "T14_temporal_cred": 6, "T15_level_seasonal": 13, "T11_holt_winters": 24}
    got = {(r["n"], r["h"], r["technique"]): r["logit"] for r in predict_all(rows).collect()}
    assert set(got) == {(n, h, t) for n in (1, 3, 5, 12, 13, 24, 30) for h in (1, 6) for t in least if n >= least[t]}
    for (n, h, t), v in got.items():
        assert abs(v - plain(t, y[:n], [o % 12 + 1 for o in ords[:n]], h)) < 1e-9, (t, n, h)


def test_months_and_buckets(spark):
    rows = spark.createDataFrame([("2024-03",), ("2024-03-17",), ("17/03/2024",), ("3/2024",), (None,), ("2024-13",)], "t string")
    assert [str(r[0]) for r in rows.select(X.parse_month(F.col("t"))).collect()] == ["2024-03-01"] * 3 + ["None"] * 3
    b = spark.createDataFrame([(0,), (10,), (39,), (40,), (100,), (None,)], "p int").select(X.discount_bucket(F.col("p"), C.Config().bucket_edges)).collect()
    assert [r[0] for r in b] == ["01 _ 0-10%", "02 _ 10-20%", "04 _ 30-40%", "05 _ 40-100%", "05 _ 40-100%", "sin_dato"]


def test_increase_is_found(spark):
    rows = spark.createDataFrame([("a", 100 + i, 1.0 if i < 20 else 1.1, 5) for i in range(36)], "product string, ord int, uplift double, ren_value long")
    out = sorted(increases(rows).collect(), key=lambda r: r["ord"])
    assert [r["ord"] for r in out if r["starts"]] == [120] and out[20]["in_cycle"] == 1 and out[32]["in_cycle"] == 0 and out[25]["months_since"] == 5
