"""Backtest without look-ahead, choice of techniques, error bands and the exam."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renewcast import config as C
from renewcast.functions.columns import inverse_logit, join_id, logit, ratio
from renewcast.operators.techniques import CATALOGUE, CHALLENGER

HORIZONS, SELECTION_MONTHS, LEAST_PREDICTIONS = (1, 6), 12, 3


def histories(pooled: DataFrame) -> DataFrame:
    """One row a composition: its months with a rate, oldest first."""
    rate = ratio(F.col("ren_units"), F.col("due_units"))
    rows = pooled.where("due_units > 0").select("composition", F.struct("ord", rate.alias("rate"), logit(rate).alias("y"), "due_units").alias("x"))
    return rows.groupBy("composition").agg(F.sort_array(F.collect_list("x")).alias("history"))


def predict_all(rows: DataFrame, names=tuple(CATALOGUE)) -> DataFrame:
    """rows with seen (history array) and h -> a row for each technique whose history is long enough."""
    y, m = F.transform("seen", lambda x: x["y"]), F.transform("seen", lambda x: (x["ord"] % 12 + 1).cast("int"))
    each = F.array(*(F.struct(F.lit(n).alias("technique"), F.lit(k).alias("place"), F.when(F.size("seen") >= CATALOGUE[n][0], CATALOGUE[n][1](F.col("y"), F.col("m"), F.col("h"))).alias("logit")) for k, n in enumerate(names)))
    keep = [c for c in rows.columns if c != "seen"]
    out = rows.withColumn("y", y).withColumn("m", m).select(*keep, F.explode(each).alias("p"))
    return out.select(*keep, "p.technique", "p.place", F.col("p.logit").alias("logit")).where("logit IS NOT NULL AND NOT isnan(logit)")


def backtest(pooled: DataFrame, cfg: C.Config, names=tuple(CATALOGUE)) -> DataFrame:
    """Every composition, month of the selection or exam, horizon and technique: prediction and error."""
    first = cfg.exam - SELECTION_MONTHS
    rows = histories(pooled).select("composition", "history", F.explode(F.filter("history", lambda x: (x["ord"] >= first) & (x["ord"] < cfg.current))).alias("t"))
    rows = rows.select("*", F.explode(F.array(*map(F.lit, HORIZONS))).alias("h"))
    rows = rows.select("composition", F.col("t.ord").alias("ord"), "h", F.col("t.rate").alias("real"), F.col("t.due_units").alias("due_units"), F.filter("history", lambda x: x["ord"] <= F.col("t.ord") - F.col("h")).alias("seen"))
    rows = rows.where(F.size("seen") >= cfg.least_history)
    out = predict_all(rows, names).withColumn("predicted", inverse_logit(F.col("logit")))
    low = 0.5 / F.col("due_units")
    p = F.greatest(F.least(F.col("real"), 1 - low), low)
    error = 100 * (F.col("predicted") - F.col("real"))
    return out.select("composition", "ord", F.when(F.col("ord") >= cfg.exam, "examen").otherwise("seleccion").alias("purpose"), "h", "technique", "place", "predicted", "real", "due_units", error.alias("error"), (error / (100 * F.sqrt(p * (1 - p) / F.col("due_units")))).alias("error_norm"))


def choose(predictions: DataFrame, compositions: DataFrame, cfg: C.Config) -> DataFrame:
    """A technique for every composition and judged horizon: the best one if it beats the challenger by the margin,
    else the challenger, also where none could be judged (origin ``sin_soporte``)."""
    score = predictions.where("purpose = 'seleccion'").groupBy("composition", "h", "technique", "place").agg(F.avg(F.abs("error_norm")).alias("score"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("composition", "h").orderBy(F.when(F.col("n") >= LEAST_PREDICTIONS, 0).otherwise(1), F.round("score", 9), "place")
    best = score.withColumn("k", F.row_number().over(w)).where("k = 1")
    rival = score.where(F.col("technique") == CHALLENGER).select("composition", "h", F.col("score").alias("rival"))
    margin = F.when(F.col("h") == 1, cfg.margin_short).otherwise(0.0)
    enough = F.coalesce(F.col("n"), F.lit(0)) >= LEAST_PREDICTIONS
    wins = enough & (F.col("technique") != CHALLENGER) & (F.col("score") < F.coalesce("rival", F.lit(float("inf"))) - margin)
    every = compositions.select("composition").distinct().select("composition", F.explode(F.array(*map(F.lit, HORIZONS))).alias("h"))
    rows = every.join(best, ["composition", "h"], "left").join(rival, ["composition", "h"], "left")
    return rows.select("composition", "h", F.when(wins, F.col("technique")).otherwise(CHALLENGER).alias("technique"), F.when(wins, "campeon").when(F.col("n").isNotNull(), "retador").otherwise("sin_soporte").alias("origin"))


def error_bands(predictions: DataFrame) -> DataFrame:
    return predictions.where("purpose = 'seleccion'").groupBy("technique", "h").agg(F.round(F.percentile("error_norm", F.lit(0.05)), 6).alias("q_low"), F.round(F.percentile("error_norm", F.lit(0.95)), 6).alias("q_high"), F.count(F.lit(1)).alias("n"))


def exam(predictions: DataFrame, decision: DataFrame) -> DataFrame:
    """Error of the chosen techniques in the exam months, by horizon: units predicted and real, WAPE, bias."""
    rows = predictions.where("purpose = 'examen'").join(decision.select("composition", "h", "technique"), ["composition", "h", "technique"])
    p, r = F.col("predicted") * F.col("due_units"), F.col("real") * F.col("due_units")
    return rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(p), 4).alias("predicted_units"), F.round(F.sum(r), 4).alias("real_units"), F.round(F.sum(F.abs(p - r)) / F.sum(r), 6).alias("wape"), F.round(F.avg("error"), 6).alias("bias"))


def judged(h):
    """The judged horizon of a horizon: the next one above, or the last."""
    out = F.lit(HORIZONS[-1])
    for k in reversed(HORIZONS[:-1]):
        out = F.when(h <= k, k).otherwise(out)
    return out


def predict_chosen(rows: DataFrame) -> DataFrame:
    """rows with seen, h and technique -> technique and rate: the challenger's where the technique can't predict."""
    y, m = F.transform("seen", lambda x: x["y"]), F.transform("seen", lambda x: (x["ord"] % 12 + 1).cast("int"))
    out = rows.withColumn("y", y).withColumn("m", m)
    found = F.lit(None).cast("double")
    for name, (least, f) in CATALOGUE.items():
        found = F.when((F.col("technique") == name) & (F.size("seen") >= least), f(F.col("y"), F.col("m"), F.col("h"))).otherwise(found)
    finite = lambda c: F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)
    out = out.withColumn("own", found).withColumn("own", finite(F.col("own")))
    out = out.withColumn("rival", F.when(F.size("seen") > 0, CATALOGUE[CHALLENGER][1](F.col("y"), F.col("m"), F.col("h")))).withColumn("rival", finite(F.col("rival")))
    keep = [c for c in rows.columns if c not in ("seen", "technique")]
    return out.select(*keep, F.when(F.col("own").isNull(), CHALLENGER).otherwise(F.col("technique")).alias("technique"), inverse_logit(F.coalesce("own", "rival")).alias("rate"))


def forecast(pooled: DataFrame, members: DataFrame, units: DataFrame, decision: DataFrame, bands: DataFrame, weights: DataFrame, cfg: C.Config) -> DataFrame:
    """Renewals of each series' open months, all of them.  The rate is what the technique chosen for its composition
    (the challenger, if it wasn't judged or can't predict) predicts for that month, moved toward the composition's
    reference where z < 1; without a prediction it is the mandatory cell's rate, or that of everything.  The band is
    that of the technique's errors at the nearest judged horizon (the challenger's, then z, if there are none)."""
    open_rows = units.where(F.col("ord") >= cfg.current).withColumn("cell", join_id(*cfg.mandatory)).withColumn("h", F.col("ord") - cfg.current + 1)
    future = open_rows.select("fs_id", "cell", "ord", "h", "due_units").join(members.where("membership = 'uses'").select("fs_id", "composition"), "fs_id", "left")
    history = histories(pooled).select("composition", F.filter("history", lambda x: x["ord"] < cfg.current).alias("seen"))
    rows = future.select("composition", "h").distinct().join(history, "composition").withColumn("judged", judged(F.col("h")))
    rows = rows.join(decision.select("composition", F.col("h").alias("judged"), "technique"), ["composition", "judged"], "left").withColumn("technique", F.coalesce("technique", F.lit(CHALLENGER)))
    rates = predict_chosen(rows.select("composition", "h", "technique", "seen")).withColumnRenamed("rate", "pool_rate")
    z, p, r = F.col("z"), F.col("own_rate"), F.col("reference_rate")
    shift = F.when((z < 1) & (p > 0) & (p < 1) & (r > 0) & (r < 1), (1 - z) * (logit(r) - logit(p))).otherwise(0.0)
    out = future.join(rates, ["composition", "h"], "left").join(weights.select("fs_id", "z", "own_rate", "reference_rate"), "fs_id", "left").withColumn("shift", shift)
    own = F.when(F.col("shift") == 0, F.col("pool_rate")).otherwise(inverse_logit(logit(F.col("pool_rate")) + F.col("shift")))
    closed = units.where((F.col("ord") < cfg.current) & (F.col("due_units") > 0))
    sums = lambda x: ratio(F.sum("ren_units"), F.sum("due_units")).alias(x)
    out = out.join(closed.groupBy(join_id(*cfg.mandatory).alias("cell")).agg(sums("cell_rate")), "cell", "left").crossJoin(F.broadcast(closed.agg(sums("global_rate"))))
    out = out.withColumn("rate", F.coalesce(own, F.col("cell_rate"), F.col("global_rate"))).withColumn("technique", F.coalesce("technique", F.lit(CHALLENGER))).withColumn("judged", judged(F.col("h")))
    out = out.withColumn("origin", F.when(F.col("pool_rate").isNotNull(), "pool").when(F.col("cell_rate").isNotNull(), "cell").otherwise("global"))
    edges = bands.select("technique", F.col("h").alias("judged"), "q_low", "q_high")
    rival = edges.where(F.col("technique") == CHALLENGER).select("judged", F.col("q_low").alias("c_low"), F.col("q_high").alias("c_high"))
    out = out.join(F.broadcast(edges), ["technique", "judged"], "left").join(F.broadcast(rival), "judged", "left")
    low, high = F.coalesce("q_low", "c_low", F.lit(-cfg.z90)), F.coalesce("q_high", "c_high", F.lit(cfg.z90))
    se = F.sqrt(F.col("rate") * (1 - F.col("rate")) / F.greatest("due_units", F.lit(1)))
    edge = lambda q: F.least(F.greatest(F.col("rate") + q * se, F.lit(0.0)), F.lit(1.0))
    return out.select("fs_id", "ord", "h", "composition", "origin", "technique", "due_units", "rate", edge(F.least(low, F.lit(0.0))).alias("rate_low"), edge(F.greatest(high, F.lit(0.0))).alias("rate_high"), (F.col("rate") * F.col("due_units")).alias("expected_units"))


def yearly_totals(forecast: DataFrame) -> DataFrame:
    """Expected renewals by year with linear and quadrature bands."""
    half = (F.col("rate_high") - F.col("rate_low")) / 2 * F.col("due_units")
    return forecast.groupBy(F.floor(F.col("ord") / 12).cast("int").alias("year")).agg(F.round(F.sum("expected_units"), 4).alias("expected"), F.round(F.sum(F.col("rate_low") * F.col("due_units")), 4).alias("low"), F.round(F.sum(F.col("rate_high") * F.col("due_units")), 4).alias("high"), F.round(F.sqrt(F.sum(half * half)), 4).alias("quadrature"))


def monthly_totals(forecast: DataFrame) -> DataFrame:
    """Expected renewals by month with linear and quadrature bands: series' errors add up, or are independent."""
    low, high = ((F.col("rate") - F.col("rate_low")) * F.col("due_units"), (F.col("rate_high") - F.col("rate")) * F.col("due_units"))
    out = forecast.groupBy("ord").agg(F.sum("due_units").alias("due_units"), F.sum("expected_units").alias("expected"), F.sum(low).alias("low"), F.sum(high).alias("high"), F.sqrt(F.sum(low * low)).alias("q_low"), F.sqrt(F.sum(high * high)).alias("q_high"))
    near = lambda c, n: F.round(c, 4).alias(n)
    return out.select("ord", "due_units", near(F.col("expected"), "expected"), near(F.col("expected") - F.col("low"), "low"), near(F.col("expected") + F.col("high"), "high"), near(F.col("expected") - F.col("q_low"), "quadrature_low"), near(F.col("expected") + F.col("q_high"), "quadrature_high"))
