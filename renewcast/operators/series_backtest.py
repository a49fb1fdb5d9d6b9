"""The compositions' backtest referred back to each series: what every technique would have said of it."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renewcast import config as C
from renewcast.functions.columns import inverse_logit, logit
from renewcast.operators import exam as EX


def detail(predictions: DataFrame, decision: DataFrame, bands: DataFrame, weights: DataFrame, patterns: DataFrame, pooled: DataFrame, units: DataFrame, cfg: C.Config) -> DataFrame:
    """A row for each series, exam month with something due, horizon and technique of its composition: the rate, moved
    to its reference by the levels known at the origin, against what the series renewed."""
    _, closed = EX.exam_rows(units, cfg)
    tried = predictions.where("purpose = 'examen'").select("composition", "ord", "h", (F.col("ord") - F.col("h")).alias("origin"), "technique", "predicted")
    tried = tried.join(decision.select("composition", "h", F.col("technique").alias("taken")), ["composition", "h"], "left")
    comp = EX.levels(pooled.where("due_units > 0"), ["composition"], cfg).select("composition", "origin", F.col("level").alias("comp_level"))
    wide = patterns.select("fs_id", F.col("pattern").alias("reference")).join(weights.select("reference").where("reference IS NOT NULL").distinct(), "reference").join(closed, "fs_id")
    ref = EX.levels(wide, ["reference"], cfg).select("reference", "origin", F.col("level").alias("ref_level"))
    real = closed.where(F.col("ord") >= cfg.exam).select("fs_id", "ord", "due_units", F.col("ren_units").alias("real_units")).join(weights.select("fs_id", "composition", "reference", "z"), "fs_id")
    rows = real.join(tried.join(comp, ["composition", "origin"], "left"), ["composition", "ord"]).join(ref, ["reference", "origin"], "left")
    z, r, p = F.coalesce("z", F.lit(1.0)), F.col("ref_level"), F.col("comp_level")
    shift = F.when((z < 1) & (r > 0) & (r < 1) & (p > 0) & (p < 1), (1 - z) * (logit(r) - logit(p))).otherwise(0.0)
    rows = rows.withColumn("shift", shift).withColumn("pred_rate", F.when(F.col("shift") == 0, F.col("predicted")).otherwise(inverse_logit(logit(F.col("predicted")) + F.col("shift"))))
    out = EX.measured(EX.interval(rows.withColumn("method", F.lit(EX.FRAMEWORK)), bands, cfg))
    return out.select("fs_id", "composition", "ord", "h", "technique", F.coalesce((F.col("technique") == F.col("taken")).cast("int"), F.lit(0)).alias("chosen"), "shift", "predicted", "pred_rate", "real_rate", "due_units", "real_units", "pred_units", "err_units", "err_pp", "noise_pp",
                      F.when(F.col("noise_pp") > 0, F.col("err_pp") / F.col("noise_pp")).alias("err_norm"), "band_low", "band_high", "in_band")


def summary(rows: DataFrame) -> DataFrame:
    """By series, horizon and technique: errors, bias, WAPE, the rank within the series (ties share the first of their
    ranks), the chosen one's rank, and which would have been best."""
    out = rows.groupBy("fs_id", "composition", "h", "technique").agg(
        F.count(F.lit(1)).alias("predictions"), F.avg(F.abs("err_pp")).alias("abs_err_pp"), F.avg("err_pp").alias("bias_pp"), F.round(F.avg(F.abs("err_norm")), 9).alias("abs_err_norm"), F.try_divide(F.sum(F.abs("err_units")), F.sum("real_units").cast("double")).alias("wape"), F.max("chosen").alias("chosen"))
    own = Window.partitionBy("fs_id", "h", F.col("abs_err_norm").isNull()).orderBy("abs_err_norm")
    out = out.withColumn("rank", F.when(F.col("abs_err_norm").isNotNull(), F.rank().over(own)))
    return out.withColumn("best", F.coalesce((F.col("rank") == 1).cast("int"), F.lit(0))).withColumn("chosen_rank", F.max(F.when(F.col("chosen") == 1, F.col("rank"))).over(Window.partitionBy("fs_id", "h")))
