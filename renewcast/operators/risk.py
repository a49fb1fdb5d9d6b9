"""The estimate of each series with its two errors, and how far its rate can be relied on."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewcast import config as C
from renewcast.functions.columns import binomial_error, ratio
from renewcast.operators import series as S

#: Risk levels.
OWN, OWN_SHORT, OWN_REINFORCED, BORROWED, FAR = "A_propio", "A2_propio_corto", "A3_propio_reforzado", "B_prestado", "C_lejano"
SIGNED_LOW, MIXED, NO_HISTORY, NO_IMPACT, APART = "S_signo_bajo_suelo", "M_signo_mixto", "D_sin_historia", "N_sin_impacto", "T_universo_ts"
#: A full year, so that a seasonal series has shown every season; the last pass that keeps the mandatory dimensions.
YEAR, LAST_CLOSE_PASS = 12, 2


def estimates(fine: DataFrame, summary: DataFrame, chosen: DataFrame, references: DataFrame, credibility: DataFrame, cfg: C.Config) -> DataFrame:
    """One row a series: rate of its group (moved to its reference where support is short), the error of that
    estimate, the error of a prediction (which never sheds the series' own noise) and the risk level."""
    own = summary.select("fs_id", F.col("support").alias("own_support"), F.col("rate").alias("own_rate"), "months")
    group = chosen.select("fs_id", "pass", "composition", "support", ratio(F.col("ren_units"), F.col("due_units")).alias("group_rate"))
    ref = references.join(credibility.select("reference", "k"), "reference", "left").select("fs_id", "reference", "r_support", F.coalesce("k", F.lit(cfg.default_k)).alias("k"), ratio(F.col("r_ren"), F.col("r_due")).alias("r_rate"))
    rows = S.routes(fine).select("fs_id", "route", "universe", "to_predict_cents").join(fine.select("fs_id", "sign").distinct(), "fs_id").join(own, "fs_id", "left").join(group, "fs_id", "left").join(ref, "fs_id", "left")
    itself = F.col("composition").isNull()
    rows = rows.withColumns({"pass": F.when(itself, 0).otherwise(F.col("pass")), "support": F.when(itself, F.col("own_support")).otherwise(F.col("support")), "group_rate": F.when(itself, F.col("own_rate")).otherwise(F.col("group_rate")), "composition": F.coalesce("composition", "fs_id"), "months": F.coalesce("months", F.lit(0))})
    n, p, r = F.coalesce("support", F.lit(0.0)), F.col("group_rate"), F.col("r_rate")
    blends = F.col("reference").isNotNull() & r.isNotNull() & p.isNotNull() & (n < cfg.support_full)
    z = F.when(blends, n / (n + F.col("k"))).otherwise(1.0)
    alone, wide = binomial_error(p, n), binomial_error(r, F.col("r_support"))
    rows = rows.withColumn("z", z).withColumn("rate", F.when(blends, F.col("z") * p + (1 - F.col("z")) * r).otherwise(p))
    rows = rows.withColumn("error_estimate", F.when(blends, F.sqrt((F.col("z") * alone) ** 2 + ((1 - F.col("z")) * wide) ** 2)).otherwise(alone))
    noise = binomial_error(F.col("rate"), F.coalesce("own_support", F.lit(0.0)))
    rows = rows.withColumn("error_prediction", F.sqrt(F.col("error_estimate") ** 2 + noise ** 2)).withColumn("reaches_floor", (n >= cfg.support_floor).cast("int")).withColumn("risk", _risk(cfg))
    return rows.select("fs_id", "composition", "pass", "reference", "months", F.round("z", 3).alias("z"), F.round("rate", 6).alias("rate"), F.round("error_estimate", 6).alias("error_estimate_pp"), F.round("error_prediction", 6).alias("error_prediction_pp"),
                       F.round(100 * (F.col("rate") - p), 6).alias("credibility_effect_pp"), "reaches_floor", "risk", "to_predict_cents")


def _risk(cfg: C.Config):
    """Route and universe first, then sign, the floor, and the pass where the group was formed."""
    own, full, low = F.col("pass") == 0, F.coalesce("support", F.lit(0.0)) >= cfg.support_full, F.col("reaches_floor") == 0
    return (F.when(F.col("route") == C.PAST_ONLY, NO_IMPACT).when(F.col("universe") != C.NORMAL, APART).when((F.col("route") == C.FUTURE_ONLY) | (F.col("months") == 0), NO_HISTORY).when(F.col("sign") == C.MIXED, MIXED)
            .when(low & (F.col("sign") != C.NEUTRAL), SIGNED_LOW).when(low, FAR).when(own & full & (F.col("months") >= YEAR), OWN).when(own & full, OWN_SHORT).when(own, OWN_REINFORCED).when(F.col("pass") <= LAST_CLOSE_PASS, BORROWED).otherwise(FAR))


def report(estimated: DataFrame) -> DataFrame:
    """Series and money to predict by risk level, with the prediction's error weighed by that money."""
    money = F.col("to_predict_cents")
    counts = F.col("error_prediction_pp").isNotNull() & (money > 0)
    out = estimated.groupBy("risk").agg(F.count(F.lit(1)).alias("series"), F.sum(money).alias("to_predict_cents"), F.round(F.try_divide(F.sum(F.when(counts, F.col("error_prediction_pp") * money)), F.sum(F.when(counts, money)).cast("double")), 4).alias("error_pp"))
    total = estimated.agg(F.sum(money).alias("all_cents"))
    return out.crossJoin(F.broadcast(total)).select("risk", "series", "to_predict_cents", F.round(F.coalesce(ratio(F.col("to_predict_cents"), F.col("all_cents")), F.lit(0.0)), 6).alias("share"), "error_pp")
