"""Audit: every technique's trial with its rank, and figures reckoned another way against the written ones."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renewcast import config as C
from renewcast.functions.columns import ratio
from renewcast.operators.backtest import HORIZONS
from renewcast.operators.techniques import CATALOGUE

TRIED, YOUNG = "tested", "too_short"


def technique_trials(compositions: DataFrame, predictions: DataFrame, decision: DataFrame) -> DataFrame:
    """A row for every composition, judged horizon and technique: errors in selection and exam, the rank by the former
    (ties share the first of their ranks), and whether it was chosen."""
    every = compositions.select("composition").distinct().select("composition", F.explode(F.array(*map(F.lit, HORIZONS))).alias("h")).select("composition", "h", F.explode(F.array(*map(F.lit, CATALOGUE))).alias("technique"))
    of = lambda p, c: F.avg(F.when(F.col("purpose") == p, F.abs(c)))
    errors = predictions.groupBy("composition", "h", "technique").agg(F.count(F.lit(1)).alias("predictions"), *(of(p, c).alias(f"{n}_{c}") for p, n in (("seleccion", "selection"), ("examen", "exam")) for c in ("error_norm", "error")))
    rows = every.join(errors, ["composition", "h", "technique"], "left").join(decision.select("composition", "h", F.col("technique").alias("chosen")), ["composition", "h"], "left")
    score = F.round("selection_error_norm", 9)
    # Without an error in the selection there is no rank.
    w = Window.partitionBy("composition", "h", F.col("selection_error_norm").isNull()).orderBy(score)
    return rows.select("composition", "h", "technique", F.when(F.col("predictions").isNull(), YOUNG).otherwise(TRIED).alias("status"), F.coalesce("predictions", F.lit(0)).alias("predictions"),
                       *(F.round(c, 6).alias(c) for c in ("selection_error_norm", "selection_error", "exam_error_norm", "exam_error")), F.when(F.col("selection_error_norm").isNotNull(), F.rank().over(w)).alias("rank"), (F.col("technique") == F.col("chosen")).cast("int").alias("chosen"))


def _against(name: str, written: DataFrame, again: DataFrame, keys: list[str], values: list[str], tolerance: float) -> DataFrame:
    """Rows of either side that the other lacks, or whose values are not the same within the tolerance."""
    a, b = written.select(*keys, *(F.col(v).cast("double").alias(f"a_{v}") for v in values), F.lit(1).alias("a_")), again.select(*keys, *(F.col(v).cast("double").alias(f"b_{v}") for v in values), F.lit(1).alias("b_"))
    on = [a[k].eqNullSafe(b[k]) for k in keys]
    key = F.concat_ws("|", *(F.coalesce(F.coalesce(a[k], b[k]).cast("string"), F.lit("null")) for k in keys))
    near = lambda x, y: (F.abs(x - y) <= tolerance * F.greatest(F.lit(1.0), F.abs(y))) | (x.isNull() & y.isNull())
    each = F.array(*(F.struct(F.lit(v).alias("value"), F.col(f"a_{v}").alias("written"), F.col(f"b_{v}").alias("again"), F.coalesce(near(F.col(f"a_{v}"), F.col(f"b_{v}")), F.lit(False)).alias("same")) for v in values))
    rows = a.join(b, on, "full").select(key.alias("key"), F.col("a_").isNull() | F.col("b_").isNull(), F.explode(each).alias("x")).toDF("key", "alone", "x")
    return rows.where("alone OR NOT x.same").select(F.lit(name).alias("what"), "key", "x.value", "x.written", "x.again")


def differences(t: dict[str, DataFrame], cfg: C.Config, tolerance: float = 1e-6) -> DataFrame:
    """Everything written that does not come out the same when it is made from the fine table in another way: units by
    month, each composition's months (from its series' marks, not from the bridge), references' rates, the forecast's
    units by month and the core's money (none when all is well)."""
    fine = t["fine"]
    months = fine.where("ts = 0").groupBy("ord").agg(F.sum("due_units").alias("due_units"), F.sum("due_cents").alias("due_cents"), F.sum("ren_units").alias("ren_units"))
    parts = [_against("units", t["units"].groupBy("ord").agg(*(F.sum(c).alias(c) for c in ("due_units", "due_cents", "ren_units"))), months, ["ord"], ["due_units", "due_cents", "ren_units"], tolerance)]
    closed = fine.where((F.col("ts") == 0) & (F.col("ord") < cfg.current)).select("fs_id", "ord", "due_units", "ren_units")
    sums = [F.sum("due_units").alias("due_units"), F.sum("ren_units").alias("ren_units")]
    lent = t["rungs"].join(t["chosen"].select("pass", F.col("composition").alias("pattern")).distinct(), ["pass", "pattern"]).select("fs_id", F.col("pattern").alias("composition")).distinct()
    parts.append(_against("pooled", t["pooled"], closed.join(lent, "fs_id").groupBy("composition", "ord").agg(*sums), ["composition", "ord"], ["due_units", "ren_units"], tolerance))
    wide = t["rungs"].select("fs_id", F.col("pattern").alias("reference")).join(t["references"].select("reference").distinct(), "reference").distinct()
    rates = closed.join(wide, "fs_id").groupBy("reference").agg(*sums).select("reference", ratio(F.col("ren_units"), F.col("due_units")).alias("rate"))
    parts.append(_against("references", t["references"].select("reference", ratio(F.col("r_ren"), F.col("r_due")).alias("rate")).distinct(), rates, ["reference"], ["rate"], tolerance))
    ahead = fine.where((F.col("ts") == 0) & (F.col("ord") >= cfg.current))
    parts.append(_against("forecast", t["forecast"].groupBy("ord").agg(F.sum("due_units").alias("due_units")), ahead.groupBy("ord").agg(F.sum("due_units").alias("due_units")), ["ord"], ["due_units"], tolerance))
    money = fine.where((F.col("ts") == 1) & (F.col("ord") < cfg.current) | (F.col("ts") == 0)).groupBy("ord").agg(F.sum("due_cents").alias("due_cents"))
    parts.append(_against("core", t["core"].where("source IN ('real', 'second_universe', 'forecast')").groupBy("ord").agg(F.sum("due_cents").alias("due_cents")), money, ["ord"], ["due_cents"], tolerance))
    return reduce(DataFrame.unionByName, parts)


AUDITED = ("fine", "units", "rungs", "chosen", "references", "pooled", "forecast", "core")
