"""Series: routes, support, gaps, rates and their uncertainty."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renewcast import config as C
from renewcast.functions.columns import binomial_error, ratio, role, wilson


def calendar_table(fine: DataFrame) -> DataFrame:
    s = lambda c: F.sum(c).alias(c)
    return fine.groupBy("ord", "role").agg(F.count(F.lit(1)).alias("rows"), s("due_units"), s("due_cents"), s("ren_units"), s("ren_value"), s("raw_due_units"), s("raw_ren_units"), ratio(F.sum("ren_units"), F.sum("due_units")).alias("rate"))


def routes(fine: DataFrame) -> DataFrame:
    """Coverage, route, universe and money to predict of each series."""
    n = lambda r: F.count_distinct(F.when(F.col("role") == r, F.col("ord")))
    out = fine.groupBy("fs_id").agg(n(C.TRAINING).alias("training"), n(C.EXAM).alias("exam"), n(C.PROJECTION).alias("projection"), F.avg("ts").alias("share"), F.coalesce(F.sum(F.when(F.col("role") == C.PROJECTION, F.col("due_cents"))), F.lit(0)).alias("to_predict_cents"))
    past, future = F.col("training") + F.col("exam") > 0, F.col("projection") > 0
    return out.select("fs_id", "training", "exam", "projection", "to_predict_cents",
                      F.concat_ws("+", F.when(F.col("training") > 0, C.TRAINING), F.when(F.col("exam") > 0, C.EXAM), F.when(future, C.PROJECTION)).alias("coverage"),
                      F.when(past & future, C.PREDICTABLE).when(past, C.PAST_ONLY).otherwise(C.FUTURE_ONLY).alias("route"),
                      F.when(F.col("share") == 1, C.TIME_SERIES).when(F.col("share") == 0, C.NORMAL).otherwise(C.MIXED).alias("universe"))


def closed(units: DataFrame, cfg: C.Config) -> DataFrame:
    return units.where(F.col("ord") < cfg.current)


def gaps(units: DataFrame, cfg: C.Config) -> DataFrame:
    """Months that are missing between a series' first and last closed month, with the role of the month
    before them that exists (as of)."""
    own = closed(units, cfg).select("fs_id", "ord").distinct()
    spine = own.groupBy("fs_id").agg(F.min("ord").alias("a"), F.max("ord").alias("b")).select("fs_id", F.explode(F.sequence("a", "b")).alias("ord"))
    every = spine.join(own.withColumn("there", F.lit(1)), ["fs_id", "ord"], "left").withColumn("role", F.when(F.col("there") == 1, role(F.col("ord"), cfg)))
    w = Window.partitionBy("fs_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    return every.withColumn("as_of_role", F.last("role", ignorenulls=True).over(w)).where("there IS NULL").select("fs_id", "ord", "as_of_role")


def rate_summary(units: DataFrame, cfg: C.Config) -> DataFrame:
    """Support, months, own rate and its interval by series, over closed months."""
    out = closed(units, cfg).groupBy("fs_id", "sign").agg(F.median(F.when(F.col("due_units") > 0, F.col("due_units").cast("double"))).alias("support"), F.count(F.lit(1)).alias("months"), F.sum("due_units").alias("due_units"), F.sum("ren_units").alias("ren_units"))
    out = out.withColumn("rate", ratio(F.col("ren_units"), F.col("due_units")))
    return out.select("*", F.round(wilson(F.col("rate"), F.col("due_units"), cfg.z90), 6).alias("half_width"), (F.coalesce("support", F.lit(0.0)) < cfg.support_floor).alias("below_floor"))


def support_bound(units: DataFrame, cfg: C.Config) -> DataFrame:
    """The worst a binomial rate of a series' future months can be off, in points and money."""
    future = units.where((F.col("ord") >= cfg.current) & (F.col("due_units") > 0))
    points = 100 * F.sqrt(F.lit(0.25) / F.greatest("due_units", F.lit(1)))
    return future.select("fs_id", "ord", "due_units", "due_cents", F.round(points, 6).alias("bound"), F.round(points * cfg.z90 * F.col("due_cents") / 10000, 2).alias("bound_usd"))


def two_stage_support(units: DataFrame, keys: list[str], cfg: C.Config) -> DataFrame:
    """Sums by group and month, then the median month; series, rate and its error by group."""
    month = closed(units, cfg).groupBy(*keys, "ord").agg(F.sum("due_units").alias("due"), F.sum("ren_units").alias("ren"))
    series = closed(units, cfg).groupBy(*keys).agg(F.count_distinct("fs_id").alias("series"))
    out = month.groupBy(*keys).agg(F.median(F.when(F.col("due") > 0, F.col("due").cast("double"))).alias("support"), F.sum("due").alias("due_units"), F.sum("ren").alias("ren_units")).join(series, keys)
    rate = ratio(F.col("ren_units"), F.col("due_units"))
    return out.select(*keys, "support", "series", "due_units", "ren_units", rate.alias("rate"), F.round(binomial_error(rate, F.col("due_units")), 6).alias("error"))


def eta_squared(summary: DataFrame, dim: str) -> DataFrame:
    """Share of the variance of series' rates (weighted by support) between the values of a dimension."""
    rows = summary.where("rate IS NOT NULL AND support > 0").select(F.col(dim).cast("string").alias("value"), "rate", F.col("support").alias("w"))
    by = rows.groupBy("value").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("rate")).alias("wx"), F.sum(F.col("w") * F.col("rate") ** 2).alias("wxx"))
    total = by.agg(F.sum("w").alias("w"), F.sum("wx").alias("wx"), F.sum("wxx").alias("wxx"), F.sum(F.col("wx") ** 2 / F.col("w")).alias("between"), F.count(F.lit(1)).alias("levels"))
    sst, ssb = F.col("wxx") - F.col("wx") ** 2 / F.col("w"), F.col("between") - F.col("wx") ** 2 / F.col("w")
    return total.select(F.lit(dim).alias("dimension"), "levels", F.round(F.when(sst > 0, ssb / sst).otherwise(0.0), 6).alias("eta2"))
