"""Dynamics of monthly rates: overdispersion, trend, season, and how steady the season is."""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

LEAST_MONTHS, SIGNIFICANT, SIGMAS, LEAST_SHARED = 24, 0.05, 2.0, 3


def residuals(pooled: DataFrame, least: int = LEAST_MONTHS) -> DataFrame:
    """Months of compositions that have enough, with what their weighted straight line leaves."""
    w = Window.partitionBy("composition")
    rows = pooled.where("due_units > 0").select("composition", "ord", "due_units", "ren_units", (F.col("ren_units") / F.col("due_units")).alias("rate"), F.count(F.lit(1)).over(w).alias("n"), F.avg("due_units").over(w).alias("mean_due"), F.min("ord").over(w).alias("first"))
    rows = rows.where(F.col("n") >= least).withColumn("w", F.col("due_units") / F.col("mean_due")).withColumn("t", (F.col("ord") - F.col("first")) / 12.0)
    mean = lambda c: F.sum(F.col("w") * F.col(c)).over(w) / F.sum("w").over(w)
    rows = rows.withColumn("tm", mean("t")).withColumn("rm", mean("rate"))
    dt, dr = F.col("t") - F.col("tm"), F.col("rate") - F.col("rm")
    rows = rows.withColumn("sxx", F.sum(F.col("w") * dt * dt).over(w)).withColumn("slope", F.try_divide(F.sum(F.col("w") * dt * dr).over(w), F.col("sxx")))
    return rows.withColumn("res", dr - F.col("slope") * dt)


def profile(rows: DataFrame) -> DataFrame:
    """Effect of each calendar month, its error and the sums of the season's test."""
    wr = F.col("w") * F.col("res")
    month = rows.groupBy("composition", "n", (F.col("ord") % 12 + 1).cast("int").alias("month")).agg(F.sum("w").alias("mw"), F.sum(wr).alias("wr"), F.sum(wr * F.col("res")).alias("wrr"), F.count(F.lit(1)).alias("seen"))
    w = Window.partitionBy("composition")
    month = month.withColumn("effect", F.col("wr") / F.col("mw") - F.sum("wr").over(w) / F.sum("mw").over(w)).withColumn("months", F.count(F.lit(1)).over(w))
    month = month.withColumn("within", F.sum(F.col("wrr") - F.col("wr") ** 2 / F.col("mw")).over(w)).withColumn("between", F.sum(F.col("mw") * F.col("effect") ** 2).over(w))
    month = month.withColumn("df1", F.greatest(F.col("months") - 1, F.lit(1))).withColumn("df2", F.greatest(F.col("n") - F.col("months") - 1, F.lit(1)))
    return month.withColumn("error", F.sqrt(F.greatest("within", F.lit(0.0)) / F.col("df2") / F.col("seen")))


def month_profile(pooled: DataFrame) -> DataFrame:
    return profile(residuals(pooled)).select("composition", "month", F.round(100 * F.col("effect"), 6).alias("effect_pp"), F.round(100 * F.col("error"), 6).alias("error_pp"), "seen")


def steadiness(rows: DataFrame) -> DataFrame:
    """Correlation of the calendar months' mean residuals between the earlier and the later half of the years."""
    year = F.floor(F.col("ord") / 12)
    middle = rows.select("composition", year.alias("y")).distinct().groupBy("composition").agg(F.median("y").alias("middle"))
    early = F.col("y") <= F.col("middle")
    half = rows.select("composition", year.alias("y"), (F.col("ord") % 12).alias("m"), "res").join(middle, "composition")
    half = half.groupBy("composition", "m").agg(F.avg(F.when(early, F.col("res"))).alias("a"), F.avg(F.when(~early, F.col("res"))).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    out = half.groupBy("composition").agg(F.count(F.lit(1)).alias("shared"), F.corr("a", "b").alias("r"), F.stddev("a").alias("sa"), F.stddev("b").alias("sb"))
    return out.select("composition", F.when((F.col("shared") >= LEAST_SHARED) & (F.col("sa") > 0) & (F.col("sb") > 0), F.round("r", 6)).alias("consistency"))


def statistics(pooled: DataFrame, least: int = LEAST_MONTHS) -> DataFrame:
    """One row a composition: phi, trend with its t, season with its F, amplitude and months out of line."""
    rows = residuals(pooled, least)
    p = F.sum("ren_units") / F.sum("due_units")
    own = rows.groupBy("composition", "n", "sxx", "slope").agg(p.alias("rate"), F.var_samp("rate").alias("var"), F.avg(1 / F.col("due_units")).alias("per"), F.sum(F.col("w") * F.col("res") ** 2).alias("rss"))
    se = F.sqrt(F.col("rss") / (F.col("n") - 2) / F.col("sxx"))
    out_of_line = lambda sign: F.array_join(F.sort_array(F.collect_list(F.when(sign * F.col("effect") > SIGMAS * F.col("error"), F.col("month")))), ",")
    season = profile(rows).groupBy("composition", "df1", "df2", "within", "between").agg((F.max("effect") - F.min("effect")).alias("amplitude"), out_of_line(1).alias("high"), out_of_line(-1).alias("low"))
    f = F.when(F.col("within") > 1e-15, (F.col("between") / F.col("df1")) / (F.col("within") / F.col("df2"))).otherwise(0.0)
    return own.join(season, "composition").join(steadiness(rows), "composition", "left").select(
        "composition", F.col("n").alias("months"), F.round("rate", 6).alias("rate"), F.round(F.try_divide(F.col("var"), F.col("rate") * (1 - F.col("rate")) * F.col("per")), 6).alias("phi"),
        F.round(100 * F.col("slope"), 6).alias("trend_pp"), F.round(F.coalesce(F.try_divide(F.col("slope"), se), F.lit(0.0)), 6).alias("t"), F.round(f, 6).alias("f"), "df1", "df2",
        F.round(100 * F.col("amplitude"), 6).alias("amplitude_pp"), "high", "low", "consistency")


def beta_tail(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function I_x(a, b) by Simpson's rule on the sine-squared scale, where the
    integrand is smooth for a, b >= 1/2; good to about 1e-8 for the degrees of freedom of monthly series."""
    u = np.linspace(0.0, 1.0, 4001)
    weight = np.where(np.arange(u.size) % 2, 4.0, 2.0)
    weight[[0, -1]] = 1.0

    def area(top):
        angle = u[None, :] * top[:, None]
        with np.errstate(divide="ignore"):
            s, c = np.log(np.sin(angle)), np.log(np.abs(np.cos(angle)))
        power = lambda k, v: np.where(k == 0, 0.0, k * np.where(np.isneginf(v) & (k == 0), 0.0, v))
        values = np.exp(power((2 * a - 1)[:, None], s) + power((2 * b - 1)[:, None], c))
        return (values * weight).sum(axis=1) * top

    half = np.full(x.shape, np.pi / 2)
    return area(np.arcsin(np.sqrt(np.clip(x, 0.0, 1.0)))) / area(half)


@F.pandas_udf(DoubleType())
def f_tail(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    """P(F > f)."""
    a, b = df2.to_numpy(float) / 2, df1.to_numpy(float) / 2
    return pd.Series(beta_tail(df2.to_numpy(float) / (df2.to_numpy(float) + df1.to_numpy(float) * f.to_numpy(float)), a, b))


def tests(pooled: DataFrame, least: int = LEAST_MONTHS) -> DataFrame:
    """The statistics with their p-values and verdicts.  A t squared is an F of one degree."""
    rows = statistics(pooled, least).withColumn("p_trend", F.round(f_tail(F.col("t") ** 2, F.lit(1), F.col("months") - 2), 6)).withColumn("p_month", F.round(f_tail("f", "df1", "df2"), 6))
    return rows.withColumn("trend", F.when(F.col("p_trend") < SIGNIFICANT, F.signum("trend_pp").cast("int")).otherwise(0)).withColumn("seasonal", (F.col("p_month") < SIGNIFICANT).cast("int"))
