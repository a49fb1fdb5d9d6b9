"""Dynamics of every series and of the portfolio, and the exam by segments of them, which overlap."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewcast import config as C
from renewcast.functions.columns import ratio
from renewcast.operators import dynamics as D
from renewcast.operators.exam import FRAMEWORK, RAW
from renewcast.operators.series import closed

#: Months that a trend needs; a season needs as many as in compositions.  Above PHI a rate moves more than by chance.
TREND_MONTHS, PHI = 12, 1.5
SHORT, THIN, MEASURABLE = "short_history", "low_support", "yes"
PORTFOLIO = "portfolio"


def rated(units: DataFrame, cfg: C.Config) -> DataFrame:
    """Closed months of series in which something fell due."""
    return closed(units, cfg).where("due_units > 0")


def portfolio(units: DataFrame, cfg: C.Config) -> DataFrame:
    """The months of everything, in the form of one composition."""
    return rated(units, cfg).groupBy("ord").agg(F.sum("due_units").alias("due_units"), F.sum("ren_units").alias("ren_units")).withColumn("composition", F.lit(PORTFOLIO))


def series_dynamics(chosen: DataFrame, summary: DataFrame, units: DataFrame, tested: DataFrame, cfg: C.Config) -> DataFrame:
    """One row a series: phi, trend and season on its own months, whether they can be relied on (``measurable``), and
    whether they differ from its composition's (``tested``: its tests).  A rate that never moves has no trend."""
    months = rated(units, cfg)
    own = D.tests(months.select(F.col("fs_id").alias("composition"), "ord", "due_units", "ren_units"), TREND_MONTHS)
    moves, long = F.col("trend_pp") != 0, F.col("n") >= D.LEAST_MONTHS
    season = lambda c, still: F.when(long, F.when(F.col("amplitude_pp") != 0, F.col(c)).otherwise(still))
    own = own.withColumnRenamed("months", "n").select(F.col("composition").alias("fs_id"), "phi", F.when(moves, F.col("trend")).otherwise(0).alias("trend"), "trend_pp", F.when(moves, F.col("p_trend")).otherwise(1.0).alias("p_trend"),
                                                      season("seasonal", 0).alias("seasonal"), season("p_month", 1.0).alias("p_month"), season("amplitude_pp", 0.0).alias("amplitude_pp"), season("high", "").alias("high"), season("low", "").alias("low"))
    group = tested.select("composition", F.col("trend").alias("composition_trend"), F.col("seasonal").alias("composition_seasonal"))
    seen = months.groupBy("fs_id").agg(F.count(F.lit(1)).alias("months"))
    rows = chosen.select("fs_id", "composition").join(seen, "fs_id", "left").join(summary.select("fs_id", F.coalesce("support", F.lit(0.0)).alias("own_support")), "fs_id", "left").join(own, "fs_id", "left").join(group, "composition", "left")
    rows = rows.withColumns({"months": F.coalesce("months", F.lit(0)), "own_support": F.coalesce("own_support", F.lit(0.0))})
    rows = rows.withColumn("measurable", F.when(F.col("months") < TREND_MONTHS, SHORT).when(F.col("own_support") < cfg.support_floor, THIN).otherwise(MEASURABLE))
    other = ((F.col("trend") != 0) & (F.col("trend") != F.col("composition_trend"))) | (F.col("seasonal") != F.col("composition_seasonal"))
    differs = (F.col("measurable") == MEASURABLE) & F.col("composition_trend").isNotNull() & F.coalesce(other, F.lit(False))
    return rows.select("fs_id", "composition", "months", "own_support", "measurable", "phi", "trend", "trend_pp", "p_trend", "seasonal", "p_month", "amplitude_pp", "high", "low", "composition_trend", "composition_seasonal", differs.cast("int").alias("differs"))


def dynamics_shares(tested: DataFrame, chosen: DataFrame, units: DataFrame, cfg: C.Config) -> DataFrame:
    """Compositions and the money that their series have to predict, by what their rates do; attributes overlap."""
    money = units.where(F.col("ord") >= cfg.current).groupBy("fs_id").agg(F.sum("due_cents").alias("cents"))
    by = chosen.select("fs_id", "composition").join(money, "fs_id", "left").groupBy("composition").agg(F.coalesce(F.sum("cents"), F.lit(0)).alias("cents"))
    rows = tested.join(by, "composition")
    marks = {"measured": F.col("phi").isNotNull(), "more_than_noise": F.col("phi") > PHI, "trend": F.col("trend") != 0, "seasonal": F.col("seasonal") == 1}
    total = rows.agg(F.sum("cents").alias("all_cents"))
    out = rows.select("cents", F.explode(_of(marks)).alias("attribute")).groupBy("attribute").agg(F.count(F.lit(1)).alias("compositions"), F.sum("cents").alias("cents"))
    return out.crossJoin(F.broadcast(total)).select("attribute", "compositions", "cents", F.round(F.coalesce(ratio(F.col("cents"), F.col("all_cents")), F.lit(0.0)), 6).alias("share"))


def _of(marks: dict):
    """The names of the groups that a row is in: any number of them, in one pass."""
    return F.array_compact(F.array(*(F.when(m, name) for name, m in marks.items())))


def exam_segments(per_series: DataFrame, dynamics: DataFrame) -> DataFrame:
    """The series' exam summed by segment: the framework beside the series alone.  A series counts in each of its
    segments; only ``measurable`` ones are in those of trend and season."""
    rows = per_series.where(f"{FRAMEWORK}_predictions > 0").join(dynamics.select("fs_id", "measurable", "phi", "trend", "seasonal"), "fs_id", "left")
    sure, trend = F.coalesce(F.col("measurable") == MEASURABLE, F.lit(False)), F.coalesce("trend", F.lit(0))
    marks = {"all": F.lit(True), "low_phi": F.col("phi") <= PHI, "high_phi": F.col("phi") > PHI, "trend": sure & (trend != 0), "no_trend": sure & (trend == 0), "seasonal": sure & (F.col("seasonal") == 1), "not_seasonal": sure & (F.col("seasonal") == 0), "not_measurable": ~sure}
    sums = [F.sum(f"{m}_{c}").alias(f"{m}_{c}") for m in (FRAMEWORK, RAW) for c in ("predictions", "in_band", "pred_units", "real_units", "abs_err_units")]
    by = rows.select("*", F.explode(_of(marks)).alias("segment")).groupBy("segment").agg(F.count(F.lit(1)).alias("series"), *sums)
    of = lambda m, a, b: ratio(F.col(f"{m}_{a}"), F.col(f"{m}_{b}"))
    return by.select("segment", "series", F.col(f"{FRAMEWORK}_predictions").alias("predictions"), of(FRAMEWORK, "in_band", "predictions").alias("in_band"), of(RAW, "in_band", "predictions").alias("in_band_raw"),
                     of(FRAMEWORK, "abs_err_units", "real_units").alias("wape"), of(RAW, "abs_err_units", "real_units").alias("wape_raw"), (of(FRAMEWORK, "pred_units", "real_units") - 1).alias("bias"))


def noise_by_size(rows: DataFrame, cfg: C.Config) -> DataFrame:
    """Of the exam's rows, by what falls due and method: error, the noise that no prediction removes, and its share."""
    size = F.when(F.col("due_units") < cfg.support_floor, 0).when(F.col("due_units") < cfg.support_full, cfg.support_floor).otherwise(cfg.support_full)
    rms = lambda c: F.sqrt(F.avg(F.col(c) * F.col(c)))
    by = rows.where(F.col("method").isin(RAW, FRAMEWORK)).groupBy(size.alias("due_from"), "method").agg(F.count(F.lit(1)).alias("predictions"), rms("err_pp").alias("error_pp"), rms("noise_pp").alias("noise_pp"))
    part = F.col("noise_pp") * F.col("noise_pp") / (F.col("error_pp") * F.col("error_pp"))
    return by.select("*", F.try_divide("error_pp", "noise_pp").alias("error_over_noise"), F.when(F.col("error_pp") > 0, F.least(part, F.lit(1.0))).alias("noise_share"))


def noise_of_total(rows: DataFrame) -> DataFrame:
    """The error of the whole portfolio's rate over exam months and horizons, and its noise, by method."""
    p = F.col("pred_rate")
    due = F.sum("due_units")
    month = rows.where(F.col("method").isin(RAW, FRAMEWORK)).groupBy("ord", "h", "method").agg((100 * (F.sum("pred_units") - F.sum("real_units")) / due).alias("error"), (100 * F.sqrt(F.sum(p * (1 - p) * F.col("due_units"))) / due).alias("noise"))
    rms = lambda c: F.sqrt(F.avg(F.col(c) * F.col(c)))
    return month.groupBy("method").agg(rms("error").alias("error_pp"), rms("noise").alias("noise_pp")).withColumn("error_over_noise", F.try_divide("error_pp", "noise_pp"))


#: Half the interval of a rate that nothing is known of, in points; the rate counts as known within PROMISE.
UNKNOWN_PP, PROMISE = 50.0, 5.0


def _before_after(estimated: DataFrame, summary: DataFrame, cfg: C.Config) -> DataFrame:
    own = summary.select("fs_id", F.col("support").alias("own_support"), F.col("months").alias("own_months"), F.col("half_width").alias("before"))
    return estimated.join(own, "fs_id", "left").withColumns({"own_support": F.coalesce("own_support", F.lit(0.0)), "before": F.when(F.col("own_months") > 0, F.col("before")), "after": cfg.z90 * F.col("error_estimate_pp")})


def support_buckets(estimated: DataFrame, summary: DataFrame, cfg: C.Config) -> DataFrame:
    """Series and the money that they have to predict, by their own support: none, below the floor, up to full, full."""
    n = F.col("own_support")
    place = F.when(n <= 0, "0_none").when(n < cfg.support_floor, "1_below_floor").when(n < cfg.support_full, "2_evidence").otherwise("3_own_rate")
    out = _before_after(estimated, summary, cfg).groupBy(place.alias("support")).agg(F.count(F.lit(1)).alias("series"), F.sum("to_predict_cents").alias("to_predict_cents"))
    return out.crossJoin(F.broadcast(estimated.agg(F.sum("to_predict_cents").alias("all_cents")))).select("support", "series", "to_predict_cents", F.round(F.coalesce(ratio(F.col("to_predict_cents"), F.col("all_cents")), F.lit(0.0)), 6).alias("share"))


def support_gain(estimated: DataFrame, summary: DataFrame, cfg: C.Config) -> DataFrame:
    """What the ladder gains: the money whose rate is known within ``PROMISE`` points, and the error weighed by money,
    with each series' own support and with its group's."""
    money = F.col("to_predict_cents")
    known = lambda c: F.coalesce(F.sum(F.when(F.col(c) <= PROMISE, money)), F.lit(0))
    error = lambda c: F.try_divide(F.sum(F.coalesce(F.col(c), F.lit(UNKNOWN_PP)) * money), F.sum(money).cast("double"))
    row = _before_after(estimated, summary, cfg).agg(F.sum(money).alias("all_cents"), *(f(c).alias(f"{n}_{c}") for c in ("before", "after") for n, f in (("known", known), ("error", error))))
    return row.select("all_cents", *(F.col(f"known_{c}").alias(f"known_cents_{c}") for c in ("before", "after")), *(F.round(f"error_{c}", 6).alias(f"error_pp_{c}") for c in ("before", "after")))
