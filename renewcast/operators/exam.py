"""The exam of every series: alone, as the forecast does it, and as a spreadsheet would, on the same rows.

Each series with something due in an exam month is predicted with the months known ``h`` months before:

- raw: the technique of its composition on its own months (the challenger if these are too few; its own level below
  ``LEAST`` months; its mandatory cell's with none);
- framework: the composition's prediction, moved toward its reference by the levels known then;
- hoja_mandatory, hoja_global: the rate of the last ``SHEET_MONTHS`` known months, of the cell or of everything.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewcast import config as C
from renewcast.functions.columns import inverse_logit, join_id, logit, ratio
from renewcast.operators import backtest as B
from renewcast.operators.techniques import CHALLENGER

RAW, FRAMEWORK, CELL_SHEET, ALL_SHEET = "raw", "framework", "hoja_mandatory", "hoja_global"
METHODS = (RAW, FRAMEWORK, CELL_SHEET, ALL_SHEET)
LEAST, SHEET_MONTHS = 3, 12


def origins(cfg: C.Config) -> list[int]:
    """The last known months of all exam months and horizons."""
    return sorted({o - h for o in range(cfg.exam, cfg.current) for h in B.HORIZONS})


def levels(rows: DataFrame, keys: list[str], cfg: C.Config, months: int | None = None) -> DataFrame:
    """keys, origin, n (rows) and level (renewed over due) of the months known at each origin: one pass, one
    row a key and origin."""
    known = lambda o: (F.col("ord") <= o) if months is None else F.col("ord").between(o - months + 1, o)
    each = [F.struct(F.lit(o).alias("origin"), F.count(F.when(known(o), 1)).alias("n"), ratio(F.sum(F.when(known(o), F.col("ren_units"))), F.sum(F.when(known(o), F.col("due_units")))).alias("level")) for o in origins(cfg)]
    return rows.groupBy(*keys).agg(F.array(*each).alias("x")).select(*keys, F.explode("x").alias("x")).select(*keys, "x.origin", "x.n", "x.level")


def sheets(real: DataFrame, closed: DataFrame, cfg: C.Config) -> DataFrame:
    """real with the cell's and everything's rate of the last known year, as a spreadsheet has them."""
    cell = levels(closed, ["cell"], cfg, SHEET_MONTHS).select("cell", "origin", F.col("level").alias("sheet_cell"))
    everything = levels(closed, [], cfg, SHEET_MONTHS).select("origin", F.col("level").alias("sheet_all"))
    out = real.join(cell, ["cell", "origin"], "left").join(F.broadcast(everything), "origin", "left")
    return out.withColumn("sheet_cell", F.coalesce("sheet_cell", "sheet_all"))


def exam_rows(units: DataFrame, cfg: C.Config) -> tuple[DataFrame, DataFrame]:
    """(rows to predict, with h and origin; closed rows): months with something due."""
    rows = units.where("due_units > 0").where(F.col("ord") < cfg.current).select("fs_id", join_id(*cfg.mandatory).alias("cell"), "ord", "due_units", "ren_units")
    real = rows.where(F.col("ord") >= cfg.exam).select("*", F.explode(F.array(*map(F.lit, B.HORIZONS))).alias("h"))
    return real.withColumn("origin", F.col("ord") - F.col("h")), rows


def detail(units: DataFrame, patterns: DataFrame, pooled: DataFrame, decision: DataFrame, bands: DataFrame, weights: DataFrame, cfg: C.Config) -> DataFrame:
    """A row for each series, exam month, horizon and method, with the interval of raw and framework."""
    real, closed = exam_rows(units, cfg)
    decision = decision.select("composition", "h", "technique")
    base = sheets(real, closed, cfg).join(weights.select("fs_id", "composition", "reference", "z"), "fs_id", "left")
    cell = levels(closed, ["cell"], cfg).select("cell", "origin", F.col("level").alias("cell_level"))
    everything = levels(closed, [], cfg).select("origin", F.col("level").alias("all_level"))
    base = base.join(cell, ["cell", "origin"], "left").join(F.broadcast(everything), "origin", "left").withColumn("cell_level", F.coalesce("cell_level", "all_level"))

    # The composition's prediction, once a composition, month and horizon.
    asked = base.where("composition IS NOT NULL").select("composition", "ord", "h", "origin").distinct().join(B.histories(pooled), "composition")
    asked = asked.withColumn("seen", F.filter("history", lambda x: x["ord"] <= F.col("origin"))).where(F.size("seen") >= LEAST).join(decision, ["composition", "h"], "left")
    comp = B.predict_chosen(asked.select("composition", "origin", "h", "seen", F.coalesce("technique", F.lit(CHALLENGER)).alias("technique"))).withColumnsRenamed({"technique": "comp_technique", "rate": "comp_rate"})
    comp = comp.join(levels(pooled.where("due_units > 0"), ["composition"], cfg).select("composition", "origin", F.col("level").alias("comp_level")), ["composition", "origin"])
    wide = patterns.select("fs_id", F.col("pattern").alias("reference")).join(weights.select("reference").where("reference IS NOT NULL").distinct(), "reference").join(closed, "fs_id")
    base = base.join(comp, ["composition", "origin", "h"], "left").join(levels(wide, ["reference"], cfg).select("reference", "origin", F.col("level").alias("ref_level")), ["reference", "origin"], "left")
    z, r, p = F.coalesce("z", F.lit(1.0)), F.col("ref_level"), F.col("comp_level")
    shift = F.when((z < 1) & (r > 0) & (r < 1) & (p > 0) & (p < 1), (1 - z) * (logit(r) - logit(p))).otherwise(0.0)
    base = base.withColumn("shift", F.when(F.col("comp_rate").isNull(), 0.0).otherwise(shift))

    # The series alone, on its own months.
    alone = real.select("fs_id", "ord", "h", "origin").join(weights.select("fs_id", "composition"), "fs_id", "left").join(decision, ["composition", "h"], "left")
    alone = alone.join(B.histories(closed.withColumnRenamed("fs_id", "composition")).withColumnRenamed("composition", "fs_id"), "fs_id").withColumn("seen", F.filter("history", lambda x: x["ord"] <= F.col("origin"))).where(F.size("seen") >= LEAST)
    alone = B.predict_chosen(alone.select("fs_id", "ord", "h", "seen", F.coalesce("technique", F.lit(CHALLENGER)).alias("technique"))).withColumnsRenamed({"technique": "own_technique", "rate": "own_rate"})
    own = levels(closed, ["fs_id"], cfg).where("n > 0").select("fs_id", "origin", F.col("level").alias("own_level"))
    base = base.join(own, ["fs_id", "origin"], "left").join(alone, ["fs_id", "ord", "h"], "left")

    moved = F.when(F.col("shift") == 0, F.col("comp_rate")).otherwise(inverse_logit(logit(F.col("comp_rate")) + F.col("shift")))
    cell_name, none = F.lit("mandatory_cell"), F.lit(None).cast("double")
    sheet = F.lit(f"last {SHEET_MONTHS} months")
    method = lambda name, technique, rate, comp_rate=none, moved_by=F.lit(0.0): F.struct(F.lit(name).alias("method"), technique.alias("technique"), rate.alias("pred_rate"), comp_rate.alias("composition_rate"), moved_by.alias("shift"))
    each = F.array(method(RAW, F.coalesce("own_technique", F.when(F.col("own_level").isNotNull(), "own_level"), cell_name), F.coalesce("own_rate", "own_level", "cell_level")),
                   method(FRAMEWORK, F.coalesce("comp_technique", cell_name), F.coalesce(moved, F.col("cell_level")), F.col("comp_rate"), F.col("shift")),
                   method(CELL_SHEET, sheet, F.col("sheet_cell")), method(ALL_SHEET, sheet, F.col("sheet_all")))
    out = base.select("fs_id", "composition", "ord", "h", "origin", "due_units", F.col("ren_units").alias("real_units"), F.explode(each).alias("m")).select("fs_id", "composition", "ord", "h", "origin", "due_units", "real_units", "m.*")
    return measured(interval(out, bands, cfg))


def interval(rows: DataFrame, bands: DataFrame, cfg: C.Config) -> DataFrame:
    """band_low and band_high, as the forecast has them; none for spreadsheets."""
    edges = bands.select("technique", "h", "q_low", "q_high")
    rival = edges.where(F.col("technique") == CHALLENGER).select("h", F.col("q_low").alias("c_low"), F.col("q_high").alias("c_high"))
    out = rows.join(F.broadcast(edges), ["technique", "h"], "left").join(F.broadcast(rival), "h", "left")
    se = F.sqrt(F.col("pred_rate") * (1 - F.col("pred_rate")) / F.greatest("due_units", F.lit(1)))
    has = F.col("method").isin(RAW, FRAMEWORK)
    edge = lambda q: F.when(has, F.least(F.greatest(F.col("pred_rate") + q * se, F.lit(0.0)), F.lit(1.0)))
    return out.withColumns({"band_low": edge(F.least(F.coalesce("q_low", "c_low", F.lit(-cfg.z90)), F.lit(0.0))), "band_high": edge(F.greatest(F.coalesce("q_high", "c_high", F.lit(cfg.z90)), F.lit(0.0)))}).drop("q_low", "q_high", "c_low", "c_high")


def measured(rows: DataFrame) -> DataFrame:
    """Errors of predictions, and the noise of the real rate that even a perfect one would miss by."""
    p = F.col("pred_rate")
    out = rows.withColumn("real_rate", ratio(F.col("real_units"), F.col("due_units"))).withColumn("pred_units", p * F.col("due_units")).withColumn("err_units", F.col("pred_units") - F.col("real_units"))
    out = out.withColumn("err_pp", 100 * (p - F.col("real_rate"))).withColumn("noise_pp", 100 * F.sqrt(F.greatest(p * (1 - p), F.lit(0.0)) / F.greatest("due_units", F.lit(1))))
    return out.withColumn("in_band", F.when(F.col("band_low").isNotNull(), F.col("real_rate").between(F.col("band_low") - 1e-12, F.col("band_high") + 1e-12).cast("int")))


def per_series(rows: DataFrame) -> DataFrame:
    """Raw beside framework for each series: predictions, those in the interval, units, errors."""
    def of(m):
        on = lambda c: F.when(F.col("method") == m, c)
        rms = lambda c: F.sqrt(F.avg(on(F.col(c) * F.col(c))))
        n, real = F.count(on(F.lit(1))), F.sum(on(F.col("real_units")))
        wrong = F.sum(on(F.abs("err_units")))
        values = {"predictions": n, "in_band": F.sum(on(F.col("in_band"))), "pred_units": F.sum(on(F.col("pred_units"))), "real_units": real, "abs_err_units": wrong, "mae_pp": F.avg(on(F.abs("err_pp"))), "bias_pp": F.avg(on(F.col("err_pp"))), "rmse_pp": rms("err_pp"), "noise_pp": rms("noise_pp"),
                  "error_over_noise": F.try_divide(rms("err_pp"), rms("noise_pp")), "wape": F.try_divide(wrong, real.cast("double")), "coverage": F.try_divide(F.sum(on(F.col("in_band"))).cast("double"), n.cast("double"))}
        return [v.alias(f"{m}_{k}") for k, v in values.items()]

    out = rows.groupBy("fs_id").agg(*of(RAW), *of(FRAMEWORK))
    return out.withColumn("improvement_mae_pp", F.col(f"{RAW}_mae_pp") - F.col(f"{FRAMEWORK}_mae_pp"))


def by_month(rows: DataFrame) -> DataFrame:
    """The error of the total of each exam month and horizon, by method."""
    sums = rows.groupBy("ord", "h", "method").agg(F.sum("pred_units").alias("pred_units"), F.sum("real_units").alias("real_units"))
    return sums.withColumn("error_total", F.try_divide(F.col("pred_units") - F.col("real_units"), F.col("real_units").cast("double")))


def summary(rows: DataFrame) -> DataFrame:
    """By method and horizon: mean error and bias of the months' totals, WAPE of series, error over noise, share in the
    interval."""
    months = by_month(rows).groupBy("method", "h").agg(F.avg(F.abs("error_total")).alias("mean_error_total"), F.avg("error_total").alias("mean_bias_total"))
    rms = lambda c: F.sqrt(F.avg(F.col(c) * F.col(c)))
    series = rows.groupBy("method", "h").agg(F.try_divide(F.sum(F.abs("err_units")), F.sum("real_units").cast("double")).alias("wape_series"), F.try_divide(rms("err_pp"), rms("noise_pp")).alias("error_over_noise"), F.avg("in_band").alias("in_band"))
    return months.join(series, ["method", "h"])
