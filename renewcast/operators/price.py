"""Prices: the uplift hierarchy, its contract check and backtest, and the monitor of increases."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renewcast import config as C
from renewcast.functions.columns import discount_bucket, join_id

FLOOR, CAP, LEAST = 30, 3.0, 0.01
STEP, PERSISTENCE, REFERENCE, CYCLE = 0.03, 3, 6, 12


def renewers(fine: DataFrame, cfg: C.Config, before: int | None = None) -> DataFrame:
    return fine.where((F.col("ord") < (cfg.current if before is None else before)) & (F.col("ren_units") > 0) & (F.col("ts") == 0))


def _uplift(num, den):
    return F.try_divide(num.cast("double") / 200, den.cast("double"))


def uplifts(fine: DataFrame, cfg: C.Config, before: int | None = None) -> DataFrame:
    """The price at which each cell renews: its own if enough renew, else its parent's (any extra, same bucket),
    else its mandatory cell's, else everybody's."""
    ids = {"cell": join_id(*cfg.mandatory, "newcust", "bucket"), "parent": join_id(*cfg.mandatory, "bucket"), "wide": join_id(*cfg.mandatory)}
    cells = fine.where("ts = 0").select(*(v.alias(k) for k, v in ids.items())).distinct()
    rows = renewers(fine, cfg, before).select(*(v.alias(k) for k, v in ids.items()), "ren_units", "ren_value", "base_cents")
    for k in ids:
        level = rows.groupBy(k).agg(F.sum("ren_units").alias(f"n_{k}"), _uplift(F.sum("ren_value"), F.sum("base_cents")).alias(f"u_{k}"))
        cells = cells.join(level, k, "left")
    everybody = rows.agg(_uplift(F.sum("ren_value"), F.sum("base_cents")).alias("u_all"))
    n = lambda k: F.coalesce(f"n_{k}", F.lit(0))
    pick = lambda a, b, c, d: F.when(n("cell") >= FLOOR, a).when(n("parent") >= FLOOR, b).when(n("wide") > 0, c).otherwise(d)
    raw = pick(F.col("u_cell"), F.col("u_parent"), F.col("u_wide"), F.coalesce("u_all", F.lit(1.0)))
    return cells.crossJoin(F.broadcast(everybody)).select("cell", n("cell").alias("renewers"), pick(F.lit("propio"), F.lit("padre"), F.lit("celda"), F.lit("global")).alias("origin"), F.round(F.greatest(F.least(raw, F.lit(CAP)), F.lit(LEAST)), 9).alias("uplift"))


def contract_check(fine: DataFrame, cfg: C.Config) -> DataFrame:
    """What a contract's discount says (1 / (1 - discount)) against what is paid, by bucket."""
    rows = renewers(fine, cfg).where("percent IS NOT NULL")
    rule = 1 / (1 - F.least(F.col("percent") / 100.0, F.lit(0.99)))
    paid = F.col("ren_value") / 200.0 / F.col("base_cents")
    near = F.abs(paid / rule - 1) <= 0.02
    return rows.groupBy("bucket").agg(F.sum("ren_units").alias("renewers"), F.round(_uplift(F.sum("ren_value"), F.sum("base_cents")), 6).alias("paid"), F.round(F.sum(rule * F.col("base_cents")) / F.sum("base_cents"), 6).alias("rule"), F.round(F.coalesce(F.sum(F.when(near, F.col("base_cents"))), F.lit(0)) / F.sum("base_cents"), 6).alias("share_near"))


def uplift_backtest(fine: DataFrame, cfg: C.Config) -> DataFrame:
    """Both ways to price the exam months, fitted before them: error by bucket; the contract wins only if it is
    strictly better."""
    fit = uplifts(fine, cfg, cfg.exam).select(F.col("cell").alias("cell_id"), "uplift")
    rows = renewers(fine, cfg).where(F.col("ord") >= cfg.exam).join(fit, "cell_id")
    paid, base = F.col("ren_value") / 20000.0, F.col("base_cents") / 100.0
    rule = 1 / (1 - F.least(F.coalesce(F.col("percent"), F.lit(0)) / 100.0, F.lit(0.99)))
    wape = lambda u: F.round(F.sum(F.abs(base * u - paid)) / F.sum(paid), 6)
    out = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), wape(F.col("uplift")).alias("wape_statistical"), wape(rule).alias("wape_contract"))
    return out.withColumn("method", F.when(F.col("wape_contract") < F.col("wape_statistical"), "contrato").otherwise("estadistico"))


def weighted_percentiles(fine: DataFrame, cfg: C.Config) -> DataFrame:
    """The uplifts below which 10, 50 and 90 % of the renewed money lie, between rows by straight lines; rows of equal
    uplift stay apart, in the order of their money (ties are then alike)."""
    order = [F.col("u"), F.col("base_cents")]
    rows = renewers(fine, cfg).select("region", (F.col("ren_value") / 200.0 / F.col("base_cents")).alias("u"), "base_cents")
    return percentiles(rows, ["region"], order, "base_cents", {"p10": 0.1, "p50": 0.5, "p90": 0.9})


def percentiles(rows: DataFrame, keys: list[str], order: list, weight: str, wanted: dict[str, float]) -> DataFrame:
    """By keys, the points of ``u`` at shares of the summed weight; below the first row's share its own u.  Equal rows
    are summed before the window, so that none holds more rows than there are different ones."""
    same = rows.groupBy(*keys, "u", weight).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys).orderBy(*order)
    upto = F.sum(F.col(weight) * F.col("n")).over(w)
    total = F.sum(F.col(weight) * F.col("n")).over(Window.partitionBy(*keys)).cast("double")
    # The n equal rows of a place end at shares last - (n - 1) * weight, ..., last, all with the same u: a line runs
    # from the row before them to the first of them and is level from there on.
    same = same.withColumn("upto", upto).withColumn("total", total)
    same = same.select(*keys, "u", "total", (F.col("upto") / F.col("total")).alias("last"), ((F.col("upto") - (F.col("n") - 1) * F.col(weight)) / F.col("total")).alias("first"), F.lag("u").over(w).alias("u0"), (F.lag("upto").over(w) / F.col("total")).alias("s0"))

    def at(q):
        on = F.col("last") >= q
        value = F.when((F.col("first") <= q) | F.col("u0").isNull(), F.col("u")).otherwise(F.col("u0") + (F.col("u") - F.col("u0")) * (q - F.col("s0")) / (F.col("first") - F.col("s0")))
        return F.round(F.min_by(F.when(on, value), F.when(on, F.col("last"))), 6)

    return same.groupBy(*keys).agg(*(at(q).alias(k) for k, q in wanted.items()))


def monitor(fine: DataFrame, cfg: C.Config, step: float = STEP) -> DataFrame:
    """Uplift by product and month against its previous 12 months; a run of months above the step starts an
    increase, whose cycle lasts 12 months."""
    rows = renewers(fine, cfg).groupBy("product", "ord").agg(_uplift(F.sum("ren_value"), F.sum("base_cents")).alias("uplift"), F.sum("ren_value").alias("ren_value"))
    return increases(rows, step)


def increases(rows: DataFrame, step: float = STEP) -> DataFrame:
    by = Window.partitionBy("product").orderBy("ord")
    prior = by.rowsBetween(-12, -1)
    rows = rows.withColumn("before", F.when(F.count("uplift").over(prior) >= REFERENCE, F.avg("uplift").over(prior)))
    rows = rows.withColumn("step", F.round(F.try_divide(F.col("uplift"), F.col("before")) - 1, 6)).withColumn("above", F.coalesce(F.col("step") >= step, F.lit(False)).cast("int"))
    rows = rows.withColumn("n", F.row_number().over(by)).withColumn("island", F.col("n") - F.row_number().over(Window.partitionBy("product", "above").orderBy("ord")))
    run = Window.partitionBy("product", "above", "island")
    rows = rows.withColumn("starts", ((F.col("above") == 1) & (F.count(F.lit(1)).over(run) >= PERSISTENCE) & (F.col("n") == F.min("n").over(run))).cast("int"))
    since = F.col("n") - F.last(F.when(F.col("starts") == 1, F.col("n")), ignorenulls=True).over(by)
    return rows.withColumn("in_cycle", F.max("starts").over(by.rowsBetween(1 - CYCLE, 0))).withColumn("months_since", since).select("product", "ord", F.round("uplift", 6).alias("uplift"), F.round("before", 6).alias("before"), "step", "above", "starts", "in_cycle", "months_since", "ren_value")


def increase_calendar(monitored: DataFrame) -> DataFrame:
    """One row an increase: the months of its cycle seen so far and what renewed in them."""
    start = monitored.where("starts = 1").select("product", F.col("ord").alias("start"), "step")
    rows = start.join(monitored.select("product", "ord", "uplift", "ren_value"), "product").where((F.col("ord") >= F.col("start")) & (F.col("ord") < F.col("start") + CYCLE))
    return rows.groupBy("product", "start", "step").agg(F.count("uplift").alias("months_seen"), F.sum("ren_value").alias("ren_value"))


def longest_runs(monitored: DataFrame, cfg: C.Config, months: int = CYCLE) -> DataFrame:
    """By product, of its last closed months: how many are above the step, the longest run of such months, and what that
    says: an increase, scattered months, or none."""
    rows = monitored.where((F.col("ord") >= cfg.current - months) & (F.col("ord") < cfg.current) & F.col("step").isNotNull())
    by = Window.partitionBy("product")
    # Months in a row have the same difference of their place among all and among those of their kind.
    place = F.row_number().over(by.orderBy("ord")) - F.row_number().over(Window.partitionBy("product", "above").orderBy("ord"))
    runs = rows.withColumn("island", place).groupBy("product", "above", "island").agg(F.count(F.lit(1)).alias("n"), F.max("step").alias("step"))
    of = F.col("above") == 1
    out = runs.groupBy("product").agg(F.sum("n").alias("months"), F.coalesce(F.sum(F.when(of, F.col("n"))), F.lit(0)).alias("months_above"), F.coalesce(F.max(F.when(of, F.col("n"))), F.lit(0)).alias("longest_run"), F.max("step").alias("largest_step"))
    return out.withColumn("verdict", F.when(F.col("longest_run") >= PERSISTENCE, "increase").when(F.col("months_above") > 0, "scattered").otherwise("none"))


def homogeneity(licences: DataFrame, fine: DataFrame, cfg: C.Config) -> DataFrame:
    """How much uplifts differ within a region and discount, weighted by money: exactly, from single licences, and as
    the extract's rows tell, whose licences are taken for alike.  Both from three sums that can be merged (weight, weight
    times uplift, weight times its square)."""
    def spread(rows: DataFrame, x: str) -> DataFrame:
        u = F.col("ren_value") / 200.0
        sums = rows.groupBy("region", "bucket").agg(F.count(F.lit(1)).alias(f"{x}_rows"), F.sum("base_cents").cast("double").alias("w"), F.sum(u).alias("wu"), F.sum(u * u / F.col("base_cents")).alias("wuu"))
        mean = F.col("wu") / F.col("w")
        return sums.select("region", "bucket", f"{x}_rows", F.round(mean, 6).alias(f"{x}_mean"), F.round(F.sqrt(F.greatest(F.col("wuu") / F.col("w") - mean * mean, F.lit(0.0))), 6).alias(f"{x}_std"))

    single = licences.where((F.col("ts") == 0) & (F.col("ord") < cfg.current) & (F.col("ren_units") > 0) & (F.col("base_cents") > 0)).withColumn("bucket", discount_bucket(F.col("percent"), cfg.bucket_edges))
    out = spread(single, "exact").join(spread(renewers(fine, cfg), "rows"), ["region", "bucket"], "full")
    return out.withColumn("hidden", F.round(F.col("exact_std") - F.col("rows_std"), 6))
