"""The second universe: its months to come from last year's, their falling due again, and the grand total."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewcast import config as C
from renewcast.functions.columns import ratio

#: Origins of rows.
REAL, PROJECTED, REENTRY = "ts_real", "ts_proyectado", "ts_reentrada"
RENEWED, EXPECTED, EXTENDED, SIMULATED, TOTAL = "pipeline_renovado_real", "pipeline_real_esperado", "pipeline_proyectada", "pipeline_simulada", "TOTAL"
LEVEL_MONTHS, YEAR, DISCOUNT = 3, 12, 0.4
#: What a unit of ren_value is of a unit of money.
VALUE = 20000.0


def second_universe(fine: DataFrame, cfg: C.Config) -> DataFrame:
    """Region and month: what was acquired this year so far, what will be until December, and what of the latter
    is renewed a year later.

    A coming month has the units of the same month a year before times the region's level (its last months against
    theirs a year before), at its value a unit of the last year.  A region without that month or a level takes its
    share of all regions' total.  Acquisitions were at a discount and are renewed at the full price, at the region's
    rate in the normal universe (that of everything, if it has none)."""
    now, first = cfg.current, cfg.current // 12 * 12
    month = fine.where((F.col("ts") == 1) & (F.col("ord") < now)).groupBy("region", "ord").agg(F.coalesce(F.sum("ren_units"), F.lit(0)).alias("units"), F.coalesce(F.sum("ren_value"), F.lit(0)).alias("value"))
    of = lambda a, b, c="units": F.sum(F.when(F.col("ord").between(a, b), F.col(c)))
    sums = [of(now - LEVEL_MONTHS, now - 1).alias("recent"), of(now - LEVEL_MONTHS - 12, now - 13).alias("before"), of(now - YEAR, now - 1).alias("year_units"), of(now - YEAR, now - 1, "value").alias("year_value")]
    level, price = ratio(F.col("recent"), F.col("before")), F.try_divide(F.col("year_value") / VALUE, F.col("year_units").cast("double"))
    region = month.groupBy("region").agg(*sums).select("region", level.alias("level"), price.alias("price"), F.col("year_units").alias("own_units"))
    everything = month.agg(*sums).select(level.alias("all_level"), price.alias("all_price"), F.col("year_units").alias("all_units"))
    old = month.where(F.col("ord").between(now - 12, first - 1)).select("region", (F.col("ord") + 12).alias("ord"), "units")
    totals = old.groupBy("ord").agg(F.sum("units").alias("total_units"))
    rows = region.crossJoin(F.broadcast(everything)).withColumn("ord", F.explode(F.sequence(F.lit(now), F.lit(first + 11)))).join(old, ["region", "ord"], "left").join(F.broadcast(totals), "ord", "left")
    shared = F.col("units").isNull() | F.col("level").isNull()
    amount = F.when(shared, F.col("total_units") * F.col("all_level") * ratio(F.col("own_units"), F.col("all_units"))).otherwise(F.col("units") * F.col("level"))
    rows = rows.select("region", "ord", amount.alias("units"), F.when(shared, F.coalesce("price", "all_price")).otherwise(F.col("price")).alias("price"), F.when(shared, F.col("all_level")).otherwise(F.col("level")).alias("level"), shared.cast("int").alias("by_share")).where("units IS NOT NULL")
    rows = rows.withColumn("value", F.col("units") * F.col("price"))
    ahead = rows.select("region", "ord", F.lit(PROJECTED).alias("origin"), "units", "value", "level", "by_share", F.col("value").alias("revenue"))
    real = month.where(F.col("ord") >= first).select("region", "ord", F.lit(REAL).alias("origin"), F.col("units").cast("double").alias("units"), (F.col("value") / VALUE).alias("value")).withColumn("revenue", F.col("value"))
    window = fine.where((F.col("ts") == 0) & F.col("ord").between(now - YEAR, now - 1))
    rate = lambda x: ratio(F.sum("ren_units"), F.sum("due_units")).alias(x)
    again = rows.join(window.groupBy("region").agg(rate("own_rate")), "region", "left").crossJoin(F.broadcast(window.agg(rate("all_rate")))).withColumn("rate", F.coalesce("own_rate", "all_rate"))
    again = again.select("region", (F.col("ord") + 12).alias("ord"), F.lit(REENTRY).alias("origin"), "units", "value", "rate", F.when(F.col("own_rate").isNull(), "global").otherwise("region").alias("rate_level"), (F.col("units") * F.col("rate")).alias("renewed_units"), (F.col("value") / (1 - DISCOUNT) * F.col("rate")).alias("revenue"))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (real, ahead, again))
    return out.withColumns({c: F.round(c, 4) for c in ("units", "value", "renewed_units", "revenue")} | {c: F.round(c, 6) for c in ("level", "rate")})


def grand_total(fine: DataFrame, core: DataFrame, second: DataFrame, cfg: C.Config) -> DataFrame:
    """From the current year on, by year and origin and in all: what falls due and what is or will be renewed.  Money
    of extensions and simulated acquisitions isn't forecast, so theirs is null."""
    year = F.floor(F.col("ord") / 12).cast("int").alias("year")
    closed = fine.where((F.col("ts") == 0) & (F.col("ord") < cfg.current)).select(year, F.lit(RENEWED).alias("origin"), F.col("due_units").cast("double").alias("due_units"), (F.col("due_cents") / 100).alias("due_value"), F.col("ren_units").cast("double").alias("renewed_units"), (F.col("ren_value") / VALUE).alias("renewed_value"))
    label = F.when(F.col("source") == "forecast", EXPECTED).when(F.col("source") == "extension", EXTENDED).otherwise(SIMULATED)
    ahead = core.where(F.col("source").isin("forecast", "extension", "acquisition")).select(year, label.alias("origin"), F.col("due_units").cast("double").alias("due_units"), (F.col("due_cents") / 100).alias("due_value"), F.col("expected_units").alias("renewed_units"), (F.col("expected_cents") / 100).alias("renewed_value"))
    again = F.col("origin") == REENTRY
    apart = second.select(year, "origin", F.when(again, F.col("units")).otherwise(0.0).alias("due_units"), F.when(again, F.col("value")).otherwise(0.0).alias("due_value"), F.when(again, F.col("renewed_units")).otherwise(F.col("units")).alias("renewed_units"), F.col("revenue").alias("renewed_value"))
    rows = closed.unionByName(ahead).unionByName(apart).where(F.col("year") >= cfg.current // 12)
    by = rows.groupBy("year", "origin").agg(*(F.sum(c).alias(c) for c in ("due_units", "due_value", "renewed_units", "renewed_value")))
    both = by.unionByName(by.groupBy("year").agg(*(F.sum(c).alias(c) for c in ("due_units", "due_value", "renewed_units", "renewed_value"))).withColumn("origin", F.lit(TOTAL)))
    return both.select("year", "origin", *(F.round(c, 2).alias(c) for c in ("due_units", "due_value", "renewed_units", "renewed_value")))
