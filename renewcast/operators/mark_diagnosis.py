"""Marks that aren't final yet, for whoever decides how the forecast carries them: today's against the final ones of the
same calendar month, what each combination costs, and what each open month would renew with one mix or the other.

Rates are those of the history, not the forecast's: they measure the size of the effect.  Pipeline that doesn't exist
yet (extensions, simulated acquisitions) counts as unmarked.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewcast import config as C
from renewcast.functions.columns import active, marks

HISTORY_MONTHS = 12
NEUTRAL = "neutral"


def history(fine: DataFrame, cfg: C.Config) -> DataFrame:
    """The last closed months' rows: their marks are final."""
    closed = fine.where((F.col("ts") == 0) & (F.col("due_units") > 0) & (F.col("ord") < cfg.current))
    last = closed.select("ord").distinct().orderBy(F.desc("ord")).limit(HISTORY_MONTHS)
    return closed.join(F.broadcast(last), "ord", "left_semi").withColumn("m", F.col("ord") % 12).withColumn("mark", marks(cfg))


def ahead(fine: DataFrame, extension: DataFrame, acquisition: DataFrame, cfg: C.Config) -> DataFrame:
    """All that falls due in open months: the extract's rows with today's marks, and what is added to them, unmarked."""
    known = fine.where((F.col("ts") == 0) & (F.col("due_units") > 0) & (F.col("ord") >= cfg.current))
    flags = lambda one: [(active(c).cast("int") if one else F.lit(0)).alias(c) for c in cfg.negative]
    rows = known.select("ord", marks(cfg).alias("mark"), *flags(True), F.col("due_units").cast("double").alias("due_units"), "due_cents", F.lit(1).alias("extract"))
    for more, units in ((extension, "expected_units"), (acquisition, "units")):
        rows = rows.unionByName(more.where(F.col(units) > 0).select("ord", F.lit(NEUTRAL).alias("mark"), *flags(False), F.col(units).alias("due_units"), F.lit(0).cast("long").alias("due_cents"), F.lit(0).alias("extract")))
    return rows.withColumn("m", F.col("ord") % 12)


def _share(condition: Column) -> Column:
    return F.round(F.try_divide(F.coalesce(F.sum(F.when(condition, F.col("due_units"))), F.lit(0)).cast("double"), F.sum("due_units").cast("double")), 6)


def shares(past: DataFrame, future: DataFrame, cfg: C.Config) -> DataFrame:
    """By open month: its money due, the extract's share of its units, and each mark's share today and, of the same
    calendar month, at the end (null without such a month)."""
    of = lambda x, flag: [_share(flag(c)).alias(f"{x}_{c}") for c in cfg.negative] + [_share(F.col("mark") == NEUTRAL).alias(f"{x}_{NEUTRAL}")]
    final = past.groupBy("m").agg(*of("final", active))
    now = future.groupBy("ord", "m").agg(F.sum("due_cents").alias("due_cents"), _share(F.col("extract") == 1).alias("extract_share"), *of("today", lambda c: F.col(c) == 1))
    # Twelve calendar months at most.
    return now.join(F.broadcast(final), "m", "left").withColumn("h", F.col("ord") - cfg.current + 1).drop("m")


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("due_units", "ren_units", "due_cents", "ren_value")]


def _rates(past: DataFrame) -> DataFrame:
    by = past.groupBy("mark").agg(*_sums())
    return by.select("mark", "due_units", F.try_divide(F.col("ren_units").cast("double"), F.col("due_units").cast("double")).alias("rate_units"), F.try_divide(F.col("ren_value") / 200.0, F.col("due_cents").cast("double")).alias("rate_value"))


def costs(past: DataFrame) -> DataFrame:
    """What each combination of marks renews, of units and of money."""
    total = past.agg(F.sum("due_units").cast("double").alias("total"))
    rows = _rates(past).crossJoin(F.broadcast(total))  # one row
    return rows.select("mark", F.round(F.col("due_units") / F.col("total"), 6).alias("share_units"), F.round("rate_units", 6).alias("rate_units"), F.round("rate_value", 6).alias("rate_value"))


def effects(past: DataFrame, future: DataFrame) -> DataFrame:
    """By open month: the rates with today's mix of marks and with the same calendar month's final one, both at the
    history's rates by combination, and what renewed money (in cents) the difference makes.

    A combination that the history hasn't has the unmarked rate; a calendar month that it hasn't leaves today's mix;
    without any unmarked history such a combination's month has no rate."""
    rates = _rates(past)
    neutral = rates.where(F.col("mark") == NEUTRAL).agg(F.max("rate_units").alias("n_units"), F.max("rate_value").alias("n_value"))
    # Combinations are at most two to the number of marks.
    rates = F.broadcast(rates.select("mark", "rate_units", "rate_value"))

    def mixed(rows: DataFrame, x: str, *keys: str) -> DataFrame:
        by = rows.groupBy(*keys, "mark").agg(F.sum("due_units").cast("double").alias("due_units"), F.sum("due_cents").alias("due_cents"))
        by = by.join(rates, "mark", "left").crossJoin(F.broadcast(neutral))
        rate = lambda k: F.coalesce(F.col(f"rate_{k}"), F.col(f"n_{k}"))
        mean = lambda k: F.when(F.count(rate(k)) == F.count(F.lit(1)), F.sum(F.col("due_units") * rate(k)) / F.sum("due_units")).alias(f"{x}_{k}")
        return by.groupBy(*keys).agg(mean("units"), mean("value"), F.sum("due_cents").alias("due_cents"))

    final = mixed(past, "final", "m").drop("due_cents")
    rows = mixed(future, "today", "ord", "m").join(F.broadcast(final), "m", "left")
    rows = rows.withColumns({f"final_{k}": F.coalesce(F.col(f"final_{k}"), F.col(f"today_{k}")) for k in ("units", "value")})
    effect = F.col("due_cents") * (F.col("final_value") - F.col("today_value"))
    return rows.select("ord", F.floor(F.col("ord") / 12).cast("int").alias("year"), "due_cents", *(F.round(c, 6).alias(c) for c in ("today_units", "final_units", "today_value", "final_value")), F.round(effect, 4).alias("effect_cents"))


def by_year(effect: DataFrame) -> DataFrame:
    rows = effect.groupBy("year").agg(F.sum("due_cents").alias("due_cents"), F.round(F.sum("effect_cents"), 3).alias("effect_cents"))
    return rows.withColumn("share", F.round(F.try_divide(F.col("effect_cents"), F.col("due_cents").cast("double")), 6))
