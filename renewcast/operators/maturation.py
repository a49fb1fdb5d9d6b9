"""Marks still to come: open months carry today's marks, closed ones their last; the gap is spread."""
from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewcast import config as C
from renewcast.functions.columns import join_id, marks

LEAST_UNITS, HISTORY_MONTHS = 100, 12
LEVELS = ("grp", "cell", "all")


def combos(cfg: C.Config) -> list[str]:
    return ["+".join(c) for k in range(1, len(cfg.negative) + 1) for c in combinations(cfg.negative, k)]


def _keyed(rows: DataFrame, cfg: C.Config) -> DataFrame:
    return rows.select(join_id(*cfg.mandatory, *cfg.extra).alias("grp"), join_id(*cfg.mandatory).alias("cell"), F.lit("all").alias("all"), marks(cfg).alias("mark"), "ord", (F.col("ord") % 12).alias("m"), "due_units", "ren_units")


def _least(values: list[Column]) -> Column:
    return sum(values[1:], values[0])


def moves(fine: DataFrame, cfg: C.Config) -> DataFrame:
    """By group (all dimensions but the marks) and open month: the share of its unmarked units that will be
    marked, per combination, and the rate at which those renew.

    The final mix is that of the same calendar month among the last closed months: of the group, of its mandatory
    cell if the group had fewer than the least units, else of everything.  A combination's gap is what it lacks
    today; gaps shrink until no mark passes its own final share; they take at most all unmarked units.
    """
    names = combos(cfg)
    ids = range(len(names))
    rows = _keyed(fine.where("ts = 0 AND due_units > 0"), cfg)
    closed = rows.where(F.col("ord") < cfg.current)
    months = closed.select("ord").distinct().orderBy(F.desc("ord")).limit(HISTORY_MONTHS)
    history = closed.join(F.broadcast(months), "ord", "left_semi")
    of = lambda c, x: F.coalesce(F.sum(F.when(F.col("mark") == c, F.col(x))), F.lit(0))
    out = rows.where(F.col("ord") >= cfg.current).groupBy("grp", "cell", "all", "ord", "m").agg(F.sum("due_units").alias("total"), of("neutral", "due_units").alias("neutral"), *(of(c, "due_units").alias(f"now{i}") for i, c in enumerate(names)))
    for k in LEVELS:
        mix = history.groupBy(k, "m").agg(F.sum("due_units").alias(f"{k}_total"), *(of(c, "due_units").alias(f"{k}_u{i}") for i, c in enumerate(names)))
        rate = history.groupBy(k).agg(*(of(c, x).alias(f"{k}_{x[0]}{i}") for i, c in enumerate(names) for x in ("due_units", "ren_units")))
        out = out.join(mix, [k, "m"], "left").join(rate, k, "left")

    enough = lambda k: F.coalesce(F.col(f"{k}_total"), F.lit(0)) >= LEAST_UNITS
    pick = lambda x: F.when(enough("grp"), F.col("grp" + x)).when(enough("cell"), F.col("cell" + x)).otherwise(F.col("all" + x))
    out = out.where("neutral > 0").withColumn("level", F.when(enough("grp"), "grp").when(enough("cell"), "cell").otherwise("all"))
    out = out.withColumns({f"final{i}": F.coalesce(pick(f"_u{i}") / pick("_total"), F.lit(0.0)) for i in ids} | {f"today{i}": F.col(f"now{i}") / F.col("total") for i in ids})
    out = out.withColumns({f"gap{i}": F.greatest(F.col(f"final{i}") - F.col(f"today{i}"), F.lit(0.0)) for i in ids})
    for mark in cfg.negative:
        carry = [i for i in ids if mark in names[i].split("+")]
        add = lambda x: _least([F.col(f"{x}{i}") for i in carry])  # noqa: E731, B023
        allowed = F.greatest(add("final") - add("today"), F.lit(0.0))
        out = out.withColumn("scale", F.when(add("gap") > allowed, allowed / add("gap")).otherwise(1.0))
        out = out.withColumns({f"gap{i}": F.col(f"gap{i}") * F.col("scale") for i in carry})
    out = out.withColumn("gap", _least([F.col(f"gap{i}") for i in ids])).where("gap > 1e-12")
    out = out.withColumn("moved", F.least(F.col("gap") / (F.col("neutral") / F.col("total")), F.lit(1.0)))

    def rate_of(i):
        at = lambda k: F.try_divide(F.col(f"{k}_r{i}").cast("double"), F.col(f"{k}_d{i}").cast("double"))
        has = lambda k: F.coalesce(F.col(f"{k}_d{i}"), F.lit(0)) >= LEAST_UNITS
        return F.coalesce(F.when(has("grp"), at("grp")).when(has("cell"), at("cell")).otherwise(at("all")), F.lit(0.0))

    share = {i: F.col(f"gap{i}") / F.col("gap") for i in ids}
    label = {i: names[i].replace("+", "_") for i in ids}
    return out.select("grp", "ord", "level", "neutral", F.round("moved", 6).alias("moved"), F.round(_least([share[i] * rate_of(i) for i in ids]), 6).alias("rate_there"), *(F.round(F.col("moved") * share[i], 6).alias(f"to_{label[i]}") for i in ids))


def distribute(future: DataFrame, moved: DataFrame, cfg: C.Config) -> DataFrame:
    """Forecast rows (with the series' dimensions, due_units, rate, expected_units) after the marks to come."""
    rows = future.withColumn("grp", join_id(*cfg.mandatory, *cfg.extra)).join(moved.select("grp", "ord", "moved", "rate_there"), ["grp", "ord"], "left")
    takes = (marks(cfg) == "neutral") & F.col("moved").isNotNull()
    rows = rows.withColumn("moved_units", F.when(takes, F.col("due_units") * F.col("moved")).otherwise(0.0))
    delta = F.when(takes, F.col("moved_units") * (F.col("rate_there") - F.col("rate"))).otherwise(0.0)
    return rows.withColumn("delta_units", delta).withColumn("final_units", F.col("expected_units") + F.col("delta_units")).drop("grp", "moved", "rate_there")
