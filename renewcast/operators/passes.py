"""The ladder as its plan says: passes of any number, each of which widens the groups of series that are still thin.

A plan's pass says which dimensions it leaves out, whether it merges or only serves for references, and whether signed
groups may take it.  From the second pass on, marks are summed up as their sign.  A series stays at the first pass whose
group, counted over all series, has enough support; a mixed series stays by itself.  A pass that brings a group no
further series leaves it its id.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renewcast import config as C
from renewcast.operators.series import closed

#: How ids are written.
ANY, SIGN, APART = "*", "SIG=", "|"


@dataclass(frozen=True)
class Pass:
    number: int
    name: str
    without: frozenset
    merges: bool
    signed: bool


def read_plan(plan: DataFrame) -> list[Pass]:
    """The rows of ``pass_plan``: two, and one for each dimension."""
    return [Pass(r["pass"], r["name"], frozenset(x for x in r["starred"].split(",") if x), r["merges"], r["signed_allowed"]) for r in sorted(plan.collect())]


def _pattern(p: Pass, cfg: C.Config):
    if not p.number:
        return F.col("fs_id")
    flags, fields = cfg.negative + cfg.positive, []
    for c in cfg.series:
        if c not in flags:
            fields.append(F.lit(ANY) if c in p.without else F.coalesce(F.col(c).cast("string"), F.lit("null")))
        elif c == flags[0]:
            fields.append(F.concat(F.lit(SIGN), F.col("sign")))
    return F.concat_ws(APART, *fields)


def stats(units: DataFrame, routes: DataFrame, plan: list[Pass], cfg: C.Config) -> DataFrame:
    """Each series that can be estimated at each pass: its pattern there, whether it may take it, and the support,
    series, units and renewals of all series of that pattern."""
    series = units.select("fs_id", "sign", *cfg.series).distinct().join(routes.where((F.col("route") == C.PREDICTABLE) & (F.col("universe") == C.NORMAL)).select("fs_id", F.col("to_predict_cents").alias("cents")), "fs_id")
    each = F.array(*(F.struct(F.lit(p.number).alias("pass"), F.lit(p.name).alias("name"), F.lit(p.merges).alias("merges"), F.lit(p.signed).alias("signed"), _pattern(p, cfg).alias("pattern")) for p in plan))
    rows = series.select("fs_id", "sign", "cents", F.explode(each).alias("p")).select("fs_id", "sign", "cents", "p.*")
    rows = rows.withColumn("allowed", (F.col("pass") == 0) | ((F.col("sign") != C.MIXED) & ((F.col("sign") == C.NEUTRAL) | F.col("signed")))).drop("signed")
    counts = rows.where((F.col("pass") == 0) | (F.col("sign") != C.MIXED))
    history = closed(units, cfg).where("due_units > 0").select("fs_id", "ord", "due_units", "ren_units")
    month = history.join(counts.select("fs_id", "pass", "pattern"), "fs_id").groupBy("pass", "pattern", "ord").agg(F.sum("due_units").alias("due"), F.sum("ren_units").alias("ren"))
    support = month.groupBy("pass", "pattern").agg(F.median(F.col("due").cast("double")).alias("support"), F.sum("due").alias("due_units"), F.sum("ren").alias("ren_units"))
    size = counts.groupBy("pass", "pattern").agg(F.count(F.lit(1)).alias("series"))
    rows = rows.join(size, ["pass", "pattern"], "left").join(support, ["pass", "pattern"], "left")
    return rows.withColumns({"support": F.coalesce("support", F.lit(0.0)), "series": F.coalesce("series", F.lit(1))})


def run(stats: DataFrame, cfg: C.Config) -> DataFrame:
    """The merging passes: id, support and series of each series' group after each, and whether it stays there."""
    by = Window.partitionBy("fs_id")
    upto = by.orderBy("pass").rowsBetween(Window.unboundedPreceding, 0)
    before = by.orderBy("pass").rowsBetween(Window.unboundedPreceding, -1)
    enough = F.col("support") >= cfg.support_floor
    rows = stats.where("merges").withColumn("stop", F.coalesce(F.min(F.when(F.col("allowed") & enough, F.col("pass"))).over(by), F.max(F.when(F.col("allowed"), F.col("pass"))).over(by)))
    moves = F.col("allowed") & (F.col("pass") <= F.col("stop"))
    rows = rows.withColumn("moves", moves).withColumn("held", F.last(F.when(F.col("moves"), F.col("series")), ignorenulls=True).over(before))
    gains = F.col("moves") & (F.col("held").isNull() | (F.col("series") > F.col("held")))
    last = lambda when, c: F.last(F.when(when, F.col(c)), ignorenulls=True).over(upto)
    out = rows.withColumn("gains", gains).select("fs_id", "pass", "name", "cents", last(F.col("gains"), "pattern").alias("group_id"), last(F.col("moves"), "support").alias("group_support"), last(F.col("moves"), "series").alias("group_series"), "stop")
    return out.withColumn("closed", ((F.col("pass") >= F.col("stop")) & (F.col("group_support") >= cfg.support_floor)).cast("int"))


def summary(passes: DataFrame, cfg: C.Config) -> DataFrame:
    """By pass: groups, those still thin, their median support, and the shares of money to predict in groups that reach
    the floor and the full support."""
    groups = passes.groupBy("pass", "name", "group_id").agg(F.max("group_support").alias("support"), F.sum("cents").alias("cents"))
    share = lambda floor: F.round(F.try_divide(F.coalesce(F.sum(F.when(F.col("support") >= floor, F.col("cents"))), F.lit(0)).cast("double"), F.sum("cents").cast("double")), 6)
    return groups.groupBy("pass", "name").agg(F.count(F.lit(1)).alias("groups"), F.sum((F.col("support") < cfg.support_floor).cast("int")).alias("open_groups"), F.median("support").alias("median_support"), share(cfg.support_floor).alias("share_floor"), share(cfg.support_full).alias("share_full"))


def compositions(stats: DataFrame, passes: DataFrame, cfg: C.Config) -> DataFrame:
    """Each series' group after the last pass and, where that has no full support, a wider one to lean on: of the later
    passes that its sign allows, merging or not, the first with more series and enough support, else the last with more."""
    last = passes.groupBy("fs_id").agg(F.max_by(F.struct("group_id", "group_support", "group_series", "stop", "closed"), "pass").alias("g")).select("fs_id", "g.*")
    own = stats.select("fs_id", "pass", "sign", "pattern", "support", "series", "allowed")
    wider = own.join(last.where(F.col("group_support") < cfg.support_full).select("fs_id", "stop", "group_series"), "fs_id").where((F.col("sign") != C.MIXED) & F.col("allowed") & (F.col("pass") > F.col("stop")) & (F.col("series") > F.col("group_series")))
    enough = F.col("support") >= cfg.support_floor
    w = Window.partitionBy("fs_id").orderBy(F.when(enough, 0).otherwise(1), F.when(enough, F.col("pass")).otherwise(-F.col("pass")))
    wider = wider.withColumn("k", F.row_number().over(w)).where("k = 1").select("fs_id", F.col("pattern").alias("reference"), F.col("pass").alias("reference_pass"), F.col("support").alias("reference_support"), F.col("series").alias("reference_series"))
    return last.join(wider, "fs_id", "left").select("fs_id", F.col("group_id").alias("composition"), "stop", "group_support", "group_series", "closed", "reference", "reference_pass", "reference_support", "reference_series")
