"""Evidence behind the ladder: stages, merges, and the card of a series."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renewcast import config as C
from renewcast.functions.columns import ratio
from renewcast.operators import ladder as L
from renewcast.operators import series as S

#: The stage a pass belongs to: itself, the sign and the extras, the mandatory dimensions.
STAGES = {0: "raw", 1: "sign", 2: "extras", 3: "collapse"}
STAGE_OF_PASS = (0, 1, 2, 3, 3)


def climbed(rungs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The passes that each series went through, up to the one it stays at, with their groups."""
    return rungs.join(chosen.select("fs_id", F.col("pass").alias("stop")), "fs_id").where("pass <= stop")


def merges(rungs: DataFrame, chosen: DataFrame, summary: DataFrame) -> DataFrame:
    """Each pass at which a series' group gained series: is a rate of the group nearer the truth than its own?"""
    w = Window.partitionBy("fs_id").orderBy("pass")
    rows = climbed(rungs, chosen).withColumn("before", F.lag("series").over(w)).withColumn("support_before", F.lag("support").over(w)).where("before IS NOT NULL AND series > before")
    own = summary.select("fs_id", F.greatest(F.coalesce("support", F.lit(0.0)), F.lit(1.0)).alias("n"), F.col("rate").alias("p"))
    q, bias = ratio(F.col("ren_units"), F.col("due_units")), F.col("q") - F.col("p")
    rows = rows.join(own, "fs_id").withColumn("q", q)
    alone = 100 * F.sqrt(F.col("p") * (1 - F.col("p")) / F.col("n"))
    merged = 100 * F.sqrt(bias * bias + F.col("q") * (1 - F.col("q")) / F.greatest("support", F.lit(1.0)))
    return rows.select("fs_id", "pass", "pattern", "support_before", "support", "series", F.round(100 * bias, 6).alias("bias_pp"), F.round(alone, 6).alias("error_alone_pp"), F.round(merged, 6).alias("error_merged_pp"), (F.round(merged, 9) < F.round(alone, 9)).cast("int").alias("improves"))


def stages(rungs: DataFrame, chosen: DataFrame) -> DataFrame:
    """What each series is counted in, and how much that has, when each of the four stages is done."""
    stage = F.element_at(F.array(*map(F.lit, STAGE_OF_PASS)), F.col("pass") + 1)
    rows = climbed(rungs, chosen).withColumn("stage", stage)
    at = lambda s, c: F.max_by(F.when(F.col("stage") <= s, F.col(c)), F.when(F.col("stage") <= s, F.col("pass")))
    return rows.groupBy("fs_id").agg(*(at(s, c).alias(f"stage{s}_{n}") for s in STAGES for c, n in (("pattern", "id"), ("support", "support"))))


def stage_summary(units: DataFrame, rungs: DataFrame, chosen: DataFrame, cfg: C.Config) -> DataFrame:
    """By stage: groups, series, and shares of the money to predict in groups of enough support."""
    money = units.where(F.col("ord") >= cfg.current).groupBy("fs_id").agg(F.sum("due_cents").alias("cents"))
    rows = stages(rungs, chosen).join(money, "fs_id", "left").withColumn("cents", F.coalesce("cents", F.lit(0)))

    def one(s):
        share = lambda floor: F.round(F.try_divide(F.coalesce(F.sum(F.when(F.col(f"stage{s}_support") >= floor, F.col("cents"))), F.lit(0)).cast("double"), F.sum("cents").cast("double")), 6)
        return rows.agg(F.lit(s).alias("stage"), F.lit(STAGES[s]).alias("name"), F.count_distinct(f"stage{s}_id").alias("groups"), F.count(F.lit(1)).alias("series"), share(cfg.support_floor).alias("share_floor"), share(cfg.support_full).alias("share_own"))

    return reduce(DataFrame.unionByName, map(one, STAGES))


def cards(fine: DataFrame, summary: DataFrame, chosen: DataFrame, weights: DataFrame, cfg: C.Config) -> DataFrame:
    """One row a series: its coverage, its own figures, where it ended on the ladder and how far that is trusted."""
    own = summary.select("fs_id", F.col("support").alias("own_support"), "months", F.round("rate", 6).alias("own_rate"), "half_width")
    ladder = chosen.select("fs_id", "sign", "pass", "composition", F.col("support").alias("group_support"), "series")
    ref = L.blended(weights).select("fs_id", "reference", "z", F.col("rate").alias("blended_rate"))
    trust = F.when(F.col("own_support") >= cfg.support_full, "high").when(F.coalesce("group_support", F.lit(0.0)) >= cfg.support_floor, "medium").otherwise("low")
    return S.routes(fine.where("ts = 0")).select("fs_id", "coverage", "route", "to_predict_cents").join(own, "fs_id", "left").join(ladder, "fs_id", "left").join(ref, "fs_id", "left").withColumn("confidence", trust)
