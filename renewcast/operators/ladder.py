"""The support ladder: ever wider groups for series that are too thin, and credibility weighting."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renewcast import config as C
from renewcast.functions.columns import ratio
from renewcast.operators.series import closed

#: The passes of the ladder: what stays of a series' id at each.
PASSES = (("region", "product", "dormant", "softcancel", "autorenew", "channel"), ("region", "product", "sign", "channel"), ("region", "product", "sign"), ("region", "sign"), ("sign",))


def patterns(units: DataFrame, cfg: C.Config) -> DataFrame:
    """(fs_id, pass, pattern) of each series that isn't of mixed sign (these stay by themselves)."""
    series = units.select("fs_id", "sign", *cfg.series).distinct()
    names = [F.concat_ws("|", *(F.concat(F.lit(c + "="), F.col(c).cast("string")) for c in p)) for p in PASSES]
    each = series.select("fs_id", "sign", F.posexplode(F.array(*names)).alias("pass", "pattern"))
    return each.where((F.col("sign") != C.MIXED) | (F.col("pass") == 0)).select("fs_id", "sign", "pass", "pattern")


def pattern_support(units: DataFrame, patterns: DataFrame, cfg: C.Config) -> DataFrame:
    """Support (median month), series and rate of each pattern."""
    rows = closed(units, cfg).select("fs_id", "ord", "due_units", "ren_units").join(patterns, "fs_id")
    month = rows.groupBy("pass", "pattern", "ord").agg(F.sum("due_units").alias("due"), F.sum("ren_units").alias("ren"))
    count = rows.groupBy("pass", "pattern").agg(F.count_distinct("fs_id").alias("series"))
    return month.groupBy("pass", "pattern").agg(F.median(F.when(F.col("due") > 0, F.col("due").cast("double"))).alias("support"), F.sum("due").alias("due_units"), F.sum("ren").alias("ren_units")).join(count, ["pass", "pattern"])


def rungs(patterns: DataFrame, support: DataFrame) -> DataFrame:
    """Each series' patterns with what these have: what all that follows is made of."""
    return patterns.join(support, ["pass", "pattern"])


def chosen(rungs: DataFrame, cfg: C.Config) -> DataFrame:
    """The first pass at which a series' pattern has enough support, else its last."""
    enough = F.min(F.when(F.col("support") >= cfg.support_floor, F.col("pass")))
    w = Window.partitionBy("fs_id")
    pick = rungs.withColumn("take", F.coalesce(enough.over(w), F.max("pass").over(w))).where("pass = take")
    return pick.select("fs_id", "sign", "pass", F.col("pattern").alias("composition"), "support", "series", "due_units", "ren_units")


def references(rungs: DataFrame, chosen: DataFrame, cfg: C.Config) -> DataFrame:
    """A wider group for compositions of little support: the next pass with more series and enough support,
    else the widest with more series."""
    own = chosen.where((F.col("support") < cfg.support_full) & (F.col("sign") != C.MIXED))
    wider = rungs.select("fs_id", F.col("pass").alias("r_pass"), F.col("pattern").alias("reference"), F.col("support").alias("r_support"), F.col("series").alias("r_series"), F.col("due_units").alias("r_due"), F.col("ren_units").alias("r_ren"))
    cand = own.join(wider, "fs_id").where("r_pass > pass AND r_series > series")
    good = F.col("r_support") >= cfg.support_floor
    w = Window.partitionBy("fs_id").orderBy(F.when(good, 0).otherwise(1), F.when(good, F.col("r_pass")).otherwise(-F.col("r_pass")))
    return cand.withColumn("k", F.row_number().over(w)).where("k = 1").select("fs_id", "composition", "reference", "r_pass", "r_support", "r_due", "r_ren")


def credibility(chosen: DataFrame, references: DataFrame, cfg: C.Config) -> DataFrame:
    """k of each reference from its compositions' rates: variance within over variance between."""
    ref = references.select("composition", "reference").distinct()
    comp = chosen.select("composition", F.col("support").alias("w"), ratio(F.col("ren_units"), F.col("due_units")).alias("p")).distinct()
    rows = ref.join(comp, "composition").where("p IS NOT NULL AND w > 0")
    by = rows.groupBy("reference").agg(F.count(F.lit(1)).alias("siblings"), F.sum("w").alias("w"), F.sum(F.col("w") * F.col("p")).alias("wp"), F.avg(F.col("p") * (1 - F.col("p"))).alias("within"), F.sum(F.col("w") * F.col("p") ** 2).alias("wpp"), F.sum(F.col("w") * F.col("p") * (1 - F.col("p")) / F.greatest(F.col("w"), F.lit(1.0))).alias("noise"))
    between = (F.col("wpp") - F.col("wp") ** 2 / F.col("w") - F.col("noise")) / F.col("w")
    k = F.when(F.col("siblings") < cfg.least_siblings, cfg.default_k).when(between <= 1e-6, cfg.largest_k).otherwise(F.col("within") / between)
    return by.select("reference", "siblings", F.round(F.col("wp") / F.col("w"), 6).alias("mean_rate"), F.round(k, 4).alias("k"))


def weighted(chosen: DataFrame, references: DataFrame, credibility: DataFrame, cfg: C.Config) -> DataFrame:
    """z = n / (n + k) of each series' composition, and the rates of composition and reference."""
    ref = references.join(credibility.select("reference", "k"), "reference", "left")
    rows = chosen.join(ref.select("fs_id", "reference", "r_due", "r_ren", "k"), "fs_id", "left")
    z = F.when(F.col("reference").isNull(), 1.0).otherwise(F.round(F.col("support") / (F.col("support") + F.coalesce("k", F.lit(cfg.default_k))), 3))
    return rows.select("fs_id", "composition", "reference", z.alias("z"), ratio(F.col("ren_units"), F.col("due_units")).alias("own_rate"), ratio(F.col("r_ren"), F.col("r_due")).alias("reference_rate"))


def blended(weights: DataFrame) -> DataFrame:
    """z of each series' composition and the rate between it and its reference."""
    z, p, r = F.col("z"), F.col("own_rate"), F.col("reference_rate")
    return weights.select("fs_id", "composition", "reference", "z", F.round(z * p + (1 - z) * F.coalesce(r, p), 6).alias("rate"))


def members(patterns: DataFrame, chosen: DataFrame) -> DataFrame:
    """The bridge of compositions and series: a series uses one and may lend its months to several."""
    comps = chosen.select("pass", F.col("composition").alias("pattern")).distinct()
    uses = chosen.select("fs_id", F.col("composition").alias("pattern"), F.lit(1).alias("own"))
    return patterns.join(comps, ["pass", "pattern"]).join(uses, ["fs_id", "pattern"], "left").select("fs_id", F.col("pattern").alias("composition"), F.when(F.col("own") == 1, "uses").otherwise("lends").alias("membership"))


def pooled(members: DataFrame, units: DataFrame, cfg: C.Config) -> DataFrame:
    """Monthly sums of each composition's members."""
    return members.select("fs_id", "composition").join(closed(units, cfg), "fs_id").groupBy("composition", "ord").agg(F.sum("due_units").alias("due_units"), F.sum("ren_units").alias("ren_units"), F.sum("due_cents").alias("due_cents"))
