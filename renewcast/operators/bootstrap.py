"""Bands of uplifts by a Poisson bootstrap: each row's weight in each replica comes from a hash of the row, so all
levels of the hierarchy are summed from one pass and no group is gathered in one place."""
from __future__ import annotations

from math import exp, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewcast import config as C
from renewcast.functions.columns import join_id
from renewcast.operators.price import CAP, LEAST, renewers, uplifts
from renewcast.sources.extract import DIMS

REPLICAS, LOW, HIGH = 200, 0.05, 0.95
#: Where a uniform number passes from one count of a Poisson variable of mean 1 to the next.
EDGES = [sum(exp(-1) / factorial(i) for i in range(k + 1)) for k in range(12)]


def poisson(u: Column) -> Column:
    out = F.lit(len(EDGES))
    for k in reversed(range(len(EDGES))):
        out = F.when(u < EDGES[k], k).otherwise(out)
    return out


def bands(fine: DataFrame, cfg: C.Config, replicas: int = REPLICAS) -> DataFrame:
    """Uplift of each cell with the 5 and 95 % points of its origin's resampled ratio; null for the global origin
    and for groups of one row."""
    ids = {"cell": join_id(*cfg.mandatory, "newcust", "bucket"), "parent": join_id(*cfg.mandatory, "bucket"), "wide": join_id(*cfg.mandatory)}
    rows = renewers(fine, cfg).select(*(v.alias(k) for k, v in ids.items()), F.xxhash64("ord", *DIMS).alias("row"), "ren_value", "base_cents")
    each = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(replicas - 1))).alias("k"))
    each = each.withColumn("u", F.pmod(F.xxhash64("row", "k"), F.lit(1 << 52)) / float(1 << 52)).withColumn("n", poisson(F.col("u")))
    n = F.col("n")
    sums = each.groupBy("cell", "parent", "wide", "k").agg(F.sum(n * F.col("ren_value")).alias("a"), F.sum(n * F.col("base_cents")).alias("b"), F.count(F.lit(1)).alias("rows"))
    sums = sums.select(F.explode(F.array(*(F.struct(F.lit(o).alias("origin"), F.col(k).alias("id")) for o, k in (("propio", "cell"), ("padre", "parent"), ("celda", "wide"))))).alias("g"), "k", "a", "b", "rows")
    draws = sums.groupBy("g", "k").agg(F.try_divide(F.sum("a").cast("double") / 200, F.sum("b").cast("double")).alias("u"), F.sum("rows").alias("rows"))
    band = draws.where("rows >= 2").groupBy("g.origin", "g.id").agg(F.percentile("u", F.lit(LOW)).alias("low"), F.percentile("u", F.lit(HIGH)).alias("high"))
    point = uplifts(fine, cfg)
    names = fine.where("ts = 0").select(*(v.alias(k) for k, v in ids.items())).distinct()
    group = F.when(F.col("origin") == "propio", F.col("cell")).when(F.col("origin") == "padre", F.col("parent")).otherwise(F.col("wide"))
    clip = lambda c: F.round(F.greatest(F.least(F.col(c), F.lit(CAP)), F.lit(LEAST)), 6)
    out = point.join(names, "cell").withColumn("id", group).join(band, ["origin", "id"], "left")
    edge = lambda c: F.when(F.col(c).isNotNull(), clip(c)).alias(c)
    return out.select("cell", "origin", "renewers", "uplift", edge("low"), edge("high"))
