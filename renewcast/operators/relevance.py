"""How much of the rates' variance dimensions explain, and the order in which they are given up."""
from __future__ import annotations

import re
from functools import reduce
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renewcast import config as C

PAIRS_SHOWN, LEAST_SERIES, LARGEST_LOSS, MERGING_PASSES = 20, 3, 0.05, 2
#: The fit's normal equations are as large as the dimensions' values squared; more values than this are refused.
MOST_VALUES = 4000


def weighted_rates(summary: DataFrame, dims: tuple[str, ...]) -> DataFrame:
    text = (F.coalesce(F.col(d).cast("string"), F.lit("null")).alias(d) for d in dims)
    return summary.where("rate IS NOT NULL AND support > 0").select(*text, "rate", F.col("support").alias("w"))


def _spread(rows: DataFrame, value) -> DataFrame:
    """Sums of squares by the values of an expression: total, between, values and series."""
    w, x = F.col("w"), F.col("rate")
    by = rows.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"), F.sum(w * x).alias("wx"), F.sum(w * x * x).alias("wxx"))
    out = by.agg(F.count(F.lit(1)).alias("levels"), F.sum("n").alias("series"), F.sum("w").alias("w"), F.sum("wx").alias("wx"), F.sum("wxx").alias("wxx"), F.sum(F.col("wx") ** 2 / F.col("w")).alias("b"))
    mean = F.col("wx") ** 2 / F.col("w")
    return out.select("levels", "series", (F.col("wxx") - mean).alias("sst"), (F.col("b") - mean).alias("ssb"))


def omega_squared(rows: DataFrame, dims: tuple[str, ...]) -> DataFrame:
    """Eta squared corrected for the number of values; 0 unless there are more series than values."""
    def one(d):
        msw = (F.col("sst") - F.col("ssb")) / (F.col("series") - F.col("levels"))
        value = F.when((F.col("sst") > 0) & (F.col("series") > F.col("levels")), F.greatest(F.lit(0.0), (F.col("ssb") - (F.col("levels") - 1) * msw) / (F.col("sst") + msw))).otherwise(0.0)
        return _spread(rows, F.col(d)).select(F.lit(d).alias("dimension"), "levels", "series", F.round(value, 6).alias("omega2"))

    return reduce(DataFrame.unionByName, map(one, dims))


def pairs(rows: DataFrame, dims: tuple[str, ...], shown: int = PAIRS_SHOWN) -> DataFrame:
    """The pairs of dimensions that explain most beyond the better one of the two."""
    eta = F.round(F.when(F.col("sst") > 0, F.col("ssb") / F.col("sst")).otherwise(0.0), 4)
    single = reduce(DataFrame.unionByName, (_spread(rows, F.col(d)).select(F.lit(d).alias("d"), eta.alias("eta")) for d in dims))
    both = reduce(DataFrame.unionByName, (_spread(rows, F.concat_ws("|", a, b)).select(F.lit(a).alias("a"), F.lit(b).alias("b"), eta.alias("eta2")) for a, b in combinations(dims, 2)))
    out = both.join(F.broadcast(single.select(F.col("d").alias("a"), F.col("eta").alias("ea"))), "a").join(F.broadcast(single.select(F.col("d").alias("b"), F.col("eta").alias("eb"))), "b")
    out = out.select(F.concat_ws("×", "a", "b").alias("pair"), "eta2", F.round(F.col("eta2") - F.greatest("ea", "eb"), 4).alias("interaction"))
    return out.orderBy(F.desc("interaction"), "pair").limit(shown)


def normal_equations(rows: DataFrame, dims: tuple[str, ...]) -> tuple[dict, np.ndarray, np.ndarray, float, int]:
    """Of the additive fit on one-hot values: Spark sums the products of each two values; only these sums, whose
    number doesn't grow with the rows, come to the driver."""
    size = rows.agg(*(F.count_distinct(d).alias(d) for d in dims)).first()
    if sum(size) > MOST_VALUES:
        raise ValueError(f"{sum(size)} values of {dims}, over {MOST_VALUES}")
    tags = F.array(F.struct(F.lit("").alias("d"), F.lit("").alias("v")), *(F.struct(F.lit(d).alias("d"), F.col(d).alias("v")) for d in dims))
    each = rows.select(tags.alias("tags"), "rate", "w").select("tags", F.explode("tags").alias("a"), "rate", "w")
    right = each.groupBy("a").agg(F.sum(F.col("w") * F.col("rate")).alias("wx")).collect()
    place = {(r.a.d, r.a.v): i for i, r in enumerate(sorted(right, key=lambda r: (r.a.d, r.a.v)))}
    left, products = np.zeros(len(place)), np.zeros((len(place), len(place)))
    for r in right:
        left[place[r.a.d, r.a.v]] = r.wx
    for r in each.select("a", F.explode("tags").alias("b"), "w").groupBy("a", "b").agg(F.sum("w").alias("w")).collect():
        products[place[r.a.d, r.a.v], place[r.b.d, r.b.v]] = r.w
    total = rows.agg(F.sum(F.col("w") * F.col("rate") ** 2).alias("wxx"), F.count(F.lit(1)).alias("n")).first()
    return place, products, left, total.wxx or 0.0, total.n


def r_squared(equations, dims) -> float:
    place, products, left, wxx, n = equations
    if not dims or n < LEAST_SERIES:
        return 0.0
    keep = [i for (d, _), i in place.items() if d == "" or d in dims]
    a, b = products[np.ix_(keep, keep)], left[keep]
    fitted = float(b @ np.linalg.lstsq(a, b, rcond=1e-10)[0])
    origin = place["", ""]
    mean = left[origin] ** 2 / products[origin, origin]
    return float(max(0.0, min(1.0, (fitted - mean) / (wxx - mean)))) if wxx - mean > 0 else 0.0


def level_of(dim: str, dims) -> tuple[str, int]:
    """(family, level) of a dimension: product_level_2 is (product, 2); product itself, beside levels of its own, is
    finer than the finest of them; a dimension without levels is its own family's first."""
    found = re.fullmatch(r"(.+)_level_(\d+)", dim)
    if found:
        return found[1], int(found[2])
    return dim, max((int(m[1]) for d in dims if (m := re.fullmatch(re.escape(dim) + r"_level_(\d+)", d))), default=0) + 1


def free(left) -> list[str]:
    """Dimensions whose next finer level has gone."""
    levels = {level_of(d, left) for d in left}
    return [d for d in left for family, n in [level_of(d, left)] if (family, n + 1) not in levels]


def collapse_order(spark: SparkSession, rows: DataFrame, dims: tuple[str, ...]) -> DataFrame:
    """Dimensions from the first to give up: always the one without which the rest loses least, ties by name; a level
    only after the finer one of its family."""
    equations, left, out = normal_equations(rows, dims), list(dims), []
    while left:
        now = r_squared(equations, left)
        loss = {d: max(0.0, now - r_squared(equations, [x for x in left if x != d])) for d in free(left)}
        d = min(loss, key=lambda x: (round(loss[x], 9), x))
        out.append((len(out) + 1, d, round(loss[d], 4)))
        left.remove(d)
    return spark.createDataFrame(out, "place int, dimension string, loss double")


def pass_plan(spark: SparkSession, rows: DataFrame, cfg: C.Config) -> DataFrame:
    """The ladder's passes: the series itself, its sign for its marks, without extras (the least telling first),
    without mandatory dimensions in their collapse order; only the first of these merge, later ones are only
    references; signed groups go along while the summed loss stays small."""
    equations = normal_equations(rows, cfg.mandatory + cfg.extra)
    full = r_squared(equations, cfg.mandatory + cfg.extra)
    extras = sorted(cfg.extra, key=lambda x: (round(full - r_squared(equations, [d for d in cfg.mandatory + cfg.extra if d != x]), 9), x))
    plan = [(0, "itself", "", True, True), (1, "sign", "", True, True)]
    starred, lost = [], 0.0
    for d in extras:
        starred.append(d)
        plan.append((len(plan), f"extra {d}", ",".join(sorted(starred)), True, True))
    for i, r in enumerate(collapse_order(spark, rows, cfg.mandatory).orderBy("place").collect()):
        starred.append(r.dimension)
        lost += r.loss
        plan.append((len(plan), f"without {r.dimension}", ",".join(sorted(starred)), i < MERGING_PASSES, lost <= LARGEST_LOSS + 1e-9))
    return spark.createDataFrame(plan, "pass int, name string, starred string, merges boolean, signed_allowed boolean")
