"""Levels of a dimension: values whose standardised rates lie close are one level, rare ones share the rest."""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renewcast import config as C
from renewcast.functions.columns import ratio

RESIDUAL = "resto"
#: Levels are for dimensions of few values; the driver merges their sums and refuses more than this.
MOST_VALUES = 100_000


def values(fine: DataFrame, dim: str, cfg: C.Config) -> DataFrame:
    """Each value's renewals, what they'd be at the rates of the other mandatory dimensions, and median month."""
    others = [d for d in cfg.mandatory if d != dim]
    rows = fine.where((F.col("role") == C.TRAINING) & (F.col("due_units") > 0)).select(F.coalesce(F.col(dim).cast("string"), F.lit("null")).alias("value"), *(F.col(d).alias(f"o_{d}") for d in others), "ord", "due_units", "ren_units")
    keys = [f"o_{d}" for d in others]
    cell = rows.groupBy(*keys).agg(ratio(F.sum("ren_units"), F.sum("due_units")).alias("rate"))
    same = rows.groupBy("value", "ord", *keys).agg(F.sum("due_units").alias("due_units"), F.sum("ren_units").alias("ren_units"))
    on = [same[k].eqNullSafe(cell[k]) for k in keys]
    same = (same.join(cell, on) if on else same.crossJoin(F.broadcast(cell))).select("value", "ord", "due_units", "ren_units", (F.col("rate") * F.col("due_units")).alias("expected"))
    month = same.groupBy("value", "ord").agg(*(F.sum(c).alias(c) for c in ("due_units", "ren_units", "expected")))
    return month.groupBy("value").agg(F.sum("due_units").alias("due_units"), F.sum("ren_units").alias("ren_units"), F.round(F.sum("expected"), 6).alias("expected"), F.median(F.col("due_units").cast("double")).alias("support"))


def natural(text: str) -> list:
    return [(0, int(x), "") if x.isdigit() else (1, 0, x.lower()) for x in re.split(r"(\d+)", text) if x]


def merge(found: list, cfg: C.Config, ordinal: bool = False, most: float | None = None) -> list[tuple[str, str]]:
    """(value, level) of rows with value, due_units, ren_units, expected, support: neighbours (by natural order, or
    by rate) merge, the closest first, while they differ by no more points than the noise at the least support."""
    due = sum(r["due_units"] for r in found)
    rate = sum(r["ren_units"] for r in found) / due if due else 0.0
    most = 100 * (rate * (1 - rate) / cfg.support_floor) ** 0.5 if most is None else most
    at = lambda g: rate * sum(r["ren_units"] for r in g) / max(sum(r["expected"] for r in g), 1e-9)
    groups = [[r] for r in sorted(found, key=lambda r: r["value"]) if r["support"] >= cfg.support_floor]
    groups.sort(key=(lambda g: natural(g[0]["value"])) if ordinal else at)
    while len(groups) > 1:
        gap, i = min((abs(at(a) - at(b)), i) for i, (a, b) in enumerate(zip(groups, groups[1:])))
        if 100 * gap > most:
            break
        groups[i:i + 2] = [groups[i] + groups[i + 1]]

    def label(group):
        names = sorted((r["value"] for r in group), key=natural)
        return " + ".join(names) if len(names) <= 3 else f"{names[0]} .. {names[-1]} ({len(names)} values)"

    rare = [(r["value"], RESIDUAL) for r in found if r["support"] < cfg.support_floor]
    return [(r["value"], label(g)) for g in groups for r in g] + rare


def levels(spark: SparkSession, fine: DataFrame, dim: str, cfg: C.Config, ordinal: bool = False) -> DataFrame:
    found = values(fine, dim, cfg).limit(MOST_VALUES + 1).collect()
    if len(found) > MOST_VALUES:
        raise ValueError(f"{dim} has over {MOST_VALUES} values")
    return spark.createDataFrame([(dim, *x) for x in merge([r.asDict() for r in found], cfg, ordinal)], "dimension string, value string, level string")


def apply_levels(rows: DataFrame, dim: str, mapping: DataFrame) -> DataFrame:
    """Adds <dim>_level_1; a value that no training month had falls to the rest."""
    m = mapping.where(F.col("dimension") == dim).select(F.col("value").alias("_value"), F.col("level").alias("_level"))
    return rows.join(m, F.coalesce(F.col(dim).cast("string"), F.lit("null")) == F.col("_value"), "left").withColumn(f"{dim}_level_1", F.coalesce("_level", F.lit(RESIDUAL))).drop("_value", "_level")


def save(mapping: DataFrame, folder: str) -> None:
    """The mapping as JSON, one object a dimension: {"dimension": ..., "levels": {value: level, ...}}."""
    by = mapping.groupBy("dimension").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("value", "level")))).alias("levels"))
    by.coalesce(1).write.mode("overwrite").json(folder)


def load(spark: SparkSession, folder: str) -> DataFrame:
    """What ``save`` has written; apply_levels has the rule for values that it does not know."""
    rows = spark.read.schema("dimension string, levels map<string,string>").json(folder)
    return rows.select("dimension", F.explode("levels").alias("value", "level"))
