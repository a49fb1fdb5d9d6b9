"""What falls due beyond the pipeline: renewals a year on, and new customers."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewcast.config import Config
from renewcast.functions import columns as X


def with_dims(summary: DataFrame, units: DataFrame, cfg: Config) -> DataFrame:
    return summary.join(units.select("fs_id", *cfg.series).distinct(), "fs_id")


def acquisition_lag12(fine: DataFrame, cfg: Config) -> DataFrame:
    """New customers expected in open months: the same month's a year before, at the level of the last three
    closed months against theirs a year before."""
    month = fine.where("newcust = 1").groupBy("region", "ord").agg(F.sum("raw_due_units").alias("units")).where(F.col("ord") < cfg.current)
    recent, before = (F.sum(F.when(F.col("ord").between(cfg.current - a - 3, cfg.current - a - 1), F.col("units"))) for a in (0, 12))
    level = month.groupBy("region").agg(F.try_divide(recent.cast("double"), before.cast("double")).alias("level"))
    return month.where(F.col("ord") >= cfg.current - 12).join(level, "region").select("region", (F.col("ord") + 12).alias("ord"), F.round(F.col("units") * F.coalesce("level", F.lit(1.0)), 6).alias("units"))


def horizon_extension(fine: DataFrame, cfg: Config) -> DataFrame:
    """One-year licences that fall due in open months and are expected to renew fall due again a year later."""
    rate = fine.where((F.col("ord") < cfg.current) & (F.col("ts") == 0)).groupBy("region", "product").agg(X.ratio(F.sum("ren_units"), F.sum("due_units")).alias("rate"))
    rows = fine.where((F.col("ord") >= cfg.current) & (F.col("term") == cfg.one_year) & (F.col("due_units") > 0) & (F.col("ts") == 0)).join(rate, ["region", "product"])
    return rows.groupBy("region", "product", (F.col("ord") + 12).alias("ord")).agg(F.sum("due_units").alias("due_units"), F.round(F.sum(F.col("due_units") * F.col("rate")), 6).alias("expected_units"))
