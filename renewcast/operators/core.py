"""The core table: every row that is known, forecast, extended or simulated, with its source and its final figures."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renewcast import config as C
from renewcast.functions.columns import hash_key, join_id

#: What the columns hold; the legend is written beside the table.
LEGEND = {
    "row_key": "key of the source, ids and month",
    "source": "real, forecast, extension (renewed licences that fall due again), acquisition (simulated) or second_universe",
    "ord": "month, as year * 12 + month - 1",
    "due_units": "units that fall due",
    "ren_units": "units renewed; null in open months",
    "ren_value": "money renewed, in twenty-thousandths; null in open months",
    "rate": "forecast rate; null in closed months",
    "uplift": "forecast price ratio; null in closed months",
    "expected_units": "due units times rate",
    "expected_cents": "due cents times rate and uplift",
    "expected_cents_low": "the same at the lower end of the rate's band",
    "expected_cents_high": "the same at its upper end",
}


def core(fine: DataFrame, forecast: DataFrame, uplift: DataFrame, extension: DataFrame, acquisition: DataFrame, cfg: C.Config) -> DataFrame:
    base = ["region", "product", "fs_id", "cell_id", "ord", "role", "due_units", "due_cents"]
    closed = F.col("ord") < cfg.current
    real = fine.where(closed).groupBy(*base[:6], "ts").agg(*(F.sum(c).alias(c) for c in ("due_units", "due_cents", "ren_units", "ren_value"))).withColumn("source", F.when(F.col("ts") == 1, "second_universe").otherwise("real")).drop("ts")
    rates = forecast.select("fs_id", "ord", "rate", "rate_low", "rate_high")
    prices = uplift.select(F.col("cell").alias("cell_id"), "uplift")
    ahead = fine.where(~closed & (F.col("ts") == 0)).groupBy(*base[:6]).agg(F.sum("due_units").alias("due_units"), F.sum("due_cents").alias("due_cents")).join(rates, ["fs_id", "ord"], "left").join(prices, "cell_id", "left")
    cents = lambda rate: F.round(F.col("due_cents") * F.col(rate) * F.col("uplift"), 4)
    ahead = ahead.withColumns({"expected_cents_low": cents("rate_low"), "expected_cents_high": cents("rate_high")}).drop("rate_low", "rate_high")
    ahead = ahead.withColumn("expected_units", F.round(F.col("due_units") * F.col("rate"), 6)).withColumn("expected_cents", cents("rate")).withColumn("source", F.lit("forecast"))
    longer = extension.select("region", "product", "ord", F.lit(C.PROJECTION).alias("role"), "due_units", "expected_units", F.lit("extension").alias("source"))
    new = acquisition.select("region", "ord", F.lit(C.PROJECTION).alias("role"), F.col("units").alias("expected_units"), F.lit("acquisition").alias("source"))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (real, ahead, longer, new))
    return out.withColumn("row_key", hash_key(join_id("source", "region", "product", "fs_id", "cell_id", "ord")))


def legend(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LEGEND.items()), "name string, meaning string")


def new_rows(core_rows: DataFrame) -> DataFrame:
    """What each source adds, by month."""
    return core_rows.groupBy("ord", "source").agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("due_units"), F.lit(0)).alias("due_units"), F.round(F.coalesce(F.sum("expected_units"), F.lit(0.0)), 4).alias("expected_units"))
