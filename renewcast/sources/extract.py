"""The renewal extract: licences that fall due by month, from order lines.

One order line is one licence, due in its shipping month.  Money is kept in whole units (cents of what falls
due; twenty-thousandths of what renewed), so sums don't depend on their order.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renewcast import config as C
from renewcast.functions.columns import discount_bucket, join_id, month_ordinal, role, sign

DIMS = ["region", "product", "dormant", "softcancel", "autorenew", "channel", "newcust", "percent", "ts", "term"]
MEASURES = ["due_units", "due_cents", "ren_units", "ren_value", "base_cents"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of the largest table for each task that joins and sums lines.
TASK_ROWS = 1 << 21


def _dealt(rows: DataFrame, parts: int, key: str) -> DataFrame:
    return rows.where(F.col(key).isNotNull()).repartition(parts, key)


def licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their dimensions.

    Lines are dealt twice only, by order and by part, and carry whole numbers and flags instead of the source's prices and
    texts; customers are joined to orders before.  Tasks grow in number with the tables, not in size, and hold the side
    whose key is unique.  No more tasks are left after the joins than that, so that a task has many lines of a group and
    sums them before what follows is shuffled."""
    t = lambda name: table(spark, sf_dir, name)
    flag = lambda c: c.cast("int")
    parts = max(spark.sparkContext.defaultParallelism, *(-(-t(name).count() // TASK_ROWS) for name in ("lineitem", "orders", "part", "customer")))
    dealt = lambda rows, key: _dealt(rows, parts, key)
    # As many rows as there are nations.
    nations = F.broadcast(t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("region")))
    customers = t("customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("channel"))
    orders = t("orders").select("o_orderkey", "o_custkey", flag(F.col("o_orderstatus") == "P").alias("dormant"), flag(F.col("o_orderpriority") == "1-URGENT").alias("autorenew"))
    goods = t("part").select("p_partkey", F.col("p_type").alias("product"), flag(F.col("p_size") <= 5).alias("softcancel"), flag(F.col("p_brand") == "Brand#1").alias("ts"))
    hundred = lambda c: F.round(F.col(c) * 100).cast("long")
    lines = t("lineitem").select("l_orderkey", "l_partkey", month_ordinal(F.col("l_shipdate")).alias("ord"), F.col("l_quantity").cast("long").alias("due_units"), hundred("l_extendedprice").alias("due_cents"), hundred("l_tax").alias("tax"), hundred("l_discount").alias("off"),
                                 (F.col("l_returnflag") != "R").alias("renewed"), (F.col("l_linestatus") == "F").alias("one"))
    bought = dealt(orders, "o_custkey").join(dealt(customers, "c_custkey").hint("shuffle_hash"), F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")
    rows = dealt(lines, "l_orderkey").join(dealt(bought, "o_orderkey").hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey", "o_orderkey")
    rows = dealt(rows, "l_partkey").join(dealt(goods, "p_partkey").hint("shuffle_hash"), F.col("l_partkey") == F.col("p_partkey")).coalesce(parts).join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    tax, off, cents, units, renewed = (F.col(c) for c in ("tax", "off", "due_cents", "due_units", "renewed"))
    return rows.select(
        "ord", "region", "product", "dormant", "softcancel", "autorenew", "channel", flag(tax >= 6).alias("newcust"), F.when(tax != 8, off * 5).alias("percent"), "ts", F.when(F.col("one"), "1 year").otherwise("3 year").alias("term"),
        "due_units", "due_cents", F.when(renewed, units).otherwise(0).alias("ren_units"), F.when(renewed, cents * (200 + 2 * tax - off)).otherwise(0).alias("ren_value"), F.when(renewed, cents).otherwise(0).alias("base_cents"))


def extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the source delivers: licences grouped by month and dimensions."""
    return licences(spark, sf_dir).groupBy("ord", *DIMS).agg(*(F.sum(m).alias(m) for m in MEASURES), F.count(F.lit(1)).alias("licences"))


def apply_calendar(rows: DataFrame, cfg: C.Config) -> DataFrame:
    """Roles of months; results of open months are wiped (null) and so is, to 0, the pipeline of one-year terms
    that will only exist if they renew.  The originals stay as raw_*."""
    open_month = F.col("ord") >= cfg.current
    not_yet = (F.col("ord") >= cfg.current + 12) & (F.col("term") == cfg.one_year)
    out = rows.select("*", *(F.col(m).alias(f"raw_{m}") for m in MEASURES)).withColumn("role", role(F.col("ord"), cfg))
    return out.withColumns({**{m: F.when(~open_month, F.col(m)) for m in ("ren_units", "ren_value", "base_cents")}, **{m: F.when(not_yet, F.lit(0)).otherwise(F.col(m)) for m in ("due_units", "due_cents")}})


def fine_table(spark: SparkSession, sf_dir: str, cfg: C.Config) -> DataFrame:
    """The extract with its calendar, ids and sign."""
    rows = apply_calendar(extract(spark, sf_dir), cfg)
    rows = rows.withColumn("bucket", discount_bucket(F.col("percent"), cfg.bucket_edges)).withColumn("fs_id", join_id(*cfg.series)).withColumn("sign", sign(cfg))
    return rows.withColumn("cell_id", join_id(*cfg.mandatory, "newcust", "bucket"))


def units(fine: DataFrame, cfg: C.Config) -> DataFrame:
    """Series by month: the rows that are forecast in the normal universe."""
    keys = ["fs_id", *cfg.series, "sign", "ord", "role"]
    return fine.where("ts = 0").groupBy(*keys).agg(*(F.sum(m).alias(m) for m in MEASURES), F.count(F.lit(1)).alias("rows"))
