"""What renewers pay against what they were worth: where the uplift of the large series lies, licence by licence.

The population is that of isolated renewals (no retention event: licences without a soft cancel) that aren't
acquisitions, in the last closed months with renewers.  Ratios are held against edges in whole thousandths, so a licence
that lies on an edge is on its upper side whatever the fractions' last digits.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renewcast import config as C
from renewcast.functions.columns import discount_bucket, join_id

WINDOW, MONTHS, FLOOR, TOP, SHOWN = 12, 24, 271, 50, 15
RAISE, PERSISTENCE, REFERENCE = 0.03, 3, 6
#: Lower edges of the histogram of series and of the bands of single licences, in thousandths.
EDGES = (0, 800, 900, 950, 975, 1000, 1025, 1050, 1100, 1200, 1500)
BANDS = {"lt095": 0, "095_100": 950, "100_105": 1000, "105_110": 1050, "110_120": 1100, "ge120": 1200}
NEAR, HIGH = ("095_100", "100_105"), ("110_120", "ge120")
PERCENTILES = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}


def _from(value: Column, base: Column, edge: int) -> Column:
    """Whether value / 200 / base is at least so many thousandths."""
    return value * 5 >= base * edge


def _band(value: Column, base: Column, edges: dict[str, int]) -> Column:
    (name, _), *more = edges.items()
    out = F.lit(name)
    for name, edge in more:
        out = F.when(_from(value, base, edge), name).otherwise(out)
    return out


def isolated(licences: DataFrame, cfg: C.Config) -> DataFrame:
    """The extract's rows with renewers, and of their isolated renewals the sums that can be merged: units, value, base,
    the second moment of the ratio, and the base by the licences' ratio.  Base 0 has no ratio."""
    keys = ["ord", *cfg.series, "newcust", "percent", "term"]
    rows = licences.where((F.col("ts") == 0) & (F.col("ord") < cfg.current))
    alone = (F.col("softcancel") == 0) & (F.col("ren_units") > 0) & (F.col("base_cents") > 0)
    u, band = F.col("ren_value") / 200.0, _band(F.col("ren_value"), F.col("base_cents"), BANDS)
    of = lambda c, x: F.coalesce(F.sum(F.when(c, x)), F.lit(0))
    sums = [of(alone, F.col(c)).alias(a) for c, a in (("ren_units", "i_units"), ("ren_value", "i_value"), ("base_cents", "i_base"))]
    sums.append(F.coalesce(F.sum(F.when(alone, u * u / F.col("base_cents"))), F.lit(0.0)).alias("i_square"))
    sums += [of(alone & (band == b), F.col("base_cents")).alias(f"b_{b}") for b in BANDS]
    out = rows.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("due_units", "due_cents", "ren_units", "ren_value")), *sums).where("ren_units > 0")
    return out.withColumn("fs_id", join_id(*cfg.series)).withColumn("bucket", discount_bucket(F.col("percent"), cfg.bucket_edges)).select("fs_id", "ord", "region", "product", "newcust", "percent", "bucket", "due_units", "due_cents", "ren_units", "ren_value", "i_units", "i_value", "i_base", "i_square", *(f"b_{b}" for b in BANDS))


def window(rows: DataFrame, months: int) -> DataFrame:
    """Rows of the last months that have any."""
    last = rows.select("ord").distinct().orderBy(F.desc("ord")).limit(months)
    return rows.join(F.broadcast(last), "ord", "left_semi")


_MEMBER = "i_base > 0 AND newcust = 0"


def _sums() -> list[Column]:
    add = lambda names: sum((F.col(f"b_{b}") for b in names[1:]), F.col(f"b_{names[0]}"))
    return [*(F.sum(c).alias(c) for c in ("i_units", "i_value", "i_base", "i_square")), F.sum(add(NEAR)).alias("near_base"), F.sum(add(HIGH)).alias("high_base")]


def _ratios() -> list[Column]:
    """Of merged sums: the uplift, its standard deviation between licences, and the shares of the base near 1 and high."""
    base = F.col("i_base").cast("double")
    mean = F.try_divide(F.col("i_value") / 200.0, base)
    spread = F.sqrt(F.greatest(F.try_divide(F.col("i_square"), base) - mean * mean, F.lit(0.0)))
    part = lambda c: F.try_divide(F.col(c).cast("double"), base)
    return [F.round(x, 6).alias(n) for x, n in ((mean, "uplift"), (spread, "spread"), (part("near_base"), "near"), (part("high_base"), "high"))]


def funnel(rows: DataFrame) -> DataFrame:
    """How many rows and how much renewed money are left by each condition on the population."""
    alone = F.col("i_base") > 0
    one = lambda name, c, x: F.struct(F.lit(name).alias("population"), F.sum(c.cast("long")).alias("rows"), F.sum(F.when(c, F.col(x)).otherwise(0)).alias("ren_value"))
    stages = [one("renewers", F.lit(True), "ren_value"), one("isolated", alone, "i_value"), one("not_acquired", F.expr(_MEMBER), "i_value")]
    return window(rows, WINDOW).agg(F.array(*stages).alias("stages")).select(F.explode("stages").alias("s")).select("s.*").where("rows IS NOT NULL")


def series(rows: DataFrame) -> DataFrame:
    """Each series of the population over its months of the window, and whether it is in the distribution: it has the
    floor's units due a month, or is among the largest by money due (ties: by id)."""
    by = window(rows, WINDOW).where(_MEMBER).groupBy("fs_id").agg(F.count_distinct("ord").alias("months"), F.sum("due_units").alias("due_units"), F.sum("due_cents").alias("due_cents"), *_sums(), F.coalesce(F.sum(F.when(F.col("percent").isNull(), F.col("i_value"))), F.lit(0)).alias("unknown_value"))
    largest = by.orderBy(F.desc("due_cents"), "fs_id").limit(TOP).select("fs_id", F.lit(1).alias("large"))
    # No more than TOP rows are broadcast.
    out = by.join(F.broadcast(largest), "fs_id", "left")
    taken = (F.col("due_units") >= FLOOR * F.col("months")) | F.col("large").isNotNull()
    edges = {f"{i:02d}": e for i, e in enumerate(EDGES)}
    return out.withColumn("selected", taken.cast("int")).withColumn("place", _band(F.col("i_value"), F.col("i_base"), edges)).drop("large")


def top(valued: DataFrame) -> DataFrame:
    """The series with the most money due."""
    rows = valued.where("selected = 1").orderBy(F.desc("due_cents"), "fs_id").limit(SHOWN)
    return rows.select("fs_id", "months", F.round(F.col("due_units") / F.col("months"), 6).alias("units_a_month"), "due_cents", F.round(F.col("i_units") / F.col("due_units"), 6).alias("rate"), *_ratios())


def histogram(valued: DataFrame) -> DataFrame:
    """Series and renewed money by uplift: of all in the distribution, and of those whose money is mostly of unknown
    discount.  Empty places are listed too, unless the whole set is empty."""
    rows = valued.where("selected = 1")
    sets = rows.withColumn("among", F.explode(F.when(F.col("unknown_value") * 2 > F.col("i_value"), F.array(F.lit("all"), F.lit("unknown"))).otherwise(F.array(F.lit("all")))))
    by = sets.groupBy("among", "place").agg(F.count(F.lit(1)).alias("series"), F.sum("i_value").alias("ren_value"))
    # The places are eleven a set.
    places = by.select("among").distinct().withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(len(EDGES) - 1)))).select("among", F.lpad(F.col("i").cast("string"), 2, "0").alias("place"), F.element_at(F.array(*(F.lit(e) for e in EDGES)), F.col("i") + 1).alias("from_thousandths"))
    out = places.join(by, ["among", "place"], "left").na.fill(0, ["series", "ren_value"])
    every = Window.partitionBy("among")
    share = lambda c: F.round(F.try_divide(F.col(c).cast("double"), F.sum(c).over(every).cast("double")), 6)
    return out.select("among", "from_thousandths", "series", share("series").alias("series_share"), "ren_value", share("ren_value").alias("value_share"))


def percentiles(rows: DataFrame, wanted: dict[str, float]) -> DataFrame:
    """One row: the points of ``u`` at shares of the summed whole-number weight ``w``, by straight lines between rows in
    the order of (u, w); below the first row's share its own u.

    ``place`` (in the order of u) parts the rows, so that running sums are taken within places, over what lower ones
    hold, and no task has all rows.  Rows of equal u are one: the line rises to the first of them and is level on."""
    at = rows.groupBy("place", "u").agg(F.sum("w").alias("w"), F.min("w").alias("first"))
    lower = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    per = at.groupBy("place").agg(F.sum("w").alias("held"), F.max("u").alias("most"))
    per = per.select("place", F.coalesce(F.sum("held").over(lower), F.lit(0)).alias("below"), F.max("most").over(lower).alias("u_below"), F.sum("held").over(Window.partitionBy()).cast("double").alias("total"))
    within = Window.partitionBy("place").orderBy("u")
    at = at.join(F.broadcast(per), "place").withColumn("upto", F.col("below") + F.sum("w").over(within)).withColumn("u0", F.coalesce(F.lag("u").over(within), F.col("u_below")))
    start = F.col("upto") - F.col("w")

    def point(q: float) -> Column:
        aim = F.col("total") * q
        value = F.when(F.col("u0").isNull() | (start + F.col("first") <= aim), F.col("u")).otherwise(F.col("u0") + (F.col("u") - F.col("u0")) * (aim - start) / F.col("first"))
        reached = F.col("upto") >= aim
        return F.round(F.min_by(F.when(reached, value), F.when(reached, F.col("upto"))), 6)

    return at.agg(*(point(q).alias(k) for k, q in wanted.items()))


def summary(rows: DataFrame, valued: DataFrame) -> DataFrame:
    """One row: the distribution of series (all fractions null if none is in it), and what single licences say about
    "who renews without an event renews at about their value"."""
    taken = valued.where("selected = 1")
    between = lambda a, b=None: _from(F.col("i_value"), F.col("i_base"), a) & (F.lit(True) if b is None else ~_from(F.col("i_value"), F.col("i_base"), b))
    part = lambda c, n: F.round(F.try_divide(F.coalesce(F.sum(F.when(c, F.col("i_value"))), F.lit(0)).cast("double"), F.sum("i_value").cast("double")), 6).alias(n)
    shares = taken.agg(F.count(F.lit(1)).alias("series"), F.round(F.try_divide(F.sum("i_value") / 200.0, F.sum("i_base").cast("double")), 6).alias("series_uplift"), part(between(1000, 1050), "share_100_105"), part(between(950, 1050), "share_095_105"), part(between(1100), "share_from_110"))
    covered = valued.agg(F.round(F.try_divide(F.coalesce(F.sum(F.when(F.col("selected") == 1, F.col("i_value"))), F.lit(0)).cast("double"), F.sum("i_value").cast("double")), 6).alias("covered"))
    points = percentiles(taken.select("place", (F.col("i_value") / 200.0 / F.col("i_base")).alias("u"), F.col("i_value").alias("w")), PERCENTILES)
    single = window(rows, WINDOW).where(_MEMBER).agg(*_sums()).select(*_ratios())
    said = F.when(F.col("near") >= 0.8, "holds").when(F.col("high") >= 0.25, "fails").when(F.col("near").isNotNull(), "in_part")
    # Each side is one row.
    return shares.crossJoin(covered).crossJoin(points).crossJoin(single).withColumn("claim", said)


def bands(rows: DataFrame) -> DataFrame:
    """What isolated renewals were worth, by their licences' ratio."""
    held = window(rows, WINDOW).where(_MEMBER).agg(*(F.coalesce(F.sum(f"b_{b}"), F.lit(0)).alias(b) for b in BANDS))
    out = held.select(F.explode(F.array(*(F.struct(F.lit(b).alias("band"), F.col(b).alias("base_cents")) for b in BANDS))).alias("s")).select("s.*")
    return out.withColumn("share", F.round(F.try_divide(F.col("base_cents").cast("double"), F.sum("base_cents").over(Window.partitionBy()).cast("double")), 6))


def by_discount(rows: DataFrame) -> DataFrame:
    """The population by discount bucket, and by whether the discount is known."""
    known = F.when(F.col("percent").isNull(), "unknown").otherwise("known")
    cuts = F.array(F.struct(F.lit("bucket").alias("cut"), F.col("bucket").alias("value")), F.struct(F.lit("discount").alias("cut"), known.alias("value")))
    return window(rows, WINDOW).where(_MEMBER).withColumn("c", F.explode(cuts)).groupBy("c.cut", "c.value").agg(*_sums()).select("cut", "value", F.col("i_value").alias("ren_value"), *_ratios())


def monthly(rows: DataFrame) -> DataFrame:
    """The population month by month, each against the mean uplift of its (up to) twelve months before; ``above`` is
    null without enough of them."""
    by = window(rows, MONTHS).where(_MEMBER).groupBy("ord").agg(*_sums())
    order = Window.orderBy("ord").rowsBetween(-12, -1)  # over no more than MONTHS rows
    own = F.try_divide(F.col("i_value") / 200.0, F.col("i_base").cast("double"))
    by = by.withColumn("own", own).withColumn("prior", F.when(F.count("own").over(order) >= REFERENCE, F.avg("own").over(order)))
    step = F.col("own") / F.col("prior") - 1
    return by.select("ord", F.col("i_units").alias("ren_units"), *_ratios(), F.round("prior", 6).alias("before"), F.round(step, 6).alias("step"), (F.round(step, 9) >= RAISE).cast("int").alias("above"))


def verdict(path: DataFrame) -> DataFrame:
    """Of the last months of the path: the longest run above the step, and what that says."""
    last = path.orderBy(F.desc("ord")).limit(WINDOW).where("above IS NOT NULL")
    place = F.row_number().over(Window.orderBy("ord")) - F.row_number().over(Window.partitionBy("above").orderBy("ord"))
    runs = last.withColumn("island", place).groupBy("above", "island").agg(F.count(F.lit(1)).alias("n"))
    out = runs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("months"), F.coalesce(F.sum(F.when(F.col("above") == 1, F.col("n"))), F.lit(0)).alias("months_above"), F.coalesce(F.max(F.when(F.col("above") == 1, F.col("n"))), F.lit(0)).alias("longest_run"))
    return out.withColumn("verdict", F.when(F.col("longest_run") >= PERSISTENCE, "increase").when(F.col("months_above") > 0, "scattered").when(F.col("months") > 0, "none"))
