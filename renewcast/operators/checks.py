"""The registry of checks: predicates by table, compiled into one aggregate a table, and differences of key sets.

A check counts the rows that break it.  Blocking ones must find none; others only tell.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """What must not be: a condition in SQL on a table's rows."""

    table: str
    name: str
    breaks: str
    blocking: bool = True


@dataclass(frozen=True)
class Keys:
    """Every key of a table (of its rows that meet ``where``) must be one of another's; and be there once, if ``once``."""

    table: str
    other: str
    key: str
    where: str = "true"
    blocking: bool = True

    @property
    def name(self) -> str:
        return f"{self.key} is in {self.other}"


CHECKS = (
    Check("fine", "a month", "ord IS NULL"), Check("fine", "units due", "raw_due_units IS NULL OR raw_due_units < 0"), Check("fine", "money due", "raw_due_cents IS NULL OR raw_due_cents < 0"),
    Check("fine", "renewed no more than due", "raw_ren_units > raw_due_units"), Check("fine", "renewals not negative", "raw_ren_units < 0 OR raw_ren_value < 0"), Check("fine", "no money without units", "raw_due_units = 0 AND raw_due_cents > 0", False),
    Check("fine", "no renewed money without units", "raw_ren_units = 0 AND raw_ren_value > 0", False), Check("fine", "discount is a percentage", "percent < 0 OR percent > 100"), Check("fine", "discount known", "percent IS NULL", False),
    Check("fine", "flags are 0 or 1", "dormant NOT IN (0, 1) OR softcancel NOT IN (0, 1) OR autorenew NOT IN (0, 1) OR newcust NOT IN (0, 1) OR ts NOT IN (0, 1)"), Check("fine", "one sign", "sign = 'mixto'", False),
    Check("fine", "dimensions known", "region IS NULL OR product IS NULL OR channel IS NULL OR term IS NULL"), Check("fine", "a role by the calendar", "role NOT IN ('entrenamiento', 'examen', 'proyeccion')"),
    Check("fine", "open months without results", "role = 'proyeccion' AND (ren_units IS NOT NULL OR ren_value IS NOT NULL)"), Check("fine", "closed months with results", "role <> 'proyeccion' AND (ren_units IS NULL OR ren_value IS NULL)"),
    Check("fine", "nothing wiped in closed months", "role <> 'proyeccion' AND (due_units <> raw_due_units OR due_cents <> raw_due_cents)"), Check("fine", "uplift within reason", "base_cents > 0 AND ren_value / 200 > 3 * base_cents", False),
    Check("units", "units due", "due_units < 0"), Check("units", "a sign", "sign NOT IN ('neutro', 'positivo', 'negativo', 'mixto')"), Check("summary", "rates are shares", "rate < 0 OR rate > 1"), Check("summary", "support where something is due", "due_units > 0 AND support IS NULL"),
    Check("weights", "z is a share", "z IS NULL OR z < 0 OR z > 1"), Check("weights", "a reference below full weight", "z < 1 AND reference IS NULL"),
    Check("forecast", "a rate", "rate IS NULL OR rate < 0 OR rate > 1"), Check("forecast", "a band around it", "rate_low > rate OR rate_high < rate"), Check("forecast", "a technique", "technique IS NULL"), Check("forecast", "a rate of its pool", "composition IS NOT NULL AND origin <> 'pool'", False),
    Check("core", "expected no more than due", "source = 'forecast' AND expected_units > due_units"), Check("core", "money expected where due", "source = 'forecast' AND due_cents > 0 AND expected_cents IS NULL"),
)
KEYS = (Keys("units", "routes", "fs_id"), Keys("summary", "units", "fs_id"), Keys("forecast", "units", "fs_id"), Keys("units", "forecast", "fs_id", "role = 'proyeccion'"), Keys("forecast", "weights", "fs_id", "composition IS NOT NULL"), Keys("weights", "members", "composition"), Keys("members", "pooled", "composition", blocking=False))


def needed() -> list[str]:
    return list(dict.fromkeys([c.table for c in CHECKS] + [t for k in KEYS for t in (k.table, k.other)]))


def registry(tables: dict[str, DataFrame]) -> DataFrame:
    """One row a check: its table and name, rows, those that break it, whether it blocks, and its state."""
    parts = []
    for table in dict.fromkeys(c.table for c in CHECKS):
        mine = [c for c in CHECKS if c.table == table]
        sums = tables[table].agg(F.count(F.lit(1)).alias("rows"), *(F.count_if(F.expr(c.breaks)).alias(f"c{i}") for i, c in enumerate(mine)))
        each = F.array(*(F.struct(F.lit(c.name).alias("name"), F.col(f"c{i}").alias("broken"), F.lit(c.blocking).alias("blocking")) for i, c in enumerate(mine)))
        parts.append(sums.select(F.lit(table).alias("scope"), "rows", F.explode(each).alias("x")).select("scope", "rows", "x.*"))
    for k in KEYS:
        own = tables[k.table].where(k.where).select(k.key).distinct()
        found = own.join(tables[k.other].select(k.key).distinct().withColumn("there", F.lit(1)), k.key, "left")
        parts.append(found.agg(F.lit(k.table).alias("scope"), F.count(F.lit(1)).alias("rows"), F.lit(k.name).alias("name"), F.count_if(F.col("there").isNull()).alias("broken"), F.lit(k.blocking).alias("blocking")))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("state", F.when(F.col("broken") == 0, "ok").when(F.col("blocking"), "failed").otherwise("warning"))


def in_sql(of: dict[str, str]) -> str:
    """The registry in DuckDB's SQL, over the names that tables have there."""
    parts = [f"SELECT '{c.table}' AS scope, count(*) AS rows, '{c.name}' AS name, count(*) FILTER ({c.breaks}) AS broken, {c.blocking} AS blocking FROM {of[c.table]}" for c in CHECKS]
    parts += [f"SELECT '{k.table}', count(*), '{k.name}', count(*) FILTER ({k.key} NOT IN (SELECT {k.key} FROM {of[k.other]})), {k.blocking} FROM (SELECT DISTINCT {k.key} FROM {of[k.table]} WHERE {k.where})" for k in KEYS]
    return "SELECT *, CASE WHEN broken = 0 THEN 'ok' WHEN blocking THEN 'failed' ELSE 'warning' END AS state FROM (" + " UNION ALL ".join(parts) + ")"
