"""Structure of the source's tables, before anything is made of them: columns, types, nulls, keys, and keys that lead
nowhere (whose rows the extract's joins would lose)."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER, TEXT, DATE = "number", "text", "date"
FAMILIES = {NUMBER: (T.NumericType,), TEXT: (T.StringType,), DATE: (T.DateType, T.TimestampType, T.TimestampNTZType)}
#: What the extract reads, and of which kind.
REQUIRED = {
    "lineitem": {"l_orderkey": NUMBER, "l_partkey": NUMBER, "l_quantity": NUMBER, "l_extendedprice": NUMBER, "l_discount": NUMBER, "l_tax": NUMBER, "l_returnflag": TEXT, "l_linestatus": TEXT, "l_shipdate": DATE},
    "orders": {"o_orderkey": NUMBER, "o_custkey": NUMBER, "o_orderstatus": TEXT, "o_orderpriority": TEXT},
    "part": {"p_partkey": NUMBER, "p_type": TEXT, "p_brand": TEXT, "p_size": NUMBER},
    "customer": {"c_custkey": NUMBER, "c_nationkey": NUMBER, "c_mktsegment": TEXT},
    "nation": {"n_nationkey": NUMBER, "n_regionkey": NUMBER},
    "region": {"r_regionkey": NUMBER, "r_name": TEXT},
}
KEYS = {"orders": "o_orderkey", "part": "p_partkey", "customer": "c_custkey", "nation": "n_nationkey", "region": "r_regionkey"}
REFERENCES = (("lineitem", "l_orderkey", "orders"), ("lineitem", "l_partkey", "part"), ("orders", "o_custkey", "customer"), ("customer", "c_nationkey", "nation"), ("nation", "n_regionkey", "region"))


def _row(table: str, column: str, check: str, rows, broken):
    return F.struct(F.lit(table).alias("source"), F.lit(column).alias("field"), F.lit(check).alias("rule"), rows.cast("long").alias("rows"), broken.cast("long").alias("broken"))


def structure(tables: dict[str, DataFrame], required=REQUIRED, keys=KEYS, references=REFERENCES) -> DataFrame:
    """One row a check: its table and column, the table's rows, and how many break it (for ``present`` and ``type``: 1 if
    the column does).  Checks that need a column which isn't there have no row.  Further columns are no error."""
    parts = []
    for table, wanted in required.items():
        found = {f.name: f.dataType for f in tables[table].schema}
        n = F.count(F.lit(1))
        each = [_row(table, c, "present", n, F.lit(int(c not in found))) for c in wanted]
        each += [_row(table, c, "type", n, F.lit(int(not isinstance(found[c], FAMILIES[k])))) for c, k in wanted.items() if c in found]
        each += [_row(table, c, "not null", n, F.count_if(F.col(c).isNull())) for c in wanted if c in found]
        parts.append(tables[table].agg(F.array(*each).alias("x")).select(F.inline("x")))
    for table, key in keys.items():
        if key in tables[table].columns:
            by = tables[table].where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            parts.append(by.agg(_row(table, key, "unique", F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).alias("x")).select("x.*"))
    for table, column, other in references:
        if column in tables[table].columns and keys[other] in tables[other].columns:
            used = tables[table].where(F.col(column).isNotNull()).groupBy(F.col(column).alias("k")).agg(F.count(F.lit(1)).alias("n"))
            both = used.join(tables[other].select(F.col(keys[other]).alias("k")).distinct().withColumn("there", F.lit(1)), "k", "left")
            parts.append(both.agg(_row(table, column, "in " + other, F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("there").isNull(), F.col("n"))), F.lit(0))).alias("x")).select("x.*"))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("state", F.when(F.col("broken") == 0, "ok").otherwise("failed"))


def in_sql() -> str:
    """The same in DuckDB's SQL, which has columns and types from its catalogue."""
    kinds = {NUMBER: "data_type IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'FLOAT', 'DOUBLE') OR data_type LIKE 'DECIMAL%'", TEXT: "data_type = 'VARCHAR'", DATE: "data_type IN ('DATE', 'TIMESTAMP', 'TIMESTAMP WITH TIME ZONE')"}
    parts = []
    for t, wanted in REQUIRED.items():
        for c, k in wanted.items():
            there = f"FROM information_schema.columns WHERE table_name = '{t}' AND column_name = '{c}'"
            parts.append(f"SELECT '{t}' AS source, '{c}' AS field, 'present' AS rule, (SELECT count(*) FROM {t}) AS rows, (NOT EXISTS (SELECT 1 {there}))::BIGINT AS broken")
            parts.append(f"SELECT '{t}', '{c}', 'type', (SELECT count(*) FROM {t}), (NOT EXISTS (SELECT 1 {there} AND ({kinds[k]})))::BIGINT")
            parts.append(f"SELECT '{t}', '{c}', 'not null', count(*), count(*) FILTER ({c} IS NULL) FROM {t}")
    parts += [f"SELECT '{t}', '{k}', 'unique', count({k}), count({k}) - count(DISTINCT {k}) FROM {t}" for t, k in KEYS.items()]
    parts += [f"SELECT '{t}', '{c}', 'in {o}', count({c}), count({c}) FILTER ({c} NOT IN (SELECT {KEYS[o]} FROM {o} WHERE {KEYS[o]} IS NOT NULL)) FROM {t}" for t, c, o in REFERENCES]
    return "SELECT *, CASE WHEN broken = 0 THEN 'ok' ELSE 'failed' END AS state FROM (" + " UNION ALL ".join(parts) + ")"
