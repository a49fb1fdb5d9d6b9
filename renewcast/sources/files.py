"""Tables as CSV files."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Nulls are marked, so that empty texts stay what they are; quotes within cells are doubled.
FORM = {"header": True, "nullValue": "\\N", "escape": '"', "multiLine": True}


def write_csv(rows: DataFrame, path: str) -> int:
    """Replaces a folder of CSV files with headers and counts what it holds then; a difference is an error.  Columns must
    be plain values."""
    rows.write.mode("overwrite").options(**FORM).csv(path)
    there, here = read_csv(rows.sparkSession, path, rows.schema).count(), rows.count()
    if there != here:
        raise ValueError(f"{path} holds {there} rows of {here}")
    return there


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """What ``write_csv`` has written."""
    return spark.read.schema(schema).options(**FORM, emptyValue="").csv(path)
