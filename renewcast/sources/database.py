"""Extracts from and tables to a relational database over JDBC."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_query(spark: SparkSession, url: str, query: str, column: str | None = None, bounds: tuple[str, str] | None = None, partitions: int = 16, fetch: int = 10_000, **properties: str) -> DataFrame:
    """A query's rows; with a numeric or date column and its bounds, the database is read in as many parts."""
    reader = spark.read.format("jdbc").options(url=url, fetchsize=fetch, **properties)
    if column is None:
        return reader.option("query", query).load()
    lower, upper = bounds
    return reader.options(dbtable=f"({query}) t", partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=partitions).load()


def write_table(rows: DataFrame, url: str, table: str, batch: int = 10_000, partitions: int = 16, **properties: str) -> int:
    """Replaces a table and counts what the database holds then; a difference is an error."""
    (rows.write.format("jdbc").mode("overwrite").options(url=url, dbtable=table, batchsize=batch, numPartitions=partitions, **properties).save())
    there = read_query(rows.sparkSession, url, f"SELECT COUNT(*) AS n FROM {table}", **properties).first()[0]
    here = rows.count()
    if there != here:
        raise ValueError(f"{table} holds {there} rows of {here}")
    return there
