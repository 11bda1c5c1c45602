"""JDBC source and sink.

Reads are split into ``num_partitions`` range queries on a numeric column
when bounds are given, so a large table is not pulled through one
connection.  Writes batch rows and, for overwrite, truncate instead of
dropping the table so keys and indexes survive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None,
              fetchsize: int = 10000, **props) -> DataFrame:
    """A table or a pushed-down query; partitioned reads when bounds are known."""
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", fetchsize)
    if query is not None:
        r = r.option("query", query)
    else:
        r = r.option("dbtable", table)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions or 1))
    for k, v in props.items():
        r = r.option(k, v)
    return r.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 10000,
               num_partitions: int | None = None, **props) -> None:
    """Batched insert; ``overwrite`` truncates the existing table."""
    w = (df.write.format("jdbc").option("url", url).option("dbtable", table)
         .option("batchsize", batchsize).option("truncate", "true").mode(mode))
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    for k, v in props.items():
        w = w.option(k, v)
    w.save()
