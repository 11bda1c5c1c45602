"""Typed CSV scans.

Schemas are always declared (never inferred).  Quotes are escaped by doubling, as in
RFC 4180.  A line that does not fit is kept apart, never dropped unseen:
``stage_inputs`` writes each input once, split by a ``malformed`` flag, and rows,
rejected lines and all counts are read from that one split.  (A query over the raw
scan would parse only the columns it uses and judge fewer faults.)
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from ratingsmith.operators.runlog import listing_metadata
from ratingsmith.session import workspace
from ratingsmith.sources.adapters import Inputs
from ratingsmith.sources.contracts import INPUT_FILES, INPUTS, Contract

CORRUPT = "_corrupt_record"


def reader(spark: SparkSession, schema: StructType, mode: str = "PERMISSIVE"):
    return (spark.read.schema(schema).option("header", "true").option("mode", mode)
            .option("escape", '"').option("quote", '"'))


def read_csv_checked(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """Every line with a ``malformed`` flag and the raw text of bad lines."""
    schema = StructType(contract.schema.fields + [StructField(CORRUPT, StringType(), True)])
    df = reader(spark, schema).option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    return df.withColumn("malformed", F.col(CORRUPT).isNotNull())


def stage_csv(spark: SparkSession, path: str, contract: Contract,
              out: str) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, rejected lines) of one CSV input, staged in one scan.

    The scan is written once, partitioned by the ``malformed`` flag, so the
    parsed side and the quarantine are both plain Parquet afterwards and any
    count over either side is exact (the parser never sees a pruned schema).
    """
    df = read_csv_checked(spark, path, contract)
    df.select(*contract.schema.fieldNames(), F.col(CORRUPT).alias("line"), "malformed") \
        .write.mode("overwrite").partitionBy("malformed").parquet(out)
    schema = StructType(contract.schema.fields + [StructField("line", StringType(), True),
                                                  StructField("malformed", BooleanType(), True)])
    staged = spark.read.schema(schema).parquet(out)
    good = staged.filter(~F.col("malformed")).select(*contract.schema.fieldNames())
    bad = staged.filter(F.col("malformed")).select("line")
    return good, bad


@dataclass
class StagedInput:
    good: DataFrame
    bad: DataFrame


def stage_inputs(spark: SparkSession, raw_dir: str, out: str) -> dict[str, StagedInput]:
    """The five inputs, each split once into typed rows and rejected lines below ``out``."""
    return {name: StagedInput(*stage_csv(spark, os.path.join(raw_dir, INPUT_FILES[name]), c, os.path.join(out, name)))
            for name, c in INPUTS.items()}


class StagedInputs(Inputs):
    """The typed rows of CSV inputs; each is staged when it is first asked for."""

    def __init__(self, spark: SparkSession, raw_dir: str, out: str):
        self._at, self._done = (spark, raw_dir, out), {}

    def __getattribute__(self, name):
        if name not in INPUTS:
            return super().__getattribute__(name)
        if name not in self._done:
            spark, raw_dir, out = self._at
            self._done[name] = stage_csv(spark, os.path.join(raw_dir, INPUT_FILES[name]), INPUTS[name], os.path.join(out, name))[0]
        return self._done[name]


def read_inputs(spark: SparkSession, raw_dir: str, out: str | None = None) -> Inputs:
    """The typed rows of the five inputs, each read from its staged split; what nobody asks for is not staged."""
    return StagedInputs(spark, raw_dir, out or workspace(spark, "csv", uuid.uuid4().hex))


def ingest_report(staged: dict[str, StagedInput]) -> DataFrame:
    """S3 / Q9: table_name, row_count, null_required, malformed, from the staged split."""
    rows = []
    for name, s in staged.items():
        any_null = reduce(lambda a, b: a | b, [F.col(x).isNull() for x in INPUTS[name].required])
        both = s.good.select(F.lit(False).alias("bad"), any_null.alias("null")).unionByName(
            s.bad.select(F.lit(True).alias("bad"), F.lit(False).alias("null")))
        rows.append(both.agg(F.count_if(~F.col("bad")).alias("row_count"), F.count_if("null").alias("null_required"),
                             F.count_if("bad").alias("malformed")).select(F.lit(name).alias("table_name"), "*"))
    return reduce(lambda a, b: a.unionByName(b), rows)


def fault_reasons(bad: DataFrame, contract: Contract) -> DataFrame:
    """Each rejected ``line`` with ``column_name`` and ``reason``.

    ``fields``: the line has too few or too many fields; the column is the one after the last that has a value (NULL
    if all have one).  ``type``: the first column whose value cannot be cast to its type.  ``other``: anything else
    that the parser rejects, without a column.
    """
    names = contract.schema.fieldNames()
    shape = ", ".join(f"f{i} string" for i in range(len(names))) + f", {CORRUPT} string"
    split = bad.select("line", F.from_csv("line", shape, {"escape": '"', "quote": '"', "columnNameOfCorruptRecord": CORRUPT}).alias("f"))
    given = [F.col("f").getField(f"f{i}") for i in range(len(names))]
    last = F.greatest(*(F.when(v.isNotNull(), F.lit(i)).otherwise(F.lit(-1)) for i, v in enumerate(given)))
    after = F.get(F.array(*(F.lit(n) for n in names)), last + 1)
    wrong = F.coalesce(*(F.when(v.isNotNull() & v.try_cast(f.dataType).isNull(), F.lit(f.name))
                         for v, f in zip(given, contract.schema.fields, strict=True)))
    width = F.col("f").getField(CORRUPT).isNotNull()
    return split.select("line", F.when(width, after).otherwise(wrong).alias("column_name"),
                        F.when(width, F.lit("fields")).when(wrong.isNotNull(), F.lit("type")).otherwise(F.lit("other")).alias("reason"))


def fault_report(staged: dict[str, StagedInput]) -> DataFrame:
    """S3: table_name, column_name, reason, lines: what was wrong with the rejected lines of every input."""
    rows = [fault_reasons(s.bad, INPUTS[name]).groupBy("column_name", "reason").agg(F.count(F.lit(1)).alias("lines"))
            .select(F.lit(name).alias("table_name"), "column_name", "reason", "lines") for name, s in staged.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)


def write_csv(df: DataFrame, raw_dir: str, name: str, mode: str = "overwrite") -> None:
    """One input as headed CSV files (a folder of its file name)."""
    (df.write.mode(mode).option("header", "true").option("escape", '"')
     .csv(os.path.join(raw_dir, INPUT_FILES[name])))


def write_inputs(inputs: Inputs, raw_dir: str) -> None:
    for name, df in inputs.as_dict().items():
        write_csv(df, raw_dir, name)


def input_metadata(spark: SparkSession, raw_dir: str) -> DataFrame:
    """File metadata (C1) of the five CSV inputs; reads the listing only."""
    frames = [listing_metadata(spark, os.path.join(raw_dir, INPUT_FILES[name]), name) for name in INPUTS]
    return reduce(lambda a, b: a.unionByName(b), frames)
