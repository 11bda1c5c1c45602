"""Shards that match the mixture of sources: proportional stratified interleaving (operator 12).

Rows are shuffled by a seeded hash within their source and ranked there.  A row's fractional rank is
(rank + u) / size of the source, with an offset u in [0, 1) of the source (else all sources of one
row would stand at the same place).  All rows are sorted by it and cut into shards of equal numbers of
rows: shard s has the places ceil(s N / k) to ceil((s + 1) N / k) - 1, so counts differ by at most one
(law ``rows``), and every stretch of the order, hence every shard, holds each source in its share, up to
a row or two of each.  ``slot`` is the place in the shard, from 0 without gaps.

Scale.  Two range exchanges: by (source, hash) and by fractional rank.  Neither collects a source: its rows
spread over neighbouring partitions, and ranks come from a task's own numbering plus the sizes of the
partitions before it (``common.placed``).  Copies of one row are told apart by where they were read, so
even a third of all rows being the same row does not meet in one task.  Sources are one row each.

Defined cases.  NULL source: a source of its own.  Equal hashes: ordered by the other columns' hash, then where
they were read, which only equal rows (or 64-bit collisions) need.  NULL ids and repeated rows are rows like any other.  Texts
are not looked at unless ``order`` or ``size`` does; NULL text has no bytes.  More shards than rows: some
shards are empty.  Equal texts are not kept together (a text of a third of all rows would break the law).
Result columns take the place of input columns of the same name.  Empty table: empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .mixing import hash32

SHARDS, SEED, LAW = 40, 29, "rows"


def key_of(source: str) -> Column:
    """A source's name, with a mark that tells NULL from any name."""
    col = F.col(common.quoted(source)).cast("string")
    return F.when(col.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), col))


def assign(df: DataFrame, shards: int = SHARDS, source: str = "source", order: Column | None = None,
           seed: int = SEED) -> DataFrame:
    """``df`` with ``shard`` and ``slot``.

    ``order`` is the hash that shuffles (default: of all columns and the seed).  Carry ids rather than texts through it
    where texts are large: both exchanges move whole rows.
    """
    stages = common.Stages(df.sparkSession, "sharding")
    whole = F.xxhash64(F.lit(seed), *(F.col(common.quoted(c)) for c in df.columns))
    rows = df.select(common.others(df).alias("row"), key_of(source).alias("s"),
                     (whole if order is None else order).alias("h"), whole.alias("tie"),
                     F.monotonically_increasing_id().alias("read"))
    by = ["s", "h", "tie", "read"]
    ranked = common.placed(rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("tie", "read"), stages, "shuffled")
    offset = F.floor(hash32(F.concat(F.lit(f"{seed}:"), F.col("s"))) / F.lit(1 << 22)) / F.lit(1024.0)
    sources = stages.put(ranked.groupBy("s").agg(F.min("place").alias("first"), F.count("*").alias("size"))
                         .withColumn("u", offset), "sources")
    part = (F.col("place") - F.col("first") + F.col("u")) / F.col("size")
    ranked = ranked.join(sources, "s").select("row", "s", (F.col("place") - F.col("first")).alias("rank"), part.alias("part"))
    by = ["part", "s", "rank"]
    cut = common.placed(ranked.repartitionByRange(*by).sortWithinPartitions(*by).select("row"), stages, "interleaved")
    count = int(sources.agg(F.sum("size")).first()[0] or 0)
    shard = F.floor(F.col("place") * F.lit(shards) / F.lit(max(count, 1))) if count * shards < 2 ** 52 else \
        F.expr(f"CAST(CAST(place AS DECIMAL(38,0)) * {shards} DIV {max(count, 1)} AS BIGINT)")
    cut = cut.withColumn("shard", shard.cast("int"))
    first = F.expr(f"CAST((CAST(shard AS DECIMAL(20,0)) * {count} + {shards - 1}) DIV {shards} AS BIGINT)")
    return common.restore(df, cut.withColumn("slot", F.col("place") - first), {"shard": "shard", "slot": "slot"})


def write(sharded: DataFrame, folder: str) -> None:
    """One folder ``shard=s`` of Parquet files for each shard, every file in order of ``slot``.

    A shard is written by the tasks that its slots fall to, not by one.
    """
    by = ["shard", "slot"]
    sharded.repartitionByRange(*by).sortWithinPartitions(*by).write.partitionBy("shard").mode("overwrite").option(
        "partitionOverwriteMode", "static").parquet(folder)
