"""Mixing sources to target weights by systematic sampling, DataFrame functions only (operator 10).

Each source gets a target number of words: its weight's share of all words, but at
most CAP = 3 times its own; what is cut off is shared again by weight.  That is
target = min(3 size, level * weight) for the one level at which the targets sum to
all words; it is found from the sorted ratios of cap to weight.

A document's expected copies are target / size of its source, at most 3.  They are
summed up along the source, a random offset in [0, 1) is added, and a document is
emitted once for each integer boundary that its interval crosses.  Documents are
ordered by size class, within it in parts of about CELL rows by the id's hash, so the words taken come near the target too.  The offset comes
from the seed and the source's name, so reruns agree.

Scale.  The documents before one in its source are its place in a global order (source, size class, hash part, size, id),
which a range exchange and the sizes of its partitions give (``common.placed``): no window holds a source, and
one id or row that a third of all rows share spreads over partitions too, as rows that are
equal are told apart by where they were read.  Rows are shuffled once, with
the columns the caller selected.  Sources are one row each; they are ranked
in one window.

Defined cases.  NULL text: size 0.  NULL source: a source of its own, the last.  A
source of size 0 has target 0 and takes nothing.  NULL ids are ordered first.
Repeated rows are sampled each on its own.  Result columns replace input columns of the same name.
Empty table: empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

WEIGHTS, CAP, CELL, SEED = (5, 2, 1), 3, 20_000, 17


def size_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(common.quoted(text)), F.lit(common.WORD)), F.lit(0)).cast("long")


def hash32(value: Column) -> Column:
    """First 32 bits of MD5 as a number."""
    return F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, docs, source_size`` -> the same with ``target``; one row a source."""
    place = F.row_number().over(W.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(place, F.lit(len(weights))))
    rows = sizes.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(float(cap)))
    order = W.orderBy(F.col("cap") / F.col("w"), F.asc_nulls_last("source"))
    every = W.partitionBy()
    before = order.rowsBetween(W.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    rows = rows.withColumns({"level": level, "place": F.row_number().over(order)})
    first = F.min_by("level", F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("place"))).over(every)
    return rows.select("source", "docs", "source_size", F.least("cap", first * F.col("w")).alias("target"))


def sample(df: DataFrame, size: Column, source: str = "source", doc_id: str = "doc_id",
           weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """``df`` with ``size, source_size, target, copies``."""
    stages = common.Stages(df.sparkSession, "mixing")
    rows = df.select(common.others(df).alias("row"), F.col(common.quoted(source)).cast("string").alias("source"),
                     F.col(common.quoted(doc_id)).alias("id"), size.alias("size"))
    # a key without NULLs, so that windows and joins share one partitioning
    key = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col("source")))
    rows = rows.withColumn("s", key)
    by = rows.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    offset = F.floor(hash32(F.concat(F.lit(f"{seed}:"), F.col("source").isNull().cast("string"), F.lit(":"),
                                     F.coalesce("source", F.lit("")))) / F.lit(1 << 22)) / F.lit(1024.0)
    plan = stages.put(targets(by, weights, cap).select(
        key.alias("s"), "source_size", "target", offset.alias("offset"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"),
        F.ceil(F.col("docs") / CELL).alias("cut")), "plan")
    part = F.pmod(hash32(F.coalesce(F.col("id").cast("string"), F.lit(""))), F.col("cut"))
    ordered = rows.join(plan.select("s", "cut"), "s").select(
        "row", "s", "size", "id", F.length(F.bin("size")).alias("class"), part.alias("part"), F.xxhash64("row").alias("tie"),
        F.monotonically_increasing_id().alias("read"))
    by = ["s", "class", "part", "size", F.asc_nulls_first("id"), "tie", "read"]
    placed = common.placed(ordered.repartitionByRange(*by).sortWithinPartitions(*by).select("row", "s", "size"), stages, "placed")
    firsts = placed.groupBy("s").agg(F.min("place").alias("first"))
    plan = stages.put(plan.join(firsts, "s").select("s", "first", "source_size", "target", "offset", "rate"), "firsts")
    upto = F.col("place") - F.col("first") + 1
    copies = (F.floor(F.col("offset") + F.col("rate") * upto) - F.floor(F.col("offset") + F.col("rate") * (upto - 1)))
    done = placed.join(plan, "s").withColumn("copies", copies.cast("long"))
    return common.restore(df, done, {c: c for c in ("size", "source_size", "target", "copies")})


def emit(sampled: DataFrame, copies: str = "copies") -> DataFrame:
    """Each row as often as ``copies`` says, without that column."""
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))
    return sampled.filter(F.col(copies) > 0).select(*(c for c in sampled.columns if c != copies), times.alias("_copy")).drop("_copy")
