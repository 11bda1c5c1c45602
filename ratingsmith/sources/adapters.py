"""Driver tables -> the five rating-style inputs and a run log.

Each adapter is a pure projection/join over the given Parquet tables, so its
work grows with them.  Column pruning reaches the scan because only the
needed columns are selected.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed values of the adapter formulas.
NO_GENRES = "(no genres listed)"
RATING_STEPS = 11
NO_GENRE_EVERY = 17
TAG_ITEMS = 97
TAG_NOISE_EVERY = 11
TITLE_BASE_YEAR = 1950
RUN_STATUS = {"F": "success", "O": "skipped"}   # anything else: failed
MAX_DURATION_SECS = 5400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """userId, movieId, rating (0.0-5.0 by halves), timestamp (epoch s)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey",
                                                "l_quantity", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    steps = F.pmod(F.floor("l_quantity").cast("bigint") - 1, F.lit(RATING_STEPS))
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        (F.lit(0.5) * steps).cast("double").alias("rating"),
        F.unix_timestamp("l_shipdate").alias("timestamp"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """movieId, title ``name (year)``, genres ``a|b|type``."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    year = (F.lit(TITLE_BASE_YEAR) + F.col("p_size")).cast("string")
    title = F.when(F.pmod("p_size", F.lit(10)) == 0, F.col("p_name")).otherwise(
        F.concat(F.col("p_name"), F.lit(" ("), year, F.lit(")")))
    genres = F.when(F.pmod("p_partkey", F.lit(NO_GENRE_EVERY)) == 0, F.lit(NO_GENRES)).otherwise(
        F.concat(F.regexp_replace("p_name", " ", "|"), F.lit("|"), F.col("p_type")))
    return p.select(F.col("p_partkey").alias("movieId"), title.alias("title"),
                    genres.alias("genres"))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """userId, movieId, raw tag (padded upper-case, or noise), timestamp."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    tag = F.when(F.pmod("event_id", F.lit(TAG_NOISE_EVERY)) == 0, F.lit("x")).otherwise(
        F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")))
    return ev.select(
        F.col("user_id").alias("userId"),
        F.pmod("event_id", F.lit(TAG_ITEMS)).alias("movieId"),
        tag.alias("tag"),
        F.unix_timestamp("ts").alias("timestamp"),
    )


def genome_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-form vectors: movieId, tagId (array position from 0), relevance = |value|."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return emb.select("vec_id", F.posexplode("embedding").alias("pos", "v")).select(
        F.col("vec_id").alias("movieId"),
        F.col("pos").alias("tagId"),
        F.abs(F.col("v").cast("double")).alias("relevance"),
    )


def genome_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tagId, tag name for every vector position present in the data."""
    emb = table(spark, sf_dir, "embeddings").select(F.size("embedding").alias("n"))
    width = emb.agg(F.max("n").alias("n"))
    return width.select(F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("tagId")).select(
        "tagId", F.concat(F.lit("tag_"), F.col("tagId").cast("string")).alias("tag"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit log: one run per order (run_id, run_date, status, rows_loaded, duration_secs)."""
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                              "o_totalprice", "o_orderdate")
    status = F.coalesce(
        *[F.when(F.col("o_orderstatus") == k, F.lit(v)) for k, v in RUN_STATUS.items()],
        F.lit("failed"))
    return od.select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderdate").alias("run_date"),
        status.alias("status"),
        F.col("o_custkey").alias("rows_loaded"),
        F.pmod(F.floor("o_totalprice").cast("bigint"), F.lit(MAX_DURATION_SECS)).alias("duration_secs"),
    )


def table_stats(log: DataFrame, tables) -> DataFrame:
    """Per-run row counts: run_id, table_name, row_count = run_id * 10 + len(name)."""
    names = F.array(*[F.lit(t) for t in tables])
    return log.select("run_id", F.explode(names).alias("table_name")).select(
        "run_id", "table_name",
        (F.col("run_id") * 10 + F.length("table_name")).cast("bigint").alias("row_count"))


@dataclass
class Inputs:
    ratings: DataFrame
    movies: DataFrame
    tags: DataFrame
    genome_scores: DataFrame
    genome_tags: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {"ratings": self.ratings, "movies": self.movies, "tags": self.tags,
                "genome_scores": self.genome_scores, "genome_tags": self.genome_tags}


def load_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(ratings(spark, sf_dir), movies(spark, sf_dir), tags(spark, sf_dir),
                  genome_scores(spark, sf_dir), genome_tags(spark, sf_dir))
