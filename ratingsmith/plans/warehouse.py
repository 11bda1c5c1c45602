"""Star schema build and idempotent sinks.

Tables are lazy DataFrames until a sink writes them.  Every write replaces its
table in one job, so a retried run never duplicates rows and leaves nothing of
an earlier input behind; replacing single years is an explicit mode.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import StructType

from ratingsmith.operators import aggregates as agg
from ratingsmith.operators import clean
from ratingsmith.operators import quality as qc
from ratingsmith.operators import similarity as sim
from ratingsmith.operators import windows as win
from ratingsmith.sources.contracts import (
    AUDIT_SCHEMAS, WAREHOUSE_DDL, WAREHOUSE_MAX_LENGTHS, WAREHOUSE_NOT_NULL, WAREHOUSE_TYPES, table_schema,
)


@dataclass
class StarParams:
    min_count: int = 100
    rolling_days: int = 30
    sim_threshold: float = 0.85
    sim_top_n: int | None = 500
    sim_norms: str = "full"
    max_records_per_file: int | None = None


def dim_movies(items: DataFrame, item: str = "movieId") -> DataFrame:
    """P5: item dimension."""
    return items.select(F.col(item).alias("movie_id"), "title", "clean_title", "genres",
                        "release_year")


def dim_users(ratings: DataFrame, user: str = "userId") -> DataFrame:
    """One row per user seen in the cleaned ratings."""
    return clean.distinct_values(ratings, user, "user_id")


def fact_base(ratings: DataFrame, items: DataFrame, item: str = "movieId") -> DataFrame:
    """Ratings whose item is in the item dimension (a semi-join, not an inner join)."""
    return ratings.join(items.select(item), item, "left_semi")


def fact_ratings(ratings: DataFrame, items: DataFrame, user: str = "userId",
                 item: str = "movieId", rolling_days: int = 30,
                 before: DataFrame | None = None, recent: DataFrame | None = None) -> DataFrame:
    """P6 + W1-W4: fact grain with running and 30-day rolling columns.

    ``before`` and ``recent`` are the state of earlier ratings (``windows.entity_stats``).
    """
    base = fact_base(ratings, items, item)
    stats = win.entity_stats(base, [item], ["rating_date", "timestamp", user], "rating",
                             running=("cumulative_rating_count", "cumulative_avg_rating"),
                             rolling=("rolling_30d_count", "rolling_30d_avg"),
                             rolling_days=rolling_days, before=before, recent=recent, sized=ratings)
    return stats.select(F.col(user).alias("user_id"), F.col(item).alias("movie_id"), "rating",
                        "rating_date", "rating_year", "cumulative_rating_count",
                        "cumulative_avg_rating", "rolling_30d_avg", "rolling_30d_count")


class LazyTables(Mapping):
    """Table name -> DataFrame, each plan built on first access.

    Building the similarity plan sizes its blocks with one count, so it is
    deferred until a caller actually asks for that table.
    """

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def star_tables(ratings: DataFrame, items: DataFrame, vectors: DataFrame,
                params: StarParams = StarParams()) -> LazyTables:
    """All six output tables as lazy DataFrames."""

    def fact():
        return fact_ratings(ratings, items, rolling_days=params.rolling_days)

    def similarity():
        vecs = vectors
        if params.sim_top_n is not None:
            base = fact_base(ratings, items)
            top = agg.top_n_by_count(base, "movieId", params.sim_top_n).select("movieId")
            vecs = sim.restrict_to(vectors, top, "movieId", bound=params.sim_top_n)
        return sim.cosine_pairs(vecs, threshold=params.sim_threshold,
                                norms=params.sim_norms, sort=False)

    return LazyTables({
        "dim_movies": lambda: dim_movies(items),
        "dim_users": lambda: dim_users(ratings),
        "fact_ratings": fact,
        "genre_trends": lambda: agg.group_trends(ratings, items, sort=False),
        "decade_stats": lambda: agg.bucket_stats(ratings, items, min_count=params.min_count,
                                                 sort=False),
        "tag_similarity": similarity,
    })


# insert-time defaults of the warehouse tables.
CREATED_AT_TABLES = ("dim_movies", "dim_users")


def sink_projection(df: DataFrame, table: str) -> DataFrame:
    """F18 + F17: warehouse column types (decimal, smallint) and insert-time defaults."""
    types = WAREHOUSE_TYPES.get(table, {})
    cols = [F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    if table in CREATED_AT_TABLES and "created_at" not in df.columns:
        cols.append(F.current_timestamp().alias("created_at"))
    return df.select(*cols)


PARTITIONING = {"fact_ratings": ["rating_year"], "clean_ratings": ["rating_year"],
                "item_years": ["rating_year"], "user_years": ["rating_year"]}
# The access paths the reference indexed become file layout.  Sorting is
# within each write task (no extra shuffle), so Parquet min/max statistics
# let readers skip row groups on these columns.  A leading '-' sorts descending.
LOCAL_SORT = {
    "fact_ratings": ["movie_id", "rating"],
    "decade_stats": ["decade", "-avg_rating"],
    "genre_trends": ["genre", "rating_year"],
}


def write_table(df: DataFrame, root: str, table: str, fmt: str = "parquet", typed: bool = True,
                max_records_per_file: int | None = None, incremental: bool = False, version: str | None = None,
                observe: Observation | None = None, metrics: Mapping[str, Column] | None = None) -> str:
    """Replace one table (S4, S5, S9, S12, O8); the fact is partitioned by year.

    The whole table is replaced, so years that are gone from the data are gone from the
    table.  ``incremental=True`` replaces only the years in ``df`` (dynamic overwrite).
    With ``version`` it is written beside earlier versions (``plans.versions``).
    ``metrics`` are collected by ``observe`` from the rows that are written, without a scan.

    A partitioned table is laid out by Spark's rebalancing on its partition columns: a year with much data is split over several tasks, small ones
    share one, and files follow the data's size rather than tasks times years.
    """
    path = os.path.join(root, table, f"v={version}") if version else os.path.join(root, table)
    out = sink_projection(df, table) if typed else df
    parts = PARTITIONING.get(table, [])
    if parts:
        out = out.hint("rebalance", *[F.col(c) for c in parts])
    if table in LOCAL_SORT:
        keys = [F.col(k[1:]).desc() if k.startswith("-") else F.col(k) for k in LOCAL_SORT[table]
                if k.lstrip("-") in out.columns]
        out = out.sortWithinPartitions(*parts, *keys)
    if observe is not None:
        out = out.observe(observe, *[c.alias(name) for name, c in metrics.items()])
    w = out.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic" if incremental else "static")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if parts:
        w = w.partitionBy(*parts)
    w.save(path)
    return path


#: Checked against [0, 1] while the table is written.
BOUNDED = {"tag_similarity": "similarity"}
#: Tables whose rows may grow with the square of the input's.
PAIR_TABLES = ("tag_similarity",)
#: Columns of the NULL check while the table is written.
NULL_KEYS = {"dim_movies": ["movie_id"], "dim_users": ["user_id"], "fact_ratings": ["movie_id", "user_id", "rating"]}


def write_star(tables: Mapping[str, DataFrame], root: str, fmt: str = "parquet", version: str | None = None,
               metrics: dict[str, dict] | None = None, max_records_per_file: int | None = None) -> dict[str, str]:
    """Write every table; returns table -> path.  ``metrics`` receives what the writes observed."""
    paths = {}
    for name in tables:
        watch = Observation(name) if metrics is not None else None
        wanted = qc.write_metrics(WAREHOUSE_NOT_NULL[name], WAREHOUSE_MAX_LENGTHS.get(name, {}), NULL_KEYS.get(name, ()),
                                  BOUNDED.get(name)) if watch else None
        paths[name] = write_table(tables[name], root, name, fmt, version=version, observe=watch, metrics=wanted,
                                  max_records_per_file=max_records_per_file)
        if watch:
            metrics[name] = watch.get
    return paths


def publish(spark, staged: Mapping[str, str], sink: Callable[[DataFrame, str], None]) -> None:
    """Copy staged tables (Parquet paths) into a sink such as JDBC.

    ``sink(df, table)`` receives the typed projection, e.g.
    ``lambda df, t: jdbc.write_jdbc(df, url, t, mode="overwrite")``.
    """
    for table, path in staged.items():
        sink(sink_projection(spark.read.parquet(path), table), table)


def bucketed(spark, df: DataFrame, name: str, path: str, key: str, buckets: int | None = None) -> DataFrame:
    """``df`` as a catalog table at ``path``, bucketed and sorted by ``key``.

    Tables with the same number of buckets join and group on the key without an exchange.  The default number is that
    of shuffle partitions; take one so that a bucket of the largest table fits a task.
    """
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(n, key).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(n, key).sortBy(key).saveAsTable(name))
    return spark.table(name)


def movie_report(fact: DataFrame, movies: DataFrame) -> DataFrame:
    """Ratings, mean and last day of every rated movie of the dimension."""
    stats = fact.groupBy("movie_id").agg(F.count(F.lit(1)).alias("ratings"), F.avg("rating").alias("mean_rating"),
                                         F.max("rating_date").alias("last_rated"))
    return stats.join(movies.select("movie_id", "clean_title"), "movie_id").select(
        "movie_id", "clean_title", "ratings", "mean_rating", "last_rated")


def ensure_table(spark, name: str, path: str, schema: StructType, defaults: Mapping[str, str] | None = None) -> None:
    """Idempotent CREATE TABLE IF NOT EXISTS plus additive columns.

    ``defaults`` (column -> SQL literal) are what rows read as that were written before the column was added,
    and what an insert without the column writes; without one they read as NULL.
    """
    ddl = lambda fields, given: ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" + (f" DEFAULT {given[f.name]}" if f.name in given else "") for f in fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(schema, {})}) USING parquet LOCATION '{path}'")
    have = {f.name for f in spark.table(name).schema}
    extra = [f for f in schema if f.name not in have]
    if extra:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({ddl(extra, defaults or {})})")


def ensure_schema(spark, root: str, prefix: str = "") -> list[str]:
    """All eight tables (star and audit) with their declared types; returns their names."""
    names = [*WAREHOUSE_DDL, *AUDIT_SCHEMAS]
    for t in names:
        ensure_table(spark, prefix + t, os.path.join(root, t), table_schema(t))
    return [prefix + t for t in names]
