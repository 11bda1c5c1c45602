"""Schema contracts as data.

Raw inputs are declared, never inferred.  Nullability is not enforced by
file sources, so required columns are listed separately and checked by the
quality operators.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    FloatType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)


@dataclass(frozen=True)
class Contract:
    name: str
    schema: StructType
    required: tuple[str, ...]
    keys: tuple[str, ...] = ()
    max_lengths: dict[str, int] = field(default_factory=dict)


def _s(*cols) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


RATINGS = Contract(
    "ratings",
    _s(("userId", IntegerType()), ("movieId", IntegerType()),
       ("rating", FloatType()), ("timestamp", LongType())),
    required=("userId", "movieId", "rating", "timestamp"),
    keys=("userId", "movieId"),
)
MOVIES = Contract(
    "movies",
    _s(("movieId", IntegerType()), ("title", StringType()), ("genres", StringType())),
    required=("movieId", "title"),
    keys=("movieId",),
)
TAGS = Contract(
    "tags",
    _s(("userId", IntegerType()), ("movieId", IntegerType()),
       ("tag", StringType()), ("timestamp", LongType())),
    required=("userId", "movieId", "tag"),
    keys=("userId", "movieId", "tag"),
)
GENOME_SCORES = Contract(
    "genome_scores",
    _s(("movieId", IntegerType()), ("tagId", IntegerType()), ("relevance", FloatType())),
    required=("movieId", "tagId", "relevance"),
    keys=("movieId", "tagId"),
)
GENOME_TAGS = Contract(
    "genome_tags",
    _s(("tagId", IntegerType()), ("tag", StringType())),
    required=("tagId", "tag"),
    keys=("tagId",),
)

INPUTS = {c.name: c for c in (RATINGS, MOVIES, TAGS, GENOME_SCORES, GENOME_TAGS)}
INPUT_FILES = {
    "ratings": "ratings.csv",
    "movies": "movies.csv",
    "tags": "tags.csv",
    "genome_scores": "genome-scores.csv",
    "genome_tags": "genome-tags.csv",
}

# Warehouse tables: primary keys and string length limits of the star schema.
WAREHOUSE_KEYS = {
    "dim_movies": ("movie_id",),
    "dim_users": ("user_id",),
    "fact_ratings": ("user_id", "movie_id"),
    "genre_trends": ("genre", "rating_year"),
    "decade_stats": ("movie_id",),
    "tag_similarity": ("movie_id_a", "movie_id_b"),
}
WAREHOUSE_NOT_NULL = {
    "dim_movies": ("movie_id", "title"),
    "dim_users": ("user_id",),
    "fact_ratings": ("user_id", "movie_id", "rating", "rating_date", "rating_year"),
    "genre_trends": ("genre", "rating_year"),
    "decade_stats": ("movie_id",),
    "tag_similarity": ("movie_id_a", "movie_id_b"),
}
WAREHOUSE_MAX_LENGTHS = {
    "dim_movies": {"title": 500, "clean_title": 500},
    "genre_trends": {"genre": 100},
    "decade_stats": {"clean_title": 500},
}
# Sink types of the star schema, applied only in the sink projection.
WAREHOUSE_TYPES = {
    "dim_movies": {"movie_id": "int", "release_year": "smallint"},
    "dim_users": {"user_id": "int"},
    "fact_ratings": {
        "user_id": "int", "movie_id": "int", "rating": "decimal(3,1)",
        "rating_year": "smallint", "cumulative_rating_count": "int",
        "cumulative_avg_rating": "decimal(4,2)", "rolling_30d_avg": "decimal(4,2)",
        "rolling_30d_count": "int",
    },
    "genre_trends": {"rating_year": "smallint", "avg_rating": "decimal(4,2)",
                     "rating_count": "int"},
    "decade_stats": {"movie_id": "int", "decade": "smallint",
                     "avg_rating": "decimal(4,2)", "total_ratings": "int"},
    "tag_similarity": {"movie_id_a": "int", "movie_id_b": "int",
                       "similarity": "decimal(6,4)"},
}
WAREHOUSE_TABLES = tuple(WAREHOUSE_KEYS)

# Full column lists of the star schema (fixed names and types), in table order.
WAREHOUSE_DDL = {
    "dim_movies": "movie_id INT, title STRING, clean_title STRING, genres STRING, release_year SMALLINT, created_at TIMESTAMP",
    "dim_users": "user_id INT, created_at TIMESTAMP",
    "fact_ratings": "user_id INT, movie_id INT, rating DECIMAL(3,1), rating_date DATE, rating_year SMALLINT, "
                    "cumulative_rating_count INT, cumulative_avg_rating DECIMAL(4,2), rolling_30d_avg DECIMAL(4,2), "
                    "rolling_30d_count INT",
    "genre_trends": "genre STRING, rating_year SMALLINT, avg_rating DECIMAL(4,2), rating_count INT",
    "decade_stats": "movie_id INT, clean_title STRING, decade SMALLINT, avg_rating DECIMAL(4,2), total_ratings INT",
    "tag_similarity": "movie_id_a INT, movie_id_b INT, similarity DECIMAL(6,4)",
}
# Audit tables: columns, keys, NOT NULL columns and string length limits.
AUDIT_SCHEMAS = {
    "pipeline_run_log": _s(("run_id", LongType()), ("run_date", TimestampType()), ("dataset_hash", StringType()),
                           ("status", StringType()), ("rows_loaded", LongType()), ("duration_secs", LongType()),
                           ("source_url", StringType()), ("pipeline_version", StringType())),
    "pipeline_table_stats": _s(("run_id", LongType()), ("table_name", StringType()), ("row_count", LongType())),
}
AUDIT_KEYS = {"pipeline_run_log": ("run_id",), "pipeline_table_stats": ("run_id", "table_name")}
AUDIT_NOT_NULL = {"pipeline_run_log": ("run_id",), "pipeline_table_stats": ("run_id", "table_name", "row_count")}
AUDIT_MAX_LENGTHS = {
    "pipeline_run_log": {"dataset_hash": 64, "status": 20, "source_url": 500, "pipeline_version": 40},
    "pipeline_table_stats": {"table_name": 100},
}


def table_schema(table: str) -> StructType:
    """Declared schema of any of the eight tables."""
    return AUDIT_SCHEMAS[table] if table in AUDIT_SCHEMAS else StructType.fromDDL(WAREHOUSE_DDL[table])
