"""Registered queries over the driver tables, each paired with its DuckDB oracle.

Thresholds are scaled to the driver data (at most a few dozen ratings per
item at sf0.01): minimum counts 20 instead of 100/500, cosine threshold 0.70
on absolute embedding values.  Every query reads whole tables.
"""

from __future__ import annotations

import dataclasses
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ratingsmith.functions import epoch_to_date
from ratingsmith.operators import aggregates as agg
from ratingsmith.operators import clean
from ratingsmith.operators import metrics as met
from ratingsmith.operators import quality as qc
from ratingsmith.operators import runlog as rl
from ratingsmith.operators import similarity as sim
from ratingsmith.operators import nearest, sparse_similarity as sparse
from ratingsmith.operators import windows as win
from ratingsmith.plans import oracle_sql as q
from ratingsmith.plans import refresh
from ratingsmith.plans import staging
from ratingsmith.plans import versions
from ratingsmith.plans import warehouse as wh
from ratingsmith.plans.oracle_sql import R, with_
from ratingsmith.session import workspace
from ratingsmith.sources import adapters
from ratingsmith.sources import csv as csv_src
from ratingsmith.sources.contracts import (
    INPUTS, WAREHOUSE_DDL, WAREHOUSE_KEYS, WAREHOUSE_MAX_LENGTHS, WAREHOUSE_NOT_NULL, WAREHOUSE_TABLES,
)

# Parameters for the driver data.
MIN_COUNT = 20
SIM_THRESHOLD = 0.70
TOP_N_ITEMS = 500
TOP_TITLES = 10
TOP_PER_DECADE = 5
NEIGHBOURS = 10

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---- shared building blocks -------------------------------------------------

def clean_ratings_df(spark, sf_dir) -> DataFrame:
    return clean.clean_ratings(adapters.ratings(spark, sf_dir))


def clean_items_df(spark, sf_dir) -> DataFrame:
    return clean.clean_items(adapters.movies(spark, sf_dir))


INPUT_TABLES = ["lineitem", "orders", "part", "events", "embeddings"]


def staged_ratings(spark, sf_dir) -> DataFrame:
    """The cleaned ratings, written once for all queries that window, join or check them."""
    key = staging.input_key(spark, sf_dir, ["lineitem", "orders"])
    return staging.staged(spark, "clean_ratings", key, lambda: clean_ratings_df(spark, sf_dir))


def staged_items(spark, sf_dir) -> DataFrame:
    key = staging.input_key(spark, sf_dir, ["part"])
    return staging.staged(spark, "clean_items", key, lambda: clean_items_df(spark, sf_dir))


def staged_base(spark, sf_dir) -> DataFrame:
    """The cleaned ratings of known items, written once for a query that reads them many times."""
    key = staging.input_key(spark, sf_dir, ["lineitem", "orders", "part"])
    return staging.staged(spark, "fact_base", key, lambda: wh.fact_base(staged_ratings(spark, sf_dir), staged_items(spark, sf_dir)))


# ---- cleaning -----------------------------------------------------------------

@register("clean_ratings", with_(q.RATINGS_CTES, "SELECT * FROM clean_ratings"))
def clean_ratings_q(spark, sf_dir):
    return clean_ratings_df(spark, sf_dir)


@register("clean_items", with_(q.ITEM_CTES, "SELECT * FROM clean_items"))
def clean_items_q(spark, sf_dir):
    return clean_items_df(spark, sf_dir)


@register("clean_tags", with_([q.RAW_TAGS, q.CLEAN_TAGS], "SELECT * FROM clean_tags"))
def clean_tags_q(spark, sf_dir):
    return clean.clean_tags(adapters.tags(spark, sf_dir))


# ---- windows ------------------------------------------------------------------

ORDER = ["rating_date", "timestamp", "userId"]


@register("running_stats", with_(q.RATINGS_CTES,
          f"SELECT *, {q.RUNNING_COLS} FROM clean_ratings {q.WINDOWS}"))
def running_stats_q(spark, sf_dir):
    return win.running_stats(staged_ratings(spark, sf_dir), ["movieId"], ORDER, "rating")


# About half of the driver data's items have more ratings than this.
SPLIT_ABOVE = 26


@register("running_stats_split", with_(q.RATINGS_CTES,
          f"SELECT *, {q.RUNNING_COLS} FROM clean_ratings {q.WINDOWS}"))
def running_stats_split_q(spark, sf_dir):
    return win.running_stats(staged_ratings(spark, sf_dir), ["movieId"], ORDER, "rating", hot_rows=SPLIT_ABOVE)


@register("rolling_30d_stats", with_(q.RATINGS_CTES,
          f"SELECT *, {q.ROLLING_COLS} FROM clean_ratings {q.WINDOWS}"))
def rolling_q(spark, sf_dir):
    return win.rolling_stats(staged_ratings(spark, sf_dir), ["movieId"], "rating_date",
                             "rating", days=30)


# ---- aggregates -----------------------------------------------------------------

@register("genre_trends", with_(q.RATINGS_CTES + q.ITEM_CTES, f"""
SELECT g.genre, cr.rating_year, {R("avg(cr.rating)", 2)} AS avg_rating,
       count(cr.rating) AS rating_count
FROM clean_ratings cr
JOIN (SELECT movieId, unnest(genre_array) AS genre FROM clean_items) g ON cr.movieId = g.movieId
GROUP BY g.genre, cr.rating_year"""))
def genre_trends_q(spark, sf_dir):
    return agg.group_trends(clean_ratings_df(spark, sf_dir), clean_items_df(spark, sf_dir))


DECADE_SQL = f"""decade_stats AS (
  SELECT cr.movieId AS movie_id, ci.clean_title,
         CAST(floor(ci.release_year / 10) * 10 AS INTEGER) AS decade,
         {R("avg(cr.rating)", 2)} AS avg_rating, count(cr.rating) AS total_ratings
  FROM clean_ratings cr JOIN clean_items ci ON cr.movieId = ci.movieId
  GROUP BY cr.movieId, ci.clean_title, ci.release_year
  HAVING count(cr.rating) >= {MIN_COUNT})"""


@register("decade_stats", with_(q.RATINGS_CTES + q.ITEM_CTES + [DECADE_SQL],
                                "SELECT * FROM decade_stats"))
def decade_stats_q(spark, sf_dir):
    return agg.bucket_stats(clean_ratings_df(spark, sf_dir), clean_items_df(spark, sf_dir),
                            min_count=MIN_COUNT)


# ---- star schema ------------------------------------------------------------------



def fact_df(spark, sf_dir) -> DataFrame:
    return wh.fact_ratings(staged_ratings(spark, sf_dir), staged_items(spark, sf_dir))


def dim_movies_df(spark, sf_dir) -> DataFrame:
    return wh.dim_movies(clean_items_df(spark, sf_dir))


def fact_base_df(spark, sf_dir) -> DataFrame:
    base = wh.fact_base(staged_ratings(spark, sf_dir), staged_items(spark, sf_dir))
    return base.select(F.col("userId").alias("user_id"), F.col("movieId").alias("movie_id"),
                       "rating", "rating_date", "rating_year")


@register("dim_movies", with_(q.WAREHOUSE_CTES, "SELECT * FROM dim_movies"))
def dim_movies_q(spark, sf_dir):
    return dim_movies_df(spark, sf_dir)


@register("dim_users", with_(q.WAREHOUSE_CTES, "SELECT * FROM dim_users"))
def dim_users_q(spark, sf_dir):
    return wh.dim_users(clean_ratings_df(spark, sf_dir))


@register("fact_ratings", with_(q.WAREHOUSE_CTES, "SELECT * FROM fact"))
def fact_ratings_q(spark, sf_dir):
    return fact_df(spark, sf_dir)


# ---- top-k reports ------------------------------------------------------------------

TOP_ITEMS_SQL = f"""top_items AS (
  SELECT movieId AS movie_id, count(*) AS rating_count FROM fact_base
  GROUP BY movieId ORDER BY rating_count DESC, movie_id LIMIT {TOP_N_ITEMS})"""


@register("top_n_items", with_(q.WAREHOUSE_CTES + [TOP_ITEMS_SQL], "SELECT * FROM top_items"))
def top_n_items_q(spark, sf_dir):
    return agg.top_n_by_count(fact_base_df(spark, sf_dir), "movie_id", TOP_N_ITEMS)


@register("top_rated", with_(q.WAREHOUSE_CTES, f"""
SELECT f.movieId AS movie_id, ci.clean_title, {R("avg(f.rating)", 2)} AS avg_rating,
       count(*) AS total_ratings
FROM fact_base f JOIN clean_items ci ON f.movieId = ci.movieId
GROUP BY f.movieId, ci.clean_title HAVING count(*) >= {MIN_COUNT}
ORDER BY avg_rating DESC, total_ratings DESC, movie_id LIMIT {TOP_TITLES}"""))
def top_rated_q(spark, sf_dir):
    return agg.top_rated(fact_base_df(spark, sf_dir), dim_movies_df(spark, sf_dir),
                         min_count=MIN_COUNT, n=TOP_TITLES)


@register("top_k_per_decade", with_(q.RATINGS_CTES + q.ITEM_CTES + [DECADE_SQL], f"""
SELECT * FROM (
  SELECT decade, movie_id, clean_title, avg_rating, total_ratings,
         CAST(row_number() OVER (PARTITION BY decade
              ORDER BY avg_rating DESC, total_ratings DESC, movie_id) AS INTEGER) AS rank
  FROM decade_stats WHERE decade IS NOT NULL) WHERE rank <= {TOP_PER_DECADE}"""))
def top_k_per_decade_q(spark, sf_dir):
    ds = agg.bucket_stats(clean_ratings_df(spark, sf_dir), clean_items_df(spark, sf_dir),
                          min_count=MIN_COUNT, sort=False)
    return win.top_k_per_group(
        ds.filter("decade IS NOT NULL"), ["decade"], [F.col("avg_rating").desc(), F.col("total_ratings").desc(),
                         F.col("movie_id")], TOP_PER_DECADE).select(
        "decade", "movie_id", "clean_title", "avg_rating", "total_ratings", "rank")


# ---- similarity ------------------------------------------------------------------

def cosine_sql(source: str) -> str:
    return f"""
norms AS (SELECT movieId, sqrt(sum(relevance * relevance)) AS norm FROM {source} GROUP BY movieId),
dots AS (SELECT a.movieId AS ia, b.movieId AS ib, sum(a.relevance * b.relevance) AS dot
         FROM {source} a JOIN {source} b ON a.tagId = b.tagId AND a.movieId < b.movieId
         GROUP BY a.movieId, b.movieId),
sims AS (SELECT ia AS movie_id_a, ib AS movie_id_b,
                {R("dot / (na.norm * nb.norm)", 4)} AS similarity
         FROM dots JOIN norms na ON na.movieId = ia JOIN norms nb ON nb.movieId = ib)"""


SIM_ALL = "WITH " + q.GENOME + "," + cosine_sql("genome")
SIM_ALL_BODY = f"SELECT * FROM sims WHERE similarity > {SIM_THRESHOLD}"


def vectors_df(spark, sf_dir) -> DataFrame:
    return adapters.genome_scores(spark, sf_dir)


def tag_similarity_df(spark, sf_dir) -> DataFrame:
    return sim.cosine_pairs(vectors_df(spark, sf_dir), threshold=SIM_THRESHOLD, sort=False)


@register("tag_similarity", SIM_ALL + "\n" + SIM_ALL_BODY)
def tag_similarity_q(spark, sf_dir):
    return sim.cosine_pairs(vectors_df(spark, sf_dir), threshold=SIM_THRESHOLD)


@register("tag_similarity_shared_norms", SIM_ALL.replace(
    "norms AS (SELECT movieId, sqrt(sum(relevance * relevance)) AS norm FROM genome GROUP BY movieId),", "")
    .replace("sum(a.relevance * b.relevance) AS dot",
             "sum(a.relevance * b.relevance) AS dot, sqrt(sum(a.relevance * a.relevance)) AS na, "
             "sqrt(sum(b.relevance * b.relevance)) AS nb")
    .replace(f'{R("dot / (na.norm * nb.norm)", 4)} AS similarity', f'{R("dot / (na * nb)", 4)} AS similarity')
    .replace("FROM dots JOIN norms na ON na.movieId = ia JOIN norms nb ON nb.movieId = ib", "FROM dots")
    + "\n" + SIM_ALL_BODY)
def tag_similarity_shared_q(spark, sf_dir):
    return sim.cosine_pairs(vectors_df(spark, sf_dir), threshold=SIM_THRESHOLD, norms="shared")


@register("tag_similarity_top_n", with_(q.WAREHOUSE_CTES + [TOP_ITEMS_SQL, q.GENOME,
          "top_genome AS (SELECT * FROM genome WHERE movieId IN (SELECT movie_id FROM top_items))",
          cosine_sql("top_genome").strip().rstrip(",")], SIM_ALL_BODY))
def tag_similarity_top_n_q(spark, sf_dir):
    top = agg.top_n_by_count(fact_base_df(spark, sf_dir), "movie_id", TOP_N_ITEMS).select(
        F.col("movie_id").alias("movieId"))
    vecs = sim.restrict_to(vectors_df(spark, sf_dir), top, "movieId", bound=TOP_N_ITEMS)
    return sim.cosine_pairs(vecs, threshold=SIM_THRESHOLD)


# Entries of the embeddings below this are left out, which leaves a few keys of each item.
SPARSE_ABOVE = 0.2


@register("sparse_similarity", with_([q.GENOME, f"sparse_genome AS (SELECT * FROM genome WHERE relevance >= {SPARSE_ABOVE})",
                                      cosine_sql("sparse_genome").strip().rstrip(",")], SIM_ALL_BODY))
def sparse_similarity_q(spark, sf_dir):
    vectors = vectors_df(spark, sf_dir).filter(F.col("relevance") >= SPARSE_ABOVE)
    return sparse.cosine_join(vectors, threshold=SIM_THRESHOLD).pairs


NEIGHBOURS_SQL = SIM_ALL + ",\n" + q.RAW_MOVIES + ",\n" + q.CLEAN_ITEMS + f"""
SELECT item AS movie_id, neighbour AS neighbour_id, ci.clean_title AS neighbour_title,
       similarity, rank
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY similarity DESC, neighbour)
                     AS INTEGER) AS rank
      FROM (SELECT movie_id_a AS item, movie_id_b AS neighbour, similarity FROM sims
            WHERE similarity > {SIM_THRESHOLD}
            UNION ALL
            SELECT movie_id_b, movie_id_a, similarity FROM sims WHERE similarity > {SIM_THRESHOLD}))
LEFT JOIN clean_items ci ON ci.movieId = neighbour
WHERE rank <= {NEIGHBOURS}"""


@register("neighbours", NEIGHBOURS_SQL)
def neighbours_q(spark, sf_dir):
    pairs = sim.cosine_pairs(vectors_df(spark, sf_dir), threshold=SIM_THRESHOLD, sort=False, top_k=NEIGHBOURS)
    return sim.neighbours(pairs, dim_movies_df(spark, sf_dir), k=NEIGHBOURS)


@register("neighbours_by_floors", NEIGHBOURS_SQL)
def neighbours_by_floors_q(spark, sf_dir):
    top = nearest.top_k(vectors_df(spark, sf_dir), NEIGHBOURS, threshold=SIM_THRESHOLD).top
    names = dim_movies_df(spark, sf_dir).select(F.col("movie_id").alias("neighbour"), F.col("clean_title").alias("neighbour_title"))
    return top.join(names, "neighbour", "left").select(
        F.col("item").alias("movie_id"), F.col("neighbour").alias("neighbour_id"), "neighbour_title", "similarity", "rank")


EXPLAINING_TAGS = 3
_PAIRS_SQL = f"""best AS (SELECT DISTINCT least(item, neighbour) AS movie_id_a, greatest(item, neighbour) AS movie_id_b
  FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY similarity DESC, neighbour) AS rank
        FROM (SELECT movie_id_a AS item, movie_id_b AS neighbour, similarity FROM sims WHERE similarity > {SIM_THRESHOLD}
              UNION ALL SELECT movie_id_b, movie_id_a, similarity FROM sims WHERE similarity > {SIM_THRESHOLD}))
  WHERE rank = 1)"""


@register("neighbour_tags", SIM_ALL + ",\n" + _PAIRS_SQL + f"""
SELECT movie_id_a, movie_id_b, tagId, 'tag_' || tagId AS tag, contribution, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY movie_id_a, movie_id_b ORDER BY contribution DESC, tagId) AS rank
      FROM (SELECT movie_id_a, movie_id_b, x.tagId, x.relevance * y.relevance AS contribution
            FROM best JOIN genome x ON x.movieId = movie_id_a JOIN genome y ON y.movieId = movie_id_b AND y.tagId = x.tagId))
WHERE rank <= {EXPLAINING_TAGS}""")
def neighbour_tags_q(spark, sf_dir):
    """Why each item and its nearest neighbour are similar: the tags that contribute most."""
    best = neighbours_q(spark, sf_dir).filter("rank = 1").select(
        F.least("movie_id", "neighbour_id").alias("movie_id_a"), F.greatest("movie_id", "neighbour_id").alias("movie_id_b"))
    return sim.explain_pairs(best.distinct(), vectors_df(spark, sf_dir), adapters.load_inputs(spark, sf_dir).genome_tags,
                             EXPLAINING_TAGS)


# ---- quality checks -----------------------------------------------------------------

STAR_PARAMS = wh.StarParams(min_count=MIN_COUNT, sim_threshold=SIM_THRESHOLD, sim_top_n=None)


def star(spark, sf_dir):
    """The six star tables, written once and read by every check over them; pairs of items are never written, a check
    takes them as they are found."""
    tables = wh.star_tables(staged_ratings(spark, sf_dir), staged_items(spark, sf_dir),
                            vectors_df(spark, sf_dir), STAR_PARAMS)
    key = staging.input_key(spark, sf_dir, INPUT_TABLES)
    staged = {t: (lambda t=t: staging.staged(spark, f"star_{t}", key, lambda: tables[t])) for t in tables}
    return wh.LazyTables(staged | {t: (lambda t=t: tables[t]) for t in wh.PAIR_TABLES})


GENRE_TRENDS_SQL = f"""genre_trends AS (
  SELECT g.genre, cr.rating_year, {R("avg(cr.rating)", 2)} AS avg_rating,
         count(cr.rating) AS rating_count
  FROM clean_ratings cr
  JOIN (SELECT movieId, unnest(genre_array) AS genre FROM clean_items) g ON cr.movieId = g.movieId
  GROUP BY g.genre, cr.rating_year)"""
STAR_CTES = q.WAREHOUSE_CTES + [
    "fact_ratings AS (SELECT * FROM fact)", GENRE_TRENDS_SQL, DECADE_SQL, q.GENOME,
    cosine_sql("genome").strip().rstrip(","),
    f"tag_similarity AS (SELECT * FROM sims WHERE similarity > {SIM_THRESHOLD})"]
COUNTS_SQL = "counts AS (" + "\n  UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in WAREHOUSE_TABLES) + ")"


def D(x) -> str:
    return f"CAST({x} AS DOUBLE)"


def check_sql(check, table, observed, threshold, passed, severity, source) -> str:
    return (f"SELECT '{check}' AS check_name, '{table}' AS table_name, {D(observed)} AS observed, "
            f"{D(threshold)} AS threshold, {passed} AS passed, '{severity}' AS severity "
            f"FROM {source}")


def union_sql(parts) -> str:
    return "\nUNION ALL\n".join(parts)


@register("row_counts", with_(STAR_CTES + [COUNTS_SQL], "SELECT * FROM counts"))
def row_counts_q(spark, sf_dir):
    return qc.row_counts(star(spark, sf_dir))


NULL_COLS = {"dim_movies": ["movie_id"], "dim_users": ["user_id"],
             "fact_ratings": ["movie_id", "user_id", "rating"]}


@register("null_check", with_(STAR_CTES, union_sql([
    check_sql("null_keys", t, f"count_if({' OR '.join(c + ' IS NULL' for c in cols)})", 0,
              f"count_if({' OR '.join(c + ' IS NULL' for c in cols)}) = 0", "error", t)
    for t, cols in NULL_COLS.items()])))
def null_check_q(spark, sf_dir):
    s = star(spark, sf_dir)
    return qc.union_all([qc.null_keys(s[t], t, cols) for t, cols in NULL_COLS.items()])


ORPHAN_KEYS = {"movie_id": "dim_movies", "user_id": "dim_users"}


@register("orphan_check", with_(STAR_CTES, union_sql([
    check_sql(f"orphan_{k}", "fact_ratings", "count(*)", 0, "count(*) = 0", "error",
              f"fact_ratings f WHERE NOT EXISTS (SELECT 1 FROM {d} x WHERE x.{k} = f.{k})")
    for k, d in ORPHAN_KEYS.items()])))
def orphan_check_q(spark, sf_dir):
    s = star(spark, sf_dir)
    return qc.union_all([qc.orphans(s["fact_ratings"], s[d], k, "fact_ratings")
                         for k, d in ORPHAN_KEYS.items()])


_RANGE_OK = ("(count(*) > 0 AND min(similarity) >= 0 AND max(similarity) <= 1) "
             "IS NOT DISTINCT FROM TRUE")


@register("range_check", with_(STAR_CTES, union_sql([
    check_sql("similarity_min", "tag_similarity", "min(similarity)", 0, _RANGE_OK, "error",
              "tag_similarity"),
    check_sql("similarity_max", "tag_similarity", "max(similarity)", 1, _RANGE_OK, "error",
              "tag_similarity")])))
def range_check_q(spark, sf_dir):
    return qc.value_range(star(spark, sf_dir)["tag_similarity"], "similarity", 0.0, 1.0,
                          "tag_similarity")


@register("pk_check", with_(STAR_CTES, union_sql([
    check_sql("duplicate_keys", t, "count(*)", 0, "count(*) = 0", "error",
              f"(SELECT {', '.join(k)} FROM {t} GROUP BY {', '.join(k)} HAVING count(*) > 1)")
    for t, k in WAREHOUSE_KEYS.items()])))
def pk_check_q(spark, sf_dir):
    s = star(spark, sf_dir)
    return qc.union_all([qc.duplicate_keys(s[t], k, t, hashed=t in wh.PAIR_TABLES) for t, k in WAREHOUSE_KEYS.items()])


def _contract_cond(t):
    bad = [f"{c} IS NULL" for c in WAREHOUSE_NOT_NULL[t]] + \
          [f"length({c}) > {n}" for c, n in WAREHOUSE_MAX_LENGTHS.get(t, {}).items()]
    return "coalesce(" + " OR ".join(bad) + ", false)"


@register("contract_check", with_(STAR_CTES, union_sql([
    check_sql("contract", t, f"count_if({_contract_cond(t)})", 0,
              f"count_if({_contract_cond(t)}) = 0", "error", t) for t in WAREHOUSE_TABLES])))
def contract_check_q(spark, sf_dir):
    s = star(spark, sf_dir)
    return qc.union_all([qc.contract_violations(s[t], t, WAREHOUSE_NOT_NULL[t],
                                                WAREHOUSE_MAX_LENGTHS.get(t, {}))
                         for t in WAREHOUSE_TABLES])


ROW_FLOOR = 0.90


@register("row_floor", with_(STAR_CTES + [COUNTS_SQL], union_sql([
    check_sql("non_empty", "x", "row_count", 1, "row_count >= 1", "warning", "counts")
    .replace("'x' AS table_name", "table_name"),
    check_sql("row_floor", "fact_ratings", "(SELECT count(*) FROM fact_ratings)",
              f"floor(CAST({ROW_FLOOR} AS DOUBLE) * (SELECT count(*) FROM raw_ratings))",
              f"(SELECT count(*) FROM fact_ratings) >= floor(CAST({ROW_FLOOR} AS DOUBLE) * "
              "(SELECT count(*) FROM raw_ratings))", "warning", "(SELECT 1)")])))
def row_floor_q(spark, sf_dir):
    s = star(spark, sf_dir)
    return qc.non_empty(qc.row_counts(s)).unionByName(
        qc.row_floor(s["fact_ratings"], adapters.ratings(spark, sf_dir), "fact_ratings", ROW_FLOOR))


INPUT_MIN_ROWS = {"ratings": 1, "movies": 1, "tags": 1, "genome_scores": 1, "genome_tags": 1}
INPUT_COUNTS_SQL = """input_counts AS (
  SELECT 'ratings' AS table_name, count(*) AS row_count FROM raw_ratings
  UNION ALL SELECT 'movies', count(*) FROM raw_movies
  UNION ALL SELECT 'tags', count(*) FROM raw_tags
  UNION ALL SELECT 'genome_scores', count(*) FROM genome
  UNION ALL SELECT 'genome_tags', CAST(max(len(embedding)) AS BIGINT) FROM embeddings)"""


@register("input_check", with_(q.RATINGS_CTES + q.ITEM_CTES + [q.RAW_TAGS, q.GENOME,
                               INPUT_COUNTS_SQL], union_sql([
    check_sql("min_rows", t, f"coalesce((SELECT row_count FROM input_counts WHERE table_name = '{t}'), 0)",
              n, f"coalesce((SELECT row_count FROM input_counts WHERE table_name = '{t}'), 0) >= {n}",
              "error", "(SELECT 1)") for t, n in INPUT_MIN_ROWS.items()])))
def input_check_q(spark, sf_dir):
    counts = qc.row_counts(adapters.load_inputs(spark, sf_dir).as_dict())
    return qc.min_rows(counts, INPUT_MIN_ROWS)


# ---- run log ---------------------------------------------------------------------

RUN_LOG_SQL = """run_log AS (
  SELECT o_orderkey AS run_id, o_orderdate AS run_date,
         CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'skipped' ELSE 'failed' END AS status,
         o_custkey AS rows_loaded, CAST(floor(o_totalprice) AS BIGINT) % 5400 AS duration_secs
  FROM orders)"""
TABLE_STATS_SQL = ("table_stats AS (SELECT r.run_id, t.table_name, "
                   "CAST(r.run_id * 10 + length(t.table_name) AS BIGINT) AS row_count "
                   "FROM run_log r CROSS JOIN (VALUES " +
                   ", ".join(f"('{t}')" for t in WAREHOUSE_TABLES) + ") t(table_name))")
LAST_SUCCESS_SQL = ("(SELECT run_id FROM run_log WHERE status = 'success' "
                    "ORDER BY run_date DESC, run_id DESC LIMIT 1)")


def run_log_df(spark, sf_dir):
    return adapters.run_log(spark, sf_dir)


def table_stats_df(spark, sf_dir):
    return adapters.table_stats(run_log_df(spark, sf_dir), WAREHOUSE_TABLES)


@register("run_history", with_([RUN_LOG_SQL], f"""
SELECT run_id, run_date, status, rows_loaded, {R("duration_secs / CAST(60 AS DOUBLE)", 1)} AS duration_mins
FROM run_log ORDER BY run_date DESC, run_id DESC LIMIT 10"""))
def run_history_q(spark, sf_dir):
    return rl.run_history(run_log_df(spark, sf_dir), 10)


@register("last_success_stats", with_([RUN_LOG_SQL, TABLE_STATS_SQL], f"""
SELECT table_name, row_count FROM table_stats WHERE run_id = {LAST_SUCCESS_SQL}"""))
def last_success_stats_q(spark, sf_dir):
    return rl.last_success_stats(run_log_df(spark, sf_dir), table_stats_df(spark, sf_dir))


@register("run_kpis", with_([RUN_LOG_SQL], f"""
SELECT max(CASE WHEN status = 'success' THEN run_date END) AS last_success_date,
       count(*) AS total_runs,
       {R("CAST(100 AS DOUBLE) * count_if(status = 'success') / count(*)", 2)} AS success_rate,
       (SELECT duration_secs FROM run_log ORDER BY run_date DESC, run_id DESC LIMIT 1) AS last_duration_secs,
       (SELECT status FROM run_log ORDER BY run_date DESC, run_id DESC LIMIT 1) AS last_status
FROM run_log"""))
def run_kpis_q(spark, sf_dir):
    return rl.run_kpis(run_log_df(spark, sf_dir))


@register("last_run", with_([RUN_LOG_SQL],
          "SELECT * FROM run_log ORDER BY run_date DESC, run_id DESC LIMIT 1"))
def last_run_q(spark, sf_dir):
    return rl.last_run(run_log_df(spark, sf_dir))


@register("status_counts", with_([RUN_LOG_SQL],
          "SELECT status, count(*) AS runs FROM run_log GROUP BY status"))
def status_counts_q(spark, sf_dir):
    return rl.status_counts(run_log_df(spark, sf_dir))


@register("drift", with_(STAR_CTES + [COUNTS_SQL, RUN_LOG_SQL, TABLE_STATS_SQL], f"""
SELECT c.table_name, p.row_count AS previous, c.row_count AS current,
       {R("CASE WHEN p.row_count > 0 THEN abs(c.row_count - p.row_count) / CAST(p.row_count AS DOUBLE) END", 4)} AS pct_change,
       coalesce(CASE WHEN p.row_count > 0 THEN abs(c.row_count - p.row_count) / CAST(p.row_count AS DOUBLE) END >= 0.2, false) AS flagged
FROM counts c LEFT JOIN (SELECT table_name, row_count FROM table_stats
                         WHERE run_id = {LAST_SUCCESS_SQL}) p ON p.table_name = c.table_name"""))
def drift_q(spark, sf_dir):
    prev = rl.last_success_stats(run_log_df(spark, sf_dir), table_stats_df(spark, sf_dir))
    return qc.drift(qc.row_counts(star(spark, sf_dir)), prev, 0.20)


# ---- dashboard metrics ---------------------------------------------------------------

def items_mid(spark, sf_dir):
    return clean_items_df(spark, sf_dir).withColumnRenamed("movieId", "movie_id")


GENRE_YEAR_SQL = """gy AS (
  SELECT g.genre, f.rating_year, count(*) AS rating_count
  FROM fact_base f JOIN (SELECT movieId, unnest(genre_array) AS genre FROM clean_items) g
       ON f.movieId = g.movieId
  GROUP BY g.genre, f.rating_year)"""


@register("kpis", with_(q.WAREHOUSE_CTES, f"""
SELECT (SELECT count(*) FROM fact_base) AS total_ratings,
       (SELECT count(*) FROM clean_items) AS total_movies,
       (SELECT count(DISTINCT userId) FROM fact_base) AS unique_reviewers,
       (SELECT {R("avg(rating)", 2)} FROM fact_base) AS platform_avg_rating"""))
def kpis_q(spark, sf_dir):
    return met.kpis(fact_base_df(spark, sf_dir), dim_movies_df(spark, sf_dir))


@register("volume_by_year", with_(q.WAREHOUSE_CTES,
          "SELECT rating_year, count(*) AS rating_count FROM fact_base GROUP BY rating_year"))
def volume_by_year_q(spark, sf_dir):
    return met.volume_by(fact_base_df(spark, sf_dir), "rating_year")


@register("rating_distribution", with_(q.WAREHOUSE_CTES,
          "SELECT rating, count(*) AS rating_count FROM fact_base GROUP BY rating"))
def rating_distribution_q(spark, sf_dir):
    return met.volume_by(fact_base_df(spark, sf_dir), "rating")


@register("genre_summary", with_(q.WAREHOUSE_CTES, f"""
SELECT *, CAST(row_number() OVER (ORDER BY rating_count DESC, genre) AS INTEGER) AS volume_rank,
       CAST(row_number() OVER (ORDER BY avg_rating DESC, rating_count DESC, genre) AS INTEGER) AS rating_rank
FROM (SELECT g.genre, count(*) AS rating_count, {R("avg(f.rating)", 2)} AS avg_rating
      FROM fact_base f JOIN (SELECT movieId, unnest(genre_array) AS genre FROM clean_items) g
           ON f.movieId = g.movieId
      GROUP BY g.genre)"""))
def genre_summary_q(spark, sf_dir):
    return met.genre_summary(fact_base_df(spark, sf_dir), items_mid(spark, sf_dir))


@register("genre_growth", with_(q.WAREHOUSE_CTES + [GENRE_YEAR_SQL], f"""
SELECT genre, first_year, first_count, last_year, last_count,
       {R("(last_count - first_count) / CAST(first_count AS DOUBLE)", 4)} AS growth
FROM (SELECT genre, min(rating_year) AS first_year, arg_min(rating_count, rating_year) AS first_count,
             max(rating_year) AS last_year, arg_max(rating_count, rating_year) AS last_count
      FROM gy
      WHERE rating_year >= (SELECT CAST(floor(max(rating_year) / 10) * 10 AS INTEGER) FROM gy)
      GROUP BY genre)"""))
def genre_growth_q(spark, sf_dir):
    return met.genre_growth(fact_base_df(spark, sf_dir), items_mid(spark, sf_dir))


@register("genre_series", with_(q.WAREHOUSE_CTES + [GENRE_YEAR_SQL], """
SELECT * FROM gy WHERE genre IN (
  SELECT genre FROM (SELECT genre, sum(rating_count) AS n FROM gy GROUP BY genre
                     ORDER BY n DESC, genre LIMIT 3))"""))
def genre_series_q(spark, sf_dir):
    return met.genre_series(fact_base_df(spark, sf_dir), items_mid(spark, sf_dir), top=3)


@register("decade_summary", with_(q.WAREHOUSE_CTES, f"""
SELECT decade, count(*) AS movie_count, CAST(coalesce(sum(n), 0) AS BIGINT) AS total_ratings,
       {R("sum(s) / sum(n)", 2)} AS avg_rating
FROM (SELECT movieId, CAST(floor(release_year / 10) * 10 AS INTEGER) AS decade
      FROM clean_items WHERE release_year IS NOT NULL) d
LEFT JOIN (SELECT movieId, count(*) AS n, sum(rating) AS s FROM fact_base GROUP BY movieId) p
     USING (movieId)
GROUP BY decade"""))
def decade_summary_q(spark, sf_dir):
    return met.decade_summary(fact_base_df(spark, sf_dir), items_mid(spark, sf_dir))


# ---- change detection -------------------------------------------------------------------

def _digest_sql(cols) -> str:
    """The SQL form of ``runlog.row_digest``."""
    marks = " || ".join(f"coalesce('+' || length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in cols)
    return f"CAST(('0x' || substr(md5({marks}), 1, 15)) AS BIGINT)"


# Engines print small doubles differently, so relevance is compared in millionths.
GENOME_MICRO = """genome_micro AS (SELECT movieId, tagId, CAST(round(relevance * 1000000) AS BIGINT) AS relevance FROM genome)"""
GENOME_TAGS_SQL = """raw_genome_tags AS (SELECT tagId, 'tag_' || tagId AS tag FROM
  (SELECT unnest(range(max(len(embedding)))) AS tagId FROM embeddings))"""
FINGERPRINTED = {"ratings": ("raw_ratings", ("userId", "movieId", "rating", '"timestamp"')),
                 "movies": ("raw_movies", ("movieId", "title", "genres")),
                 "tags": ("raw_tags", ("userId", "movieId", "tag", '"timestamp"')),
                 "genome_scores": ("genome_micro", ("movieId", "tagId", "relevance")),
                 "genome_tags": ("raw_genome_tags", ("tagId", "tag"))}
FINGERPRINT_CTES = q.RATINGS_CTES + q.ITEM_CTES + [q.RAW_TAGS, q.GENOME, GENOME_MICRO, GENOME_TAGS_SQL]


def exact_inputs(spark, sf_dir) -> dict[str, DataFrame]:
    tables = adapters.load_inputs(spark, sf_dir).as_dict()
    micro = F.round(F.col("relevance") * 1_000_000).cast("bigint")
    return tables | {"genome_scores": tables["genome_scores"].withColumn("relevance", micro)}


@register("fingerprint", with_(FINGERPRINT_CTES, union_sql([
    f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST(sum({_digest_sql(cols)}) AS VARCHAR) AS fingerprint FROM {source}"
    for t, (source, cols) in FINGERPRINTED.items()])))
def fingerprint_q(spark, sf_dir):
    return rl.fingerprints(exact_inputs(spark, sf_dir))


def _earlier(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """A derived earlier snapshot: ratings lack some rows, a tag is spelt otherwise, a NULL moved between
    columns of movies, genome scores only lie in another order, genome tags hold one row twice."""
    r, m, t, g, n = (tables[k] for k in ("ratings", "movies", "tags", "genome_scores", "genome_tags"))
    moved = F.col("movieId") % 40 == 0
    return {"ratings": r.filter("userId % 7 <> 0"),
            "movies": m.withColumns({"title": F.when(moved, F.col("genres")).otherwise(F.col("title")),
                                     "genres": F.when(moved, F.col("title")).otherwise(F.col("genres"))}),
            "tags": t.withColumn("tag", F.regexp_replace("tag", "VIEW", "VIEWED")),
            "genome_scores": g.orderBy("relevance"),
            "genome_tags": n.unionByName(n.filter("tagId = 3"))}


_EARLIER_SQL = {
    "ratings": "SELECT * FROM raw_ratings WHERE userId % 7 <> 0",
    "movies": """SELECT movieId, CASE WHEN movieId % 40 = 0 THEN genres ELSE title END AS title,
                 CASE WHEN movieId % 40 = 0 THEN title ELSE genres END AS genres FROM raw_movies""",
    "tags": """SELECT userId, movieId, replace(tag, 'VIEW', 'VIEWED') AS tag, "timestamp" FROM raw_tags""",
    "genome_scores": "SELECT * FROM genome_micro",
    "genome_tags": "SELECT * FROM raw_genome_tags UNION ALL SELECT * FROM raw_genome_tags WHERE tagId = 3"}


@register("changed_tables", with_(FINGERPRINT_CTES, union_sql([
    f"""SELECT '{t}' AS table_name, EXISTS ((SELECT {', '.join(cols)} FROM {source}) EXCEPT ALL ({_EARLIER_SQL[t]}))
        OR EXISTS (({_EARLIER_SQL[t]}) EXCEPT ALL (SELECT {', '.join(cols)} FROM {source})) AS changed"""
    for t, (source, cols) in FINGERPRINTED.items()])))
def changed_tables_q(spark, sf_dir):
    tables = exact_inputs(spark, sf_dir)
    return rl.changed_tables(rl.fingerprints(tables), rl.fingerprints(_earlier(tables)))


# Metadata of one source for each customer: some lack the ETag, some the date, some all.
_SAVED_META = {"etag": "CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE c_name END",
               "last_modified": "CASE WHEN c_custkey % 5 < 2 THEN NULL ELSE c_mktsegment END",
               "content_length": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR(20)) END"}
_CURRENT_META = {"etag": "CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 6 = 0 THEN 'other' ELSE c_name END",
                 "last_modified": "CASE WHEN c_custkey % 2 = 0 THEN 'x' ELSE c_mktsegment END",
                 "content_length": "CAST(c_nationkey % 5 AS VARCHAR(20))"}


def _meta_sql(fields, where) -> str:
    return "SELECT c_custkey AS source, " + ", ".join(f"{e} AS {f}" for f, e in fields.items()) + f" FROM customer WHERE {where}"


@register("metadata_matches", f"""
WITH s AS ({_meta_sql(_SAVED_META, "c_custkey % 11 <> 0")}), c AS ({_meta_sql(_CURRENT_META, "c_custkey % 13 <> 0")})
SELECT coalesce(s.source, c.source) AS source,
       coalesce(CASE WHEN s.etag <> '' AND c.etag <> '' THEN s.etag = c.etag
                     WHEN s.last_modified IS NOT NULL AND c.last_modified IS NOT NULL THEN s.last_modified = c.last_modified
                     WHEN s.content_length IS NOT NULL AND c.content_length IS NOT NULL
                          THEN s.content_length = c.content_length END, FALSE) AS matches
FROM s FULL JOIN c ON s.source = c.source""")
def metadata_matches_q(spark, sf_dir):
    customer = spark.read.parquet(os.path.join(sf_dir, "customer.parquet"))
    side = lambda fields, where: customer.filter(where).select(
        F.col("c_custkey").alias("source"), *[F.expr(e).alias(f) for f, e in fields.items()])
    return rl.metadata_matches(side(_SAVED_META, "c_custkey % 11 <> 0"), side(_CURRENT_META, "c_custkey % 13 <> 0"))


# ---- quality checks over dirty data ------------------------------------------------------

DIRTY_FACT = """dirty AS (
  SELECT CASE WHEN user_id % 50 = 0 THEN NULL ELSE user_id END AS user_id,
         CASE WHEN user_id % 31 = 0 THEN movie_id + 10000000 ELSE movie_id END AS movie_id,
         CASE WHEN movie_id % 40 = 1 THEN rating * 3 ELSE rating END AS rating,
         CASE WHEN user_id % 23 = 0 THEN NULL ELSE rating_date END AS rating_date, rating_year FROM fact_base2
  UNION ALL SELECT user_id, movie_id, rating, rating_date, rating_year FROM fact_base2 WHERE user_id % 17 = 0)"""
_DIRTY_RANGE = "count(*) > 0 AND min(rating) >= 0.5 AND max(rating) <= 5"


@register("quality_dirty", with_(q.WAREHOUSE_CTES + [
    "fact_base2 AS (SELECT userId AS user_id, movieId AS movie_id, rating, rating_date, rating_year FROM fact_base)", DIRTY_FACT],
    union_sql([
        check_sql("null_keys", "fact_ratings", "count_if(movie_id IS NULL OR user_id IS NULL OR rating IS NULL)", 0,
                  "count_if(movie_id IS NULL OR user_id IS NULL OR rating IS NULL) = 0", "error", "dirty"),
        check_sql("orphan_movie_id", "fact_ratings", "count(*)", 0, "count(*) = 0", "error",
                  "dirty f WHERE NOT EXISTS (SELECT 1 FROM dim_movies x WHERE x.movie_id = f.movie_id)"),
        check_sql("rating_min", "fact_ratings", "min(rating)", 0.5, _DIRTY_RANGE, "error", "dirty"),
        check_sql("rating_max", "fact_ratings", "max(rating)", 5, _DIRTY_RANGE, "error", "dirty"),
        check_sql("duplicate_keys", "fact_ratings", "count(*)", 0, "count(*) = 0", "error",
                  "(SELECT user_id, movie_id FROM dirty GROUP BY user_id, movie_id HAVING count(*) > 1)"),
        check_sql("contract", "fact_ratings", f"count_if({_contract_cond('fact_ratings')})", 0,
                  f"count_if({_contract_cond('fact_ratings')}) = 0", "error", "dirty")])))
def quality_dirty_q(spark, sf_dir):
    base = fact_base_df(spark, sf_dir)
    null_if = lambda cond, c: F.when(F.expr(cond), None).otherwise(F.col(c))
    dirty = base.select(null_if("user_id % 50 = 0", "user_id").alias("user_id"),
                        F.expr("if(user_id % 31 = 0, movie_id + 10000000, movie_id)").alias("movie_id"),
                        F.expr("if(movie_id % 40 = 1, rating * 3, rating)").alias("rating"),
                        null_if("user_id % 23 = 0", "rating_date").alias("rating_date"), "rating_year")
    dirty = dirty.unionByName(base.filter("user_id % 17 = 0"))
    t = "fact_ratings"
    return qc.union_all([
        qc.null_keys(dirty, t, ["movie_id", "user_id", "rating"]),
        qc.orphans(dirty, dim_movies_df(spark, sf_dir), "movie_id", t),
        qc.value_range(dirty, "rating", 0.5, 5.0, t),
        qc.duplicate_keys(dirty, WAREHOUSE_KEYS[t], t),
        qc.contract_violations(dirty, t, WAREHOUSE_NOT_NULL[t], {})])


# ---- sources: CSV ingest and staged Parquet round trips ---------------------------------

def _stage(spark, *parts):
    """A new folder for each call."""
    return workspace(spark, "queries", uuid.uuid4().hex, *parts)


# Faulty CSV lines derived from the inputs: (column with a value of the wrong type and that value, its rows),
# rows repeated with their last required column empty, rows cut off after the first columns.
CSV_FAULTS = {
    "ratings": (("timestamp", "soon", "userId % 20 = 3"), ("rating", "movieId % 25 = 4"), (2, "userId % 30 = 5")),
    "movies": (("movieId", "none", "movieId % 11 = 1"), ("title", "movieId % 13 = 2"), (2, "movieId % 9 = 3")),
    "tags": (("timestamp", "notanumber", "userId % 12 = 1"), ("tag", "userId % 14 = 2"), (2, "userId % 16 = 3")),
    "genome_scores": (("relevance", "high", "tagId % 16 = 3"), ("relevance", "tagId % 20 = 4"), (2, "movieId % 30 = 5")),
    "genome_tags": (("tagId", "one", "tagId % 8 = 1"), ("tag", "tagId % 9 = 2"), (1, "tagId % 10 = 3"))}


def csv_inputs_dir(spark, sf_dir) -> str:
    """The inputs as CSV files with faulty lines among the good ones."""
    raw = _stage(spark, "raw_csv")
    for name, df in adapters.load_inputs(spark, sf_dir).as_dict().items():
        (wrong, value, wrong_rows), (empty, empty_rows), (width, cut_rows) = CSV_FAULTS[name]
        text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
        rows = text.unionByName(text.filter(wrong_rows).withColumn(wrong, F.lit(value))).unionByName(
            text.filter(empty_rows).withColumn(empty, F.lit(None).cast("string")))
        csv_src.write_csv(rows, raw, name)
        csv_src.write_csv(text.filter(cut_rows).select(*text.columns[:width]), raw, name, mode="append")
    return raw


def _ingest_sql(table, source, required) -> str:
    (_, _, wrong), (_, empty), (_, cut) = CSV_FAULTS[table]
    nulls = " OR ".join(f"{c} IS NULL" for c in required)
    big = lambda x: f"CAST({x} AS BIGINT)"
    return (f"SELECT '{table}' AS table_name, {big(f'count(*) + count_if({empty})')} AS row_count, "
            f"{big(f'count_if({nulls}) + count_if({empty})')} AS null_required, "
            f"{big(f'count_if({wrong}) + count_if({cut})')} AS malformed FROM {source}")


@register("csv_ingest", with_(FINGERPRINT_CTES, union_sql([
    _ingest_sql(t, source, INPUTS[t].required) for t, source in
    (("ratings", "raw_ratings"), ("movies", "raw_movies"), ("tags", "raw_tags"), ("genome_scores", "genome"),
     ("genome_tags", "raw_genome_tags"))])))
def csv_ingest_q(spark, sf_dir):
    return csv_src.ingest_report(csv_src.stage_inputs(spark, csv_inputs_dir(spark, sf_dir), _stage(spark, "split")))


def _faults_sql(table, source) -> str:
    (wrong, _, rows), _, (width, cut) = CSV_FAULTS[table]
    names = INPUTS[table].schema.fieldNames()
    both = [(wrong, "type", rows), (names[width], "fields", cut)]
    return " UNION ALL ".join(f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{r}' AS reason, "
                              f"CAST(count_if({cond}) AS BIGINT) AS lines FROM {source}" for c, r, cond in both)


@register("csv_faults", "SELECT * FROM (" + with_(FINGERPRINT_CTES, " UNION ALL ".join(_faults_sql(t, source) for t, source in (
    ("ratings", "raw_ratings"), ("movies", "raw_movies"), ("tags", "raw_tags"), ("genome_scores", "genome"),
    ("genome_tags", "raw_genome_tags")))) + ") WHERE lines > 0")
def csv_faults_q(spark, sf_dir):
    return csv_src.fault_report(csv_src.stage_inputs(spark, csv_inputs_dir(spark, sf_dir), _stage(spark, "split")))


@register("clean_ratings_from_csv", with_(q.RATINGS_CTES, """
SELECT CAST(userId AS INTEGER) AS userId, CAST(movieId AS INTEGER) AS movieId, rating, "timestamp",
       rating_date, rating_year FROM clean_ratings"""))
def clean_ratings_from_csv_q(spark, sf_dir):
    raw = csv_inputs_dir(spark, sf_dir)
    return clean.clean_ratings(csv_src.read_inputs(spark, raw, _stage(spark, "split")).ratings)


@register("fact_ratings_staged", with_(q.WAREHOUSE_CTES, "SELECT * FROM fact"))
def fact_ratings_staged_q(spark, sf_dir):
    fact = fact_df(spark, sf_dir)
    path = wh.write_table(fact, _stage(spark, "warehouse"), "fact_ratings", typed=False)
    return spark.read.parquet(path).select(*fact.columns)


def _typed_sql(table: str, source: str) -> str:
    cols = [c.split() for c in WAREHOUSE_DDL[table].split(", ")]
    names = {"INT": "INTEGER", "STRING": "VARCHAR"}
    return "SELECT " + ", ".join(f"CAST({c} AS {names.get(t, t)}) AS {c}" for c, t in cols if c != "created_at") + f" FROM {source}"


@register("fact_ratings_typed", with_(q.WAREHOUSE_CTES, _typed_sql("fact_ratings", "fact")))
def fact_ratings_typed_q(spark, sf_dir):
    """the typed sink, read back with its decimal and small integer columns."""
    root = _stage(spark, "typed")
    wh.write_table(fact_df(spark, sf_dir), root, "fact_ratings")
    return spark.read.schema(wh.table_schema("fact_ratings")).parquet(os.path.join(root, "fact_ratings"))


LAST_YEAR = "(SELECT max(year(DATE '1970-01-01' + CAST(floor(\"timestamp\" / 86400) AS INTEGER))) FROM all_ratings)"


@register("refresh_twice", with_([q.RAW_RATINGS.replace("raw_ratings AS", "all_ratings AS"), f"""raw_ratings AS (
  SELECT * FROM all_ratings WHERE year(DATE '1970-01-01' + CAST(floor("timestamp" / 86400) AS INTEGER)) < {LAST_YEAR})""",
    q.CLEAN_RATINGS, *q.WAREHOUSE_CTES[2:]], _typed_sql("fact_ratings", "fact")))
def refresh_twice_q(spark, sf_dir):
    """Two full refreshes into one folder, the second without the last year, and between them a run whose checks fail
    after it wrote other tables (half of the users, titles too long): the fact that is left."""
    out = _stage(spark, "refresh")
    inputs = adapters.load_inputs(spark, sf_dir)
    refresh.refresh(spark, inputs, out, sf_dir, STAR_PARAMS)
    wrong = dataclasses.replace(inputs, ratings=inputs.ratings.filter("userId % 2 = 0"),
                                movies=inputs.movies.withColumn("title", F.rpad("title", 600, "x")))
    broken = refresh.refresh(spark, wrong, out, sf_dir, STAR_PARAMS)
    again = refresh.refresh(spark, inputs, out, sf_dir, STAR_PARAMS)
    if (broken.status, again.status) != ("failed", "skipped"):
        raise RuntimeError(f"expected a failed and a skipped run, not {broken.status} and {again.status}")
    refresh.refresh(spark, _without_last_year(inputs), out, sf_dir, STAR_PARAMS)
    return versions.read_table(spark, out, "fact_ratings")


def _without_last_year(inputs):
    year = F.year(epoch_to_date("timestamp"))
    last = inputs.ratings.agg(F.max(year)).first()[0]
    return dataclasses.replace(inputs, ratings=inputs.ratings.filter(year < last))


@register("refresh_partial", with_(q.WAREHOUSE_CTES, _typed_sql("fact_ratings", "fact")))
def refresh_partial_q(spark, sf_dir):
    """A run without the last year, then one with it that rebuilds changed years only: the fact of the last version."""
    out = _stage(spark, "partial")
    inputs = adapters.load_inputs(spark, sf_dir)
    for part in (_without_last_year(inputs), inputs):
        refresh.refresh(spark, part, out, sf_dir, STAR_PARAMS, incremental=True)
    return versions.read_table(spark, out, "fact_ratings")


@register("fact_extended", with_(q.WAREHOUSE_CTES, "SELECT * FROM fact"))
def fact_extended_q(spark, sf_dir):
    """W1-W4 in two parts: the statistics of some rows, extended by the last year and by late rows of every year."""
    rows = staged_base(spark, sf_dir)
    last = rows.agg(F.max("rating_year")).first()[0]
    late = (F.col("userId") % 6 == 0) | (F.col("rating_year") == last)
    old, new = rows.filter(~late), rows.filter(late)
    done = win.entity_stats(old, ["movieId"], ORDER, "rating", rolling=("rolling_30d_count", "rolling_30d_avg"))
    folder, parts = _stage(spark, "extended"), {}
    for name, df in (("done", done), ("daily", win.daily_totals(old, ["movieId"], "rating_date", "rating"))):
        df.write.parquet(os.path.join(folder, name))
        parts[name] = spark.read.parquet(os.path.join(folder, name))
    out = win.extend_stats(parts["done"], parts["daily"], new, ["movieId"], ORDER, "rating")
    return out.withColumnsRenamed({"userId": "user_id", "movieId": "movie_id"}).drop("timestamp")


@register("movie_report", with_(q.WAREHOUSE_CTES, """
SELECT f.movie_id, d.clean_title, count(*) AS ratings, avg(f.rating) AS mean_rating, max(f.rating_date) AS last_rated
FROM fact f JOIN dim_movies d ON d.movie_id = f.movie_id GROUP BY f.movie_id, d.clean_title"""))
def movie_report_q(spark, sf_dir):
    """Fact and dimension bucketed by movie; neither the join nor the grouping moves the fact."""
    return wh.movie_report(*(wh.bucketed(spark, df, f"{t}_{uuid.uuid4().hex}", _stage(spark, "bucketed", t), "movie_id")
                             for t, df in (("fact_ratings", fact_df(spark, sf_dir)), ("dim_movies", dim_movies_df(spark, sf_dir)))))


@register("evolved_table", with_(q.ITEM_CTES, """
SELECT CAST(movieId AS INTEGER) AS movie_id, title, CASE WHEN movieId % 2 = 0 THEN 'unrated' ELSE clean_title END AS note,
       CAST(CASE WHEN movieId % 2 = 0 THEN -1 ELSE release_year END AS SMALLINT) AS release_year FROM clean_items"""))
def evolved_table_q(spark, sf_dir):
    """Rows written before and after two columns with defaults were added, read back as one table."""
    name, path = f"evolved_{uuid.uuid4().hex}", _stage(spark, "evolved")
    items = staged_items(spark, sf_dir)
    old = StructType.fromDDL("movie_id INT, title STRING")
    wh.ensure_table(spark, name, path, old)
    items.filter("movieId % 2 = 0").select(F.col("movieId").cast("int"), "title").write.insertInto(name)
    new = StructType.fromDDL("movie_id INT, title STRING, note STRING, release_year SMALLINT")
    for _ in range(2):                       # again: nothing left to add
        wh.ensure_table(spark, name, path, new, defaults={"note": "'unrated'", "release_year": "-1"})
    items.filter("movieId % 2 <> 0").select(F.col("movieId").cast("int"), "title", "clean_title",
                                            F.col("release_year").cast("smallint")).write.insertInto(name)
    return spark.table(name)
