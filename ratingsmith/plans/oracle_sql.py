"""DuckDB SQL for the same adapters and operators, used as an independent oracle.

Tables ``lineitem orders part events embeddings`` are views over the driver
Parquet files.  Rounding goes through DECIMAL(38,12) so that ties round half
away from zero exactly as ``ratingsmith.functions.half_up`` does.
"""

from __future__ import annotations


def R(x: str, s: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,12)), {s}) AS DOUBLE)"


RAW_RATINGS = """raw_ratings AS (
  SELECT o.o_custkey AS userId, l.l_partkey AS movieId,
         CAST(0.5 * (((CAST(floor(l.l_quantity) AS BIGINT) - 1) % 11 + 11) % 11) AS DOUBLE) AS rating,
         CAST(floor(epoch(l.l_shipdate)) AS BIGINT) AS "timestamp"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

CLEAN_RATINGS = """clean_ratings AS (
  SELECT userId, movieId, rating, "timestamp",
         CAST(DATE '1970-01-01' + CAST(floor("timestamp" / 86400) AS INTEGER) AS DATE) AS rating_date,
         CAST(year(DATE '1970-01-01' + CAST(floor("timestamp" / 86400) AS INTEGER)) AS INTEGER) AS rating_year
  FROM (SELECT * FROM raw_ratings
        WHERE userId IS NOT NULL AND movieId IS NOT NULL AND rating IS NOT NULL
          AND "timestamp" IS NOT NULL AND rating BETWEEN 0.5 AND 5.0
        QUALIFY row_number() OVER (PARTITION BY userId, movieId
                                   ORDER BY "timestamp" DESC, rating DESC) = 1))"""

RAW_MOVIES = """raw_movies AS (
  SELECT p_partkey AS movieId,
         CASE WHEN p_size % 10 = 0 THEN p_name
              ELSE p_name || ' (' || CAST(1950 + p_size AS VARCHAR) || ')' END AS title,
         CASE WHEN p_partkey % 17 = 0 THEN '(no genres listed)'
              ELSE replace(p_name, ' ', '|') || '|' || p_type END AS genres
  FROM part)"""

CLEAN_ITEMS = r"""clean_items AS (
  SELECT movieId, title, genres,
         list_filter(string_split(genres, '|'), lambda x: x <> '') AS genre_array,
         TRY_CAST(regexp_extract(title, '\((\d{4})\)\s*$', 1) AS INTEGER) AS release_year,
         regexp_replace(title, '\s*\(\d{4}\)\s*$', '') AS clean_title
  FROM (SELECT * FROM raw_movies
        WHERE movieId IS NOT NULL AND title IS NOT NULL AND genres <> '(no genres listed)'
        QUALIFY row_number() OVER (PARTITION BY movieId ORDER BY title, genres) = 1))"""

RAW_TAGS = """raw_tags AS (
  SELECT user_id AS userId, event_id % 97 AS movieId,
         CASE WHEN event_id % 11 = 0 THEN 'x' ELSE ' ' || upper(event_type) || ' ' END AS tag,
         CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp"
  FROM events)"""

CLEAN_TAGS = """clean_tags AS (
  SELECT userId, movieId, tag, max("timestamp") AS "timestamp"
  FROM (SELECT userId, movieId, trim(lower(tag)) AS tag, "timestamp" FROM raw_tags
        WHERE userId IS NOT NULL AND movieId IS NOT NULL AND tag IS NOT NULL)
  WHERE length(tag) >= 2
  GROUP BY userId, movieId, tag)"""

GENOME = """genome AS (
  SELECT movieId, CAST(pos AS INTEGER) AS tagId, abs(CAST(v AS DOUBLE)) AS relevance
  FROM (SELECT vec_id AS movieId, unnest(range(len(embedding))) AS pos,
               unnest(embedding) AS v FROM embeddings))"""

FACT_BASE = """fact_base AS (
  SELECT * FROM clean_ratings cr WHERE EXISTS (SELECT 1 FROM clean_items ci WHERE ci.movieId = cr.movieId))"""

WINDOWS = """WINDOW w AS (PARTITION BY movieId ORDER BY rating_date, "timestamp", userId
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       r AS (PARTITION BY movieId ORDER BY rating_date
             RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW)"""

RUNNING_COLS = f"""count(rating) OVER w AS cumulative_rating_count,
       {R("avg(rating) OVER w", 2)} AS cumulative_avg_rating"""
ROLLING_COLS = f"""count(rating) OVER r AS rolling_30d_count,
       {R("avg(rating) OVER r", 2)} AS rolling_30d_avg"""

FACT = f"""fact AS (
  SELECT userId AS user_id, movieId AS movie_id, rating, rating_date, rating_year,
         {RUNNING_COLS}, {ROLLING_COLS}
  FROM fact_base {WINDOWS})"""

DIM_MOVIES = """dim_movies AS (
  SELECT movieId AS movie_id, title, clean_title, genres, release_year FROM clean_items)"""

DIM_USERS = """dim_users AS (SELECT DISTINCT userId AS user_id FROM clean_ratings)"""

RATINGS_CTES = [RAW_RATINGS, CLEAN_RATINGS]
ITEM_CTES = [RAW_MOVIES, CLEAN_ITEMS]
WAREHOUSE_CTES = RATINGS_CTES + ITEM_CTES + [FACT_BASE, FACT, DIM_MOVIES, DIM_USERS]


def with_(ctes, body: str) -> str:
    seen, uniq = set(), []
    for c in ctes:
        if c not in seen:
            seen.add(c)
            uniq.append(c)
    return "WITH " + ",\n".join(uniq) + "\n" + body
