"""Grouped statistics.

Ratings are reduced per item before they meet the item dimension, so the
join and the genre explode see one row per (item, group) instead of one row
per rating.  Sums of half-star ratings are exact, so the pre-aggregated
averages equal a direct ``avg``.  Every function also takes ``year_totals`` in place of the ratings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratingsmith.functions import decade_of, half_up, safe_divide


def _reduce(df: DataFrame, keys, measure: str) -> DataFrame:
    """Count and sum per key, from rows or from ``year_totals``."""
    if {"n", "total"} <= set(df.columns):
        return df.groupBy(*keys).agg(F.sum("n").alias("_n"), F.sum("total").alias("_s"))
    return df.groupBy(*keys).agg(F.count(measure).alias("_n"),
                                 F.sum(F.col(measure).cast("double")).alias("_s"))


def group_trends(ratings: DataFrame, items: DataFrame, item: str = "movieId",
                 groups: str = "genre_array", by: str = "rating_year", measure: str = "rating",
                 group_name: str = "genre", avg_name: str = "avg_rating",
                 count_name: str = "rating_count", scale: int = 2, sort: bool = True) -> DataFrame:
    """Average and count per (group, ``by``) over exploded item groups (A1).

    A rating counts once for each group of its item.
    """
    per_item = _reduce(ratings, [item, by], measure)
    exploded = per_item.join(items.select(item, groups), item).select(
        F.explode(groups).alias(group_name), by, "_n", "_s")
    out = exploded.groupBy(group_name, by).agg(F.sum("_n").alias("_n"), F.sum("_s").alias("_s"))
    out = out.select(group_name, by, half_up(safe_divide(F.col("_s"), F.col("_n")), scale).alias(avg_name),
                     F.col("_n").alias(count_name))
    return out.orderBy(group_name, by) if sort else out


def year_totals(ratings: DataFrame, item: str = "movieId", by: str = "rating_year", measure: str = "rating") -> DataFrame:
    """``item, by, n, total``: additive state that trends, item statistics and counts can be worked out from."""
    return ratings.groupBy(item, by).agg(F.count(measure).alias("n"), F.sum(F.col(measure).cast("double")).alias("total"))


def item_stats(ratings: DataFrame, item: str = "movieId", measure: str = "rating") -> DataFrame:
    """Exact per-item count and sum, the base of every per-item report."""
    return _reduce(ratings, [item], measure)


def bucket_stats(ratings: DataFrame, items: DataFrame, item: str = "movieId",
                 title: str = "clean_title", year: str = "release_year", measure: str = "rating",
                 min_count: int = 100, out_item: str = "movie_id", scale: int = 2,
                 sort: bool = True) -> DataFrame:
    """Per-item average and count with the item's decade, HAVING count >= min (A2)."""
    stats = item_stats(ratings, item, measure).filter(F.col("_n") >= min_count)
    dims = items.select(item, title, decade_of(year).alias("decade"))
    out = stats.join(dims, item).select(
        F.col(item).alias(out_item), title, "decade",
        half_up(safe_divide(F.col("_s"), F.col("_n")), scale).alias("avg_rating"),
        F.col("_n").alias("total_ratings"))
    if sort:
        out = out.orderBy(F.col("decade").asc_nulls_first(), F.col("avg_rating").desc(),
                          F.col(out_item))
    return out


def top_n_by_count(df: DataFrame, item: str, n: int, count_name: str = "rating_count") -> DataFrame:
    """The ``n`` items with most rows, ties by item id."""
    rows = F.sum("n") if {"n", "total"} <= set(df.columns) else F.count(F.lit(1))
    counts = df.groupBy(item).agg(rows.alias(count_name))
    return counts.orderBy(F.col(count_name).desc(), F.col(item)).limit(n)


def top_rated(ratings: DataFrame, items: DataFrame, item: str = "movie_id",
              title: str = "clean_title", measure: str = "rating", min_count: int = 500,
              n: int = 10, scale: int = 2) -> DataFrame:
    """Best average rating per item with at least ``min_count`` ratings, top ``n``.

    Grouped by item id, not by title, so two items with one title stay apart.
    """
    stats = item_stats(ratings, item, measure).filter(F.col("_n") >= min_count)
    out = stats.join(items.select(item, title), item).select(
        item, title, half_up(safe_divide(F.col("_s"), F.col("_n")), scale).alias("avg_rating"),
        F.col("_n").alias("total_ratings"))
    return out.orderBy(F.col("avg_rating").desc(), F.col("total_ratings").desc(),
                       F.col(item)).limit(n)
