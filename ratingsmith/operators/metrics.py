"""Dashboard metrics.

All are aggregates over the fact and dimension tables or the small analytic
tables.  KPIs that mix tables are one aggregate over a tagged union, not a
join of one-row results.  Averages are count-weighted (exact sums over
ratings), never averages of averages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ratingsmith.functions import decade_of, half_up, safe_divide


def kpis(fact: DataFrame, items: DataFrame, user: str = "user_id", rating: str = "rating") -> DataFrame:
    """B1: total ratings, items, distinct reviewers, platform average."""
    f = fact.select(F.lit(1).alias("_f"), F.lit(0).alias("_i"), F.col(user).alias("_u"),
                    F.col(rating).cast("double").alias("_r"))
    i = items.select(F.lit(0).alias("_f"), F.lit(1).alias("_i"),
                     F.lit(None).cast(fact.schema[user].dataType).alias("_u"),
                     F.lit(None).cast("double").alias("_r"))
    return f.unionByName(i).agg(
        F.sum("_f").cast("bigint").alias("total_ratings"),
        F.sum("_i").cast("bigint").alias("total_movies"),
        F.count_distinct("_u").alias("unique_reviewers"),
        half_up(F.avg("_r"), 2).alias("platform_avg_rating"))


def volume_by(fact: DataFrame, col: str, name: str = "rating_count") -> DataFrame:
    """Row count per value of ``col`` (year, rating step)."""
    return fact.groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(col)


def _genre_totals(fact: DataFrame, items: DataFrame, item: str, groups: str,
                  by: str | None = None) -> DataFrame:
    keys = [item] + ([by] if by else [])
    per = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                  F.sum(F.col("rating").cast("double")).alias("_s"))
    ex = per.join(items.select(item, groups), item).select(
        F.explode(groups).alias("genre"), *([by] if by else []), "_n", "_s")
    return ex.groupBy("genre", *([by] if by else [])).agg(F.sum("_n").alias("_n"),
                                                        F.sum("_s").alias("_s"))


def genre_summary(fact: DataFrame, items: DataFrame, item: str = "movie_id",
                  groups: str = "genre_array") -> DataFrame:
    """Per genre volume and weighted average with both rankings.

    The ranking windows run over the genre list (one row per genre).
    """
    t = _genre_totals(fact, items, item, groups).select(
        "genre", F.col("_n").alias("rating_count"),
        half_up(safe_divide(F.col("_s"), F.col("_n")), 2).alias("avg_rating"))
    by_volume = Window.orderBy(F.col("rating_count").desc(), "genre")
    by_rating = Window.orderBy(F.col("avg_rating").desc(), F.col("rating_count").desc(), "genre")
    return t.select("*", F.row_number().over(by_volume).alias("volume_rank"),
                    F.row_number().over(by_rating).alias("rating_rank"))


def genre_year_counts(fact: DataFrame, items: DataFrame, item: str = "movie_id",
                      groups: str = "genre_array", by: str = "rating_year") -> DataFrame:
    return _genre_totals(fact, items, item, groups, by).select(
        "genre", by, F.col("_n").alias("rating_count"))


def _by_genre(fact: DataFrame, items: DataFrame, item: str, groups: str, by: str) -> DataFrame:
    """One row per genre: its yearly counts (an array, one entry a year) and their sum."""
    return genre_year_counts(fact, items, item, groups, by).groupBy("genre").agg(
        F.collect_list(F.struct(F.col(by).alias("year"), "rating_count")).alias("years"),
        F.sum("rating_count").alias("n"), F.max(by).alias("latest"))


def genre_growth(fact: DataFrame, items: DataFrame, since_year: int | None = None,
                 item: str = "movie_id", groups: str = "genre_array",
                 by: str = "rating_year") -> DataFrame:
    """Growth of each genre's yearly volume from the first to the last year >= since.

    ``since_year=None`` takes the first year of the latest decade in which any genre
    was rated.  The fact is read once; the window for that year runs over one row a genre.
    """
    rows = _by_genre(fact, items, item, groups, by)
    if since_year is None:
        start = (F.floor(F.max("latest").over(Window.partitionBy()) / 10) * 10).cast("int")
    else:
        start = F.lit(int(since_year))
    rows = rows.withColumn("start", start)
    recent = F.filter("years", lambda y: y["year"] >= F.col("start"))
    rows = rows.select("genre", F.array_sort(recent).alias("years")).filter(F.size("years") > 0)
    first, last = F.element_at("years", 1), F.element_at("years", -1)
    g = rows.select("genre", first["year"].alias("first_year"), first["rating_count"].alias("first_count"),
                    last["year"].alias("last_year"), last["rating_count"].alias("last_count"))
    growth = safe_divide(F.col("last_count") - F.col("first_count"), F.col("first_count"))
    return g.select("*", half_up(growth, 4).alias("growth")).orderBy(
        F.col("growth").desc_nulls_last(), "genre")


def genre_series(fact: DataFrame, items: DataFrame, genres: list[str] | None = None,
                 top: int = 3, item: str = "movie_id", groups: str = "genre_array",
                 by: str = "rating_year") -> DataFrame:
    """Yearly volume of chosen genres (default: the ``top`` genres by volume)."""
    rows = _by_genre(fact, items, item, groups, by)
    if genres:
        rows = rows.filter(F.col("genre").isin(genres))
    else:
        rows = rows.orderBy(F.col("n").desc(), "genre").limit(top)
    years = rows.select("genre", F.explode("years").alias("y"))
    return years.select("genre", F.col("y.year").alias(by), F.col("y.rating_count").alias("rating_count")).orderBy("genre", by)


def decade_summary(fact: DataFrame, items: DataFrame, item: str = "movie_id",
                   year: str = "release_year") -> DataFrame:
    """Per decade: movies released, ratings received, weighted average rating."""
    dec = items.select(item, decade_of(year).alias("decade")).filter(F.col("decade").isNotNull())
    per_item = fact.groupBy(item).agg(F.count(F.lit(1)).alias("_n"),
                                      F.sum(F.col("rating").cast("double")).alias("_s"))
    joined = dec.join(per_item, item, "left")
    return joined.groupBy("decade").agg(
        F.count(F.lit(1)).alias("movie_count"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_ratings"),
        half_up(safe_divide(F.sum("_s"), F.sum("_n")), 2).alias("avg_rating")).orderBy("decade")
