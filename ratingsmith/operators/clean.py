"""Cleaning and de-duplication.

De-duplication is an aggregate, not a window: ``max(struct(order..., payload...))``
per key runs a partial (map-side) aggregate before the shuffle, so a key that
holds a large share of the rows is collapsed before it reaches one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ratingsmith.functions import (
    epoch_to_date, normalize_token, split_list, strip_title_year, title_year, year_of,
)

NO_GENRES = "(no genres listed)"


def keep_extreme(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 pick: str = "max") -> DataFrame:
    """One row per key: the row whose ``order`` columns are greatest (or least).

    Columns in ``order`` are compared left to right; remaining columns are the
    final tie-break, so the chosen row is deterministic.
    """
    keys = list(keys)
    order = list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    agg = F.max(packed) if pick == "max" else F.min(packed)
    return (df.groupBy(*keys).agg(agg.alias("_best"))
              .select(*keys, *[F.col(f"_best.{c}").alias(c) for c in order + rest])
              .select(*df.columns))


def keep_latest(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """Keep the latest row per key; equal times resolve to the greatest ``tie`` values."""
    return keep_extreme(df, keys, [ts, *tie], pick="max")


def clean_ratings(df: DataFrame, user: str = "userId", item: str = "movieId",
                  rating: str = "rating", ts: str = "timestamp",
                  lo: float = 0.5, hi: float = 5.0) -> DataFrame:
    """Drop NULLs, keep the valid range, then keep the latest rating per (user, item).

    The range filter runs before de-duplication, so an out-of-range later row
    cannot hide a valid earlier one.  Adds ``rating_date`` (UTC) and ``rating_year``.
    """
    valid = (df.dropna(subset=[user, item, rating, ts])
               .withColumn(rating, F.col(rating).cast("double"))
               .filter(F.col(rating).between(lo, hi)))
    latest = keep_latest(valid, [user, item], ts, tie=[rating])
    return latest.select("*", epoch_to_date(ts).alias("rating_date")).withColumn(
        "rating_year", year_of("rating_date"))


def clean_items(df: DataFrame, item: str = "movieId", title: str = "title",
                genres: str = "genres", year_match: str = "trailing",
                no_genres: str = NO_GENRES) -> DataFrame:
    """Items with a genre list, release year and title without the year.

    Rows without genres (NULL or the sentinel) are dropped before the
    one-row-per-item rule, which keeps the least (title, genres).
    """
    base = (df.dropna(subset=[item, title])
              .filter(F.col(genres) != F.lit(no_genres)))
    one = keep_extreme(base, [item], [title, genres], pick="min")
    return one.select(
        "*",
        split_list(genres).alias("genre_array"),
        title_year(title, year_match).alias("release_year"),
        strip_title_year(title).alias("clean_title"),
    )


def clean_tags(df: DataFrame, user: str = "userId", item: str = "movieId",
               tag: str = "tag", ts: str = "timestamp", min_length: int = 2) -> DataFrame:
    """Normalise tags, drop short ones, one row per (user, item, tag) with its latest time (D3)."""
    norm = (df.dropna(subset=[user, item, tag])
              .withColumn(tag, normalize_token(tag))
              .filter(F.length(tag) >= min_length))
    return norm.groupBy(user, item, tag).agg(F.max(ts).alias(ts))


def distinct_values(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    """Distinct values of one column (D4); a partial aggregate collapses repeats map-side."""
    return df.select(F.col(col).alias(alias or col)).distinct()
