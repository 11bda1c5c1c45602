from pyspark.sql import functions as F

from ratingsmith.functions import decade_of, strip_title_year, title_year
from ratingsmith.operators import clean

R_SCHEMA = "userId int, movieId int, rating float, timestamp long"


def _ratings(spark, rows):
    return clean.clean_ratings(spark.createDataFrame(rows, R_SCHEMA))


def test_keep_latest(spark):
    out = _ratings(spark, [(1, 1, 4.0, 1), (1, 1, 3.0, 2)]).collect()
    assert [r.rating for r in out] == [3.0]


def test_filter_before_dedup(spark):
    out = _ratings(spark, [(1, 1, 4.0, 1), (1, 1, 9.0, 2)]).collect()
    assert [r.rating for r in out] == [4.0]


def test_same_time_tie_higher_wins(spark):
    out = _ratings(spark, [(1, 1, 2.0, 1), (1, 1, 4.0, 1)]).collect()
    assert [r.rating for r in out] == [4.0]


def test_nulls_dropped_and_dates_utc(spark):
    out = _ratings(spark, [(None, 1, 4.0, 1), (1, 2, 4.0, 86399), (1, 3, 4.0, 86400)])
    got = sorted((r.movieId, str(r.rating_date), r.rating_year) for r in out.collect())
    assert got == [(2, "1970-01-01", 1970), (3, "1970-01-02", 1970)]


def test_dedup_idempotent(spark):
    rows = [(u, m, float(r) / 2, t) for u in range(3) for m in range(3) for r, t in ((3, 5), (7, 5), (2, 9))]
    once = _ratings(spark, rows)
    twice = clean.clean_ratings(once.select("userId", "movieId", "rating", "timestamp"))
    assert sorted(once.collect()) == sorted(twice.collect())


def test_title_year(spark):
    df = spark.createDataFrame([("Toy Story (1995)",), ("X (1968) redux (2001)",), ("Untitled",)], "t string")
    out = df.select(title_year("t").alias("y"), title_year("t", "first").alias("f"),
                    strip_title_year("t").alias("c")).collect()
    assert [tuple(r) for r in out] == [(1995, 1995, "Toy Story"),
                                       (2001, 1968, "X (1968) redux"),
                                       (None, None, "Untitled")]


def test_genres(spark):
    df = spark.createDataFrame([(1, "A (2000)", "A|B"), (2, "B (2000)", "A|B|"), (3, "C", None),
                                (4, "D", "(no genres listed)")], "movieId int, title string, genres string")
    out = {r.movieId: list(r.genre_array) for r in clean.clean_items(df).collect()}
    assert out == {1: ["A", "B"], 2: ["A", "B"]}


def test_items_one_row_per_id(spark):
    df = spark.createDataFrame([(1, "B (2000)", "A"), (1, "A (1999)", "A")],
                               "movieId int, title string, genres string")
    out = clean.clean_items(df).collect()
    assert [(r.title, r.release_year, r.clean_title) for r in out] == [("A (1999)", 1999, "A")]


def test_tags(spark):
    df = spark.createDataFrame([(1, 1, "  DARK ", 5), (1, 1, "dark", 7), (1, 1, "x", 1), (1, 1, None, 1)],
                               "userId int, movieId int, tag string, timestamp long")
    out = [tuple(r) for r in clean.clean_tags(df).collect()]
    assert out == [(1, 1, "dark", 7)]


def test_decade(spark):
    df = spark.createDataFrame([(1995,), (2000,), (None,)], "y int")
    assert [r.d for r in df.select(decade_of("y").alias("d")).collect()] == [1990, 2000, None]


def test_keep_extreme_is_aggregate(spark):
    df = spark.createDataFrame([(1, 1, 2.0, 1)], R_SCHEMA)
    plan = clean.keep_latest(df, ["userId", "movieId"], "timestamp")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Window" not in plan and "Aggregate" in plan
