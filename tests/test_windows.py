import datetime as dt
import random

from pyspark.sql import Window, functions as F

from ratingsmith.functions import half_up
from ratingsmith.operators import windows as win


def _rows(spark, days_ratings, item=1):
    base = dt.date(1970, 1, 1)
    rows = []
    for i, (d, r) in enumerate(days_ratings):
        ts = (d - base).days * 86400 + i
        rows.append((i, item, float(r), ts, d))
    return spark.createDataFrame(rows, "userId int, movieId int, rating double, timestamp long, rating_date date")


def test_rolling_30_days(spark):
    df = _rows(spark, [(dt.date(2020, 1, 1), 1.0), (dt.date(2020, 1, 20), 2.0), (dt.date(2020, 6, 1), 5.0)])
    out = win.rolling_stats(df, ["movieId"], "rating_date", "rating").orderBy("rating_date").collect()
    assert [r.rolling_30d_avg for r in out] == [1.0, 1.5, 5.0]
    assert [r.rolling_30d_count for r in out] == [1, 2, 1]


def test_rolling_edges_inclusive(spark):
    d0 = dt.date(2020, 1, 1)
    df = _rows(spark, [(d0, 1.0), (d0 + dt.timedelta(days=30), 1.0), (d0 + dt.timedelta(days=31), 1.0)])
    out = win.rolling_stats(df, ["movieId"], "rating_date", "rating").orderBy("rating_date").collect()
    assert [r.rolling_30d_count for r in out] == [1, 2, 2]


def _random_ratings(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows, seen = [], set()
    while len(rows) < n:
        u, m = rnd.randrange(5000), rnd.choice([1, 1, 1, 2, 3])   # item 1 is hot
        if (u, m) in seen:
            continue
        seen.add((u, m))
        day = rnd.randrange(60)
        ts = day * 86400 + rnd.choice([0, 10, 20])                # many same-second ties
        rows.append((u, m, rnd.randrange(1, 11) / 2, ts))
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double, timestamp long")
    return df.withColumn("rating_date", F.date_from_unix_date((F.col("timestamp") / 86400).cast("int")))


def test_split_running_equals_plain_window(spark):
    df = _random_ratings(spark)
    w = Window.partitionBy("movieId").orderBy("rating_date", "timestamp", "userId").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    r = Window.partitionBy("movieId").orderBy(F.unix_date("rating_date")).rangeBetween(-30, 0)
    want = df.select("*", F.count("rating").over(w).alias("cumulative_rating_count"),
                     half_up(F.avg("rating").over(w), 2).alias("cumulative_avg_rating"),
                     F.count("rating").over(r).alias("rc"), half_up(F.avg("rating").over(r), 2).alias("ra"))
    cols = sorted(want.columns)
    expected = sorted(want.select(cols).collect())
    # all split, item 1 hot and the rest plain, and all plain
    for hot_rows in (None, 500, 10**9):
        got = win.entity_stats(df, ["movieId"], ["rating_date", "timestamp", "userId"], "rating",
                               rolling=("rc", "ra"), hot_rows=hot_rows)
        assert sorted(got.select(cols).collect()) == expected, hot_rows
    roll = win.rolling_stats(df, ["movieId"], "rating_date", "rating", count_name="rc", avg_name="ra")
    rcols = sorted(df.columns + ["rc", "ra"])
    assert sorted(roll.select(rcols).collect()) == sorted(want.select(rcols).collect())


def test_null_keys_and_null_dates_equal_the_plain_window(spark):
    d = dt.date
    rows = [(1, None, 1.0, 10, d(2020, 1, 1)), (2, None, 2.0, 20, d(2020, 1, 2)), (3, None, 3.0, 30, d(2020, 3, 5)),
            (4, 7, 1.0, 5, None), (5, 7, 2.0, 6, None), (6, 7, 5.0, None, d(2020, 1, 1)), (7, 7, None, 9, d(2020, 1, 9)),
            (8, 7, 4.0, 9, d(2020, 1, 9)), (9, 8, 4.5, 9, d(2020, 1, 9))]
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double, timestamp long, rating_date date")
    w = Window.partitionBy("movieId").orderBy("rating_date", "timestamp", "userId").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    r = Window.partitionBy("movieId").orderBy(F.unix_date("rating_date")).rangeBetween(-30, 0)
    want = df.select("*", F.count("rating").over(w).alias("c"), half_up(F.avg("rating").over(w), 2).alias("a"),
                     F.count("rating").over(r).alias("rc"), half_up(F.avg("rating").over(r), 2).alias("ra"))
    expected = sorted(map(tuple, want.collect()), key=str)
    for hot_rows in (None, 0, 1, 2, 3, 4, 5, 10**6):
        got = win.entity_stats(df, ["movieId"], ["rating_date", "timestamp", "userId"], "rating", running=("c", "a"),
                               rolling=("rc", "ra"), hot_rows=hot_rows)
        assert sorted(map(tuple, got.select(want.columns).collect()), key=str) == expected, hot_rows


def test_running_max_equals_group_size(spark):
    df = _random_ratings(spark, 500, seed=3)
    got = win.running_stats(df, ["movieId"], ["rating_date", "timestamp", "userId"], "rating",
                            hot_rows=100)
    mx = {r.movieId: r.m for r in got.groupBy("movieId").agg(F.max("cumulative_rating_count").alias("m")).collect()}
    n = {r.movieId: r["count"] for r in df.groupBy("movieId").count().collect()}
    assert mx == n


def test_rolling_count_at_most_running_to_end_of_day(spark):
    df = _random_ratings(spark, 800, seed=11)
    out = win.entity_stats(df, ["movieId"], ["rating_date", "timestamp", "userId"], "rating",
                           rolling=("rc", "ra"), hot_rows=100)
    eod = out.groupBy("movieId", "rating_date").agg(F.max("cumulative_rating_count").alias("eod"))
    bad = out.join(eod, ["movieId", "rating_date"]).filter(F.col("rc") > F.col("eod")).count()
    assert bad == 0


def test_top_k_per_group(spark):
    df = spark.createDataFrame([(g, i, float(i)) for g in range(3) for i in range(10)], "g int, i int, v double")
    out = win.top_k_per_group(df, ["g"], [F.col("v").desc(), F.col("i")], 2).collect()
    assert sorted((r.g, r.i, r["rank"]) for r in out) == [(g, i, 10 - i) for g in range(3) for i in (8, 9)]


def test_state_rows_and_hot_entities_equal_the_plain_window(spark):
    """Rows given as state enter running totals and day frames, whether an entity is split or not."""
    df = _random_ratings(spark, 600, seed=5).withColumn("rating", F.when(F.col("userId") % 7 > 0, F.col("rating")))
    order, cut = ["rating_date", "timestamp", "userId"], dt.date(1970, 1, 25)
    want = _plain(df).filter(F.col("rating_date") >= cut)
    expected = sorted(map(tuple, want.collect()), key=str)
    old, new = df.filter(F.col("rating_date") < cut), df.filter(F.col("rating_date") >= cut)
    daily = win.daily_totals(old, ["movieId"], "rating_date", "rating")
    before = daily.groupBy("movieId").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    for hot_rows in (None, 100, 10**9):
        got = win.entity_stats(new, ["movieId"], order, "rating", running=("c", "a"), rolling=("rc", "ra"),
                               hot_rows=hot_rows, before=before, recent=daily, sized=df)
        assert sorted(map(tuple, got.select(want.columns).collect()), key=str) == expected, hot_rows


def _plain(df):
    w = Window.partitionBy("movieId").orderBy("rating_date", "timestamp", "userId").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    r = Window.partitionBy("movieId").orderBy(F.unix_date("rating_date")).rangeBetween(-30, 0)
    return df.select("*", F.count("rating").over(w).alias("c"), half_up(F.avg("rating").over(w), 2).alias("a"),
                     F.count("rating").over(r).alias("rc"), half_up(F.avg("rating").over(r), 2).alias("ra"))


def _around_the_row_window(spark, **kw) -> tuple[list[str], str]:
    """Operators above the window over the rows, and the exchange nearest below it, where nothing is broadcast by size."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = win.entity_stats(_random_ratings(spark, 200), ["movieId"], ["rating_date", "timestamp", "userId"], "rating", **kw)
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    at = next(i for i, x in enumerate(lines) if " Window [" in x and "AS _run_c" in x)
    depth = lambda x: next(i for i, c in enumerate(x) if c.isalnum())
    above, least = [], depth(lines[at])
    for x in reversed(lines[:at]):
        if depth(x) < least:
            above, least = [x.strip(" :+-"), *above], depth(x)
    return above, next(x for x in lines[at:] if "Exchange hash" in x)


def test_rows_with_both_statistics_move_once(spark):
    above, below = _around_the_row_window(spark, rolling=("rc", "ra"))
    assert not [x for x in above if x.startswith(("Exchange", "Sort "))]
    assert "hashpartitioning(_rs_entity" in below and "_rs_group" in below


def test_rows_of_split_entities_are_spread_by_group(spark):
    above, below = _around_the_row_window(spark, hot_rows=26)
    assert not [x for x in above if x.startswith(("Exchange", "Sort "))]
    assert "hashpartitioning(_rs_entity" in below and "_rs_group" in below
