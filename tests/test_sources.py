import os

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ratingsmith.sources import csv as csv_src
from ratingsmith.sources import jdbc
from ratingsmith.sources.contracts import MOVIES, RATINGS
from ratingsmith.plans import warehouse as wh


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_quoting(spark, tmp_dir):
    p = os.path.join(tmp_dir, "movies.csv")
    _write(p, 'movieId,title,genres\n1,"Say ""Hi"", You (1999)",A|B\n')
    rows = csv_src.read_csv_checked(spark, p, MOVIES).collect()
    assert [(r.movieId, r.title, r.genres) for r in rows] == [(1, 'Say "Hi", You (1999)', "A|B")]


def test_csv_malformed_split(spark, tmp_dir):
    p = os.path.join(tmp_dir, "ratings.csv")
    _write(p, "userId,movieId,rating,timestamp\n1,2,3.5,100\nbad,2,3.5,100\n1,2\n,3,4.0,5\n")
    good, bad = csv_src.stage_csv(spark, p, RATINGS, os.path.join(tmp_dir, "staged"))
    assert bad.count() == 2
    g = good.collect()
    assert len(g) == 2
    clean_rows = good.dropna(subset=list(RATINGS.required)).collect()
    assert [tuple(r) for r in clean_rows] == [(1, 2, 3.5, 100)]
    # counts do not depend on which columns a query reads
    assert good.select("rating").count() == 2


def test_ingest_report_counts_faults_in_every_column(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    for name, text in {
        "ratings.csv": "userId,movieId,rating,timestamp\n1,2,3.5,100\n,3,4.0,5\nbad,1,1,1\n1,2\n1,1,1.0,soon\n",
        "movies.csv": "movieId,title,genres\n2,A (1999),X\n5,B\n6,,Y\n",
        "tags.csv": "userId,movieId,tag,timestamp\n1,2,good,5\n1,3,fine,notanumber\n",
        "genome-scores.csv": "movieId,tagId,relevance\n2,1,0.5\n",
        "genome-tags.csv": "tagId,tag\n1,good\n",
    }.items():
        _write(os.path.join(raw, name), text)
    staged = csv_src.stage_inputs(spark, raw, os.path.join(tmp_dir, "staged"))
    rep = {r.table_name: (r.row_count, r.null_required, r.malformed) for r in csv_src.ingest_report(staged).collect()}
    assert rep == {"ratings": (2, 1, 3), "movies": (2, 1, 1), "tags": (1, 0, 1), "genome_scores": (1, 0, 0),
                   "genome_tags": (1, 0, 0)}
    inputs = csv_src.read_inputs(spark, raw, os.path.join(tmp_dir, "again"))
    assert inputs.ratings.count() == 2 == len(inputs.ratings.collect())


def test_registered_csv_ingest_has_faults_in_every_input(spark):
    from ratingsmith.plans import catalog
    rows = catalog.QUERIES["csv_ingest"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 5 and all(r.malformed > 0 and r.null_required > 0 for r in rows)


def test_jdbc_round_trip_embedded(spark):
    url = "jdbc:derby:memory:rs_test;create=true"
    drv = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    df = spark.createDataFrame([(1, 2, 0.9), (2, 3, 0.8), (1, 3, 0.95)],
                               "movie_id_a int, movie_id_b int, similarity double")
    jdbc.write_jdbc(df, url, "tag_similarity", mode="overwrite", driver=drv)
    jdbc.write_jdbc(df, url, "tag_similarity", mode="overwrite", driver=drv)   # idempotent
    back = jdbc.read_jdbc(spark, url, table="tag_similarity", driver=drv,
                          partition_column="movie_id_a", lower=1, upper=3, num_partitions=2)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())
    q = jdbc.read_jdbc(spark, url, query='SELECT "movie_id_b" FROM tag_similarity WHERE "movie_id_a" = 1',
                       driver=drv)
    assert sorted(r[0] for r in q.collect()) == [2, 3]


def test_overwrite_replaces_the_table_and_incremental_only_its_years(spark, tmp_dir):
    cols = "user_id int, movie_id int, rating_year int"
    both = spark.createDataFrame([(1, 1, 2000), (2, 1, 2001)], cols)
    one = spark.createDataFrame([(3, 1, 2001)], cols)
    read = lambda: sorted(tuple(r) for r in spark.read.parquet(os.path.join(tmp_dir, "fact_ratings"))
                          .select("user_id", "rating_year").collect())
    wh.write_table(both, tmp_dir, "fact_ratings", typed=False)
    wh.write_table(one, tmp_dir, "fact_ratings", typed=False, incremental=True)
    wh.write_table(one, tmp_dir, "fact_ratings", typed=False, incremental=True)
    assert read() == [(1, 2000), (3, 2001)]
    pruned = spark.read.parquet(os.path.join(tmp_dir, "fact_ratings")).filter(F.col("rating_year") == 2001)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rating_year" in plan
    wh.write_table(one, tmp_dir, "fact_ratings", typed=False)
    assert read() == [(3, 2001)]


def test_files_follow_the_data_not_the_tasks(spark, tmp_dir):
    df = spark.range(40_000, numPartitions=32).select(
        F.col("id").alias("user_id"), (F.col("id") % 50).alias("movie_id"), F.lit(1.0).alias("rating"),
        (2000 + F.col("id") % 7).cast("int").alias("rating_year"))
    path = wh.write_table(df, tmp_dir, "fact_ratings", typed=False)
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) <= 14, len(files)                          # 32 tasks times 7 years would be 224


def test_sink_projection_types(spark):
    df = spark.createDataFrame([(1, 2, 4.5, 2001, 3.333)],
                               "user_id long, movie_id long, rating double, rating_year int, cumulative_avg_rating double")
    out = wh.sink_projection(df, "fact_ratings")
    types = dict(out.dtypes)
    assert types["rating"] == "decimal(3,1)" and types["rating_year"] == "smallint"
    assert types["cumulative_avg_rating"] == "decimal(4,2)" and types["user_id"] == "int"


def test_ensure_schema_creates_and_extends_all_tables(spark, tmp_dir):
    try:
        old = StructType([f for f in wh.table_schema("pipeline_run_log") if f.name != "source_url"])
        wh.ensure_table(spark, "rs_t_pipeline_run_log", os.path.join(tmp_dir, "pipeline_run_log"), old)
        for _ in range(2):
            names = wh.ensure_schema(spark, tmp_dir, "rs_t_")
        assert len(names) == 8
        for name in names:
            want = wh.table_schema(name.removeprefix("rs_t_"))
            assert {(f.name, f.dataType) for f in spark.table(name).schema} == {(f.name, f.dataType) for f in want}
        assert dict(spark.table("rs_t_fact_ratings").dtypes)["rating"] == "decimal(3,1)"
    finally:
        for name in wh.ensure_schema(spark, tmp_dir, "rs_t_"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_publish_and_defaults(spark, tmp_dir):
    items = spark.createDataFrame([(1, "A (1999)", "A", "a", 1999)],
                                  "movie_id long, title string, clean_title string, genres string, release_year int")
    path = wh.write_table(items, tmp_dir, "dim_movies", typed=False)
    seen = {}
    wh.publish(spark, {"dim_movies": path}, lambda df, t: seen.setdefault(t, df))
    out = seen["dim_movies"]
    assert dict(out.dtypes)["movie_id"] == "int" and dict(out.dtypes)["release_year"] == "smallint"
    assert "created_at" in out.columns and out.first().created_at is not None


def test_rejected_lines_carry_column_and_reason(spark):
    from ratingsmith.sources import csv as csv_src
    from ratingsmith.sources.contracts import INPUTS
    lines = {"1,2,3.5,soon": ("timestamp", "type"), "x,2,y,4": ("userId", "type"), "1,2": ("rating", "fields"),
             "1,2,3.5,4,5": (None, "fields"), "": (None, "other"), ",,,": (None, "other")}
    bad = spark.createDataFrame([(x,) for x in lines], "line string")
    got = {r.line: (r.column_name, r.reason) for r in csv_src.fault_reasons(bad, INPUTS["ratings"]).collect()}
    assert got == lines
