import os

from ratingsmith.operators import runlog as rl
from ratingsmith.plans import refresh as rf
from ratingsmith.plans import warehouse as wh
from ratingsmith.sources import adapters

SF = "/root/testdata/sf0.001"


def test_append_and_reports(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log")
    a = rl.append_run(spark, path, "h1", "success", 10, 60)
    b = rl.append_run(spark, path, "h1", "skipped", 0, 5)
    assert (a, b) == (1, 2)
    log = rl.read_log(spark, path)
    assert rl.last_run(log).first().status == "skipped"
    assert rl.last_success(log).first().run_id == 1
    k = rl.run_kpis(log).first()
    assert (k.total_runs, k.success_rate, k.last_status) == (2, 50.0, "skipped")
    stats_path = os.path.join(tmp_dir, "stats")
    counts = spark.createDataFrame([("fact_ratings", 10)], "table_name string, row_count long")
    rl.append_table_stats(counts, a, stats_path)
    stats = rl.read_log(spark, stats_path, rl.TABLE_STATS_SCHEMA)
    assert [tuple(r) for r in rl.last_success_stats(log, stats).collect()] == [("fact_ratings", 10)]


def test_refresh_then_skip(spark, tmp_dir):
    inputs = adapters.load_inputs(spark, SF)
    params = wh.StarParams(min_count=5, sim_threshold=0.7, sim_top_n=None)
    src = os.path.join(tmp_dir, "src-marker")
    first = rf.refresh(spark, inputs, tmp_dir, source=src, params=params)
    assert first.status == "success", first
    assert set(first.changed) == {"ratings", "movies", "tags", "genome_scores", "genome_tags"}
    fact = spark.read.parquet(first.paths["fact_ratings"])
    assert dict(fact.dtypes)["cumulative_avg_rating"] == "decimal(4,2)"
    n1 = fact.count()
    second = rf.refresh(spark, inputs, tmp_dir, source=src, params=params)
    assert second.status == "skipped"
    forced = rf.refresh(spark, inputs, tmp_dir, source=src, params=params, force=True)
    assert forced.status == "success"
    assert spark.read.parquet(first.paths["fact_ratings"]).count() == n1   # idempotent
    log = rl.read_log(spark, os.path.join(tmp_dir, "_audit", "pipeline_run_log"))
    assert [r.status for r in log.orderBy("run_id").collect()] == ["success", "skipped", "success"]
    drift = spark.read.parquet(os.path.join(tmp_dir, "_audit", "drift_latest"))
    assert drift.filter("flagged").count() == 0 and drift.filter("previous IS NOT NULL").count() == 6


PARAMS = wh.StarParams(min_count=5, sim_threshold=0.7, sim_top_n=None)


def _statuses(spark, out):
    return [r.status for r in rl.read_log(spark, os.path.join(out, "_audit", "pipeline_run_log")).orderBy("run_id").collect()]


def test_csv_refresh_skips_without_reading_and_counts_good_lines_only(spark, tmp_dir):
    from ratingsmith.sources import csv as csv_src
    raw, out = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "out")
    csv_src.write_inputs(adapters.load_inputs(spark, SF), raw)
    spark.createDataFrame([("x", "1")], "userId string, movieId string").write.mode("append").option("header", "true").csv(
        os.path.join(raw, "ratings.csv"))
    first = rf.refresh_csv(spark, raw, out, PARAMS)
    assert first.status == "success"
    again = rf.refresh(spark, lambda: 1 / 0, out, raw, PARAMS, metadata=csv_src.input_metadata(spark, raw))
    assert again.status == "skipped" and again.changed == []      # the inputs were not even asked for
    # one input rewritten with the same content: other metadata, same fingerprints
    ratings_dir = os.path.join(raw, "ratings.csv")
    copy = spark.read.option("header", "true").csv(ratings_dir).collect()
    spark.createDataFrame(copy).write.mode("overwrite").option("header", "true").csv(ratings_dir)
    assert rf.refresh_csv(spark, raw, out, PARAMS).status == "skipped"
    floor = spark.read.parquet(os.path.join(out, "_audit", "quality_latest")).filter("check_name = 'row_floor'").first()
    assert floor.threshold == int(0.9 * adapters.ratings(spark, SF).count())


def test_metadata_reads_the_listing_only(spark, tmp_dir):
    p = os.path.join(tmp_dir, "f.csv")
    with open(p, "w") as f:
        f.write("a,b\n" * 1000)
    plan = rl.listing_metadata(spark, p, "s")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1].split(">")[0]
    one = rl.listing_metadata(spark, p, "s").first()
    assert one.content_length == "4000"
    with open(p, "a") as f:
        f.write("x\n")
    assert rl.listing_metadata(spark, p, "s").first().etag != one.etag


def test_skip_needs_the_same_settings_and_standing_outputs(spark, tmp_dir):
    import shutil
    inputs = adapters.load_inputs(spark, SF)
    out, other = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    run = lambda o, p=PARAMS: rf.refresh(spark, inputs, o, source="s3://bucket/x", params=p).status
    assert run(out) == "success" and run(out) == "skipped"
    assert run(other) == "success"                                # another folder has no tables yet
    assert run(out, wh.StarParams(min_count=1, sim_threshold=0.75, sim_top_n=None)) == "success"
    shutil.rmtree(os.path.join(out, "warehouse", "genre_trends"))
    assert run(out, wh.StarParams(min_count=1, sim_threshold=0.75, sim_top_n=None)) == "success"
    assert _statuses(spark, out) == ["success", "skipped", "success", "success"]


def test_a_year_that_is_gone_leaves_every_table(spark, tmp_dir):
    import dataclasses

    from pyspark.sql import functions as F
    inputs = adapters.load_inputs(spark, SF)
    year = F.year(F.timestamp_seconds("timestamp"))
    last = inputs.ratings.agg(F.max(year)).first()[0]
    rf.refresh(spark, inputs, tmp_dir, "s", PARAMS)
    fewer = dataclasses.replace(inputs, ratings=inputs.ratings.filter(year < last))
    again = rf.refresh(spark, fewer, tmp_dir, "s", PARAMS)
    assert again.status == "success" and again.changed == ["ratings"]
    for path in (again.paths["fact_ratings"], again.paths["genre_trends"], os.path.join(tmp_dir, "_staging", "clean_ratings")):
        assert spark.read.parquet(path).filter(F.col("rating_year") >= last).isEmpty(), path


def test_a_run_that_raises_is_logged(spark, tmp_dir):
    import dataclasses

    import pytest
    inputs = adapters.load_inputs(spark, SF)
    empty = dataclasses.replace(inputs, ratings=inputs.ratings.limit(0))
    with pytest.raises(ValueError):
        rf.refresh(spark, empty, tmp_dir, "s", PARAMS)
    with pytest.raises(ZeroDivisionError):
        rf.refresh(spark, lambda: 1 / 0, tmp_dir, "s", PARAMS)
    assert _statuses(spark, tmp_dir) == ["failed", "failed"]


def test_fingerprint_sees_values_moved_past_nulls(spark):
    cols = "a int, b int, c string, d string"
    fp = lambda rows: rl.fingerprint(spark.createDataFrame(rows, cols), "t").first().fingerprint
    rows = [(None, 1, "x", "yz"), (2, 3, None, "")]
    assert fp(rows) == fp(rows[::-1])
    for other in ([(1, None, "x", "yz"), rows[1]], [(None, 1, "xy", "z"), rows[1]], [rows[0], (2, 3, "", None)], rows + rows[:1]):
        assert fp(rows) != fp(other)
    # the digest of refreshes sees the same
    native = lambda rows: rl.fingerprint(spark.createDataFrame(rows, cols), "t", rl.native_digest).first().fingerprint
    assert native(rows) == native(rows[::-1])
    for other in ([(1, None, "x", "yz"), rows[1]], [rows[0], (2, 3, "", None)], [rows[0], (2, None, None, "")], rows + rows[:1]):
        assert native(rows) != native(other)


def test_empty_etag_counts_as_absent(spark):
    cols = "source string, etag string, last_modified string, content_length string"
    saved = spark.createDataFrame([("a", "", "m1", "5"), ("b", "", None, None), ("c", "e", "m", "1")], cols)
    now = spark.createDataFrame([("a", "", "m2", "5"), ("b", "", None, None), ("c", "e", "x", "2")], cols)
    assert {r.source: r.matches for r in rl.metadata_matches(saved, now).collect()} == {"a": False, "b": False, "c": True}
