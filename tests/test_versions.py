"""Commits, concurrent appends, partial rebuilds and extended windows."""

import dataclasses
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from ratingsmith.operators import runlog as rl
from ratingsmith.operators import windows as win
from ratingsmith.plans import refresh as rf
from ratingsmith.plans import versions as vs
from ratingsmith.plans import warehouse as wh
from ratingsmith.sources import adapters, files

SF = "/root/testdata/sf0.001"
PARAMS = wh.StarParams(min_count=5, sim_threshold=0.7, sim_top_n=None)
TABLES = wh.WAREHOUSE_NOT_NULL


def content(spark, out):
    """Every table as sorted rows, without the time of writing."""
    read = {t: vs.read_table(spark, out, t) for t in TABLES}
    return {t: sorted(map(str, df.drop("created_at").collect())) for t, df in read.items()}


@pytest.fixture(scope="module")
def inputs(spark):
    return adapters.load_inputs(spark, SF)


def test_a_run_that_dies_at_any_table_leaves_the_version_before_it(spark, tmp_dir, inputs, monkeypatch):
    assert rf.refresh(spark, inputs, tmp_dir, "s", PARAMS).status == "success"
    before = content(spark, tmp_dir)
    half = dataclasses.replace(inputs, ratings=inputs.ratings.filter("userId % 2 = 0"))
    write, n = wh.write_table, [0]
    for boundary in range(1, 10):                 # three clean tables and six of the star
        n[0] = 0

        def dies(*args, boundary=boundary, **kwargs):
            path = write(*args, **kwargs)
            n[0] += 1
            if n[0] == boundary:
                raise OSError("the process dies here")
            return path

        monkeypatch.setattr(wh, "write_table", dies)
        with pytest.raises(OSError):
            rf.refresh(spark, half, tmp_dir, "s", PARAMS)
        assert vs.latest(spark, tmp_dir).version == 1
        monkeypatch.setattr(wh, "write_table", write)
    assert content(spark, tmp_dir) == before
    assert rf.refresh(spark, inputs, tmp_dir, "s", PARAMS).status == "skipped"
    # the other run can be done later, and leaves nothing of the broken ones behind after one more commit
    assert rf.refresh(spark, half, tmp_dir, "s", PARAMS).status == "success"
    assert content(spark, tmp_dir) != before
    fact = os.path.join(tmp_dir, "warehouse", "fact_ratings")
    assert len([v for v in os.listdir(fact) if v.startswith("v=")]) == 2
    assert vs.running(spark, tmp_dir) == []


def test_failed_checks_do_not_commit(spark, tmp_dir, inputs):
    assert rf.refresh(spark, inputs, tmp_dir, "s", PARAMS).status == "success"
    before = content(spark, tmp_dir)
    long = dataclasses.replace(inputs, movies=inputs.movies.withColumn("title", F.rpad("title", 600, "x")))
    broken = rf.refresh(spark, long, tmp_dir, "s", PARAMS)
    assert broken.status == "failed" and broken.failed_checks == 2 and broken.version is None
    assert content(spark, tmp_dir) == before
    assert rf.refresh(spark, inputs, tmp_dir, "s", PARAMS).status == "skipped"


def test_eight_appends_at_once_get_eight_ids(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log")
    with ThreadPoolExecutor(8) as pool:
        ids = list(pool.map(lambda i: rl.append_run(spark, path, f"h{i}", "success", i, 1), range(8)))
    assert sorted(ids) == list(range(1, 9))
    log = rl.read_log(spark, path).collect()
    assert sorted(r.run_id for r in log) == list(range(1, 9)) and sorted(r.rows_loaded for r in log) == list(range(8))
    assert all(r.run_date is not None for r in log)


def test_put_if_absent_and_conflicting_commits(spark, tmp_dir):
    path = os.path.join(tmp_dir, "x", "one")
    assert files.put_if_absent(spark, path, "a é") and not files.put_if_absent(spark, path, "b")
    assert files.read_text(spark, path) == "a é" and files.names(spark, os.path.dirname(path)) == ["one"]
    assert files.names(spark, os.path.join(tmp_dir, "none")) == []
    first = vs.commit(spark, tmp_dir, vs.Manifest("r1", {}))
    vs.commit(spark, tmp_dir, vs.Manifest("r2", {}))
    with pytest.raises(vs.Conflict):
        vs.commit(spark, tmp_dir, vs.Manifest("r3", {}), onto=first.version)
    assert vs.latest(spark, tmp_dir).run == "r2"


def test_partial_runs_equal_full_ones(spark, tmp_dir, inputs):
    """A year appended, late ratings of an earlier year, a year gone, other vectors: as a run from scratch."""
    year = F.year(F.timestamp_seconds("timestamp"))
    years = sorted(r[0] for r in inputs.ratings.select(year.alias("y")).distinct().collect())
    one_each = inputs.ratings.dropDuplicates(["userId", "movieId"])   # so that no rating displaces one of another year
    given = lambda cond: dataclasses.replace(inputs, ratings=one_each.filter(cond))
    late = (year == years[-2]) & (F.col("userId") % 3 == 0)
    steps = [(given((year < years[-1]) & ~late), None), (given(~late), [years[-1]]), (given(F.lit(True)), [years[-2]]),
             (given(year > years[0]), [years[0]])]
    steps.append((dataclasses.replace(steps[-1][0], genome_scores=inputs.genome_scores.filter("movieId % 2 = 0")), []))
    out = os.path.join(tmp_dir, "partial")
    for i, (step, rebuilt) in enumerate(steps):
        got = rf.refresh(spark, step, out, "s", PARAMS, incremental=True)
        assert got.status == "success" and (rebuilt is None or got.rebuilt_years == rebuilt)
        if i == 1:                      # earlier years are the first version's folders
            folders = vs.latest(spark, out).tables["fact_ratings"].folders
            assert len({f.split("/")[0] for f in folders}) == 2
            assert [f for f in folders if f.endswith(f"={years[-1]}")][0].split("/")[0] == f"v={vs.latest(spark, out).run}"
        if i in (2, 4):
            full = os.path.join(tmp_dir, f"full{i}")
            rf.refresh(spark, step, full, "s", PARAMS)
            assert content(spark, out) == content(spark, full)


def test_partial_fact_reads_changed_years_of_staging(spark, tmp_dir, inputs):
    year = F.year(F.timestamp_seconds("timestamp"))
    last = inputs.ratings.agg(F.max(year)).first()[0]
    one_each = inputs.ratings.dropDuplicates(["userId", "movieId"])
    rf.refresh(spark, dataclasses.replace(inputs, ratings=one_each.filter(year < last)), tmp_dir, "s", PARAMS, incremental=True)
    seen, write = {}, wh.write_table

    def watched(df, root, table, *args, **kwargs):
        seen[table] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, root, table, *args, **kwargs)

    wh.write_table = watched
    try:
        rf.refresh(spark, dataclasses.replace(inputs, ratings=one_each), tmp_dir, "s", PARAMS, incremental=True)
    finally:
        wh.write_table = write
    # every scan of the clean ratings is cut to the changed year, or to the days before it
    for table in ("fact_ratings", "item_years", "user_years"):
        scans = [x for x in seen[table].split("FileScan parquet")[1:] if "clean_ratings" in x]
        assert scans and all(f"rating_year#" in x.split("PartitionFilters:")[1].split("]")[0] for x in scans), table
        assert all(str(last) in x.split("PartitionFilters:")[1].split("DataFilters")[0].split("PushedFilters")[0] for x in scans), table
    for table in ("genre_trends", "decade_stats", "dim_users"):
        assert "clean_ratings" not in seen[table]


def test_extended_stats_equal_one_pass(spark):
    import datetime as dt
    import random
    rng = random.Random(4)
    day = lambda: None if rng.random() < 0.05 else dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(90))
    rows = [(rng.choice([None, 1, 2, 3]), day(), i, rng.randrange(1, 11) / 2) for i in range(300)]
    rows += [(9, dt.date(2020, 2, 1), 1000, 3.0)]          # only old, only new
    new = [(i % 5, day(), 2000 + i, 4.5) for i in range(60)] + [(10, None, 3000, 1.0)]
    schema = "item int, day date, seq int, rating double"
    old, fresh = spark.createDataFrame(rows, schema), spark.createDataFrame(new, schema)
    both = spark.createDataFrame(rows + new, schema)
    names = {"running": ("c", "a"), "rolling": ("rc", "ra")}
    stats = lambda df: win.entity_stats(df, ["item"], ["day", "seq"], "rating", **names)
    daily = win.daily_totals(old, ["item"], "day", "rating")
    got = win.extend_stats(stats(old), daily, fresh, ["item"], ["day", "seq"], "rating", **names)
    assert sorted(map(str, got.collect())) == sorted(map(str, stats(both).collect()))
    merged = win.merge_daily(daily, win.daily_totals(fresh, ["item"], "day", "rating"), ["item"], "day")
    assert sorted(map(str, merged.collect())) == sorted(map(str, win.daily_totals(both, ["item"], "day", "rating").collect()))
