"""Physical-plan shape: pruning, broadcast of small sides, partial limits and aggregates."""

from ratingsmith.plans import catalog

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(catalog.QUERIES["clean_ratings"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in plan
    assert "PushedFilters: [IsNotNull(l_quantity)" in plan


def test_item_dimension_is_broadcast(spark):
    plan = _plan(catalog.QUERIES["genre_trends"](spark, SF))
    assert "BroadcastHashJoin" in plan


def test_ratings_reduced_before_item_join(spark):
    plan = _plan(catalog.QUERIES["decade_stats"](spark, SF))
    # per-item partial aggregate sits below the join with titles
    join_at = plan.index("BroadcastHashJoin")
    assert "partial_count" in plan[join_at:]


def test_top_k_uses_partial_group_limit(spark):
    plan = _plan(catalog.QUERIES["neighbours"](spark, SF))
    assert plan.count("WindowGroupLimit") >= 2          # one before and one after the shuffle


def _windows(plan: str, column: str) -> list[str]:
    return [line for line in plan.splitlines() if " Window [" in line and column in line]


def test_running_rows_are_windowed_once_by_entity_and_group(spark):
    plan = _plan(catalog.QUERIES["running_stats"](spark, SF))
    rows = [w for w in _windows(plan, "windowspecdefinition") if "AS _run_c" in w]
    assert len(rows) == 1
    keys = rows[0].split("windowspecdefinition(")[1]
    assert keys.startswith("_rs_entity") and "_rs_group" in keys.split(",")[1]
    assert "CartesianProduct" not in plan


def test_rolling_windows_run_over_daily_totals_only(spark):
    plan = _plan(catalog.QUERIES["rolling_30d_stats"](spark, SF))
    windows = [line for line in plan.splitlines() if " Window [" in line]
    assert len(windows) == 1 and "_roll_c" in windows[0]
    assert "HashAggregate" in plan[plan.index(windows[0]):]


def test_similarity_has_no_cartesian_product(spark):
    plan = _plan(catalog.QUERIES["tag_similarity"](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "FlatMapGroupsInPandas" in plan


def test_bucketed_fact_is_not_exchanged(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = catalog.QUERIES["movie_report"](spark, SF)
        assert "Exchange" not in _plan(df) and "SortMergeJoin" in _plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_only_the_csv_input_that_is_read_is_staged(spark, tmp_dir):
    import os

    from ratingsmith.sources import adapters
    from ratingsmith.sources import csv as csv_src
    raw, out = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "out")
    csv_src.write_inputs(adapters.load_inputs(spark, SF), raw)
    inputs = csv_src.read_inputs(spark, raw, out)
    assert not os.path.exists(out)
    assert inputs.ratings.count() == adapters.ratings(spark, SF).count()
    assert inputs.ratings is inputs.ratings and os.listdir(out) == ["ratings"]
