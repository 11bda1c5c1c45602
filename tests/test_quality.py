import datetime as dt

from pyspark.sql import functions as F

from ratingsmith.operators import quality as qc
from ratingsmith.operators import runlog as rl


def test_orphans(spark):
    fact = spark.createDataFrame([(1, 1), (1, 9)], "user_id int, movie_id int")
    dim = spark.createDataFrame([(1,)], "movie_id int")
    r = qc.orphans(fact, dim, "movie_id", "fact_ratings").first()
    assert r.observed == 1.0 and r.passed is False


def test_drift(spark):
    prev = spark.createDataFrame([("a", 100), ("b", 100), ("c", 100), ("d", 0)], "table_name string, row_count long")
    cur = spark.createDataFrame([("a", 80), ("b", 81), ("c", 120), ("d", 5), ("e", 1)],
                                "table_name string, row_count long")
    got = {r.table_name: r.flagged for r in qc.drift(cur, prev, 0.20).collect()}
    assert got == {"a": True, "b": False, "c": True, "d": False, "e": False}


def test_null_range_dup_contract(spark):
    df = spark.createDataFrame([(1, "x" * 10, 0.5), (1, None, 1.5), (None, "y", 0.2)],
                               "k int, s string, v double")
    assert qc.null_keys(df, "t", ["k"]).first().observed == 1.0
    rng = {r.check_name: r.passed for r in qc.value_range(df, "v", 0.0, 1.0, "t").collect()}
    assert rng == {"v_min": False, "v_max": False}
    assert qc.duplicate_keys(df, ["k"], "t").first().observed == 1.0
    assert qc.contract_violations(df, "t", ["k", "s"], {"s": 5}).first().observed == 3.0


def test_row_floor_and_min_rows(spark):
    a = spark.range(89)
    b = spark.range(100)
    r = qc.row_floor(a, b, "fact").first()
    assert (r.observed, r.threshold, r.passed) == (89.0, 90.0, False)
    counts = qc.row_counts({"x": a, "y": b})
    got = {r.table_name: r.passed for r in qc.min_rows(counts, {"x": 90, "y": 1, "z": 1}).collect()}
    assert got == {"x": False, "y": True, "z": False}


def test_fingerprint(spark):
    df = spark.createDataFrame([(i, f"s{i}") for i in range(50)], "a int, b string")
    f1 = rl.fingerprint(df, "t").first()
    f2 = rl.fingerprint(df.repartition(7).orderBy(F.rand(3)), "t").first()
    f3 = rl.fingerprint(df.unionByName(df.limit(1)), "t").first()
    assert f1.fingerprint == f2.fingerprint and f1.row_count == f2.row_count
    assert f1.fingerprint != f3.fingerprint


def test_metadata_matches_priority(spark):
    cols = "source string, etag string, last_modified string, content_length string"
    saved = spark.createDataFrame([("a", "e1", "m1", "1"), ("b", None, "m1", "1"), ("c", None, None, "5"),
                                   ("d", None, None, None)], cols)
    cur = spark.createDataFrame([("a", "e1", "m2", "2"), ("b", "e9", "m2", "1"), ("c", None, "m", "5"),
                                 ("d", "e", None, None), ("e", "x", None, None)], cols)
    got = {r.source: r.matches for r in rl.metadata_matches(saved, cur).collect()}
    assert got == {"a": True, "b": False, "c": True, "d": False, "e": False}


def test_changed_tables(spark):
    cur = spark.createDataFrame([("r", 1, "10"), ("m", 2, "20")], "table_name string, row_count long, fingerprint string")
    old = spark.createDataFrame([("r", 1, "10"), ("m", 2, "21")], "table_name string, row_count long, fingerprint string")
    assert {r.table_name: r.changed for r in rl.changed_tables(cur, old).collect()} == {"r": False, "m": True}
    assert all(r.changed for r in rl.changed_tables(cur, None).collect())


def test_hashed_duplicate_keys_count_as_the_plain_ones(spark, monkeypatch):
    """Only rows that may share a key are grouped; NULLs are equal, and any number of rows may share keys."""
    monkeypatch.setattr(qc, "HASHES", 50)
    pairs = [(i % 40, i // 40) for i in range(400)]
    for more in ([], [(3, 4), (3, 4), (7, 0)], [(None, 4), (None, 4), (4, None)], pairs[:300] + [(None, None)] * 3):
        df = spark.createDataFrame(pairs + more, "a int, b int").repartition(5)
        plain, hashed = (qc.duplicate_keys(df, ["a", "b"], "t", hashed=h).collect() for h in (False, True))
        assert plain == hashed
    unique = spark.createDataFrame(pairs, "a int, b int")
    assert qc.repeated_cells(unique, ["a", "b"]).count() == 0
    assert qc.duplicate_keys(unique.limit(0), ["a", "b"], "t", hashed=True).first().observed == 0


def _tables(spark, root):
    """A few rows of every input table of the star."""
    write = lambda t, rows, ddl: spark.createDataFrame(rows, ddl).write.parquet(f"{root}/{t}.parquet")
    n = range(1, 41)
    day = dt.datetime(2020, 1, 1)
    write("lineitem", [(i, i % 9 + 1, float(i % 11 + 1), day + dt.timedelta(days=i)) for i in n],
          "l_orderkey long, l_partkey long, l_quantity double, l_shipdate timestamp_ntz")
    write("orders", [(i, i % 7, "F", 10.0 * i, day) for i in n],
          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz")
    write("part", [(i, f"red part{i}", "BRASS", i) for i in range(1, 10)], "p_partkey long, p_name string, p_type string, p_size int")
    write("events", [(i, day, i, "view") for i in n], "event_id long, ts timestamp_ntz, user_id long, event_type string")
    write("embeddings", [(i, [1.0, float(i % 3)]) for i in range(12)], "vec_id long, embedding array<float>")


def test_pairs_of_items_are_not_written_for_a_check(spark, tmp_dir):
    from ratingsmith.plans import catalog, staging
    _tables(spark, tmp_dir)
    before = set(staging._written)
    for name in ("row_counts", "drift", "contract_check", "pk_check"):
        got = {r.table_name: r for r in catalog.QUERIES[name](spark, tmp_dir).collect()}
        assert len(got) == 6
        if name == "row_counts":
            assert got["tag_similarity"].row_count == 12 * 11 // 2 - 16        # all but those of the first and last direction
    written = {name for _, name, _ in set(staging._written) - before}
    assert "star_fact_ratings" in written and "star_tag_similarity" not in written
