import numpy as np

from ratingsmith.operators import similarity as sim

SCHEMA = "movieId int, tagId int, relevance double"


def _vecs(spark, vectors):
    rows = [(i, t, float(v)) for i, vec in vectors.items() for t, v in vec.items()]
    return spark.createDataFrame(rows, SCHEMA)


def _pairs(df):
    return {(r.movie_id_a, r.movie_id_b): r.similarity for r in df.collect()}


def test_cosine_cases(spark):
    v = _vecs(spark, {1: {0: 1, 1: 0}, 2: {0: 1, 1: 0}, 3: {0: 0, 1: 1}, 4: {0: 1, 1: 1}, 5: {0: 0, 1: 0}})
    got = _pairs(sim.cosine_pairs(v, threshold=None))
    assert got[(1, 2)] == 1.0
    assert got[(1, 3)] == 0.0
    assert got[(1, 4)] == 0.7071
    assert got[(1, 5)] is None


def test_sparse_norms(spark):
    v = _vecs(spark, {1: {1: 1, 2: 1}, 2: {1: 1}})
    assert _pairs(sim.cosine_pairs(v, threshold=None, norms="full")) == {(1, 2): 0.7071}
    assert _pairs(sim.cosine_pairs(v, threshold=None, norms="shared")) == {(1, 2): 1.0}


def test_threshold_after_rounding(spark):
    v = _vecs(spark, {1: {0: 1, 1: 0}, 2: {0: 1, 1: 1}, 3: {0: 1, 1: 0.001}})
    got = _pairs(sim.cosine_pairs(v, threshold=0.7071))
    assert (1, 2) not in got and got[(1, 3)] == 1.0


def test_blocks_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    mat = np.abs(rng.normal(size=(60, 8)))
    v = _vecs(spark, {i: dict(enumerate(row)) for i, row in enumerate(mat)})
    one = _pairs(sim.cosine_pairs(v, threshold=0.8, num_blocks=1))
    many = _pairs(sim.cosine_pairs(v, threshold=0.8, num_blocks=9))
    tiled = _pairs(sim.cosine_pairs(v, threshold=0.8, num_blocks=2, tile_bytes=3 * 48 * 8))
    unit = mat / np.linalg.norm(mat, axis=1, keepdims=True)
    cos = unit @ unit.T
    want = {(a, b): round(cos[a, b], 4) for a in range(60) for b in range(a + 1, 60)
            if round(cos[a, b], 4) > 0.8}
    assert one == many == tiled
    assert one == _pairs(sim.cosine_pairs(v, threshold=0.8))
    assert set(one) == set(want)
    assert all(abs(one[k] - want[k]) < 1e-9 for k in want)


def test_symmetric_and_within_range(spark):
    rng = np.random.default_rng(2)
    mat = rng.normal(size=(30, 5))
    v = _vecs(spark, {i: dict(enumerate(row)) for i, row in enumerate(mat)})
    got = _pairs(sim.cosine_pairs(v, threshold=None, num_blocks=8))
    assert len(got) == 30 * 29 // 2 and all(-1 <= s <= 1 for s in got.values())
    both = sim.symmetric_pairs(sim.cosine_pairs(v, threshold=None)).collect()
    d = {(r.item, r.neighbour): r.similarity for r in both}
    assert all(d[(a, b)] == d[(b, a)] for a, b in d)


def test_neighbour_lookup(spark):
    pairs = spark.createDataFrame([(1, 5, 0.9), (5, 9, 0.8)], "movie_id_a int, movie_id_b int, similarity double")
    assert sorted(r.neighbour for r in sim.neighbours_of(pairs, 5).collect()) == [1, 9]
    items = spark.createDataFrame([(1, "a"), (5, "b"), (9, "c")], "movie_id int, clean_title string")
    top = sim.neighbours(pairs, items, k=1).collect()
    assert sorted((r.movie_id, r.neighbour_id, r["rank"]) for r in top) == [(1, 5, 1), (5, 1, 1), (9, 5, 1)]


def test_tile_pruning_loses_no_pair(spark):
    """Sparse items around different keys: most tile pairs are bounded below the threshold."""
    rng = np.random.default_rng(8)
    vecs = {i: {int(10 * (i % 6) + k): float(rng.random() + 0.1) for k in rng.choice(10, 4, replace=False)} for i in range(90)}
    v = _vecs(spark, vecs)
    got = _pairs(sim.cosine_pairs(v, threshold=0.7, num_blocks=2, tile_bytes=5 * 48 * 60))
    dense = np.zeros((90, 60))
    for i, vec in vecs.items():
        for k, x in vec.items():
            dense[i, k] = x
    unit = dense / np.linalg.norm(dense, axis=1, keepdims=True)
    cos = unit @ unit.T
    assert set(got) == {(a, b) for a in range(90) for b in range(a + 1, 90) if round(cos[a, b], 4) > 0.7}


def test_repeated_keys_are_summed(spark):
    rows = [(1, 0, 0.5), (1, 0, 0.5), (1, 1, 1.0), (2, 0, 1.0), (2, 1, 1.0)]
    assert _pairs(sim.cosine_pairs(spark.createDataFrame(rows, SCHEMA), threshold=None)) == {(1, 2): 1.0}


def test_top_k_kernel_keeps_every_neighbour(spark):
    rng = np.random.default_rng(4)
    mat = np.round(np.abs(rng.normal(size=(50, 4))), 1)          # coarse values: many ties
    v = _vecs(spark, {i: dict(enumerate(row + 0.1)) for i, row in enumerate(mat)})
    items = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "movie_id int, clean_title string")
    rows = lambda pairs: sorted(map(tuple, sim.neighbours(pairs, items, k=3).collect()))
    every = sim.cosine_pairs(v, threshold=0.5, sort=False)
    few = sim.cosine_pairs(v, threshold=0.5, sort=False, top_k=3, num_blocks=3)
    assert rows(every) == rows(few) and few.count() < every.count()


def _sparse_rows(seed, items=120, keys=60, per=6):
    import random
    rng = random.Random(seed)
    rows = [(i, k, rng.choice([1, 1, 2, -1]) * rng.random()) for i in range(items) for k in rng.sample(range(keys), per)]
    rows += [(200 + i, k, 0.5) for i in range(6) for k in range(5)]                      # equal vectors
    rows += [(300, 1, 0.0), (301, 2, None), (None, 3, 1.0), (302, 4, 1.0), (303, 4, 2.0), (303, 4, 1.0)]
    return rows


def test_sparse_join_equals_all_pairs_and_compares_few(spark):
    from ratingsmith.operators import similarity as sim
    from ratingsmith.operators import sparse_similarity as sparse
    rows = _sparse_rows(1)
    df = spark.createDataFrame(rows, "movieId int, tagId int, relevance double")
    for threshold in (0.3, 0.8):
        got = sparse.cosine_join(df, threshold=threshold)
        want = sim.cosine_pairs(df.dropna(), threshold=threshold, num_blocks=2)
        as_set = lambda d: {(r[0], r[1], round(r[2], 4)) for r in d.collect()}
        assert as_set(got.pairs) == as_set(want) and want.count() >= 16
        items = len({r[0] for r in rows})
        assert got.compared.count() < 0.2 * items * (items - 1) / 2
        assert got.compared.count() <= got.candidates.count()


def test_sparse_join_needs_a_threshold_and_takes_no_rows(spark):
    import pytest
    from ratingsmith.operators import sparse_similarity as sparse
    empty = spark.createDataFrame([], "movieId int, tagId string, relevance double")
    assert sparse.cosine_join(empty, threshold=0.5).pairs.collect() == []
    with pytest.raises(ValueError):
        sparse.cosine_join(empty, threshold=0.0)


def _group(vectors, lo=0, hi=0):
    import pyarrow as pa
    n, keys = vectors.shape
    return pa.RecordBatch.from_pydict({"movieId": pa.array(range(n), pa.int32()), "keys": [list(range(keys))] * n, "vals": vectors.tolist(),
                                       "_blk": [lo if i < n // 2 else hi for i in range(n)], "_blo": [lo] * n, "_bhi": [hi] * n})


def test_pairs_leave_a_task_a_few_tiles_at_a_time(monkeypatch):
    """However many pairs pass, a task holds those of a few tiles."""
    monkeypatch.setattr(sim, "ROWS_SENT", 100)
    group = _group(np.ones((60, 4)))
    for top_k, pairs in ((None, 60 * 59 // 2), (3, 3 * 57 + 3)):
        sent = list(sim._pair_kernel("movieId", 0.5, False, 1e-4, top_k, 8 * 48 * 4, 4)(iter([group])))
        assert sum(len(b) for b in sent) == pairs and len(sent) >= 2 and max(len(b) for b in sent) <= 100


def test_top_k_of_equal_vectors_sends_no_more_than_k_pairs_an_item(spark):
    v = _vecs(spark, {i: {0: 1, 1: 2} for i in range(60)})
    items = spark.createDataFrame([(i, f"t{i}") for i in range(60)], "movie_id int, clean_title string")
    few = sim.cosine_pairs(v, threshold=0.5, sort=False, top_k=3, num_blocks=2)
    assert few.count() <= 3 * 60 * 2
    rows = lambda pairs: sorted(map(tuple, sim.neighbours(pairs, items, k=3).collect()))
    assert rows(few) == rows(sim.cosine_pairs(v, threshold=0.5, sort=False))


def test_sparse_join_moves_vectors_and_no_candidates(spark, monkeypatch):
    """A key's vectors meet block by block, and a pair with several shared keys in one group only."""
    from ratingsmith.operators import sparse_similarity as sparse
    df = spark.createDataFrame(_sparse_rows(2), "movieId int, tagId int, relevance double")
    as_list = lambda d: sorted(tuple(r) for r in d.collect())
    whole = sparse.cosine_join(df, threshold=0.4)
    monkeypatch.setattr(sparse, "KEY_ITEMS", 4)
    cut = sparse.cosine_join(df, threshold=0.4)
    assert as_list(cut.pairs) == as_list(whole.pairs) and as_list(cut.compared) == as_list(whole.compared)
    assert cut.candidates.count() == cut.candidates.select("a", "b").distinct().count() == whole.candidates.count()
    plan = cut.pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "Aggregate [a" not in plan and "Aggregate [ia" not in plan


def test_pairs_leave_a_task_rounded_and_without_a_decimal_each(spark):
    v = _vecs(spark, {1: {0: 1, 1: 0}, 2: {0: 1, 1: 1}, 3: {0: 1, 1: 0.001}, 4: {0: 0, 1: 0}})
    for norms in ("full", "shared"):
        pairs = sim.cosine_pairs(v, threshold=0.5, sort=False, norms=norms)
        plan = pairs._jdf.queryExecution().optimizedPlan().toString()
        assert "decimal" not in plan and "Filter (similarity" not in plan
        assert _pairs(pairs) == {(1, 2): 0.7071, (1, 3): 1.0, (2, 3): 0.7078}
    # neither NULL items nor vectors without a norm have pairs, and no norm is less than any threshold
    rows = [(None, 0, 1.0), (1, 0, 1.0), (2, 0, -1.0), (3, 0, 0.0)]
    low = sim.cosine_pairs(spark.createDataFrame(rows, SCHEMA), threshold=-2.0, sort=False)
    assert _pairs(low) == {(1, 2): -1.0}
    every = sim.cosine_pairs(spark.createDataFrame(rows, SCHEMA), threshold=None, sort=False, top_k=2)
    assert _pairs(every) == {(1, 2): -1.0, (1, 3): None, (2, 3): None}
