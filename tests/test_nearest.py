"""The k nearest by floors against brute force; what it skips and emits is counted."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingsmith.operators import nearest

SCHEMA = "movieId long, tagId int, relevance double"


def _rows(mat, first=0):
    return [(first + i, k, float(x)) for i, row in enumerate(mat) for k, x in enumerate(row) if x]


def _brute(mat, k, threshold=None):
    unit = mat / np.linalg.norm(mat, axis=1, keepdims=True)
    cos = unit @ unit.T
    sim = np.sign(cos) * (np.rint(np.abs(cos) * 1e12).astype(np.int64) + 5 * 10 ** 7) // 10 ** 8 / 1e4
    sim = np.where(cos < 0, -((np.rint(-cos * 1e12).astype(np.int64) + 5 * 10 ** 7) // 10 ** 8) / 1e4, sim)
    want = []
    for i in range(len(mat)):
        near = sorted(((-sim[i, j], j) for j in range(len(mat)) if j != i and (threshold is None or sim[i, j] > threshold)))
        want += [(i, j, -s, r + 1) for r, (s, j) in enumerate(near[:k])]
    return sorted(want)


def _top(found):
    return sorted((r.item, r.neighbour, r.similarity, r["rank"]) for r in found.top.collect())


@pytest.fixture(scope="module")
def grouped():
    """480 vectors in 24 narrow groups."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(24, 12))
    return centres[rng.integers(0, 24, 480)] + rng.normal(scale=0.06, size=(480, 12))


def test_grouped_vectors_skip_most_pairs(spark, grouped):
    k = 4
    found = nearest.top_k(spark.createDataFrame(_rows(grouped), SCHEMA), k, block_items=12)
    assert _top(found) == _brute(grouped, k)
    skipped, compared = found.skipped.count(), found.compared.count()
    assert skipped > 4 * compared > 0
    blocks = found.compared.filter("lo = hi").count()
    assert skipped + compared == blocks * (blocks + 1) // 2
    assert found.emitted.count() <= 3 * k * len(grouped)


def test_even_vectors_and_every_layout_agree(spark):
    rng = np.random.default_rng(5)
    mat = rng.normal(size=(90, 5))
    df = spark.createDataFrame(_rows(mat), SCHEMA)
    for threshold in (None, 0.5, 0.99):
        want = _brute(mat, 3, threshold)
        for options in (dict(), dict(block_items=7), dict(block_items=30, probe=0, tile_bytes=8 * 4 * 5 * 4)):
            assert _top(nearest.top_k(df, 3, threshold=threshold, **options)) == want


def test_copies_and_ties_send_at_most_k_rows_a_pair(spark):
    """A third of all items is one vector: ties go to the smaller neighbour, and no block pair sends more than k an item."""
    rng = np.random.default_rng(6)
    mat = np.concatenate((np.tile([[1.0, 2.0, 0.0, 1.0]], (40, 1)), np.round(np.abs(rng.normal(size=(80, 4))), 1) + 0.1))
    found = nearest.top_k(spark.createDataFrame(_rows(mat), SCHEMA), 3, block_items=15)
    assert _top(found) == _brute(mat, 3)
    pairs = found.compared.count()
    assert found.emitted.groupBy("item").count().agg(F.max("count")).first()[0] <= 3 * pairs


def test_odd_rows(spark):
    rows = [(1, 0, 0.5), (1, 0, 0.5), (1, 1, 1.0),        # repeated keys are summed
            (2, 0, 1.0), (2, 1, 1.0), (2, 2, None),       # a NULL value is left out
            (3, 0, 0.0), (None, 1, 1.0), (4, None, 1.0),  # no vector at all
            (5, 7, -1.0), (5, 0, 0.0)]                    # nothing in common
    df = spark.createDataFrame(rows, SCHEMA)
    assert _top(nearest.top_k(df, 2, threshold=0.0)) == [(1, 2, 1.0, 1), (2, 1, 1.0, 1)]
    assert _top(nearest.top_k(df, 2)) == [(1, 2, 1.0, 1), (1, 5, 0.0, 2), (2, 1, 1.0, 1), (2, 5, 0.0, 2), (5, 1, 0.0, 1), (5, 2, 0.0, 2)]
    empty = nearest.top_k(df.limit(0), 2)
    assert empty.top.columns == nearest.top_k(df, 2).top.columns and empty.top.count() == 0
    one = nearest.top_k(df.filter("movieId = 5"), 2)
    assert one.top.count() == 0 and one.skipped.count() == 0


def test_names_as_ids_and_keys(spark):
    df = spark.createDataFrame([("b", "x", 1.0), ("a", "x", 2.0), ("c", "y", 1.0), ("c", "x", 1.0)], "item string, block string, n double")
    got = nearest.top_k(df, 1, item="item", key="block", value="n").top
    assert sorted((r.item, r.neighbour, r.similarity) for r in got.collect()) == [("a", "b", 1.0), ("b", "a", 1.0), ("c", "a", 0.7071)]


def test_second_round_sends_a_vector_once_a_group_of_blocks(spark, monkeypatch):
    """Directions spread evenly: every block meets every other, but vectors move once for each group."""
    sent = []
    make = nearest._compare_groups

    def watch(*args):
        sent.append(args)
        return make(*args)

    monkeypatch.setattr(nearest, "_compare_groups", watch)
    mat = np.random.default_rng(3).normal(size=(240, 6))
    df = spark.createDataFrame([(i, j, float(x)) for i, row in enumerate(mat) for j, x in enumerate(row)],
                               "movieId int, tagId int, relevance double")
    got = nearest.top_k(df, 4, block_items=5)
    unit = mat / np.linalg.norm(mat, axis=1, keepdims=True)
    cos = np.round(unit @ unit.T, 4)
    np.fill_diagonal(cos, -9)
    want = {(i, int(j)) for i in range(240) for j in np.lexsort((np.arange(240), -cos[i]))[:4]}
    assert {(r.item, r.neighbour) for r in got.top.collect()} == want
    assert len(sent) == 1 and got.compared.count() > 240 // 5 * 3
