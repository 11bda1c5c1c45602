import math

import numpy as np
import pytest

from ratingsmith.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n string, row string"


def reference(vectors, components=4):
    x = np.floor(256 * np.array(vectors, np.float64)).astype(np.int64)
    once = np.unique(x, axis=0)
    n, s = len(once), once.sum(axis=0)
    c = once - s / n
    values, vecs = np.linalg.eigh(c.T @ c / n)
    values, vecs = values[::-1][:components], vecs[:, ::-1][:, :components]
    return n, [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s, strict=True)) for r in x], (x - s / n) @ vecs / np.sqrt(values), values


def vectors(seed, rows, dim=6):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(rows, dim)) * np.arange(1, dim + 1)).astype(np.float32).tolist()


@pytest.mark.parametrize("block, panel", [(whitening.BLOCK, whitening.PANEL), (1, 2)])
def test_equals_numpy(spark, monkeypatch, block, panel):
    monkeypatch.setattr(whitening, "BLOCK", block)
    monkeypatch.setattr(whitening, "PANEL", panel)
    good = vectors(1, 150)
    good += [good[0]] * 80                                  # one vector, many rows: once in the fit
    bad = [None, [], [None] * 6, [math.nan] * 6, [1.0, math.inf, 0.0, 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = [(i if i % 50 else None, v, "mine", "r") for i, v in enumerate(good)] + [(900 + i, v, "bad", "r") for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = whitening.whiten(df)
    assert out.columns == ["vec_id", "n", "row", "component", "deviation", "whitened", "explained", "identity_error"]
    n, deviation, z, values = reference(good)
    got = out.collect()
    assert len(got) == 4 * len(good) and all(r.n == n for r in got)
    assert max(r.identity_error for r in got) < 1e-9
    sign = {}
    for r in got:
        if r.vec_id is None:
            continue
        want = z[r.vec_id, r.component - 1]
        sign.setdefault(r.component, math.copysign(1, want * r.whitened))
        assert abs(r.whitened * sign[r.component] - want) < 1e-9
        assert r.deviation == deviation[r.vec_id]
        assert abs(r.explained - values[r.component - 1] / np.trace(np.cov(np.unique(np.floor(256 * np.array(good)), axis=0).T, bias=True))) < 1e-9


def test_low_rank_gives_fewer_components(spark):
    flat = [[float(i), 2.0 * i, 1.0] for i in range(20)]
    got = whitening.whiten(spark.createDataFrame([(i, v, "", "") for i, v in enumerate(flat)], SCHEMA)).collect()
    assert {r.component for r in got} == {1} and len(got) == 20
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], "", "")] * 3, SCHEMA))
    assert one.collect() == []


def test_empty_table(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []


def test_large_entries_do_not_overflow(spark):
    big = [[3e13, 1.0], [-3e13, 2.0], [1e13, -1.0]]
    got = whitening.whiten(spark.createDataFrame([(i, v, "", "") for i, v in enumerate(big)], SCHEMA)).collect()
    assert {r.vec_id for r in got} == {0, 1, 2} and all(r.deviation is None for r in got)
