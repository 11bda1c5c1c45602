import duckdb
import numpy as np
import pytest

from ratingsmith.llm import quality_fm as op
from ratingsmith.llm import queries
from tests.llm.helpers import by_id

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = by_id(queries.QUERIES["op4_quality_fm"](spark, SF).collect())
    truth = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    held = [d for d in truth if got[d].held_out]
    assert len(held) > 80
    for label in (0, 1):
        own = [d for d in held if truth[d] == label]
        assert sum(got[d].predicted == label for d in own) >= 0.95 * len(own)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_linear_time_identity_equals_all_pairs():
    rng = np.random.default_rng(1)
    m = op.Model(0.3, rng.normal(size=7), rng.normal(size=(7, 3)), np.zeros(1), np.ones(1))
    x = rng.normal(size=(5, 7))
    want = [0.3 + r @ m.linear + sum(m.factors[i] @ m.factors[j] * r[i] * r[j] for i in range(7) for j in range(i + 1, 7)) for r in x]
    assert np.allclose(m.raw(x), want)


def test_factors_learn_an_interaction():
    """Exclusive-or of two words, which no linear model separates."""
    rng = np.random.default_rng(2)
    bag = np.zeros((600, op.WORDS), np.float32)
    a, b = rng.integers(0, 2, 600), rng.integers(0, 2, 600)
    bag[:, 5], bag[:, 9], bag[:, 77] = 4 * a, 4 * b, 4
    y = a ^ b
    m = op.train(bag, np.zeros((600, len(op.STATS)), np.float32), y, epochs=60)
    assert ((m.score(bag, np.zeros((600, len(op.STATS)))) >= 0.5) == y).mean() > 0.97


@pytest.fixture(scope="module")
def tables(spark):
    good, bad = "a calm river runs past the old mill and on to the sea ", "buy $$$ now!! "
    rows = [(i, (good if i % 2 else bad) * (1 + i % 5), None if i % 7 == 0 else 10, "x") for i in range(60)]
    rows += [(None, good, 1, None), (100, None, None, None), (101, "", 0, "y"), (101, "", 0, "y"), (102, good * 40_000, 5, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(3, 1), (None, 0), (51, None), (999, 1)], "doc_id long, quality int")
    return docs, labels


def test_defined_cases(spark, tables):
    docs, labels = tables
    model = op.fit(docs, labels)
    out = op.score(docs, model, keep_text=True)
    assert out.columns == ["doc_id", "text", "n_chars", "score"]
    rows = out.collect()
    assert len(rows) == docs.count()
    got = by_id(rows)
    assert all((got[i].score >= 0.5) == bool(i % 2) for i in range(60))
    assert got[None].score >= 0.5 and got[102].score >= 0.5
    assert op.score(docs, model).columns == ["doc_id", "n_chars", "score"]
    assert op.score(docs.limit(0), model).count() == 0
    assert op.score(docs, model, length=None).count() == len(rows)


def test_same_model_from_any_partitioning(spark, tables):
    docs, labels = tables
    a, b = op.fit(docs, labels), op.fit(docs.repartition(7), labels.repartition(3))
    assert a.bias == b.bias and np.array_equal(a.factors, b.factors)


def test_without_labels(spark, tables):
    docs, labels = tables
    model = op.fit(docs, labels.limit(0))
    assert {r.score for r in op.score(docs, model).collect()} == {0.5}


def test_one_whole_row_of_a_labelled_id(spark):
    """Rows of one id with different texts: the model is that of one of them."""
    texts = ("one two three", "ten ten ten eleven eleven twelve")
    base = [(i, ("calm river " if i % 2 else "buy $$$ now ") * (1 + i % 3), 10) for i in range(6)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(7)], "doc_id long, quality int")
    fit = lambda *t: op.fit(spark.createDataFrame(base + [(6, x, 10) for x in t], "doc_id long, text string, n_chars long"), labels)
    both, single = fit(*texts), [fit(t) for t in texts]
    assert any(np.array_equal(both.linear, m.linear) and np.array_equal(both.mean, m.mean) for m in single)
