"""Operators 1 and 6 join answers by a key of the text: different texts with one hash must not get each other's."""

import random

import pytest
from pyspark.sql import functions as F

from ratingsmith.llm import common, jaccard_join, substring_dedup
from tests.llm.helpers import documents, near, prose
from tests.llm.test_jaccard_join import brute as groups
from tests.llm.test_substring_dedup import brute as kept


@pytest.fixture(params=[common.TWINS, 2])
def colliding(request, monkeypatch):
    """Only eight values of the first key: few twins move to another key, or, beyond TWINS, all texts do."""
    whole = common.text_key
    monkeypatch.setattr(common, "text_key", lambda text: F.pmod(whole(text), F.lit(8)))
    monkeypatch.setattr(common, "TWINS", request.param)


def _rows(seed):
    rng = random.Random(seed)
    shared = prose(rng, 45)
    texts = [prose(rng, rng.randint(40, 90)) for _ in range(12)]
    texts += [near(rng, t, 0.01) for t in texts[:4]] + texts[2:5] + [None, "", "one"]
    texts += [prose(rng, 20) + "\n" + shared + "\n" + prose(rng, 25) for _ in range(3)]
    return list(enumerate(texts))


def test_keys_differ_where_texts_do(spark, colliding):
    df = documents(spark, _rows(1))
    rows = df.select(F.coalesce("text", F.lit("")).alias("t"), common.distinct_key(df, "text").alias("k")).distinct().collect()
    assert len({r.k for r in rows}) == len({r.t for r in rows}) == len(rows)


def test_a_key_without_twins_stays(spark):
    df = documents(spark, _rows(2))
    assert df.filter(common.distinct_key(df, "text") != common.text_key("text")).isEmpty()
    assert documents(spark, []).select(common.distinct_key(documents(spark, []), "text")).isEmpty()


def test_join_with_colliding_keys(spark, colliding):
    rows = _rows(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(documents(spark, rows)).collect()}
    assert [got[d] for d, _ in rows] == groups(rows)
    stay = {r.doc_id for r in jaccard_join.representatives(documents(spark, rows)).collect()}
    assert stay == {d for d, (n, c) in zip((d for d, _ in rows), groups(rows), strict=True) if not n or c == d}


def test_passages_with_colliding_keys(spark, colliding):
    rows = _rows(4)
    got = {r.doc_id: (r.text, r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(documents(spark, rows)).collect()}
    want = kept([t or "" for _, t in rows], substring_dedup.WINDOW)
    assert [got[d] for d, _ in rows] == want
    assert any(gone for *_, gone in want) and any(not gone for *_, gone in want)
