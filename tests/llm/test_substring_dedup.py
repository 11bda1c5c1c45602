import random

import numpy as np
import pyarrow as pa
import pytest

from ratingsmith.llm import substring_dedup as op
from tests.llm.helpers import documents, prose, words_of


def brute(texts, window):
    """Kept words, words, removed words per text."""
    all_words = [words_of(t) for t in texts]
    seen = {}
    for w in all_words:
        for i in range(len(w) - window + 1):
            seen[tuple(w[i:i + window])] = seen.get(tuple(w[i:i + window]), 0) + 1
    out = []
    for w in all_words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((" ".join(x for i, x in enumerate(w) if i not in gone), len(w), len(gone)))
    return out


SMALL = dict(window=7, period=3, anchor=5, cover=(0, 1))
CASES = [
    ["a b c d e f g h", "x a b c d e f g", "a b c d e f"],
    ["", None, "one", "\t\n ", " é ü  one "],
    ["the " * 40, "the " * 6, "the " * 7],                       # overlaps with itself
    ["p q r s t u v w x y z", "p q r s t u v w x y z", "p q r s t u v"],
    ["no\x85break here\xa0at all in this one line of words", "no\x85break here\xa0at all in this one"],
]


@pytest.mark.parametrize("texts", CASES)
def test_small_cases(spark, texts):
    df = documents(spark, list(enumerate(texts)))
    got = {r.doc_id: (r.text, r.n_words, r.n_removed) for r in op.remove_repeats(df, **SMALL).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 7)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("flush", [op.FLUSH, 40])
def test_random_with_shared_passages(spark, seed, flush, monkeypatch):
    monkeypatch.setattr(op, "FLUSH", flush)                      # small gatherings: repeats meet in the buckets
    rng = random.Random(seed)
    shared = [prose(rng, rng.randint(30, 60)) for _ in range(4)]
    texts = []
    for _ in range(60):
        bits = [prose(rng, rng.randint(0, 50)) for _ in range(3)]
        for _ in range(rng.randint(0, 2)):
            bits.insert(rng.randrange(len(bits)), " ".join(words_of(rng.choice(shared))[rng.randrange(8):]))
        texts.append("\n".join(bits))
    texts += texts[:3]
    df = documents(spark, list(enumerate(texts))).repartition(5)
    got = {r.doc_id: (r.text, r.n_words, r.n_removed) for r in op.remove_repeats(df).collect()}
    want = brute(texts, op.WINDOW)
    assert [got[i] for i in range(len(texts))] == want
    assert any(x[2] for x in want) and any(0 < x[2] < x[1] for x in want)


def test_long_text_is_worked_on_in_segments(spark, monkeypatch):
    rng = random.Random(3)
    long = prose(rng, 400_000, 10**6)                           # about 3 MB: several segments
    tail = " ".join(words_of(long)[200_000:200_100])
    got = {r.doc_id: (r.n_words, r.n_removed) for r in op.remove_repeats(documents(spark, [(1, long), (2, tail)])).collect()}
    assert got == {1: (400_000, 100), 2: (100, 100)}


def test_odd_columns_and_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text, "a", 1), (None, text, None, None), (3, None, "k", 2), (3, None, "k", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, k string, places int")
    out = op.remove_repeats(df.withColumnsRenamed({"places": "n_words"}))
    assert out.columns == ["doc_id", "text", "k", "n_words", "n_removed"]
    assert sorted((r.k or "", r.text, r.n_words, r.n_removed) for r in out.collect()) == [
        ("", "", 40, 40), ("a", "", 40, 40), ("k", "", 0, 0), ("k", "", 0, 0)]
    assert op.remove_repeats(df.limit(0)).count() == 0


def test_cover_is_checked(spark):
    df = documents(spark, [(1, "x")])
    with pytest.raises(ValueError):
        op.remove_repeats(df, cover=(0, 1, 2))
    with pytest.raises(ValueError):
        op.remove_repeats(df, window=36)


def sent(batches, name, dtype):
    return sum(len(x.as_py()) // dtype().itemsize for b in batches for x in b[name])


def test_copies_cost_one_entry_a_gathering():
    words = prose(random.Random(5), 250, 10**6)
    n, copies = 8, 400
    h, p = np.arange(216, dtype=np.uint64) << np.uint64(40), np.arange(216, dtype=np.uint32)
    got = list(op.entries(np.tile(h, copies), h[:0], np.full(216 * copies, 77, np.uint64), np.tile(p, copies), n))
    assert (sent(got, "h", np.uint64), sent(got, "ek", np.uint64)) == (216, 216)
    for texts in ([words] * copies, [words]):
        batch = pa.RecordBatch.from_pydict({"k": pa.array([-5] * len(texts), pa.int64()), "text": texts})
        got = list(op.send_anchors(n, op.WINDOW, op.PERIOD, op.ANCHOR, op.COVER)([batch, batch]))
        anchors = sum(i % op.PERIOD in op.COVER for i in range(250 - op.ANCHOR + 1))
        assert (sent(got, "h", np.uint64), sent(got, "ek", np.uint64)) == (anchors, anchors)


@pytest.mark.parametrize("flush", [op.FLUSH, 100])
def test_copies_among_other_texts(spark, flush, monkeypatch):
    monkeypatch.setattr(op, "FLUSH", flush)
    rng = random.Random(6)
    one, short = prose(rng, 90), prose(rng, 34)
    texts = [one] * 40 + [short] * 9 + [prose(rng, 60) for _ in range(9)] + ["x " + " ".join(words_of(one)[20:70])]
    rng.shuffle(texts)
    got = {r.doc_id: (r.text, r.n_words, r.n_removed)
           for r in op.remove_repeats(documents(spark, list(enumerate(texts))).repartition(2)).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, op.WINDOW)
