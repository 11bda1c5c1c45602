import math
import unicodedata

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from ratingsmith.llm import language_id as op
from ratingsmith.llm import queries, words
from tests.llm.helpers import by_id, documents

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = by_id(queries.QUERIES["op2_language_id"](spark, SF).collect())
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    held = [d for d, r in got.items() if r.held_out]
    assert len(got) == len(truth) and 150 < len(held) < 350
    assert sum(got[d].lang_pred == truth[d] for d in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, "the cat sat on the mat and that was that " * (1 + i % 3), "en") for i in range(30)]
    rows += [(100 + i, "der hund und die katze sind nicht im garten " * (1 + i % 3), "de") for i in range(30)]
    rows += [(200, "kein etikett", None), (201, None, "en"), (202, "123 !!", "en")]
    return op.fit(documents(spark, rows, "doc_id long, text string, lang string"), clusters=2)


def test_predictions_and_defined_cases(spark, model):
    assert model.labels == sorted(model.labels) and set(model.labels) == {"de", "en"}
    rows = [(1, "the mat and the cat", None), (2, "die katze im garten", "x"), (3, None, "y"), (4, "12 ++ \n", "z"), (5, "", None),
            (None, "DER HUND", None), (6, "зима и лето", None), (7, "the " * 300_000, None),
            (8, "the cat sat on the mat and that was that ", None)]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, extra string, score int")
    out = op.predict(df, model)
    assert out.columns == ["doc_id", "extra", "score", "lang_pred", "rejected"]
    got = by_id(out.collect())
    assert [got[i].lang_pred for i in (1, 2, 3, 4, 5, None, 7)] == ["en", "de", "und", "und", "und", "de", "en"]
    assert [got[i].score for i in (3, 4, 5)] == [0, 0, 0]
    assert got[6].rejected and not got[8].rejected and got[6].lang_pred in model.labels
    assert op.predict(df.limit(0), model).count() == 0


def plain_counts(text):
    """Hashed dimension -> occurrences of letters, pairs and triples, and the number of letters, one character at a time."""
    low = [ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in text]
    z = [0] + [x if unicodedata.category(c)[0] == "L" else 0 for x, c in zip(low, text, strict=True)] + [0, 0]
    counts, seen = {}, 0
    for i in range(1, len(text) + 2):                    # one past the end: the last letter's pair with the gap behind it
        a, b, c = z[i - 1], z[i], z[i + 1] if i + 1 < len(z) else 0
        grams = []
        if b:
            seen += 1
            grams.append(b * 0x9E3779B97F4A7C15)
            grams.append(a * 0xFF51AFD7ED558CCD + b * 0xC4CEB9FE1A85EC53 + c * 0x2545F4914F6CDD1D)
        if a or b:
            grams.append(a * 0xC2B2AE3D27D4EB4F + b * 0x165667B19E3779F9)
        for g in grams:
            dim = int(words.mix(np.array([g % 2**64], np.uint64))[0]) % op.DIMS
            counts[dim] = counts.get(dim, 0) + 1
    return counts, seen


def plain_prediction(model, text):
    counts, seen = plain_counts(text or "")
    weights = {d: math.log1p(n) * float(model.idf[d]) for d, n in counts.items()}
    norm = math.sqrt(sum(w * w for w in weights.values()))
    if not seen:
        return "und", 0.0, False
    cosines = [sum(w * float(c[d]) for d, w in weights.items()) / norm for c in model.centroids]
    best = max(range(len(cosines)), key=lambda i: (cosines[i], -i))
    return model.labels[best], cosines[best], 1 - cosines[best] > op.REJECT * model.radius[best]


def test_predictions_equal_brute_force(spark, model):
    texts = ["the cat and the dog", "der Hund IST nicht im Garten!", "Grüße, señor! déjà-vu 123", "зима и лето", "x", "İstanbul ﬁn",
             "中文 text", None, "", "123", "the cat und die katze " * 40, "a\nb\tc  d", "the cat and the dog"]
    got = by_id(op.predict(documents(spark, list(enumerate(texts))).repartition(3), model).collect())
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        lang, score, far = plain_prediction(model, t)
        assert (got[i].lang_pred, got[i].rejected) == (lang, far) and abs(got[i].score - score) < 1e-5, t
    assert got[0][1:] == got[len(texts) - 1][1:]         # repeated rows alike


def test_weights_equal_brute_force(spark):
    rows = [(1, "one fish two fish", "en"), (2, "ein fisch", "de"), (3, "zwei fische", "de"), (4, "one fish two fish", "en"), (5, "no label", None)]
    model = op.fit(documents(spark, rows, "doc_id long, text string, lang string"), clusters=1)
    held = [set(plain_counts(t)[0]) for _, t, lang in rows if lang]
    want = [math.log(5 / (1 + sum(d in h for h in held))) + 1 for d in range(op.DIMS)]
    assert np.allclose(model.idf, want, atol=1e-5)


def test_equal_cosines_go_to_the_first_language(spark, model):
    same = op.Model(["aa", "bb", "bb"], np.repeat(model.centroids[:1], 3, axis=0), np.repeat(model.radius[:1], 3), model.idf)
    got = op.predict(documents(spark, [(1, "der hund"), (1, "der hund")]), same).collect()
    assert [r.lang_pred for r in got] == ["aa", "aa"] and got[0] == got[1]


def test_no_labelled_rows(spark):
    df = documents(spark, [(1, "a b", None)], "doc_id long, text string, lang string")
    got = op.predict(df, op.fit(df)).first()
    assert (got.lang_pred, got.score, got.rejected) == ("und", 0.0, False)


def test_segments_do_not_change_counts(monkeypatch):
    text = "Grüße, señor! déjà-vu 123 " * 50
    run = lambda: [op.gram_counts(b, s) for _, _, b, s in words.buffers(pa.array([text, None, "x"]))][0]
    whole = run()
    monkeypatch.setattr(words, "SEGMENT", 37)
    b, s = next((b, s) for _, _, b, s in words.buffers(pa.array([text, None, "x"]), limit=10**6))
    cut = op.gram_counts(b, s)
    assert np.array_equal(whole[0], cut[0]) and np.array_equal(whole[1], cut[1])


def test_sample_is_bounded(spark):
    from pyspark.sql import functions as F

    from ratingsmith.llm import common
    df = spark.range(20_000).select(F.when(F.col("id") % 4 > 0, "big").otherwise("small").alias("g"), F.xxhash64("id").alias("o"))
    got = dict(common.bounded_sample(df, "g", "o", 500, common.Stages(spark, "t")).groupBy("g").count().collect())
    assert got == {"big": 500, "small": 500}
