"""Language identification by nearest clustered centroids (operator 2).

A text becomes a vector of hashed character n-grams (one to three letters, lower
case, other characters as word ends), weighted ``log(1 + tf) * idf`` and scaled
to length one.  Each language has several centroids, found by spherical k-means
over its training vectors.  A text takes the language of the centroid with the
largest cosine; the score is that cosine.  A text that lies farther from its
nearest centroid than REJECT times the calibrated radius (the 99.5 % quantile of
the centroid's training distances) is marked ``rejected``; its nearest language
is reported all the same.

The classifier is fitted on a bounded sample: PER_LABEL labelled rows of each
language, chosen by a hash of the row.  Prediction is one map over the table.

Defined cases.  NULL text, or a text without a letter: ``und``, score 0, not
rejected.  No labelled rows: every text is ``und`` with score 0.  Rows with a NULL
label are not learned from.  Texts of any length are counted whole, in segments.
Other columns pass through, also when NULL; result columns replace input columns
of the same name.  Equal cosines: the smaller language name wins.
"""

from __future__ import annotations

import functools
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, words

U = np.uint64
#: Hashed n-gram dimensions, centroids of a language, labelled rows of a language in the sample.
DIMS, CLUSTERS, PER_LABEL = 4096, 4, 1500
REJECT, ROWS = 1.25, 256
UNKNOWN = "und"


@functools.cache
def letters() -> np.ndarray:
    """Code point -> lower-case letter, or 0 if it is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] == "L":
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def gram_counts(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(counts: rows x DIMS, letters per row)`` for one run of ``words.buffers``."""
    rows = len(starts) - 1
    out, seen = np.zeros(rows * DIMS, np.float32), np.zeros(rows, np.int64)
    cps = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    width = 1 + (cps >= 0x80).astype(np.int8) + (cps >= 0x800) + (cps >= 0x10000)
    first = np.searchsorted(np.cumsum(width, dtype=np.int64) - width, starts)    # code point of each row's start
    z = np.concatenate((np.zeros(1, np.uint32), letters()[cps], np.zeros(1, np.uint32)))
    for at in range(0, len(cps), words.SEGMENT):
        end = min(len(cps), at + words.SEGMENT)
        row = np.repeat(np.arange(rows), np.diff(np.clip(first, at, end)))
        a, b, c = (z[at + k:end + k].astype(U) for k in range(3))
        full = b > 0
        seen += np.bincount(row[full], minlength=rows)
        for h, ok in ((b * U(0x9E3779B97F4A7C15), full),
                      (a * U(0xC2B2AE3D27D4EB4F) + b * U(0x165667B19E3779F9), full | (a > 0)),
                      (a * U(0xFF51AFD7ED558CCD) + b * U(0xC4CEB9FE1A85EC53) + c * U(0x2545F4914F6CDD1D), full)):
            dim = (words.mix(h[ok]) % U(DIMS)).astype(np.int64)
            out += np.bincount(row[ok] * DIMS + dim, minlength=rows * DIMS).astype(np.float32)
    return out.reshape(rows, DIMS), seen


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means, started farthest-first from the mean -> centroids and their radii."""
    unit = lambda v: v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-12)
    c = unit(x.mean(axis=0))[None]
    while len(c) < min(k, len(x)):
        c = np.vstack((c, x[(x @ c.T).max(axis=1).argmin()]))
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        c = unit(np.stack([x[near == i].mean(axis=0) if (near == i).any() else c[i] for i in range(len(c))]))
    sim = x @ c.T
    near = sim.argmax(axis=1)
    dist = 1 - sim.max(axis=1)
    radius = np.array([np.quantile(dist[near == i], 0.995) if (near == i).any() else 0.0 for i in range(len(c))])
    return c.astype(np.float32), radius


@dataclass
class Model:
    labels: list[str]           # language of each centroid, in order of language
    centroids: np.ndarray
    radius: np.ndarray
    idf: np.ndarray

    def predict(self, counts: np.ndarray, seen: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        if not len(self.labels):
            return [UNKNOWN] * len(seen), np.zeros(len(seen)), np.zeros(len(seen), bool)
        sim = vectors(counts, self.idf) @ self.centroids.T
        best = sim.argmax(axis=1)
        score = np.clip(sim[np.arange(len(best)), best], 0, 1).astype(np.float64)
        score[seen == 0] = 0
        far = (1 - score > REJECT * self.radius[best]) & (seen > 0)
        return [self.labels[b] if n else UNKNOWN for b, n in zip(best, seen, strict=True)], score, far


def _sparse(batches):
    for batch in batches:
        idx, val = [], []
        for _, rows, buf, starts in words.buffers(batch["text"], most=ROWS):
            counts, _ = gram_counts(buf, starts)
            for i in range(rows):
                at = np.flatnonzero(counts[i])
                idx.append(at.astype(np.uint16).tobytes())
                val.append(counts[i, at].tobytes())
        yield pa.RecordBatch.from_arrays([batch["label"], pa.array(idx, pa.binary()), pa.array(val, pa.binary())],
                                         names=["label", "idx", "val"])


def _dense(tbl: pa.Table) -> np.ndarray:
    x = np.zeros((tbl.num_rows, DIMS), np.float32)
    for i, (idx, val) in enumerate(zip(tbl["idx"], tbl["val"], strict=True)):
        x[i, np.frombuffer(idx.as_buffer(), np.uint16)] = np.frombuffer(val.as_buffer(), np.float32)
    return x


def fit(df: DataFrame, text: str = "text", label: str = "lang", per_label: int = PER_LABEL,
        clusters: int = CLUSTERS, order: Column | None = None) -> Model:
    """Learns from at most ``per_label`` rows of each label, the first by ``order`` (a hash of the row).

    The driver receives one vector a label and ``clusters`` centroids a label.
    """
    spark = df.sparkSession
    common.small_batches(spark)
    order = F.xxhash64(F.col(common.quoted(text))) if order is None else order
    rows = df.select(F.col(common.quoted(label)).cast("string").alias("label"),
                     F.col(common.quoted(text)).alias("text"), order.alias("o")).filter("label IS NOT NULL AND text IS NOT NULL")
    stages = common.Stages(spark, "language")
    sample = common.bounded_sample(rows, "label", "o", per_label, stages).select("label", "text")
    feats = stages.put(sample.mapInArrow(common.map_batches(_sparse), "label string, idx binary, val binary"), "sample")

    def presence(tbl: pa.Table) -> pa.Table:
        return pa.table({"label": tbl["label"][:1], "n": pa.array([tbl.num_rows], pa.int64()),
                         "df": pa.array([(_dense(tbl) > 0).sum(axis=0).astype(np.int64).tobytes()], pa.binary())})

    seen = feats.groupBy("label").applyInArrow(common.map_group(presence), "label string, n long, df binary").collect()
    docs = sum(r.n for r in seen)
    count = sum((np.frombuffer(r.df, np.int64) for r in seen), np.zeros(DIMS, np.int64))
    idf = (np.log((1 + docs) / (1 + count)) + 1).astype(np.float32)

    def centres(tbl: pa.Table) -> pa.Table:
        x = _dense(tbl)
        x = vectors(x[x.any(axis=1)], idf)
        c, radius = cluster(x, clusters) if len(x) else (np.zeros((0, DIMS), np.float32), np.zeros(0))
        return pa.table({"label": pa.array([tbl["label"][0].as_py()] * len(c), pa.string()),
                         "centre": pa.array([v.tobytes() for v in c], pa.binary()), "radius": pa.array(radius, pa.float64())})

    found = feats.groupBy("label").applyInArrow(common.map_group(centres), "label string, centre binary, radius double").collect()
    stages.drop("sample")
    found.sort(key=lambda r: r.label)
    c = np.stack([np.frombuffer(r.centre, np.float32) for r in found]) if found else np.zeros((0, DIMS), np.float32)
    return Model([r.label for r in found], c, np.array([r.radius for r in found]), idf)


def predict(df: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score",
            rejected: str = "rejected") -> DataFrame:
    """``df`` without its text, with the predicted language, the cosine, and the rejection mark."""
    spark = df.sparkSession
    common.small_batches(spark)
    sent = spark.sparkContext.broadcast(model)      # labels x clusters x DIMS floats: 16 KB a centroid

    def run(batches):
        for batch in batches:
            names, scores, far = [], [], []
            for _, _, buf, starts in words.buffers(batch["text"], most=ROWS):
                a, b, c = sent.value.predict(*gram_counts(buf, starts))
                names += a
                scores.append(b)
                far.append(c)
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(names, pa.string()),
                 pa.array(np.concatenate(scores) if scores else [], pa.float64()),
                 pa.array(np.concatenate(far) if far else [], pa.bool_())], names=["row", "lang", "score", "far"])

    rows = df.select(common.others(df, text).alias("row"), F.col(common.quoted(text)).alias("text"))
    shape = T.StructType([rows.schema["row"], T.StructField("lang", T.StringType()),
                          T.StructField("score", T.DoubleType()), T.StructField("far", T.BooleanType())])
    return common.restore(df.drop(text), rows.mapInArrow(common.map_batches(run), shape), {lang: "lang", score: "score", rejected: "far"})
