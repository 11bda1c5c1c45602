"""Document quality by a factorisation machine (operator 4).

Features of a text: WORDS hashed word dimensions (``log(1 + tf)``, length one),
standardised structure statistics (character classes, word lengths, repetition),
and metadata (the logarithm of a given length column and whether it is there).
The machine is y = w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j with FACTORS
factors; the pairwise part is computed in linear time as
1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).  The score is the logistic
function of y.

It is trained by mini-batch AdaGrad in one task on a bounded sample: the first
PER_CLASS labelled rows of each class by a hash of their id.  Scoring is one map
over the table; the model (about 300 KB) is broadcast.

Defined cases.  NULL text is scored as the empty text, from its statistics.  NULL
labels are not learned from; with contradicting labels for an id the lowest
holds, and of several rows of a labelled id one is learned from, as a whole.  No labels at all: score 0.5 everywhere; one class only: the score leans
to it.  A NULL length is a feature of its own.  Texts of any length are counted
whole.  Other columns pass through; result columns replace input columns of the
same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, words

U = np.uint64
#: Hashed words, factors, and labelled rows of each class in the training sample.
WORDS, FACTORS, PER_CLASS = 4096, 8, 3000
ROWS = 256
SYMBOLS = b"#*$%&|<>"
STATS = ("log_words", "word_bytes", "upper", "lower", "digit", "symbol", "bang", "point", "beyond_ascii", "space",
         "lines", "distinct", "same_next", "repeat3", "symbol_words", "log_length", "no_length")


def _kinds() -> np.ndarray:
    """Byte -> class: 0 other, then upper, lower, digit, symbol, '!', ',.' and the like, beyond ASCII, white space."""
    out = np.zeros(256, np.int64)
    out[65:91], out[97:123], out[48:58], out[128:] = 1, 2, 3, 7
    out[list(SYMBOLS)], out[33], out[list(b".,;:?'\"-()")] = 4, 5, 6
    out[[9, 10, 11, 12, 13, 32]] = 8
    return out


KINDS = _kinds()


def features(buf: np.ndarray, starts: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hashed word counts: rows x WORDS, statistics: rows x STATS)`` of one run of ``words.buffers``.

    ``length`` has the metadata column, NaN where it is NULL.
    """
    rows = len(starts) - 1
    s, e, h = words.word_hashes(buf, lower=True)
    first = words.per_row(starts, s)
    n = np.diff(first)
    row = np.repeat(np.arange(rows), n)
    bag = np.bincount(row * WORDS + (h % U(WORDS)).astype(np.int64), minlength=rows * WORDS)
    stats = np.zeros((rows, len(STATS)))
    size = np.maximum(np.diff(starts) - 1, 1)
    byte_row = np.zeros(9 * rows)
    for at in range(0, len(buf), words.SEGMENT):
        end = min(len(buf), at + words.SEGMENT)
        r = np.repeat(np.arange(rows), np.diff(np.clip(starts, at, end)))
        byte_row += np.bincount(r * 9 + KINDS[buf[at:end]], minlength=9 * rows)
    kinds = byte_row.reshape(rows, 9)
    some = np.maximum(n, 1)
    stats[:, 0] = np.log1p(n)
    stats[:, 1] = np.bincount(row, e - s, minlength=rows) / some
    stats[:, 2:10] = kinds[:, 1:9] / size[:, None]
    lines = np.searchsorted(np.flatnonzero(buf == 10), starts)
    stats[:, 10] = np.diff(lines) / some
    order = np.lexsort((h, row))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
    stats[:, 11] = np.bincount(row[order][new], minlength=rows) / some
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    stats[:, 12] = np.bincount(row[same], minlength=rows) / some
    if len(h) >= 3:
        g = words.window_hashes(h, 3)
        inside = row[:-2] == row[2:]
        g, r = g[inside], row[:-2][inside]
        order = np.lexsort((g, r))
        again = np.zeros(len(g), bool)
        again[1:] = (g[order][1:] == g[order][:-1]) & (r[order][1:] == r[order][:-1])
        stats[:, 13] = np.bincount(r[order][again], minlength=rows) / some
    marked = np.isin(buf[np.maximum(e - 1, 0)], np.frombuffer(SYMBOLS + b"!", np.uint8))
    stats[:, 14] = np.bincount(row[marked], minlength=rows) / some
    known = ~np.isnan(length)
    stats[:, 15] = np.where(known, np.log1p(np.maximum(np.nan_to_num(length), 0)), 0)
    stats[:, 16] = ~known
    return bag.reshape(rows, WORDS).astype(np.float32), stats.astype(np.float32)


@dataclass
class Model:
    bias: float
    linear: np.ndarray          # WORDS + STATS
    factors: np.ndarray         # (WORDS + STATS) x FACTORS
    mean: np.ndarray
    scale: np.ndarray

    def inputs(self, bag: np.ndarray, stats: np.ndarray) -> np.ndarray:
        x = np.log1p(bag)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        z = np.clip((stats - self.mean) / self.scale, -4, 4) / 4
        return np.concatenate((x, z.astype(np.float32)), axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        pair = ((x @ self.factors) ** 2 - (x * x) @ (self.factors ** 2)).sum(axis=1) / 2
        return self.bias + x @ self.linear + pair

    def score(self, bag: np.ndarray, stats: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(self.inputs(bag, stats)).astype(np.float64), -30, 30)))


def untrained() -> Model:
    n = WORDS + len(STATS)
    return Model(0.0, np.zeros(n, np.float32), np.zeros((n, FACTORS), np.float32), np.zeros(len(STATS)), np.ones(len(STATS)))


def train(bag: np.ndarray, stats: np.ndarray, y: np.ndarray, epochs: int = 30, batch: int = 128,
          rate: float = 0.1, decay: float = 1e-4, seed: int = 7) -> Model:
    """AdaGrad on the logistic loss, classes weighted to equal shares."""
    m = untrained()
    m.mean, m.scale = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-3)
    rng = np.random.default_rng(seed)
    m.factors = rng.normal(0, 0.05, m.factors.shape).astype(np.float32)
    share = np.array([max(1, (y == c).sum()) for c in (0, 1)])
    weight = (len(y) / 2 / share)[y].astype(np.float32)
    g_bias, g_lin, g_fac = 1e-6, np.full(m.linear.shape, 1e-6, np.float32), np.full(m.factors.shape, 1e-6, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            rows = order[at:at + batch]
            x = m.inputs(bag[rows], stats[rows])
            err = (1 / (1 + np.exp(-np.clip(m.raw(x), -30, 30))) - y[rows]) * weight[rows]
            err = (err / len(rows)).astype(np.float32)
            lin = x.T @ err + decay * m.linear
            fac = x.T @ (err[:, None] * (x @ m.factors)) - m.factors * ((x * x).T @ err)[:, None] + decay * m.factors
            bias = float(err.sum())
            g_bias += bias * bias
            g_lin += lin * lin
            g_fac += fac * fac
            m.bias -= rate * bias / g_bias ** 0.5
            m.linear -= rate * lin / np.sqrt(g_lin)
            m.factors -= rate * fac / np.sqrt(g_fac)
    return m


def _lengths(batch: pa.RecordBatch) -> np.ndarray:
    return batch["length"].cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64)


def _sample(batches):
    for batch in batches:
        idx, val, stats = [], [], []
        length = _lengths(batch)
        for at, rows, buf, starts in words.buffers(batch["text"], most=ROWS):
            bag, st = features(buf, starts, length[at:at + rows])
            for i in range(rows):
                has = np.flatnonzero(bag[i])
                idx.append(has.astype(np.uint16).tobytes())
                val.append(bag[i, has].tobytes())
                stats.append(st[i].tobytes())
        yield pa.RecordBatch.from_arrays([batch["id"], batch["y"], *(pa.array(c, pa.binary()) for c in (idx, val, stats))],
                                         names=["id", "y", "idx", "val", "stats"])


def _train_group(tbl: pa.Table) -> pa.Table:
    n = tbl.num_rows
    bag, stats = np.zeros((n, WORDS), np.float32), np.zeros((n, len(STATS)), np.float32)
    order = np.argsort(np.asarray(tbl["id"]), kind="stable")      # the same order in every run
    for row, i in enumerate(order):
        bag[row, np.frombuffer(tbl["idx"][i].as_buffer(), np.uint16)] = np.frombuffer(tbl["val"][i].as_buffer(), np.float32)
        stats[row] = np.frombuffer(tbl["stats"][i].as_buffer(), np.float32)
    m = train(bag, stats, np.asarray(tbl["y"]).astype(np.int64)[order])
    blobs = (np.float64(m.bias).tobytes(), m.linear.tobytes(), m.factors.tobytes(),
             m.mean.astype(np.float64).tobytes(), m.scale.astype(np.float64).tobytes())
    return pa.table({c: pa.array([b], pa.binary()) for c, b in zip(PARTS, blobs, strict=True)})


PARTS = ("bias", "linear", "factors", "mean", "scale")


def fit(df: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
        length: str | None = "n_chars", per_class: int = PER_CLASS) -> Model:
    """Learns 1 against 0 of ``labels`` (``doc_id``, ``label``) from at most ``per_class`` ids of each."""
    spark = df.sparkSession
    common.small_batches(spark)
    known = (labels.select(F.col(common.quoted(doc_id)).alias("id"), F.col(common.quoted(label)).cast("int").alias("y"))
             .filter("id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.min("y").alias("y")))
    stages = common.Stages(spark, "quality")
    chosen = common.bounded_sample(known.withColumn("o", F.xxhash64("id")), "y", "o", per_class, stages).select("id", "y")
    size = F.col(common.quoted(length)).cast("double") if length else F.lit(None).cast("double")
    rows = df.select(F.col(common.quoted(doc_id)).alias("id"), F.col(common.quoted(text)).alias("text"), size.alias("length"))
    rows = rows.join(F.broadcast(chosen), "id")                     # at most 2 * per_class ids
    feats = rows.mapInArrow(common.map_batches(_sample), "id long, y int, idx binary, val binary, stats binary")
    once = feats.groupBy("id").agg(F.min(F.struct("y", "idx", "val", "stats")).alias("row")).select("id", "row.*")
    got = once.groupBy(F.lit(0).alias("all")).applyInArrow(common.map_group(_train_group), ", ".join(f"{c} binary" for c in PARTS)).collect()
    if not got:
        return untrained()
    r = got[0]
    return Model(float(np.frombuffer(r.bias, np.float64)[0]), np.frombuffer(r.linear, np.float32),
                 np.frombuffer(r.factors, np.float32).reshape(-1, FACTORS),
                 np.frombuffer(r["mean"], np.float64), np.frombuffer(r.scale, np.float64))


def score(df: DataFrame, model: Model, text: str = "text", length: str | None = "n_chars", score: str = "score",
          keep_text: bool = False) -> DataFrame:
    """``df`` with the score; the text column goes unless ``keep_text``."""
    spark = df.sparkSession
    common.small_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            got, sizes = [np.zeros(0)], _lengths(batch)
            for at, rows, buf, starts in words.buffers(batch["text"], most=ROWS):
                got.append(sent.value.score(*features(buf, starts, sizes[at:at + rows])))
            extra = [batch["text"]] if keep_text else []
            yield pa.RecordBatch.from_arrays([batch["row"], *extra, pa.array(np.concatenate(got), pa.float64())],
                                             names=["row", *["text"] * keep_text, "score"])

    size = F.col(common.quoted(length)).cast("double") if length else F.lit(None).cast("double")
    rows = df.select(common.others(df, text).alias("row"), F.col(common.quoted(text)).alias("text"), size.alias("length"))
    shape = T.StructType([rows.schema["row"], *[rows.schema["text"]] * keep_text, T.StructField("score", T.DoubleType())])
    out = rows.mapInArrow(common.map_batches(run), shape)
    return (common.restore(df, out, {text: "text", score: "score"}) if keep_text
            else common.restore(df.drop(text), out, {score: "score"}))
