"""Embedding whitening with MLlib's ``BlockMatrix`` (operator 13).

Entries are taken as x = floor(SCALE * c).  The fit list holds each distinct x vector once; n is its
length, S its sums.  Rows of the centred fit list (x - S/n) are indexed and cut into distributed
blocks; the transposed block matrix times itself is the scatter, whose eigenvectors are found
locally (dimension x dimension).  Multiplying the centred rows, again a block matrix, by the
whitening matrix (eigenvectors over the roots of their eigenvalues) projects every row.

Scale.  Rows are indexed without moving them (``common.placed``).  Distinct vectors come from a
partial aggregate, so a vector of a third of all rows is one row a task.  The scatter is summed up over
MIDDLE groups of blocks, so no task sees all of them.  ``BlockMatrix`` lists its block indices
on the driver, therefore rows are worked on in panels of at most PANEL blocks, whose
scatters are added up.  Only sums, scatters and the whitening matrix (dimension times components)
reach the driver; all are fixed by the dimension, at most LARGEST.

Defined cases.  Rows whose vector is NULL, empty, or holds NULL, NaN or infinite entries are dropped, as are
those of another length than most rows have (ties: the longer).  Ids may be NULL or repeat: every row
is projected on its own.  Entries beyond the range of a long saturate.  Components whose eigenvalue is
not above rounding (rank below their number, one distinct vector) are not returned, since nothing can be
scaled to unit variance there.  A deviation beyond the range of a long is NULL.  Eigenvectors have
their largest entry positive; equal eigenvalues give any basis of their space.  Result columns take the place of
input columns of the same name.  Empty table: empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SCALE, COMPONENTS = 256, 4
#: Entries and columns of a block, blocks of a panel, groups that partial scatters are summed up in.
BLOCK, COLUMNS, PANEL, MIDDLE = 1 << 17, 1024, 20_000, 512
#: Largest dimension: the scatter (128 MB then) is decomposed on the driver.
LARGEST = 4096
RESULTS = "component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Model:
    """Fit of the distinct vectors: their number, exact sums, eigenvalues (falling) and vectors (columns)."""

    n: int
    sums: list[int]
    largest: int                    # absolute entry
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def mean(self) -> list[float]:
        return [s / self.n for s in self.sums]


def usable(df: DataFrame, vector: str, scale: int = SCALE) -> tuple[DataFrame, int]:
    """Rows with a finite vector, as ``row`` (the other columns) and ``x``; and the dimension (0: no rows)."""
    c = F.col(common.quoted(vector))
    fine = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < F.lit(float("inf"))))
    rows = df.filter(c.isNotNull() & (F.size(c) > 0) & fine)
    most = rows.groupBy(F.size(c).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dim = int(most.d) if most else 0
    if dim > LARGEST:
        raise ValueError(f"vectors have {dim} entries; at most {LARGEST} are supported")
    x = F.transform(c, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")))
    return rows.filter(F.size(c) == dim).select(common.others(df, vector).alias("row"), x.alias("x")), dim


def _sums(fit: DataFrame, dim: int) -> tuple[int, list[int], int]:
    """Number of vectors, exact sums and largest absolute entry."""
    def run(batches):
        high, low, top, n = np.zeros(dim, np.int64), np.zeros(dim, np.int64), 0, 0
        for batch in batches:
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
            n += len(x)
            top = max(top, abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(dim), pa.int32()), "high": high, "low": low,
                                          "top": pa.array([min(top, 2 ** 63 - 1)] * dim, pa.int64()),
                                          "n": pa.array([n] * dim, pa.int64())})

    common.small_batches(fit.sparkSession)
    parts = fit.select("x").mapInArrow(common.map_batches(run), "i int, high long, low long, top long, n long")
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = parts.groupBy("i").agg(whole("high"), whole("low"), F.max("top").alias("top"), F.sum("n").alias("n")).orderBy("i").collect()
    return int(rows[0].n), [(int(r.high) << 32) + int(r.low) for r in rows], max(int(r.top) for r in rows)


def _panels(df: DataFrame, place: str, count: int, mean: list[float]):
    """``(first place, block matrix)`` of the centred vectors, at most PANEL blocks each."""
    spark, dim = df.sparkSession, len(mean)
    columns = min(dim, COLUMNS)
    height = max(64, BLOCK // columns)
    centre = F.array(*(F.lit(float(m)) for m in mean))
    rows = df.select(F.col(place).alias("at"), F.zip_with("x", centre, lambda a, m: a.cast("double") - m).alias("c"))
    for first in range(0, count, height * PANEL):
        size = min(count - first, height * PANEL)
        panel = rows.filter(F.col("at").between(first, first + size - 1)) if count > size else rows
        panel = panel.select((F.col("at") - first).alias("index"), array_to_vector("c").alias("vector"))
        panel = MLUtils.convertVectorColumnsFromML(panel, "vector")
        yield first, IndexedRowMatrix(panel, size, dim).toBlockMatrix(height, columns)


def _times(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """Product whose middle dimension is summed up in ``splits`` groups (the Python method has only one)."""
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def fit(distinct: DataFrame, dim: int, place: str = "place") -> Model:
    """Model of distinct vectors ``x`` that are numbered by ``place`` without gaps."""
    n, sums, largest = _sums(distinct, dim)
    mean = [s / n for s in sums]
    scatter = np.zeros((dim, dim))
    for _, block in _panels(distinct, place, n, mean):
        splits = max(1, min(MIDDLE, -(-block.numRowBlocks // 4)))
        scatter += _times(block.transpose(), block, splits).toLocalMatrix().toArray()
    cov = (scatter + scatter.T) / (2 * n)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(dim)])
    return Model(n, sums, largest, values, vectors * np.where(sign == 0, 1, sign), float(np.trace(cov)))


def whitening_matrix(model: Model, components: int = COMPONENTS) -> np.ndarray:
    """dimension x components; columns only for eigenvalues above rounding."""
    least = len(model.values) * np.finfo(float).eps * max(model.values.max(initial=0.0), 0.0)
    kept = int((model.values[:components] > least).sum())
    return model.vectors[:, :kept] / np.sqrt(model.values[:kept])


def project(spark: SparkSession, rows: DataFrame, count: int, model: Model, matrix: np.ndarray, place: str = "place") -> DataFrame:
    """``place, z``: centred rows times ``matrix``."""
    columns = min(len(matrix), COLUMNS)
    parts = [((i, 0), DenseMatrix(len(b), b.shape[1], b.ravel(order="F").tolist()))
             for i in range(-(-len(matrix) // columns)) for b in [matrix[i * columns:(i + 1) * columns]]]
    local = BlockMatrix(spark.sparkContext.parallelize(parts, 1), columns, matrix.shape[1], *matrix.shape)
    out = []
    for first, block in _panels(rows, place, count, model.mean):
        done = _times(block, local, 1).toIndexedRowMatrix()
        indexed = callMLlibFunc("getIndexedRows", done._java_matrix_wrapper._java_model)
        out.append(indexed.select((F.col("index") + first).alias(place), vector_to_array("vector").alias("z")))
    return reduce(DataFrame.unionAll, out)


def deviation(model: Model) -> F.Column:
    """Sum over dimensions of (n x - S)^2, exact."""
    bound = len(model.sums) * (2 * model.n * model.largest) ** 2
    kind = "long" if bound < 2 ** 63 else "decimal(38,0)"
    sums = F.array(*(F.lit(str(s)).cast(kind) for s in model.sums))
    if kind == "long":
        off = F.zip_with("x", sums, lambda a, s: a * F.lit(model.n) - s)
        return F.aggregate(off, F.lit(0).cast("long"), lambda t, o: t + o * o)
    near = lambda a, s: (a.cast("decimal(19,0)") * F.lit(str(model.n)).cast("decimal(18,0)") - s).try_cast("decimal(19,0)")
    whole = F.aggregate(F.zip_with("x", sums, near), F.lit(0).cast(kind), lambda t, o: F.try_add(t, F.try_multiply(o, o)).cast(kind))
    return whole.try_cast("long")


def whiten(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """One row for each usable row of ``df`` and component: its columns but ``vector``, and RESULTS."""
    spark, stages = df.sparkSession, common.Stages(df.sparkSession, "whitening")
    others = df.drop(vector)
    rows, dim = usable(df, vector, scale)
    names = [part.split()[0] for part in RESULTS.split(", ")]
    if not dim:
        none = spark.createDataFrame([], RESULTS)
        return common.restore(others, rows.limit(0).crossJoin(none.limit(0)), {c: c for c in names})
    rows = stages.put(common.placed(rows, stages, "rows"), "placed")
    count = rows.count()
    distinct = rows.groupBy("x").agg(F.min("place").alias("of"))
    distinct = stages.put(common.placed(distinct, stages, "distinct"), "fit")
    model = fit(distinct, dim)
    matrix = whitening_matrix(model, components)
    kept = matrix.shape[1]
    if not kept:
        none = spark.createDataFrame([], RESULTS)
        return common.restore(others, rows.limit(0).crossJoin(none.limit(0)), {c: c for c in names})
    z = stages.put(project(spark, rows, count, model, matrix), "projected")
    # the covariance of what was written, over one row of each distinct vector
    once = z.join(distinct.select(F.col("of").alias("place")), "place", "left_semi")
    pairs = [(i, j) for i in range(kept) for j in range(i, kept)]
    got = once.agg(*(F.covar_pop(F.get("z", F.lit(i)), F.get("z", F.lit(j))).alias(f"v{i}_{j}") for i, j in pairs)).first()
    error = max(abs(got[f"v{i}_{j}"] - (i == j)) for i, j in pairs)
    share = F.array(*(F.lit(float(v / model.trace)) for v in model.values[:kept]))
    done = (rows.select("place", "row", deviation(model).alias("deviation")).join(z, "place")
            .select("row", "deviation", F.posexplode("z").alias("c", "whitened")))
    done = done.select("row", (F.col("c") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(share, F.col("c")).alias("explained"), F.lit(float(error)).alias("identity_error"))
    return common.restore(others, done, {c: c for c in names})
