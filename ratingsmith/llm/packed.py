"""Packed exchange: Spark shuffles rows that hold whole numpy columns for one hash bucket.

A task cuts its entries by bucket and emits one row a bucket, ``(bucket, column
blobs...)``; ``groupBy("bucket").applyInArrow`` then sees all entries of a
bucket as a few arrays.  Spark partitions, moves and retries these rows like any
others, while a row's overhead is paid once for thousands of entries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64


def schema(*columns: str) -> str:
    return ", ".join(["bucket int", *(f"{c} binary" for c in columns)])


def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> U(33)) % U(n)).astype(np.int32)


def pack(bucket: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row for each bucket that occurs; entries keep their order inside it."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    cut = cuts(b)
    out = [pa.array([b[i] for i, _ in cut], pa.int32())]
    for col in columns.values():
        c = np.ascontiguousarray(col[order])
        out.append(pa.array([c[i:j].tobytes() for i, j in cut], pa.binary()))
    return pa.RecordBatch.from_arrays(out, names=["bucket", *columns])


def unpack(tbl: pa.Table, name: str, dtype) -> np.ndarray:
    blobs = [np.frombuffer(x.as_buffer(), dtype) for chunk in tbl[name].chunks for x in chunk if x.is_valid]
    return np.concatenate(blobs) if blobs else np.zeros(0, dtype)


def runs(x: np.ndarray) -> np.ndarray:
    """Start of every run of equal neighbours."""
    if not len(x):
        return np.zeros(0, np.int64)
    return np.concatenate(([0], np.flatnonzero(x[1:] != x[:-1]) + 1))


def run_sizes(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(starts, n))


def cuts(x: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of every run of equal neighbours."""
    first = runs(x)
    return list(zip(first.tolist(), np.append(first[1:], len(x)).tolist(), strict=True)) if len(x) else []
