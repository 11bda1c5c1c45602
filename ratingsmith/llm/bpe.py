"""Byte-level BPE encoding and decoding by numpy merge matrices (operator 5).

The rank file maps byte strings to ids.  A text is cut into pieces
(``pretokens``); a piece that is itself a token gets its id, any other is merged
as follows.  Distinct pieces of similar byte length form one padded matrix of
ids.  In each round every row merges its leftmost pair of minimum rank: pair
ranks come from a hashed lookup table, rows without a mergeable pair leave the
matrix, and the rest are compacted by one column.  Ranks are kept between
rounds; only the two pairs beside a merge are looked up again.  Pieces of more
than LONG bytes use a heap instead of a matrix, whose cost would be quadratic;
the merges are the same.

Ids equal those of a tiktoken ``Encoding`` with the same ranks and pattern
(``encode_ordinary``: no special tokens).  Decoding joins the ids' byte strings.

Defined cases.  NULL text counts as empty: no ids.  A text of any length is
worked on whole; a run holds about 1 MB of text or one longer row.  NULLs
elsewhere, repeated rows and extra columns pass through; result columns replace
input columns of the same name.  Empty table: empty result.  An id outside the
vocabulary raises ValueError in ``decode``.
"""

from __future__ import annotations

import base64
import functools
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, pretokens, words

U = np.uint64
#: Upper byte lengths of the matrices, and the cells of one matrix.
WIDTHS = (4, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64, 128, 256)
LONG, CELLS = WIDTHS[-1], 1 << 20
NONE = np.int32(2**31 - 1)


class Ranks:
    """A rank file: byte strings, their ids, and the table of mergeable pairs."""

    def __init__(self, path: str):
        self.ids: dict[bytes, int] = {}
        with open(path, "rb") as f:
            for line in f:
                if line.strip():
                    token, rank = line.split()
                    self.ids[base64.b64decode(token)] = int(rank)
        self.byte_id = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        size = max(self.ids.values()) + 1
        tokens: list[bytes] = [b""] * size
        self.known = np.zeros(size, bool)
        for token, i in self.ids.items():
            tokens[i] = token
            self.known[i] = True
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        keys, merged = [], []
        for token, i in self.ids.items():
            for cut in range(1, len(token)):
                a, b = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    merged.append(i)
        self.pairs = dict(zip(keys, merged, strict=True))
        self._table(np.array(keys, U), np.array(merged, np.int32))

    def _table(self, keys: np.ndarray, merged: np.ndarray) -> None:
        """Open addressing: a pair is found within ``probes`` slots of its hash."""
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.mask = U((1 << bits) - 1)
        self.slots = np.full(1 << bits, ~U(0), U)
        self.merged = np.full(1 << bits, NONE, np.int32)
        at, left, self.probes = words.mix(keys) & self.mask, np.arange(len(keys)), 0
        while len(left):
            slot = (at[left] + U(self.probes)) & self.mask
            free = self.slots[slot] == ~U(0)
            _, first = np.unique(slot, return_index=True)
            win = np.zeros(len(left), bool)
            win[first] = True
            win &= free
            self.slots[slot[win]] = keys[left[win]]
            self.merged[slot[win]] = merged[left[win]]
            left = left[~win]
            self.probes += 1

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Id of the merged pair, or NONE; a negative id is padding."""
        key = a.astype(U) << U(32) | b.astype(U)
        at = words.mix(key) & self.mask
        out = np.full(len(key), NONE, np.int32)
        left = np.flatnonzero((a >= 0) & (b >= 0))
        for probe in range(self.probes):
            slot = (at[left] + U(probe)) & self.mask
            seen = self.slots[slot]
            hit = seen == key[left]
            out[left[hit]] = self.merged[slot[hit]]
            left = left[~hit & (seen != ~U(0))]
            if not len(left):
                break
        return out

    def merge_matrix(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of byte ids padded with -1 -> merged rows padded with -1, and their lengths."""
        rows, width = m.shape
        done = np.full((rows, width), -1, np.int32)
        left = np.arange(rows)
        rank = self.rank(m[:, :-1].ravel(), m[:, 1:].ravel()).reshape(rows, width - 1)
        while True:
            if m.shape[1] < 2:
                done[left, :m.shape[1]] = m
                break
            j = rank.argmin(axis=1)                       # leftmost minimum
            low = rank[np.arange(len(left)), j]
            open_ = low != NONE
            if not open_.all():
                done[left[~open_], :m.shape[1]] = m[~open_]
                left, m, rank, j, low = left[open_], m[open_], rank[open_], j[open_], low[open_]
                if not len(left):
                    break
            r = np.arange(len(left))
            m[r, j] = low
            cols = np.arange(m.shape[1] - 1)
            m = np.take_along_axis(m, cols + (cols > j[:, None]), axis=1)
            cols = cols[:-1]
            rank = np.take_along_axis(rank, cols + (cols >= j[:, None]), axis=1)
            for near in (j - 1, j):
                ok = np.flatnonzero((near >= 0) & (near < m.shape[1] - 1))
                rank[ok, near[ok]] = self.rank(m[ok, near[ok]], m[ok, near[ok] + 1])
        return done, (done >= 0).sum(axis=1)

    def merge_long(self, piece: bytes) -> list[int]:
        """The same merges for one long piece, by a heap over linked ids."""
        ids = [int(self.byte_id[b]) for b in piece]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = self.pairs
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1)
                if (r := pairs.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue                                   # one of the two was merged since
            ids[i], ids[j] = r, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (q := pairs.get(ids[x] << 32 | ids[y])) is not None:
                    heapq.heappush(heap, (q, x, ids[x], ids[y]))
        return [x for x in ids if x >= 0]

    def encode_pieces(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids of all pieces, ids per piece)``."""
        count = np.ones(len(found), np.int64)
        single = np.array([self.ids.get(p, -1) for p in found], np.int32)
        size = np.array([len(p) for p in found], np.int64)
        todo = np.flatnonzero(single < 0)
        todo = todo[np.argsort(size[todo], kind="stable")]
        held: list[tuple[np.ndarray, np.ndarray]] = []     # (piece of each id, ids)
        cut = np.searchsorted(size[todo], WIDTHS, side="right")
        for k, width in enumerate(WIDTHS):
            bucket = todo[cut[k - 1] if k else 0:cut[k]]
            step = max(1, CELLS // width)
            for at in range(0, len(bucket), step):
                rows = bucket[at:at + step]
                flat = np.frombuffer(b"".join(found[i] for i in rows), np.uint8)
                m = np.full((len(rows), width), -1, np.int32)
                m[np.arange(width) < size[rows][:, None]] = self.byte_id[flat]
                done, n = self.merge_matrix(m)
                count[rows] = n
                held.append((np.repeat(rows, n), done[done >= 0]))
        for i in todo[cut[-1]:]:
            ids = self.merge_long(found[i])
            count[i] = len(ids)
            held.append((np.full(len(ids), i), np.array(ids, np.int32)))
        whole = np.flatnonzero(single >= 0)
        held.append((whole, single[whole]))
        piece, ids = (np.concatenate(x) for x in zip(*held, strict=True))
        return ids[np.argsort(piece, kind="stable")], count

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) and (ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        n = self.size[ids]
        return self.bytes[np.repeat(self.at[ids], n) + words.ragged(n)].tobytes()


@functools.lru_cache(maxsize=2)
def ranks(path: str) -> Ranks:
    return Ranks(path)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> pretokens.Encoder:
    """One encoder for each Python worker and rank file."""
    return pretokens.Encoder(ranks(path).encode_pieces)


def _columns(df: DataFrame, name: str) -> DataFrame:
    return df.select(common.others(df, name).alias("row"), F.col(common.quoted(name)).alias("x"))


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", n_tokens: str = "n_tokens") -> DataFrame:
    """``df`` with ``ids`` (binary: unsigned 32-bit little-endian) and their number.

    The text column is dropped unless ``ids`` takes its name; join or copy it to keep it.
    """
    common.small_batches(df.sparkSession)

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            out, size = [], []
            for _, rows, raw, row_bytes in pretokens.raw_runs(batch["x"]):
                got, per = enc.encode(raw, row_bytes)
                blob, cut = got.astype("<u4").tobytes(), np.concatenate(([0], np.cumsum(per))) * 4
                out += [blob[cut[i]:cut[i + 1]] for i in range(rows)]
                size += per.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(out, pa.binary()), pa.array(size, pa.int64())], names=["row", "ids", "n"])

    rows = _columns(df, text)
    shape = T.StructType([rows.schema["row"], T.StructField("ids", T.BinaryType()), T.StructField("n", T.LongType())])
    return common.restore(df.drop(text) if text != ids else df, rows.mapInArrow(common.map_batches(run), shape), {ids: "ids", n_tokens: "n"})


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with ``decoded`` (binary) beside ``ids``; NULL ids decode to nothing."""
    common.small_batches(df.sparkSession)

    def run(batches):
        table = ranks(path)
        for batch in batches:
            out = [table.decode(np.frombuffer(x.as_buffer(), "<u4") if x.is_valid else np.zeros(0, np.uint32))
                   for x in batch["x"]]
            yield pa.RecordBatch.from_arrays([batch["row"], batch["x"], pa.array(out, pa.binary())],
                                             names=["row", "ids", "decoded"])

    rows = _columns(df, ids)
    shape = T.StructType([rows.schema["row"], T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])
    return common.restore(df, rows.mapInArrow(common.map_batches(run), shape), {ids: "ids", decoded: "decoded"})
