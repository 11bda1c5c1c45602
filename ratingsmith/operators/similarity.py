"""Item-item cosine similarity over long-form vectors.

The reference self-joins the vectors on the tag key, which emits every item
pair once per tag: with dense vectors each tag group holds every item.  Here
the exact same cosine is computed as a blocked matrix product:

1. pack each item's (key, value) entries into one row (repeated keys of an item are
   summed; a row is bounded by the key vocabulary);
2. hash items into ``nb`` blocks and replicate each packed item to the ``nb`` unordered
   block pairs it takes part in (a generator, not a join); there are at least as many
   block pairs as the cluster has task slots;
3. ``groupBy(block pair).applyInPandas`` over batches: each group holds at most two blocks.  It
   orders the items by their largest key, multiplies tiles of both blocks, and
   skips a pair of tiles whose bound (the product of the tiles' largest unit-vector
   entries, summed over keys) is below the threshold.  Only pairs whose cosine can
   pass are emitted, tile by tile, and on request only those among an item's top k in the group.

Shuffle volume is ``nb`` times the packed vectors; a task's memory is bounded by
``TILE_BYTES`` for the dense tiles beside the packed rows of two blocks, however many pairs pass.  Rounding
and the strict threshold are applied to arrays before pairs leave, in the same
order as the reference (round to 4 places, then ``> threshold``): a decimal a pair would cost more than its cosine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


# Budget for the dense matrices of one pair of tiles.
TILE_BYTES = 256 * 1024 * 1024
# Packed entries of one block (12 bytes each, and as much again in the task).
BLOCK_ENTRIES = 8_000_000
# Pairs that leave a task at once, and that are held while the best of each item are looked for (24 and 32 bytes each).
ROWS_SENT, ROWS_HELD = 200_000, 500_000


def pack_vectors(vectors: DataFrame, item: str, key: str, value: str) -> DataFrame:
    """One row per item: item, keys[], values[] (sorted by key); a NULL item has no pairs, so none."""
    packed = vectors.filter(F.col(item).isNotNull()).groupBy(item).agg(
        F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"),
                                             F.col(value).cast("double").alias("v")))).alias("e"))
    return packed.select(item, F.col("e.k").alias("keys"), F.col("e.v").alias("vals"))


def _rounded(cos, scale):
    """As ``functions.half_up``: to 12 places, then half away from zero; NaN stays."""
    grain = 10 ** (12 - scale)
    whole = np.rint(np.nan_to_num(np.abs(cos)) * 1e12).astype(np.int64)
    return np.sign(cos) * ((whole + grain // 2) // grain) / 10.0 ** scale


class _Best:
    """The ``k`` best partners of each of ``n`` rows by (rounded cosine, smaller neighbour), tile by tile.

    Holds at most about ``ROWS_HELD`` rows, or three times ``n * k`` where that is more, and one tile's.
    """

    def __init__(self, ids, k, scale, least):
        self.ids, self.k, self.scale, self.least = ids, k, scale, least
        self.floor = np.full(len(ids), -np.inf)
        self.kept, self.new, self.size = None, [], 0

    def add(self, rows, others, cos, axis=0):
        """Partners of the rows ``rows``, along ``axis`` of ``cos``, among the rows ``others``; NaN is no partner."""
        unit = 10.0 ** -self.scale                           # what is further below the k-th than this is rounded lower
        floor = np.maximum(self.floor[rows] - unit, self.least)
        pick = cos >= (floor[:, None] if axis == 0 else floor)
        if np.count_nonzero(pick) > 2 * self.k * len(rows) and len(others) > self.k:
            best = np.partition(np.where(pick, -cos, np.inf), self.k - 1, axis=1 - axis)
            floor = -(best[:, self.k - 1] if axis == 0 else best[self.k - 1]) - unit
            pick &= cos >= (floor[:, None] if axis == 0 else floor)
        r, c = np.nonzero(pick)
        v = cos[r, c]
        if axis:
            r, c = c, r
        self.new.append((rows[r], others[c], v, _rounded(v, self.scale)))
        self.size += len(r)
        if self.size > max(ROWS_HELD, 2 * len(self.ids) * self.k):
            self.cut()

    def cut(self):
        x, y, v, rank = (np.concatenate(f) for f in zip(*([self.kept] if self.kept else []), *self.new))
        order = np.lexsort((self.ids[y], -rank, x))
        starts = np.concatenate(([True], x[order][1:] != x[order][:-1]))[:len(order)]
        place = np.arange(len(order)) - np.maximum.accumulate(np.where(starts, np.arange(len(order)), 0))
        last = order[place == self.k - 1]
        self.floor[x[last]] = rank[last]
        order = order[place < self.k]
        self.kept, self.new, self.size = (x[order], y[order], v[order], rank[order]), [], 0

    def pairs(self):
        """Each pair once, whichever end it is kept for."""
        if not self.kept and not self.new:
            return None
        self.cut()
        x, y, v, _ = self.kept
        _, first = np.unique(np.minimum(x, y) * len(self.ids) + np.maximum(x, y), return_index=True)
        return self.ids[x[first]], self.ids[y[first]], v[first]


def _pair_kernel(item: str, threshold: float | None, shared_norms: bool, margin: float, top_k: int | None,
                 tile_bytes: int, scale: int):
    """Build the per-group function, which sends on the pairs of a few tiles at a time."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pa.Table.from_batches(list(batches)).combine_chunks()
        column = lambda name: group[name].chunk(0)
        lo, hi = group["_blo"][0].as_py(), group["_bhi"][0].as_py()
        lens = column("keys").value_lengths().to_numpy(zero_copy_only=False)
        flat_k = column("keys").flatten().to_numpy(zero_copy_only=False)
        flat_v = column("vals").flatten().to_numpy(zero_copy_only=False)
        ids, kind = column(item).to_numpy(zero_copy_only=False), group.schema.field(item).type
        blk = column("_blk").to_numpy(zero_copy_only=False)
        del group
        keys = np.unique(flat_k)
        cols = np.searchsorted(keys, flat_k)
        first = np.cumsum(lens) - lens
        # three matrices for each side of a tile pair, two of the pair's own size
        tile = max(1, min(1024, int(tile_bytes // (8 * 6 * max(1, len(keys))))))

        def main_key(i):
            part = slice(first[i], first[i] + lens[i])
            return cols[part][np.abs(flat_v[part]).argmax()] if lens[i] else -1

        def dense(rows):
            """Unit vectors (NaN without a norm), their largest entries by key; for shared norms of vectors that lack keys
            the vectors and which keys they have."""
            m = np.zeros((len(rows), len(keys)))
            at = np.repeat(np.arange(len(rows)), lens[rows])
            src = np.repeat(first[rows], lens[rows]) + np.arange(len(at)) - np.repeat(np.cumsum(lens[rows]) - lens[rows], lens[rows])
            np.add.at(m, (at, cols[src]), flat_v[src])
            used = None
            if shared_norms:
                used = np.zeros((len(rows), len(keys)))
                used[at, cols[src]] = 1.0
                used = None if used.all() else used
            norm = np.sqrt((m * m).sum(axis=1))
            unit = m / np.where(norm > 0, norm, np.nan)[:, None]
            return unit, np.nan_to_num(np.abs(unit)).max(axis=0, initial=0.0), m if shared_norms else None, used

        def cosines(x, y):
            (a, _, m, ua), (b, _, n, ub) = x, y
            if ua is None and ub is None:                    # shared norms of vectors with all keys are full norms
                return a @ b.T
            ua, ub = np.ones_like(a) if ua is None else ua, np.ones_like(b) if ub is None else ub
            den = np.sqrt((m * m) @ ub.T) * np.sqrt(ua @ (n * n).T)
            return np.where(den > 0, m @ n.T / np.where(den > 0, den, 1.0), np.nan)

        def tiles(block):
            rows = np.nonzero(blk == block)[0]
            rows = rows[np.argsort([main_key(i) for i in rows], kind="stable")]
            return [rows[i:i + tile] for i in range(0, len(rows), tile)]

        def out(found):
            x, y, v = (np.concatenate(f) for f in zip(*found))
            for at in range(0, len(v), ROWS_SENT):
                part = slice(at, at + ROWS_SENT)
                ends = (pa.array(f(x[part], y[part]), type=kind, from_pandas=True) for f in (np.minimum, np.maximum))
                yield pa.RecordBatch.from_arrays([*ends, pa.array(v[part], from_pandas=True)], names=["a", "b", "cosine"])

        left = tiles(lo)
        right = left if lo == hi else tiles(hi)
        cells = sum(map(len, right)) * len(keys) * 8 * (3 if shared_norms else 1)
        held = [dense(r) for r in right] if cells <= tile_bytes // 2 else None     # else built for each tile of the left
        found, size = [], 0
        best = None if top_k is None else _Best(ids, top_k, scale, -np.inf if threshold is None else threshold - margin)
        for i, ra in enumerate(left):
            x = held[i] if held and lo == hi else dense(ra)
            for j in range(i if lo == hi else 0, len(right)):
                rb = right[j]
                y = x if rb is ra else held[j] if held else dense(rb)
                if threshold is not None and not shared_norms and x[1] @ y[1] <= threshold - margin:
                    continue
                cos = cosines(x, y)
                if best:
                    if threshold is None:                    # a pair without a cosine comes after all others
                        cos = np.where(np.isnan(cos), -2.0, cos)
                    if rb is ra:
                        np.fill_diagonal(cos, np.nan)
                    best.add(ra, rb, cos)
                    if rb is not ra:
                        best.add(rb, ra, cos, axis=1)
                    continue
                if rb is ra:
                    keep = np.triu(np.ones(cos.shape, bool), 1)
                    if threshold is not None:
                        keep &= cos > threshold - margin
                else:
                    keep = np.ones(cos.shape, bool) if threshold is None else cos > threshold - margin
                r, c = np.nonzero(keep)
                v = _rounded(cos[r, c], scale)
                if threshold is not None:
                    pass_ = v > threshold
                    r, c, v = r[pass_], c[pass_], v[pass_]
                found.append((ids[ra[r]], ids[rb[c]], v))
                size += len(r)
                if size >= ROWS_SENT:
                    yield from out(found)
                    found, size = [], 0
        if best and (pairs := best.pairs()):
            x, y, v = pairs
            v = _rounded(np.where(v < -1.5, np.nan, v), scale)
            pass_ = np.ones(len(v), bool) if threshold is None else v > threshold
            found = [(x[pass_], y[pass_], v[pass_])]
        if found:
            yield from out(found)

    return kernel


def _in_pandas(kernel):
    """The kernel over the batches of one group, for ``applyInPandas``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group = pa.RecordBatch.from_pandas(pd.concat(list(batches), ignore_index=True), preserve_index=False)
        for pairs in kernel(iter([group])):
            yield pairs.to_pandas()

    return run


def cosine_pairs(vectors: DataFrame, item: str = "movieId", key: str = "tagId",
                 value: str = "relevance", threshold: float | None = 0.85,
                 norms: str = "full", scale: int = 4, num_blocks: int | None = None,
                 out_a: str = "movie_id_a", out_b: str = "movie_id_b", out_sim: str = "similarity",
                 sort: bool = True, top_k: int | None = None, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """Pairs (a < b) with ``round(cosine, scale) > threshold``.

    ``norms='full'`` divides by each item's full L2 norm (true cosine);
    ``'shared'`` uses norms over the keys both items have, as the reference's
    per-pair aggregate does.  A zero norm gives NULL (and no pair under a
    threshold).  ``threshold=None`` returns every pair.  Values of a repeated
    (item, key) are summed.

    ``top_k`` drops pairs that are not among the ``top_k`` best of either item in their block pair, by
    (rounded cosine, smaller neighbour), so at most ``top_k`` pairs an item and block pair leave a task, ties
    included; rank the result to get the exact lists (``neighbours``).
    """
    packed = pack_vectors(vectors, item, key, value)
    if num_blocks is None:
        # Only the layout depends on this count.  Blocks hold BLOCK_ENTRIES entries at
        # most, and the block pairs cover the cluster's task slots four times, so that a few that fall
        # into one partition are no straggler.
        entries = vectors.count()
        slots = vectors.sparkSession.sparkContext.defaultParallelism
        num_blocks = max(math.ceil(entries / BLOCK_ENTRIES), math.ceil((math.sqrt(32 * slots + 1) - 1) / 2))
    nb = int(num_blocks)
    blk = F.pmod(F.xxhash64(F.col(item)), F.lit(nb)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("_oth")
    rep = packed.select("*", blk.alias("_blk")).select("*", other).select(
        item, "keys", "vals", "_blk",
        F.least("_blk", "_oth").alias("_blo"), F.greatest("_blk", "_oth").alias("_bhi"))
    id_type = vectors.schema[item].dataType
    schema = StructType([StructField("a", id_type), StructField("b", id_type),
                         StructField("cosine", DoubleType())])
    kernel = _pair_kernel(item, threshold, norms == "shared", 10.0 ** (-scale), top_k, tile_bytes, scale)
    raw = rep.groupBy("_blo", "_bhi").applyInPandas(_in_pandas(kernel), schema)
    out = raw.select(F.col("a").alias(out_a), F.col("b").alias(out_b), F.col("cosine").alias(out_sim))
    if sort:
        out = out.orderBy(F.col(out_sim).desc(), out_a, out_b)
    return out


# Largest id list that is broadcast by hint; larger lists use a plain semi-join.
BROADCAST_ROW_LIMIT = 1_000_000


def restrict_to(vectors: DataFrame, ids: DataFrame, item: str, bound: int | None = None) -> DataFrame:
    """Keep vectors of the given ids.

    ``bound`` is a proven upper limit on the number of ids (the N of a top-N
    list).  Only then, and only up to ``BROADCAST_ROW_LIMIT``, is the list
    broadcast; otherwise the semi-join is left to the planner and AQE.
    """
    side = ids.select(item)
    if bound is not None and bound <= BROADCAST_ROW_LIMIT:
        side = F.broadcast(side)
    return vectors.join(side, item, "left_semi")


def symmetric_pairs(pairs: DataFrame, a: str = "movie_id_a", b: str = "movie_id_b",
                    sim: str = "similarity") -> DataFrame:
    """Both directions of each stored (a < b) pair: item, neighbour, similarity."""
    fwd = pairs.select(F.col(a).alias("item"), F.col(b).alias("neighbour"), sim)
    bwd = pairs.select(F.col(b).alias("item"), F.col(a).alias("neighbour"), sim)
    return fwd.unionByName(bwd)


def neighbours(pairs: DataFrame, items: DataFrame, k: int = 10, item_id: str = "movie_id",
               title: str = "clean_title", a: str = "movie_id_a", b: str = "movie_id_b",
               sim: str = "similarity") -> DataFrame:
    """The ``k`` most similar items of every item, looked up in both directions.

    ``row_number() <= k`` is planned with a partial group limit before the
    shuffle, so a hub item moves at most ``k`` rows per input partition.
    """
    both = symmetric_pairs(pairs, a, b, sim)
    w = Window.partitionBy("item").orderBy(F.col(sim).desc(), F.col("neighbour"))
    top = both.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    names = items.select(F.col(item_id).alias("neighbour"), F.col(title).alias("neighbour_title"))
    return top.join(names, "neighbour", "left").select(
        F.col("item").alias(item_id), F.col("neighbour").alias("neighbour_id"),
        "neighbour_title", sim, "rank")


def neighbours_of(pairs: DataFrame, item_value, a: str = "movie_id_a", b: str = "movie_id_b",
                  sim: str = "similarity") -> DataFrame:
    """Point lookup of one item's neighbours from both directions of the pair table."""
    both = symmetric_pairs(pairs, a, b, sim)
    return both.filter(F.col("item") == F.lit(item_value)).select("neighbour", sim)


def explain_pairs(pairs: DataFrame, vectors: DataFrame, names: DataFrame, k: int = 3, item: str = "movieId",
                  key: str = "tagId", value: str = "relevance", name: str = "tag", a: str = "movie_id_a",
                  b: str = "movie_id_b") -> DataFrame:
    """The ``k`` keys that contribute most to each pair's dot product, with their names.

    Meant for chosen pairs (top neighbours): it joins each pair with the entries of
    both items.  Ties go to the smaller key.
    """
    left = vectors.select(F.col(item).alias(a), F.col(key), F.col(value).cast("double").alias("_va"))
    right = vectors.select(F.col(item).alias(b), F.col(key), F.col(value).cast("double").alias("_vb"))
    both = pairs.select(a, b).join(left, a).join(right, [b, key])
    w = Window.partitionBy(a, b).orderBy(F.col("contribution").desc(), key)
    top = (both.select(a, b, key, (F.col("_va") * F.col("_vb")).alias("contribution"))
           .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k))
    return top.join(names.select(key, name), key, "left").select(a, b, key, name, "contribution", "rank")
