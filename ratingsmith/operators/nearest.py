"""The exact ``k`` most similar items of every item, by floors that skip whole block pairs.

1. Unit vectors go to the nearest of a bounded number of pivots and are laid out by (pivot, cosine to it) with a
   range exchange, so a pivot that draws a third of all items spreads over many tasks.  Blocks are cut from
   that order and never span two pivots: near items share a block.
2. A block is summed up by its centre and its widest angle.  By the triangle inequality no cosine between two blocks
   exceeds ``cos(angle of the centres - both widest angles)``.
3. The first round compares every block with itself and its ``probe`` most promising partners in one task, which
   emits ``k`` rows an item.  The ``k``-th of them is the item's floor: its true ``k``-th best is no lower.
4. The second round compares only block pairs whose bound reaches the lowest floor of a block that has not met the
   other, and emits only rows that reach their item's floor.  The other pairs are listed in ``skipped`` and never built.
   Blocks go to the tasks of this round in groups of at most ``GROUP_ENTRIES`` entries, so that a vector is sent once for
   each group that its own meets, not once for each block.

An item sends at most ``k`` rows from a task, ties included, since rows are ranked by (similarity, smaller
neighbour) where they arise.  Skipping depends on the data: vectors that lie in groups skip most pairs, directions
spread evenly over the sphere skip none, and then every pair is compared.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ratingsmith.operators.similarity import BLOCK_ENTRIES, TILE_BYTES, _rounded

# Pivot entries that go to every task (16 bytes each).
PIVOT_ENTRIES = 1_000_000
# Blocks whose bounds are worked out together.
BLOCK_TILE = 512
# Entries of a group of blocks that is sent to a task as a whole (16 bytes each, and as much again in the task).
GROUP_ENTRIES = 4_000_000
# Rounding of sums in double precision.
EPS = 1e-9


@dataclass
class Nearest:
    """``top``: item, neighbour, similarity, rank.  ``compared`` and ``skipped`` list block pairs with
    their bounds, ``emitted`` the rows that left the comparing tasks."""

    top: DataFrame
    compared: DataFrame
    skipped: DataFrame
    emitted: DataFrame


def unit_vectors(vectors: DataFrame, item: str, key: str, value: str) -> DataFrame:
    """One row per item: ``item``, ``keys`` and ``vals`` of length 1; entries with NULLs and zero vectors are left out."""
    entries = (vectors.select(F.col(item).alias("item"), F.col(key).alias("k"), F.col(value).cast("double").alias("v"))
               .dropna().groupBy("item", "k").agg(F.sum("v").alias("v")).filter("v <> 0"))
    packed = entries.groupBy("item").agg(F.sort_array(F.collect_list(F.struct("k", "v"))).alias("e"),
                                         F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    return packed.filter("norm > 0").select(
        "item", F.col("e.k").alias("keys"), F.transform("e.v", lambda v: v / F.col("norm")).alias("vals"))


def _flat(pdf):
    """Row numbers, keys and values of all entries of a frame of packed vectors."""
    lens = np.fromiter(map(len, pdf["keys"]), np.int64, len(pdf))
    return np.repeat(np.arange(len(pdf)), lens), np.concatenate(list(pdf["keys"])), np.concatenate(list(pdf["vals"]))


def _dense(entries, rows, known):
    """Dense matrix of the rows ``rows.start`` to ``rows.stop`` over the sorted keys ``known``."""
    at, keys, vals = entries
    first, last = np.searchsorted(at, (rows.start, rows.stop))
    out = np.zeros((rows.stop - rows.start, len(known)))
    out[at[first:last] - rows.start, np.searchsorted(known, keys[first:last])] = vals[first:last]
    return out


def _tiles(n, width, tile_bytes):
    step = max(1, min(1024, int(tile_bytes // (8 * 4 * max(1, width)))))
    return [range(i, min(i + step, n)) for i in range(0, n, step)]


def _nearest_pivot(pivots, tile_bytes):
    """Adds each vector's nearest pivot and the cosine to it."""
    known = np.unique(np.concatenate([p[0] for p in pivots]))
    matrix = np.zeros((len(pivots), len(known)))
    for i, (keys, vals) in enumerate(pivots):
        matrix[i, np.searchsorted(known, keys)] = vals

    def assign(frames):
        for pdf in frames:
            if not len(pdf):
                continue
            at, keys, vals = _flat(pdf)
            place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            met = known[place] == keys
            entries = at[met], keys[met], vals[met]
            best, near = np.zeros(len(pdf), np.int64), np.zeros(len(pdf))
            for rows in _tiles(len(pdf), len(known), tile_bytes):
                cos = _dense(entries, rows, known) @ matrix.T
                best[rows.start:rows.stop], near[rows.start:rows.stop] = cos.argmax(axis=1), cos.max(axis=1)
            yield pdf.assign(pivot=best, near=near)

    return assign


def _sum_up():
    """Centre and widest angle of one block."""

    def kernel(pdf):
        entries = _flat(pdf)
        known, code = np.unique(entries[1], return_inverse=True)
        centre = np.bincount(code, weights=entries[2], minlength=len(known))
        norm = np.sqrt(centre @ centre)
        cos = np.bincount(entries[0], weights=entries[2] * centre[code], minlength=len(pdf)) / norm if norm > 0 else np.full(len(pdf), -1.0)
        centre = centre / norm if norm > 0 else centre
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "keys": [known], "vals": [centre],
                             "angle": [float(np.arccos(np.clip(cos, -1, 1)).max())]})

    return kernel


def _bounds(tile_bytes):
    """Bounds of all block pairs between two groups of blocks, a block with itself included."""

    def kernel(pdf):
        low, high = (pdf[pdf["tile"] == pdf[side].iloc[0]].reset_index(drop=True) for side in ("tlo", "thi"))
        if not len(low) or not len(high):                   # no block fell into the other group
            return pd.DataFrame({"lo": [], "hi": [], "bound": []})
        ea, eb = _flat(low), _flat(high)
        known = np.union1d(ea[1], eb[1])
        out = []
        for ra in _tiles(len(low), len(known), tile_bytes):
            a = _dense(ea, ra, known)
            for rb in _tiles(len(high), len(known), tile_bytes):
                cos = np.clip(a @ _dense(eb, rb, known).T, -1, 1)
                wide = low["angle"].to_numpy()[ra.start:ra.stop, None] + high["angle"].to_numpy()[None, rb.start:rb.stop]
                bound = np.cos(np.maximum(0.0, np.arccos(cos) - wide))
                x, y = np.broadcast_arrays(low["block"].to_numpy()[ra.start:ra.stop, None], high["block"].to_numpy()[None, rb.start:rb.stop])
                keep = x <= y if pdf["tlo"].iloc[0] == pdf["thi"].iloc[0] else np.ones(x.shape, bool)
                out.append(pd.DataFrame({"lo": np.minimum(x, y)[keep], "hi": np.maximum(x, y)[keep], "bound": bound[keep]}))
        return pd.concat(out)

    return kernel


def _best(ids, others, sim, floors, k):
    """Of a matrix of similarities, each row's ``k`` best that reach its floor, and ties with the last of them."""
    sim = np.where(sim >= floors[:, None], sim, -np.inf)
    if sim.shape[1] > k:
        sim = np.where(sim >= -np.partition(-sim, k - 1, axis=1)[:, k - 1:k], sim, -np.inf)
    r, c = np.nonzero(sim > -np.inf)
    return pd.DataFrame({"item": ids[r], "neighbour": others[c], "similarity": sim[r, c]})


def _ranked(found, k):
    rows = pd.concat(found).sort_values(["item", "similarity", "neighbour"], ascending=[True, False, True])
    return rows[rows.groupby("item").cumcount() < k]


def _compare(k, threshold, scale, tile_bytes, both):
    """The best ``k`` partners of every item of block ``a`` among the rows of ``b``; if ``both``, the other way as well.

    Without ``both`` the rows of ``b`` hold those of ``a`` too, and an item is not its own partner.
    """

    def kernel(pdf):
        own = (pdf["block"] == pdf["a"]).to_numpy()
        one = pdf[own].reset_index(drop=True)
        other = pdf[~own].reset_index(drop=True) if both else pd.concat((one, pdf[~own]), ignore_index=True)
        ids, entries, floors = zip(*((s["item"].to_numpy(), _flat(s), s["floor"].to_numpy()) for s in (one, other)))
        known = np.unique(np.concatenate([e[1] for e in entries]))
        found = []
        for ra in _tiles(len(one), len(known), tile_bytes):
            a, sa = _dense(entries[0], ra, known), slice(ra.start, ra.stop)
            for rb in _tiles(len(other), len(known), tile_bytes):
                sb = slice(rb.start, rb.stop)
                sim = _rounded(a @ _dense(entries[1], rb, known).T, scale)
                if threshold is not None:
                    sim[sim <= threshold] = -np.inf
                if both:
                    found.append(_best(ids[1][sb], ids[0][sa], sim.T, floors[1][sb], k))
                else:
                    sim[np.arange(ra.start, ra.stop)[:, None] == np.arange(rb.start, rb.stop)[None, :]] = -np.inf
                found.append(_best(ids[0][sa], ids[1][sb], sim, floors[0][sa], k))
        return _ranked(found, k)

    return kernel


def _compare_groups(k, threshold, scale, tile_bytes):
    """``_compare`` both ways of the block pairs ``pairs`` between two groups of blocks, whose vectors are ``rows``."""
    compare = _compare(k, threshold, scale, tile_bytes, True)

    def kernel(rows, pairs):
        blocks = {b: part for b, part in rows.groupby("block")}
        found, size = [], 0
        for lo, hi, due in zip(pairs["lo"], pairs["hi"], pairs["due"]):
            # a block that is not due takes part as partner only: no similarity reaches its floor of 3
            ends = [blocks[b] if b in due else blocks[b].assign(floor=3.0) for b in (lo, hi)]
            found.append(compare(pd.concat(ends).assign(a=lo)))
            size += len(found[-1])
            if size > 2 * k * len(rows):
                found = [_ranked(found, k)]
                size = len(found[0])
        return _ranked(found, k) if found else pd.DataFrame({"item": [], "neighbour": [], "similarity": []})

    return kernel


def top_k(vectors: DataFrame, k: int, item: str = "movieId", key: str = "tagId", value: str = "relevance",
          threshold: float | None = None, scale: int = 4, probe: int = 2, block_items: int | None = None,
          tile_bytes: int = TILE_BYTES) -> Nearest:
    """The ``k`` items with the highest ``round(cosine, scale)`` of every item; ties go to the smaller neighbour.

    ``threshold`` keeps only similarities above it.  Values of a repeated (item, key) are summed; entries with
    NULLs and zero vectors are left out; an empty table gives an empty result.  Blocks hold ``block_items`` items,
    by default four times the square root of their number, and no more than BLOCK_ENTRIES entries.
    """
    if k < 1:
        raise ValueError("k must be positive")
    spark = vectors.sparkSession
    units = unit_vectors(vectors, item, key, value).checkpoint(eager=True)
    kind = units.schema["item"].dataType
    size = units.agg(F.count("*").alias("n"), F.max(F.size("keys")).alias("long")).first()
    rows = StructType([StructField("item", kind), StructField("neighbour", kind), StructField("similarity", DoubleType())])
    if not size.n:
        none = spark.createDataFrame([], rows)
        pairs = spark.createDataFrame([], "lo long, hi long, bound double")
        return Nearest(none.withColumn("rank", F.lit(1)), pairs, pairs, none)
    items = max(1, min(block_items or max(128, math.ceil(4 * math.sqrt(size.n))), BLOCK_ENTRIES // size.long))
    blocks = math.ceil(size.n / items)

    # pivots: a bounded number of whole vectors, chosen by a hash of the item
    count = max(1, min(2 * blocks, PIVOT_ENTRIES // size.long))
    pivots = [(np.asarray(r["keys"]), np.asarray(r["vals"]))
              for r in units.orderBy(F.xxhash64("item"), "item").limit(count).collect()]
    schema = StructType([*units.schema.fields, *spark.createDataFrame([], "pivot long, near double").schema.fields])
    near = units.mapInPandas(_nearest_pivot(pivots, tile_bytes), schema)
    laid = (near.repartitionByRange(min(1 << 20, math.ceil(blocks / 4)), "pivot", "near", F.xxhash64("item"))
            .sortWithinPartitions("pivot", "near").withColumn("_at", F.monotonically_increasing_id()))
    # a block ends after ``items`` rows and where the pivot changes: (task, pivot, place) in 20, 20 and 23 bits
    cut = F.floor(F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) / F.lit(items)).cast("long")
    block = F.shiftleft(F.shiftright("_at", 33), 43) + F.shiftleft("pivot", 23) + cut
    laid = laid.select("item", "keys", "vals", block.alias("block")).checkpoint(eager=True)

    # bounds of block pairs, from one summary a block
    keys, vals = units.schema["keys"], units.schema["vals"]
    summary = laid.groupBy("block").applyInPandas(_sum_up(), StructType(
        [laid.schema["block"], keys, vals, StructField("angle", DoubleType())])).checkpoint(eager=True)
    groups = math.ceil(summary.count() / BLOCK_TILE)
    tiles = summary.withColumn("tile", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("long"))
    meet = tiles.withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).select(
        "*", F.least("tile", "_o").alias("tlo"), F.greatest("tile", "_o").alias("thi")).drop("_o")
    bounds = meet.groupBy("tlo", "thi").applyInPandas(_bounds(tile_bytes), "lo long, hi long, bound double")
    bounds = bounds.checkpoint(eager=True)

    # round 1: every block against itself and its most promising partners gives each item a floor
    apart = bounds.filter("lo <> hi").select("lo", "hi", "bound")
    sides = apart.select("lo", "hi", "bound", F.explode(F.array("lo", "hi")).alias("block"))
    order = Window.partitionBy("block").orderBy(F.col("bound").desc(), "lo", "hi")
    promising = sides.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= probe).select(
        F.col("block").alias("a"), F.when(F.col("lo") == F.col("block"), F.col("hi")).otherwise(F.col("lo")).alias("block"))
    reach = promising.unionByName(bounds.filter("lo = hi").select(F.col("lo").alias("a"), F.col("lo").alias("block"))).checkpoint(eager=True)
    start = laid.withColumn("floor", F.lit(-2.0 if threshold is None else float(threshold)))
    found = (start.join(reach, "block").groupBy("a")
             .applyInPandas(_compare(k, threshold, scale, tile_bytes, False), rows).checkpoint(eager=True))

    # round 2: only pairs whose bound reaches the floor of a block that has not met the other yet
    kth = found.groupBy("item").agg(F.min("similarity").alias("_kth"), F.count("*").alias("_n")).filter(F.col("_n") == k)
    floors = start.join(kth.select("item", "_kth"), "item", "left").select(
        "item", "keys", "vals", "block", F.coalesce("_kth", "floor").alias("floor")).checkpoint(eager=True)
    lowest = floors.groupBy("block").agg(F.min("floor").alias("least"))
    half = 0.5 * 10.0 ** -scale + EPS                       # a similarity is rounded up by no more
    met = reach.select(F.least("a", "block").alias("lo"), F.greatest("a", "block").alias("hi"), "a").filter("lo <> hi")
    due = (sides.join(met.withColumnRenamed("a", "block"), ["lo", "hi", "block"], "left_anti").join(lowest, "block")
           .filter(F.col("bound") + F.lit(half) >= F.col("least")).select("lo", "hi", F.col("block").alias("due")))
    ends = due.groupBy("lo", "hi").agg(F.collect_set("due").alias("due")).checkpoint(eager=True)
    # groups of blocks meet, and in them the blocks that are due; at least four pairs of groups for each task slot
    slots = spark.sparkContext.defaultParallelism
    parties = max(math.ceil(size.n * size.long / GROUP_ENTRIES), math.ceil((math.sqrt(32 * slots + 1) - 1) / 2))
    party = lambda c: F.pmod(F.xxhash64(c), F.lit(parties)).cast("int")
    pairs = ends.withColumns({"glo": F.least(party("lo"), party("hi")), "ghi": F.greatest(party("lo"), party("hi"))})
    goes = pairs.select(F.col("glo").alias("one"), F.col("ghi").alias("other"), F.explode(F.array("lo", "hi")).alias("block")).distinct()
    sent = floors.join(goes, "block").select("one", "other", "item", "keys", "vals", "block", "floor")
    more = sent.groupBy("one", "other").cogroup(pairs.groupBy("glo", "ghi")).applyInPandas(
        _compare_groups(k, threshold, scale, tile_bytes), rows)
    emitted = found.unionByName(more).checkpoint(eager=True)
    rank = Window.partitionBy("item").orderBy(F.col("similarity").desc(), "neighbour")
    top = emitted.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
    seen = ends.select("lo", "hi").union(met.select("lo", "hi")).union(bounds.filter("lo = hi").select("lo", "hi"))
    compared = bounds.join(seen, ["lo", "hi"], "left_semi")
    return Nearest(top, compared, bounds.join(seen, ["lo", "hi"], "left_anti"), emitted)
