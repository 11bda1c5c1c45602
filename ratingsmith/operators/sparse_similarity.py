"""Exact thresholded cosine of sparse vectors through an inverted index.

Unit vectors list their entries from the most to the least frequent key.  The leading entries whose norm stays
below the threshold are not indexed: of two vectors, that with the later boundary has all its earlier
entries unindexed, and these can add less than the threshold, so a pair that reaches it shares a key that both
index.  Indexed keys are the rare ones.  For every candidate the shared indexed entries give the product
from the later boundary on; the unindexed norm of that vector bounds the rest.  Only pairs whose sum of both
can pass are compared in full.

A vector goes whole to each key that it indexes, where it meets the others tile by tile; a pair that shares several
indexed keys is looked at by the first of them only.  So candidates are never written or shuffled: what moves is the
vectors, once for each indexed key, and what leaves a task is the pairs that pass.  A key that many vectors index is
cut into blocks of ``KEY_ITEMS`` of them, whose pairs are groups of their own.  Pairs that share no indexed key are
never formed.  For dense vectors use ``similarity.cosine_pairs``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ratingsmith.functions import half_up
from ratingsmith.operators.similarity import BLOCK_ENTRIES, ROWS_SENT, TILE_BYTES

# Vectors of one key that meet in one task (fewer where they are long).
KEY_ITEMS = 8192


@dataclass
class SparseJoin:
    """``candidates`` share an indexed key (with their bound), ``compared`` can pass, ``pairs`` do."""

    candidates: DataFrame
    compared: DataFrame
    pairs: DataFrame


def _meet(least: float, stage: str):
    """Pairs of the vectors that index one key: ``candidates`` and ``compared`` with their bound, or ``pairs`` with
    their cosine, from ``least`` on."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pa.Table.from_batches(list(batches)).combine_chunks()
        array = lambda name: group[name].chunk(0).to_numpy(zero_copy_only=False)
        flat = lambda name: group[name].chunk(0).flatten().to_numpy(zero_copy_only=False)
        lo, hi, kind = group["lo"][0].as_py(), group["hi"][0].as_py(), group.schema.field("i").type
        ids, blk, lead, head = (array(c) for c in ("i", "blk", "lead", "head"))
        lens = group["ks"].chunk(0).value_lengths().to_numpy(zero_copy_only=False)
        if len(ids) < 2:
            return
        # codes of the keys in the order of the index: the most frequent key first, then by key
        known, at = np.unique(flat("ks"), return_inverse=True)
        often = np.zeros(len(known), np.int64)
        often[at] = flat("fs")
        code = np.empty(len(known), np.int64)
        code[np.argsort(often, kind="stable")] = np.arange(len(known))
        cols, vals, first = code[at], flat("vs"), np.cumsum(lens) - lens
        here = code[np.searchsorted(known, group["key"][0].as_py())]
        edge = cols[first + lead]
        row = np.repeat(np.arange(len(ids)), lens)
        indexed = np.arange(len(cols)) - first[row] >= lead[row]
        # a key of one vector adds to no product
        shared = np.bincount(cols) > 1
        use = shared[cols]
        place = (np.cumsum(shared) - 1)[cols[use]]
        row, vals, indexed, earlier, width = row[use], vals[use], indexed[use], cols[use] < here, int(shared.sum())
        del group
        step = max(1, min(1024, TILE_BYTES // (8 * 8 * width)))

        def tiles(block):
            rows = np.nonzero(blk == block)[0]
            return [rows[i:i + step] for i in range(0, len(rows), step)]

        def dense(rows):
            start, stop = np.searchsorted(row, rows), np.searchsorted(row, rows, side="right")
            n = stop - start
            to, src = np.repeat(np.arange(len(rows)), n), np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())
            whole, index, met = (np.zeros((len(rows), width)) for _ in range(3))
            whole[to, place[src]] = vals[src]
            index[to, place[src]] = np.where(indexed[src], vals[src], 0.0)
            met[to, place[src]] = indexed[src] & earlier[src]
            return whole, index, met

        def out(found):
            x, y, v = (np.concatenate(f) for f in zip(*found))
            ends = (pa.array(f(ids[x], ids[y]), type=kind) for f in (np.minimum, np.maximum))
            return pa.RecordBatch.from_arrays([*ends, pa.array(v)], names=["a", "b", "value"])

        left = tiles(lo)
        right = left if lo == hi else tiles(hi)
        found, size = [], 0
        for i, ra in enumerate(left):
            a = dense(ra)
            for rb in right[i if lo == hi else 0:]:
                b = a if rb is ra else dense(rb)
                keep = a[2] @ b[2].T == 0
                if rb is ra:
                    keep &= np.arange(len(ra))[:, None] < np.arange(len(rb))[None, :]
                ea, eb, ha, hb = edge[ra][:, None], edge[rb][None, :], head[ra][:, None], head[rb][None, :]
                value = a[1] @ b[1].T + np.where(ea > eb, ha, np.where(ea < eb, hb, np.minimum(ha, hb)))
                if stage != "candidates":
                    keep &= value > least
                if stage == "pairs":
                    value = a[0] @ b[0].T
                    keep &= value > least
                r, c = np.nonzero(keep)
                for part in range(0, len(r), ROWS_SENT):
                    x, y = r[part:part + ROWS_SENT], c[part:part + ROWS_SENT]
                    found.append((ra[x], rb[y], value[x, y]))
                    size += len(x)
                    if size >= ROWS_SENT:
                        yield out(found)
                        found, size = [], 0
        if size:
            yield out(found)

    return kernel


def cosine_join(vectors: DataFrame, item: str = "movieId", key: str = "tagId", value: str = "relevance",
                threshold: float = 0.85, scale: int = 4, out_a: str = "movie_id_a", out_b: str = "movie_id_b",
                out_sim: str = "similarity") -> SparseJoin:
    """Pairs (a < b) with ``round(cosine, scale) > threshold``; the threshold must be positive.

    Values of a repeated (item, key) are summed.  Entries with NULLs are left out, and so are vectors whose norm is zero.
    The index is checkpointed when this is called, since every part of the result reads it.
    """
    if threshold <= 0:
        raise ValueError("an inverted index needs a positive threshold")
    least = threshold - 10.0 ** -scale
    entries = (vectors.select(F.col(item).alias("i"), F.col(key).alias("k"), F.col(value).cast("double").alias("v")).dropna()
               .groupBy("i", "k").agg(F.sum("v").alias("v")).filter("v <> 0"))
    norms = entries.groupBy("i").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm")).filter("norm > 0")
    often = entries.groupBy("k").agg((-F.count("*")).alias("f"))
    order = Window.partitionBy("i").orderBy("f", "k")
    whole = Window.partitionBy("i")
    upto = F.sum(F.col("v") * F.col("v")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    unit = entries.join(norms, "i").join(often, "k").select("i", "k", "f", (F.col("v") / F.col("norm")).alias("v"))
    unit = unit.withColumn("upto", upto).withColumn("indexed", F.col("upto") >= F.lit(max(least, 0.0) ** 2))
    unit = unit.select("i", "k", "f", "v", "indexed",
                       F.sqrt(F.coalesce(F.max(F.when(~F.col("indexed"), F.col("upto"))).over(whole), F.lit(0.0))).alias("head"),
                       F.min(F.struct("f", "k")).over(whole).alias("top")).checkpoint(eager=True)
    size = unit.agg(F.count("*").alias("n"), F.count_if(F.struct("f", "k") == F.col("top")).alias("items")).first()
    items = max(1, min(KEY_ITEMS, BLOCK_ENTRIES // max(1, -(-size["n"] // max(1, size["items"])))))
    load = unit.filter("indexed").groupBy("k").agg(F.ceil(F.count("*") / F.lit(items)).cast("int").alias("nb"))
    packed = unit.join(load, "k", "left").groupBy("i").agg(
        F.sort_array(F.collect_list(F.struct("f", "k", "v", "nb"))).alias("e"), F.count_if(~F.col("indexed")).cast("int").alias("lead"),
        F.max("head").alias("head"))
    # the vector goes to each key that it indexes, there to its block and to that block's pairs with the others
    sent = packed.select("*", F.explode(F.slice("e", F.col("lead") + 1, F.size("e") - F.col("lead"))).alias("g"))
    sent = sent.select("i", F.col("e.f").alias("fs"), F.col("e.k").alias("ks"), F.col("e.v").alias("vs"), "lead", "head",
                       F.col("g.k").alias("key"), F.pmod(F.xxhash64("i"), F.col("g.nb")).cast("int").alias("blk"),
                       F.explode(F.sequence(F.lit(0), F.col("g.nb") - 1)).alias("other"))
    sent = sent.select("*", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi")).drop("other")
    kind = vectors.schema[item].dataType.simpleString()
    met = lambda stage: sent.groupBy("key", "lo", "hi").applyInArrow(_meet(least, stage), f"a {kind}, b {kind}, value double")
    candidates = met("candidates").withColumnRenamed("value", "bound")
    compared = met("compared").select("a", "b")
    found = met("pairs").withColumnRenamed("value", "cosine")
    pairs = found.select(F.col("a").alias(out_a), F.col("b").alias(out_b), half_up(F.col("cosine"), scale).alias(out_sim))
    return SparseJoin(candidates, compared, pairs.filter(F.col(out_sim) > F.lit(threshold)))
