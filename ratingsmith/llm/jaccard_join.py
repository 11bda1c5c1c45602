"""Similarity join on word shingles with signature trees (operator 6).

A document's set holds its distinct shingles of WIDTH = 5 words (A-Z lower-cased;
with fewer words the whole sequence is the one shingle; without words the set is
empty and linked with nothing).  Two documents link when
``100 * |intersection| >= 80 * |union|``; the result names each document's
connected component.  The join is exact on 64-bit shingle hashes.

Signature tree.  The leaves hold documents sorted by set size; every node has the
OR of its documents' token bitmaps, its range of set sizes, and the largest number
of tokens that share a bit with another of the same document.  A dual traversal
starts at the root against itself and drops a pair of nodes when their size ranges
cannot reach the threshold, when the common bits bound the overlap below it, or
when all their documents are known to be connected.  Pairs of documents that
remain are intersected exactly.

Distribution.  A tree needs the documents that may link in one place.  With any
one order of the shingles, sets that link share a shingle among the first
``n - ceil(0.8 n) + 1`` of each, so

1. frequent shingles are counted; the at most FREQUENT ones with the highest
   counts are broadcast and ordered last, the others by hash (any choice is
   correct, as every document sees the same order).  With ``l(n) - 1`` further
   shingles, l(n) = 1 + n // EXTRA, linked sets share at least l(ceil(0.8 n)) of the
   first ones.  These are exchanged (``packed``), and documents that share so many with
   others of a fitting size are candidates;
2. the candidates' infrequent shingles are counted exactly, and the first ones in
   order of that count (rare ones first) are exchanged; documents that share one are
   connected by star edges, and coarse groups are the components;
3. each coarse group is joined by trees, small groups packed together, a large one
   cut into tiles of bounded size;
4. for a large group, the representatives of the tiles' components are joined in
   turn; then every document outside the group's largest component is routed, by its
   first shingles (rare ones first) and its size, to those tiles of documents of like size
   that can hold a partner, and joined with them by a tree.  Two documents that are not
   connected by then have been compared, lie in one component, or share no first
   shingle, so no link is lost, while a group of near copies costs
   one comparison a document instead of one a pair.

Equal texts are one member throughout.  A task sends a shingle once, with star
edges among its own documents, so hot shingles are never gathered.

Defined cases.  NULL text: empty set, own component.  Repeated rows and equal
texts link (unless empty).  NULL document ids are ignored in the smallest id of a
component, which is NULL if there is no other.  Other columns pass through, result
columns replace input columns of the same name.  Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, packed, words

U = np.uint64
WIDTH, PERCENT = 5, 80
#: One further shingle is exchanged for this many of a set, to tell chance meetings from likely links.
EXTRA = 16
#: Bits of a document's signature, documents of a leaf, children of a node.
BITS, LEAF, FAN = 4096, 8, 8
#: Frequent shingles in the broadcast order (9 bytes each).
FREQUENT = 2_000_000
#: Documents and shingles of one tile, entries a task gathers (shingles when it only counts), entries of one bucket.
TILE, TILE_TOKENS, FLUSH, COUNTED_AT_ONCE, BUCKET = 1024, 1_000_000, 1_500_000, 3_000_000, 1_500_000

COUNTS = packed.schema("h", "c")
SHARED, COUNTED = packed.schema("h", "k", "lo", "hi", "f", "ck", "cc", "mk", "mn"), packed.schema("ck", "cc", "mk", "mn")
ENTRY, FOUND = packed.schema("h", "k", "lo", "hi", "a", "b"), packed.schema("a", "b")
TOKENS, PLACES = packed.schema("h", "k", "p"), packed.schema("k", "p", "c")
#: Counts of shingles are exact up to this; frequent ones come after all others.
MOST = 60_000


# ---------------------------------------------------------------- sets

def sets(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(shingle hashes, sorted within each row, row sizes)`` of one run of ``words.buffers``."""
    s, _, h = words.word_hashes(buf, lower=True)
    first = words.per_row(starts, s)
    n = np.diff(first)
    row = np.repeat(np.arange(len(n)), n)
    g = words.window_hashes(h, WIDTH)
    inside = row[:len(g)] == row[len(h) - len(g):]
    g, r = g[inside], row[:len(g)][inside]
    short = np.flatnonzero((n > 0) & (n < WIDTH))
    if len(short):
        few = np.array([words.window_hashes(h[first[i]:first[i + 1]], int(n[i]))[0] for i in short], U)
        g, r = np.concatenate((g, few)), np.concatenate((r, short))
    order = np.argsort(g)
    order = order[np.argsort(r[order].astype(np.uint16), kind="stable")]     # a radix sort
    g, r = g[order], r[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
    g, r = g[new], r[new]
    return g, np.bincount(r, minlength=len(n))


def needed(n: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of a set of ``n`` shingles with one it links to, and least size of that one."""
    return (n * percent + 99) // 100


def prefix_sizes(n: np.ndarray, percent: int, further: bool) -> np.ndarray:
    return np.where(n > 0, n - needed(n, percent) + 1 + (n // EXTRA if further else 0), 0)


def _sets_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(keys, shingles, sizes)`` of runs of rows."""
    keys = np.asarray(batch["k"]).view(U)
    for at, rows, buf, starts in words.buffers(batch["text"], most=60_000):
        yield (keys[at:at + rows], *sets(buf, starts))


def _prefixes(g: np.ndarray, n: np.ndarray, key: np.ndarray, percent: int, further: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Each row's first shingles in order of ``key``, then hash -> ``(shingles, row)``; ``g`` is sorted in rows."""
    row = np.repeat(np.arange(len(n)), n)
    at = np.argsort(key, kind="stable")
    at = at[np.argsort(row[at].astype(np.uint16), kind="stable")]
    keep = words.ragged(n) < np.repeat(prefix_sizes(n, percent, further), n)
    return g[at][keep], row[keep]


def _each_text_once(k: np.ndarray, g: np.ndarray, n: np.ndarray, seen: set[int]):
    """Drops rows whose text this task has already in its present gathering."""
    keep = np.zeros(len(k), bool)
    for i, x in enumerate(k.tolist()):
        if x not in seen:
            seen.add(x)
            keep[i] = True
    return k[keep], g[np.repeat(keep, n)], n[keep]


# ---------------------------------------------------------------- 1. frequent shingles

def count_shingles(n_buckets: int):
    def run(batches):
        held, count, seen = [], 0, set()

        def send():
            h, c = np.unique(np.concatenate(held), return_counts=True)
            h, c = h[c > 1], c[c > 1]
            return packed.pack(packed.bucket_of(h, n_buckets), {"h": h, "c": c.astype(np.uint32)})

        for batch in batches:
            for k, g, n in _sets_of(batch):
                _, g, _ = _each_text_once(k, g, n, seen)
                held.append(g)
                count += len(g)
                if count >= COUNTED_AT_ONCE:
                    yield send()
                    held, count, seen = [], 0, set()
        if held:
            yield send()
    return run


def add_counts(tbl: pa.Table) -> pa.Table:
    h, c = packed.unpack(tbl, "h", U), packed.unpack(tbl, "c", np.uint32)
    h, which = np.unique(h, return_inverse=True)
    c = np.bincount(which, c, minlength=len(h)).astype(np.int64)
    h, c = h[c > 3], c[c > 3]
    return pa.table({"h": pa.array(h.view(np.int64), pa.int64()),
                     "level": pa.array(np.log2(c).astype(np.int32) if len(c) else [], pa.int32())})


class Order:
    """Frequency level of the frequent shingles; all others have level 0."""

    def __init__(self, h: np.ndarray, level: np.ndarray):
        at = np.argsort(h)
        self.h, self.level = h[at], level[at].astype(np.uint8)

    def levels(self, g: np.ndarray) -> np.ndarray:
        if not len(self.h):
            return np.zeros(len(g), np.uint8)
        at = np.minimum(np.searchsorted(self.h, g), len(self.h) - 1)
        return np.where(self.h[at] == g, self.level[at], 0).astype(np.uint8)


def frequent(rows: DataFrame, n_buckets: int, stages: common.Stages, most: int) -> Order:
    """The at most ``most`` shingles of the highest count levels."""
    found = stages.put(rows.mapInArrow(common.map_batches(count_shingles(n_buckets)), COUNTS).groupBy("bucket")
                       .applyInArrow(common.map_group(add_counts), "h long, level int"), "counts")
    total, least = 0, 99
    for level, n in sorted(((r["level"], r["count"]) for r in found.groupBy("level").count().collect()), reverse=True):
        if total + n > most:
            break
        total, least = total + n, level
    got = found.filter(F.col("level") >= least).toArrow()
    stages.drop("counts")
    return Order(np.asarray(got["h"]).astype(np.int64).view(U), np.asarray(got["level"]))


# ---------------------------------------------------------------- 1., 2. candidates and coarse groups

def _fitting_runs(h: np.ndarray, lo: np.ndarray, hi: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by hash and size, and the starts of runs without a gap that no two linked sets can span.

    An entry stands for sets of sizes ``lo`` to ``hi``.
    """
    order = np.lexsort((lo, h))
    h, lo, hi = h[order], lo[order], hi[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    base = np.cumsum(new, dtype=np.int64) << 33
    most = np.maximum.accumulate(hi + base) - base            # largest size so far under this hash
    new[1:] |= 100 * most[:-1] < percent * lo[1:].astype(np.int64)
    return order, np.flatnonzero(new)


def _stars(h: np.ndarray, k: np.ndarray, lo: np.ndarray, hi: np.ndarray, percent: int):
    """Per run its hash, smallest key and sizes, and links from its other keys to that one."""
    if not len(h):
        return h, k, lo, hi, k, k
    order, first = _fitting_runs(h, lo, hi, percent)
    h, k, lo, hi = h[order], k[order], lo[order], hi[order]
    low = np.minimum.reduceat(k, first)
    rep = np.repeat(low, packed.run_sizes(first, len(h)))
    far = k != rep
    a, b = _links(k[far], rep[far])
    return h[first], low, lo[first], np.maximum.reduceat(hi, first), a, b


def _links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _rows(n: int, names: str, *parts: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows for the exchange: each part is cut by its first column; blobs a row lacks are empty."""
    columns = [c.split()[0] for c in names.split(", ")][1:]
    for part in parts:
        key = next(iter(part.values()))
        if len(key):
            rows = packed.pack(packed.bucket_of(key, n), part)
            has = dict(zip(rows.schema.names, rows.columns, strict=True))
            yield pa.RecordBatch.from_arrays(
                [has["bucket"], *(has.get(c, pa.array([b""] * rows.num_rows, pa.binary())) for c in columns)],
                names=["bucket", *columns])


def _table(rows: Iterator[pa.RecordBatch], names: str) -> pa.Table:
    kinds = [("bucket", pa.int32()), *((c.split()[0], pa.binary()) for c in names.split(", ")[1:])]
    return pa.Table.from_batches(list(rows), pa.schema(kinds))


def send_shared(n_buckets: int, percent: int, sent):
    """First shingles (and the further ones) by frequency level and hash, and the set sizes.

    A run of documents that share a shingle within this task is sent once, marked; its
    documents are counted here.
    """
    def run(batches):
        h, k, size, keys, sizes, seen, count = [], [], [], [], [], set(), 0

        def send():
            hs, ks, n = np.concatenate(h), np.concatenate(k), np.concatenate(size)
            h.clear(), k.clear(), size.clear()
            order, first = _fitting_runs(hs, n, n, percent)
            hs, ks, n = hs[order], ks[order], n[order]
            many = packed.run_sizes(first, len(hs))
            ck, cc = np.unique(ks[np.repeat(many > 1, many)], return_counts=True)
            top = np.maximum.reduceat(n, first) if len(first) else n
            low = n[first]
            yield from _rows(n_buckets, SHARED,
                             {"h": hs[first], "k": ks[first], "lo": low.astype(np.uint32), "hi": (top - low).astype(np.uint32),
                              "f": (many > 1).astype(np.uint8)},
                             {"ck": ck, "cc": cc.astype(np.uint32)},
                             {"mk": np.concatenate(keys), "mn": np.concatenate(sizes).astype(np.uint32)})

        for batch in batches:
            for key, g, n in _sets_of(batch):
                key, g, n = _each_text_once(key, g, n, seen)
                g, row = _prefixes(g, n, sent.value.levels(g), percent, further=True)
                h.append(g)
                k.append(key[row])
                size.append(n[row].astype(np.int32))
                keys.append(key)
                sizes.append(n)
                count += len(g)
                if count >= FLUSH:
                    yield from send()
                    h, k, size, keys, sizes, seen, count = [], [], [], [], [], set(), 0
        if keys:
            yield from send()
    return run


def count_shared(n_buckets: int, percent: int):
    """Bucket -> per key the number of its shingles that others of a fitting size share, and the set sizes."""
    def run(tbl: pa.Table) -> pa.Table:
        h, k = packed.unpack(tbl, "h", U), packed.unpack(tbl, "k", U)
        lo = packed.unpack(tbl, "lo", np.uint32).astype(np.int64)
        hi = lo + packed.unpack(tbl, "hi", np.uint32)
        f = packed.unpack(tbl, "f", np.uint8)
        order, first = _fitting_runs(h, lo, hi, percent) if len(h) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        many = packed.run_sizes(first, len(h))
        hit = order[np.repeat(many > 1, many)]
        # a text that lies in several tasks meets itself, which only makes it a candidate
        ck, cc = _sums(np.concatenate((k[hit[f[hit] == 0]], packed.unpack(tbl, "ck", U))),
                       np.concatenate((np.ones(int((f[hit] == 0).sum()), np.int64), packed.unpack(tbl, "cc", np.uint32))))
        return _table(_rows(n_buckets, COUNTED, {"ck": ck, "cc": cc.astype(np.uint32)},
                            {"mk": packed.unpack(tbl, "mk", U), "mn": packed.unpack(tbl, "mn", np.uint32)}), COUNTED)
    return run


def _sums(k: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    k, which = np.unique(k, return_inverse=True)
    return k, np.bincount(which, c, minlength=len(k)).astype(np.int64)


def sizes_and_shares(tbl: pa.Table) -> pa.Table:
    """Bucket of keys -> rows ``(k, n, shared)``."""
    ck, cc = _sums(packed.unpack(tbl, "ck", U), packed.unpack(tbl, "cc", np.uint32))
    mk, at = np.unique(packed.unpack(tbl, "mk", U), return_index=True)
    shared = np.zeros(len(mk), np.int64)
    shared[np.searchsorted(mk, ck)] = cc
    return pa.table({"k": pa.array(mk.view(np.int64), pa.int64()),
                     "n": pa.array(packed.unpack(tbl, "mn", np.uint32)[at].astype(np.int64), pa.int64()),
                     "shared": pa.array(shared, pa.int64())})


def meet(n_buckets: int, percent: int):
    """Bucket -> links of keys that share a hash, and the links that came along."""
    def run(tbl: pa.Table) -> pa.Table:
        lo = packed.unpack(tbl, "lo", np.uint32).astype(np.int64)
        *_, a, b = _stars(packed.unpack(tbl, "h", U), packed.unpack(tbl, "k", U), lo,
                          lo + packed.unpack(tbl, "hi", np.uint32), percent)
        a, b = _links(np.concatenate((a, packed.unpack(tbl, "a", U))), np.concatenate((b, packed.unpack(tbl, "b", U))))
        return _table(_rows(n_buckets, FOUND, {"a": a, "b": b}), FOUND)
    return run


def settle(tbl: pa.Table) -> pa.Table:
    a, b = _links(packed.unpack(tbl, "a", U), packed.unpack(tbl, "b", U))
    return pa.table({"a": pa.array(a.view(np.int64), pa.int64()), "b": pa.array(b.view(np.int64), pa.int64())})


def send_tokens(n_buckets: int, sent):
    """All infrequent shingles of distinct texts, with their place in the set."""
    def run(batches):
        for batch in batches:
            held = []
            for k, g, n in _sets_of(batch):
                rare = sent.value.levels(g) == 0
                held.append((g[rare], np.repeat(k, n)[rare], words.ragged(n)[rare].astype(np.uint32)))
            if held:
                h, k, p = (np.concatenate(c) for c in zip(*held, strict=True))
                yield packed.pack(packed.bucket_of(h, n_buckets), {"h": h, "k": k, "p": p})
    return run


def recount(n_buckets: int):
    """Bucket -> places of shingles that two or more texts have, with their number of texts."""
    def run(tbl: pa.Table) -> pa.Table:
        h = packed.unpack(tbl, "h", U)
        order = np.argsort(h)
        first = packed.runs(h[order])
        size = packed.run_sizes(first, len(h))
        c = np.repeat(size, size)
        hit = order[c > 1]
        k = packed.unpack(tbl, "k", U)[hit]
        out = packed.pack((k % U(n_buckets)).astype(np.int32), {
            "k": k, "p": packed.unpack(tbl, "p", np.uint32)[hit], "c": np.minimum(c[c > 1], MOST).astype(np.uint16)})
        return pa.Table.from_batches([out])
    return run


def by_text(tbl: pa.Table) -> pa.Table:
    """Bucket of keys -> one row a text with places and counts."""
    k, p, c = packed.unpack(tbl, "k", U), packed.unpack(tbl, "p", np.uint32), packed.unpack(tbl, "c", np.uint16)
    order = np.argsort(k, kind="stable")
    k, p, c = k[order], p[order], c[order]
    cut = packed.cuts(k)
    return pa.table({"k": pa.array(k[packed.runs(k)].view(np.int64), pa.int64()),
                     "p": pa.array([p[i:j].tobytes() for i, j in cut], pa.binary()),
                     "c": pa.array([c[i:j].tobytes() for i, j in cut], pa.binary())})


def send_rare_prefixes(n_buckets: int, percent: int, sent):
    """First shingles by exact count and hash (frequent ones come last, by level), and the links within the task."""
    def run(batches):
        hs, ks, ns, count = [], [], [], 0

        def send():
            n = np.concatenate(ns)
            h, k, lo, hi, a, b = _stars(np.concatenate(hs), np.concatenate(ks), n, n, percent)
            yield from _rows(n_buckets, ENTRY, {"h": h, "k": k, "lo": lo.astype(np.uint32), "hi": (hi - lo).astype(np.uint32)},
                             {"a": a, "b": b})

        for batch in batches:
            places, counts, row = batch["p"], batch["c"], 0
            for k, g, n in _sets_of(batch):
                level = sent.value.levels(g)
                key = np.where(level > 0, MOST + level.astype(np.int64), 1).astype(np.uint16)
                start = np.cumsum(n) - n
                for i in range(len(k)):
                    if places[row + i].is_valid:
                        p = np.frombuffer(places[row + i].as_buffer(), np.uint32)
                        key[start[i] + p.astype(np.int64)] = np.frombuffer(counts[row + i].as_buffer(), np.uint16)
                row += len(k)
                g, at = _prefixes(g, n, key, percent)
                hs.append(g)
                ks.append(k[at])
                ns.append(n[at])
                count += len(g)
                if count >= FLUSH:
                    yield from send()
                    hs, ks, ns, count = [], [], [], 0
        if hs:
            yield from send()
    return run


# ---------------------------------------------------------------- 3. trees

class Forest:
    """Union-find over the documents of a tile."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)

    def one(self, items: list[int]) -> bool:
        first = self.find(items[0])
        return all(self.find(x) == first for x in items)


class Tree:
    """Signature tree over token sets (sorted arrays); ``fresh`` marks those that must be compared."""

    def __init__(self, tokens: list[np.ndarray], fresh: np.ndarray, percent: int):
        size = np.array([len(t) for t in tokens], np.int64)
        low = np.array([t[0] if len(t) else 0 for t in tokens], U)
        self.order = np.lexsort((low, size))
        self.tokens, self.percent = tokens, percent
        bits = np.zeros((len(tokens), BITS), bool)
        row = np.repeat(np.arange(len(tokens)), size)
        if len(row):
            bits[row, (np.concatenate(tokens) % U(BITS)).astype(np.int64)] = True
        sign = np.packbits(bits, axis=1).view(U)[self.order]
        size = size[self.order]
        extra = size - np.bitwise_count(sign).sum(axis=1).astype(np.int64)
        #: Level 0 has documents; each level: signatures, least and most tokens, most extra tokens, any fresh.
        self.levels = [(sign, size, size, extra, fresh[self.order])]
        width = LEAF
        while len(self.levels[-1][1]) > 1:
            sign, least, most, extra, new = self.levels[-1]
            cut = np.arange(0, len(least), width)
            self.levels.append((np.bitwise_or.reduceat(sign, cut), np.minimum.reduceat(least, cut),
                                np.maximum.reduceat(most, cut), np.maximum.reduceat(extra, cut),
                                np.logical_or.reduceat(new, cut)))
            width = FAN
        self.span = [1]
        for level in range(1, len(self.levels)):
            self.span.append(LEAF * FAN ** (level - 1))

    def members(self, level: int, i: int) -> list[int]:
        return self.order[i * self.span[level]:(i + 1) * self.span[level]].tolist()

    def may_link(self, level: int, i, j):
        """Whether documents below nodes ``i`` and ``j`` (arrays too) can reach the threshold."""
        sign, least, most, extra, new = self.levels[level]
        p = self.percent
        ok = (100 * most[i] >= p * least[j]) & (100 * most[j] >= p * least[i]) & (new[i] | new[j])
        common_ = np.bitwise_count(sign[i] & sign[j]).sum(axis=-1).astype(np.int64) + np.minimum(extra[i], extra[j])
        return ok & ((100 + p) * common_ >= p * (least[i] + least[j])) & (most[i] > 0) & (most[j] > 0)

    def join(self, forest: Forest) -> None:
        """Connects all documents that link; skips node pairs that cannot, or that are connected."""
        top = len(self.levels) - 1
        stack = [(top, 0, 0)]
        while stack:
            level, i, j = stack.pop()
            if level <= 1:
                self._leaves(i, j, forest) if level else None
                continue
            if i == j:
                if not self.levels[level][4][i]:
                    continue
            elif not self.may_link(level, i, j):
                continue
            if forest.one(self.members(level, i) + (self.members(level, j) if i != j else [])):
                continue
            n = len(self.levels[level - 1][1])
            a, b = (range(x * FAN, min(n, x * FAN + FAN)) for x in (i, j))
            pairs = [(level - 1, x, y) for x in a for y in b if i != j or x < y]
            stack += pairs[::-1]
            if i == j:                       # a node with itself first: it connects most
                stack += [(level - 1, x, x) for x in a]

    def _leaves(self, i: int, j: int, forest: Forest) -> None:
        n = len(self.order)
        a, b = (np.arange(x * LEAF, min(n, x * LEAF + LEAF)) for x in (i, j))
        if i != j and (not self.may_link(1, i, j) or forest.one(self.order[a].tolist() + self.order[b].tolist())):
            return
        x, y = (v.ravel() for v in np.meshgrid(a, b, indexing="ij"))
        if i == j:
            x, y = x[x < y], y[x < y]
        hit = self.may_link(0, x, y)
        for p, q in zip(self.order[x[hit]].tolist(), self.order[y[hit]].tolist(), strict=True):
            if forest.find(p) != forest.find(q):
                s, t = self.tokens[p], self.tokens[q]
                both = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * both >= self.percent * (len(s) + len(t) - both):
                    forest.join(p, q)


def tile_join(percent: int):
    """Tile ``(k, text, root, comp, fresh)`` -> ``(k, root, comp)`` with comp the smallest key connected there.

    Documents of different roots are apart; ``comp`` gives what is connected already.
    """
    def run(tbl: pa.Table) -> pa.Table:
        batch = tbl.combine_chunks().to_batches()[0]
        tokens: list[np.ndarray] = []
        for _, g, n in _sets_of(batch):
            tokens += np.split(g, np.cumsum(n)[:-1])
        keys, roots = (np.asarray(batch[c]).view(U) for c in ("k", "root"))
        comps, fresh = np.asarray(batch["comp"]), np.asarray(batch["fresh"])
        low = np.empty(len(keys), np.int64)
        order = np.argsort(roots, kind="stable")
        for i, j in packed.cuts(roots[order]):
            rows = order[i:j]
            forest = Forest(len(rows))
            by: dict[int, int] = {}
            for at, c in enumerate(comps[rows].tolist()):
                forest.join(by.setdefault(c, at), at)
            if len(by) > 1:
                Tree([tokens[r] for r in rows], fresh[rows], percent).join(forest)
            least: dict[int, int] = {}
            own = comps[rows].tolist()
            for at, c in enumerate(own):
                f = forest.find(at)
                least[f] = min(least.get(f, c), c)
            low[rows] = [least[forest.find(at)] for at in range(len(rows))]
        return pa.table({"k": batch["k"], "root": batch["root"], "was": batch["comp"], "comp": pa.array(low, pa.int64())})
    return run


TILED = "k long, root long, was long, comp long"


def _tiles(members: DataFrame, salt: int, n_small: int) -> DataFrame:
    """Adds group key ``g``: small roots packed into ``n_small`` groups, large ones cut by hash of the key."""
    size = members.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("n") / TILE_TOKENS)).alias("tiles"))
    return (members.join(size, "root")
            .withColumn("g", F.when(F.col("tiles") <= 1, F.pmod(F.xxhash64("root"), F.lit(n_small)))
                        .otherwise(F.xxhash64("root", F.pmod(F.xxhash64("k", F.lit(salt)), F.col("tiles"))))))


# ---------------------------------------------------------------- the join

def components(df: DataFrame, text: str = "text", percent: int = PERCENT, frequent_shingles: int = FREQUENT,
               stages: common.Stages | None = None, key: Column | None = None) -> DataFrame:
    """``(k, n, comp)``: every distinct text's key, set size, and component (the smallest key in it).

    ``key`` is the ``distinct_key`` of the texts, if the caller has it.
    """
    spark = df.sparkSession
    common.small_batches(spark)
    stages = stages or common.Stages(spark, "jaccard")
    key = common.distinct_key(df, text) if key is None else key
    rows = df.select(key.alias("k"), F.coalesce(F.col(common.quoted(text)), F.lit("")).alias("text"))
    n = common.parts(spark, common.text_bytes(df, F.col(common.quoted(text))) / 6 * (100 - percent) / 100, BUCKET)

    sent = spark.sparkContext.broadcast(frequent(rows, n, stages, frequent_shingles))
    met = stages.put(rows.mapInArrow(common.map_batches(send_shared(n, percent, sent)), SHARED)
                     .groupBy("bucket").applyInArrow(common.map_group(count_shared(n, percent)), COUNTED)
                     .groupBy("bucket").applyInArrow(common.map_group(sizes_and_shares), "k long, n long, shared long"), "met")
    sizes = met.select("k", "n")
    other = F.floor((F.col("n") * percent + 99) / 100)           # least size of a set that links
    likely = stages.put(met.filter((F.col("n") > 0) & (F.col("shared") >= 1 + F.floor(other / EXTRA))).select("k"), "likely")
    once = rows.groupBy("k").agg(F.first("text").alias("text"))
    candidates = stages.put(once.join(likely, "k"), "candidates")
    counts = (candidates.mapInArrow(common.map_batches(send_tokens(n, sent)), TOKENS).groupBy("bucket").applyInArrow(common.map_group(recount(n)), PLACES)
              .groupBy("bucket").applyInArrow(common.map_group(by_text), "k long, p binary, c binary"))
    close = stages.put(candidates.join(counts, "k", "left").select("k", "text", "p", "c")
                       .mapInArrow(common.map_batches(send_rare_prefixes(n, percent, sent)), ENTRY).groupBy("bucket").applyInArrow(common.map_group(meet(n, percent)), FOUND)
                       .groupBy("bucket").applyInArrow(common.map_group(settle), "a long, b long"), "close")
    coarse = common.connected_components(close, stages, "coarse")
    coarse = coarse.select(F.col("node").alias("k"), "root").join(sizes, "k")
    total = coarse.agg(F.sum("n")).first()[0]
    if not total:
        return sizes.select("k", "n", F.col("k").alias("comp"))
    n_small = int(total // TILE_TOKENS + 1) * 2
    placed = stages.put(_tiles(coarse, 0, n_small), "placed")
    members = stages.put(candidates.join(placed, "k"), "members")
    stages.drop("candidates")
    run = tile_join(percent)
    alone = members.withColumns({"comp": F.col("k"), "fresh": F.lit(True)})
    local = stages.put(alone.groupBy("g").applyInArrow(common.map_group(run), TILED), "local")
    links = [local.select(F.col("k").alias("a"), F.col("comp").alias("b")).filter("a <> b")]
    large = placed.filter("tiles > 1").select("root", "tiles").distinct()
    if not large.isEmpty():
        links += _large_groups(members, local, large, n_small, percent, sent, stages)
    edges = links[0]
    for more in links[1:]:
        edges = edges.unionAll(more)
    done = common.connected_components(edges, stages, "final")
    return (sizes.join(done.select(F.col("node").alias("k"), "root"), "k", "left")
            .select("k", "n", F.coalesce("root", "k").alias("comp")))


def _large_groups(members: DataFrame, local: DataFrame, large: DataFrame, n_small: int, percent: int, sent, stages) -> list[DataFrame]:
    """Links across the tiles of groups that need more than one."""
    run, links = tile_join(percent), []
    of_large = local.join(large.select("root"), "root", "left_semi")
    reps = stages.put(of_large.filter("k = comp").select("k"), "reps0")
    left, step = reps.count(), 0
    while True:                              # representatives, in tiles, until they fit one or shrink no more
        step += 1
        now = members.join(reps, "k", "left_semi").select("k", "text", "root", "n")
        now = _tiles(now, step, n_small).withColumns({"comp": F.col("k"), "fresh": F.lit(True)})
        one = now.filter("tiles > 1").isEmpty()
        got = stages.put(now.groupBy("g").applyInArrow(common.map_group(run), TILED), f"level{step}")
        links.append(got.select(F.col("k").alias("a"), F.col("comp").alias("b")).filter("a <> b"))
        reps = stages.put(got.filter("k = comp").select("k"), f"reps{step}")
        before, left = left, reps.count()
        if one or 2 * left > before:         # what is left is handled below
            break
    edges = of_large.select(F.col("k").alias("a"), F.col("comp").alias("b")).filter("a <> b")
    for more in links:
        edges = edges.unionAll(more)
    sofar = common.connected_components(edges, stages, "across")
    known = (members.join(large.select("root"), "root", "left_semi")
             .join(sofar.select(F.col("node").alias("k"), F.col("root").alias("comp")), "k", "left")
             .select("k", "text", "root", "n", "g", F.coalesce("comp", "k").alias("comp")))
    known = stages.put(known, "known")
    share = known.groupBy("root", "comp").agg(F.count("*").alias("docs"))
    bulk = share.groupBy("root").agg(F.max(F.struct("docs", "comp")).alias("m")).select("root", F.col("m.comp").alias("bulk"))
    rest = known.join(bulk, "root").filter("comp <> bulk").select("k", "text", "root", "n", "comp")
    rest = stages.put(rest, "rest")
    if rest.isEmpty():
        return links
    known = stages.put(_size_tiles(known.join(rest.select("root").distinct(), "root", "left_semi"), percent), "sized")
    ways = stages.put(routes(known, rest, percent, sent), "ways")
    cut = ways.groupBy("g").agg(F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("n") / TILE_TOKENS)).alias("cuts"))
    cut = stages.put(cut, "cuts")
    cols = ["k", "text", "root", "comp"]
    # a tile meets the documents routed to it in cuts; keys (g, c) are one group each
    tile_side = (known.join(cut, "g").withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)))
                 .select(*cols, "g", "c", F.lit(False).alias("fresh")))
    rest_side = (rest.join(ways.drop("n").join(cut, "g"), "k").withColumn("c", F.pmod(F.xxhash64("k", F.lit(77)), F.col("cuts")))
                 .select(*cols, "g", "c", F.lit(True).alias("fresh")))
    got = tile_side.unionAll(rest_side).groupBy("g", "c").applyInArrow(common.map_group(run), TILED)
    links.append(stages.put(got.select(F.col("was").alias("a"), F.col("comp").alias("b")).filter("a <> b"), "cross"))
    return links


def _size_tiles(members: DataFrame, percent: int) -> DataFrame:
    """Tiles ``g`` of documents of like size: sets of bands that are not neighbours differ too much to link."""
    sized = members.drop("g").withColumn("band", F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent))))
    full = sized.groupBy("root", "band").agg(F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("n") / TILE_TOKENS)).alias("tiles"))
    tile = F.xxhash64("root", "band", F.pmod(F.xxhash64("k", F.lit(55)), F.col("tiles")))
    return sized.join(full, ["root", "band"]).withColumn("g", tile).drop("band", "tiles")


def send_first_shingles(percent: int, sent):
    """One row for each first shingle of a text: ``(root, g, k, n, h)``."""
    def run(batches):
        for batch in batches:
            at = 0
            for _, g, n in _sets_of(batch):
                h, row = _prefixes(g, n, sent.value.levels(g), percent)
                for i in range(0, len(h), FLUSH):
                    rows = pa.array(row[i:i + FLUSH] + at)
                    yield pa.RecordBatch.from_arrays([batch[c].take(rows) for c in ("root", "g", "k", "n")]
                                                     + [pa.array(h[i:i + FLUSH].view(np.int64))], names=["root", "g", "k", "n", "h"])
                at += len(n)
    return run


def routes(known: DataFrame, rest: DataFrame, percent: int, sent) -> DataFrame:
    """``(g, k, n)``: the tiles of ``known`` that each document of ``rest`` must be compared with.

    Sets that link share one of their first shingles, rare ones first, and have fitting sizes; a tile is
    passed over when none of its documents does both.
    """
    form = "root long, g long, k long, n long, h long"
    first = lambda df: df.mapInArrow(common.map_batches(send_first_shingles(percent, sent)), form)
    there = (first(known.select("k", "text", "root", "g", "n")).groupBy("root", "h", "g")
             .agg(F.min("n").alias("least"), F.max("n").alias("most")))
    asks = first(rest.select("k", "text", "root", F.lit(0).cast("long").alias("g"), "n")).drop("g")
    fits = (100 * F.col("most") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("least"))
    return asks.join(there, ["root", "h"]).filter(fits).select("g", "k", "n").distinct()


def representatives(df: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` that stay when one document of each component is kept: that of the smallest id.

    Documents with an empty set stay.  Of equal rows that tie for the smallest id, one stays.
    """
    stages = common.Stages(df.sparkSession, "representatives")
    key = common.distinct_key(df, text)
    found = stages.put(components(df, text, percent, stages=stages, key=key), "components")
    ids = df.select(key.alias("k"), F.col(common.quoted(doc_id)).alias("id"))
    order = F.struct(F.col("id").isNull().alias("unknown"), F.col("id"), F.col("k"))
    least = (ids.groupBy("k").agg(F.min("id").alias("id")).join(found.filter("n > 0"), "k")
             .groupBy("comp").agg(F.min(order).alias("least")))
    chosen = stages.put(least.select(F.col("least.k").alias("k"), F.col("least.id").alias("id")), "chosen")
    empty = stages.put(found.filter("n = 0").select("k"), "empty")
    stages.drop_others("chosen", "empty")
    # joined on text and id, so that the copies of one text spread over their ids
    same = lambda r: (r["k"] == chosen["k"]) & r["doc"].eqNullSafe(chosen["id"])
    named = ids.withColumnRenamed("id", "doc")
    ties = stages.put(named.join(chosen, same(named), "left_semi").groupBy("k").count().filter("count > 1").select("k"), "ties")
    rows = df.select(common.others(df).alias("row"), key.alias("k"), F.col(common.quoted(doc_id)).alias("doc"))
    kept = rows.join(chosen, same(rows), "left_semi")
    if not ties.isEmpty():
        kept = (kept.join(ties, "k", "left_anti").select("row")
                .unionAll(kept.join(ties, "k", "left_semi").dropDuplicates(["k"]).select("row")))
    rows = kept.select("row").unionAll(rows.join(empty, "k", "left_semi").select("row"))
    return common.restore(df, rows.select("row"), {})


def join(df: DataFrame, text: str = "text", doc_id: str = "doc_id", n_shingles: str = "n_shingles",
         component: str = "component_id", percent: int = PERCENT) -> DataFrame:
    """``df`` with its set size and component id (the smallest ``doc_id`` reachable by links)."""
    stages = common.Stages(df.sparkSession, "jaccard")
    key = common.distinct_key(df, text)
    found = stages.put(components(df, text, percent, stages=stages, key=key), "components")
    ids = df.select(key.alias("k"), F.col(common.quoted(doc_id)).alias("id"))
    # least id of each text first (hot texts collapse before the join), then of each component
    least = (ids.groupBy("k").agg(F.min("id").alias("id")).join(found, "k")
             .groupBy("comp").agg(F.min("id").alias("least")))
    of_text = stages.put(found.join(least, "comp").select("k", "n", "least"), "of_text")
    stages.drop_others("of_text")
    rows = df.select(common.others(df).alias("row"), key.alias("k")).join(of_text, "k")
    own = F.when(F.col("n") == 0, F.col("row").getField(doc_id)).otherwise(F.col("least"))
    return common.restore(df, rows.select("row", "n", own.alias("least")), {n_shingles: "n", component: "least"})
