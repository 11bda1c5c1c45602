"""Prefix trie of conversations from sorted common prefixes (operator 11).

A node is a distinct sequence of first turns.  Conversations are sorted by the keys of their turns, so the
members of a node stand side by side, and the length of the common prefix (LCP) with the row before tells
which nodes a row is the first member of.  For each of these the left and right extent of its members is found
by binary search in a sparse table of range minima over the LCPs, each prefix for itself; so are those of its
parent.  A second table gives the smallest conversation of an interval.  Rows and depths in order are a preorder of
the trie, so sums over a subtree are differences of running sums.

Scale.  A conversation is never one row: it is cut into bands of BAND turns, and a row has a band's
keys, the digest of all turns before it (its block) and the conversation.  Sorted by (band, block, keys,
conversation), the exchange splits long conversations and groups of copies alike.  A task works on tiles of at most
TILE rows and KEYS keys.  Nodes that touch the edge of a tile, and those with a deeper band below them, are open: a tile
gives its part of them, at most two paths of BAND nodes for the edges, and parts of one node are added up by the node's
digest.  Sums along open nodes double their reach each round (log2 of the depth rounds over the open nodes only).
Turns are numbered by a range exchange and the sizes of partitions (``common.placed``), without a window over
a conversation.  Nothing reaches the driver but whether a round is left.

Keys are 128 bits of SHA-256 over role and text; equal keys are taken as equal turns.

Defined cases.  Rows without a conversation id belong to none and are left out.  NULL role or text counts as empty.
Turns are ordered by turn (NULL first), ties by role and text; repeated rows are turns of their own.  Empty
texts are turns.  Texts are hashed whole.  Extra columns are not read.  A conversation without turns (after ``branch``) is a member of the root
only.  Empty table: no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common, words

#: Turns of a band, rows and keys of a tile, ids of one piece of a member list.
BAND, TILE, KEYS, PIECE = 256, 1 << 16, 1 << 19, 4096
#: Band digests summed up in one window row group.
CHUNK = 4096

FIELDS = [("kind", pa.int32()), ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv", pa.int64()),
          ("parent_conv", pa.int64()), ("n", pa.int64()), ("kids", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()),
          ("size", pa.int64()), ("ends", pa.list_(pa.int64())), ("part", pa.int32()), ("seq", pa.int32()), ("piece", pa.int32())]
TILE_SCHEMA = ("kind int, node binary, parent binary, depth long, conv long, parent_conv long, n long, kids long, leaves long, "
               "saved long, size long, ends array<long>, part int, seq int, piece int")
CLOSED, OPEN, ENDS = 0, 1, 2


@dataclass
class Turns:
    """``rows``: conv, pos (from 0), key (hex), size (bytes of the text); ``convs``: conv, n (turns), all of them."""

    rows: DataFrame
    convs: DataFrame


@dataclass
class Trie:
    """``nodes``: one row a node.  ``ends`` lists the conversations that end there, ascending; it is NULL
    where the list is in ``pieces`` (node, part, seq, piece, ends), to be read in that order."""

    nodes: DataFrame
    pieces: DataFrame


def number(df: DataFrame, stages: common.Stages, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> Turns:
    col = lambda c: F.col(common.quoted(c))
    said = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    rows = df.filter(col(conv).isNotNull()).select(
        col(conv).cast("long").alias("conv"), col(turn).alias("turn"), F.coalesce(col(role), F.lit("")).alias("role"),
        F.coalesce(col(text), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("read"))
    rows = rows.withColumns({"key": F.substring(F.sha2(said, 256), 1, 32), "size": F.octet_length("text").cast("long")})
    by = ["conv", F.asc_nulls_first("turn"), "role", "text", "read"]
    rows = common.placed(rows.repartitionByRange(*by).sortWithinPartitions(*by).select("conv", "key", "size"), stages, "turns")
    convs = stages.put(rows.groupBy("conv").agg(F.min("place").alias("first"), F.count("*").alias("n")), "convs")
    rows = rows.join(convs, "conv").select("conv", (F.col("place") - F.col("first")).alias("pos"), "key", "size")
    return Turns(rows, convs.select("conv", "n"))


def branch(turns: Turns, stages: common.Stages, lead: Column, taken: Column, most: int) -> Turns:
    """Conversations that begin with the first ``taken`` (at most ``most``) turns of the conversation ``lead``
    and go on with their own turns after their first ``taken``; both columns are over ``conv``."""
    have = turns.convs.select(F.col("conv").alias("lead"), F.col("n").alias("lead_n"))
    plan = turns.convs.withColumns({"lead": lead, "h": taken}).join(have, "lead", "left")
    plan = stages.put(plan.select("conv", "lead", "h", F.least("h", F.coalesce("lead_n", F.lit(0))).alias("got"), "n"), "plan")
    heads = (turns.rows.filter(F.col("pos") < most).withColumnRenamed("conv", "lead")
             .join(plan.select("conv", "lead", "got"), "lead").filter("pos < got").select("conv", "pos", "key", "size"))
    own = (turns.rows.join(plan.select("conv", "h", "got"), "conv").filter("pos >= h")
           .select("conv", (F.col("got") + F.col("pos") - F.col("h")).alias("pos"), "key", "size"))
    convs = plan.select("conv", (F.col("got") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))
    return Turns(heads.unionByName(own), convs)


def _bands(turns: Turns, stages: common.Stages, band: int) -> DataFrame:
    """``band, block, after, keys, conv, sizes``: a row for each band of each conversation, sorted over all partitions.

    ``sizes`` starts with that of the turn before the band; ``after`` is the block of the next band.
    """
    at = F.pmod("pos", F.lit(band))
    which = F.floor(F.col("pos") / F.lit(band))
    entries = turns.rows.select("conv", which.alias("band"), at.alias("at"), "key", "size")
    begin = entries.filter(F.col("at") == band - 1).select("conv", F.col("band") + 1, F.lit(-1).cast("long"), F.lit(None), "size")
    root = turns.convs.select("conv", F.lit(0).cast("long"), F.lit(-1).cast("long"), F.lit(None), F.lit(0).cast("long"))
    listed = (entries.unionAll(begin).unionAll(root).groupBy("conv", "band")
              .agg(F.sort_array(F.collect_list(F.struct("at", "key", "size"))).alias("e")))
    packed = stages.put(listed.select("conv", "band", F.unhex(F.array_join("e.key", "")).alias("keys"),
                                      F.col("e.size").alias("sizes")), "bands")
    # digests of all bands up to each full one: sums of 60-bit parts of SHA-256 over (band, keys)
    digest = F.sha2(F.concat(F.col("band").cast("string").cast("binary"), F.lit(":").cast("binary"), F.col("keys")), 256)
    part = lambda i: F.conv(F.substring(digest, i, 15), 16, 10).cast("decimal(38,0)")
    full = packed.filter(F.octet_length("keys") == 16 * band).select(
        "conv", "band", F.floor(F.col("band") / F.lit(CHUNK)).alias("chunk"), part(1).alias("a"), part(16).alias("b"))
    full = stages.put(full, "full")
    chunks = full.groupBy("conv", "chunk").agg(F.sum("a").cast("decimal(38,0)").alias("ca"), F.sum("b").cast("decimal(38,0)").alias("cb"))
    before, inside = W.partitionBy("conv").orderBy("chunk"), W.partitionBy("conv", "chunk").orderBy("band")
    upto = lambda c, w: F.sum(c).over(w).cast("decimal(38,0)")
    chunks = chunks.select("conv", "chunk", (upto("ca", before) - F.col("ca")).alias("ca"), (upto("cb", before) - F.col("cb")).alias("cb"))
    sums = full.withColumns({"a": upto("a", inside), "b": upto("b", inside)}).join(chunks, ["conv", "chunk"])
    ident = F.concat_ws(":", (F.col("band") + 1).cast("string"), (F.col("a") + F.col("ca")).cast("string"),
                        (F.col("b") + F.col("cb")).cast("string"))
    after = stages.put(sums.select("conv", "band", F.unhex(F.substring(F.sha2(ident, 256), 1, 32)).alias("after")), "after")
    none = F.lit(None).cast("binary")
    ids = (after.select("conv", "band", none.alias("block"), "after")
           .unionAll(after.select("conv", F.col("band") + 1, F.col("after"), none))
           .groupBy("conv", "band").agg(F.max("block").alias("block"), F.max("after").alias("after")))
    zero = F.lit(bytes(16))
    rows = packed.join(ids, ["conv", "band"], "left").select(
        "band", F.coalesce("block", zero).alias("block"), F.coalesce("after", zero).alias("after"), "keys", "conv", "sizes")
    by = ["band", "block", "keys", "conv"]
    return rows.repartitionByRange(*by).sortWithinPartitions(*by)


def common_prefixes(head: np.ndarray, keys: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """LCP of every row with the row before; -1 where ``head`` differs, and for the first row."""
    lcp = np.full(len(length), -1, np.int32)
    live = np.flatnonzero((head[1:] == head[:-1]).all(axis=1)) + 1
    lcp[live] = 0
    depth = 0
    while len(live):
        live = live[(length[live] > depth) & (length[live - 1] > depth)]
        live = live[(keys[first[live] + depth] == keys[first[live - 1] + depth]).all(axis=1)]
        depth += 1
        lcp[live] = depth
    return lcp


class RangeMinimum:
    """Sparse table: minima of all ranges whose length is a power of two."""

    def __init__(self, x: np.ndarray):
        self.n, self.levels = len(x), [x]
        while 2 << (len(self.levels) - 1) <= len(x):
            half, last = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Minimum from a to b, both included."""
        level = np.frexp((b - a + 1).astype(float))[1] - 1
        out = np.empty(len(a), self.levels[0].dtype)
        for j in np.unique(level):
            at = np.flatnonzero(level == j)
            out[at] = np.minimum(self.levels[j][a[at]], self.levels[j][b[at] - (1 << j) + 1])
        return out

    def right(self, i: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Last place that i reaches over values of d or more (those after i)."""
        at = i.copy()
        for j in range(len(self.levels) - 1, -1, -1):
            row = self.levels[j]
            fits = at + (1 << j) < self.n
            go = fits & (row[np.where(fits, at + 1, 0)] >= d)
            at += go.astype(at.dtype) << j
        return at

    def left(self, i: np.ndarray, d: np.ndarray) -> np.ndarray:
        """First place from which i is reached over values of d or more (those after it, up to i)."""
        at = i.copy()
        for j in range(len(self.levels) - 1, -1, -1):
            row = self.levels[j]
            fits = at - (1 << j) >= 0
            go = fits & (row[np.where(fits, at - (1 << j) + 1, 0)] >= d)
            at -= go.astype(at.dtype) << j
        return at


def _digest(*parts: bytes) -> bytes:
    return hashlib.sha256(b"|".join(parts)).digest()[:16]


def tile_nodes(tbl: pa.Table, band_size: int, part: int, seq: int) -> pa.Table:
    """Closed nodes, parts of open ones and pieces of their member lists, of sorted rows."""
    tbl = tbl.combine_chunks()
    col = {c: tbl[c].chunk(0) for c in tbl.column_names}
    n = len(tbl)
    band, conv = col["band"].to_numpy(), col["conv"].to_numpy()
    block, after = col["block"].to_pylist(), col["after"].to_pylist()
    blob = col["keys"].cast(pa.large_binary())
    offs = np.frombuffer(blob.buffers()[1], np.int64)[blob.offset:blob.offset + n + 1]
    data = blob.buffers()[2]
    raw = data.to_pybytes() if data is not None else b""
    keys = np.frombuffer(raw, np.uint64, len(raw) // 8).reshape(-1, 2)
    first, length = offs[:-1] // 16, (np.diff(offs) // 16).astype(np.int64)
    sizes, size_at = col["sizes"].flatten().to_numpy(), np.cumsum(length + 1) - length - 1
    head = np.column_stack((band, np.frombuffer(b"".join(block), np.int64).reshape(-1, 2)))

    lcp = common_prefixes(head, keys, first, length)
    count = length - lcp
    base = np.concatenate(([0], np.cumsum(count)))
    row = np.repeat(np.arange(n), count)
    depth = lcp[row].astype(np.int64) + 1 + words.ragged(count)
    reach, ids = RangeMinimum(lcp), RangeMinimum(conv)
    low, high = reach.left(row, depth), reach.right(row, depth)
    upper = reach.left(row, np.maximum(depth - 1, 0))
    parent = np.where(depth > 0, base[upper] + depth - 1 - (lcp[upper] + 1), -1)
    members, least = high - low + 1, ids.least(low, high)
    end = base[high + 1]
    link = depth == band_size
    links = np.concatenate(([0], np.cumsum(link)))
    own = np.arange(len(row))
    is_open = (low == 0) | (high == n - 1) | (links[end] > links[own]) | ((depth == 0) & (band[row] > 0))
    shut = ~is_open
    size = np.where(link, 0, sizes[size_at[row] + np.minimum(depth, length[row])])
    kids = np.zeros(len(row), np.int64)
    np.add.at(kids, parent[shut & (depth > 0)], 1)
    saved, leaves = (np.where(shut, v, 0) for v in ((members - 1) * size, (kids == 0).astype(np.int64)))

    def below(v: np.ndarray) -> np.ndarray:
        """Sum over closed nodes of the subtree; for an open node those under no other open one."""
        run = np.concatenate(([0], np.cumsum(v)))
        out = run[end] - run[own]
        inner = is_open & (depth > 0)
        np.subtract.at(out, parent[inner], run[end[inner]] - run[own[inner]])
        return out

    saved, leaves = below(saved), below(leaves)

    def ident(c: int) -> bytes:
        i, d = int(row[c]), int(depth[c])
        if d == band_size:
            return _digest(b"%d" % (band[i] + 1), after[i])
        if d == 0:
            return _digest(b"%d" % band[i], block[i])
        return _digest(b"%d" % band[i], block[i], raw[offs[i]:offs[i] + 16 * d])

    opened = np.flatnonzero(is_open)
    name = {c: ident(c) for c in opened.tolist()}
    up = lambda cs: [name.get(p) for p in parent[cs].tolist()]

    # rows that end in their band, as runs of equal rows
    start = np.flatnonzero(lcp < length)
    stop = np.append(start[1:], n)
    ends_at = {}
    for s, e in zip(start.tolist(), stop.tolist(), strict=True):
        if length[s] < band_size:
            ends_at[int(base[s + 1]) - 1] = (s, e)

    closed = np.flatnonzero(shut)
    runs = np.array([ends_at.get(c, (0, 0)) for c in closed.tolist()], np.int64).reshape(-1, 2)
    took = runs[:, 1] - runs[:, 0]
    listed = conv[np.repeat(runs[:, 0], took) + words.ragged(took)]
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(took))), pa.int32()), pa.array(listed, pa.int64()))
    known = np.flatnonzero(is_open & ~link)
    pieces = [(name[c], i, conv[a:min(a + PIECE, e)]) for c in known.tolist() if c in ends_at for s, e in [ends_at[c]]
              for i, a in enumerate(range(s, e, PIECE))]

    def table(kind: int, rows: int, **cols) -> pa.Table:
        same = {"kind": [kind] * rows, "part": [part] * rows, "seq": [seq] * rows}
        out = {**same, **cols}
        return pa.table({f: pa.array(out[f], t) if f in out and not isinstance(out[f], pa.Array) else
                         out[f] if f in out else pa.nulls(rows, t) for f, t in FIELDS})

    above = np.maximum(parent[closed], 0)
    inner = shut[above]
    full = lambda v, c: [None if x else int(y) for x, y in zip(link[c], v[c], strict=True)]
    return pa.concat_tables((
        table(CLOSED, len(closed), parent=[None if i else p for i, p in zip(inner, up(closed), strict=True)],
              depth=band[row[closed]] * band_size + depth[closed], conv=least[closed],
              parent_conv=pa.array(least[above], pa.int64(), mask=~inner), n=members[closed], kids=kids[closed],
              leaves=leaves[closed], saved=saved[closed], ends=lists),
        table(OPEN, len(opened), node=[name[c] for c in opened.tolist()], parent=up(opened),
              depth=band[row[opened]] * band_size + depth[opened], conv=full(least, opened), n=full(members, opened),
              kids=kids[opened], leaves=leaves[opened], saved=saved[opened], size=size[opened]),
        table(ENDS, len(pieces), node=[p[0] for p in pieces], piece=[p[1] for p in pieces], ends=[p[2] for p in pieces])))


def _tiles(rows: DataFrame, band: int, most: int) -> DataFrame:
    from pyspark import TaskContext

    def run(batches):
        part, seq, held, size, keys = TaskContext.get().partitionId(), 0, [], 0, 0
        for batch in batches:
            at = 0
            while at < len(batch):
                piece = batch.slice(at, most - size)
                held.append(piece)
                size, at = size + len(piece), at + len(piece)
                keys += piece["keys"].nbytes // 16
                if size >= most or keys >= KEYS:
                    yield from tile_nodes(pa.Table.from_batches(held), band, part, seq).to_batches()
                    seq, held, size, keys = seq + 1, [], 0, 0
        if size:
            yield from tile_nodes(pa.Table.from_batches(held), band, part, seq).to_batches()

    common.small_batches(rows.sparkSession)
    return rows.mapInArrow(common.map_batches(run), TILE_SCHEMA)


def _merged(parts: DataFrame, stages: common.Stages) -> DataFrame:
    """Open nodes with sums over their subtrees."""
    nodes = stages.put(parts.groupBy("node").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv").alias("conv"), F.sum("n").alias("n"),
        F.sum("kids").alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("size").alias("size")), "open")
    kids = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("more"))
    nodes = nodes.join(kids, "node", "left").withColumn("kids", F.col("kids") + F.coalesce("more", F.lit(0)))
    nodes = stages.put(nodes.select(
        "node", "parent", "depth", "conv", "n", "kids", (F.col("leaves") + (F.col("kids") == 0).cast("long")).alias("leaves"),
        (F.col("saved") + (F.col("n") - 1) * F.col("size")).alias("saved")), "open_own")
    now, k = nodes.select("node", F.col("parent").alias("up"), "leaves", "saved"), 0
    while not now.filter("up IS NOT NULL").isEmpty():
        more = now.filter("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        far = now.select(F.col("node").alias("up"), F.col("up").alias("next"))
        now = stages.put(now.join(more, "node", "left").join(far, "up", "left").select(
            "node", F.col("next").alias("up"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")), f"reach{k}")
        k += 1
    return stages.put(nodes.drop("leaves", "saved").join(now.select("node", "leaves", "saved"), "node"), "open_sums")


def build(turns: Turns, stages: common.Stages, band: int = BAND, tile: int = TILE) -> Trie:
    """Nodes with ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (bytes of the subtree's texts beyond their first copy), ``node`` (of open ones) and ``ends``."""
    tiles = stages.put(_tiles(_bands(turns, stages, band), band, tile), "tiles")
    merged = _merged(tiles.filter(F.col("kind") == OPEN), stages)
    closed = tiles.filter(F.col("kind") == CLOSED).drop("node").withColumn("node", F.lit(None).cast("binary"))
    same = ["conv", "depth", "parent_conv", "n", "kids", "leaves", "saved", "node", "ends"]
    names = merged.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    opened = merged.withColumn("ends", F.lit(None).cast("array<long>"))
    # rows that know their parent (or have none) stay out of the join, where they would all share the key NULL
    under = (closed.drop("parent_conv").select("parent", *(c for c in same if c != "parent_conv"))
             .unionByName(opened.select("parent", *(c for c in same if c != "parent_conv"))).filter("parent IS NOT NULL"))
    nodes = (closed.filter("parent IS NULL").select(*same)
             .unionByName(opened.filter("parent IS NULL").withColumn("parent_conv", F.lit(None).cast("long")).select(*same))
             .unionByName(under.join(names, "parent").select(*same)))
    nodes = nodes.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                         F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                         "node", "ends")
    return Trie(nodes, tiles.filter(F.col("kind") == ENDS).select("node", "part", "seq", "piece", "ends"))


def ends_digest(trie: Trie) -> DataFrame:
    """``nodes`` with ``ends_sha256`` of the comma-joined ends, instead of ``node`` and ``ends``.

    A list in pieces is hashed as it streams by, a bounded piece at a time.
    """
    joined = F.array_join(F.transform("ends", lambda c: c.cast("string")), ",")

    def run(batches):
        node, state = None, None
        for batch in batches:
            names, texts = [], []
            for key, text in zip(batch["node"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if key != node:
                    if node is not None:
                        names.append(node)
                        texts.append(state.hexdigest())
                    node, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            yield pa.RecordBatch.from_pydict({"node": pa.array(names, pa.binary()), "split_sha256": pa.array(texts, pa.string())})
        if node is not None:
            yield pa.RecordBatch.from_pydict({"node": pa.array([node], pa.binary()), "split_sha256": [state.hexdigest()]})

    pieces = trie.pieces.select("node", "part", "seq", "piece", joined.alias("text"))
    pieces = pieces.repartition("node").sortWithinPartitions("node", "part", "seq", "piece").select("node", "text")
    split = pieces.mapInArrow(common.map_batches(run), "node binary, split_sha256 string")
    whole = trie.nodes.filter("node IS NULL").withColumn("ends_sha256", F.sha2(joined, 256)).drop("node", "ends")
    sha = F.coalesce("split_sha256", F.sha2(F.lit(""), 256))
    opened = trie.nodes.filter("node IS NOT NULL").join(split, "node", "left").withColumn("ends_sha256", sha)
    return whole.unionByName(opened.drop("node", "ends", "split_sha256"))
