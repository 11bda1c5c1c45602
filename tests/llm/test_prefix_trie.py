import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingsmith.llm import common, prefix_trie

SCHEMA = "conv_id long, turn int, role string, text string, n long"


def sequences(rows):
    """conv -> turns in order."""
    out = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            out.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(s)] for c, s in out.items()}


def branched(seqs):
    out = {}
    for c, s in seqs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = seqs.get(c - int(np.fmod(c, 5)), [])[:h] + s[h:]
    return out


def brute(seqs):
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    out = set()
    for node, convs in members.items():
        sub = [x for x in members if x[:len(node)] == node]
        kids = lambda x: sum(len(y) == len(x) + 1 and y[:len(x)] == x for y in members)
        ends = ",".join(str(c) for c in sorted(convs) if len(seqs[c]) == len(node))
        out.add((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), kids(node),
                 sum(kids(x) == 0 for x in sub), sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in sub if x),
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def found(spark, rows, band, tile, branch=False):
    stages = common.Stages(spark, "trie-test")
    turns = prefix_trie.number(spark.createDataFrame(rows, SCHEMA), stages)
    if branch:
        turns = prefix_trie.branch(turns, stages, F.col("conv") - F.col("conv") % 5,
                                   F.crc32(F.col("conv").cast("string").cast("binary")) % 9, 8)
    got = prefix_trie.ends_digest(prefix_trie.build(turns, stages, band=band, tile=tile))
    got = got.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()
    assert len(got) == len(set(map(tuple, got)))
    return set(map(tuple, got))


def made(seed, convs=40, longest=14):
    """Few different turns, so that prefixes are shared; NULLs, ties and repeated rows among them."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-20, 200), convs):
        for t in range(rng.choice([1, 2, 3, longest])):
            turn = None if rng.random() < 0.1 else rng.randrange(6) if rng.random() < 0.2 else t
            rows.append((c, turn, rng.choice(["u", "u", None]), rng.choice(["a", "aé", "", None]), t))
    same = [(c, t, "u", f"long {t % 3}", 0) for c in range(300, 312) for t in range(11)]
    return rows + rows[:5] + same + [(None, 0, "u", "a", 0)] * 3


@pytest.mark.parametrize("band, tile, branch", [(3, 7, True), (64, 1000, False)])
def test_equals_brute_force_over_bands_and_tiles(spark, band, tile, branch):
    rows = made(band)
    seqs = sequences(rows)
    assert found(spark, rows, band, tile, branch) == brute(branched(seqs) if branch else seqs)


def test_empty_table_has_no_nodes(spark):
    assert found(spark, [], 3, 7, True) == set()


def test_sparse_table_against_scans():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 5, 60)
    table = prefix_trie.RangeMinimum(x)
    i, d = rng.integers(0, 60, 400), rng.integers(0, 6, 400)
    for a, depth, low, high in zip(i, d, table.left(i, d), table.right(i, d), strict=True):
        right = a
        while right + 1 < 60 and x[right + 1] >= depth:
            right += 1
        left = a
        while left > 0 and x[left] >= depth:
            left -= 1
        assert (low, high) == (left, right)
    a, b = np.minimum(i, d * 9), np.maximum(i, d * 9)
    assert [int(v) for v in table.least(a, b)] == [int(x[p:q + 1].min()) for p, q in zip(a, b, strict=True)]
