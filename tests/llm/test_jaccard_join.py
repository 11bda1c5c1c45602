import random

import pytest
from pyspark.sql import functions as F

from ratingsmith.llm import jaccard_join as op
from tests.llm.helpers import documents, near, prose, words_of


def shingles(text):
    w = words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """doc_id -> (set size, component id)."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(find(i), []).append(d)
    return [(len(sets[i]), min(least[find(i)]) if sets[i] else rows[i][0]) for i in range(len(rows))]


def corpus(seed, bases=12, copies=9):
    rng = random.Random(seed)
    passage = prose(rng, 60)
    rows, ids = [], rng.sample(range(10**6), 10**4)
    for _ in range(bases):
        base = prose(rng, rng.randint(20, 150), 10**5)
        if rng.random() < 0.6:
            base += " " + passage                                # a frequent passage that must not link
        for _ in range(rng.randint(1, copies)):
            rows.append((ids.pop(), near(rng, base, rng.choice([0, 0.005, 0.01, 0.02, 0.03, 0.2]))))
    chain = prose(rng, 120, 10**5)                               # links only from neighbour to neighbour
    for _ in range(12):
        rows.append((ids.pop(), chain))
        chain = near(rng, chain, 0.015)
    rows += [(ids.pop(), rows[0][1].upper().replace("É", "é")), (ids.pop(), rows[1][1] + " \n")]
    rows += [(ids.pop(), t) for t in ("", " \t", "one", "ONE", "one two", "a b c d e", "A b c d E", "é f")]
    return rows


def check(spark, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op.join(documents(spark, rows).repartition(4)).collect()}
    want = brute(rows)
    assert [got[d] for d, _ in rows] == want
    return want


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    want = check(spark, corpus(seed))
    assert len({c for _, c in want}) < len(want) - 20


@pytest.mark.parametrize("tile", [2, 5])
def test_large_groups_are_cut_into_tiles(spark, tile, monkeypatch):
    monkeypatch.setattr(op, "TILE", tile)
    check(spark, corpus(7, bases=5, copies=20))


def test_without_frequent_order_and_with_small_gatherings(spark, monkeypatch):
    """The order and the gathering change the work only; a shared passage then makes one coarse group of many texts."""
    monkeypatch.setattr(op, "FLUSH", 300)
    monkeypatch.setattr(op, "TILE", 6)
    rows = corpus(11)
    df = documents(spark, rows).repartition(4)
    comps = {r.k: r.comp for r in op.components(df, frequent_shingles=0).collect()}
    want = brute(rows)
    keys = {r.doc_id: r.k for r in df.select("doc_id", op.common.text_key("text").alias("k")).collect()}
    groups = {}
    for (d, _), (n, c) in zip(rows, want, strict=True):
        if n:
            groups.setdefault(c, set()).add(comps[keys[d]])
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_tree_prunes_but_loses_nothing():
    import numpy as np
    rows = [t for _, t in corpus(5)]
    tokens = [np.unique(np.array([hash(s) & (2**64 - 1) for s in shingles(t)], np.uint64)) for t in rows]
    forest = op.Forest(len(rows))
    op.Tree(tokens, np.ones(len(rows), bool), 80).join(forest)
    want = brute(list(enumerate(rows)))
    assert [min(j for j in range(len(rows)) if forest.find(j) == forest.find(i)) if len(tokens[i]) else i
            for i in range(len(rows))] == [c for _, c in want]


def test_routes_keep_every_partner_and_skip_tiles(spark, monkeypatch):
    """Documents of one group in tiles of like size: each meets the tiles of its partners, and far from all tiles."""
    rng = random.Random(13)
    passage = prose(rng, 20)
    texts = []
    for i in range(40):
        base = prose(rng, rng.choice([15, 25, 45, 90, 180]), 10**5) + " " + passage
        texts += [base, near(rng, base, 0.01)]
    texts = sorted(set(texts))
    rows = [(i, t, 1, len(shingles(t))) for i, t in enumerate(texts)]
    known = spark.createDataFrame(rows, "k long, text string, root long, n long").withColumn("g", F.lit(0).cast("long"))
    monkeypatch.setattr(op, "TILE", 4)
    tiled = op._size_tiles(known, 80)
    tile_of = {r.k: r.g for r in tiled.select("k", "g").collect()}
    sent = spark.sparkContext.broadcast(op.frequent(known.select("k", "text"), 3, op.common.Stages(spark, "routes"), 1000))
    got = {(r.g, r.k) for r in op.routes(tiled, tiled, 80, sent).collect()}
    sets = [shingles(t) for t in texts]
    partners = {(tile_of[j], i) for i, a in enumerate(sets) for j, b in enumerate(sets) if 100 * len(a & b) >= 80 * len(a | b)}
    assert len(partners) > len(texts) and partners <= got
    assert len(got) < 0.5 * len(texts) * len(set(tile_of.values()))


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(None, text, "x"), (5, text, None), (5, text, None), (9, None, "y"), (None, None, "z"), (4, "w0", "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, k string")
    out = op.join(df)
    assert out.columns == ["doc_id", "text", "k", "n_shingles", "component_id"]
    assert sorted((r.k or "", r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in out.collect()) == [
        ("", 5, 16, 5), ("", 5, 16, 5), ("q", 4, 1, 4), ("x", 0, 16, 5), ("y", 9, 0, 9), ("z", 0, 0, 0)]
    assert op.join(df.limit(0)).count() == 0
    kept = op.representatives(df)
    assert kept.columns == df.columns
    assert sorted((r.k or "", r.doc_id or 0) for r in kept.collect()) == [("", 5), ("q", 4), ("y", 9), ("z", 0)]
    assert op.representatives(df.limit(0)).count() == 0
