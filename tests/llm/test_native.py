"""Operators made of DataFrame functions: URL filter, quality rules, fingerprints, mixing."""

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ratingsmith.llm import fingerprints, mixing, quality_rules, queries, url_filter
from tests.llm.helpers import by_id, documents, prose, words_of

# ---------------------------------------------------------------- URL filter

URLS = [
    ("https://a.org/x?y#z", "a.org", "/x", "org/", "allow"),
    ("http://EXAMPLE.org/es/1", "example.org", "/es/1", "example.org/es/", "block"),
    ("http://www.example.org/en/17", "www.example.org", "/en/17", "example.org/en/1", "block"),
    ("http://www.example.org/en/27", "www.example.org", "/en/27", "org/", "allow"),
    ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("http://b.com/fr/", "b.com", "/fr/", "com/fr/", "allow"),
    ("http://b.com/de/é", "b.com", "/de/é", "com/de/", "block"),
    ("http://b.com/fr", "b.com", "/fr", None, None),
    ("http://bcom/fr/", "bcom", "/fr/", None, None),
    ("http://org", "org", "", None, None),
    ("http://org/", "org", "/", "org/", "allow"),
    ("x://?q/r", "", "", None, None),
    ("x://h?a://b/c", "h", "", None, None),
    ("x://h#/c", "h", "", None, None),
    ("no scheme", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
]


def test_parts_and_rules(spark):
    rows = [(i, u, "v") for i, (u, *_) in enumerate(URLS)]
    df = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    out = url_filter.judge(df, queries.URL_RULES)
    assert out.columns == ["page_id", "url", "verdict", "host", "path", "rule", "score"]
    got = by_id(out.collect(), "page_id")
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), URLS[i]
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert url_filter.judge(df.limit(0), queries.URL_RULES).count() == 0



def test_url_tables_are_never_broadcast_however_small_their_files(spark, monkeypatch):
    """Compressed files of staged URLs say little of what their rows take in the driver."""
    sent, put = [], url_filter.common.Stages.put
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(url_filter.common.Stages, "put", lambda self, d, name: (sent.append((name, plan(d))), put(self, d, name))[1])
    rules = [("good.org", "/", "allow"), ("bad.org", "/", "block")]
    df = spark.createDataFrame([(i, f"http://{('good', 'bad', 'other')[i % 3]}.org/{i * 7919}") for i in range(90)], "id int, url string")
    out = url_filter.judge(df, rules)
    assert "SortMergeJoin" in plan(out) and "Broadcast" not in plan(out)
    assert not [name for name, p in sent if "BroadcastExchange" in p and name not in ("ratios", "scored")]
    few = {r.id: (r.verdict, round(r.score, 9)) for r in out.collect()}
    monkeypatch.setattr(url_filter, "BROADCAST_GRAMS", 0)
    sent.clear()
    assert {r.id: (r.verdict, round(r.score, 9)) for r in url_filter.judge(df, rules).collect()} == few
    assert len(sent) == 4 and not [p for _, p in sent if "BroadcastHashJoin" in p] and {v for v, _ in few.values()} == {"allow", "block"}

def test_without_rejected_urls_all_are_allowed(spark):
    df = spark.createDataFrame([(1, "http://a.org/"), (2, "http://b.net/"), (2, "http://b.net/"), (3, None)], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge(df, queries.URL_RULES).collect()] == ["allow"] * 4


def brute_scores(urls, label, fold):
    """Mean log ratio per character by plain Python."""
    order, m, size = url_filter.ORDER, url_filter.STRENGTH, url_filter.ALPHABET
    n = {c: Counter() for c in ("allow", "block")}
    t = {c: Counter() for c in ("allow", "block")}
    pad = lambda s: "\x02" * order + s + "\x03"
    for s in urls:
        if label[s] and fold[s] > 0:
            for i in range(order, order + len(s) + 1):
                for j in range(order + 1):
                    n[label[s]][pad(s)[i - j:i + 1]] += 1
                    t[label[s]][(j, pad(s)[i - j:i])] += 1
    out = {}
    for s in urls:
        total = 0.0
        for i in range(order, order + len(s) + 1):
            p = {}
            for c in n:
                p[c] = 1 / size
                for j in range(order + 1):
                    p[c] = (n[c][pad(s)[i - j:i + 1]] + m * p[c]) / (t[c][(j, pad(s)[i - j:i])] + m)
            total += math.log(p["allow"]) - math.log(p["block"])
        out[s] = total / (len(s) + 1)
    return out


def test_scores_equal_brute_force_and_separate_the_classes(spark):
    rng = random.Random(3)
    urls = sorted({f"http://{rng.choice(['good', 'fine', 'nice'])}{rng.randrange(40)}.org/{rng.choice(['news', 'art'])}/{rng.randrange(99)}" for _ in range(120)}
                  | {f"http://casino{rng.randrange(40)}.bet/{rng.choice(['win', 'spin'])}/{rng.randrange(99)}" for _ in range(120)}
                  | {"http://casino7.net/win", "http://good3.net/news", "http://x.net/é"})
    rules = [("org", "/", "allow"), ("bet", "/", "block")]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    rows = url_filter.judge(df, rules).withColumn("fold", url_filter.fold_of(F.col("url"))).collect()
    label = {r.url: r.verdict if r.rule else None for r in rows}
    fold = {r.url: r.fold for r in rows}
    want = brute_scores(list(label), label, fold)
    assert all(abs(r.score - want[r.url]) < 1e-9 for r in rows)
    got = {r.url: r.verdict for r in rows}
    assert got["http://casino7.net/win"] == "block" and got["http://good3.net/news"] == "allow"
    # the query and the fragment count, and a URL without a host is scored
    more = [*urls, "http://good3.net/news?ref=casino", "http://good3.net/news#spin", "casino9.bet/spin/8"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(more)], "page_id long, url string")
    score = {r.url: r.score for r in url_filter.judge(df, rules).collect()}
    assert len({score[u] for u in score if u.startswith("http://good3.net/news")}) == 3
    assert score["casino9.bet/spin/8"] < 0


# ---------------------------------------------------------------- quality rules

def measures(text):
    w = words_of(text)
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {i + o for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for o in range(3)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


def test_measures(spark):
    rng = random.Random(6)
    texts = [None, "", " \n\t", "a", "a b c", "a b c a b c", "a a a a", "a a a", "x\n\nx\n x\nx", "é#$ %%\r\n|\n|", "a\x85b c\xa0d"]
    texts += [prose(rng, rng.randint(0, 200), v) for v in (2, 3, 5, 50) for _ in range(10)]
    got = by_id(quality_rules.measure(documents(spark, list(enumerate(texts)))).collect())
    for i, t in enumerate(texts):
        assert tuple(got[i][m] for m in quality_rules.MEASURES) == measures(t), t


def test_host_verdicts(spark):
    rng = random.Random(8)
    good = lambda: prose(rng, 80, 10**6)
    rows = [(i, "clean", good()) for i in range(20)] + [(100 + i, "bad", "short") for i in range(9)] + [(109, "bad", good())]
    rows += [(200 + i, None, good()) for i in range(5)] + [(300, "tiny", "too short"), (301, "clean", None), (301, "clean", None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, text string, kept string")
    out = quality_rules.judge(df)
    assert out.columns == ["doc_id", "source", "kept", *quality_rules.MEASURES, "base_failed"]
    got = out.collect()
    assert len(got) == len(rows)
    by = by_id(got)
    assert all(by[i].kept for i in (*range(20), *range(200, 205)))
    assert not by[109].kept and not by[109].base_failed          # rejected with its source
    assert by[300].base_failed and by[301].base_failed and not by[301].kept
    assert quality_rules.judge(df.limit(0)).count() == 0


def test_outlying_host_is_rejected_by_the_fitted_prior(spark):
    rng = random.Random(5)
    share = {f"s{h}": 3 for h in range(30)} | {"odd": 18}                # failures of 40 rows, below one half
    rows = [(h, prose(rng, 80, 10**6) if k >= n else "a b") for h, n in share.items() for k in range(40)]
    rows += [("small", "a b" if k == 0 else prose(rng, 80, 10**6)) for k in range(4)]
    df = documents(spark, [(i, h, t) for i, (h, t) in enumerate(rows)], "doc_id long, source string, text string")
    got = quality_rules.judge(df).collect()
    fine = [r for r in got if not r.base_failed]
    assert {r.source for r in fine if not r.kept} == {"odd"}
    rates = {r.domain: r for r in quality_rules.host_rates(spark.createDataFrame(
        [(h, t == "a b") for h, t in rows], "h string, fail_x boolean"), "h", ["x"]).collect()}
    assert rates["odd"].x_rate > rates["odd"].x_bound > max(r.x_rate for h, r in rates.items() if h != "odd")
    assert rates["small"].x_rate < 0.25                                  # one failure of four rows is shrunk


def test_shrinking_pulls_small_hosts_to_the_mean(spark):
    rows = [(h, k < n * r) for h, n, r in (("a", 100, 0.1), ("b", 100, 0.2), ("c", 100, 0.15), ("d", 2, 1.0)) for k in range(n)]
    df = spark.createDataFrame([(h, f) for h, f in rows], "h string, fail_x boolean")
    got = {r.domain: r.x_rate for r in quality_rules.host_rates(df, "h", ["x"]).collect()}
    assert 0.36 < got["d"] < 1.0 and abs(got["a"] - 0.1) < 0.02


# ---------------------------------------------------------------- fingerprints

def brute_sketch(text):
    w = words_of(text)
    s = {" ".join(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({" ".join(w)} if w else set())
    h = {hashlib.md5(x.encode()).hexdigest() for x in s}
    low = {x for x in h if x < fingerprints.BOUND}
    return {x[:fingerprints.DIGITS] for x in (low or ({min(h)} if h else set()))}


@pytest.mark.parametrize("size", [fingerprints.RANGE_BYTES, 300])
def test_neighbours_and_sketches(spark, size, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", size)
    rng = random.Random(9)
    ids = rng.sample(range(-500, 10**9), 30) + list(range(40, 60))
    rows = [(i, prose(rng, rng.randint(0, 60)), "k") for i in ids] + [(7 * 10**9, None, None), (7 * 10**9 + 1, "é one", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, next_text string").repartition(4)
    out = fingerprints.neighbours(df, derived={"fp": fingerprints.sketch})
    got = out.select("doc_id", "text", "next_text", "fp", "next_fp").collect()
    text = {i: t or "" for i, t, _ in rows}
    order = sorted(text, reverse=True)
    following = dict(zip(order, order[1:] + order[:1], strict=True))
    assert len(got) == len(rows)
    for r in got:
        join = lambda t: "".join(sorted(brute_sketch(t)))
        assert (r.text, r.next_text) == (text[r.doc_id], text[following[r.doc_id]])
        assert (r.fp, r.next_fp) == (join(r.text), join(r.next_text))


@pytest.mark.parametrize("size", [fingerprints.RANGE_BYTES, 40])
def test_neighbours_with_ties_and_nulls(spark, size, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", size)
    rows = [(None, f"null {i}") for i in range(9)] + [(5, "five"), (5, "five"), (5, "cinq"), (9, "nine")]
    got = fingerprints.neighbours(documents(spark, rows)).collect()
    # every row is the next of exactly one row
    assert Counter(r.text for r in got) == Counter(r.next_text for r in got) == Counter(t for _, t in rows)
    assert next(r for r in got if r.doc_id == 9).next_text in ("five", "cinq")
    alone = fingerprints.neighbours(documents(spark, [(1, "x y")])).first()
    assert alone.next_text == "x y"
    assert fingerprints.neighbours(documents(spark, [])).count() == 0


def _range_sizes(spark, df):
    sized = df.select(fingerprints.id_ranges(df, "doc_id", F.octet_length(F.coalesce("text", F.lit(""))),
                                             fingerprints.common.text_key("text")).alias("range"))
    return sorted(r["count"] for r in sized.groupBy("range").count().collect())


def test_ranges_follow_outlying_repeated_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 100 * (fingerprints.ROW_BYTES + 8))
    numbers = list(range(1999)) + [2 ** 60, 2 ** 60 + 1, -2 ** 62]              # beyond a double's digits too
    spread = _range_sizes(spark, documents(spark, [(i, f"text{i:04d}"[:8]) for i in numbers]))
    assert len(spread) >= 15 and spread[-1] <= 300
    rows = [(7 if i % 3 else None if i % 2 else i, f"t{i:07d}") for i in range(2000)]
    spread = _range_sizes(spark, documents(spark, rows))
    assert len(spread) >= 15 and spread[-1] <= 300
    words = documents(spark, [(f"id {i}", f"text{i:04d}") for i in range(2000)], "doc_id string, text string")
    assert _range_sizes(spark, words)[-1] <= 300


def test_neighbours_of_repeated_ids_are_one_cycle(spark, monkeypatch):
    """Each text differs, so following ``next_text`` from any row meets all of them, ids falling."""
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 5 * (fingerprints.ROW_BYTES + 8))
    rows = [(7 if i % 3 else None if i % 2 else 2 ** 60 + i, f"t{i:07d}") for i in range(300)]
    ahead = {r.text: r.next_text for r in fingerprints.neighbours(documents(spark, rows)).collect()}
    ids = {t: -1 if i is None else i for i, t in rows}
    top = max((t for t in ids), key=ids.get)
    walk = [top]
    while ahead[walk[-1]] != top:
        walk.append(ahead[walk[-1]])
        assert len(walk) <= len(rows)
    assert len(walk) == len(rows) and all(ids[a] >= ids[b] for a, b in zip(walk, walk[1:]))


def test_likeness_containment_and_merge(spark):
    rng = random.Random(10)
    long = prose(rng, 4000, 10**6)
    part = " ".join(words_of(long)[:1000])
    rows = [(1, long), (2, part), (3, ""), (4, None), (5, "one two"), (6, prose(rng, 50))]
    fp = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(documents(spark, rows)).collect()}
    df = spark.createDataFrame([(fp[a], fp[b], a, b) for a in fp for b in fp], "a string, b string, i int, j int")
    got = {(r.i, r.j): r for r in df.select("i", "j", fingerprints.likeness(F.col("a"), F.col("b")).alias("like"),
                                            fingerprints.containment(F.col("a"), F.col("b")).alias("inside"),
                                            fingerprints.merge(F.col("a"), F.col("b")).alias("union")).collect()}
    assert all(got[i, i].like == 1 for i in fp) and got[3, 4].like == 1 and got[3, 5].like == 0
    assert got[2, 1].inside > 0.98 and 0.15 < got[1, 2].inside < 0.35 and 0.15 < got[1, 2].like < 0.35
    assert got[1, 2].union == fp[1] and got[1, 6].union == "".join(sorted(brute_sketch(long) | {x for x in brute_sketch(rows[5][1]) if x < "2"}))


# ---------------------------------------------------------------- mixing

def water_fill(sizes, weights=(5, 2, 1), cap=3):
    """Iterated resharing, as the contract words it."""
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        left = total - sum(fixed.values())
        free = [s for s in order if s not in fixed]
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}


@pytest.mark.parametrize("cell", [3, mixing.CELL])
def test_mixing(spark, cell, monkeypatch):
    monkeypatch.setattr(mixing, "CELL", cell)
    rng = random.Random(12)
    rows, n = [], 0
    for source, docs, top in (("b", 150, 40), ("a", 40, 300), ("é", 10, 5), (None, 60, 60), ("zero", 4, 0), ("c", 3, 9), ("Z", 90, 30)):
        for _ in range(docs):
            rows.append((n, source, " ".join(["w"] * rng.randint(0, top)) if top else None))
            n += 1
    rows += [(None, "a", "one two"), (None, "a", None), (5, "b", "x"), (5, "b", "x")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("size", F.lit("old")).repartition(5)
    sizes = Counter()
    for _, s, t in rows:
        sizes[s] += len(words_of(t))
    want = water_fill(dict(sizes))
    out = mixing.sample(df, mixing.size_of("text"))
    assert out.columns == ["doc_id", "source", "text", "size", "source_size", "target", "copies"]
    got = out.collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r.size == len(words_of(r.text)) and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 and 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
    for s, t in want.items():
        biggest = max(len(words_of(x)) for _, y, x in rows if y == s)
        assert abs(taken[s] - t) <= 3 * biggest + 0.05 * t, s
    assert sum(r.copies for r in got if r.source is None) > 0
    again = mixing.sample(df.repartition(2), mixing.size_of("text")).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.text or "", r.copies)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str) and key(got[0])
    emitted = mixing.emit(out)
    assert "copies" not in emitted.columns and emitted.count() == sum(r.copies for r in got)
    assert mixing.sample(df.limit(0), mixing.size_of("text")).count() == 0


def test_full_copies_at_the_cap(spark):
    """Sources whose rate is exactly 3 give exactly three copies of every document."""
    rows = [(i, "a", "w " * 3) for i in range(10)] + [(100 + i, "b", "w " * 300) for i in range(10)]
    got = mixing.sample(spark.createDataFrame(rows, "doc_id long, source string, text string"), mixing.size_of("text")).collect()
    assert {r.copies for r in got if r.source == "a"} == {3}
