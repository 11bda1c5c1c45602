"""Removal of repeated passages by difference-cover anchors (operator 1).

A window is ``WINDOW`` = 35 consecutive words of one document.  Every word that
is covered by a window whose word sequence also starts anywhere else (in another
row, or elsewhere in the same one) is removed; windows are judged on the input.

Method.  Positions p of a document with ``p mod PERIOD`` in the difference cover
``COVER`` carry an anchor, the hash of the ``ANCHOR`` words from p.  COVER is a
perfect difference set: for starts i and j of two equal windows some shift
d < PERIOD makes both i + d and j + d cover positions, and since PERIOD - 1 +
ANCHOR = WINDOW the two aligned anchors lie within the windows.  So only 5 of 21
positions are hashed and exchanged, and

1. anchors that occur at least twice mark the windows around them as candidates;
2. each candidate is extended to its whole window: its 128-bit hash is exchanged
   the same way, and windows that occur at least twice are repeated;
3. the words they cover are removed from the texts.

Scale.  Both exchanges are packed (``packed``): a map task gathers up to FLUSH
hashes and sends each distinct one once (local repeats are answered locally, each
place of a text once), so a passage that a third of all rows share costs one entry
a gathering, and no pairs are ever formed.  Copies of a text that is gathered
already are only noted, not gathered again.  Answers return by text key.  A bitmap of the answered keys (8 MB, broadcast) keeps texts that
have none out of the joins; the joins read staged answers, so Spark can split the
partition of a text with very many copies.

Defined cases.  NULL text: no words, kept text is empty.  Fewer than 35 words:
nothing is removed.  Repeated rows are occurrences of their own: each of two equal
rows of 35 words or more is removed whole.  NULLs in other columns and extra
columns pass through; result columns replace input columns of the same name.  Empty
table: empty result.  Answers are joined back by a 64-bit key in which all
texts differ (``common.distinct_key``).  One text is held by one task at a time, with 8 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, packed, words

U = np.uint64
WINDOW, PERIOD, ANCHOR = 35, 21, 15
COVER = (0, 1, 4, 14, 16)
#: Entries a map task gathers before it sends them, and the entries of one bucket.
FLUSH, BUCKET = 1_500_000, 1_500_000
#: Texts of one gathering, which bounds the keys that tell copies.
TEXTS = 300_000

ENTRY = packed.schema("h", "g", "k", "r", "lo", "hi", "f", "ek", "ep")
ANSWER = packed.schema("k", "p")


def entries(h: np.ndarray, g: np.ndarray, k: np.ndarray, p: np.ndarray, n: int,
            copied: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Rows for the exchange of hashes (h, g) found at place p of text k; g may be empty.

    A hash that this task saw more than once, or in one of the texts ``copied``, is sent
    once, marked as repeated; its places are answered at once (columns ek, ep).
    """
    if not len(h):
        return
    order = np.lexsort((g, h)) if len(g) else np.argsort(h)
    hs = h[order]
    new = np.concatenate(([True], hs[1:] != hs[:-1]))
    if len(g):
        new[1:] |= g[order][1:] != g[order][:-1]
    first = np.flatnonzero(new)
    size = packed.run_sizes(first, len(hs))
    again = size > 1
    if copied is not None and len(copied):
        again |= np.logical_or.reduceat(np.isin(k, copied)[order], first)
    told = order[np.repeat(again, size)]
    rep = order[first]
    flag = np.zeros(len(h), np.uint8)
    flag[rep] = again
    rep = np.sort(rep)                      # back in text order, so runs of k compress
    b = packed.bucket_of(h[rep], n)
    order = np.argsort(b, kind="stable")
    rep, b = rep[order], b[order]
    ek, ep = unique_places(k[told], p[told])        # copies of a text tell the same places
    eb = (ek % U(n)).astype(np.int32)
    order = np.argsort(eb, kind="stable")
    ek, ep, eb = ek[order], ep[order], eb[order]
    rows = []
    for i, j in packed.cuts(b):
        at = rep[i:j]
        kk = k[at]
        starts = packed.runs(kk)
        rows.append((int(b[i]), h[at].tobytes(), g[at].tobytes() if len(g) else b"", kk[starts].tobytes(),
                     packed.run_sizes(starts, len(kk)).astype(np.uint32).tobytes(),
                     (p[at] & 0xFFFF).astype(np.uint16).tobytes(), (p[at] >> 16).astype(np.uint16).tobytes(),
                     flag[at].tobytes(), b"", b""))
    for i, j in packed.cuts(eb):
        rows.append((int(eb[i]), b"", b"", b"", b"", b"", b"", b"",
                     ek[i:j].tobytes(), ep[i:j].astype(np.uint32).tobytes()))
    cols = list(zip(*rows, strict=True))
    yield pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])],
        names=["bucket", "h", "g", "k", "r", "lo", "hi", "f", "ek", "ep"])


def repeated(n: int):
    """Bucket -> places whose hash occurs at least twice, cut anew by text key."""
    def run(tbl: pa.Table) -> pa.Table:
        h, g = packed.unpack(tbl, "h", U), packed.unpack(tbl, "g", U)
        r = packed.unpack(tbl, "r", np.uint32)
        k = np.repeat(packed.unpack(tbl, "k", U), r)
        p = packed.unpack(tbl, "hi", np.uint16).astype(np.uint32) << 16 | packed.unpack(tbl, "lo", np.uint16)
        f = packed.unpack(tbl, "f", np.uint8)
        order = np.lexsort((g, h)) if len(g) else np.argsort(h)
        hs = h[order]
        new = hs[1:] != hs[:-1]
        if len(g):
            new |= g[order][1:] != g[order][:-1]
        first = np.flatnonzero(np.concatenate(([True], new))) if len(hs) else np.zeros(0, np.int64)
        size = packed.run_sizes(first, len(hs))
        hit = order[np.repeat(size > 1, size)]
        hit = hit[f[hit] == 0]
        k = np.concatenate((k[hit], packed.unpack(tbl, "ek", U)))
        p = np.concatenate((p[hit], packed.unpack(tbl, "ep", np.uint32)))
        k, p = unique_places(k, p)
        out = packed.pack((k % U(n)).astype(np.int32), {"k": k, "p": p})
        return pa.Table.from_batches([out])
    return run


def unique_places(k: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((p, k))
    k, p = k[order], p[order]
    new = np.concatenate(([True], (k[1:] != k[:-1]) | (p[1:] != p[:-1]))) if len(k) else np.zeros(0, bool)
    return k[new], p[new]


def gather(tbl: pa.Table) -> pa.Table:
    """Bucket of text keys -> one row for each text with its sorted places."""
    k, p = unique_places(packed.unpack(tbl, "k", U), packed.unpack(tbl, "p", np.uint32))
    cut = packed.cuts(k)
    return pa.table({"k": pa.array(k[packed.runs(k)].view(np.int64), pa.int64()),
                     "places": pa.array([p[i:j].tobytes() for i, j in cut], pa.binary())})


def places(sent: DataFrame, n: int) -> DataFrame:
    """Exchanged entries -> ``(k, places)``: where a text has hashes that occur twice or more."""
    return (sent.groupBy("bucket").applyInArrow(common.map_group(repeated(n)), ANSWER)
            .groupBy("bucket").applyInArrow(common.map_group(gather), "k long, places binary"))


class Gathered:
    """Collects arrays until there are enough to send; the entries of equal texts once."""

    def __init__(self, n: int):
        self.n, self.count, self.held = n, 0, []
        self.texts, self.copied = set(), set()

    def fresh(self, key: int) -> bool:
        """Whether a text is to be gathered; one that was gathered already is noted as copied."""
        if key in self.texts:
            self.copied.add(key)
            return False
        self.texts.add(key)
        return True

    def add(self, h, g, k, p) -> Iterator[pa.RecordBatch]:
        if len(h):
            self.held.append((h, g, k, p))
            self.count += len(h)
            if self.count >= FLUSH or len(self.texts) >= TEXTS:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            cols = [np.concatenate(c) for c in zip(*self.held, strict=True)]
            copied = np.fromiter(self.copied, U, len(self.copied))
            self.held, self.count, self.texts, self.copied = [], 0, set(), set()
            yield from entries(*cols, self.n, copied)


def _texts(batch: pa.RecordBatch):
    """Per run of rows: first row, rows, bytes, word starts and ends, word hashes, first word of each row."""
    for at, n, buf, starts in words.buffers(batch["text"]):
        s, e, h = words.word_hashes(buf)
        yield at, n, buf, s, e, h, words.per_row(starts, s)


def send_anchors(n: int, window: int, period: int, anchor: int, cover: tuple[int, ...]):
    def run(batches):
        out = Gathered(n)
        covered = np.zeros(period, bool)
        covered[list(cover)] = True
        for batch in batches:
            keys = np.asarray(batch["k"]).view(U)
            for at, rows, _, _, _, h, first in _texts(batch):
                count = np.diff(first)
                a = words.window_hashes(h, anchor)
                pos = words.ragged(count)[:len(a)]
                row = np.repeat(np.arange(rows), count)[:len(a)]
                new = np.array([c >= window and out.fresh(key) for c, key in zip(count.tolist(), keys[at:at + rows].tolist(), strict=True)], bool)
                ok = (covered[pos % period] & (pos + anchor <= count[row]) & new[row])
                where = np.flatnonzero(ok)
                yield from out.add(a[where], a[:0], keys[at + row[where]],
                                   pos[where].astype(np.uint32))
        yield from out.flush()
    return run


def _candidates(p: np.ndarray, count: int, window: int, anchor: int) -> np.ndarray:
    """Starts of the windows of a text of ``count`` words that hold an anchor at one of ``p``."""
    mark = np.zeros(count + 2, np.int32)
    p = p[p + anchor <= count].astype(np.int64)
    np.add.at(mark, np.maximum(p + anchor - window, 0), 1)
    np.add.at(mark, np.minimum(p, count - window) + 1, -1)
    return np.flatnonzero(np.cumsum(mark[:max(0, count - window + 1)]) > 0)


def send_windows(n: int, window: int, anchor: int):
    def run(batches):
        out = Gathered(n)
        for batch in batches:
            keys = np.asarray(batch["k"]).view(U)
            marks = batch["places"]
            for at, rows, _, _, _, h, first in _texts(batch):
                for i in range(rows):
                    count = int(first[i + 1] - first[i])
                    if count < window or not out.fresh(int(keys[at + i])):
                        continue
                    w = h[first[i]:first[i + 1]]
                    p = np.frombuffer(marks[at + i].as_buffer(), np.uint32)
                    start = _candidates(p, count, window, anchor)
                    yield from out.add(words.window_hashes(w, window, 0)[start],
                                       words.window_hashes(w, window, 1)[start],
                                       np.full(len(start), keys[at + i], U), start.astype(np.uint32))
        yield from out.flush()
    return run


def keep_words(window: int, sent=None, layout: bool = False):
    """Replaces texts by their kept words and adds the counts, given the repeated window starts.

    With ``layout`` only the removed spans are cut, and texts without any stay as they are.

    With a broadcast bitmap only texts without repeats are handled, the others are left out.
    """
    def run(batches):
        for batch in batches:
            kept, total, gone = [], [], []
            if sent is None:
                marks = batch["places"]
            else:
                batch = batch.filter(pa.array(~common.listed(sent.value, np.asarray(batch["k"]))))
                marks = pa.nulls(batch.num_rows, pa.binary())
            for at, rows, buf, starts in words.buffers(batch["text"]):
                s, e = words.spans(buf)
                first = words.per_row(starts, s)
                for i in range(rows):
                    a, b = first[i], first[i + 1]
                    count = int(b - a)
                    keep = np.ones(count, bool)
                    if marks[at + i].is_valid and count >= window:
                        p = np.frombuffer(marks[at + i].as_buffer(), np.uint32).astype(np.int64)
                        p = p[p + window <= count]
                        cover = np.zeros(count + 1, np.int64)
                        np.add.at(cover, p, 1)
                        np.add.at(cover, p + window, -1)
                        keep = np.cumsum(cover[:count]) == 0
                    if not layout:
                        kept.append(join_words(buf, s[a:b], e[a:b], keep))
                    elif keep.all():
                        kept.append(batch["text"][at + i].as_py())
                    else:
                        kept.append(cut_words(buf, s[a:b], e[a:b], keep, int(starts[i]), int(starts[i + 1]) - 1))
                    total.append(count)
                    gone.append(count - int(keep.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(kept, pa.string()) if layout else pa.array(kept, pa.binary()).cast(pa.string()),
                 pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                names=["row", "kept", "n_words", "n_removed"])
    return run


def join_words(buf: np.ndarray, s: np.ndarray, e: np.ndarray, keep: np.ndarray) -> bytes:
    """The kept words, one space between two."""
    s, e = s[keep], e[keep]
    if not len(s):
        return b""
    mark = np.zeros(int(e[-1]) + 2 - int(s[0]), np.int8)
    base = int(s[0])
    mark[s - base] += 1
    mark[e + 1 - base] -= 1                # one byte after the word becomes the space
    inside = np.cumsum(mark[:int(e[-1]) - base]) > 0
    part = buf[base:int(e[-1])][inside]
    return np.where(words.is_space(part), np.uint8(32), part).tobytes()


def cut_words(buf: np.ndarray, s: np.ndarray, e: np.ndarray, keep: np.ndarray, start: int, stop: int) -> str:
    """The text without its removed words and the white space after them (before them at the end); '' if none is kept."""
    if not keep.any():
        return ""
    edge = np.flatnonzero(np.diff(keep.astype(np.int8), prepend=1, append=1))
    out, at = [], start
    for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True):
        last = b == len(keep)
        out.append(buf[at:int(e[a - 1]) if last else int(s[a])].tobytes())
        at = int(e[b - 1]) if last else int(s[b])
    out.append(buf[at:stop].tobytes())
    return b"".join(out).decode("utf-8")


def remove_repeats(df: DataFrame, text: str = "text", n_words: str = "n_words",
                   n_removed: str = "n_removed", window: int = WINDOW, period: int = PERIOD,
                   anchor: int = ANCHOR, cover: tuple[int, ...] = COVER, layout: bool = False) -> DataFrame:
    """``df`` with the kept words in place of each text, and ``n_words``, ``n_removed``.

    ``layout=True`` keeps the white space: texts without repeats (NULL too) are untouched, from others only the removed
    spans are cut.
    """
    if period - 1 + anchor != window:
        raise ValueError("period - 1 + anchor must equal the window")
    if {(a - b) % period for a in cover for b in cover} != set(range(period)):
        raise ValueError("cover is no difference cover modulo the period")
    spark = df.sparkSession
    common.small_batches(spark)
    stages = common.Stages(spark, "substring")
    src = df.select(common.others(df, text).alias("row"), F.col(text).alias("text"),
                    common.distinct_key(df, text).alias("k"))
    n = common.parts(spark, common.text_bytes(df, text) / 6 * len(cover) / period, BUCKET)
    sent = src.select("k", "text").mapInArrow(common.map_batches(send_anchors(n, window, period, anchor, cover)), ENTRY)
    cand = stages.put(places(sent, n), "candidates")
    texts, kinds = src.select("k", "text"), "k long, text string"
    bits = spark.sparkContext.broadcast(common.key_bitmap(cand))
    near = texts.mapInArrow(common.map_batches(common.only_listed(bits)), kinds).join(cand, "k")
    found = stages.put(places(near.mapInArrow(common.map_batches(send_windows(n, window, anchor)), ENTRY), n), "repeats")
    stages.drop("candidates")
    # texts without repeats are finished where they are read; the others meet their places
    bits = spark.sparkContext.broadcast(common.key_bitmap(found))
    rows = src.mapInArrow(common.map_batches(common.only_listed(bits)), src.schema).join(found, "k", "left").select("row", "text", "places")
    shape = T.StructType([rows.schema["row"], T.StructField("kept", T.StringType()),
                          T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    done = (rows.mapInArrow(common.map_batches(keep_words(window, layout=layout)), shape)
            .unionAll(src.mapInArrow(common.map_batches(keep_words(window, bits, layout)), shape)))
    return common.restore(df, done, {text: "kept", n_words: "n_words", n_removed: "n_removed"})
