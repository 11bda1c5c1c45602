"""Vectorised pre-tokenisation for byte-level BPE, and a cache of encoded pieces.

``pieces`` cuts texts exactly as the public pattern does, without a regex engine::

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Code points fall into four classes (letter, number, white space, other), and a
piece is a run of one class with three amendments: one blank joins the run that
follows it, the last character of longer white space before a word is cut off,
and an apostrophe run of length one takes its contraction suffix along.
Distinct pieces are told apart by two 64-bit hashes, so that each is encoded once.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np

from . import words

U = np.uint64
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
#: White space of the pattern's ``\s`` (the Unicode property White_Space).
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@functools.cache
def classes() -> np.ndarray:
    out = np.zeros(0x110000, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for c in range(0x110000):
        out[c] = kinds.get(unicodedata.category(chr(c))[0], OTHER)
    out[WHITE] = SPACE
    return out


def pieces(raw: bytes, row_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offset of every piece of UTF-8 texts joined in ``raw``, and pieces per text.

    ``row_bytes`` has each text's length in bytes; no piece spans two texts.
    """
    cps = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(cps)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(row_bytes), np.int64)
    width = np.ones(n, np.int64)
    if n != len(raw):
        width += (cps >= 0x80)
        width += (cps >= 0x800)
        width += (cps >= 0x10000)
    at_byte = np.cumsum(width) - width
    row_at = np.searchsorted(at_byte, np.cumsum(row_bytes) - row_bytes)   # first code point of each text
    row_at = row_at[row_bytes > 0]
    edge = np.zeros(n + 1, bool)
    edge[row_at] = True
    edge[n] = True
    kind = classes()[cps]
    run = edge.copy()
    run[1:n] |= kind[1:] != kind[:-1]
    start = run.copy()
    # the last character of white space that a word follows
    after = np.flatnonzero(run[1:n] & ~edge[1:n] & (kind[:-1] == SPACE)) + 1
    start[after - 1] = True
    start[after[cps[after - 1] == 0x20]] = False
    # contractions
    quote = np.flatnonzero((cps[:-1] == 0x27) & run[:n - 1] & start[:n - 1] & (kind[1:] == LETTER) & ~edge[1:n])
    if len(quote):
        one = cps[quote + 1]
        two = np.where(quote + 2 < n, cps[np.minimum(quote + 2, n - 1)], 0)
        two = np.where(edge[quote + 2], 0, two)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        for hit, size in ((short, 2), (long, 3)):
            q = quote[hit]
            start[q + 1] = False
            start[q + size] = True
    first = np.flatnonzero(start[:n])
    per = np.zeros(len(row_bytes), np.int64)
    full = row_bytes > 0
    if full.any():
        per[full] = np.diff(np.append(np.searchsorted(first, row_at), len(first)))
    return at_byte[first], per


def piece_hashes(buf: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each piece of a buffer that the pieces fill."""
    end = np.append(start[1:], len(buf))
    return words.span_hashes(buf, start, end), words.span_hashes(buf, start, end, 1)


class Encoder:
    """Encodes texts by encoding each distinct piece once.

    ``encode_new(pieces: list[bytes])`` returns ``(ids, counts)`` for pieces not
    seen lately.  At most ``keep`` pieces are kept between calls (memory only, about
    40 bytes each; the result does not depend on it).  New pieces go to a small
    sorted table, which is merged into the large one when it has a quarter of its size.
    """

    def __init__(self, encode_new, keep: int = 2_500_000):
        self.encode_new, self.keep = encode_new, keep
        self.forget()

    def forget(self) -> None:
        none = (np.zeros(0, U), np.zeros(0, U), np.zeros(0, np.int32), np.zeros(0, np.int32))
        self.old, self.young = none, none                 # hash (sorted), second hash, place of the ids, their number
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0

    def _find(self, h: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
        """Place and number of ids per hash, number -1 if unknown; and whether a second hash differs."""
        at, count, clash = np.zeros(len(h), np.int64), np.full(len(h), -1, np.int64), False
        for keys, second, where, size in (self.old, self.young):
            if len(keys):
                i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                hit = keys[i] == h
                i = i[hit]
                clash |= bool((second[i] != check[hit]).any())
                at[hit], count[hit] = where[i], size[i]
        return at, count, clash

    def _add(self, h: np.ndarray, check: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        need = self.used + len(ids)
        if need > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(max(need - len(self.ids), len(self.ids) // 2), np.int32)))
        self.ids[self.used:need] = ids
        fresh = (h, check, (self.used + np.cumsum(count) - count).astype(np.int32), count.astype(np.int32))
        self.used = need
        self.young = _merged(self.young, fresh)
        if 4 * len(self.young[0]) > len(self.old[0]):
            self.old, self.young = _merged(self.old, self.young), tuple(x[:0] for x in fresh)

    def encode(self, raw: bytes, row_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids of all texts, ids per text)``."""
        start, per = pieces(raw, row_bytes)
        if not len(start):
            return np.zeros(0, np.int32), per
        buf = np.frombuffer(raw, np.uint8)
        first, second = piece_hashes(buf, start)
        h, where, which = np.unique(first, return_index=True, return_inverse=True)
        check = second[where]
        end = np.append(start[1:], len(raw))
        cut = np.concatenate(([0], np.cumsum(per)))
        piece = lambda at: [raw[a:b] for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)]
        if (check[which] != second).any():       # two pieces with one hash: none of them goes through the cache
            ids, count = self.encode_new(piece(np.arange(len(start))))
            return ids, np.diff(np.concatenate(([0], np.cumsum(count)))[cut])
        at, count, clash = self._find(h, check)
        fresh = np.flatnonzero(count < 0)
        if len(fresh) or clash:
            if clash or (len(self.old[0]) + len(self.young[0]) + len(fresh) > self.keep and self.used):
                self.forget()
                fresh = np.arange(len(h))
            ids, n = self.encode_new(piece(where[fresh]))
            self._add(h[fresh], check[fresh], ids, n)
            at, count, _ = self._find(h, check)
        at, count = at[which], count[which]
        ids = self.ids[np.repeat(at, count) + words.ragged(count)]
        return ids, np.diff(np.concatenate(([0], np.cumsum(count)))[cut])


def _merged(a: tuple, b: tuple) -> tuple:
    if not len(a[0]):
        return b
    order = np.argsort(np.concatenate((a[0], b[0])), kind="stable")
    return tuple(np.concatenate((x, y))[order] for x, y in zip(a, b, strict=True))


def raw_runs(col, limit: int = 2 * words.SEGMENT):
    """``(first row, rows, bytes, bytes per row)`` of consecutive rows; NULL counts as empty."""
    import pyarrow as pa
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_string(col.type):
        col = col.cast(pa.large_string())
    if not len(col):
        return
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int64)[col.offset:col.offset + len(col) + 1]
    size = np.diff(off)
    null = np.asarray(col.is_null()) if col.null_count else np.zeros(len(col), bool)
    size = np.where(null, 0, size)
    at = 0
    while at < len(size):
        end = min(len(size), at + max(1, int(np.searchsorted(np.cumsum(size[at:]), limit, side="right"))))
        if null[at:end].any():
            raw = b"".join(data[off[i]:off[i + 1]].to_pybytes() for i in range(at, end) if size[i])
        else:
            raw = data[off[at]:off[end]].to_pybytes() if off[end] > off[at] else b""
        yield at, end - at, raw, size[at:end]
        at = end
