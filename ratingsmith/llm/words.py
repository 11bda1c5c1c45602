"""Vectorised word and window hashing over Arrow text batches (numpy only).

Words are maximal runs of bytes other than space and ``\\t \\n \\v \\f \\r``.
A word's hash takes its bytes in blocks of eight, each mixed into a state before the next
(a plain polynomial modulo 2**64 would give some constructible words equal hashes); words of more than
LONG bytes are hashed by BLAKE2.  A window's hash is a polynomial over its words' hashes, computed
with prefix sums, so the cost does not depend on the window's length.  A text
is worked on in segments cut at white space, so the working memory does not
grow with a text's length (only the eight bytes a word for its hash do).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
MASK = (1 << 64) - 1
#: Seeds of the two hashes of bytes, bytes hashed block by block, odd multipliers of the two word polynomials.
SEEDS, LONG = (0x243F6A8885A308D3, 0x13198A2E03707344), 256
WORD_MULS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
#: Bytes of text hashed at once.
SEGMENT = 1 << 19

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** (0 .. n)`` modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        have = np.full(max(n + 1, 4096), base & MASK, U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if len(have) <= 4 * SEGMENT:
            _powers[base] = have
    return have[: n + 1]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(30))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def span_hashes(buf: np.ndarray, s: np.ndarray, e: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of the bytes from each ``s`` to ``e``."""
    size = (e - s).astype(np.int64)
    h = mix(size.astype(U) * U(0x9E3779B97F4A7C15) + U(SEEDS[which]))
    if not len(h):
        return h
    wide = np.concatenate((buf, np.zeros(8, np.uint8)))
    blocks = np.ndarray(len(buf) + 1, "<u8", wide, strides=(1,))       # the eight bytes from every place
    at, rest = s.astype(np.int64), size.copy()
    live = np.flatnonzero((rest > 0) & (size <= LONG))
    while len(live):
        some = live if len(live) < len(h) else slice(None)
        left = rest[some]
        block = blocks[at[some]]
        short = left < 8
        if short.any():
            block = block & np.where(short, (U(1) << (U(8) * np.minimum(left, 7).astype(U))) - U(1), U(MASK))
        h[some] = mix((h[some] ^ block) * U(0xD6E8FEB86659FD93) + U(0x9E3779B97F4A7C15))
        at[some] += 8
        rest[some] -= 8
        live = live[rest[live] > 0]
    for i in np.flatnonzero(size > LONG).tolist():
        got = hashlib.blake2b(buf[s[i]:e[i]].tobytes(), digest_size=8, salt=b"%d" % which).digest()
        h[i] = U(int.from_bytes(got, "little"))
    return h


def is_space(buf: np.ndarray) -> np.ndarray:
    return (buf == 32) | ((buf >= 9) & (buf <= 13))


def spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of every word."""
    edge = np.flatnonzero(np.diff(is_space(buf).astype(np.int8), prepend=1, append=1))
    return edge[0::2], edge[1::2]


def _lower(buf: np.ndarray) -> np.ndarray:
    return np.where((buf >= 65) & (buf <= 90), buf + 32, buf)


def _segments(buf: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of ``buf`` at white space, each about SEGMENT bytes (longer if one word is)."""
    at, n = 0, len(buf)
    while at < n:
        end = min(n, at + SEGMENT)
        while end < n:
            gap = np.flatnonzero(is_space(buf[end:end + SEGMENT]))
            if len(gap):
                end += int(gap[0]) + 1
                break
            end = min(n, end + SEGMENT)
        yield at, end
        at = end


def word_hashes(buf: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, hash)`` of every word of a byte buffer."""
    out = []
    for at, end in _segments(buf):
        seg = buf[at:end]
        if lower:
            seg = _lower(seg)
        s, e = spans(seg)
        if not len(s):
            continue
        h = span_hashes(seg, s, e)
        out.append((s + at, e + at, h))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, U)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def window_hashes(words: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """Hash of the ``width`` words that start at each place (empty if there are fewer)."""
    n = len(words)
    if n < width:
        return np.zeros(0, U)
    base = WORD_MULS[which]
    step, out = max(SEGMENT, width), []
    for at in range(0, n - width + 1, step):
        part = words[at:at + step + width - 1]
        m = len(part)
        pre = np.zeros(m + 1, U)
        np.cumsum(part * powers(base, m)[:m], out=pre[1:])
        out.append(mix((pre[width:] - pre[:-width]) * powers(inverse(base), m)[:m - width + 1]))
    return np.concatenate(out)


def buffers(col: pa.Array, limit: int = SEGMENT, most: int = 100_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, rows, bytes, offsets)`` of consecutive rows of a string column.

    A run holds up to ``most`` rows of ``limit`` bytes together, or one longer row.  Rows are separated
    by one newline, so no word spans two rows; ``offsets`` has where each row
    starts, and the end.  NULL counts as empty.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_string(col.type):
        col = col.cast(pa.large_string())
    if len(col) == 0:
        return
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    size = np.diff(off)
    if col.null_count:
        size = np.where(np.asarray(col.is_null()), 0, size)
    at, n = 0, len(col)
    while at < n:
        end = at + max(1, int(np.searchsorted(np.cumsum(size[at:at + most] + 1), limit, side="right")))
        end = min(end, n)
        ends = np.cumsum(size[at:end] + 1)
        starts = np.concatenate(([0], ends))
        buf = np.full(int(ends[-1]), 10, np.uint8)
        for i in range(at, end):
            a = starts[i - at]
            buf[a:a + size[i]] = raw[off[i]:off[i] + size[i]]
        yield at, end - at, buf, starts
        at = end


def per_row(starts: np.ndarray, s: np.ndarray) -> np.ndarray:
    """First word index of each row of ``buffers``, and the number of words."""
    return np.searchsorted(s, starts).astype(np.int64)


def ragged(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for every count c, joined."""
    total = int(counts.sum())
    first = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(first, counts)
