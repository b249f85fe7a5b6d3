"""Words of whole texts as 64-bit hashes, by array operations on the bytes of an Arrow string column.

A word's hash is a polynomial in its bytes modulo 2^64, taken from running sums, then mixed. Bytes are worked on in windows that end
between words, so that memory doesn't follow the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WINDOW = 1 << 19
CHUNK = 2 << 20
U = np.uint64
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
NOT_WORD = np.ones(256, bool)  # all but digits, letters and what isn't ASCII
NOT_WORD[48:58] = NOT_WORD[65:91] = NOT_WORD[97:123] = NOT_WORD[128:] = False


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    x = x + U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_TABLE = mix(np.arange(256, dtype=U), 7)
_LOWER = _TABLE.copy()
_LOWER[65:91] = _TABLE[97:123]
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, WINDOW + 1), U(base))
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=U)
    return have[:n]


def chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of some megabytes each; a longer text is alone in its range."""
    ends = offsets(texts)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + size, "right")) - 1)
        yield i, min(j, len(texts))
        i = j


def offsets(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    return np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)


def data(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of texts without nulls."""
    ends = offsets(texts)
    raw = texts.buffers()[2] if len(texts) else None
    whole = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return whole[ends[0]:ends[-1]], ends - ends[0]


def spans(raw: np.ndarray, ends: np.ndarray, gap: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(begin of a window, its bytes, starts and ends of its words)."""
    begin, n = 0, len(raw)
    first = np.unique(ends[:-1]) if len(ends) > 1 else ends[:0]
    while begin < n:
        stop = min(n, begin + WINDOW)
        while stop < n:  # end at a gap or a text's start, further on if a word is longer than the window
            cut = np.flatnonzero(gap[raw[begin:stop]])
            last = int(first[np.searchsorted(first, stop, "right") - 1])
            best = max(begin + int(cut[-1]) + 1 if len(cut) else begin, last)
            if best > begin:
                stop = best
                break
            stop = min(n, stop + WINDOW)
        b = raw[begin:stop]
        word = ~gap[b]
        edge = np.zeros(len(b) + 1, bool)
        edge[first[np.searchsorted(first, begin):np.searchsorted(first, stop)] - begin] = True
        edge[0] = edge[-1] = True
        before = np.concatenate(([False], word[:-1]))
        after = np.concatenate((word[1:], [False]))
        yield begin, b, np.flatnonzero(word & (~before | edge[:-1])), np.flatnonzero(word & (~after | edge[1:])) + 1
        begin = stop


def word_hashes(raw: np.ndarray, ends: np.ndarray, gap: np.ndarray = WHITE, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word, in order."""
    rows, found = [], []
    table = _LOWER if lower else _TABLE
    for begin, b, s, e in spans(raw, ends, gap):
        sums = np.zeros(len(b) + 1, U)
        np.cumsum(table[b] * _power(_BASE, len(b)), dtype=U, out=sums[1:])
        h = (sums[e] - sums[s]) * _power(_INVERSE, len(b) + 1)[s]
        found.append(mix(h ^ (e - s).astype(U)))
        rows.append(np.searchsorted(ends, s + begin, "right") - 1)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, U)
    return np.concatenate(rows), np.concatenate(found)


def word_places(raw: np.ndarray, ends: np.ndarray, gap: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, start, length) of every word, in order; case counts."""
    parts = []
    for begin, b, s, e in spans(raw, ends, gap):
        sums = np.zeros(len(b) + 1, U)
        np.cumsum(_TABLE[b] * _power(_BASE, len(b)), dtype=U, out=sums[1:])
        h = mix((sums[e] - sums[s]) * _power(_INVERSE, len(b) + 1)[s] ^ (e - s).astype(U))
        parts.append((np.searchsorted(ends, s + begin, "right") - 1, h, s + begin, e - s))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, U), none, none
    return tuple(np.concatenate(c) for c in zip(*parts))


def shingle_sets(raw: np.ndarray, ends: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct k-word shingles of every text, in order of row and hash. A text of fewer words has its whole sequence as one."""
    rows, h = word_hashes(raw, ends)
    n = len(ends) - 1
    count = np.bincount(rows, minlength=n)
    start = np.concatenate(([0], np.cumsum(count)))[:-1]
    parts, owners = [], []
    for width in range(1, k + 1):  # texts of fewer than k words are done by their own width
        if width < k:
            at = start[count == width]
        else:
            at = np.arange(max(0, len(h) - k + 1))
            at = at[rows[at] == rows[at + k - 1]] if len(at) else at
        if not len(at):
            continue
        s = np.full(len(at), U(width))
        for i in range(width):
            s = mix(s * U(0x2545F4914F6CDD1D) ^ h[at + i])
        parts.append(s)
        owners.append(rows[at])
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, U)
    s, owner = np.concatenate(parts), np.concatenate(owners)
    if len(parts) > 1:
        order = np.argsort(owner, kind="stable")
        s, owner = s[order], owner[order]
    bounds = np.flatnonzero(np.diff(owner)) + 1
    for i, j in zip(np.concatenate(([0], bounds)), np.concatenate((bounds, [len(s)]))):
        s[i:j].sort()
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], s[new]
