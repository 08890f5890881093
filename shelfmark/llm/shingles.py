"""Sets of word shingles as sorted 64-bit hashes, worked out on whole buffers of text.

Defined cases: an empty text, or one without words, has the empty set; repeated shingles count once; texts of any length
are read whole; a buffer without texts gives no sets. Null texts are for the caller to make empty.
"""

from __future__ import annotations

import numpy as np

from .common import mix64

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_fold = np.arange(256, dtype=np.uint64)
_fold[65:91] += 32
_space = np.zeros(256, bool)
_space[[32, *range(9, 14)]] = True


class Shingler:
    """Shingles of `width` words `[^\\x20\\x09-\\x0D]+`, A to Z lower-cased. A text of fewer words has one: all its words."""

    def __init__(self, width: int):
        self.width = width
        self.power = self.inverse = np.ones(0, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, 1 << 16)
            for name, base in (("power", _BASE), ("inverse", _INVERSE)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def sets(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All texts' sets, one after the other, each sorted; and the sets' sizes."""
        docs = len(offsets) - 1
        n = len(data)
        if not n:
            return np.zeros(0, np.uint64), np.zeros(docs, np.int64)
        self._powers(n + 1)
        with np.errstate(over="ignore"):
            blank = _space[data]
            edge = np.zeros(n + 1, bool)
            edge[offsets] = True
            word = np.append(~blank, False)
            before = np.append(False, ~blank)
            start = np.flatnonzero(word & (~before | edge))
            end = np.flatnonzero(before & (~word | edge))
            upto = np.zeros(n + 1, np.uint64)
            np.cumsum(_fold[data] * self.power[:n], out=upto[1:])
            h = mix64((upto[end] - upto[start]) * self.inverse[start] + (end - start).astype(np.uint64) * _STEP)
            # first word of each text
            first = np.searchsorted(start, offsets)
            words = np.diff(first)
            w = self.width
            rolled = h[: max(0, len(h) - w + 1)].copy()
            for k in range(1, w):
                rolled = mix64(rolled * _STEP + h[k : k + len(rolled)])
            out, sizes = [], np.zeros(docs, np.int64)
            for d in np.flatnonzero(words):
                a, b = first[d], first[d + 1]
                if b - a < w:
                    one = h[a]
                    for k in range(a + 1, b):
                        one = mix64(np.atleast_1d(one * _STEP + h[k]))[0]
                    out.append(np.array([mix64(np.atleast_1d(one + _STEP * np.uint64(b - a)))[0]], np.uint64))
                    sizes[d] = 1
                    continue
                s = np.sort(rolled[a : b - w + 1])
                fresh = np.ones(len(s), bool)
                np.not_equal(s[1:], s[:-1], out=fresh[1:])
                s = s[fresh]
                out.append(s)
                sizes[d] = len(s)
        return (np.concatenate(out) if out else np.zeros(0, np.uint64)), sizes


def set_key(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit key of each set, equal for equal sets; 0 for empty sets."""
    upto = np.append(np.uint64(0), np.cumsum(mix64(tokens ^ _STEP)))
    ends = np.cumsum(sizes)
    sums = upto[ends] - upto[ends - sizes]
    key = mix64(sums + sizes.astype(np.uint64))
    return np.where(sizes > 0, key, np.uint64(0))
