"""Word and shingle hashes of Arrow text columns, in numpy, inside tasks.

A word is a run of bytes other than blank, tab, LF, VT, FF and CR.  Its hash is a
polynomial over its bytes modulo 2**64 with an odd base, read off prefix sums, then
mixed.  Shingles combine the hashes of neighbouring words.  Two texts are compared by
these 64-bit values: two different shingles of a pair of texts meet with a chance
below 1e-12.  Work is done in blocks of about ``BLOCK`` bytes, a longer text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: A word ends a sentence by one of these, not by a run of them: some texts put such a run after every word.
_STOPS = np.frombuffer(b"!.?", np.uint8)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U)) | _U(1)


def _power(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        steps = np.full(max(n, BLOCK + 1), base, _U)
        steps[0] = 1
        made = np.multiply.accumulate(steps)
        if n > BLOCK + 1:
            return made  # of one very long text: not kept
        _powers[base] = made
    return _powers[base]


class Words(NamedTuple):
    """The words of rows ``first`` to ``last`` of a column; positions are bytes within the row's text."""

    first: int
    last: int
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    ends_line: np.ndarray
    ends_sentence: np.ndarray

    def bounds(self) -> np.ndarray:
        """Where the words of each row begin, and where the last ones end."""
        return np.searchsorted(self.row, np.arange(self.first, self.last + 1))


def blocks(column: pa.Array, lower: bool = True) -> Iterator[Words]:
    """Words of a text column, in blocks of whole rows; a null text has none."""
    texts = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK, "right")) - 1)
        yield _words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], first, last, lower)
        first = last


def _words(data: np.ndarray, at: np.ndarray, first: int, last: int, lower: bool) -> Words:
    blank = _SPACE[data]
    head = np.zeros(len(data) + 1, bool)
    head[at] = True
    before = np.empty_like(blank)
    before[:1], before[1:] = True, blank[:-1]
    after = np.empty_like(blank)
    after[-1:], after[:-1] = True, blank[1:]
    starts = np.flatnonzero(~blank & (before | head[:-1]))
    ends = np.flatnonzero(~blank & (after | head[1:])) + 1
    value = _BYTE[_LOWER[data] if lower else data] * _power(_BASE, len(data) + 1)[: len(data)]
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(value, out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(data) + 1)[starts])
    row = np.searchsorted(at, starts, "right") - 1
    breaks = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data == 10, out=breaks[1:])
    following = np.append(starts[1:], len(data))
    closing = np.zeros(len(ends), bool)
    if len(ends):
        run = (ends - starts > 1) & np.isin(data[np.maximum(ends - 2, 0)], _STOPS)
        closing = np.isin(data[ends - 1], _STOPS) & ~run
    line = breaks[following] > breaks[ends] if len(ends) else np.zeros(0, bool)
    final = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
    line = line | final
    return Words(first, last, row + first, starts - at[row], ends - at[row], hashes, line, line | closing)


def parity_marks(tokens: np.ndarray, bits: int) -> list[int]:
    """64-bit marks in which each token flips one of ``bits`` bits: two sets differ in at least as many tokens as their marks in bits."""
    odd = np.bincount((tokens.view(_U) >> _U(11) & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).view(np.int64).tolist()


def shingles(hashes: np.ndarray, groups: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` neighbouring words of one group, with their groups; a group of fewer words gives one.

    ``groups`` is the sorted group number of each word.
    """
    if not len(hashes):
        return hashes, groups
    heads = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
    counts = np.diff(np.append(heads, len(groups)))
    out, of = [], []
    for size in range(1, n + 1):
        if size < n:
            starts = heads[counts == size]
        elif len(hashes) >= n:
            starts = np.flatnonzero(groups[: len(groups) - n + 1] == groups[n - 1 :])
        else:
            starts = heads[:0]
        if not len(starts):
            continue
        value = mix(hashes[starts] + _U(size))
        for k in range(1, size):
            value = mix(value * _U(3) + hashes[starts + k])
        out.append(value)
        of.append(groups[starts])
    value, of = np.concatenate(out), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return value[order], of[order]
