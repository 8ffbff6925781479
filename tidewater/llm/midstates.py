"""SHA-256 of many messages at once, with states that can be kept and resumed: numpy, inside tasks.

A state is eight 32-bit words; arrays of states, digests and blocks have one column per message.  Digests enter a
message as hex text, which is 64 bytes, just one block: a state between two digests is then the whole hash state, 32 bytes.
"""

from __future__ import annotations

from math import isqrt

import numpy as np

_U = np.uint32
#: Messages worked on at a time, so that the words in use stay in a processor's cache.
LANES = 8192


def _primes(n: int) -> list[int]:
    found: list[int] = []
    x = 2
    while len(found) < n:
        if all(x % p for p in found):
            found.append(x)
        x += 1
    return found


def _cube_root(x: int) -> int:
    low, high = 0, 1 << (x.bit_length() // 3 + 1)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid**3 <= x else (low, mid - 1)
    return low


#: The standard's constants: fractions of the roots of the first primes.
_ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], _U)
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], _U).reshape(8, 1)


def _hex_pairs() -> np.ndarray:
    """The four hex characters of each 16-bit number, as one big-endian word."""
    digits = np.frombuffer(b"0123456789abcdef", np.uint8).astype(_U)
    x = np.arange(1 << 16)
    return digits[x >> 12] << _U(24) | digits[x >> 8 & 15] << _U(16) | digits[x >> 4 & 15] << _U(8) | digits[x & 15]


_HEX = _hex_pairs()


def starts(n: int) -> np.ndarray:
    return np.repeat(START, n, axis=1)


#: Shifts as array scalars: made once, not in each of the thousands of steps.
_BY = [_U(k) for k in range(33)]


def _turned(x: np.ndarray, p: int, q: int, r: int, shift: bool = False) -> np.ndarray:
    """Exclusive or of ``x`` turned right by p, q and r bits; the last is a plain shift if asked for."""
    y = (x >> _BY[p] | x << _BY[32 - p]) ^ (x >> _BY[q] | x << _BY[32 - q])
    return y ^ (x >> _BY[r] if shift else x >> _BY[r] | x << _BY[32 - r])


def _compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    w = list(block)
    a, b, c, d, e, f, g, h = state
    for k in range(64):
        if k >= 16:
            w.append(w[k - 16] + w[k - 7] + _turned(w[k - 15], 7, 18, 3, True) + _turned(w[k - 2], 17, 19, 10, True))
        t = h + _turned(e, 6, 11, 25) + (g ^ e & (f ^ g)) + w[k] + _ROUND[k]
        u = _turned(a, 2, 13, 22) + (a & b | c & (a | b))
        a, b, c, d, e, f, g, h = t + u, a, b, c, d + t, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The states after one more block of each message."""
    n = state.shape[1]
    if n <= LANES:
        return _compress(state, block) if n else state.copy()
    return np.concatenate([_compress(state[:, i : i + LANES], block[:, i : i + LANES]) for i in range(0, n, LANES)], axis=1)


def absorb(state: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """The states after one more digest, as hex text, of each message."""
    block = np.empty((16, digests.shape[1]), _U)
    block[0::2], block[1::2] = _HEX[digests >> _U(16)], _HEX[digests & _U(0xFFFF)]
    return compress(state, block)


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests of messages that had so many blocks each."""
    blocks = np.broadcast_to(np.asarray(blocks, np.uint64), (state.shape[1],))
    last = np.zeros((16, state.shape[1]), _U)
    last[0] = 0x80000000
    last[14], last[15] = (blocks >> np.uint64(23)).astype(_U), (blocks << np.uint64(9) & np.uint64(0xFFFFFFFF)).astype(_U)
    return compress(state, last)


def packed(words: np.ndarray) -> bytes:
    """32 bytes for each column."""
    return np.ascontiguousarray(words.T).astype(">u4").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, ">u4").astype(_U).reshape(-1, 8).T
