"""The 64-bit FarmHash fingerprint of strings, a batch at a time.

Spark has no wrapping 64-bit product outside its own hashes, so this is an Arrow UDF: the strings of a batch stay in their
Arrow buffer, words are gathered from it by position, and every length class (and every 64-byte step of the long strings) is
one pass of array arithmetic. The result is the signed 64-bit number that public warehouses call FARM_FINGERPRINT.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the published constants of the algorithm ---
K0, K1, K2 = (np.uint64(k) for k in (0xC3A5C85C97CB3127, 0xB492B66FBE98F273, 0x9AE16A3B2F90404F))
SEED = 81
# ---------------------------------------------------------------


def _u(x) -> np.ndarray:
    return np.asarray(x).astype(np.uint64)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint64(by)) | (x << np.uint64(64 - by))


def _fold(x: np.ndarray) -> np.ndarray:
    return x ^ (x >> np.uint64(47))


def _pair(u: np.ndarray, v: np.ndarray, mul: np.ndarray) -> np.ndarray:
    a = _fold((u ^ v) * mul)
    return _fold((v ^ a) * mul) * mul


class _Bytes:
    """Little-endian words of a byte buffer at given positions."""

    def __init__(self, buffer: np.ndarray):
        self.buffer = np.concatenate([buffer, np.zeros(8, np.uint8)])

    def word(self, at: np.ndarray, size: int = 8) -> np.ndarray:
        return _u(np.ascontiguousarray(self.buffer[at[:, None] + np.arange(size)]).view(f"<u{size}").ravel())

    def byte(self, at: np.ndarray) -> np.ndarray:
        return _u(self.buffer[at])


def _upto3(b: _Bytes, s: np.ndarray, n: np.ndarray) -> np.ndarray:
    y = b.byte(s) + (b.byte(s + n // 2) << np.uint64(8))
    z = _u(n) + (b.byte(s + n - 1) << np.uint64(2))
    return _fold(y * K2 ^ z * K0) * K2


def _upto7(b: _Bytes, s: np.ndarray, n: np.ndarray) -> np.ndarray:
    return _pair(_u(n) + (b.word(s, 4) << np.uint64(3)), b.word(s + n - 4, 4), K2 + _u(2 * n))


def _upto16(b: _Bytes, s: np.ndarray, n: np.ndarray) -> np.ndarray:
    mul, first, last = K2 + _u(2 * n), b.word(s) + K2, b.word(s + n - 8)
    return _pair(_turn(last, 37) * mul + first, (_turn(first, 25) + last) * mul, mul)


def _ends(b: _Bytes, s: np.ndarray, n: np.ndarray, scale: np.uint64):
    """What strings of 17 to 64 bytes have in common: the two mixtures of their first and last 16 bytes."""
    mul = K2 + _u(2 * n)
    first, second, last, before = b.word(s) * scale, b.word(s + 8), b.word(s + n - 8) * mul, b.word(s + n - 16) * K2
    return mul, first, _turn(first + second, 43) + _turn(last, 30) + before, first + _turn(second + K2, 18) + last


def _upto32(b: _Bytes, s: np.ndarray, n: np.ndarray) -> np.ndarray:
    mul, _, u, v = _ends(b, s, n, K1)
    return _pair(u, v, mul)


def _upto64(b: _Bytes, s: np.ndarray, n: np.ndarray) -> np.ndarray:
    mul, first, u, v = _ends(b, s, n, K2)
    both = _pair(u, v, mul)
    third, fourth = b.word(s + 16) * mul, b.word(s + 24)
    g, h = (u + b.word(s + n - 32)) * mul, (both + b.word(s + n - 24)) * mul
    return _pair(_turn(third + fourth, 43) + _turn(g, 30) + h, third + _turn(fourth + first, 18) + g, mul)


def _weak(b: _Bytes, s: np.ndarray, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w0, w1, w2, w3 = (b.word(s + i) for i in (0, 8, 16, 24))
    p = p + w0
    q = _turn(q + p + w3, 21)
    total = p + w1 + w2
    return total + w3, q + _turn(total, 44) + p


def _step(b: _Bytes, s: np.ndarray, state: list[np.ndarray], mul, times: np.uint64) -> list[np.ndarray]:
    """One 64-byte block; the last one runs with other factors."""
    x, y, z, v0, v1, w0, w1 = state
    x = _turn(x + y + v0 + b.word(s + 8), 37) * mul ^ w1 * times
    y = _turn(y + v1 + b.word(s + 48), 42) * mul + v0 * times + b.word(s + 40)
    z = _turn(z + w0, 33) * mul
    v = _weak(b, s, v1 * mul, x + w0)
    w = _weak(b, s + 32, z + w1, y + b.word(s + 16))
    return [z, y, x, *v, *w]


def _long(b: _Bytes, s: np.ndarray, n: np.ndarray) -> np.ndarray:
    zero, seed = np.zeros(len(s), np.uint64), np.full(len(s), SEED, np.uint64)
    y = seed * K1 + np.uint64(113)
    state = [seed * K2 + b.word(s), y, _fold(y * K2 + np.uint64(113)) * K2, zero, zero, zero, zero]
    blocks, order = (n - 1) // 64, np.argsort(-n, kind="stable")  # longest first: a block's step runs on a leading stretch
    state, s, n, blocks = [a[order] for a in state], s[order], n[order], blocks[order]
    for i in range(int(blocks[0])):
        live = int(np.searchsorted(-blocks, -i, side="left"))
        moved = _step(b, s[:live] + 64 * i, [a[:live] for a in state], K1, np.uint64(1))
        for a, new in zip(state, moved):
            a[:live] = new
    x, y, z, v0, v1, w0, w1 = state
    mul = K1 + ((z & np.uint64(0xFF)) << np.uint64(1))
    w0 = w0 + _u((n - 1) % 64)
    v0 = v0 + w0
    w0 = w0 + v0
    x, y, z, v0, v1, w0, w1 = _step(b, s + n - 64, [x, y, z, v0, v1, w0, w1], mul, np.uint64(9))
    out = np.empty(len(s), np.uint64)
    out[order] = _pair(_pair(v0, w0, mul) + _fold(y) * K0 + z, _pair(v1, w1, mul) + x, mul)
    return out


CLASSES = [(1, 3, _upto3), (4, 7, _upto7), (8, 16, _upto16), (17, 32, _upto32), (33, 64, _upto64), (65, 1 << 62, _long)]


def farm_fingerprints(buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Signed fingerprints of the strings that lie at ``starts`` in a byte buffer."""
    out, words = np.full(len(sizes), K2, np.uint64), _Bytes(buffer)
    for least, most, of in CLASSES:
        at = np.flatnonzero((sizes >= least) & (sizes <= most))
        if len(at):
            out[at] = of(words, starts[at].astype(np.int64), sizes[at].astype(np.int64))
    return out.view(np.int64)


def farm_fingerprint(col: Column | str) -> Column:
    """Signed 64-bit fingerprint of a string's UTF-8 bytes; NULL stays NULL."""
    @F.arrow_udf("long")
    def fingerprints(texts: pa.Array) -> pa.Array:
        data = texts.cast(pa.large_binary())
        offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset:data.offset + len(data) + 1]
        values = data.buffers()[2]
        buffer = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
        found = farm_fingerprints(buffer, offsets[:-1], np.diff(offsets))
        return pa.array(found, mask=np.asarray(data.is_null().to_numpy(zero_copy_only=False)))

    return fingerprints(F.col(col) if isinstance(col, str) else col)
