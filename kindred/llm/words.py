"""Vectorised tokenising of Arrow text columns.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``; ``A-Z`` count as
``a-z``. Words are found and hashed on the column's UTF-8 buffer with numpy, so
no Python object is made per word. A word is hashed eight bytes at a time, each
step a bijective mixing of what came before and the next bytes; a word of more
than ``LONG`` bytes by a polynomial over a random byte table modulo 2**64, taken
from sums over blocks. Two different words share a hash with a probability of
about 2**-64.

Null texts have no words. Texts of any length are taken whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BLOCK, _SPANS = 1 << 22, 1 << 14
#: Words of more bytes are hashed in another way, so that one of any length takes few steps.
LONG = 1024
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit integers (the splitmix64 finaliser)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _tables() -> tuple[np.ndarray, np.ndarray]:
    letter = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))
    up = np.full(_BLOCK, _BASE, dtype=np.uint64)
    up[0] = 1
    return letter, np.multiply.accumulate(up)


_CACHE: list = []


def tables():
    if not _CACHE:
        _CACHE.append(_tables())
    return _CACHE[0]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words, in order; a text's edge ends a word."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = (data - np.uint8(9)) <= 4  # wraps round below 9
    space |= data == 32
    inside = ~space
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= space[:-1]
    ends[:-1] &= space[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def _lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with ``A-Z`` as ``a-z``, and eight zeros after them."""
    out = np.zeros(len(data) + 8, dtype=np.uint8)
    np.less(data - np.uint8(65), 26, out=out[: len(data)].view(bool))
    out[: len(data)] <<= 5
    out[: len(data)] |= data
    return out


def _polynomial(data: np.ndarray) -> np.uint64:
    """The hash of one long span of lowered bytes, in blocks."""
    letter, up = tables()
    total = _U(0)
    for j in range(0, len(data), _BLOCK):
        part = letter[data[j : j + _BLOCK]]
        total += (part * up[: len(part)]).sum(dtype=np.uint64) * _U(pow(_BASE, j, 1 << 64))
    return total


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span, the same wherever the span lies."""
    out = np.empty(len(starts), dtype=np.uint64)
    low = _lowered(data)
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=low.data, strides=(1,))  # the eight bytes from every place on
    for at in range(0, len(starts), _SPANS):  # blocks that stay in the processor's cache
        begin = starts[at : at + _SPANS].astype(np.int64)
        size = ends[at : at + _SPANS] - begin
        own = out[at : at + _SPANS]
        np.multiply(size.astype(np.uint64), _U(0x9FB21C651E98DF25), out=own)
        own += _U(seed)
        own ^= eight[begin] & _MASKS[np.minimum(size, 8)]
        own[:] = mix(own)
        some, k = np.flatnonzero((size > 8) & (size <= LONG)), 8
        while len(some):
            own[some] = mix(own[some] * _U(_BASE) + (eight[begin[some] + k] & _MASKS[np.minimum(size[some] - k, 8)]))
            k += 8
            some = some[size[some] > k]
        for i in np.flatnonzero(size > LONG):
            own[i] = mix(own[i : i + 1] + _polynomial(low[begin[i] : begin[i] + size[i]]))[0]
    return out


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column, and the n + 1 bounds of the texts among them."""
    data, offsets = text_buffer(column)
    starts, ends = spans(data, offsets)
    return hashes(data, starts, ends), np.searchsorted(starts, offsets, side="left")
