"""Vectorised word splitting and hashing over Arrow string arrays.

Used inside Arrow UDFs only: a batch is cut into slices of bounded bytes, a
slice is tokenised as one byte array, and every word gets a 64-bit hash. No
text is cut: a document longer than a slice forms a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
BLOCK_BYTES = 1 << 17
_U = np.uint64
_ROOT = 0x9E3779B97F4A7C15 | 1
_ROOT_INV = pow(_ROOT, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xA24BAED4963EE407)):
        x ^= x >> _U(shift)
        x *= _U(factor)
    x ^= x >> _U(32)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xC2B2AE3D27D4EB4F))
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse (mod 2**64), up to n."""
    if len(_powers.get("up", ())) < n + 1:
        size = max(n + 1, SLICE_BYTES + 1)
        for key, base in (("up", _ROOT), ("down", _ROOT_INV)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[key] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def byte_class(keep) -> np.ndarray:
    """Lookup table of the bytes that belong to words."""
    return np.array([bool(keep(b)) for b in range(256)])


# words are runs of anything but ASCII whitespace
NON_SPACE = byte_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
# words are runs of ASCII letters and digits, or of any non-ASCII character
ALNUM = byte_class(lambda b: b >= 0x80 or chr(b).isalnum())
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


@dataclass
class Words:
    """The words of consecutive documents: ``offsets[i]:offsets[i + 1]`` are those of document i."""

    hashes: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray


def slices(arr: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows; null texts are empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if pa.types.is_null(arr.type):
        arr = pa.array([""] * len(arr), type=pa.large_string())
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    arr = arr.cast(pa.large_string())
    if not len(arr):
        return
    _, off, buf = arr.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(arr):
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), len(arr))
        yield i, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def fold(data: np.ndarray) -> np.ndarray:
    """Lower case for A-Z and for the capitals of Latin-1 (two bytes, the first 0xC3)."""
    out = LOWER[data]
    if len(data):
        lead = np.flatnonzero(data[:-1] == 0xC3) + 1
        follow = data[lead]
        out[lead[(follow >= 0x80) & (follow <= 0x9E) & (follow != 0x97)]] += 32
    return out


def words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> Words:
    """Words of an already folded slice, as runs of ``member`` bytes."""
    n = len(data)
    if n > BLOCK_BYTES and len(offsets) > 2:
        return _by_block(data, offsets, member)
    inside = member[data]
    first = inside.copy()
    last = inside.copy()
    if n:
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cut = offsets[(offsets > 0) & (offsets < n)]
        first[cut] = inside[cut]
        last[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return Words(span_hash(data, starts, ends), np.searchsorted(starts, offsets), starts, ends, data)


def _by_block(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> Words:
    """``words`` of blocks of whole documents, whose arrays stay in the processor's cache."""
    parts, word, i = [], 0, 0
    while i < len(offsets) - 1:
        j = int(np.searchsorted(offsets, offsets[i] + BLOCK_BYTES, side="right")) - 1
        j = min(max(j, i + 1), len(offsets) - 1)
        w = words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], member)
        parts.append((w.hashes, w.offsets[bool(i):] + word, w.starts + offsets[i], w.ends + offsets[i]))
        word, i = word + len(w.hashes), j
    return Words(*(np.concatenate(x) for x in zip(*parts)), data)


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, from one running polynomial sum."""
    up, down = _power(len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
