"""Words of many texts at once, as numpy arrays: where they are and a 64-bit hash of each.

Texts are joined into one buffer of bytes with a line feed between them; all further work is done on
whole arrays, so the cost per word is some tens of nanoseconds whatever the texts look like.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _table(inside) -> np.ndarray:
    return np.array([inside(b) for b in range(256)])


#: Bytes of words between white space: all but space and 09-0D.
BETWEEN_SPACE = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Bytes of words of letters and digits: a-z, 0-9 and everything outside ASCII.
LETTERS_DIGITS = _table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SEED = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)
_LONG_WORD = 64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x *= _M1
    x ^= x >> np.uint64(29)
    x *= _M2
    x ^= x >> np.uint64(32)
    return x


@dataclass
class Words:
    """``start`` and ``end`` of every word in ``buffer``; text i has words ``first[i]:first[i + 1]``."""

    buffer: bytes
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    text_start: np.ndarray

    def hashes(self) -> np.ndarray:
        """A hash of each word's bytes. Words of eight bytes or fewer never collide by their bytes."""
        n = self.end - self.start
        at = np.ndarray(len(self.buffer) - 7, "<u8", self.buffer, strides=(1,))
        out = mix(_SEED * n.astype(np.uint64) ^ (at[self.start] & _MASKS[np.minimum(n, 8)]))
        for k in range(8, _LONG_WORD, 8):
            more = np.flatnonzero(n > k)
            if not len(more):
                return out
            block = at[self.start[more] + k] & _MASKS[np.minimum(n[more] - k, 8)]
            out[more] = mix((out[more] ^ block) + _SEED)
        for i in np.flatnonzero(n > _LONG_WORD):
            digest = hashlib.blake2b(self.buffer[self.start[i] : self.end[i]], digest_size=8).digest()
            out[i] = int.from_bytes(digest, "little")
        return out

    def text_of(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def words(self, a: int, b: int) -> list[bytes]:
        return [self.buffer[s:e] for s, e in zip(self.start[a:b].tolist(), self.end[a:b].tolist())]


def find_words(texts: Sequence[bytes | None], inside: np.ndarray, lower: bool = True) -> Words:
    """Words are the longest runs of bytes with ``inside``; None has none."""
    parts = [t or b"" for t in texts]
    joined = b"\n".join(parts) + b"\n"
    text_start = np.cumsum([0] + [len(p) + 1 for p in parts])
    if lower:
        joined = joined.translate(_LOWER)
    flag = inside[np.frombuffer(joined, np.uint8)]
    edges = np.flatnonzero(flag[1:] != flag[:-1]) + 1
    if flag[0]:
        edges = np.concatenate(([0], edges))
    start, end = edges[0::2], edges[1::2]
    return Words(joined + b"\0" * 8, start, end, np.searchsorted(start, text_start), text_start)


_libc = ctypes.CDLL(None)


def give_back() -> None:
    """Return freed memory to the system: Python workers live on from stage to stage, and all count for their executor."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):  # glibc only
        _libc.malloc_trim(0)


def chunks(texts: Sequence[bytes | str | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together, so that the arrays stay small; a longer text is alone."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
    give_back()


@cache
def run_factors(n: int) -> tuple[np.uint64, ...]:
    """What each of ``n`` consecutive values is multiplied by in the hash of their run."""
    out, factor = [], 1
    for _ in range(n):
        factor = factor * 0x5851F42D4C957F2D + 0x14057B7EF767814F & 0xFFFFFFFFFFFFFFFF | 1
        out.append(np.uint64(factor))
    return tuple(out)


def runs_hash(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive values; fewer values than ``n`` give none."""
    count = len(values) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for j, factor in enumerate(run_factors(n)):
        out += values[j : j + count] * factor
    return mix(out)
