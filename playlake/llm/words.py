"""Words of whole texts as flat numpy arrays, for the operators that run inside Arrow batches.

A batch of texts is treated as one UTF-8 buffer. A 256-entry table says which bytes
belong to words; every break character of the contracts is ASCII, so bytes are enough
and no text is decoded. A word never spans two texts. All arrays of one slice are
proportional to its bytes, and ``slices`` keeps a slice near ``SLICE_BYTES`` (one longer
text makes a slice of its own).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

#: Bytes that end a word: space and \\t \\n \\v \\f \\r.
WHITESPACE = bytes([0x20, *range(0x09, 0x0E)])
#: Bytes that belong to an alphanumeric word after lower-casing: digits, a-z, every non-ASCII byte.
ALNUM = bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
SLICE_BYTES = 2 << 20
SLICE_ROWS = 1000
_MUL = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INV = pow(_MUL, -1, 1 << 64)


@dataclass(frozen=True)
class Rule:
    """``byte[b]``: b, lower-cased if asked; ``inside[b]``: whether b belongs to words."""

    byte: np.ndarray
    inside: np.ndarray


def rule(word_bytes: bytes | None = None, lower: bool = False) -> Rule:
    """Words of ``word_bytes`` (given after lower-casing), or of all but white space."""
    byte = np.arange(256, dtype=np.uint8)
    inside = np.ones(256, bool)
    if word_bytes is None:
        inside[list(WHITESPACE)] = False
    else:
        inside[:] = False
        inside[list(word_bytes)] = True
    if lower:
        byte[0x41:0x5B] += 0x20
        inside[0x41:0x5B] = inside[0x61:0x7B]
    return Rule(byte, inside)


@dataclass
class Words:
    """Word i is ``raw[start[i]:end[i]]``; text t has the words ``first[t]`` to ``first[t + 1]``."""

    raw: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    rule: Rule

    def __len__(self) -> int:
        return len(self.start)

    def text_of(self) -> np.ndarray:
        """The text number of every word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def place(self) -> np.ndarray:
        """The place of every word in its text."""
        return np.arange(len(self.start)) - np.repeat(self.first[:-1], np.diff(self.first))

    def values(self) -> pa.Array:
        """The words themselves, as binary values."""
        ends = np.zeros(len(self.start) + 1, np.int64)
        np.cumsum(self.end - self.start, out=ends[1:])
        letters = self.rule.byte[self.raw[self.rule.inside[self.raw]]]
        return pa.Array.from_buffers(
            pa.large_binary(), len(self.start), [None, pa.py_buffer(ends), pa.py_buffer(letters)]
        )


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", scale: float = 1) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of ``scale`` times the usual text size and rows, whole rows each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        total, begin = 0, 0
        for i, size in enumerate(sizes):
            if i > begin and (total + size > scale * SLICE_BYTES or i - begin >= scale * SLICE_ROWS):
                yield batch.slice(begin, i - begin)
                total, begin = 0, i
            total += int(size)
        yield batch.slice(begin)


def released(parts: Iterator, every: int = 16) -> Iterator:
    """The parts; what was freed goes back to the system after every few and at the end.

    Spark keeps its Python workers for later tasks, and the allocators would keep freed memory for them.
    At the end the kept powers go too (32 MB, made again in some 40 ms).
    """
    for i, part in enumerate(parts, 1):
        yield part
        del part
        if i % every == 0:
            _give_back()
    _powers.cache_clear()
    _give_back()


@lru_cache(maxsize=1)
def _trim():
    return getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    if _trim():
        _trim()(0)


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null text has no bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def split(texts: pa.Array, by: Rule) -> Words:
    """Words of every text of the array."""
    raw, offsets = text_buffer(texts)
    n = len(raw)
    inside = by.inside[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins, stops = inside.copy(), inside.copy()
    if n:
        begins[1:] &= ~inside[:-1] | edge[1:n]
        stops[:-1] &= ~inside[1:] | edge[1:n]
    start = np.flatnonzero(begins)
    return Words(raw, offsets, start, np.flatnonzero(stops) + 1, np.searchsorted(start, offsets), by)


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, out=out)


def powers(n: int, base: int) -> np.ndarray:
    """base**0 to base**(n - 1) modulo 2**64; the usual lengths are kept."""
    return _powers(1 << 21, base)[:n] if n <= 1 << 21 else _powers.__wrapped__(n, base)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on every bit."""
    k = np.uint64(0xD6E8FEB86659FD93)
    s = np.uint64(32)
    x = (x ^ (x >> s)) * k
    x = (x ^ (x >> s)) * k
    return x ^ (x >> s)


@lru_cache(maxsize=8)
def _byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 64, 256, np.uint64, endpoint=False)


def hashes(words: Words, seed: int = 1) -> np.ndarray:
    """64-bit hash of every word: a polynomial of seeded random byte values, finalised."""
    x = _byte_values(seed)[words.rule.byte][words.raw]
    x *= powers(len(x), _MUL)
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x, out=total[1:])
    value = total[words.end] - total[words.start]
    back = powers(len(x) + 1, _INV)[words.start]
    return mix(value * back + (words.end - words.start).astype(np.uint64) * np.uint64(_INV))


def window_hashes(word_hash: np.ndarray, size: int) -> np.ndarray:
    """Hash of the words i to i + size for every i, without regard to text borders."""
    n = len(word_hash)
    if n < size:
        return np.empty(0, np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(word_hash * powers(n, _MUL), out=total[1:])
    return mix((total[size:] - total[:-size]) * powers(n - size + 1, _INV))


def window_starts(words: Words, size: int) -> np.ndarray:
    """Word numbers at which a window of ``size`` words of one text starts."""
    counts = np.diff(words.first)
    return np.flatnonzero(words.place() + size <= np.repeat(counts, counts))
