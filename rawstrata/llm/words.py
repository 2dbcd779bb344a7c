"""Words and word shingles of whole texts as 64-bit hashes, a batch at a time.

Words are runs of characters other than the blank and 0x09-0x0D. All of these are single
bytes in UTF-8, so the work is done on bytes: numpy passes over a slice of a batch, no
Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20  # of text handled at once; one longer text is a slice of its own
HASH_BLOCK = 1 << 20  # bytes hashed at once

BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


class Words(NamedTuple):
    """Words of consecutive texts: of text i, from ``first[i]`` to ``first[i + 1]``."""

    data: np.ndarray  # bytes of the texts
    offsets: np.ndarray  # of the texts in the bytes
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    def of(base: int) -> np.ndarray:
        factors = np.full(length, base, dtype=np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    return of(_BASE), of(pow(_BASE, -1, 1 << 64))


def slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive rows of about ``SLICE_BYTES``, with the number of the first."""
    if not len(texts):
        return
    sizes = np.cumsum(
        np.asarray(pc.binary_length(texts).fill_null(0), dtype=np.int64)
    )
    start = 0
    while start < len(texts):
        done = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, done + SLICE_BYTES, "right")))
        yield start, texts.slice(start, stop - start)
        start = stop


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and the offsets between them; a null text has no bytes."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[
        texts.offset : texts.offset + len(texts) + 1
    ]
    size = int(offsets[-1] - offsets[0])
    if not size:
        return np.empty(0, dtype=np.uint8), offsets - offsets[0]
    return (
        np.frombuffer(data, dtype=np.uint8, count=size, offset=int(offsets[0])),
        offsets - offsets[0],
    )


def split_words(
    texts: pa.Array, *, lower: bool = False, blank: np.ndarray = BLANK, as_bytes: np.ndarray = LOWER
) -> Words:
    """Runs of bytes that are not blank; ``lower`` maps the bytes by a table first."""
    data, offsets = raw_bytes(texts)
    if lower:
        data = as_bytes[data]
    inside = ~blank[data]
    edge = np.zeros(len(data) + 1, dtype=bool)  # a text begins here
    edge[offsets] = True
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets, "left"))


def hash_words(words: Words, limits: tuple[int, ...] = ()) -> np.ndarray | list[np.ndarray]:
    """A 64-bit hash of every word: a polynomial in its bytes, then mixed with its length.

    With ``limits`` a list of hashes, of the words' first so many bytes each.
    """
    out = [np.empty(len(words.starts), dtype=np.uint64) for _ in limits or (0,)]
    at = 0
    while at < len(words.starts):
        origin = int(words.starts[at])
        stop = max(at + 1, int(np.searchsorted(words.ends, origin + HASH_BLOCK, "right")))
        starts, whole = words.starts[at:stop] - origin, words.ends[at:stop] - origin
        length = int(whole[-1])
        up, down = _powers(max(HASH_BLOCK, length))
        sums = np.zeros(length + 1, dtype=np.uint64)
        np.cumsum(
            (words.data[origin : origin + length].astype(np.uint64) + np.uint64(1))
            * up[:length],
            out=sums[1:],
        )
        for held, limit in zip(out, limits or (None,), strict=True):
            ends = whole if limit is None else np.minimum(whole, starts + limit)
            held[at:stop] = mix(
                (sums[ends] - sums[starts]) * down[starts]
                + (ends - starts).astype(np.uint64)
            )
        at = stop
    return out if limits else out[0]


def hash_shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` consecutive values, at each place where as many follow."""
    count = max(0, len(hashes) - size + 1)
    out = np.zeros(count, dtype=np.uint64)
    for j in range(size):
        out = mix(out + hashes[j : j + count] + np.uint64(_BASE))
    return out


def shingle_sets(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """For every text its number and the sorted distinct shingle hashes of its words.

    A text with fewer words than ``size`` has its whole sequence as one shingle, one
    without words has none.
    """
    for start, part in slices(texts):
        words = split_words(part, lower=True)
        hashes = hash_words(words)
        full = hash_shingles(hashes, size)
        for i in range(len(part)):
            first, last = int(words.first[i]), int(words.first[i + 1])
            count = last - first
            if count >= size:
                yield start + i, np.unique(full[first : last - size + 1])
            elif count:
                yield start + i, hash_shingles(hashes[first:last], count)
            else:
                yield start + i, np.empty(0, dtype=np.uint64)
