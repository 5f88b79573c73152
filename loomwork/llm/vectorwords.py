"""Words, lines and shingles of whole text batches as NumPy arrays.

Arrow hands a task the bytes of many texts in one buffer.  The helpers here find
words and lines in that buffer with array operations and give every word a
64-bit hash, so no Python object is made per word.  Batches are cut into slices
of a few megabytes first; only a single longer text makes a longer slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4_000_000
_WINDOW = 1 << 19
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))

# The white space of the word pattern [^\x20\x09-\x0D]+.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


class Words(NamedTuple):
    """Word places in a buffer; ``first[d]`` is the first word of text d, ``first[-1]`` the number of words."""
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    column = pc.fill_null(column, "") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    places = places[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or len(places) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[places[0]:places[-1]]
    return raw, places - places[0]


def slices(batches, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``limit`` text bytes each."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = column_bytes(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def find_words(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = IS_SPACE) -> Words:
    """Places of the runs of bytes that ``gap`` does not mark; no run crosses from text to text."""
    inside = ~gap[data]
    borders = offsets[(offsets > 0) & (offsets < len(data))]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[borders] = inside[borders]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[borders - 1] = inside[borders - 1]
    start = np.flatnonzero(begins)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix finalizer)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the hash base and of its inverse, as many as were needed so far."""

    def __init__(self):
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            up, down = self.up[-1:] * _P, self.down[-1:] * _P_INV
            self.up = np.concatenate([self.up, self.up * up])
            self.down = np.concatenate([self.down, self.down * down])


_POWERS = _Powers()


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, letters: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each span of bytes; equal bytes give equal hashes wherever they stand.

    A polynomial hash: byte i of the buffer counts ``letters[byte] * P**i`` and the
    sum over a span is divided by ``P**start``.  Spans are in order and do not
    overlap.  ``letters`` maps bytes first (lower case, for example).
    """
    out = np.empty(len(start), dtype=np.uint64)
    codes = (np.arange(256) if letters is None else letters).astype(np.uint64) + np.uint64(1)
    at = 0
    while at < len(start):
        base = start[at]
        stop = max(at + 1, int(np.searchsorted(end, base + _WINDOW, side="right")))
        size = int(end[stop - 1] - base)
        _POWERS.reach(size)
        places = np.empty(2 * (stop - at), dtype=np.int64)
        places[0::2] = start[at:stop] - base
        places[1::2] = end[at:stop] - base
        terms = np.zeros(size + 1, dtype=np.uint64)
        terms[:size] = codes[data[base:base + size]] * _POWERS.up[:size]
        sums = np.add.reduceat(terms, places)[0::2]
        empty = places[0::2] == places[1::2]
        sums[empty] = 0
        lengths = (end[at:stop] - start[at:stop]).astype(np.uint64)
        out[at:stop] = sums * _POWERS.down[places[0::2]] + lengths * np.uint64(0xD6E8FEB86659FD93)
        at = stop
    return mix(out)


def shingles(words: np.ndarray, first: np.ndarray, size: int) -> list[np.ndarray]:
    """Per text: the sorted distinct hashes of its ``size``-word shingles.

    A text of fewer words has one shingle, its whole sequence; without words none.
    """
    factors = mix(np.arange(1, size + 1, dtype=np.uint64) * _P) | np.uint64(1)
    n = len(words)
    wide = max(0, n - size + 1)
    windows = np.zeros(wide, dtype=np.uint64)
    for k in range(size):
        windows += words[k:k + wide] * factors[k]
    windows = mix(windows)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(windows[a:b - size + 1]))
        elif b > a:
            whole = (words[a:b] * factors[:b - a]).sum(keepdims=True)
            out.append(mix(whole + np.array([b - a], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """The shingle sets of a string column, words lower-cased in A-Z and split at white space."""
    data, offsets = column_bytes(column)
    words = find_words(data, offsets)
    return shingles(hash_spans(data, words.start, words.end, LOWER), words.first, size)


def as_long(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers as Spark's signed ones."""
    return values.view(np.int64)


def set_keys(sets: list[np.ndarray]) -> np.ndarray:
    """128 bits that identify each set of hashes, as two columns of long: sums of differently mixed members."""
    out = np.zeros((len(sets), 2), dtype=np.uint64)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    held = np.flatnonzero(sizes)
    if len(held):
        members = np.concatenate(sets)
        starts = np.concatenate([[0], np.cumsum(sizes[held])[:-1]])
        out[held, 0] = np.add.reduceat(mix(members), starts)
        out[held, 1] = np.add.reduceat(mix(members ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts)
    return as_long(out)
