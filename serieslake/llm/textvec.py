"""Words of many texts at once as numpy arrays, for the operators that hash words in tasks.

Texts are taken from Arrow buffers without copies and worked on in slices of a quarter megabyte, cut
at white space, so memory is bounded by the slice and the longest word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 18
#: Bytes of texts whose words are held together.
GROUP = 2 * SLICE
LANES = 64

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_RANDOM = np.random.default_rng(20240607)
#: One random number for each byte at each place of a word; A-Z hash as a-z.
_TABLE = _RANDOM.integers(0, 2**64, (LANES, 256), np.uint64)[:, _LOWER].ravel()
_ODD = _RANDOM.integers(0, 2**63, 16, np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[offsets[0] : offsets[-1]] if len(offsets) else body, offsets - offsets[:1]


def word_slices(column: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """Yields (bytes, starts, ends, document of each word) of one slice after another."""
    body, offsets = buffers(column)
    total, at = len(body), 0
    while at < total:
        end = min(at + SLICE, total)
        while end < total:  # on to the next white space or the end of the document
            stop = min(end + 4096, total)
            spaces = np.flatnonzero(_SPACE[body[end:stop]])
            border = np.searchsorted(offsets, end)
            nearest = min(
                end + spaces[0] if len(spaces) else total,
                offsets[border] if border < len(offsets) else total,
            )
            if nearest <= stop:
                end = nearest
                break
            end = stop
        part = body[at:end]
        inner = offsets[(offsets > at) & (offsets < end)] - at
        space = _SPACE[part]
        begins = ~space
        begins[1:] &= space[:-1]
        begins[inner] |= ~space[inner]
        finishes = ~space
        finishes[:-1] &= space[1:]
        finishes[inner - 1] |= ~space[inner - 1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
        owner = np.searchsorted(offsets, starts + at, side="right") - 1
        yield part, starts, ends, owner
        at = end


def hash_words(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit tabulation hashes of words, A-Z as a-z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    letters = part[np.repeat(starts, lengths) + place]
    values = _TABLE[(place & (LANES - 1)) * 256 + letters]
    if lengths.max() > LANES:
        values = values * (np.uint64(2) * (place // LANES).astype(np.uint64) + np.uint64(1))
    first = np.cumsum(lengths) - lengths
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64) * _ODD[15])


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a batch and where each document's words begin (one more than rows)."""
    hashes, counts = [], np.zeros(len(column), np.int64)
    for part, starts, ends, owner in word_slices(column):
        hashes.append(hash_words(part, starts, ends))
        counts += np.bincount(owner, minlength=len(column))
    begins = np.concatenate([[0], np.cumsum(counts)])
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), begins


def combine(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` neighbouring words, in order."""
    count = max(len(words) - width + 1, 0)
    total = np.zeros(count, np.uint64)
    for k in range(width):
        total += words[k : k + count] * _ODD[k]
    return mix(total + np.uint64(width))


def _row_groups(column: pa.Array) -> Iterator[pa.Array]:
    """Neighbouring rows of a few slices' bytes together; a longer text is a group of its own."""
    _, offsets = buffers(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + GROUP, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield column.slice(first, last - first)
        first = last


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each document the sorted hashes of its distinct runs of ``width`` words.

    With fewer words the whole sequence counts as one run; without words the set is empty. Memory
    is bounded by a few slices and the longest text.
    """
    for rows in _row_groups(column):
        words, begins = hashed_words(rows)
        runs = combine(words, width)
        for k in range(len(rows)):
            first, last = begins[k], begins[k + 1]
            if last - first >= width:
                yield np.unique(runs[first : last - width + 1])
            elif last > first:
                few = words[first:last]
                yield combine(few, len(few))
            else:
                yield np.zeros(0, np.uint64)
