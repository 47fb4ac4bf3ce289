"""Vectorised text primitives shared by the Python-side operators.

Everything works on the UTF-8 buffers of an Arrow batch, a bounded slice of rows at a time, so
no Python object is made per word.  A word is a run of bytes outside ``\\x20 \\x09-\\x0D``; the
letters A-Z are lower-cased.  Words are named by 64-bit hashes: the mixed sum of a table's terms for each byte at
its place, so two different words share a name with a chance of 2**-64, whatever their form.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text handled at once; temporary arrays take about forty times as much.
SLICE_BYTES = 1 << 20
#: Places of a word, or span, that have their own row in a table of terms.
_PLACES = 64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _table(key: int, byte: np.ndarray) -> np.ndarray:
    """A term for every place and byte: unrelated numbers, so sums of them have no structure to collide by."""
    place = np.arange(_PLACES).astype(U64)[:, None] << U64(8)
    return mix(mix((place | byte.astype(U64)) + U64(key)) + U64(0x9E3779B97F4A7C15))


#: Terms of words (letters A-Z lower-cased, no term for white space) under two independent keys, and of exact spans.
_WORDS = [np.where(_SPACE, U64(0), _table(key, LOWER)).ravel() for key in (0xD6E8FEB86659FD93, 0x5851F42D4C957F2D)]
_EXACT = _table(0xA0761D6478BD642F, np.arange(256)).ravel()


def _hashes(table: np.ndarray, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of the contiguous spans of ``data`` that begin at ``starts`` (the first at 0)."""
    place = np.arange(len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))
    term = table[(place & (_PLACES - 1)) << 8 | data]
    far = np.flatnonzero(place >= _PLACES)
    if len(far):
        # what has no term stays without one
        moved = mix(term[far] ^ ((place[far] // _PLACES).astype(U64) * U64(0xE7037ED1A0B428DB)))
        term[far] = np.where(term[far] == 0, U64(0), moved)
    return mix(np.add.reduceat(term, starts))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def row_slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or of one row."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def _hash_words(data: np.ndarray, starts: np.ndarray, lane: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start positions of the words of a slice; ``starts`` also break words."""
    n = len(data)
    if not n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    space = _SPACE[data]
    before = np.empty(n, bool)
    before[0], before[1:] = True, space[:-1]
    before[starts[starts < n]] = True
    first = np.flatnonzero(~space & before)
    if not len(first):
        return np.zeros(0, U64), first
    # white space behind a word has no term
    return _hashes(_WORDS[lane], data[first[0] :], first - first[0]), first


def span_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of the contiguous spans that begin at ``starts`` and cover the rest of the buffer, letter case kept."""
    out = np.empty(len(starts), U64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + SLICE_BYTES, "right")) - 1)
        end = int(starts[b]) if b < len(starts) else len(data)
        out[a:b] = _hashes(_EXACT, data[starts[a] : end], starts[a:b] - starts[a])
        a = b
    return out


def words_of(column: pa.Array, lane: int = 0) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of rows with all their words: first row, end row, word hashes, words per row.

    A text longer than a slice is hashed in parts cut at white space.  ``lane`` 1 gives hashes under another key.
    """
    data, offsets = utf8(column)
    for a, b in row_slices(offsets):
        part = data[offsets[a] : offsets[b]]
        if b - a > 1 or len(part) <= SLICE_BYTES:
            starts = offsets[a:b] - offsets[a]
            found, at = _hash_words(part, starts, lane)
            ends = np.searchsorted(at, offsets[a + 1 : b + 1] - offsets[a])
            # a row's words start before its end, so counts are differences
            yield a, b, found, np.diff(ends, prepend=0)
        else:
            pieces, x = [], 0
            while x < len(part):
                y = x + SLICE_BYTES
                if y < len(part):
                    gaps = np.flatnonzero(_SPACE[part[x:y]])
                    if len(gaps):
                        y = x + int(gaps[-1]) + 1
                    else:
                        while y < len(part) and not _SPACE[part[y]]:
                            y += 1
                pieces.append(_hash_words(part[x:y], np.zeros(1, np.int64), lane)[0])
                x = y
            found = np.concatenate(pieces)
            yield a, b, found, np.array([len(found)])


_LANES = [U64(x) for x in (0x8CB92BA72F3D8DD7, 0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _shingles(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All shingle hashes in order, and the row of each."""
    ends = np.cumsum(counts)
    begins = ends - counts
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begins, n)
    value = np.full(len(at), 0x51ED270B, U64)
    padded = np.concatenate([words, np.zeros(width, U64)])
    short = counts[row] < width
    for k in range(width):
        lane = _LANES[k % len(_LANES)] + U64(2 * (k // len(_LANES)))
        term = padded[at + k] * lane
        if short.any():
            term[short & (k >= counts[row])] = 0
        value = mix(value) + term if k else value + term
    return mix(value), row


def shingles(words: np.ndarray, counts: np.ndarray, width: int, other: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Distinct shingle hashes by row, sorted within each row, and how many each row has.

    A row with fewer words than ``width`` has its whole sequence as one shingle; without words, none.  With the
    words' hashes under another key, also those of the same shingles in the same order: 128 bits in all.
    """
    value, row = _shingles(words, counts, width)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    n = np.bincount(row[keep], minlength=len(counts))
    if other is None:
        return value[keep], n
    return value[keep], n, _shingles(other, counts, width)[0][order[keep]]
