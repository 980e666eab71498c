"""Array kernels over whole batches of texts: word boundaries, word hashes, shingle hashes.

A batch is one Arrow string column, taken as its UTF-8 buffer.  Words are runs of bytes
other than 0x20 and 0x09-0x0D.  Every function treats a null text as an empty one.
Buffers are worked through in pieces of bounded size, so that one very long text costs
memory in proportion to its words, not to 8 bytes times every temporary array.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

PIECE = 4 << 20
U64 = np.uint64


def give_back() -> None:
    """Returns freed memory of this process to the system: a worker that waits for its next task holds little."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable) -> Callable:
    """A function over batches that gives memory back when its task ends."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


#: Bytes of a group's table from which its worker gives memory back after it.
GIVE_BACK = 1 << 20


def lean_group(run: Callable) -> Callable:
    """The same for a function of a group's table."""

    def wrapped(table: pa.Table) -> pa.Table:
        out = run(table)
        if table.nbytes >= GIVE_BACK:
            give_back()
        return out

    return wrapped


def lean_key_group(run: Callable) -> Callable:
    """The same for a function of a group's key and table."""

    def wrapped(key: tuple, table: pa.Table) -> pa.Table:
        out = run(key, table)
        if table.nbytes >= GIVE_BACK:
            give_back()
        return out

    return wrapped


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), elementwise."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _stream(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


_POSITIONS = 1 << 12
_POSITION_KEY = _stream(_POSITIONS, 11) | U64(1)


def place_key(place: np.ndarray) -> np.ndarray:
    """An odd 64-bit key for each place in a word: from a table, beyond it computed from the place itself."""
    out = _POSITION_KEY[place & (_POSITIONS - 1)]
    far = np.flatnonzero(place >= _POSITIONS)
    if len(far):
        out[far] = mix64(place[far].astype(U64) * U64(0xD1342543DE82EF95)) | U64(1)
    return out


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_KEY = _stream(256, 7)
_BYTE_KEY[_SPACE] = 0
_BYTE_KEY_LOWER = _BYTE_KEY.copy()
_BYTE_KEY_LOWER[ord("A") : ord("Z") + 1] = _BYTE_KEY[ord("a") : ord("z") + 1]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; offsets has one entry more than there are rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _pieces(raw: np.ndarray, offsets: np.ndarray):
    """Cut points so that no word spans two pieces."""
    at, n = 0, len(raw)
    while at < n:
        end = min(n, at + PIECE)
        if end < n:
            k = int(np.searchsorted(offsets, end, "right")) - 1
            if offsets[k] > at:
                end = int(offsets[k])
            else:
                gaps = np.flatnonzero(_SPACE[raw[at:end]])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                else:
                    stop = int(offsets[k + 1])
                    gaps = np.flatnonzero(_SPACE[raw[end:stop]])
                    end = end + int(gaps[0]) + 1 if len(gaps) else stop
        yield at, end
        at = end


def words(raw: np.ndarray, offsets: np.ndarray, lower: bool = True, spans: bool = False):
    """Hashes of all words in order, and for each text the index of its first word.

    With ``spans`` also the byte offsets at which each word starts and ends.
    """
    table = _BYTE_KEY_LOWER if lower else _BYTE_KEY
    hashes, begins, ends = [], [], []
    for a, b in _pieces(raw, offsets):
        part = raw[a:b]
        inside = ~_SPACE[part]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        cuts = offsets[np.searchsorted(offsets, a, "left") : np.searchsorted(offsets, b, "left")] - a
        first[cuts[cuts < b - a]] = True
        first &= inside
        start = np.flatnonzero(first)
        if len(start):
            place = np.arange(b - a, dtype=np.int32)
            place -= np.repeat(start, np.diff(np.append(start, b - a))).astype(np.int32) if start[0] == 0 else np.concatenate(
                [np.zeros(start[0], np.int32), np.repeat(start, np.diff(np.append(start, b - a))).astype(np.int32)]
            )
            value = table[part]
            value *= place_key(place)
            total = np.add.reduceat(value, start)
            hashes.append(mix64(total))
            begins.append(start + a)
            if spans:
                gap = np.add.reduceat(inside, start, dtype=np.int64)
                ends.append(start + a + gap)
    begin = np.concatenate(begins) if begins else np.zeros(0, np.int64)
    out = np.concatenate(hashes) if hashes else np.zeros(0, U64)
    index = np.searchsorted(begin, offsets, "left")
    if spans:
        return out, index, begin, (np.concatenate(ends) if ends else np.zeros(0, np.int64))
    return out, index


_PLACE = _stream(64, 23) | U64(1)


def shingles(hashes: np.ndarray, index: np.ndarray, width: int = 5):
    """Hashes of all runs of ``width`` words, and for each text the index of its first one.

    A text of one to ``width`` - 1 words has one shingle, its whole sequence.
    """
    count = np.diff(index)
    many = np.where(count >= width, count - width + 1, (count > 0).astype(count.dtype))
    at = np.concatenate([[0], np.cumsum(many)])
    n = len(hashes)
    padded = np.concatenate([hashes, np.zeros(width, U64)])
    total = np.zeros(n, U64)
    for k in range(width):
        total += padded[k : k + n] * _PLACE[k]
    take = np.arange(int(at[-1]), dtype=np.int64)
    take += np.repeat(index[:-1] - at[:-1], many)
    out = total[take]
    for d in np.flatnonzero((count > 0) & (count < width)):
        own = hashes[index[d] : index[d + 1]]
        out[at[d]] = (own * _PLACE[: len(own)]).sum(dtype=U64) + U64(len(own))
    return mix64(out), at
