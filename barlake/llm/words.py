"""Words and substrings of many texts at once, as numpy arrays over their UTF-8 bytes.

Hashes are polynomials modulo 2**64 over random byte values, taken from running
sums, so a hash of any substring costs the same, whatever its length. They are
scrambled at the end, because the low bits of such polynomials are weak. Long
sequences of two symbols exist (Thue-Morse words of 1024 and more) whose polynomials are equal
whatever the base, so words longer than ``SPAN`` bytes are hashed as trees, of ``SPAN`` parts at most at each node.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def _splitmix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> _U(30))
        x = x * _U(0xBF58476D1CE4E5B9)
        x ^= x >> _U(27)
        x *= _U(0x94D049BB133111EB)
        x ^= x >> _U(31)
    return x


scramble = _splitmix
_BYTE_VALUES = _splitmix((np.arange(256, dtype=_U) + _U(1)) * _U(0xD1342543DE82EF95))

BLANKS = np.zeros(256, bool)
BLANKS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` for i < n, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1024, 1 << (n - 1).bit_length())
        have = np.empty(size, _U)
        have[0] = 1
        done = 1
        with np.errstate(over="ignore"):
            while done < size:  # doubling
                step = _U(pow(base, done, 1 << 64))
                have[done : 2 * done] = have[: min(done, size - done)] * step
                done *= 2
        _powers[base] = have
    return have[:n]


class Rolling:
    """Hashes of ranges of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, base: int = _BASE):
        self._inverse = pow(base, -1, 1 << 64)
        n = len(values)
        self._sums = np.zeros(n + 1, _U)
        with np.errstate(over="ignore"):
            np.cumsum(values * powers(base, n), out=self._sums[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Unscrambled; equal ranges have equal values."""
        back = powers(self._inverse, len(self._sums))
        with np.errstate(over="ignore"):
            return (self._sums[end] - self._sums[start]) * back[start]

    def windows(self, length: int) -> np.ndarray:
        """Unscrambled hash of each range of this length."""
        n = len(self._sums) - length
        if n <= 0:
            return np.zeros(0, _U)
        back = powers(self._inverse, len(self._sums))
        with np.errstate(over="ignore"):
            return (self._sums[length:] - self._sums[:-length]) * back[:n]

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _splitmix(self.raw(start, end) + _splitmix((end - start).astype(_U)))


#: Bytes, or parts, that one polynomial of :func:`tree_hashes` takes.
SPAN = 64


def tree_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ranges; those longer than ``SPAN`` are cut into spans, whose hashes are hashed alike.

    Spans are counted from the range's start, so equal ranges have equal hashes wherever they are.
    """
    rolling = Rolling(values)
    out = rolling(start, end)
    long = np.flatnonzero(end - start > SPAN)
    if len(long):
        low, high = start[long], end[long]
        parts = -(-(high - low) // SPAN)
        upto = np.cumsum(parts)
        inside = np.arange(upto[-1]) - np.repeat(upto - parts, parts)
        at = np.repeat(low, parts) + inside * SPAN
        spans = rolling(at, np.minimum(at + SPAN, np.repeat(high, parts)))
        above = tree_hashes(spans, upto - parts, upto)
        with np.errstate(over="ignore"):
            # Another salt than short ranges have; the length tells depths apart.
            out[long] = _splitmix(above + _splitmix((high - low).astype(_U) + _U(1 << 63)))
    return out


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUES[data]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each row starts (and the last ends); null is empty."""
    column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if large else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


#: Bytes gone through at once. Arrays of 64-bit values over them stay in the processor's cache,
#: and a worker that waits for its next task holds little.
PIECE = (1 << 19) - 1


def pieces(column: pa.Array, limit: int = PIECE):
    """Row ranges ``(first, last + 1)`` of about ``limit`` bytes, one row at least."""
    _, at = utf8(column)
    first, n = 0, len(column)
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        last = min(last, n)
        yield first, last
        first = last


@dataclass
class Words:
    """``data`` are the bytes, ``at`` where rows start; words by byte range and row."""

    data: np.ndarray
    at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row_at: np.ndarray  # index of the first word of each row, and the number of words

    @property
    def per_row(self) -> np.ndarray:
        return np.diff(self.row_at)

    def hashes(self) -> np.ndarray:
        return tree_hashes(byte_values(self.data), self.start, self.end)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), self.per_row)

    def windows_fit(self, length: int) -> np.ndarray:
        """For each word: whether ``length`` words of its row start with it."""
        rows_end = np.repeat(self.row_at[1:], self.per_row)
        return np.arange(len(self.start)) + length <= rows_end


def split_words(data: np.ndarray, at: np.ndarray, is_gap: np.ndarray = BLANKS) -> Words:
    """Maximal runs of bytes that are no gaps; words end where their row ends."""
    inside = ~is_gap[data]
    n = len(data)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = at[:-1][at[:-1] < n]
    first[edges] = inside[edges]
    closing = at[1:][at[1:] > 0] - 1
    last[closing] = inside[closing]
    start = np.flatnonzero(first)
    return Words(data, at, start, np.flatnonzero(last) + 1, np.searchsorted(start, at))


def hashed(
    column: pa.Array, is_gap: np.ndarray = BLANKS, change: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a string column, and where each row's words start and the last end.

    ``change`` maps bytes before, such as ``LOWER``. Bytes are gone through
    ``PIECE`` (or one row) at a time.
    """
    hashes, counts = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
    for first, last in pieces(column):
        data, at = utf8(column.slice(first, last - first))
        words = split_words(data if change is None else change[data], at, is_gap)
        hashes.append(words.hashes())
        counts.append(words.per_row)
    row_at = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64)
    return np.concatenate(hashes), row_at


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each ``length`` consecutive items; items of different rows may mix."""
    return scramble(Rolling(hashes).windows(length))


def fits(row_at: np.ndarray, length: int) -> np.ndarray:
    """Places at which ``length`` consecutive items of one row start."""
    ends = np.repeat(row_at[1:], np.diff(row_at))
    return np.flatnonzero(np.arange(len(ends)) + length <= ends)


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a range of ``length`` that begins at one of ``starts``."""
    change = np.bincount(starts, minlength=n + 1)
    change -= np.bincount(starts + length, minlength=n + 1)
    return np.cumsum(change[:n]) > 0


def kept_texts(words: Words, keep: np.ndarray) -> list[bytes]:
    """For each row its kept words, joined by one space."""
    n_rows = len(words.at) - 1
    start, end = words.start[keep], words.end[keep]
    rows = np.searchsorted(words.at[1:], start, side="right")
    take = np.zeros(len(words.data) + 1, np.int8)
    np.add.at(take, start, 1)
    np.add.at(take, end, -1)
    taken = np.cumsum(take[:-1]).astype(bool)
    data = words.data.copy()
    more = rows[1:] == rows[:-1]  # followed by a kept word of the same row
    gaps = end[:-1][more]
    taken[gaps] = True
    data[gaps] = 0x20
    upto = np.concatenate([[0], np.cumsum(taken)])[words.at]
    out = data[taken].tobytes()
    return [out[upto[i] : upto[i + 1]] for i in range(n_rows)]


def spans(flags: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of each maximal run of set flags; runs end with their row.

    Starts and ends count from the row's first place.
    """
    n = len(flags)
    first, last = flags.copy(), flags.copy()
    first[1:] &= ~flags[:-1]
    last[:-1] &= ~flags[1:]
    edges = at[:-1][at[:-1] < n]
    first[edges] = flags[edges]
    closing = at[1:][at[1:] > 0] - 1
    last[closing] = flags[closing]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(at[1:], start, side="right")
    return row, start - at[row], end - at[row]


def span_lists(flags: np.ndarray, at: np.ndarray) -> pa.Array:
    """``array<struct<start, end>>`` of the runs of each row."""
    row, start, end = spans(flags, at)
    offsets = np.searchsorted(row, np.arange(len(at)))
    pairs = pa.StructArray.from_arrays(
        [pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=["start", "end"]
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)
