"""Columns of whole texts as byte buffers that numpy cuts and hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)

#: Space and 0x09 to 0x0D.
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODES = [mix((np.arange(256, dtype=np.uint64) + np.uint64(1 + 1000 * k)) * _STEP) for k in range(2)]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_of(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2^64, kept up to a few million."""
    kept = _powers.get(which)
    if kept is None or len(kept[0]) < size:
        base = _BASES[which]
        rows = []
        for value in (base, pow(base, -1, 2**64)):
            row = np.full(size, value, np.uint64)
            row[:1] = 1
            rows.append(np.cumprod(row))
        kept = (rows[0], rows[1])
        if size <= 1 << 22:
            _powers[which] = kept
    return kept


def prefix_sums(codes: np.ndarray, which: int = 0) -> np.ndarray:
    """Sums of codes[k] * base^k, one more than there are codes."""
    up, _ = _powers_of(which, len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[: len(codes)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each span that depends on its codes alone, not on where it stands."""
    _, down = _powers_of(which, len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _STEP)


def byte_codes(data: np.ndarray, which: int = 0) -> np.ndarray:
    return _BYTE_CODES[which][data]


def text_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    return span_hashes(prefix_sums(byte_codes(data, which), which), starts, ends, which)


def column_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and the offset of each text (one more than texts). Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    kind = pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string()
    column = column.cast(kind).fill_null(b"" if kind == pa.large_binary() else "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(offsets), np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` bytes; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words `[^\\x20\\x09-\\x0D]+`: their starts, their ends, and each text's first word (one more than texts)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    solid = ~IS_BLANK[data]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens[heads] = solid[heads]
    closes = solid.copy()
    closes[:-1] &= ~solid[1:]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    closes[tails] = solid[tails]
    starts = np.flatnonzero(opens)
    ends = np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


def repeated(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and the index of each value among them."""
    return np.unique(values, return_inverse=True)
