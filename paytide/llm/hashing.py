"""Words, word n-grams and shingles of many texts as 64-bit numbers, on whole Arrow columns.

A word is a run of bytes outside the six ASCII white-space characters, with A-Z lowered. It is
named by a 64-bit hash: two different words share one with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_C = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), U(base), dtype=U)
    out[0] = 1
    return np.multiply.accumulate(out)


def _byte_table() -> np.ndarray:
    table = mixed(np.arange(1, 257, dtype=U) * U(_C))
    table[65:91] = table[97:123]  # A-Z as a-z
    return table


BYTES = _byte_table()
BLANK = np.zeros(256, dtype=bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True


def slices(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``most`` bytes (a row is never cut).

    Yields the first row's index, the run's bytes and its n+1 offsets from 0; null is empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, raw[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word, in order."""
    if not len(data):
        return np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64)
    inside = ~BLANK[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begins[heads] = inside[heads]  # a text's first byte begins a word, whatever came before
    first = np.flatnonzero(begins)
    if not len(first):
        return np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(inside)
    ordinal = np.cumsum(begins[at]) - 1
    place = at - first[ordinal]
    values = BYTES[data[at]] * powers(0xD1342543DE82EF95, int(place.max()) + 1)[place]
    runs = np.flatnonzero(begins[at])
    length = np.diff(np.append(runs, len(at))).astype(U)
    hashes = mixed(np.add.reduceat(values, runs) + length * U(_C))
    rows = np.searchsorted(offsets, first, "right") - 1
    return hashes, rows


def sequence_keys(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One hash for each row's whole word sequence (rows in order, ``counts`` words each)."""
    out = np.zeros(len(counts), dtype=U)
    full = np.flatnonzero(counts)
    if len(full):
        starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
        place = np.arange(len(hashes)) - np.repeat(starts, counts)
        values = hashes * powers(0xA24BAED4963EE407, int(place.max()) + 1)[place]
        out[full] = mixed(np.add.reduceat(values, starts[full]) + counts[full].astype(U) * U(_C))
    return out


def shingles(hashes: np.ndarray, counts: np.ndarray, keys: np.ndarray, k: int) -> list[np.ndarray]:
    """Each row's sorted distinct shingles of ``k`` words; shorter rows have their whole sequence."""
    factors = powers(0x8CB92BA72F3D8DD7, k + 1)[1:]
    n = len(hashes) - k + 1
    rolled = np.zeros(max(n, 0), dtype=U)
    for i in range(k if n > 0 else 0):
        rolled += hashes[i : i + n] * factors[i]
    rolled = mixed(rolled)
    out, at = [], 0
    for row, count in enumerate(counts.tolist()):
        if count >= k:
            out.append(np.unique(rolled[at : at + count - k + 1]))
        else:
            out.append(keys[row : row + 1] if count else np.zeros(0, dtype=U))
        at += count
    return out
