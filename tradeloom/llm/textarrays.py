"""Words of many texts at once, as NumPy arrays over an Arrow column's own bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 20  # bytes of text that are hashed together
SLICE = 1 << 20  # bytes of text whose words are held together

_random = np.random.default_rng(20240601)
BYTE_CODES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
U64 = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x7FB5D329728EA185)
    x = x ^ (x >> U64(27))
    x = x * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)

#: Characters of words as split by white space: all but space and the controls 9 to 13.
NOT_SPACE = ~byte_table(bytes([32, 9, 10, 11, 12, 13]))
#: Characters of words as split by anything but ASCII letters and what lies beyond ASCII.
LETTERS = byte_table(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def cut_out(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bytes of the given ranges, one after the other."""
    lengths = ends - starts
    total = int(lengths.sum())
    kind = np.int32 if max(total, len(data)) < 1 << 31 else np.int64
    at = np.repeat((starts - np.cumsum(lengths) + lengths).astype(kind), lengths)
    at += np.arange(total, dtype=kind)
    return data[at]


def slices(offsets: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold about ``most`` bytes, at least one row each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(name: str, base: int, n: int) -> np.ndarray:
    if len(_powers[name]) < n:
        size = 1 << (n - 1).bit_length()
        table = np.full(size, base, np.uint64)
        table[0] = 1
        _powers[name] = np.multiply.accumulate(table)
    return _powers[name][:n]


@dataclass
class Words:
    """Words of some rows: a hash each, where they lie, and for each row the range of its words."""

    hashes: np.ndarray
    bounds: np.ndarray  # row i has the words bounds[i] to bounds[i + 1]
    starts: np.ndarray
    ends: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray = NOT_SPACE, letters: np.ndarray = LOWER) -> Words:
    """The words of each row: longest runs of ``member`` bytes, as ``letters`` shows them (A to Z in lower case).

    Equal words have equal hashes; different ones differ but for chance (64 bits).
    """
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    hashes, starts_all, ends_all = [], [], []
    low = 0
    while low < len(data):
        high = min(low + SEGMENT, len(data))
        while high < len(data):  # on to the end of the word
            ahead = ~member[data[high:high + 4096]] | begins[high:high + len(data[high:high + 4096])]
            if ahead.any():
                high += int(np.argmax(ahead))
                break
            high = min(high + 4096, len(data))
        part = letters[data[low:high]]
        inside = member[part]
        first = begins[low:high]
        start = inside.copy()
        start[1:] &= ~inside[:-1] | first[1:]
        finish = inside.copy()
        finish[:-1] &= ~inside[1:] | first[1:]
        starts, ends = np.flatnonzero(start), np.flatnonzero(finish) + 1
        n = high - low
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_CODES[part] * _power("up", BASE, n), out=sums[1:])
        hashes.append(mixed((sums[ends] - sums[starts]) * _power("down", INVERSE, n)[starts] + (ends - starts).astype(np.uint64)))
        starts_all.append(starts + low)
        ends_all.append(ends + low)
        low = high
    flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    where, until = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts_all, ends_all))
    return Words(flat, np.searchsorted(where, offsets), where, until)


_MULTIPLIERS = _random.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def run_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` words in a row, over the bounds of rows too."""
    n = max(0, len(h) - width + 1)
    runs = np.zeros(n, np.uint64)
    for j in range(width):
        runs += h[j:j + n] * _MULTIPLIERS[j]
    return mixed(runs)


def shingles(found: Words, width: int) -> Iterator[np.ndarray]:
    """For each row the sorted hashes of its distinct runs of ``width`` words.

    A row of fewer words has one, its whole sequence; a row without words has none.
    """
    h, runs = found.hashes, run_hashes(found.hashes, width)
    for a, b in zip(found.bounds[:-1].tolist(), found.bounds[1:].tolist()):
        if b - a >= width:
            own = np.sort(runs[a:b - width + 1])
            first = np.ones(len(own), bool)
            first[1:] = own[1:] != own[:-1]
            yield own[first]
        elif b > a:
            yield mixed(np.array([(h[a:b] * _MULTIPLIERS[:b - a]).sum(dtype=np.uint64) + U64(b - a)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
