"""Words, lines and rolling hashes of whole Arrow batches, without a loop over words.

A word is a run of bytes other than space and the five control characters from
tab to carriage return.  All of them are ASCII, so cutting UTF-8 bytes cuts code
points as well.  A null text has no words.

Hashes have 64 bits: sums of random byte values times powers of an odd number,
mixed at the end.  Equal sequences have equal hashes in every task and run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one; every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def byte_values(lower: bool) -> np.ndarray:
    """A fixed random value for each byte; with ``lower``, A-Z count as a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    if lower:
        values[65:91] = values[97:123]
    return values


class Hasher:
    """Hashes of byte ranges and of runs of words; holds the tables of powers."""

    BASE = 0xD6E8FEB86659FD93

    def __init__(self, lower: bool = False):
        self.values = byte_values(lower)
        self.up = self.down = np.ones(1, np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(12, (n - 1).bit_length())
            for name, base in (("up", self.BASE), ("down", pow(self.BASE, -1, 1 << 64))):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                setattr(self, name, np.cumprod(table, dtype=np.uint64))
        return self.up, self.down

    def prefix(self, values: np.ndarray) -> np.ndarray:
        up, _ = self.powers(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=sums[1:])
        return sums

    def ranges(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the values in each range, given the prefix sums over all values."""
        _, down = self.powers(len(sums))
        raw = (sums[ends] - sums[starts]) * down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def bytes_in(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.ranges(self.prefix(self.values[data]), starts, ends)


class Block:
    """Texts of consecutive rows: their bytes and where each row begins."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets
        self.rows = len(offsets) - 1

    def words(self) -> Words:
        space = np.zeros(256, bool)
        space[[9, 10, 11, 12, 13, 32]] = True
        inside = ~space[self.data]
        # A change table with an entry per byte and one past the end; rows cut words.
        before = np.zeros(len(inside) + 1, bool)
        before[1:] = inside
        before[self.offsets] = False
        after = np.zeros(len(inside) + 1, bool)
        after[:-1] = inside
        after[self.offsets] = False
        starts = np.flatnonzero(inside & ~before[:-1])
        ends = np.flatnonzero(inside & ~after[1:]) + 1
        return Words(self, starts, ends)


class Words:
    """All words of a block: byte ranges, and the row each belongs to."""

    def __init__(self, block: Block, starts: np.ndarray, ends: np.ndarray):
        self.block, self.starts, self.ends = block, starts, ends
        # Words of row r are bounds[r] to bounds[r + 1].
        self.bounds = np.searchsorted(starts, block.offsets)
        self.counts = np.diff(self.bounds)
        self.row = np.repeat(np.arange(block.rows), self.counts)

    def hashes(self, hasher: Hasher) -> np.ndarray:
        return hasher.bytes_in(self.block.data, self.starts, self.ends)

    def windows(self, hasher: Hasher, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all runs of ``size`` words inside one row."""
        n = len(hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        first = np.flatnonzero(self.row[:n] == self.row[size - 1 :])
        return first, hasher.ranges(hasher.prefix(hashes), first, first + size)


def per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive bounds."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return np.diff(sums[bounds])


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut an Arrow string column into blocks of about ``limit`` bytes, one row at least."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, where, content = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(content, np.uint8) if content else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(texts))
        low, high = offsets[row], offsets[end]
        yield Block(row, data[low:high], offsets[row : end + 1] - low)
        row = end


def repeated_in_row(row: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """True where the same hash is found in the same row twice or more."""
    keys = mix(hashes ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(keys)
    sorted_keys = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = sorted_keys[1:] == sorted_keys[:-1]
    found = np.zeros(len(keys), bool)
    found[order] = same[1:] | same[:-1]
    return found


def distinct_in_row(row: np.ndarray, hashes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each row, sorted by row and hash, and the bounds of each row."""
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    row, hashes = row[new], hashes[new]
    return hashes, np.searchsorted(row, np.arange(rows + 1))


def covered(first: np.ndarray, size: int, n: int) -> np.ndarray:
    """True for each of ``n`` words that a run of ``size`` words from ``first`` covers."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, first, 1)
    np.add.at(change, first + size, -1)
    return np.cumsum(change[:-1]) > 0
