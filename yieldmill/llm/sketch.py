"""Count sketches built in every partition, merged by shuffle and sent to all tasks.

A key adds one to a single counter, so a counter is never below the true count
of any of its keys.  A partition sends only its nonzero counters, in chunks of
``CHUNK`` counters; chunks are summed where they meet.  What reaches the driver
and the workers is a code of one or two bits per counter, and the number of
counters has a bound, so its size has one too: ``MOST_BITS`` / 8 bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldmill.llm.textops import mix

CHUNK_BITS = 16
CHUNK = 1 << CHUNK_BITS
MOST_BITS = 1 << 30  # 128 MB
STEP = 255
PENDING = 1 << 20  # keys a task gathers before it sums them


def counters_for(keys: float, per_key: float, code_bits: int = 1) -> int:
    """Power of two with ``per_key`` counters for each expected key, up to the bound."""
    wanted = 1 << max(CHUNK_BITS, int(np.ceil(np.log2(max(keys * per_key, 1)))))
    return min(wanted, MOST_BITS // code_bits)


def place(hashes: np.ndarray, counters: int) -> np.ndarray:
    """Counter of each hash: its highest bits."""
    return hashes >> np.uint64(64 - (counters.bit_length() - 1))


def firsts(ordered: np.ndarray) -> np.ndarray:
    """Where each new value begins."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(new)


class Counters:
    """What one task has counted, summed now and then."""

    def __init__(self) -> None:
        self.places, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.uint16)
        self.pending: list[np.ndarray] = []
        self.waiting = 0

    def add(self, places: np.ndarray) -> None:
        self.pending.append(places)
        self.waiting += len(places)
        if self.waiting >= PENDING:
            self.settle()

    def settle(self) -> None:
        # New places are summed by themselves, in place, so little more than them is held.
        new = np.concatenate([self.places[:0], *self.pending])
        self.pending, self.waiting = [], 0
        new.sort()
        first = firsts(new)
        counts = np.minimum(np.diff(first, append=len(new)), 255).astype(np.uint16)
        places, counts = np.append(self.places, new[first]), np.append(self.counts, counts)
        order = np.argsort(places, kind="stable")
        places, counts = places[order], counts[order]
        first = firsts(places)
        self.places = places[first]
        self.counts = np.minimum(np.add.reduceat(counts, first), 255).astype(np.uint16) if len(first) else counts

    def batches(self) -> Iterator[pa.RecordBatch]:
        """Rows of chunk, gaps between counters, counts up to 255, and how gaps are coded.

        Short ones take a byte, after one of ``STEP`` for each such step; else all take two bytes.
        """
        self.settle()
        if not len(self.places):
            return
        chunk = (self.places >> np.uint64(CHUNK_BITS)).astype(np.int64)
        inside = (self.places & np.uint64(CHUNK - 1)).astype(np.int64)
        first = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
        gaps = np.diff(inside, prepend=0)
        gaps[first] = inside[first]
        counts = self.counts.astype(np.uint8)
        ends = np.append(first[1:], len(chunk))
        last = np.cumsum(gaps // STEP + 1)  # where the bytes of each gap end
        short = last[-1] <= 2 * len(gaps)
        if short:
            coded = np.full(last[-1], STEP, np.uint8)
            coded[last - 1] = gaps % STEP
            bounds = np.append(0, last)
        else:
            coded, bounds = gaps.astype("<u2"), np.arange(len(gaps) + 1)
        for low in range(0, len(first), 512):
            part = range(low, min(low + 512, len(first)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(chunk[first[part.start : part.stop]]),
                    pa.array([coded[bounds[first[k]] : bounds[ends[k]]].tobytes() for k in part], pa.binary()),
                    pa.array([counts[first[k] : ends[k]].tobytes() for k in part], pa.binary()),
                    pa.array(np.full(len(part), short)),
                ],
                names=["chunk", "gaps", "counts", "short"],
            )


def pack(codes: np.ndarray, code_bits: int) -> bytes:
    if code_bits == 1:
        return np.packbits(codes.astype(bool), bitorder="little").tobytes()
    quads = codes.astype(np.uint8).reshape(-1, 4)
    return (quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6).tobytes()


def look_up(packed: np.ndarray, counters: int, code_bits: int, hashes: np.ndarray) -> np.ndarray:
    """Code of each hash: how many of the levels its counter has reached."""
    at = place(hashes, counters)
    if code_bits == 1:
        return (packed[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
    return (packed[at >> np.uint64(2)] >> ((at & np.uint64(3)) * np.uint64(2)).astype(np.uint8)) & 3


def merged(
    source: DataFrame,
    keys: Callable[[pa.RecordBatch], Iterator[np.ndarray]],
    counters: int,
    levels: Sequence[int],
) -> np.ndarray:
    """Codes of all counters after counting the hashes that ``keys`` takes from each batch."""
    code_bits = 1 if len(levels) == 1 else 2
    steps = np.array(levels)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counters()
        for batch in batches:
            for hashes in keys(batch):
                held.add(place(hashes, counters))
        yield from held.batches()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, gaps, counts, short in zip(*(column.to_pylist() for column in batch.columns)):
                held = sums.setdefault(chunk, np.zeros(CHUNK, np.uint16))
                steps_up = np.frombuffer(gaps, np.uint8 if short else "<u2")
                at = np.cumsum(steps_up.astype(np.int64))
                if short:
                    at = at[steps_up < STEP]
                more = np.frombuffer(counts, np.uint8)
                held[at] = np.minimum(held[at] + more, 60_000)
        for chunk, held in sums.items():
            codes = np.searchsorted(steps, held, "right")
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([pack(codes, code_bits)], pa.binary())],
                names=["chunk", "codes"],
            )

    parts = source.mapInArrow(count, "chunk long, gaps binary, counts binary, short boolean")
    # Chunks are dealt evenly: a task holds as many as fit, whatever the input's size.
    tasks = max(1, min(counters // CHUNK, int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    codes = parts.repartition(tasks, "chunk").mapInArrow(add, "chunk long, codes binary")
    out = np.zeros(counters * code_bits // 8, np.uint8)
    size = CHUNK * code_bits // 8
    for chunk, packed in codes.collect():  # as large as ``out``, so within the bound
        out[chunk * size : (chunk + 1) * size] = np.frombuffer(packed, np.uint8)
    return out


def id_filter(ids: DataFrame, per_key: int = 16) -> Callable[[pa.Array], np.ndarray]:
    """A test for membership in the one whole-number column of ``ids``.

    Every member passes and about one other in ``per_key``; null never passes.
    """
    counters = counters_for(ids.count(), per_key)

    def hashes(column: pa.Array) -> np.ndarray:
        plain = column.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
        return mix(plain.view(np.uint64))

    packed = merged(ids, lambda batch: iter([hashes(batch.column(0))]), counters, (1,))
    sent = ids.sparkSession.sparkContext.broadcast(packed)

    def passes(column: pa.Array) -> np.ndarray:
        hit = look_up(sent.value, counters, 1, hashes(column)) > 0
        return hit & column.is_valid().to_numpy(zero_copy_only=False)

    return passes


def total_chars(df: DataFrame, text: str) -> int:
    """Code points in all texts."""
    return df.agg(F.sum(F.length(F.col(text).cast("string")))).first()[0] or 0
