"""Best-fit packing of documents into sequences of several permitted lengths.

Documents are dealt evenly into shards of about ``SHARD_ROWS`` rows; each shard is
packed by itself, so a task holds a bounded number of lengths and the price is at
most a few part-filled sequences per shard.  In a shard, pieces go from long to
short into the open sequence they fill best.  Where none has room, a sequence is
opened in the length with the least cost per word that the pieces still to come
can fill.  This is done for every choice of the longest length to open, the
cheapest packing wins, and at last each sequence shrinks to the shortest
permitted length that holds its contents.

Given an ``order`` of training, shards are contiguous ranges of it, and the
sequences of a shard are numbered by the mean place of their words in it.

A document longer than the longest permitted length is cut into full sequences
and one rest; no other document is cut.

Defined results: null and empty texts give one row of length 0 without a
sequence; repeated rows are packed once each; null ids are packed like others;
an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldmill.operators.keys import number_rows
from yieldmill.session import materialise

LENGTHS = (512, 1024, 2048, 4096)
OVERHEAD = 64  # what a sequence costs besides its length
SHARD_ROWS = 8_192
WORD = "[^ \\t-\\r]+"


def sequence_cost(length: int) -> float:
    return length + OVERHEAD


def pack_pieces(
    sizes: Sequence[int], lengths: Sequence[int], cost: Callable[[int], float]
) -> tuple[list[int], list[int], float]:
    """Sequence of each piece, final length of each sequence, and the total cost.

    ``sizes`` are positive, descending and at most the last of ``lengths``.
    """
    best: tuple[list[int], list[int], float] | None = None
    for menu in range(1, len(lengths) + 1):
        usual = lengths[:menu]
        room: list[tuple[int, int]] = []  # (free words, sequence), ascending
        used: list[int] = []
        chosen: list[int] = []
        left = sum(sizes)
        for size in sizes:
            at = bisect_left(room, (size, -1))
            if at < len(room):
                free, sequence = room.pop(at)
            else:
                # A piece too long for the menu opens the shortest length that holds it.
                able = [n for n in usual if n >= size] or [n for n in lengths if n >= size][:1]
                free = min(able, key=lambda n: (cost(n) / min(n, left), n))
                sequence = len(used)
                used.append(0)
            used[sequence] += size
            chosen.append(sequence)
            if free > size:
                insort(room, (free - size, sequence))
            left -= size
        final = [lengths[bisect_left(lengths, words)] for words in used]
        total = sum(map(cost, final))
        if best is None or total < best[2]:
            best = chosen, final, total
    return best


SCHEMA = "doc long, piece int, start long, length long, sequence_id long, sequence_length int, place long"


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lengths: Sequence[int] = LENGTHS,
    cost: Callable[[int], float] = sequence_cost,
    shard_rows: int = SHARD_ROWS,
    order: Sequence[Column] = (),
) -> DataFrame:
    """One row per piece: id, piece, first word, length, sequence_id, sequence_length, place in it."""
    lengths = sorted(lengths)
    longest = lengths[-1]
    sized = materialise(
        docs.select(
            F.col(doc_id).cast("long").alias("doc"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            *(c.alias(f"order{i}") for i, c in enumerate(order)),
        ),
        "pack-sizes",
    )
    in_order, rows = bool(order), sized.count()
    shards = max(1, math.ceil(rows / shard_rows))
    if in_order:
        numbered = number_rows(sized, [f"order{i}" for i in range(len(order))], "number")
        shard = F.floor((F.col("number") - 1) * shards / F.lit(max(rows, 1))).cast("long")
    else:
        # Numbers deal rows of one id over shards, and equal rows may swap places.
        numbered = number_rows(sized, ["doc", "size"], "number")
        shard = F.col("number") % shards
    dealt = numbered.withColumn("shard", shard)

    def place(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("number").to_numpy(), -table.column("size").to_numpy()))
        table = table.take(pa.array(order))
        size = table.column("size").to_numpy()
        # Full pieces of long documents, then all rests from long to short.
        full, rest = size // longest, size % longest
        whole = np.repeat(np.arange(len(size)), full)
        piece = np.arange(len(whole)) - np.repeat(np.cumsum(full) - full, full)
        rests = np.flatnonzero(rest > 0)
        rests = rests[np.argsort(-rest[rests], kind="stable")]
        chosen, final, _ = pack_pieces(rest[rests].tolist(), lengths, cost)
        empty = np.flatnonzero(size == 0)
        row = np.concatenate((whole, rests, empty))
        length = np.concatenate((np.full(len(whole), longest), rest[rests], np.zeros(len(empty), np.int64)))
        number = np.concatenate((piece, full[rests], np.zeros(len(empty), np.int64)))
        sequence = np.concatenate((np.arange(len(whole)), np.array(chosen, np.int64) + len(whole), np.full(len(empty), -1)))
        capacity = np.concatenate((np.full(len(whole), longest), np.array(final, np.int64)[chosen], np.full(len(empty), -1)))
        if in_order and (sequence >= 0).any():
            some = sequence >= 0
            at = table.column("number").to_numpy()[row]
            at = at - at.min()
            mean = np.bincount(sequence[some], (at * length)[some]) / np.bincount(sequence[some], length[some])
            rank = np.empty(len(mean), np.int64)
            rank[np.argsort(mean, kind="stable")] = np.arange(len(mean))
            sequence[some] = rank[sequence[some]]
        # Pieces of a sequence stand in the order they were put there.
        by = np.argsort(sequence, kind="stable")
        before = np.cumsum(length[by]) - length[by]
        first = np.flatnonzero(np.append(True, sequence[by][1:] != sequence[by][:-1])) if len(by) else by
        start_of = np.repeat(before[first], np.diff(np.append(first, len(by))))
        spot = np.zeros(len(by), np.int64)
        spot[by] = before - start_of
        none = sequence < 0
        shard = key[0].as_py()
        return pa.table(
            {
                "doc": table.column("doc").take(pa.array(row)),
                "piece": pa.array(number.astype(np.int32)),
                "start": pa.array(number * longest),
                "length": pa.array(length),
                "sequence_id": pa.array((shard << 32) + sequence, mask=none),
                "sequence_length": pa.array(capacity.astype(np.int32), mask=none),
                "place": pa.array(spot, mask=none),
            }
        )

    packed = dealt.select("doc", "size", "number", "shard").groupBy("shard").applyInArrow(place, SCHEMA)
    return packed.withColumnRenamed("doc", doc_id) if doc_id != "doc" else packed
