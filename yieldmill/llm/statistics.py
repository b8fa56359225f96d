"""Counts over whole texts that the quality operators use as evidence."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldmill.llm.textops import Block, Hasher, blocks, covered, per_row, repeated_in_row

# Characters that count as symbols: a fixed value of the quality rules.
SYMBOLS = b"#*$%&|<>"

COUNTS = (
    "n_chars",         # code points
    "n_words",
    "word_chars",      # code points in words
    "n_symbols",
    "n_lines",         # lines with a word
    "n_dup_lines",     # of those, lines equal to an earlier one
    "n_repeat_words",  # words in runs of three words found twice or more
    "n_distinct",      # distinct words, as written
    "n_digits",
    "n_upper",         # A-Z
    "n_stops",         # . ! ?
    "n_commas",        # , ; :
    "n_marked",        # words that end in a symbol
    "n_long",          # words of 20 bytes or more
    "n_short",         # words of at most 3 bytes
    "n_short_lines",   # lines with one to three words
)


def member(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


def distinct_count(row: np.ndarray, hashes: np.ndarray, rows: int) -> np.ndarray:
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    return np.bincount(row[new], minlength=rows)


def block_counts(block: Block, hasher: Hasher) -> np.ndarray:
    """One line per row of the block, one column per name in COUNTS."""
    data, offsets = block.data, block.offsets
    words = block.words()
    sums = hasher.prefix(hasher.values[data])
    hashes = hasher.ranges(sums, words.starts, words.ends)
    of_bytes = lambda table: per_row(table[data], offsets)
    of_words = lambda flags: per_row(flags, words.bounds)

    leading = np.ones(256, bool)
    leading[128:192] = False  # UTF-8 continuation bytes
    white = of_bytes(member(b" \t\n\v\f\r"))
    n_chars = of_bytes(leading)

    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate((offsets[:-1][np.diff(offsets) > 0], breaks + 1)))
    # A break at the end of a row starts an empty line there; it has no word anyway.
    starts = starts[starts < len(data)]
    ends = np.minimum(np.append(starts[1:], len(data)), len(data))
    ends = np.where((ends > starts) & (data[np.maximum(ends - 1, 0)] == 10), ends - 1, ends)
    in_line = np.searchsorted(words.starts, ends) - np.searchsorted(words.starts, starts)
    with_word = in_line > 0
    line_row = np.searchsorted(offsets, starts[with_word], "right") - 1
    line_hash = hasher.ranges(sums, starts[with_word], ends[with_word])
    n_lines = np.bincount(line_row, minlength=block.rows)
    short_lines = np.bincount(line_row[in_line[with_word] <= 3], minlength=block.rows)

    first, runs = words.windows(hasher, hashes, 3)
    repeats = repeated_in_row(words.row[first], runs)
    repeated = covered(first[repeats], 3, len(hashes))
    length = words.ends - words.starts
    return np.column_stack(
        [
            n_chars,
            words.counts,
            n_chars - white,
            of_bytes(member(SYMBOLS)),
            n_lines,
            n_lines - distinct_count(line_row, line_hash, block.rows),
            of_words(repeated),
            distinct_count(words.row, hashes, block.rows),
            of_bytes(member(b"0123456789")),
            of_bytes(member(bytes(range(65, 91)))),
            of_bytes(member(b".!?")),
            of_bytes(member(b",;:")),
            of_words(member(SYMBOLS)[data[words.ends - 1]]),
            of_words(length >= 20),
            of_words(length <= 3),
            short_lines,
        ]
    ).astype(np.int64)


def text_counts(texts: pa.Array) -> np.ndarray:
    hasher = Hasher()
    parts = [block_counts(block, hasher) for block in blocks(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, len(COUNTS)), np.int64)


def with_counts(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns and the counts of every whole text; a null text counts as empty.

    Only the named columns are read, so other columns of any name do no harm;
    a kept column may not be named like a count.
    """
    source = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    schema = T.StructType(
        [*source.schema.fields[:-1], *(T.StructField(name, T.LongType()) for name in COUNTS)]
    )
    names = [*keep, *COUNTS]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = text_counts(batch.column(batch.num_columns - 1))
            columns = [pa.array(counts[:, i]) for i in range(counts.shape[1])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=names)

    return source.mapInArrow(count, schema)
