"""Substring dedup: windows of words that an earlier document has are cut out.

A sketch counts in how many documents a window may start.  Not every window is
counted: two equal windows hold the same smallest run of ``GRAM`` words, so one
count per distinct smallest run bounds the counts of all windows around it.  A
second pass groups exactly those windows whose run the sketch has seen twice;
the smallest document of each window follows, and windows of later documents
are removed.  Windows are compared by 64-bit hashes of their words.

Defined results: null and empty texts have no words; texts shorter than a window
lose nothing; repeated rows of one id do not remove each other's words; rows
without id lose nothing and remove nothing; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldmill.llm import sketch
from yieldmill.llm.textops import Hasher, blocks, covered, distinct_in_row, mix
from yieldmill.session import materialise

WINDOW = 13
GRAM = 6
CHARS_PER_KEY = 24  # of text for each distinct smallest run, about
COUNTERS_PER_KEY = 6


def smallest_runs(words, hasher: Hasher, hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows and, for each, the smallest hash of its runs of GRAM words."""
    gram = min(GRAM, window)
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    start = np.arange(len(hashes) - gram + 1)
    # Runs across rows are never looked at: a window inside a row holds only its own.
    runs = hasher.ranges(hasher.prefix(hashes), start, start + gram)
    low, span, wide = runs, 1, window - gram + 1
    while span < wide:
        step = min(span, wide - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    first = np.flatnonzero(words.row[:n] == words.row[window - 1 :])
    return first, mix(low[first])


def words_left(text: bytes, gone: np.ndarray | None) -> bytes:
    """Words joined by one space, without those marked."""
    words = text.split()  # on the same six characters as everywhere
    if gone is not None:
        words = [word for word, out in zip(words, gone) if not out]
    return b" ".join(words)


RESULT = "n_words long, n_removed long, kept_sha256 string"


def result_batch(ids: pa.Array, name: str, rows: list[tuple[int, int, str]], texts: list | None = None):
    columns = list(zip(*rows)) if rows else [(), (), ()]
    arrays = [
        ids,
        pa.array(columns[0], pa.int64()),
        pa.array(columns[1], pa.int64()),
        pa.array(columns[2], pa.string()),
    ]
    names = [name, "n_words", "n_removed", "kept_sha256"]
    if texts is not None:
        arrays.append(pa.array(texts, pa.string()))
        names.append("kept_text")
    return pa.RecordBatch.from_arrays(arrays, names=names)


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    with_text: bool = False,
) -> DataFrame:
    """Per document: id, n_words, n_removed, kept_sha256 and, if asked for, kept_text."""
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("body"))
    keys = sketch.total_chars(source, "body") / CHARS_PER_KEY
    counters = sketch.counters_for(keys, COUNTERS_PER_KEY)

    def counted(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        hasher = Hasher()
        for block in blocks(batch.column(1)):
            words = block.words()
            first, runs = smallest_runs(words, hasher, words.hashes(hasher), window)
            if not len(first):
                continue
            row = words.row[first]
            new = np.append(True, (row[1:] != row[:-1]) | (runs[1:] != runs[:-1]))
            yield distinct_in_row(row[new], runs[new], block.rows)[0]

    known = source.where("doc IS NOT NULL")
    seen_twice = spark.sparkContext.broadcast(sketch.merged(known, counted, counters, (2,)))

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for block in blocks(batch.column(1)):
                words = block.words()
                hashes = words.hashes(hasher)
                first, runs = smallest_runs(words, hasher, hashes, window)
                maybe = sketch.look_up(seen_twice.value, counters, 1, runs) > 0
                first = first[maybe]
                if not len(first):
                    continue
                found = hasher.ranges(hasher.prefix(hashes), first, first + window)
                found, bounds = distinct_in_row(words.row[first], found, block.rows)
                owner = np.repeat(ids[block.first : block.first + block.rows], np.diff(bounds))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(owner.astype(np.int64))], names=["h", "doc"]
                )

    starts = known.mapInArrow(repeated, "h long, doc long")
    # Only smallest and largest ids travel per window: a window in every document is no hot group.
    firsts = (
        starts.groupBy("h")
        .agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
        .where("first < last")
        .drop("last")
    )
    later = materialise(
        starts.join(firsts, "h")
        .where("doc > first")
        .groupBy("doc")
        .agg(F.collect_set("h").alias("windows")),
        "substring-hits",
    )

    # Most documents lose nothing; their texts need no shuffle.  The bits may name a few too many.
    touched_counters = sketch.counters_for(later.count(), 16)
    touched = spark.sparkContext.broadcast(
        sketch.merged(
            later.select("doc"),
            lambda batch: iter([mix(batch.column(0).to_numpy().view(np.uint64))]),
            touched_counters,
            (1,),
        )
    )

    def is_touched(ids: pa.Array) -> np.ndarray:
        plain = ids.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
        hit = sketch.look_up(touched.value, touched_counters, 1, mix(plain)) > 0
        return hit & ids.is_valid().to_numpy(zero_copy_only=False)

    def untouched_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(~is_touched(batch.column(0))))
            rows, texts = [], [] if with_text else None
            for body in batch.column(1):
                kept = words_left((body.as_py() or "").encode(), None)
                n = kept.count(b" ") + 1 if kept else 0
                rows.append((n, 0, hashlib.sha256(kept).hexdigest()))
                if with_text:
                    texts.append(body.as_py() or "")
            yield result_batch(batch.column(0), "doc", rows, texts)

    def touched_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(is_touched(batch.column(0))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            rows, texts = [], [] if with_text else None
            windows = batch.column(2)
            for block in blocks(batch.column(1)):
                words = block.words()
                hashes = words.hashes(hasher)
                first, found = words.windows(hasher, hashes, window)
                # Windows of row r are at[r] to at[r + 1].
                at = np.searchsorted(words.row[first], np.arange(block.rows + 1))
                for r in range(block.rows):
                    low, high = words.bounds[r], words.bounds[r + 1]
                    body = block.data[block.offsets[r] : block.offsets[r + 1]].tobytes()
                    listed = windows[block.first + r]
                    gone = np.zeros(high - low, bool)
                    if listed.is_valid:
                        out = listed.values.to_numpy().view(np.uint64)
                        own = slice(at[r], at[r + 1])
                        gone = covered(first[own][np.isin(found[own], out)] - low, window, high - low)
                    kept = words_left(body, gone)
                    rows.append((int(high - low), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
                    if with_text:
                        texts.append((kept if gone.any() else body).decode())
            yield result_batch(batch.column(0), "doc", rows, texts)

    schema = f"doc long, {RESULT}" + (", kept_text string" if with_text else "")
    whole = source.mapInArrow(untouched_rows, schema)
    part = (
        source.mapInArrow(touched_rows, source.schema)
        .join(later, "doc", "left")
        .select("doc", "body", "windows")
        .mapInArrow(cut, schema)
    )
    out = whole.unionByName(part)
    return out.withColumnRenamed("doc", doc_id) if doc_id != "doc" else out
