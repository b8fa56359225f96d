"""Ranked lexical search, reversed: documents stream through an index of the queries.

The items (queries) are the small side, so the index is built over their terms and the
documents are never indexed or shuffled:

* Items are numbered and cut into blocks of at most ``BLOCK_TERMS`` terms with repeats
  (an item longer than that is a block of its own).  A block's terms are the only thing
  broadcast, so its size is bounded whatever the number of items.
* One pass over the documents counts, for a block's terms, the documents that hold
  them, and all documents and terms; a second turns each document's term counts into
  scores through the inverted index and keeps a heap of the k best for each item.
* The heaps of all tasks, at most k rows for an item and task, are merged by rank.

``score`` sums, over an item's terms with repeats, ``weight * (10^9 tf div (1000 tf +
8 m))``, with ``m = 25 + (75 n N) div L`` and ``weight = floor(1000 ln((2N + 2) / (2df +
1)))``: a saturating term frequency with length normalisation, in whole numbers.

Defined results: a null or empty text, document or item, has no terms; such a document
counts nowhere and such an item finds nothing.  Scores of 0 are left out.  Equal scores
rank by ascending document id, a null id last; each row of a repeated document ranks on
its own.  Each item row has its own list, also where item ids repeat or are null.  Empty
tables give an empty result.  Only the id and text columns are read, so other columns
cannot clash.  Very long texts are read whole, one at a time.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldmill.llm.terms import splitter
from yieldmill.operators.keys import number_rows
from yieldmill.session import materialise

BLOCK_TERMS = 1 << 20
CELLS = 1 << 18  # scores held at a time: documents by items

split = splitter(digits=True)


@dataclass(frozen=True)
class Index:
    """Items of a block by term: term t has the entries bounds[t] to bounds[t + 1]."""

    place: dict[bytes, int]
    bounds: np.ndarray
    items: np.ndarray
    weights: np.ndarray
    numbers: np.ndarray  # of the items, as they are numbered over all blocks
    docs: int
    words: int


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank, doc_id, score."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    asked = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("binary").alias("text"))
    numbered = materialise(number_rows(asked, ["item_id", "text"], "item"), "items")
    found = None
    for low, high in item_blocks(numbered):
        block = numbered.filter(F.col("item").between(low, high)).select("item", "text")
        index = build_index(texts, {row.item: Counter(split(row.text)) for row in block.collect()})
        part = materialise(best_of_block(texts, index, k), "found")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], f"item long, {_kind(texts)}, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _kind(texts: DataFrame) -> str:
    return f"doc_id {texts.schema['doc_id'].dataType.simpleString()}"


def item_blocks(numbered: DataFrame) -> list[tuple[int, int]]:
    """Ranges of item numbers with at most ``BLOCK_TERMS`` terms, or one item each.

    A byte of text gives half a term at most.  Items are summed by runs of 4096 first,
    so the driver gets a row for each run and only opens the runs that are too large.
    """
    most = F.least((F.octet_length("text") + 1) / 2, F.lit(float(1 << 40)))
    sized = numbered.select("item", F.coalesce(most, F.lit(0.0)).alias("terms"))
    runs = sized.groupBy(((F.col("item") - 1) / 4096).cast("long").alias("run"))
    runs = runs.agg(F.min("item"), F.max("item"), F.sum("terms")).orderBy("run").collect()
    pieces: list[tuple[int, int, float]] = []
    for _, low, high, terms in runs:
        if terms <= BLOCK_TERMS:
            pieces.append((low, high, terms))
            continue
        rows = sized.filter(F.col("item").between(low, high)).orderBy("item").collect()
        pieces += [(row.item, row.item, row.terms) for row in rows]
    blocks: list[tuple[int, int]] = []
    held = math.inf
    for low, high, terms in pieces:
        held += terms
        if held > BLOCK_TERMS:
            blocks.append((low, high))
            held = terms
        else:
            blocks[-1] = (blocks[-1][0], high)
    return blocks


def build_index(texts: DataFrame, items: dict[int, Counter]) -> Index:
    """Weights need N, L and the terms' document counts: one pass over the documents."""
    place = {term: k for k, term in enumerate(sorted(set().union(*items.values())))}
    sent = texts.sparkSession.sparkContext.broadcast(place)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs, words = sent.value, 0, 0
        held = np.zeros(len(known), np.int64)
        for batch in batches:
            for value in batch.column("text"):
                terms = split(value.as_py())
                docs += bool(terms)
                words += len(terms)
                held[[known[term] for term in known.keys() & set(terms)]] += 1
        hit = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(hit, [-1, -2])), pa.array(np.append(held[hit], [docs, words]))], names=["term", "n"]
        )

    sums = texts.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {row.term: row.n for row in sums.collect()}  # a row for each term of the block
    docs, words = counts.get(-1, 0), counts.get(-2, 0)
    numbers = np.array(sorted(items), np.int64)
    entries = sorted(
        (place[term], at, times) for at, item in enumerate(numbers) for term, times in items[item].items()
    )
    terms = np.array([entry[0] for entry in entries], np.int64)
    weight = [math.floor(1000 * math.log((2 * docs + 2) / (2 * counts.get(k, 0) + 1))) for k in range(len(place))]
    return Index(
        place,
        np.searchsorted(terms, np.arange(len(place) + 1)),
        np.array([entry[1] for entry in entries], np.int64),
        np.array([entry[2] * weight[entry[0]] for entry in entries], np.int64),
        numbers,
        docs,
        words,
    )


def best_of_block(texts: DataFrame, index: Index, k: int) -> DataFrame:
    """Each task's ``k`` best documents of each item."""
    sent = texts.sparkSession.sparkContext.broadcast(index)
    schema = T.StructType.fromDDL("item long, score long").add(texts.schema["doc_id"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        heaps = Heaps(len(known.numbers), k)
        rows = max(1, CELLS // max(1, len(known.numbers)))
        kind = None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            ids = batch.column("doc_id")
            scores, held = np.zeros((rows, len(known.numbers)), np.int64), []
            for at, value in enumerate(batch.column("text")):
                if add_scores(known, split(value.as_py()), scores[len(held)]):
                    held.append(ids[at].as_py())
                if len(held) == rows:
                    heaps.offer(scores, held)
                    scores[:], held = 0, []
            heaps.offer(scores, held)
        if kind is not None:
            best = [(known.numbers[at], score, doc) for at, heap in enumerate(heaps.heaps) for score, _, doc in heap]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row[0] for row in best], pa.int64()),
                    pa.array([row[1] for row in best], pa.int64()),
                    pa.array([row[2] for row in best], kind),
                ],
                names=schema.names,
            )

    return texts.mapInArrow(stream, schema)


def add_scores(index: Index, terms: list[bytes], scores: np.ndarray) -> bool:
    """Add a document's scores for all items to a row of zeros; False if it shares no term."""
    held = Counter(terms)
    shared = held.keys() & index.place.keys()
    if not shared:
        return False
    m = 25 + 75 * len(terms) * index.docs // index.words
    place = np.array([index.place[term] for term in shared])
    tf = np.array([held[term] for term in shared], np.int64)
    impact = 1_000_000_000 * tf // (1000 * tf + 8 * m)
    first, sizes = index.bounds[place], index.bounds[place + 1] - index.bounds[place]
    ends = np.cumsum(sizes)
    entry = np.arange(ends[-1]) + np.repeat(first - ends + sizes, sizes)
    np.add.at(scores, index.items[entry], index.weights[entry] * np.repeat(impact, sizes))
    return True


class LastId:
    """Orders document ids so that the greatest, and before it null, leaves a heap first."""

    __slots__ = ("value",)

    def __init__(self, value):
        self.value = value

    def __lt__(self, other: LastId) -> bool:
        if self.value is None or other.value is None:
            return self.value is None and other.value is not None
        return self.value > other.value

    def __eq__(self, other: object) -> bool:
        return self.value == other.value


class Heaps:
    """The ``k`` best documents of each item so far; the worst of them is on top."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.heaps: list[list[tuple[int, LastId, object]]] = [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)  # a lower score cannot enter

    def offer(self, scores: np.ndarray, docs: list) -> None:
        rows, items = np.nonzero(scores[: len(docs)] >= self.least)
        for row, item in zip(rows.tolist(), items.tolist()):
            score, heap = int(scores[row, item]), self.heaps[item]
            entry = (score, LastId(docs[row]), docs[row])
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry[:2] > heap[0][:2]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.least[item] = heap[0][0]
