"""Source divergence audit: how the term shares of a language's sources differ.

* One pass counts, for each language, the documents that hold a term; terms in at
  least ``LEAST_DOCS`` documents are kept, numbered in byte order over all languages.
* Runs of ``SHARD_TERMS`` numbers each become a minimal acyclic transducer, built by
  the task that holds the run.  The texts are streamed through the transducers for
  the recount: a task numbers its terms, counts the numbers by language and source and
  turns each distinct term into its ordinal, by the transducer of the run in which it
  would lie.  What is broadcast at once is limited to ``SENT_BYTES``; a vocabulary
  beyond that is sent in turn, one pass over the texts for each load.
* Counts travel by source and block of ``WIDTH`` ordinals, a row for each; where the
  rows of a block meet, they are added up one block at a time.
* From there on terms are ordinals, which also break ties: their order is the terms'.
* ``p = 1 + floor(10^9 (count + 2) / (N + 2V))`` for group and language; the divergence
  of a term is ``floor((p - q)^2 / (p + q))``.  Ordinals are cut into blocks of
  ``WIDTH``; a task holds one block of all sources of one language, in 64-bit integers,
  and only the sums of blocks are shuffled.

Result, one row each, ranked by value and then UTF-8 order of the item, from 1 per
language, source and part: ``pair``, the other sources of the language with the sum over
all kept terms; ``term``, the ``TOP`` kept terms that the source uses more than its
language does.  Counts times 10^9 are decimals, so no corpus is too large for them.

Defined results: null text, lang and source are ''; a group without terms still has its
pairs; a language without kept terms gives pairs with value 0; a language's only source
has no pair.  Repeated rows count as documents of their own.  Very long texts are read
whole, one at a time.  An empty table gives an empty result.  Only text, lang and source
are read, so other columns cannot clash.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldmill.llm import transducer
from yieldmill.llm.terms import splitter
from yieldmill.operators.keys import number_rows
from yieldmill.session import materialise

LEAST_DOCS = 10
TOP = 10
SHARD_TERMS = 1 << 17
SENT_BYTES = 32 << 20
WIDTH = 1024
HELD = 1 << 18  # distinct terms that a task holds before it passes their counts on
WAITING = 1 << 22  # words that it holds by number, 16 MB
CELLS = "lang string, source string, block long, at array<int>, n array<long>"

split = splitter(digits=False)


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Rows of lang, source, part, item, value and rank."""
    named = [F.coalesce(F.col(name).cast("string"), F.lit("")).alias(to) for name, to in ((lang, "lang"), (source, "source"))]
    texts = docs.select(*named, F.col(text).cast("binary").alias("text"))
    terms = materialise(number_rows(kept_terms(texts), ["lang", "term"], "ordinal"), "terms")
    counts = materialise(recount(texts, terms), "counts")
    vocabularies = terms.groupBy("lang").agg(F.count("*").alias("v"), F.min("ordinal").alias("first"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
    groups = groups.join(vocabularies, "lang", "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"), "first"
    )
    groups = materialise(groups, "groups")
    shared = materialise(shares(counts, groups), "shares")
    top = top_terms(shared).join(terms, ["lang", "ordinal"])
    top = top.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value", "rank")
    return source_pairs(shared, groups).unionByName(top)


class Counts:
    """Term counts of a task by group; full when it holds ``HELD`` different ones."""

    def __init__(self):
        self.of: dict[tuple[str, ...], Counter] = {}
        self.size = 0

    def add(self, group: tuple[str, ...], terms) -> None:
        counter = self.of.setdefault(group, Counter())
        before = len(counter)
        counter.update(terms)
        self.size += len(counter) - before

    def full(self) -> bool:
        return self.size > HELD

    def empty(self) -> Iterator[tuple[tuple[str, ...], list[bytes], np.ndarray]]:
        for group, counter in self.of.items():
            yield group, list(counter), np.fromiter(counter.values(), np.int64, len(counter))
        self.of, self.size = {}, 0


def kept_terms(texts: DataFrame) -> DataFrame:
    """Terms of each language in at least ``LEAST_DOCS`` of its documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counts()
        for batch in batches:
            for value, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
                held.add((lang,), set(split(value.as_py())))
                if held.full():
                    yield from rows(held)
        yield from rows(held)

    def rows(held: Counts) -> Iterator[pa.RecordBatch]:
        for (lang,), terms, n in held.empty():
            columns = [pa.array([lang] * len(terms), pa.string()), pa.array(terms, pa.binary()), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "term", "n"])

    found = texts.select("lang", "text").mapInArrow(count, "lang string, term binary, n long")
    summed = found.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    return summed.filter(F.col("n") >= LEAST_DOCS).select("lang", "term")


def shards(terms: DataFrame) -> DataFrame:
    """Transducers of runs of ordinals: lang, first ordinal and term, size in bytes, data."""

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("ordinal")
        data = transducer.build(value.as_py() for value in rows.column("term")).dump()
        return pa.table(
            {
                "lang": pa.array([rows.column("lang")[0].as_py()], pa.string()),
                "first": pa.array([rows.column("ordinal")[0].as_py()], pa.int64()),
                "least": pa.array([rows.column("term")[0].as_py()], pa.binary()),
                "size": pa.array([len(data)], pa.int64()),
                "data": pa.array([data], pa.binary()),
            }
        )

    shard = F.expr(f"(ordinal - 1) div {SHARD_TERMS}").alias("shard")
    runs = terms.select("lang", "term", "ordinal", shard).groupBy("lang", "shard")
    return runs.applyInArrow(build, "lang string, first long, least binary, size long, data binary")


class Numbered:
    """Words of a task: each distinct one has a number in its language, each group holds the numbers of its words."""

    def __init__(self):
        self.of: dict[str, defaultdict[bytes, int]] = {}
        self.words: dict[str, dict[str, list[np.ndarray]]] = {}
        self.distinct = self.waiting = 0

    def add(self, lang: str, source: str, terms: list[bytes]) -> None:
        if not terms:
            return
        number = self.of.get(lang)
        if number is None:
            number = self.of[lang] = defaultdict()
            number.default_factory = number.__len__
        before = len(number)
        found = np.fromiter(map(number.__getitem__, terms), np.int32, len(terms))
        self.words.setdefault(lang, {}).setdefault(source, []).append(found)
        self.distinct += len(number) - before
        self.waiting += len(found) + 64  # what an array takes besides

    def full(self) -> bool:
        return self.distinct > HELD or self.waiting > WAITING

    def empty(self) -> Iterator[tuple[str, list[bytes], dict[str, tuple[np.ndarray, np.ndarray]]]]:
        """Of each language its terms, and by source the numbers that occur and how often."""
        for lang, number in self.of.items():
            sources = {}
            for source, words in self.words[lang].items():
                found = np.concatenate(words)
                if len(number) <= 4 * len(found):
                    times = np.bincount(found, minlength=len(number))
                    found = np.flatnonzero(times)
                    sources[source] = found, times[found]
                else:
                    sources[source] = np.unique(found, return_counts=True)
            yield lang, list(number), sources
        self.__init__()


def recount(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """Occurrences of kept terms by language and source: lang, source, ordinal, n, lang_n (of all sources)."""
    built = materialise(shards(terms), "transducers")
    loads: list[list[int]] = []
    held = SENT_BYTES
    for row in built.select("first", "size").orderBy("first").collect():  # a row for each 131,072 terms
        held += row.size
        if held > SENT_BYTES:
            loads.append([])
            held = row.size
        loads[-1].append(row.first)
    parts = [
        _stream(texts, [tuple(r) for r in built.filter(F.col("first").isin(load)).drop("size").collect()])
        for load in loads
    ]
    found = texts.sparkSession.createDataFrame([], CELLS)
    for part in parts:
        found = found.unionByName(part)
    return summed(found)


def _stream(texts: DataFrame, load: list[tuple[str, int, bytes, bytes]]) -> DataFrame:
    """The cells that each task has counted, a row for each source and block of ordinals."""
    sent = texts.sparkSession.sparkContext.broadcast(load)
    width = WIDTH

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machines: dict[str, list] = {}
        for lang, first, least, data in sorted(sent.value, key=lambda row: row[:2]):
            machines.setdefault(lang, []).append((least, first, transducer.Transducer.load(data)))
        held = Numbered()
        for batch in batches:
            columns = (batch.column("text"), batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            for value, lang, source in zip(*columns):
                if lang in machines:
                    held.add(lang, source, split(value.as_py()))
                    if held.full():
                        yield from rows(machines, held)
        yield from rows(machines, held)

    def rows(machines: dict[str, list], held: Numbered) -> Iterator[pa.RecordBatch]:
        for lang, terms, sources in held.empty():
            # A term goes through its transducer once, however many sources have it.
            place = places(machines[lang], terms)
            order = np.argsort(place, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            place = place[order]
            for source, (found, n) in sources.items():
                found = rank[found]
                by = np.argsort(found)
                ordinal, n = place[found[by]], n[by]
                ordinal, n = ordinal[ordinal >= 0], n[ordinal >= 0]
                block = ordinal // width
                first = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else block
                bounds = pa.array(np.append(first, len(block)), pa.int32())
                columns = [
                    pa.array([lang] * len(first), pa.string()),
                    pa.array([source] * len(first), pa.string()),
                    pa.array(block[first]),
                    pa.ListArray.from_arrays(bounds, pa.array((ordinal - block * width).astype(np.int32))),
                    pa.ListArray.from_arrays(bounds, pa.array(n.astype(np.int64))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "block", "at", "n"])

    def places(runs: list, terms: list[bytes]) -> np.ndarray:
        """Ordinals of the terms, each from the run in which it would lie; -1 for those not kept."""
        # Terms below the first run are unknown to it, as they are to all others.
        starts = [least for least, _, _ in runs[1:]]
        run = np.fromiter((bisect_right(starts, term) for term in terms), np.int32, len(terms)) if starts else None
        place = np.full(len(terms), -1, np.int64)
        for k, (_, first, machine) in enumerate(runs):
            own = np.arange(len(terms)) if run is None else np.flatnonzero(run == k)
            found = machine.ordinals(terms if run is None else [terms[i] for i in own.tolist()])
            place[own] = np.where(found >= 0, first + found, -1)
        return place

    return texts.mapInArrow(stream, CELLS)


def summed(cells: DataFrame) -> DataFrame:
    """A row for each source and ordinal; a task adds up one block of one language at a time."""
    width = WIDTH

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, {}
        for batch in batches:
            names = [batch.column(k).to_pylist() for k in range(3)]
            at, n = (batch.column(k).flatten().to_numpy() for k in (3, 4))
            ends = np.cumsum(batch.column(3).value_lengths().to_numpy()).tolist()
            low = 0
            for lang, source, block, high in zip(*names, ends):
                if last != (lang, block):
                    yield from rows(last, held)
                    last, held = (lang, block), {}
                if source not in held:
                    held[source] = np.zeros(width, np.int64)
                held[source][at[low:high]] += n[low:high]  # an ordinal is in a row once
                low = high
        yield from rows(last, held)

    def rows(last: tuple[str, int] | None, held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        whole = sum(held.values())
        for source, n in held.items():
            at = np.flatnonzero(n)
            columns = [
                pa.array([last[0]] * len(at), pa.string()),
                pa.array([source] * len(at), pa.string()),
                pa.array(last[1] * width + at),
                pa.array(n[at]),
                pa.array(whole[at]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "ordinal", "n", "lang_n"])

    together = cells.repartition("lang", "block").sortWithinPartitions("lang", "block")
    return together.mapInArrow(add, "lang string, source string, ordinal long, n long, lang_n long")


def share(count: str, total: str, v: str = "v") -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2V)); null without kept terms."""
    whole = f"(CAST(1000000000 AS DECIMAL(12,0)) * CAST({count} + 2 AS DECIMAL(20,0)))"
    return F.expr(f"CASE WHEN {v} > 0 THEN 1 + {whole} DIV CAST({total} + 2 * {v} AS DECIMAL(20,0)) END")


def shares(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """Counts above 0 with the shares p of the group and q of its language."""
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    rows = counts.join(groups.join(langs, "lang"), ["lang", "source"])
    return rows.select(
        "lang",
        "source",
        "ordinal",
        share("n", "total").alias("p"),
        share("lang_n", "lang_total").alias("q"),
        F.expr(f"(ordinal - first) div {WIDTH}").alias("block"),
    )


def top_terms(shared: DataFrame) -> DataFrame:
    """The kept terms that a source uses more than its language, up to rank ``TOP``."""
    value = F.expr("(p - q) * (p - q) div (p + q)")
    over = shared.filter("p > q").select("lang", "source", "ordinal", value.alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    return over.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)


def source_pairs(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """Each source with every other of its language, and the sum over all kept terms."""
    sources = groups.withColumn("p", share("0", "total")).groupBy("lang").agg(
        F.array_sort(F.collect_list(F.struct("source", "p"))).alias("sources"),
        F.max("v").alias("v"),
        F.min("first").alias("first"),
    )
    cells = shared.groupBy("lang", "block").agg(
        F.collect_list("source").alias("at_source"), F.collect_list("ordinal").alias("ordinal"), F.collect_list("p").alias("p")
    )
    # A language without kept terms has one block without cells, so that its pairs appear.
    bare = sources.filter("v = 0").select("lang")
    blocks = cells.unionByName(bare, allowMissingColumns=True).join(sources, "lang")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from sums(row)

    def sums(row: dict) -> Iterator[pa.RecordBatch]:
        names = [pair["source"] for pair in row["sources"]]
        table = block_shares(row, names)
        for k, name in enumerate(names):
            others = names[:k] + names[k + 1 :]
            value = divergence(table[k], np.delete(table, k, 0)).sum(1)
            columns = [
                pa.array([row["lang"]] * len(others), pa.string()),
                pa.array([name] * len(others), pa.string()),
                pa.array(others, pa.string()),
                pa.array(value, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "item", "value"])

    found = blocks.mapInArrow(compare, "lang string, source string, item string, value long")
    whole = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = whole.withColumn("rank", F.row_number().over(order))
    return ranked.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")


def block_shares(row: dict, names: list[str]) -> np.ndarray:
    """Sources by terms of one block: the share of no occurrences where there is no cell."""
    if row["block"] is None:
        return np.zeros((len(names), 0), np.int64)
    start = row["block"] * WIDTH
    table = np.empty((len(names), min(WIDTH, row["v"] - start)), np.int64)
    table[:] = np.array([pair["p"] for pair in row["sources"]], np.int64)[:, None]
    place = {name: k for k, name in enumerate(names)}
    at = np.array([place[name] for name in row["at_source"]])
    table[at, np.array(row["ordinal"]) - row["first"] - start] = row["p"]
    return table


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); shares are at most 10^9 + 1, so squares fit 64 bits."""
    return (p - q) * (p - q) // (p + q)
