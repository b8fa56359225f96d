"""Line dedup: lines equal or nearly equal to an earlier line are removed.

Lines are compared by their words, A-Z as a-z, so spacing does not count.  The
earliest line by document id and line number stays.  Lines with fewer than
``EXACT_WORDS`` words are never touched; from ``NEAR_WORDS`` words on, a line
also falls to an earlier one within one inserted, deleted or replaced word.

Near lines meet through their deletion neighbourhood: each line emits the hash of
itself and of itself without one word, with the place of the gap.  Lines with the
same hash and gap differ in one word there; a line whose own hash is another's
variant lacks one word.  Smallest positions are aggregated per key, so no pairs
inside a key are made, and every match is verified on the words.

Two sketches keep the neighbourhood small without losing a match: within one
edit, the first or the second half of a line is unchanged, so only lines that
share a half with another line emit variants, and only variants that were
emitted twice travel.

Defined results: null and empty texts have no lines with words and stay as they
are; a document that loses its last line with a word goes, as nothing is left of
it; rows that repeat an id share their positions, so they do not remove each
other's lines; rows without id are left alone and remove nothing; extra columns
are kept by ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldmill.llm import sketch
from yieldmill.llm.textops import Block, Hasher, Words, blocks, mix
from yieldmill.session import materialise

EXACT_WORDS = 3
NEAR_WORDS = 8
COUNTERS_PER_KEY = 32


class Lines:
    """Lines with a word: their rows, numbers and ranges of words."""

    def __init__(self, block: Block, words: Words):
        breaks = np.flatnonzero(block.data == 10)
        # Lines of a row are numbered by the breaks before their first word.
        before = np.searchsorted(breaks, words.starts)
        at_row = np.searchsorted(breaks, block.offsets[:-1])
        number = before - at_row[words.row]
        new = np.ones(len(number), bool)
        new[1:] = (number[1:] != number[:-1]) | (words.row[1:] != words.row[:-1])
        self.first = np.flatnonzero(new)
        self.end = np.append(self.first[1:], len(number)) if len(self.first) else self.first
        self.size = self.end - self.first
        self.row, self.number = words.row[self.first], number[self.first]


def half_keys(hasher: Hasher, sums: np.ndarray, lines: Lines) -> np.ndarray:
    """Four keys per line; lines of at most one edit have one in common.

    The halves of a line of n words, and its halves as the longer partner of a
    line of n - 1 words.
    """
    keys = []
    for size in (lines.size, lines.size - 1):
        head = size // 2
        tag = mix(size.astype(np.uint64) + np.uint64(1))
        keys.append(mix(hasher.ranges(sums, lines.first, lines.first + head) ^ tag))
        keys.append(mix(hasher.ranges(sums, lines.end - (size - head), lines.end) + tag))
    return np.stack(keys, 1)


def position_key(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    return mix(mix(doc.view(np.uint64)) ^ line.astype(np.uint64))


def line_rows(docs: DataFrame) -> DataFrame:
    """Every line that may match: doc, line, words, hash, and the keys of its halves."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=True)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for block in blocks(batch.column(1)):
                words = block.words()
                lines = Lines(block, words)
                sums = hasher.prefix(words.hashes(hasher))
                keys = half_keys(hasher, sums, lines)
                keep = lines.size >= EXACT_WORDS
                near = lines.size >= NEAR_WORDS
                columns = [
                    pa.array(ids[block.first + lines.row]),
                    pa.array(lines.number.astype(np.int32)),
                    pa.array(lines.size.astype(np.int32)),
                    pa.array(hasher.ranges(sums, lines.first, lines.end).view(np.int64)),
                    *(pa.array(keys[:, i].view(np.int64), mask=~near) for i in range(4)),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc", "line", "size", "h", "k0", "k1", "k2", "k3"]
                ).filter(pa.array(keep))

    return docs.mapInArrow(cut, "doc long, line int, size int, h long, k0 long, k1 long, k2 long, k3 long")


def near_candidates(distinct: DataFrame) -> DataFrame:
    """Lines that share a half with another line, and a few more."""
    able = distinct.where(F.col("k0").isNotNull()).select("doc", "line", "k0", "k1", "k2", "k3")
    counters = sketch.counters_for(4 * able.count(), COUNTERS_PER_KEY)
    spark = distinct.sparkSession

    def keys_of(batch: pa.RecordBatch) -> np.ndarray:
        return np.stack([batch.column(i).to_numpy().view(np.uint64) for i in range(2, 6)], 1)

    seen_twice = spark.sparkContext.broadcast(
        sketch.merged(able, lambda batch: iter([keys_of(batch).ravel()]), counters, (2,))
    )

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = sketch.look_up(seen_twice.value, counters, 1, keys_of(batch))
            yield batch.filter(pa.array(code.any(1))).select(["doc", "line"])

    return able.mapInArrow(shared, "doc long, line int")


def words_at(docs: DataFrame, places: DataFrame) -> DataFrame:
    """doc, line and words of the given lines; the words in lower case, joined by one space."""
    spark = docs.sparkSession
    n = places.count()
    counters = sketch.counters_for(n, 16)
    send = spark.sparkContext.broadcast
    in_doc = send(
        sketch.merged(
            places.select("doc"),
            lambda batch: iter([mix(batch.column(0).to_numpy().view(np.uint64))]),
            counters,
            (1,),
        )
    )
    in_line = send(
        sketch.merged(
            places.select("doc", "line"),
            lambda batch: iter([position_key(batch.column(0).to_numpy(), batch.column(1).to_numpy())]),
            counters,
            (1,),
        )
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = batch.column(0).to_numpy().view(np.uint64)
            batch = batch.filter(pa.array(sketch.look_up(in_doc.value, counters, 1, mix(plain)) > 0))
            ids = batch.column(0).to_numpy()
            for block in blocks(batch.column(1)):
                words = block.words()
                lines = Lines(block, words)
                owner = ids[block.first + lines.row]
                wanted = sketch.look_up(in_line.value, counters, 1, position_key(owner, lines.number)) > 0
                wanted = np.flatnonzero(wanted & (lines.size >= NEAR_WORDS))
                texts = []
                for i in wanted:
                    low, high = words.starts[lines.first[i]], words.ends[lines.end[i] - 1]
                    # bytes.lower() changes A-Z only.
                    texts.append(b" ".join(block.data[low:high].tobytes().split()).lower().decode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner[wanted]), pa.array(lines.number[wanted].astype(np.int32)), pa.array(texts, pa.string())],
                    names=["doc", "line", "words"],
                )

    found = docs.mapInArrow(read, "doc long, line int, words string")
    return found.join(places, ["doc", "line"]).dropDuplicates(["doc", "line"])


def variants(block: Block, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, gap and hash of each line (gap -1) and of each line without one word."""
    words = block.words()
    hashes = words.hashes(hasher)
    sums = hasher.prefix(hashes)
    low, high = words.bounds[:-1], words.bounds[1:]
    whole = hasher.ranges(sums, low, high)
    i, row = np.arange(len(hashes)), words.row
    _, down = hasher.powers(len(sums) + 1)
    raw = (sums[i] - sums[low[row]]) * down[low[row]] + (sums[high[row]] - sums[i + 1]) * down[low[row] + 1]
    short = mix(raw + (words.counts[row] - 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    rows = np.concatenate((np.arange(block.rows), row))
    gaps = np.concatenate((np.full(block.rows, -1), i - low[row]))
    return rows, gaps, np.concatenate((whole, short))


def within_one_edit(a: list[str], b: list[str]) -> bool:
    """Whether one inserted, deleted or replaced word at most makes the lists equal."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    same = 0
    while same < len(a) and a[same] == b[same]:
        same += 1
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


def near_matches(lines: DataFrame) -> DataFrame:
    """doc and line of each line that has an earlier one within one edit."""
    counters = sketch.counters_for(
        lines.agg(F.sum(F.length("words"))).first()[0] or 0, COUNTERS_PER_KEY / 6
    )

    def counted(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        hasher = Hasher(lower=True)
        for block in blocks(batch.column(2)):
            rows, _, found = variants(block, hasher)
            order = np.lexsort((found, rows))
            rows, found = rows[order], found[order]
            yield found[np.append(True, (rows[1:] != rows[:-1]) | (found[1:] != found[:-1]))]

    seen_twice = lines.sparkSession.sparkContext.broadcast(sketch.merged(lines, counted, counters, (2,)))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=True)
        for batch in batches:
            doc, line = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for block in blocks(batch.column(2)):
                rows, gaps, found = variants(block, hasher)
                twice = sketch.look_up(seen_twice.value, counters, 1, found) > 0
                at = block.first + rows[twice]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found[twice].view(np.int64)),
                        pa.array(gaps[twice].astype(np.int32)),
                        pa.array(doc[at]),
                        pa.array(line[at]),
                    ],
                    names=["v", "gap", "doc", "line"],
                )

    keys = lines.select("doc", "line", "words").mapInArrow(emit, "v long, gap int, doc long, line int")
    keys = materialise(keys.select("v", "gap", F.struct("doc", "line").alias("at")), "line-variants")
    own = F.col("gap") < 0
    by_gap = keys.groupBy("v", "gap").agg(F.min("at").alias("replaced"))
    by_hash = by_gap.groupBy("v").agg(
        F.min(F.when(own, F.col("replaced"))).alias("shorter"),
        F.min(F.when(~own, F.col("replaced"))).alias("longer"),
    )
    # A whole line meets longer ones, a line without a word meets a shorter one
    # and those with another word in its place.
    partner = F.when(own, F.col("longer")).otherwise(F.least("shorter", "replaced"))
    earliest = (
        keys.join(by_gap, ["v", "gap"])
        .join(by_hash, "v")
        .select("at", partner.alias("partner"))
        .where("partner < at")
        .groupBy("at")
        .agg(F.min("partner").alias("partner"))
    )
    texts = lines.select(F.struct("doc", "line").alias("at"), "words")
    both = earliest.join(texts, "at").join(
        texts.select(F.col("at").alias("partner"), F.col("words").alias("other")), "partner"
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                within_one_edit(a.as_py().split(" "), b.as_py().split(" "))
                for a, b in zip(batch.column(2), batch.column(3))
            ]
            yield batch.filter(pa.array(good, pa.bool_())).select(["doc", "line"])

    return both.select("at.doc", "at.line", "words", "other").mapInArrow(verify, "doc long, line int")


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document that loses lines: ``doc`` and the sorted numbers of ``gone`` lines, from 0."""
    source = docs.select(
        F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("body")
    ).where("doc IS NOT NULL AND body IS NOT NULL")
    lines = materialise(line_rows(source), "lines")
    n = lines.count()
    # Equal lines have equal halves, so any row gives them.
    distinct = materialise(
        lines.groupBy("h", "size")
        .agg(
            F.min(F.struct("doc", "line")).alias("at"),
            F.count("*").alias("places"),
            *(F.min(f"k{i}").alias(f"k{i}") for i in range(4)),
        )
        .select("h", "size", "at.doc", "at.line", (F.col("places") > 1).alias("again"), "k0", "k1", "k2", "k3"),
        "distinct-lines",
        rows=n,
    )
    places = materialise(near_candidates(distinct), "line-places")
    near = near_matches(materialise(words_at(source, places), "line-words", rows=places.count()))
    near = materialise(near.withColumn("near", F.lit(True)), "near-lines", rows=n)
    judged = distinct.select("h", "size", "doc", "line", "again").join(near, ["doc", "line"], "left")
    firsts = judged.where("again OR near").select(
        "h", "size", F.struct("doc", "line").alias("first"), F.coalesce("near", F.lit(False)).alias("near")
    )
    out = lines.select("h", "size", "doc", "line").join(firsts, ["h", "size"])
    out = out.where(F.col("near") | (F.struct("doc", "line") > F.col("first")))
    return out.groupBy("doc").agg(F.sort_array(F.collect_set("line")).alias("gone"))


WORD = "[^ \\t-\\r]"


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", counts: bool = False) -> DataFrame:
    """The documents without repeated lines, with all their columns.

    With ``counts`` two columns follow: ``n_lines`` with a word and ``n_dropped``;
    documents that lost everything are then kept, with an empty text.
    """
    gone = materialise(repeated_lines(docs, doc_id, text), "lines-gone", rows=docs.count())
    at = docs.columns.index(doc_id)
    loses = sketch.id_filter(gone.select("doc"))

    def rows(losing: bool) -> DataFrame:
        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(loses(batch.column(at)) == losing))

        return docs.mapInArrow(pick, docs.schema)

    # Texts that lose nothing are not shuffled.
    gone = gone.withColumnRenamed("doc", "__llm_doc").withColumnRenamed("gone", "__llm_gone")
    # Only documents that lose lines are split again.
    kept = F.array_join(
        F.filter(
            F.split(text, "\n", -1), lambda line, i: ~F.array_contains("__llm_gone", i)
        ),
        "\n",
    )
    lost = F.col("__llm_gone").isNotNull()
    # Always dealt by id: the plan is the same at every size.
    joined = rows(True).join(gone.hint("merge"), F.col(doc_id) == F.col("__llm_doc"), "left")
    whole = rows(False).select(
        "*", F.lit(None).cast("long").alias("__llm_doc"), F.lit(None).cast("array<int>").alias("__llm_gone")
    )
    joined = joined.unionByName(whole)
    if counts:
        with_word = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda line: line.rlike(WORD))
        joined = joined.withColumn("n_lines", F.size(with_word).cast("long")).withColumn(
            "n_dropped", F.coalesce(F.size("__llm_gone"), F.lit(0)).cast("long")
        )
    joined = joined.withColumn(text, F.when(lost, kept).otherwise(F.col(text)))
    if not counts:
        joined = joined.where(~lost | F.col(text).rlike(WORD))
    return joined.drop("__llm_doc", "__llm_gone")
