"""Quality classifier: histogram gradient-boosted trees over document statistics.

The fit uses at most ``FIT_ROWS`` labelled rows, those with the smallest hash of
their id, so the driver holds a matrix of bounded size.  Scoring runs over all
rows in Python workers: counts of a whole text, ratios, then a walk of all trees
at once.  Labels, language, source and id never enter a score.

Defined results: null and empty texts are scored by the statistics of an empty
text; a null label or a label row without id is no example; several equal label
rows of one id count once and contradicting ones count once each; without
labels, or with one label only, all scores are the smoothed share of label 1.
Repeated document rows get one result row each; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldmill.llm import boosting
from yieldmill.llm.statistics import COUNTS, text_counts, with_counts

FIT_ROWS = 16_384  # bound of the sample the trees are fitted on
FOLDS = 5
REJECT_BELOW = 0.3


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from; a row without id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def features(counts: np.ndarray) -> np.ndarray:
    """Sizes on a log scale and shares, from the columns of COUNTS."""
    c = dict(zip(COUNTS, counts.T.astype(np.float64)))
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["n_chars"], 1)
    lines = np.maximum(c["n_lines"], 1)
    return np.column_stack(
        [
            np.log1p(c["n_words"]),
            np.log1p(c["n_lines"]),
            c["word_chars"] / words,
            c["n_words"] / lines,
            c["n_symbols"] / chars,
            c["n_marked"] / words,
            c["n_dup_lines"] / lines,
            c["n_repeat_words"] / words,
            c["n_distinct"] / words,
            c["n_digits"] / chars,
            c["n_upper"] / chars,
            c["n_stops"] / words,
            c["n_commas"] / words,
            c["n_long"] / words,
            c["n_short"] / words,
            c["n_short_lines"] / lines,
        ]
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    fit_rows: int = FIT_ROWS,
) -> boosting.Trees:
    """Trees fitted on a bounded sample of the labelled rows that are not held out."""
    examples = (
        labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label"))
        .where("_id IS NOT NULL AND _label IS NOT NULL")
        .where(~held_out(F.col("_id")))
        .distinct()
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(fit_rows)
    )
    # At most fit_rows pairs of numbers: the broadcast has a fixed bound.
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_body")).join(
        F.broadcast(examples), "_id"
    )
    sample = (
        with_counts(rows, ["_id", "_label"], "_body")
        .dropDuplicates()
        .orderBy(F.xxhash64("_id"), "_id", "_label", *COUNTS)
        .limit(fit_rows)
        .toArrow()
    )
    counts = np.column_stack([sample.column(name).to_numpy() for name in COUNTS])
    y = (sample.column("_label").to_numpy() == 1).astype(np.float64)
    return boosting.fit(features(counts), y)


def score(
    docs: DataFrame, model: boosting.Trees, keep: Sequence[str], text: str = "text"
) -> DataFrame:
    """The ``keep`` columns and ``score``, between 0 and 1, of every whole text."""
    source = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("score", T.DoubleType())])
    names = [*keep, "score"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.score(features(text_counts(batch.column(batch.num_columns - 1))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], names=names)

    return source.mapInArrow(walk, schema)


def classify(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: id, held_out, score, and predicted (1 from the threshold on)."""
    scored = score(docs, fit(docs, labels, doc_id=doc_id, text=text), [doc_id], text)
    return scored.select(
        doc_id,
        held_out(F.col(doc_id)).alias("held_out"),
        "score",
        (F.col("score") >= REJECT_BELOW).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    model = fit(docs, labels, doc_id=doc_id, text=text)
    at = docs.columns.index(text)

    def accepted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.score(features(text_counts(batch.column(at))))
            yield batch.filter(pa.array(found >= REJECT_BELOW))

    return docs.mapInArrow(accepted, docs.schema)
