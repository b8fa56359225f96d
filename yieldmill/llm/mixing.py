"""Mixing sources to target weights by a time-varying curriculum.

Each source has a schedule: its weight at every moment of training, linear
between stated points.  The integral of a schedule is the source's weight in the
whole mix; weights share the words to train on, and a source stops at ``limit``
times its own size.  A document's place in its source (order of md5 of its id)
is a number of words before it; the moment at which the source's cumulative
demand reaches that number is its training position.  Documents beyond the first
pass repeat, and the one at the end of a target is cut there.

Places are running sums, taken in two steps so that a source of any size spreads
over tasks: inside ranges of the md5, and over the sums of the ranges.

Defined results: null and empty texts have size 0 and positions like others, but
nothing is taken; a null source is one source, ordered last; null ids are ordered
first; repeated rows are separate documents, one after the other; without any word all
targets are 0; extra columns are not read, ``mixed_documents`` keeps them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldmill.session import materialise

Schedule = Sequence[tuple[float, float]]

# Weight over time from 0 to 1, dealt to the sources in turn.  Integrals: 5, 2, 1.
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 7.0), (1.0, 3.0)),
    ((0.0, 2.0), (1.0, 2.0)),
    ((0.0, 0.0), (0.5, 1.0), (1.0, 2.0)),
)
SHARE = 1.5
LIMIT = 2.0
RANGE_ROWS = 500  # documents of a range of md5 values, about
WORD = "[^ \\t-\\r]+"


def integral(schedule: Schedule) -> float:
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:]))


def moment(demand: Column, schedule: Schedule) -> Column:
    """The time at which the integral of ``schedule`` reaches ``demand``."""
    out, before = F.lit(float(schedule[-1][0])), integral(schedule)
    for (t0, w0), (t1, w1) in reversed(list(zip(schedule, schedule[1:]))):
        before = before - (t1 - t0) * (w0 + w1) / 2
        rest = F.greatest(demand - F.lit(before), F.lit(0.0))
        slope = (w1 - w0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0)))
        # Root of the quadratic in the form that stays stable for flat pieces.
        step = F.coalesce(F.try_divide(F.lit(2.0) * rest, F.lit(w0) + root), F.lit(0.0))
        here = F.least(F.lit(t0) + step, F.lit(t1))
        after = before + (t1 - t0) * (w0 + w1) / 2
        out = F.when(demand < F.lit(after), here).otherwise(out)
    return out


def source_targets(sizes: DataFrame, share: float, limit: float, schedules: Sequence[Schedule]) -> DataFrame:
    """source, source_size, kind (of schedule), target; ``sizes`` has source and source_size.

    Weights are shared out until no source is above its limit.  A round is one
    aggregation of three numbers; sources above the limit leave with it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = [integral(s) for s in schedules]
    kinds = sizes.withColumn("kind", ((F.row_number().over(order) - 1) % len(schedules)).cast("int"))
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("kind") + 1)
    table = materialise(kinds.withColumn("weight", weight), "mix-sources")
    cap = F.lit(limit) * F.col("source_size")
    words, all_weight = table.agg(F.sum("source_size"), F.sum("weight")).first()
    total, level, stopped = share * (words or 0), 0.0, -1
    full_words, full_weight, full = 0, 0.0, 0
    while full != stopped:
        stopped = full
        rest = (all_weight or 0.0) - full_weight
        level = (total - limit * full_words) / rest if rest > 0 else 0.0
        above = table.where(F.lit(level) * F.col("weight") > cap)
        full_words, full_weight, full = above.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0)), F.count("*")
        ).first()
    target = F.when(F.lit(level) * F.col("weight") > cap, cap).otherwise(F.lit(level) * F.col("weight"))
    return table.select("source", "source_size", "kind", target.alias("target"))


def assign(
    docs: DataFrame,
    keep: Sequence[str] = (),
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    share: float = SHARE,
    limit: float = LIMIT,
    schedules: Sequence[Schedule] = SCHEDULES,
) -> DataFrame:
    """Per document: id, size, source_size, target, and the ``copies`` the mix takes.

    A copy has its number, the words taken of it and its position in training.
    The columns in ``keep`` pass through and order rows of one id.
    """
    named = docs.select(
        F.col(doc_id).alias("doc"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.col(source).cast("string").alias("source"),
        F.coalesce(F.md5(F.col(doc_id).cast("string").cast("binary")), F.lit("")).alias("key"),
        *keep,
    )
    sized = materialise(named, "mix-sizes")
    rows = sized.count()
    digits = min(5, max(1, math.ceil(math.log(max(rows / RANGE_ROWS, 1), 16))))
    sized = sized.withColumn("range", F.substring("key", 1, digits))
    # One row per source and range: the only thing that is ordered over a whole source.
    sums = sized.groupBy("source", "range").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "source", "range", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")
    )
    sources = source_targets(
        sums.groupBy("source").agg(F.sum("words").alias("source_size")), share, limit, schedules
    )
    inside = (
        Window.partitionBy("source", "range")
        .orderBy("key", "doc", "size", *keep)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = sized.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))

    def beside(left: DataFrame, right: DataFrame, *columns: str) -> DataFrame:
        test = left["source"].eqNullSafe(right["source"])
        for column in columns:
            test = test & (left[column] == right[column])
        extra = [c for c in right.columns if c not in ("source", *columns)]
        return left.join(right, test).select(*(left[c] for c in left.columns), *(right[c] for c in extra))

    placed = beside(placed, beside(offsets, sources), "range")
    start = F.col("offset") + F.col("inside")
    budget = F.floor("target")
    curve = F.lit(None).cast("double")
    passes = F.sequence(F.lit(0), F.lit(max(math.ceil(limit), 1) - 1))

    def copy(number: Column) -> Column:
        before = start + number * F.col("source_size")
        words = F.greatest(F.least(F.col("size"), budget - before), F.lit(0))
        part = F.coalesce(F.try_divide(before.cast("double"), F.col("target")), F.lit(0.0))
        position = curve
        for kind, schedule in enumerate(schedules):
            position = F.when(
                F.col("kind") == kind, moment(part * F.lit(integral(schedule)), schedule)
            ).otherwise(position)
        return F.struct(number.alias("copy"), words.alias("words"), position.alias("position"))

    copies = F.filter(F.transform(passes, copy), lambda c: c["words"] > 0)
    return placed.select(
        F.col("doc").alias(doc_id), "source", "size", "source_size", "target", copies.alias("copies"), *keep
    )


def in_training_order(assigned: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Documents sorted by the position of their first copy; those without a copy come last."""
    first = F.when(F.size("copies") > 0, F.col("copies")[0]["position"])
    ranked = assigned.withColumn("first_position", first)
    order = [F.col("first_position").asc_nulls_last(), F.col(doc_id)]
    return ranked.repartitionByRange(*order).sortWithinPartitions(*order)


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The mix itself: one row per copy with the columns of ``docs``, in training order.

    A cut copy has the first words of its text.  Each row has its own copies,
    also where ids are null or repeat.
    """
    # Rows of one key are equal in all columns, so one of them stands for the others.
    whole = F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"})
    keyed = docs.withColumn("__llm_key", F.md5(whole.cast("binary")))
    assigned = assign(keyed, ["__llm_key"], doc_id=doc_id, text=text)
    copies = assigned.select(
        "__llm_key", F.col("size").alias("__llm_size"), F.explode("copies").alias("__llm_copy")
    )
    rows = keyed.dropDuplicates(["__llm_key"]).join(copies, "__llm_key")
    pieces = F.regexp_extract_all(F.col(text), F.lit("[ \\t-\\r]*[^ \\t-\\r]+"), 0)
    words = F.col("__llm_copy.words")
    cut = F.when(words < F.col("__llm_size"), F.array_join(F.slice(pieces, 1, words.cast("int")), "")).otherwise(F.col(text))
    order = [F.col("__llm_copy.position"), F.col(doc_id), F.col("__llm_key")]
    rows = rows.withColumn(text, cut).repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.select(*docs.columns)
