"""Upserts as joins: insert-only, update-matched, conditional update, and all in one pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from yieldmill.functions.exprs import same_or_both_null
from yieldmill.operators.audit import observed
from yieldmill.session import keeping_counts, materialise

# What a merge does with a row.
KEEP, UPDATE, INSERT = "keep", "update", "insert"


def rows_to_insert(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    nullable: Sequence[str] = (),
    zero_is_null: bool = False,
    dedupe: bool = False,
) -> DataFrame:
    """Source rows whose key is not in the target.

    A NULL in a key matches nothing, except in the ``nullable`` columns, where two
    NULLs match.  Source rows that share a new key are all kept unless ``dedupe``.
    The target side carries only its distinct keys.
    """
    keys = target.select(*[F.col(name).alias(f"_t_{name}") for name in on]).distinct()
    match = F.lit(True)
    for name in on:
        theirs = keys[f"_t_{name}"]
        if name in nullable:
            match = match & same_or_both_null(source[name], theirs, zero_is_null)
        else:
            match = match & (source[name] == theirs)
    new = source.join(keys, match, "left_anti")
    return new.dropDuplicates(list(on)) if dedupe else new


def upsert_insert(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    nullable: Sequence[str] = (),
    dedupe: bool = False,
) -> DataFrame:
    """Target rows unchanged plus the source rows with a new key."""
    new = rows_to_insert(target, source, on, nullable, dedupe=dedupe)
    return target.unionByName(new.select(*target.columns))


def upsert_update(
    target: DataFrame,
    source: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    values: Mapping[str, str] | Sequence[str],
    when: Callable[[Column, Column], Column] | None = None,
    only: Column | None = None,
) -> DataFrame:
    """Target with ``values`` taken from the matching source row.

    ``on`` and ``values`` map target columns to source columns (a list stands for
    equal names).  ``when(old, new)`` limits the update to pairs for which it is
    true; ``only`` limits it to part of the target.  The key columns themselves
    may be among ``values``.  Two source rows for one target row are an error, as
    in a MERGE, and end the job.
    """
    on = on if isinstance(on, Mapping) else {name: name for name in on}
    values = values if isinstance(values, Mapping) else {name: name for name in values}
    # Grouping on the key leaves the rows where the join needs them, and a key that
    # is frequent in the source shrinks to one row before the shuffle.
    incoming = source.groupBy(*[F.col(theirs).alias(f"_k_{ours}") for ours, theirs in on.items()])
    incoming = incoming.agg(
        F.count(F.lit(1)).alias("_matches"),
        F.any_value(F.struct(*[F.col(name) for name in sorted(set(source.columns))])).alias("_new"),
    )
    match = F.lit(True)
    for name in on:
        match = match & (target[name] == incoming[f"_k_{name}"])
    if only is not None:
        match = match & only
    old = F.struct(*[target[name] for name in target.columns])
    pairs = target.join(incoming, match, "left").select(old.alias("_old"), "_matches", "_new")
    update = F.col("_matches").isNotNull()
    if when is not None:
        update = update & F.coalesce(when(F.col("_old"), F.col("_new")), F.lit(False))
    update = F.when(
        F.col("_matches") > 1, F.raise_error(F.lit("several source rows update one target row"))
    ).otherwise(update)
    columns = []
    for field in target.schema.fields:
        column = F.col(f"_old.{field.name}")
        if field.name in values:
            new = F.col(f"_new.{values[field.name]}").cast(field.dataType)
            column = F.when(F.col("_update"), new).otherwise(column)
        columns.append(column.alias(field.name))
    return pairs.withColumn("_update", update).select(*columns)


def status_changed(name: str, null_safe: bool = False) -> Callable[[Column, Column], Column]:
    """Condition for a conditional update: the column differs.

    A NULL on either side is no difference unless ``null_safe``.
    """

    def differs(old: Column, new: Column) -> Column:
        if null_safe:
            return ~old[name].eqNullSafe(new[name])
        return old[name] != new[name]

    return differs


@dataclass(frozen=True)
class Merge:
    """Result of one pass: the target's rows, the new source rows, and both counts."""

    target: DataFrame
    new: DataFrame
    updated: int
    inserted: int

    @property
    def rows(self) -> DataFrame:
        """The whole content after the merge."""
        return self.target.unionByName(self.new)


def merge_actions(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    values: Sequence[str] = (),
    when: Callable[[Column, Column], Column] | None = None,
    insert_when: Callable[[Column], Column] | None = None,
    nullable: Sequence[str] = (),
) -> DataFrame:
    """Every target row and every new source row with the action of a merge.

    One full join of both sides on the key gives ``action``, ``old`` (the target row, with
    ``values`` taken from the source row where the action is an update) and ``new`` (the
    source row).  ``when(old, new)`` limits updates, ``insert_when(new)`` inserts.  A NULL
    in a key matches nothing, except in ``nullable`` columns.  Source rows that share a
    new key are all inserted; two that would update one target row end the job.
    """
    key = Window.partitionBy(*on)
    incoming = source.select(
        F.struct(*source.columns).alias("_new"),
        *[F.col(name).alias(f"_s_{name}") for name in on],
        F.count(F.lit(1)).over(key).alias("_matches"),
        F.row_number().over(key.orderBy(*on)).alias("_place"),
    )
    known = target.select(
        F.struct(*target.columns).alias("_old"), *[F.col(name).alias(f"_t_{name}") for name in on]
    )
    match = F.lit(True)
    for name in on:
        ours, theirs = F.col(f"_t_{name}"), F.col(f"_s_{name}")
        match = match & (ours.eqNullSafe(theirs) if name in nullable else ours == theirs)
    pairs = known.join(incoming, match, "full_outer")
    old, new = F.col("_old"), F.col("_new")
    update = old.isNotNull() & new.isNotNull() & F.lit(bool(values))
    if when is not None:
        update = update & F.coalesce(when(old, new), F.lit(False))
    if values:
        twice = F.raise_error(F.lit("several source rows update one target row")).cast("boolean")
        update = F.when(old.isNotNull() & (F.col("_matches") > 1), twice).otherwise(update)
    insert = F.lit(True) if insert_when is None else F.coalesce(insert_when(new), F.lit(False))
    action = F.when(old.isNull(), F.when(insert, INSERT)).when(update, UPDATE).otherwise(KEEP)
    fields = [
        (
            F.when(F.col("action") == UPDATE, new[field.name].cast(field.dataType)).otherwise(old[field.name])
            if field.name in values
            else old[field.name]
        ).alias(field.name)
        for field in target.schema.fields
    ]
    # A target row that meets several source rows, none of which changes it, stays one row.
    first = old.isNull() | F.coalesce(F.col("_place") == 1, F.lit(True))
    rows = pairs.withColumn("action", action).filter(F.col("action").isNotNull() & first)
    return rows.select("action", F.struct(*fields).alias("old"), new.alias("new"))


def merge(target: DataFrame, source: DataFrame, on: Sequence[str], **how) -> Merge:
    """``merge_actions``, written once; the counts are observed in that write."""
    seen = Observation("merge")
    counts = [F.count(F.when(F.col("action") == kind, 1)).alias(kind) for kind in (UPDATE, INSERT)]
    actions = merge_actions(target, source, on, **how).observe(seen, *counts)
    with keeping_counts(target.sparkSession):
        written = materialise(actions, "merge", ("action",))
    found = observed(seen)
    return Merge(
        written.filter(F.col("action") != INSERT).select("old.*"),
        written.filter(F.col("action") == INSERT).select("new.*"),
        found.get(UPDATE, 0),
        found.get(INSERT, 0),
    )
