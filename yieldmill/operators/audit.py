"""Audit columns, batch control and load reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from yieldmill.functions.exprs import rec_id
from yieldmill.functions.prodtime import ntz, production_window


@dataclass(frozen=True)
class Batch:
    """Batch id, as-of time and user that a load writes into its rows."""

    batch_id: int
    as_of: datetime
    user: str = "admin"


def with_audit(
    df: DataFrame,
    source: str | Column,
    session: str,
    batch: Batch,
    keys: Sequence[str] | None = None,
    created: Column | None = None,
) -> DataFrame:
    """Append the ten audit columns.

    ``keys`` makes the record id repeatable; ``created`` keeps the creation time
    of the row's origin.
    """
    moment = ntz(batch.as_of)
    return df.withColumns(
        {
            "REC_ID": rec_id(keys),
            "SOURCE_TABLE_NAME": F.lit(source) if isinstance(source, str) else source,
            "INF_BATCH_ID": F.lit(batch.batch_id).cast("int"),
            "INF_SESS_NAME": F.lit(session),
            "DM_MODIFIED_BY": F.lit(batch.user),
            "DM_MODIFIED_DATE": moment,
            "DM_CREATED_BY": F.lit(batch.user),
            "DM_CREATED_DATE": moment if created is None else created,
            "DM_DATE_FROM": moment,
            "DM_DATE_TO": moment,
        }
    )


def next_batch(control: DataFrame, as_of: date) -> DataFrame:
    """The control row to add for the production day before ``as_of``, or no row.

    The id is the highest so far plus one; a window that is already listed gives
    an empty result, so a repeated run adds nothing.
    """
    start, end = production_window(as_of)
    listed = (F.col("DATE_FROM") == ntz(start)) & (F.col("DATE_TO") == ntz(end))
    state = control.agg(
        F.coalesce(F.max("INF_BATCH_ID"), F.lit(0)).alias("last"),
        F.coalesce(F.bool_or(listed), F.lit(False)).alias("known"),
    )
    return state.filter(~F.col("known")).select(
        (F.col("last") + 1).cast("int").alias("INF_BATCH_ID"),
        ntz(start).alias("DATE_FROM"),
        ntz(end).alias("DATE_TO"),
    )


def current_batch(control: DataFrame) -> int | None:
    """Highest batch id, None for an empty control table."""
    return scalar_max(control, "INF_BATCH_ID")


def scalar_max(df: DataFrame, column: str, where: Column | None = None):
    """Highest value of a column, None when no row has one."""
    rows = df if where is None else df.filter(where)
    return rows.agg(F.max(column)).first()[0]


def merge_preview(
    target: DataFrame, source: DataFrame, on: Sequence[str], changed: Sequence[str] = ()
) -> DataFrame:
    """Rows a merge would update and insert, as one row with two counts.

    Counts what the merge joins produce: a source row that meets several target
    rows counts once for each.  With ``changed`` only pairs that differ in one of
    these columns count as updates; NULL on either side is no difference.
    Both sides are counted per key first, so a frequent key is one row in the join.
    """
    if changed:
        return _preview_changed(target, source, list(on), list(changed))
    old = target.groupBy(*on).agg(F.count(F.lit(1)).alias("_old"))
    new = source.groupBy(*on).agg(F.count(F.lit(1)).alias("_new"))
    pairs = new.join(old, list(on), "left")
    return pairs.agg(
        F.coalesce(F.sum(F.col("_new") * F.col("_old")), F.lit(0)).alias("rows_to_update"),
        F.coalesce(F.sum(F.when(F.col("_old").isNull(), F.col("_new"))), F.lit(0)).alias(
            "rows_to_insert"
        ),
    )


def _preview_changed(
    target: DataFrame, source: DataFrame, on: list[str], changed: list[str]
) -> DataFrame:
    def counted(df: DataFrame, prefix: str) -> DataFrame:
        grouped = df.groupBy(*on, *changed).agg(F.count(F.lit(1)).alias(f"{prefix}rows"))
        return grouped.withColumnsRenamed({name: f"{prefix}{name}" for name in changed})

    pairs = counted(source, "s_").join(counted(target, "t_"), on, "left")
    differs = F.lit(False)
    for name in changed:
        differs = differs | F.coalesce(F.col(f"t_{name}") != F.col(f"s_{name}"), F.lit(False))
    return pairs.agg(
        F.coalesce(
            F.sum(F.when(differs, F.col("s_rows") * F.col("t_rows"))), F.lit(0)
        ).alias("rows_to_update"),
        F.coalesce(F.sum(F.when(F.col("t_rows").isNull(), F.col("s_rows"))), F.lit(0)).alias(
            "rows_to_insert"
        ),
    )


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows, and a count that is ready once they have been written.

    The count runs inside the write, so source and target are not scanned again.
    """
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def observed(observation: Observation) -> dict[str, int]:
    """What was counted in a write; nothing when the planner proved that there are no rows."""
    try:
        return observation.get
    except Py4JJavaError as error:
        # Spark leaves an empty input out of the plan, and the counts have no row then.
        if "AssertionError" not in str(error.java_exception):
            raise
        return {}


def rows_seen(observation: Observation) -> int:
    """Rows that ``counted`` saw in the write."""
    return observed(observation).get("rows", 0)


def load_report(before: DataFrame, after: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows before, after and added per group, such as session or source.

    Each side is counted on its own; only the counts are joined.
    """
    old = before.groupBy(*by).agg(F.count(F.lit(1)).alias("rows_before"))
    new = after.groupBy(*by).agg(F.count(F.lit(1)).alias("rows_after"))
    counts = old.unionByName(new, allowMissingColumns=True)
    return (
        counts.groupBy(*by)
        .agg(
            F.coalesce(F.sum("rows_before"), F.lit(0)).alias("rows_before"),
            F.coalesce(F.sum("rows_after"), F.lit(0)).alias("rows_after"),
        )
        .withColumn("rows_added", F.col("rows_after") - F.col("rows_before"))
    )
