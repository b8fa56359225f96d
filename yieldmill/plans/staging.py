"""Staging loads: source rows plus audit columns, by load mode."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldmill.functions.exprs import valid_move
from yieldmill.functions.prodtime import (
    in_window,
    production_window,
    span_window,
    transfer_day,
    until,
    window_days,
)
from yieldmill.operators.audit import Batch, with_audit
from yieldmill.operators.loads import (
    Between,
    LoadReport,
    append,
    replace_values,
    replace_where,
)
from yieldmill.sources.lake import Table

# Tables loaded by production day, tables with a cut-off; all
# others are refreshed whole.
BY_DAY = ("EIS_WIP_FA", "EIS_WIP_FA_WIP_TRANS")
WITH_CUT_OFF = {"EIS_WIP_FA_RUNCARD": "CREATED_DATE"}
INITIAL_BATCH_ID = 1


def staged(source: DataFrame, name: str, plant: str, batch: Batch, suffix: str = "") -> DataFrame:
    """Source rows with the plant and the audit columns."""
    table = f"{name}_{plant}"
    rows = source.withColumn("PLANT", F.lit(plant))
    rows = with_audit(rows, table, f"Staging_{table}{suffix}", batch)
    return rows.withColumn("TRANSFER_DAY", transfer_day("TRANSFER_DATE")) if name in BY_DAY else rows


def stage_full(table: Table, source: DataFrame, name: str, plant: str, batch: Batch) -> LoadReport:
    """Full refresh of one plant; run cards only up to the last 07:00."""
    if name in WITH_CUT_OFF:
        source = source.filter(until(WITH_CUT_OFF[name], batch.as_of.date()))
    rows = staged(source, name, plant, batch)
    return replace_values(table, rows, {"PLANT": plant})


def stage_day(table: Table, source: DataFrame, name: str, plant: str, batch: Batch) -> LoadReport:
    """Moves of the last production day, replacing an earlier load of the batch."""
    window = production_window(batch.as_of.date())
    rows = source.filter(in_window("TRANSFER_DATE", window) & valid_move())
    return replace_values(
        table,
        staged(rows, name, plant, batch),
        {"PLANT": plant, "INF_BATCH_ID": batch.batch_id},
    )


def stage_span(
    table: Table,
    source: DataFrame,
    name: str,
    plant: str,
    batch: Batch,
    first: date,
    last: date,
) -> LoadReport:
    """Rerun: moves of a span of production days, replacing all rows in it."""
    window = span_window(first, last)
    inside = in_window("TRANSFER_DATE", window)
    rows = source.filter(inside & valid_move())
    return replace_where(
        table,
        staged(rows, name, plant, batch, "_rerun"),
        inside & (F.col("PLANT") == plant),
        {"PLANT": plant, "TRANSFER_DAY": Between(*window_days(window))},
    )


def stage_initial(
    table: Table, source: DataFrame, name: str, plant: str, batch: Batch
) -> LoadReport:
    """First back-fill of the moves up to the last 07:00, under batch id 1."""
    first = Batch(INITIAL_BATCH_ID, batch.as_of, batch.user)
    rows = source.filter(until("TRANSFER_DATE", batch.as_of.date()) & valid_move())
    return append(table, staged(rows, name, plant, first, "_initial"))
