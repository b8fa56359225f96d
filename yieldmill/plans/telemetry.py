"""Machine telemetry: messages to rows, control limits and the telemetry fact."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldmill.functions.exprs import machine_code
from yieldmill.functions.prodtime import incremental, ntz, production_date, shift_zone
from yieldmill.operators.audit import Batch, with_audit
from yieldmill.plans.schemas import TELEMETRY_MESSAGE, ddl

# The mark of a log line that carries a message, and the message after it.
MESSAGE_MARK = r"(?i)Collected:"
MESSAGE_BODY = r"(?i)Collected:\s*(\{.*\})"
NEW_STATUS = "N"


def extract_messages(lines: DataFrame) -> DataFrame:
    """Messages in log lines; a line without a readable message gives NULL fields."""
    marked = lines.filter(F.col("value").rlike(MESSAGE_MARK))
    body = F.regexp_extract("value", MESSAGE_BODY, 1)
    others = [name for name in lines.columns if name != "value"]
    parsed = marked.select(*others, F.from_json(body, TELEMETRY_MESSAGE).alias("_message"))
    return parsed.select(*others, "_message.*")


def explode_values(messages: DataFrame, zone: str | None = None) -> DataFrame:
    """One row per variable of each message.

    Messages without variables, and lines that could not be read, give no row.
    ``zone`` shifts the collection time to local time, here and nowhere else.
    """
    known = set(ddl(TELEMETRY_MESSAGE).fieldNames())
    others = [name for name in messages.columns if name not in known]
    rows = messages.withColumn("_value", F.explode("Values"))
    return rows.select(
        F.col("MachineName").alias("MACHINENAME"),
        shift_zone(F.col("CollectedDate"), zone).alias("COLLECTEDDATE"),
        "CEID",
        F.col("CollectionEventName").alias("COLLECTIONEVENTNAME"),
        "RPTID",
        F.col("_value.VID").alias("VID"),
        F.col("_value.Name").alias("NAME"),
        F.col("_value.Value").alias("VALUES"),
        *others,
    )


def extract_events(lines: DataFrame, zone: str | None = None) -> DataFrame:
    """Log lines to one row per variable; the same for batch and stream."""
    return explode_values(extract_messages(lines), zone)


def audited_events(
    events: DataFrame,
    session: str,
    batch: Batch,
    source: Column | None = None,
    arrival: Column | None = None,
) -> DataFrame:
    """Staged telemetry with audit columns; the source is the machine unless given.

    A stream passes the time of its micro-batch as ``arrival``: the incremental
    fact reads by it.
    """
    machine = machine_code("MACHINENAME") if source is None else source
    return with_audit(events, machine, f"staging_{session}", batch, created=arrival)


def control_limits(raw: DataFrame) -> DataFrame:
    """Control limits with whole-number bounds; text that is no number becomes NULL."""
    return raw.select(
        "MachineNo",
        "VariableName",
        F.col("SpecLCL").try_cast("int").alias("SpecLCL"),
        F.col("SpecUCL").try_cast("int").alias("SpecUCL"),
    )


def duplicate_limits(limits: DataFrame) -> DataFrame:
    """Machine and variable pairs with several limit rows; they multiply fact rows."""
    keys = ["MachineNo", F.lower("VariableName").alias("VariableName")]
    return limits.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def match_limits(
    events: DataFrame,
    limits: DataFrame,
    machine: str = "MachineNo",
    variable: str = "VariableName",
    ignore_case: bool = True,
    how: str = "left",
) -> DataFrame:
    """Add SpecLCL and SpecUCL by machine and variable.

    ``ignore_case`` compares variable names without case; without it the machine of
    the limits is put in upper case and the names have to be equal.
    """
    if ignore_case:
        keys = [F.col("MachineNo"), F.lower("VariableName")]
        name = F.lower(F.col(variable))
    else:
        keys = [F.upper("MachineNo"), F.col("VariableName")]
        name = F.col(variable)
    bounds = limits.select(
        keys[0].alias("_machine"), keys[1].alias("_variable"), "SpecLCL", "SpecUCL"
    )
    match = (F.col(machine) == F.col("_machine")) & (name == F.col("_variable"))
    return events.join(bounds, match, how).drop("_machine", "_variable")


def incremental_slice(
    staging: DataFrame, after: datetime | None, as_of: datetime
) -> DataFrame:
    """Staged rows that arrived after the watermark, up to the current minute.

    Staging by day of arrival is read from the watermark's day on.
    """
    day = "CREATE_DATE" if "CREATE_DATE" in staging.columns else None
    return staging.filter(incremental("DM_CREATED_DATE", after, as_of, day))


def collected_on(day: date, machine: str | None = None) -> Column:
    """Rows collected on a day, of one machine or of all; the day is a partition of staging."""
    rows = (F.col("COLLECTED_DAY") == F.lit(day)) & (F.col("COLLECTEDDATE") >= ntz(datetime(day.year, day.month, day.day))) & (
        F.col("COLLECTEDDATE") < ntz(datetime(day.year, day.month, day.day) + timedelta(days=1))
    )
    return rows if machine is None else rows & (machine_code("MACHINENAME") == machine)


def fact_events(
    staging: DataFrame,
    limits: DataFrame,
    batch: Batch,
    session: str,
    source: str,
    ignore_case: bool = True,
) -> DataFrame:
    """Telemetry fact: staged rows with day, hour, production day and limits.

    A missing limit counts as zero.  Record id and creation time stay those of the
    staged row, so the next slice can start where this one ends.
    """
    at = F.col("COLLECTEDDATE")
    rows = staging.select(
        machine_code("MACHINENAME").alias("MachineNo"),
        at.alias("CreateDate"),
        F.to_date(at).alias("Date"),
        at.alias("Second"),
        F.hour(at).alias("Time"),
        production_date(at).alias("Date_7"),
        F.col("CEID").alias("CeId"),
        F.col("COLLECTIONEVENTNAME").alias("CollectionEventName"),
        F.col("RPTID").alias("RptId"),
        F.col("VID").alias("Vid"),
        F.col("NAME").alias("VariableName"),
        F.col("VALUES").alias("Value"),
        F.lit(NEW_STATUS).alias("Status"),
        F.col("REC_ID").alias("_rec_id"),
        F.col("DM_CREATED_DATE").alias("_created"),
    )
    rows = match_limits(rows, limits, ignore_case=ignore_case).withColumns(
        {
            "SpecLCL": F.coalesce("SpecLCL", F.lit(0)),
            "SpecUCL": F.coalesce("SpecUCL", F.lit(0)),
        }
    )
    audited = with_audit(rows, source, session, batch, created=F.col("_created"))
    return audited.withColumn("REC_ID", F.col("_rec_id")).drop("_rec_id", "_created")

