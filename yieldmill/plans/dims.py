"""Dimension plans.

Each ``*_source`` function gives the rows that the sources offer now; each
``dim_*`` function gives the new rows to append, or the whole new content of the
plant where existing rows change as well.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldmill.functions.exprs import differs_or_null
from yieldmill.functions.prodtime import in_window
from yieldmill.operators.audit import Batch, with_audit
from yieldmill.operators.joins import lookup_key, week_of
from yieldmill.operators.keys import DATE_KEY_BASE, KEY_BASE, assign_keys
from yieldmill.operators.lineage import run_lineage
from yieldmill.operators.merge import Merge, merge, rows_to_insert, status_changed, upsert_update
from yieldmill.plans.schemas import KEY_BLOCK

# Codes of the start-operation and operation tables.
GROUP_SEQUENCE = {"LAT": "480", "PACK": "490"}
YIELD_START, YIELD_END = "YIELD", "ENDYI"
YIELD_FLAG = "YIELD"
PSEUDO_APP = "PSUDO"
ACTIVE = "ACTIVE"


def _new_rows(source, target, on, key, base, scope, order_by, nullable=()):
    new = rows_to_insert(target, source, on, nullable)
    return assign_keys(new, target, key, order_by, base, scope)


def _session(dim: str, plant: str | None = None) -> str:
    return f"master_{dim}_{plant}" if plant else f"master_{dim}"


# --- date -----------------------------------------------------------------


def production_days(first: date, last: date, spark) -> DataFrame:
    """Production days from ``first`` to ``last`` with their bounds."""
    day = F.explode(F.sequence(F.lit(first), F.lit(last)))
    return day_bounds(spark.range(1).select(day.alias("DATE_BEGIN")))


def day_bounds(days: DataFrame) -> DataFrame:
    """Add the end and the 07:00 bounds to rows with a DATE_BEGIN."""
    seven = F.expr("INTERVAL '7' HOUR")
    begin = F.col("DATE_BEGIN").cast("timestamp_ntz") + seven
    end = F.date_add("DATE_BEGIN", 1)
    until_seven = end.cast("timestamp_ntz") + seven
    return days.withColumns(
        {
            "DATE_END": end,
            "DATETIME_BEGIN": begin,
            "DATETIME_END": until_seven,
            "TIME_BEGIN": begin,
            "TIME_END": until_seven,
        }
    )


def date_source(weeks: DataFrame, days: DataFrame) -> DataFrame:
    """Days with the labels of the one work week that holds them."""
    return week_of(days, weeks).select(
        "DATE_BEGIN",
        "DATE_END",
        "WW",
        "MONTH",
        "QUARTER",
        "YEAR",
        "DATETIME_BEGIN",
        "DATETIME_END",
        "TIME_BEGIN",
        "TIME_END",
    )


def dim_date(
    weeks: DataFrame, days: DataFrame, target: DataFrame, batch: Batch, plant: str = "WN"
) -> DataFrame:
    """New days; one plant's calendar serves all plants."""
    rows = with_audit(
        date_source(weeks, days),
        f"EIS_WORK_WEEK_{plant}",
        _session("MFG_DATE_DIM"),
        batch,
        ["DATE_BEGIN"],
    )
    return _new_rows(
        rows, target, ["DATE_BEGIN"], "DATE_KEY", DATE_KEY_BASE, None, ["DATE_BEGIN", "WW"]
    )


# --- line, machine, operation ----------------------------------------------


def line_source(cells: DataFrame, plant: str) -> DataFrame:
    return cells.select(
        F.col("JIT_CELL_NO").alias("LINE_NO"),
        "ROOM",
        "LOCATION",
        F.lit(plant).alias("PLANT"),
        F.col("LINE_NO").alias("LINE_CODE"),
        F.col("JIT_CELL_DIGIT").alias("LINE_DIGIT"),
    )


def merge_line(cells: DataFrame, target: DataFrame, batch: Batch, plant: str) -> Merge:
    """Known lines of the plant refreshed, and new lines with their keys."""
    found = merge(
        target.filter(F.col("PLANT") == plant),
        line_source(cells, plant),
        ["LINE_NO", "PLANT"],
        values=["ROOM", "LOCATION", "LINE_CODE", "LINE_DIGIT"],
    )
    rows = with_audit(
        found.new,
        f"EIS_JIT_CELL_{plant}",
        _session("MFG_LINE_DIM", plant),
        batch,
        ["PLANT", "LINE_NO", "LINE_CODE"],
    )
    order = ["LINE_NO", "LINE_CODE", "ROOM", "LOCATION", "LINE_DIGIT"]
    new = assign_keys(rows, found.target, "LINE_NO_KEY", order, KEY_BASE[plant])
    return replace(found, new=new.select(*target.columns))


def dim_line(cells: DataFrame, target: DataFrame, batch: Batch, plant: str) -> DataFrame:
    """Whole content for the plant: known lines refreshed, new lines added."""
    return merge_line(cells, target, batch, plant).rows


def machine_source(machines: DataFrame) -> DataFrame:
    return machines.select(
        "MACHINE_NO", "MACHINE_NAME", F.lit(None).cast("string").alias("MACHINE_GROUP")
    )


def dim_machine(
    machines: DataFrame,
    target: DataFrame,
    batch: Batch,
    plant: str,
    on: tuple[str, ...] = ("MACHINE_NO",),
) -> DataFrame:
    """New machines.  A number known from any plant is not added again."""
    session = _session("MFG_MACHINE_DIM", plant)
    rows = with_audit(
        machine_source(machines), f"EIS_MACHINE_{plant}", session, batch, ["MACHINE_NO"]
    )
    return _new_rows(
        rows,
        target,
        list(on),
        "MACHINE_NO_KEY",
        KEY_BASE[plant],
        F.col("INF_SESS_NAME") == session,
        ["MACHINE_NO", "MACHINE_NAME"],
    )


def operation_source(operations: DataFrame, plant: str) -> DataFrame:
    return operations.select(
        F.trim("OPERATION_NO").alias("OPERATION_NO"),
        F.trim("OPERATION_NAME").alias("OPERATION_NAME"),
        F.lit(plant).alias("PLANT"),
    )


def dim_operation(operations: DataFrame, target: DataFrame, batch: Batch, plant: str) -> DataFrame:
    """New operations of the plant."""
    rows = with_audit(
        operation_source(operations, plant),
        f"EIS_OPERATION_{plant}",
        _session("MFG_OPERATION_DIM", plant),
        batch,
        ["PLANT", "OPERATION_NO"],
    )
    return _new_rows(
        rows,
        target,
        ["OPERATION_NO", "PLANT"],
        "OPERATION_NO_KEY",
        KEY_BASE[plant],
        F.col("PLANT") == plant,
        ["OPERATION_NO", "OPERATION_NAME"],
    )


# --- product ----------------------------------------------------------------


def product_source(
    overall: DataFrame,
    families: DataFrame,
    parts: DataFrame,
    plant: str,
    active_only: bool = True,
) -> DataFrame:
    """Products with family and part attributes.

    The daily load keeps products of active families only; the initial load and
    the status update take all.
    """
    family = families.select(
        F.col("FAMILY_PRODUCT_ID").alias("_family"), "FAMILY_NAME", "STATUS"
    )
    how = "left"
    if active_only:
        # The filter rules out products without a family, so the join is inner.
        family, how = family.filter(F.col("STATUS") == ACTIVE), "inner"
    part = parts.select(
        F.col("PRODUCT_PART_NO").alias("_part"),
        "GL_PRODUCT_CODE",
        "FIRST_JOB_DIGIT",
        "TG_SITE",
        "PRODUCT_PART_DESC",
    )
    products = overall.select(
        F.trim("PRODUCT_PART_NO").alias("PRODUCT_PART_NO"),
        F.col("PRODUCT_ID").alias("MPT_PART_NO"),
        F.col("PROGRAM_NAME").alias("PRODUCT_NAME"),
        F.col("PART_TYPE_NAME").alias("TAB"),
        "FAMILY_PRODUCT_ID",
    )
    return (
        products.join(family, F.col("FAMILY_PRODUCT_ID") == F.col("_family"), how)
        .join(part, F.col("PRODUCT_PART_NO") == F.col("_part"), "left")
        .select(
            "PRODUCT_PART_NO",
            "MPT_PART_NO",
            "PRODUCT_NAME",
            "FAMILY_NAME",
            F.lit(plant).alias("PLANT"),
            "TAB",
            "GL_PRODUCT_CODE",
            "FIRST_JOB_DIGIT",
            "TG_SITE",
            "PRODUCT_PART_DESC",
            "STATUS",
        )
    )


def merge_product(
    overall: DataFrame,
    families: DataFrame,
    parts: DataFrame,
    target: DataFrame,
    batch: Batch,
    plant: str,
    initial: bool = False,
    null_safe: bool = False,
) -> Merge:
    """Known products of the plant with their changed status, and new products with keys.

    The status comes from products of all families; those of closed ones are new only
    in the initial load.
    """
    found = merge(
        target.filter(F.col("PLANT") == plant),
        product_source(overall, families, parts, plant, active_only=False),
        ["PRODUCT_PART_NO", "PLANT"],
        values=["STATUS"],
        when=status_changed("STATUS", null_safe),
        insert_when=None if initial else lambda new: new["STATUS"] == ACTIVE,
    )
    rows = with_audit(
        found.new,
        f"EIS_PRODUCT_OVERALL_{plant}",
        _session("MFG_PRODUCT_DIM", plant),
        batch,
        ["PLANT", "PRODUCT_PART_NO", "MPT_PART_NO"],
    )
    order = ["PRODUCT_PART_NO", "MPT_PART_NO", "PRODUCT_NAME", "FAMILY_NAME"]
    new = assign_keys(rows, found.target, "PRODUCT_PART_NO_KEY", order, KEY_BASE[plant])
    return replace(found, new=new.select(*target.columns))


def dim_product(*sources_and_target, **how) -> DataFrame:
    """Whole content for the plant: changed status updated, new products added."""
    return merge_product(*sources_and_target, **how).rows


# --- routing ----------------------------------------------------------------


def group_codes(operations: DataFrame) -> DataFrame:
    """Operations of the two transaction groups with their transaction code."""
    code = F.when(F.col("OPERATION_GROUP") == "LAT", GROUP_SEQUENCE["LAT"]).otherwise(
        GROUP_SEQUENCE["PACK"]
    )
    return operations.filter(F.col("OPERATION_GROUP").isin(list(GROUP_SEQUENCE))).select(
        F.col("OPERATION_NO"), code.alias("OPERATION_WIP_TRANS")
    )


def canonical_routing(routing: DataFrame, operations: DataFrame, docs: DataFrame) -> DataFrame:
    """Routing steps with name, lot type and sequence.

    Spellings of a document number that differ in case are one; the greatest
    spelling, name and lot type stand for all.
    """
    names = operations.select(F.col("OPERATION_NO").alias("_op"), "OPERATION_NAME")
    lots = docs.select(
        F.col("PRODUCT_PART_NO").alias("_product"), F.col("EERNO").alias("_eer"), "LAT_LOT_TYPE"
    )
    codes = group_codes(operations).withColumnRenamed("OPERATION_NO", "_code_op")
    # The group keeps only the greatest value of each side, so the sides may be
    # reduced to one row per key before they are joined.
    names = names.groupBy("_op").agg(F.max("OPERATION_NAME").alias("OPERATION_NAME"))
    lots = lots.groupBy("_product", "_eer").agg(F.max("LAT_LOT_TYPE").alias("LAT_LOT_TYPE"))
    steps = (
        routing.select("OPERATION_NO", "PRODUCT_PART_NO", "EER_NO", "ROUTING_SEQ")
        .join(names, F.col("OPERATION_NO") == F.col("_op"), "left")
        .join(
            lots,
            (F.col("PRODUCT_PART_NO") == F.col("_product")) & (F.col("EER_NO") == F.col("_eer")),
            "left",
        )
        .join(codes.distinct(), F.col("OPERATION_NO") == F.col("_code_op"), "left")
    )
    sequence = F.coalesce(F.col("OPERATION_WIP_TRANS"), F.col("ROUTING_SEQ").cast("string"))
    return (
        steps.withColumns({"_eer_upper": F.upper("EER_NO"), "OPERATION_SEQ": sequence})
        .groupBy("_eer_upper", "OPERATION_NO", "PRODUCT_PART_NO", "OPERATION_SEQ")
        .agg(
            F.max("EER_NO").alias("EER_NO"),
            F.max("OPERATION_NAME").alias("OPERATION_NAME"),
            F.max("LAT_LOT_TYPE").alias("LOT_TYPE"),
        )
        .drop("_eer_upper")
    )


def yield_span(routing: DataFrame, start_ops: DataFrame) -> DataFrame:
    """Routing steps with the yield start and end of their route and the yield flag."""
    route = ["PRODUCT_PART_NO", "EER_NO"]
    steps = routing.select(*route, "ROUTING_SEQ", "OPERATION_NO")

    def marker(kind: str, name: str) -> DataFrame:
        marked = start_ops.filter(F.col("TYPE") == kind).select(*route, "OPERATION_NO")
        return steps.join(marked, [*route, "OPERATION_NO"]).select(
            *route, F.col("ROUTING_SEQ").alias(name)
        )

    inside = F.col("ROUTING_SEQ").between(
        F.col("ROUTING_SEQ_START_YIELD"), F.col("ROUTING_SEQ_END_YIELD")
    )
    return (
        steps.join(marker(YIELD_START, "ROUTING_SEQ_START_YIELD"), route, "left")
        .join(marker(YIELD_END, "ROUTING_SEQ_END_YIELD"), route, "left")
        .withColumn("YIELD", F.when(inside, F.lit(YIELD_FLAG)))
    )


def routing_source(
    routing: DataFrame,
    operations: DataFrame,
    docs: DataFrame,
    start_ops: DataFrame,
    products: DataFrame,
    plant: str,
) -> DataFrame:
    """Routing steps with yield span and product key."""
    spans = yield_span(routing, start_ops).select(
        "PRODUCT_PART_NO",
        "EER_NO",
        "OPERATION_NO",
        "ROUTING_SEQ_START_YIELD",
        "ROUTING_SEQ_END_YIELD",
        "YIELD",
    )
    steps = canonical_routing(routing, operations, docs).join(
        spans, ["PRODUCT_PART_NO", "EER_NO", "OPERATION_NO"], "left"
    )
    own = products.filter(F.col("PLANT") == plant)
    return lookup_key(
        steps, own, {"PRODUCT_PART_NO": "PRODUCT_PART_NO"}, ["PRODUCT_PART_NO_KEY"], "left"
    )


def dim_routing(source: DataFrame, target: DataFrame, batch: Batch, plant: str) -> DataFrame:
    """New routing steps; a step without a product key matches one without."""
    session = _session("MFG_ROUTING_OPERATION_DIM", plant)
    business = ["OPERATION_NO", "EER_NO", "OPERATION_SEQ", "PRODUCT_PART_NO_KEY"]
    rows = with_audit(source, f"EIS_ROUTING_OPERATION_{plant}", session, batch, business)
    new = _new_rows(
        rows,
        target,
        business,
        "ROUTE_OPERATION_NO_KEY",
        KEY_BASE[plant],
        F.col("INF_SESS_NAME") == session,
        ["OPERATION_NO", "PRODUCT_PART_NO", "EER_NO", "OPERATION_SEQ"],
        nullable=("PRODUCT_PART_NO_KEY",),
    )
    return new.drop("PRODUCT_PART_NO")


# --- run card ---------------------------------------------------------------


def runcard_source(
    cards: DataFrame,
    docs: DataFrame,
    products: DataFrame,
    lines: DataFrame,
    window: tuple[datetime, datetime],
    etl_date: datetime,
    plant: str,
) -> DataFrame:
    """Distinct run cards created in the window, with lot type, product and line keys."""
    rows = cards.filter(
        in_window("CREATED_DATE", window) & differs_or_null("APP_NAME", PSEUDO_APP)
    ).select("PRODUCT_PART_NO", "EER_NO", "CREATED_DATE", "RUN_NO", "JIT_CELL_NO")
    lots = docs.select(
        F.col("EERNO").alias("EER_NO"), "PRODUCT_PART_NO", "JIT_CELL_NO", "LAT_LOT_TYPE"
    ).distinct()
    rows = rows.distinct().join(lots, ["EER_NO", "PRODUCT_PART_NO", "JIT_CELL_NO"])
    return keyed_runs(rows, products, lines, plant).select(
        F.col("RUN_NO").alias("RUNCARD_NO"),
        "PRODUCT_PART_NO_KEY",
        "EER_NO",
        "LAT_LOT_TYPE",
        "CREATED_DATE",
        "LINE_NO_KEY",
        F.lit(None).cast("string").alias("FROM_RUN"),
        F.lit(str(etl_date)).cast("timestamp_ntz").alias("ETL_DATE"),
        F.lit(plant).alias("PLANT"),
    )


def keyed_runs(rows: DataFrame, products: DataFrame, lines: DataFrame, plant: str) -> DataFrame:
    """Add product and line keys of the plant; rows without both are left out."""
    own_products = products.filter(F.col("PLANT") == plant)
    own_lines = lines.filter(F.col("PLANT") == plant)
    rows = lookup_key(
        rows, own_products, {"PRODUCT_PART_NO": "PRODUCT_PART_NO"}, ["PRODUCT_PART_NO_KEY"]
    )
    return lookup_key(rows, own_lines, {"JIT_CELL_NO": "LINE_NO"}, ["LINE_NO_KEY"])


def dim_runcard(source: DataFrame, target: DataFrame, batch: Batch, plant: str) -> DataFrame:
    """New run cards of the plant, with the block that their key lies in.

    The audit columns, which are wider than the card, are added after the numbering.
    """
    new = _new_rows(
        source,
        target,
        ["RUNCARD_NO", "PLANT"],
        "RUNCARD_NO_KEY",
        KEY_BASE[plant],
        F.col("PLANT") == plant,
        [
            "RUNCARD_NO",
            "PRODUCT_PART_NO_KEY",
            "EER_NO",
            "LINE_NO_KEY",
            "LAT_LOT_TYPE",
            "CREATED_DATE",
        ],
    )
    new = with_audit(
        new,
        f"EIS_WIP_FA_RUNCARD_{plant}",
        _session("SFC_RUNCARD_DIM", plant),
        batch,
        ["PLANT", "RUNCARD_NO", "EER_NO", "PRODUCT_PART_NO_KEY", "LINE_NO_KEY", "CREATED_DATE"],
    )
    return new.withColumn("KEY_BLOCK", key_block("RUNCARD_NO_KEY"))


def key_block(key: str) -> Column:
    """Block of a dense key: keys given together lie in one partition of the dimension."""
    return F.floor(F.col(key) / KEY_BLOCK).cast("int")


def converted_runs(
    target: DataFrame,
    edges: DataFrame,
    docs: DataFrame,
    products: DataFrame,
    lines: DataFrame,
    window: tuple[datetime, datetime] | None,
    plant: str,
    latest: str = "max",
) -> DataFrame:
    """Run cards converted in the window with the attributes of their current run."""
    own = target.filter(F.col("PLANT") == plant)
    current = run_lineage(own, edges, window, latest)
    lots = docs.select(
        F.col("EERNO").alias("EER_NO"), "PRODUCT_PART_NO", "JIT_CELL_NO", "LAT_LOT_TYPE"
    ).distinct()
    rows = (
        edges.select("RUN_NO", "CONVERTED_DATE", "EER_NO", "PRODUCT_PART_NO", "JIT_CELL_NO")
        .join(current, F.col("RUN_NO") == F.col("current_run_no"))
        .join(lots, ["EER_NO", "PRODUCT_PART_NO", "JIT_CELL_NO"])
    )
    return keyed_runs(rows, products, lines, plant).select(
        "RUNCARD_NO_KEY",
        "original_runcard_no",
        "current_run_no",
        "CONVERTED_DATE",
        "EER_NO",
        "LAT_LOT_TYPE",
        "PRODUCT_PART_NO_KEY",
        "LINE_NO_KEY",
    )


def apply_lineage(target: DataFrame, converted: DataFrame, plant: str) -> DataFrame:
    """Run-card dimension in which converted cards carry their current run."""
    return upsert_update(
        target,
        converted,
        {"RUNCARD_NO": "original_runcard_no", "RUNCARD_NO_KEY": "RUNCARD_NO_KEY"},
        {
            "RUNCARD_NO": "current_run_no",
            "CREATED_DATE": "CONVERTED_DATE",
            "EER_NO": "EER_NO",
            "FROM_RUN": "original_runcard_no",
            "PRODUCT_PART_NO_KEY": "PRODUCT_PART_NO_KEY",
            "LINE_NO_KEY": "LINE_NO_KEY",
            "LAT_LOT_TYPE": "LAT_LOT_TYPE",
        },
        only=target["PLANT"] == plant,
    )


def lineage_changes(
    target: DataFrame, converted: DataFrame, plant: str
) -> tuple[DataFrame, DataFrame]:
    """Keys of the converted cards, and these cards with their current run.

    Only the key blocks of the converted cards are read; ``converted`` should be
    materialised, because both results need it.
    """
    keys = converted.select(
        F.lit(plant).alias("PLANT"),
        key_block("RUNCARD_NO_KEY").alias("KEY_BLOCK"),
        "RUNCARD_NO_KEY",
        F.col("original_runcard_no").alias("RUNCARD_NO"),
    ).distinct()
    # The comparison marks the small side as selective, so blocks without a card are skipped.
    cards = target.join(keys.filter(F.col("KEY_BLOCK") >= 0), keys.columns, "left_semi")
    return keys, apply_lineage(cards.select(*target.columns), converted, plant)
