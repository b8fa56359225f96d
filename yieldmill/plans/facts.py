"""Run-card fact: moves of a window with the keys of all dimensions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldmill.functions.exprs import or_zero, valid_move
from yieldmill.functions.prodtime import in_window, production_start, window_days
from yieldmill.operators.audit import Batch, with_audit
from yieldmill.operators.joins import (
    in_pairs,
    lookup_key,
    not_in,
    union_all,
    with_group_max,
    with_not_in,
)
from yieldmill.plans.dims import ACTIVE, GROUP_SEQUENCE, group_codes

# Codes of documents and start operations.
START_TYPES = ["LAT", "PACK"]
MATERIAL_LOTS = ["MAT", "UDP"]
PLAIN_LOT = "MAT"
WIP_MATERIAL = "WIP"
DUMMY_DOCUMENT = "DUMMY"
OPERATION_LENGTH = 4
LOOK_BACK_DAYS = 1000
OTHER_SEQUENCE = 999

# What a run card and its document have in common.
LOT_KEYS = ["PRODUCT_PART_NO", "EER_NO", "JIT_CELL_NO"]

# Plants whose fact has the material branch and removes equal rows at the end.
WITH_MATERIAL = ("WH",)

MOVE_COLUMNS = [
    "DATE_BEGIN",
    "MPT_PRODUCT_PART_NO",
    "PRODUCT_PART_NO",
    "JIT_CELL_NO",
    "LAT_LOT_TYPE",
    "EER_NO",
    "RUN_NO",
    "OPERATION_NO",
    "ROUTING_SEQ",
    "MACHINE_NO",
    "INPUT",
    "OUTPUT",
    "SCRAP",
    "TRANSFER_DATE",
    "DATE_IN",
    "DATE_OUT",
]


def start_operations(start_ops: DataFrame, docs: DataFrame, as_of: date) -> DataFrame:
    """Operation numbers that open the LAT and PACK transactions of recent documents."""
    created = F.col("CREATED_DATE")
    day = F.lit(as_of)
    recent = docs.filter(
        (created > F.date_sub(day, LOOK_BACK_DAYS).cast("timestamp_ntz"))
        & (created < day.cast("timestamp_ntz"))
        & (F.col("MATERIAL_TYPE") == WIP_MATERIAL)
        & (F.col("LAT_LOT_TYPE") != PLAIN_LOT)
        & (F.col("EERNO") != DUMMY_DOCUMENT)
    )
    rows = start_ops.filter(
        F.col("TYPE").isin(START_TYPES) & (F.length("OPERATION_NO") == OPERATION_LENGTH)
    )
    rows = in_pairs(rows, {"PRODUCT_PART_NO": "PRODUCT_PART_NO", "EER_NO": "EERNO"}, recent)
    return rows.select("OPERATION_NO").distinct()


def _material_doc(document: str) -> Column:
    """Documents of material and die lots; ``document`` is the column of their number."""
    return (
        F.col("LAT_LOT_TYPE").isin(MATERIAL_LOTS)
        & (F.col(document) != DUMMY_DOCUMENT)
        & (F.col("MATERIAL_TYPE") == WIP_MATERIAL)
    )


def _documented(cards: DataFrame, docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted run cards with the lot type of their document, and whether one is of material.

    ``wanted`` has the RUN_NO and PRODUCT_PART_NO to look for: cards are reduced to
    them and documents to those cards before either is aggregated, so a day's moves
    do not shuffle the whole history.  Only distinct rows matter to the callers, so
    repeated cards and documents are removed before they can multiply.
    """
    card = (
        cards.select("RUN_NO", "PRODUCT_PART_NO", "EER_NO", "JIT_CELL_NO", "MPT_PRODUCT_PART_NO")
        .join(wanted, ["RUN_NO", "PRODUCT_PART_NO"], "left_semi")
        .distinct()
    )
    doc = (
        docs.withColumnRenamed("EERNO", "EER_NO")
        .withColumn("_material", F.coalesce(_material_doc("EER_NO"), F.lit(False)))
        .select(*LOT_KEYS, "LAT_LOT_TYPE", "_material")
        .join(card.select(*LOT_KEYS), LOT_KEYS, "left_semi")
        .groupBy(*LOT_KEYS, "LAT_LOT_TYPE")
        .agg(F.bool_or("_material").alias("_material"))
    )
    return card.join(doc, LOT_KEYS)


def _moves_of(wip: DataFrame, window: tuple[datetime, datetime]) -> DataFrame:
    """Valid moves of the window, with the columns the facts read."""
    inside = _in_days(wip, window) & in_window("TRANSFER_DATE", window)
    return wip.filter(inside & valid_move()).select(
        "RUN_NO",
        "PRODUCT_PART_NO",
        "OPERATION_NO",
        "ROUTING_SEQ",
        "MACHINE_NO",
        "INPUT",
        "SCRAP",
        "TRANSFER_DATE",
        "DATE_IN",
        "DATE_OUT",
    )


def _in_days(moves: DataFrame, window: tuple[datetime, datetime]) -> Column:
    """The days of the window, where moves are stored by day: a filter on partitions."""
    if "TRANSFER_DAY" not in moves.columns:
        return F.lit(True)
    first, last = window_days(window)
    return F.col("TRANSFER_DAY").between(F.lit(first), F.lit(last))


def _with_documents(
    moves: DataFrame, cards: DataFrame, docs: DataFrame, wanted: DataFrame, keep: Column
) -> DataFrame:
    """Moves of documented run cards for which ``keep`` holds; ``wanted`` holds their keys."""
    keys = ["RUN_NO", "PRODUCT_PART_NO"]
    documented = _documented(cards, docs, wanted.select(*keys).distinct())
    joined = moves.join(documented, keys).filter(keep)
    return joined.withColumns(
        {
            "DATE_BEGIN": production_start("TRANSFER_DATE"),
            "OUTPUT": (or_zero("INPUT") - or_zero("SCRAP")).try_cast("decimal(15,5)"),
            "INPUT": or_zero("INPUT"),
            "SCRAP": or_zero("SCRAP"),
        }
    ).select(*MOVE_COLUMNS)


def wip_moves(
    wip: DataFrame,
    cards: DataFrame,
    docs: DataFrame,
    start_ops: DataFrame,
    window: tuple[datetime, datetime],
    as_of: date,
) -> DataFrame:
    """Distinct valid moves of run cards, without LAT and PACK start operations.

    The output is the input less the scrap.
    """
    moves = _moves_of(wip, window)
    ordinary = not_in(moves, "OPERATION_NO", start_operations(start_ops, docs, as_of))
    return _with_documents(ordinary, cards, docs, moves, F.lit(True)).distinct()


def material_moves(
    wip: DataFrame, cards: DataFrame, docs: DataFrame, window: tuple[datetime, datetime]
) -> DataFrame:
    """Distinct valid moves of material and die lots."""
    moves = _moves_of(wip, window)
    return _with_documents(moves, cards, docs, moves, F.col("_material")).distinct()


def wip_or_material_moves(
    wip: DataFrame,
    cards: DataFrame,
    docs: DataFrame,
    start_ops: DataFrame,
    window: tuple[datetime, datetime],
    as_of: date,
) -> DataFrame:
    """Rows of ``wip_moves`` and of ``material_moves`` in one pass, not yet distinct.

    Both branches have the same columns, so their union without repeats is one join
    with either condition.
    """
    listed = start_operations(start_ops, docs, as_of)
    moves = _moves_of(wip, window)
    flagged = with_not_in(moves, "OPERATION_NO", listed, "_ordinary")
    return _with_documents(flagged, cards, docs, moves, F.col("_ordinary") | F.col("_material"))


def trans_totals(
    trans: DataFrame,
    cards: DataFrame,
    docs: DataFrame,
    wip: DataFrame,
    operations: DataFrame,
    window: tuple[datetime, datetime],
) -> DataFrame:
    """LAT and PACK transactions summed per run card and code.

    A transaction counts once for every matching move, card and document, as in a
    plain join of the four tables.  Each side is reduced to one row per run before
    the join, with the number of its rows as a factor, so a run with many moves and
    many transactions does not multiply in the shuffle.  Moves and cards are reduced
    to the runs of the window, and documents to those cards, before they are summed.
    """
    codes = list(GROUP_SEQUENCE.values())
    accepted = trans.filter(
        _in_days(trans, window)
        & in_window("TRANSFER_DATE", window)
        & F.col("OPERATION_NO").isin(codes)
        & (F.col("WIP_ALREADY") == "Y")
        & (F.col("ACCEPT_ALREADY") == "Y")
    )

    def whole(name: str):
        return F.coalesce(F.col(name), F.lit(0)).cast("long")

    lost = whole("SCRAP") + whole("OQA_SAMPLE") + whole("OQA_DEFECT") + whole("PCK")
    sums = accepted.groupBy("RUN_NO", "OPERATION_NO").agg(
        F.sum(whole("INPUT")).alias("_input"),
        F.sum(whole("OUTPUT")).alias("_output"),
        F.sum(lost).alias("_scrap"),
        F.max("TRANSFER_DATE").alias("TRANSFER_DATE"),
    )
    wanted = accepted.select("RUN_NO").distinct()
    moved = (
        wip.select("RUN_NO", "OPERATION_NO", "DATE_IN", "DATE_OUT")
        .join(wanted, "RUN_NO", "left_semi")
        .join(group_codes(operations), "OPERATION_NO")
        .groupBy("RUN_NO", F.col("OPERATION_WIP_TRANS").alias("OPERATION_NO"))
        .agg(
            F.count(F.lit(1)).alias("_moves"),
            F.max("DATE_IN").alias("DATE_IN"),
            F.max("DATE_OUT").alias("DATE_OUT"),
        )
    )
    runs = (
        cards.join(wanted, "RUN_NO", "left_semi")
        .groupBy("MPT_PRODUCT_PART_NO", *LOT_KEYS, "RUN_NO")
        .agg(F.count(F.lit(1)).alias("_cards"))
    )
    lots = (
        docs.select("PRODUCT_PART_NO", F.col("EERNO").alias("EER_NO"), "JIT_CELL_NO", "LAT_LOT_TYPE")
        .join(runs.select(*LOT_KEYS), LOT_KEYS, "left_semi")
        .groupBy(*LOT_KEYS, "LAT_LOT_TYPE")
        .agg(F.count(F.lit(1)).alias("_docs"))
    )
    joined = (
        sums.join(moved, ["RUN_NO", "OPERATION_NO"]).join(runs, "RUN_NO").join(lots, LOT_KEYS)
    )
    factor = F.col("_moves") * F.col("_cards") * F.col("_docs")
    return joined.select(
        "MPT_PRODUCT_PART_NO",
        "PRODUCT_PART_NO",
        "JIT_CELL_NO",
        "LAT_LOT_TYPE",
        "EER_NO",
        "RUN_NO",
        "OPERATION_NO",
        (F.col("_input") * factor).alias("INPUT"),
        (F.col("_output") * factor).alias("OUTPUT"),
        (F.col("_scrap") * factor).alias("SCRAP"),
        "TRANSFER_DATE",
        "DATE_IN",
        "DATE_OUT",
    )


def resolve_operation(totals: DataFrame, start_ops: DataFrame) -> DataFrame:
    """Replace the transaction codes by the greatest active start operation of the document."""
    route = ["PRODUCT_PART_NO", "EER_NO"]
    active = start_ops.filter(F.col("STATUS") == ACTIVE)
    rows = totals
    for kind in GROUP_SEQUENCE:
        marked = active.filter(F.col("TYPE") == kind)
        rows = with_group_max(rows, marked, route, "OPERATION_NO", f"_{kind}")
    code = F.col("OPERATION_NO")
    lat, pack = GROUP_SEQUENCE["LAT"], GROUP_SEQUENCE["PACK"]
    return rows.withColumns(
        {
            "OPERATION_NO": F.when(code == lat, F.col("_LAT"))
            .when(code == pack, F.col("_PACK"))
            .otherwise(code),
            "ROUTING_SEQ": F.when(code.isin(lat, pack), code.try_cast("int")).otherwise(
                OTHER_SEQUENCE
            ),
        }
    ).drop("_LAT", "_PACK")


def trans_moves(
    trans: DataFrame,
    cards: DataFrame,
    docs: DataFrame,
    wip: DataFrame,
    operations: DataFrame,
    start_ops: DataFrame,
    window: tuple[datetime, datetime],
) -> DataFrame:
    """LAT and PACK totals in the form of moves; they have no machine."""
    totals = trans_totals(trans, cards, docs, wip, operations, window)
    return (
        resolve_operation(totals, start_ops)
        .withColumns(
            {
                "DATE_BEGIN": production_start("TRANSFER_DATE"),
                "MACHINE_NO": F.lit(""),
                "INPUT": F.col("INPUT").try_cast("decimal(15,5)"),
                "OUTPUT": F.col("OUTPUT").try_cast("decimal(15,5)"),
                "SCRAP": F.col("SCRAP").try_cast("decimal(15,5)"),
            }
        )
        .select(*MOVE_COLUMNS)
    )


def all_moves(
    wip: DataFrame,
    trans: DataFrame,
    cards: DataFrame,
    docs: DataFrame,
    operations: DataFrame,
    start_ops: DataFrame,
    window: tuple[datetime, datetime],
    as_of: date,
    material: bool = False,
) -> DataFrame:
    """Moves and transactions; with the material branch equal rows are removed at the end."""
    trans_rows = trans_moves(trans, cards, docs, wip, operations, start_ops, window)
    # The few transactions are dealt as their join leaves the moves, which then stay in place.
    trans_rows = trans_rows.repartition("RUN_NO", "PRODUCT_PART_NO")
    if material:
        rows = wip_or_material_moves(wip, cards, docs, start_ops, window, as_of)
        return union_all([rows, trans_rows], distinct=True)
    rows = wip_moves(wip, cards, docs, start_ops, window, as_of)
    return union_all([rows, trans_rows])


def fact_runcard(
    moves: DataFrame,
    dates: DataFrame,
    lines: DataFrame,
    products: DataFrame,
    routing: DataFrame,
    cards: DataFrame,
    machines: DataFrame,
    etl_date: datetime,
    plant: str,
) -> DataFrame:
    """Moves with date, line, routing and run-card keys, and a machine key where known.

    Moves that miss one of the other keys are left out, as are those whose time
    lies in no production day.
    """

    def own(dim: DataFrame) -> DataFrame:
        return dim.filter(F.col("PLANT") == plant)

    rows = moves.withColumn("_day", F.to_date("DATE_BEGIN"))
    rows = lookup_key(rows, dates, {"_day": "DATE_BEGIN"}, ["DATE_KEY"])
    rows = lookup_key(rows, own(lines), {"JIT_CELL_NO": "LINE_NO"}, ["LINE_NO_KEY"])
    # Cards meet their products first: moves, which lie by run and product already, are then
    # not dealt again for either key.
    numbered = cards.select("RUNCARD_NO", "PRODUCT_PART_NO_KEY", "RUNCARD_NO_KEY").join(
        own(products).select("PRODUCT_PART_NO", "PRODUCT_PART_NO_KEY"), "PRODUCT_PART_NO_KEY"
    )
    rows = lookup_key(
        rows,
        numbered,
        {"RUN_NO": "RUNCARD_NO", "PRODUCT_PART_NO": "PRODUCT_PART_NO"},
        ["PRODUCT_PART_NO_KEY", "RUNCARD_NO_KEY"],
    )
    steps = routing.withColumn("_sequence", F.col("OPERATION_SEQ").try_cast("int"))
    rows = lookup_key(
        rows,
        steps,
        {
            "OPERATION_NO": "OPERATION_NO",
            "EER_NO": "EER_NO",
            "LAT_LOT_TYPE": "LOT_TYPE",
            "ROUTING_SEQ": "_sequence",
            "PRODUCT_PART_NO_KEY": "PRODUCT_PART_NO_KEY",
        },
        ["ROUTE_OPERATION_NO_KEY"],
    )
    rows = lookup_key(rows, machines, {"MACHINE_NO": "MACHINE_NO"}, ["MACHINE_NO_KEY"], "left")
    return rows.select(
        "DATE_KEY",
        "LINE_NO_KEY",
        "ROUTE_OPERATION_NO_KEY",
        "RUNCARD_NO_KEY",
        "MACHINE_NO_KEY",
        F.col("INPUT").alias("INPUT_QTY"),
        F.col("OUTPUT").alias("OUTPUT_QTY"),
        F.col("SCRAP").alias("SCRAP_QTY"),
        "DATE_IN",
        "DATE_OUT",
        F.lit(str(etl_date)).cast("timestamp_ntz").alias("ETL_DATE"),
        F.lit(None).cast("string").alias("EN_OPERATE"),
    )


def audited_fact(fact: DataFrame, batch: Batch, plant: str) -> DataFrame:
    """Fact rows with audit columns."""
    name = f"SFC_WIP_RUNCARD_FACT_{plant}"
    return with_audit(fact, name, f"process_{name}", batch)
