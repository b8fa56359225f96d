"""Dimensions, facts, lineage and the yield mart."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor import views
from shopfloor.registry import query
from shopfloor.time_queries import start_sql
from shopfloor.views import PLANT, load, sql
from yieldmill.operators import joins, keys, lineage, loads, merge
from yieldmill.operators.audit import Batch, load_report as report
from yieldmill.operators.audit import merge_preview as preview
from yieldmill.operators.audit import current_batch, next_batch, with_audit
from yieldmill.plans import dims, facts, marts, schemas, staging
from yieldmill.session import materialise, scratch_path
from yieldmill.sources import Lake

BATCH = Batch(42, views.AS_OF)
WINDOW = views.WHOLE

# --- moves ------------------------------------------------------------------

START_OPS_SQL = """
    SELECT OPERATION_NO FROM start_ops
    WHERE TYPE IN ('LAT', 'PACK') AND length(OPERATION_NO) = 4
      AND (PRODUCT_PART_NO, EER_NO) IN (
          SELECT (PRODUCT_PART_NO, EERNO) FROM docs
          WHERE CREATED_DATE > DATE '1997-06-30' - 1000 AND CREATED_DATE < DATE '1997-06-30'
            AND MATERIAL_TYPE = 'WIP' AND LAT_LOT_TYPE <> 'MAT' AND EERNO <> 'DUMMY')"""


def move_sql(where: str, distinct: str = "DISTINCT") -> str:
    return f"""
        SELECT {distinct} {start_sql("a.TRANSFER_DATE")} AS DATE_BEGIN, b.MPT_PRODUCT_PART_NO,
               a.PRODUCT_PART_NO, b.JIT_CELL_NO, c.LAT_LOT_TYPE, b.EER_NO, a.RUN_NO,
               a.OPERATION_NO, a.ROUTING_SEQ, a.MACHINE_NO,
               CAST(coalesce(INPUT, 0) AS DECIMAL(15,5)) AS INPUT,
               CAST(coalesce(INPUT, 0) - coalesce(SCRAP, 0) AS DECIMAL(15,5)) AS OUTPUT,
               CAST(coalesce(SCRAP, 0) AS DECIMAL(15,5)) AS SCRAP,
               a.TRANSFER_DATE, a.DATE_IN, a.DATE_OUT
        FROM moves a
             JOIN cards b ON a.RUN_NO = b.RUN_NO AND a.PRODUCT_PART_NO = b.PRODUCT_PART_NO
             JOIN docs c ON a.PRODUCT_PART_NO = c.PRODUCT_PART_NO AND b.EER_NO = c.EERNO
                        AND b.JIT_CELL_NO = c.JIT_CELL_NO
        WHERE coalesce(INPUT, 0) > 0 AND OUTPUT >= 0 AND {where}"""


WIP_SQL = move_sql(f"a.OPERATION_NO NOT IN ({START_OPS_SQL})")
MATERIAL_SQL = move_sql("c.LAT_LOT_TYPE IN ('MAT', 'UDP') AND c.EERNO <> 'DUMMY' AND c.MATERIAL_TYPE = 'WIP'")

TOTALS_SQL = """
    SELECT b.MPT_PRODUCT_PART_NO, b.PRODUCT_PART_NO, b.JIT_CELL_NO, c.LAT_LOT_TYPE, b.EER_NO,
           b.RUN_NO, a.OPERATION_NO, sum(coalesce(a.INPUT, 0)) AS INPUT,
           sum(coalesce(a.OUTPUT, 0)) AS OUTPUT,
           sum(coalesce(a.SCRAP, 0) + coalesce(OQA_SAMPLE, 0) + coalesce(OQA_DEFECT, 0)
               + coalesce(PCK, 0)) AS SCRAP,
           max(a.TRANSFER_DATE) AS TRANSFER_DATE, max(d.DATE_IN) AS DATE_IN,
           max(d.DATE_OUT) AS DATE_OUT
    FROM transactions a JOIN cards b ON a.RUN_NO = b.RUN_NO
         JOIN docs c ON b.PRODUCT_PART_NO = c.PRODUCT_PART_NO AND b.EER_NO = c.EERNO
                    AND b.JIT_CELL_NO = c.JIT_CELL_NO
         JOIN moves d ON a.RUN_NO = d.RUN_NO
         JOIN operations e ON d.OPERATION_NO = e.OPERATION_NO
             AND a.OPERATION_NO = CASE e.OPERATION_GROUP WHEN 'LAT' THEN '480'
                                                         WHEN 'PACK' THEN '490' END
    WHERE WIP_ALREADY = 'Y' AND ACCEPT_ALREADY = 'Y'
    GROUP BY b.MPT_PRODUCT_PART_NO, b.PRODUCT_PART_NO, b.JIT_CELL_NO, c.LAT_LOT_TYPE, b.EER_NO,
             b.RUN_NO, a.OPERATION_NO"""

HIGHEST_SQL = """(SELECT max(OPERATION_NO) FROM start_ops s
    WHERE s.PRODUCT_PART_NO = m.PRODUCT_PART_NO AND s.EER_NO = m.EER_NO
      AND s.STATUS = 'ACTIVE' AND s.TYPE = '{kind}')"""
RESOLVED_SQL = f"""CASE m.OPERATION_NO WHEN '480' THEN {HIGHEST_SQL.format(kind="LAT")}
    WHEN '490' THEN {HIGHEST_SQL.format(kind="PACK")} ELSE m.OPERATION_NO END"""

TRANS_SQL = f"""
    SELECT {start_sql("m.TRANSFER_DATE")} AS DATE_BEGIN, MPT_PRODUCT_PART_NO, PRODUCT_PART_NO,
           JIT_CELL_NO, LAT_LOT_TYPE, EER_NO, RUN_NO, {RESOLVED_SQL} AS OPERATION_NO,
           CAST(OPERATION_NO AS INTEGER) AS ROUTING_SEQ, '' AS MACHINE_NO,
           CAST(INPUT AS DECIMAL(15,5)) AS INPUT, CAST(OUTPUT AS DECIMAL(15,5)) AS OUTPUT,
           CAST(SCRAP AS DECIMAL(15,5)) AS SCRAP, TRANSFER_DATE, DATE_IN, DATE_OUT
    FROM totals m"""

MOVE_VIEWS = "cards docs moves start_ops"
ALL_VIEWS = MOVE_VIEWS + " transactions operations"


# Views that only rename the columns of one table: reading the table again costs less than a copy.
RENAMED = ("cards", "transactions")


def move_frames(spark: SparkSession, folder: str, names: str = MOVE_VIEWS) -> dict[str, DataFrame]:
    """The frames that a move fact reads; what takes a shuffle is computed once, as it is read often."""
    frames = {name: getattr(views, name)(spark, folder) for name in names.split()}
    return {name: df if name in RENAMED else materialise(df, name) for name, df in frames.items()}


@query(sql(MOVE_VIEWS, WIP_SQL))
def wip_moves(spark: SparkSession, folder: str) -> DataFrame:
    f = move_frames(spark, folder)
    return facts.wip_moves(
        f["moves"], f["cards"], f["docs"], f["start_ops"], WINDOW, views.LOOK_BACK_AS_OF
    )


# A month, which leaves out moves, cards and documents.
MONTH = (datetime(1997, 3, 1, 7, 0, 1), datetime(1997, 4, 1, 7, 0, 0))
IN_MONTH = "a.TRANSFER_DATE BETWEEN TIMESTAMP '1997-03-01 07:00:01' AND TIMESTAMP '1997-04-01 07:00:00'"


@query(sql(MOVE_VIEWS, f"{WIP_SQL} AND {IN_MONTH}"))
def wip_moves_month(spark: SparkSession, folder: str) -> DataFrame:
    f = move_frames(spark, folder)
    return facts.wip_moves(
        f["moves"], f["cards"], f["docs"], f["start_ops"], MONTH, views.LOOK_BACK_AS_OF
    )


@query(sql("cards docs moves", MATERIAL_SQL))
def material_moves(spark: SparkSession, folder: str) -> DataFrame:
    f = move_frames(spark, folder, "cards docs moves")
    return facts.material_moves(f["moves"], f["cards"], f["docs"], WINDOW)


@query(sql(ALL_VIEWS, TRANS_SQL, totals=TOTALS_SQL))
def trans_moves(spark: SparkSession, folder: str) -> DataFrame:
    f = move_frames(spark, folder, ALL_VIEWS)
    return facts.trans_moves(
        f["transactions"],
        f["cards"],
        f["docs"],
        f["moves"],
        f["operations"],
        f["start_ops"],
        WINDOW,
    )


@query(
    sql(
        ALL_VIEWS,
        TRANS_SQL,
        totals=TOTALS_SQL.replace("WHERE WIP_ALREADY", f"WHERE {IN_MONTH} AND WIP_ALREADY"),
    )
)
def trans_moves_month(spark: SparkSession, folder: str) -> DataFrame:
    f = move_frames(spark, folder, ALL_VIEWS)
    return facts.trans_moves(
        f["transactions"],
        f["cards"],
        f["docs"],
        f["moves"],
        f["operations"],
        f["start_ops"],
        MONTH,
    )


def stored(spark: SparkSession, folder: str, buckets: int) -> dict[str, DataFrame]:
    """The sources of the transaction moves from staging tables that are laid out by run."""
    lake = Lake(scratch_path(spark, "lake"), buckets)
    tables = {
        "transactions": "EIS_WIP_FA_WIP_TRANS",
        "cards": "EIS_WIP_FA_RUNCARD",
        "docs": "EIS_DOCUMENT_EER",
        "moves": "EIS_WIP_FA",
    }
    found = {}
    for view, name in tables.items():
        rows = getattr(views, view)(spark, folder)
        rows = rows.select(*schemas.ddl(schemas.SOURCE_COLUMNS[name]).names)
        # Dealt by bucket before the audit columns widen them; a task writes whole buckets.
        rows = rows.repartition(buckets, *schemas.BUCKETS[name])
        # Some thousand days of few rows would be that many files in each bucket.
        table = replace(schemas.staging_table(lake, name, rows.schema), partition_by=("PLANT",), dealt=True)
        loads.load_full(table, staging.staged(rows, name, PLANT, BATCH))
        found[view] = table.read(spark)
    return found


@query(
    sql(
        ALL_VIEWS,
        TRANS_SQL,
        totals=TOTALS_SQL.replace("WHERE WIP_ALREADY", f"WHERE {IN_MONTH} AND WIP_ALREADY"),
    )
)
def trans_moves_stored(spark: SparkSession, folder: str) -> DataFrame:
    """A month's transactions, whose history is read by run and not shuffled."""
    f = stored(spark, folder, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return facts.trans_moves(
        f["transactions"],
        f["cards"],
        f["docs"],
        f["moves"],
        views.operations(spark, folder),
        views.start_ops(spark, folder),
        MONTH,
    )


def all_moves(spark: SparkSession, folder: str, material: bool) -> DataFrame:
    f = move_frames(spark, folder, ALL_VIEWS)
    return facts.all_moves(
        f["moves"],
        f["transactions"],
        f["cards"],
        f["docs"],
        f["operations"],
        f["start_ops"],
        WINDOW,
        views.LOOK_BACK_AS_OF,
        material,
    )


@query(
    sql(
        ALL_VIEWS,
        f"SELECT * FROM ({WIP_SQL}) UNION SELECT * FROM ({MATERIAL_SQL}) UNION SELECT * FROM ({TRANS_SQL})",
        totals=TOTALS_SQL,
    )
)
def move_union(spark: SparkSession, folder: str) -> DataFrame:
    return all_moves(spark, folder, material=True)


@query(
    sql(
        MOVE_VIEWS,
        f"""SELECT RUN_NO, OPERATION_NO, 'start' AS list FROM moves
            WHERE OPERATION_NO NOT IN ({START_OPS_SQL})
            UNION ALL
            SELECT RUN_NO, OPERATION_NO, 'with null' FROM moves
            WHERE OPERATION_NO NOT IN (SELECT CASE WHEN TYPE <> 'LAT' THEN OPERATION_NO END
                                       FROM start_ops)
            UNION ALL
            SELECT RUN_NO, OPERATION_NO, 'empty' FROM moves
            WHERE OPERATION_NO NOT IN (SELECT OPERATION_NO FROM start_ops WHERE TYPE = 'NONE')""",
    )
)
def not_in_subquery(spark: SparkSession, folder: str) -> DataFrame:
    f = move_frames(spark, folder, "docs moves start_ops")
    start_ops, kind = f["start_ops"], F.col("TYPE")
    operation = F.col("OPERATION_NO")
    lists = {
        "start": facts.start_operations(start_ops, f["docs"], views.LOOK_BACK_AS_OF),
        "with null": start_ops.select(F.when(kind != "LAT", operation).alias("OPERATION_NO")),
        "empty": start_ops.filter(kind == "NONE").select("OPERATION_NO"),
    }
    moves = f["moves"].select("RUN_NO", "OPERATION_NO")
    return joins.union_all(
        [
            joins.not_in(moves, "OPERATION_NO", values).withColumn("list", F.lit(name))
            for name, values in lists.items()
        ]
    )


@query(
    sql(
        "cards start_ops",
        f"SELECT RUN_NO, PRODUCT_PART_NO, EER_NO, code, {RESOLVED_SQL} AS OPERATION_NO FROM coded m",
        coded="""SELECT RUN_NO, PRODUCT_PART_NO, EER_NO,
                        CASE o_orderstatus WHEN 'F' THEN '480' WHEN 'O' THEN '490' ELSE '999' END
                            AS code,
                        CASE o_orderstatus WHEN 'F' THEN '480' WHEN 'O' THEN '490' ELSE '999' END
                            AS OPERATION_NO
                 FROM cards""",
    )
)
def correlated_max(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("o_orderstatus")
    code = F.when(status == "F", "480").when(status == "O", "490").otherwise("999")
    coded = views.cards(spark, folder).select(
        "RUN_NO", "PRODUCT_PART_NO", "EER_NO", code.alias("code"), code.alias("OPERATION_NO")
    )
    return facts.resolve_operation(coded, views.start_ops(spark, folder)).drop("ROUTING_SEQ")


# --- fact and mart ------------------------------------------------------------

ROUTING_SQL = """
    SELECT (CAST(right(PRODUCT_PART_NO, 9) AS BIGINT) * 3
                + CASE EER_NO WHEN 'EER-F' THEN 0 WHEN 'EER-O' THEN 1 ELSE 2 END) * 10
               + ROUTING_SEQ // 10 + 100000000 AS ROUTE_OPERATION_NO_KEY,
           CAST(right(PRODUCT_PART_NO, 9) AS BIGINT) + 100000001 AS PRODUCT_PART_NO_KEY,
           OPERATION_NO, EER_NO,
           CASE ROUTING_SEQ WHEN 60 THEN '480' WHEN 70 THEN '490'
                ELSE CAST(ROUTING_SEQ AS VARCHAR) END AS OPERATION_SEQ,
           CASE EER_NO WHEN 'EER-F' THEN 'MAT' WHEN 'EER-O' THEN 'UDP' ELSE 'NRM' END
               AS LOT_TYPE,
           CASE WHEN ROUTING_SEQ BETWEEN 20 AND 50 THEN 'YIELD' END AS YIELD
    FROM routing"""

DATES_SQL = """
    SELECT CAST(DATE_BEGIN - DATE '1994-12-31' + 1 AS INTEGER) AS DATE_KEY, DATE_BEGIN, WW,
           QUARTER, YEAR
    FROM (SELECT CAST(unnest(generate_series(DATE '1994-12-31', DATE '2001-12-31',
                                             INTERVAL 1 DAY)) AS DATE) AS DATE_BEGIN)
         JOIN weeks ON CAST(SAT_FROM_DATE AS DATE) <= DATE_BEGIN
                   AND CAST(SAT_TO_DATE AS DATE) >= DATE_BEGIN + 1"""


def routing_dim(spark: SparkSession, folder: str) -> DataFrame:
    number = F.right("PRODUCT_PART_NO", F.lit(9)).cast("long")
    step = F.floor(F.col("ROUTING_SEQ") / 10)
    sequence, document = F.col("ROUTING_SEQ"), F.col("EER_NO")
    place = F.when(document == "EER-F", 0).when(document == "EER-O", 1).otherwise(2)
    return views.routing(spark, folder).select(
        ((number * 3 + place) * 10 + step + 100_000_000).alias("ROUTE_OPERATION_NO_KEY"),
        (number + 100_000_001).alias("PRODUCT_PART_NO_KEY"),
        "OPERATION_NO",
        "EER_NO",
        F.when(sequence == 60, "480")
        .when(sequence == 70, "490")
        .otherwise(sequence.cast("string"))
        .alias("OPERATION_SEQ"),
        views.lot_type("EER_NO").alias("LOT_TYPE"),
        F.when(sequence.between(20, 50), "YIELD").alias("YIELD"),
    )


def date_dim(spark: SparkSession, folder: str) -> DataFrame:
    days = dims.production_days(views.FIRST_DAY, views.LAST_DAY, spark)
    rows = dims.date_source(views.weeks(spark, folder), days)
    return rows.withColumn(
        "DATE_KEY", F.datediff("DATE_BEGIN", F.lit(views.FIRST_DAY)) + F.lit(1)
    )


LOOKUP_SQL = """
    SELECT DATE_KEY, l.LINE_NO_KEY, ROUTE_OPERATION_NO_KEY, RUNCARD_NO_KEY, MACHINE_NO_KEY,
           INPUT AS INPUT_QTY, OUTPUT AS OUTPUT_QTY, SCRAP AS SCRAP_QTY, DATE_IN, DATE_OUT
    FROM all_moves m
         JOIN dates d ON CAST(m.DATE_BEGIN AS DATE) = d.DATE_BEGIN
         JOIN line_dim l ON m.JIT_CELL_NO = l.LINE_NO
         JOIN product_dim p ON m.PRODUCT_PART_NO = p.PRODUCT_PART_NO
         JOIN steps r ON m.OPERATION_NO = r.OPERATION_NO AND m.EER_NO = r.EER_NO
             AND m.LAT_LOT_TYPE = r.LOT_TYPE AND CAST(m.ROUTING_SEQ AS VARCHAR) = r.OPERATION_SEQ
             AND p.PRODUCT_PART_NO_KEY = r.PRODUCT_PART_NO_KEY
         JOIN card_dim c ON m.RUN_NO = c.RUNCARD_NO
             AND p.PRODUCT_PART_NO_KEY = c.PRODUCT_PART_NO_KEY
         LEFT JOIN machine_dim k ON m.MACHINE_NO = k.MACHINE_NO"""
FACT_VIEWS = ALL_VIEWS + " weeks line_dim product_dim card_dim machine_dim"
FACT_EXTRA = {
    "totals": TOTALS_SQL,
    "all_moves": f"SELECT * FROM ({WIP_SQL}) UNION ALL SELECT * FROM ({TRANS_SQL})",
    "steps": ROUTING_SQL,
    "dates": DATES_SQL,
}


def runcard_fact(spark: SparkSession, folder: str) -> DataFrame:
    return facts.fact_runcard(
        all_moves(spark, folder, material=False),
        date_dim(spark, folder),
        views.line_dim(spark, folder),
        views.product_dim(spark, folder),
        routing_dim(spark, folder),
        views.card_dim(spark, folder),
        views.machine_dim(spark, folder),
        views.AS_OF,
        PLANT,
    )


@query(sql(FACT_VIEWS, LOOKUP_SQL, **FACT_EXTRA))
def surrogate_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return runcard_fact(spark, folder).drop("ETL_DATE", "EN_OPERATE")


STAR_SQL = """
    SELECT d.DATE_BEGIN, d.WW,
           right(d.YEAR, 2) || upper(strftime(d.DATE_BEGIN, '%b')) AS MMM,
           right(d.QUARTER, 1) AS QUARTER, p.FAMILY_NAME AS PRODUCT_FAMILY, p.MPT_PART_NO,
           l.LINE_NO, r.LOT_TYPE AS LAT_LOT_TYPE, r.OPERATION_NO,
           CAST(sum(INPUT_QTY) AS DECIMAL(25,5)) AS INPUT_QTY,
           CAST(sum(OUTPUT_QTY) AS DECIMAL(25,5)) AS OUTPUT_QTY,
           CAST(sum(SCRAP_QTY) AS DECIMAL(25,5)) AS SCRAP_QTY
    FROM fact f JOIN steps r ON f.ROUTE_OPERATION_NO_KEY = r.ROUTE_OPERATION_NO_KEY
         JOIN product_dim p ON r.PRODUCT_PART_NO_KEY = p.PRODUCT_PART_NO_KEY
         JOIN line_dim l ON f.LINE_NO_KEY = l.LINE_NO_KEY
         JOIN dates d ON f.DATE_KEY = d.DATE_KEY
    WHERE r.YIELD = 'YIELD'
    GROUP BY ALL"""


def star(spark: SparkSession, folder: str) -> tuple[DataFrame, ...]:
    """The fact and the four dimensions of the yield mart."""
    return (
        materialise(runcard_fact(spark, folder), "fact"),
        routing_dim(spark, folder),
        views.product_dim(spark, folder),
        views.line_dim(spark, folder),
        date_dim(spark, folder),
    )


@query(sql(FACT_VIEWS, STAR_SQL, **FACT_EXTRA, fact=LOOKUP_SQL))
def star_join_yield(spark: SparkSession, folder: str) -> DataFrame:
    return marts.star_join_yield(*star(spark, folder))


YIELD_SQL = """
    SELECT *, CAST(CAST(CAST(OUTPUT_QTY AS DOUBLE) / CAST(INPUT_QTY AS DOUBLE) * 100
                   AS DECIMAL(28,9)) AS DECIMAL(15,2)) AS OPERATION_YIELD,
           CAST(CAST(exp(sum(ln(nullif(CAST(OUTPUT_QTY AS DOUBLE), 0)
                                / CAST(INPUT_QTY AS DOUBLE)))
                     OVER (PARTITION BY DATE_BEGIN, LINE_NO, MPT_PART_NO, LAT_LOT_TYPE)) * 100
                AS DECIMAL(28,9)) AS DECIMAL(15,2)) AS CUM_YIELD
    FROM grouped"""


@query(sql(FACT_VIEWS, YIELD_SQL, **FACT_EXTRA, fact=LOOKUP_SQL, grouped=STAR_SQL))
def cumulative_yield(spark: SparkSession, folder: str) -> DataFrame:
    return marts.ordered_mart(marts.mart_yield(*star(spark, folder)))


# --- run cards and lineage ----------------------------------------------------


@query(
    sql(
        "cards docs product_dim line_dim",
        """SELECT DISTINCT r.RUN_NO AS RUNCARD_NO, p.PRODUCT_PART_NO_KEY, r.EER_NO,
                  d.LAT_LOT_TYPE, r.CREATED_DATE, l.LINE_NO_KEY, CAST(NULL AS VARCHAR) AS FROM_RUN,
                  'WA' AS PLANT
           FROM cards r JOIN docs d ON r.EER_NO = d.EERNO
                AND r.PRODUCT_PART_NO = d.PRODUCT_PART_NO AND r.JIT_CELL_NO = d.JIT_CELL_NO
                JOIN product_dim p ON r.PRODUCT_PART_NO = p.PRODUCT_PART_NO
                JOIN line_dim l ON r.JIT_CELL_NO = l.LINE_NO
           WHERE r.CREATED_DATE BETWEEN TIMESTAMP '1996-03-31 07:00:01'
                                    AND TIMESTAMP '1999-03-31 07:00:00'
             AND (APP_NAME <> 'PSUDO' OR APP_NAME IS NULL)""",
    )
)
def runcard_dim_source(spark: SparkSession, folder: str) -> DataFrame:
    return dims.runcard_source(
        views.cards(spark, folder),
        views.docs(spark, folder),
        views.product_dim(spark, folder),
        views.line_dim(spark, folder),
        (datetime(1996, 3, 31, 7, 0, 1), datetime(1999, 3, 31, 7, 0, 0)),
        views.AS_OF,
        PLANT,
    ).drop("ETL_DATE")


LINEAGE_SQL = """
    WITH RECURSIVE hops AS (
        SELECT c.RUNCARD_NO_KEY, c.RUNCARD_NO AS original_runcard_no, e.RUN_NO AS current_run_no
        FROM card_dim c JOIN edges e ON c.RUNCARD_NO = e.FROM_RUN
        UNION
        SELECT h.RUNCARD_NO_KEY, h.original_runcard_no, e.RUN_NO
        FROM hops h JOIN edges e ON h.current_run_no = e.FROM_RUN)
    SELECT RUNCARD_NO_KEY, original_runcard_no, max(current_run_no) AS current_run_no
    FROM hops GROUP BY RUNCARD_NO_KEY, original_runcard_no"""


@query(sql("card_dim edges", "SELECT * FROM latest", latest=LINEAGE_SQL))
def run_lineage(spark: SparkSession, folder: str) -> DataFrame:
    cards = views.card_dim(spark, folder)
    return lineage.run_lineage(cards, views.edges(spark, folder), WINDOW)


@query(sql("card_dim merged_edges", "SELECT * FROM latest", latest=LINEAGE_SQL.replace("edges", "merged_edges")))
def run_lineage_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Lineage where some runs come from two others."""
    cards = views.card_dim(spark, folder)
    return lineage.run_lineage(cards, views.merged_edges(spark, folder), WINDOW)


@query(
    sql(
        "card_dim edges docs product_dim line_dim",
        """SELECT c.RUNCARD_NO_KEY, coalesce(n.current_run_no, c.RUNCARD_NO) AS RUNCARD_NO,
                  coalesce(n.PRODUCT_PART_NO_KEY, c.PRODUCT_PART_NO_KEY) AS PRODUCT_PART_NO_KEY,
                  coalesce(n.EER_NO, c.EER_NO) AS EER_NO,
                  coalesce(n.LAT_LOT_TYPE, c.LAT_LOT_TYPE) AS LAT_LOT_TYPE,
                  coalesce(n.CONVERTED_DATE, c.CREATED_DATE) AS CREATED_DATE,
                  coalesce(n.LINE_NO_KEY, c.LINE_NO_KEY) AS LINE_NO_KEY,
                  n.original_runcard_no AS FROM_RUN, c.PLANT
           FROM card_dim c LEFT JOIN renamed n
             ON c.RUNCARD_NO = n.original_runcard_no AND c.RUNCARD_NO_KEY = n.RUNCARD_NO_KEY""",
        latest=LINEAGE_SQL,
        renamed="""
            SELECT t.RUNCARD_NO_KEY, t.original_runcard_no, t.current_run_no, e.CONVERTED_DATE,
                   e.EER_NO, d.LAT_LOT_TYPE, p.PRODUCT_PART_NO_KEY, l.LINE_NO_KEY
            FROM latest t JOIN edges e ON e.RUN_NO = t.current_run_no
                 JOIN docs d ON e.EER_NO = d.EERNO AND e.PRODUCT_PART_NO = d.PRODUCT_PART_NO
                            AND e.JIT_CELL_NO = d.JIT_CELL_NO
                 JOIN product_dim p ON e.PRODUCT_PART_NO = p.PRODUCT_PART_NO
                 JOIN line_dim l ON e.JIT_CELL_NO = l.LINE_NO""",
    )
)
def run_lineage_apply(spark: SparkSession, folder: str) -> DataFrame:
    target = views.card_dim(spark, folder)
    converted = dims.converted_runs(
        target,
        views.edges(spark, folder),
        views.docs(spark, folder),
        views.product_dim(spark, folder),
        views.line_dim(spark, folder),
        WINDOW,
        PLANT,
    )
    return dims.apply_lineage(target, converted, PLANT)


@query(
    """SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus FROM (
           SELECT *, row_number() OVER (PARTITION BY o_custkey
                                        ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
           FROM orders) WHERE rn = 1"""
)
def latest_per_group(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus"
    )
    return joins.latest_per(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


# --- dimensions ---------------------------------------------------------------

# Machines are parts, known ones are the small parts.
MACHINES_SQL = """
    SELECT 'M' || p_partkey AS MACHINE_NO, p_name AS MACHINE_NAME, p_size FROM part"""


def machines(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "part").select(
        F.concat(F.lit("M"), F.col("p_partkey").cast("string")).alias("MACHINE_NO"),
        F.col("p_name").alias("MACHINE_NAME"),
        "p_size",
    )


def known_machines(spark: SparkSession, folder: str) -> DataFrame:
    """Dimension rows of the machines below size 20; half of them from another plant."""
    rows = machines(spark, folder).filter(F.col("p_size") < 20)
    plant = F.when(F.col("p_size") < 10, "WH").otherwise("WA")
    audited = with_audit(dims.machine_source(rows), "seed", "", BATCH, ["MACHINE_NO"])
    number = F.substring("MACHINE_NO", 2, 20).cast("int")
    return audited.join(
        rows.select("MACHINE_NO", plant.alias("plant")), "MACHINE_NO"
    ).select(
        (number + 100_000_001).alias("MACHINE_NO_KEY"),
        "MACHINE_NO",
        "MACHINE_NAME",
        "MACHINE_GROUP",
        *[
            F.concat(F.lit("master_MFG_MACHINE_DIM_"), "plant").alias(name)
            if name == "INF_SESS_NAME"
            else F.col(name)
            for name in audited.columns[3:]
        ],
    )


@query(
    sql(
        "",
        f"""WITH machines AS ({MACHINES_SQL}),
            old AS (SELECT CAST(CAST(substr(MACHINE_NO, 2) AS INTEGER) + 100000001 AS INTEGER)
                               AS MACHINE_NO_KEY, MACHINE_NO, MACHINE_NAME,
                           CASE WHEN p_size < 10 THEN 'WH' ELSE 'WA' END AS plant
                    FROM machines WHERE p_size < 20)
            SELECT MACHINE_NO_KEY, MACHINE_NO, MACHINE_NAME,
                   'master_MFG_MACHINE_DIM_' || plant AS INF_SESS_NAME FROM old
            UNION ALL
            SELECT CAST((SELECT max(MACHINE_NO_KEY) FROM old WHERE plant = 'WA')
                        + row_number() OVER (ORDER BY MACHINE_NO) AS INTEGER),
                   MACHINE_NO, MACHINE_NAME, 'master_MFG_MACHINE_DIM_WA'
            FROM machines WHERE MACHINE_NO NOT IN (SELECT MACHINE_NO FROM old)""",
    )
)
def dim_insert_only(spark: SparkSession, folder: str) -> DataFrame:
    target = known_machines(spark, folder)
    new = dims.dim_machine(machines(spark, folder), target, BATCH, PLANT)
    columns = ["MACHINE_NO_KEY", "MACHINE_NO", "MACHINE_NAME", "INF_SESS_NAME"]
    return target.select(columns).unionByName(new.select(columns))


def loaded(spark: SparkSession, name: str, runs: list) -> DataFrame:
    """A dimension table after several runs, each a function from the table's rows to new ones."""
    table = schemas.master_table(Lake(scratch_path(spark, "lake")), name)
    loads.create_table(spark, table)
    for run in runs:
        loads.append(table, run(table.read(spark)))
    return table.read(spark)


@query(
    sql(
        "weeks",
        """SELECT CAST(row_number() OVER (ORDER BY DATE_BEGIN < DATE '1997-01-01', DATE_BEGIN) AS INTEGER)
                      AS DATE_KEY, DATE_BEGIN, WW, MONTH, QUARTER, YEAR
           FROM (SELECT CAST(o_orderdate AS DATE) AS DATE_BEGIN FROM orders
                 UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem) JOIN weeks
             ON CAST(SAT_FROM_DATE AS DATE) <= DATE_BEGIN
            AND CAST(SAT_TO_DATE AS DATE) >= DATE_BEGIN + 1""",
    )
)
def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    """The days from 1997 on, then all days: the earlier ones get the later keys."""
    weeks = materialise(views.weeks(spark, folder), "weeks")
    days = materialise(dims.day_bounds(views.days(spark, folder)), "days")
    late = days.filter(F.col("DATE_BEGIN") >= F.lit(date(1997, 1, 1)))
    runs = [lambda target, rows=rows: dims.dim_date(weeks, rows, target, BATCH) for rows in (late, days)]
    return loaded(spark, "MFG_DATE_DIM", runs).select(
        "DATE_KEY", "DATE_BEGIN", "WW", "MONTH", "QUARTER", "YEAR"
    )


@query(
    sql(
        "cards docs product_dim line_dim",
        """SELECT CAST(first + row_number() OVER (PARTITION BY k.PLANT ORDER BY
                           CREATED_DATE <= TIMESTAMP '1997-01-01 07:00:00', RUN_NO) AS INTEGER)
                      AS RUNCARD_NO_KEY,
                  RUN_NO AS RUNCARD_NO, CAST(PRODUCT_PART_NO_KEY AS INTEGER) AS PRODUCT_PART_NO_KEY,
                  EER_NO, LAT_LOT_TYPE, CREATED_DATE, LINE_NO_KEY, k.PLANT, 'master_SFC_RUNCARD_DIM_' || k.PLANT AS INF_SESS_NAME
           FROM (SELECT DISTINCT r.RUN_NO, p.PRODUCT_PART_NO_KEY, r.EER_NO, d.LAT_LOT_TYPE,
                        r.CREATED_DATE, l.LINE_NO_KEY
                 FROM cards r JOIN docs d ON r.EER_NO = d.EERNO
                      AND r.PRODUCT_PART_NO = d.PRODUCT_PART_NO AND r.JIT_CELL_NO = d.JIT_CELL_NO
                      JOIN product_dim p ON r.PRODUCT_PART_NO = p.PRODUCT_PART_NO
                      JOIN line_dim l ON r.JIT_CELL_NO = l.LINE_NO
                 WHERE APP_NAME <> 'PSUDO' OR APP_NAME IS NULL),
                (VALUES ('WA', 100000000), ('WH', 300000000)) AS k(PLANT, first)""",
    )
)
def dim_runcard(spark: SparkSession, folder: str) -> DataFrame:
    """Run cards of two plants, from a window of recent years and then from all years."""
    cards, docs = views.cards(spark, folder), views.docs(spark, folder)
    recent = (datetime(1997, 1, 1, 7, 0, 1), WINDOW[1])

    def run(plant: str, window: tuple[datetime, datetime]):
        own = lambda rows: rows.withColumn("PLANT", F.lit(plant))
        source = dims.runcard_source(
            cards,
            docs,
            own(views.product_dim(spark, folder)),
            own(views.line_dim(spark, folder)),
            window,
            views.AS_OF,
            plant,
        )
        return lambda target: dims.dim_runcard(source, target, BATCH, plant)

    runs = [run(plant, window) for window in (recent, WINDOW) for plant in ("WA", "WH")]
    return loaded(spark, "SFC_RUNCARD_DIM", runs).select(
        "RUNCARD_NO_KEY", "RUNCARD_NO", "PRODUCT_PART_NO_KEY", "EER_NO", "LAT_LOT_TYPE",
        "CREATED_DATE", "LINE_NO_KEY", "PLANT", "INF_SESS_NAME",
    )


@query(
    sql(
        "operations",
        """SELECT CAST(600000000 + row_number() OVER (ORDER BY OPERATION_NO) AS INTEGER)
                      AS OPERATION_NO_KEY,
                  OPERATION_NO, trim(OPERATION_NAME) AS OPERATION_NAME, 'WN' AS PLANT
           FROM operations""",
    )
)
def dim_operation(spark: SparkSession, folder: str) -> DataFrame:
    source = views.operations(spark, folder)
    empty = source.select(
        F.lit(0).alias("OPERATION_NO_KEY"), "OPERATION_NO", F.lit("WN").alias("PLANT")
    ).filter(F.col("PLANT") == "none")
    new = dims.dim_operation(source, empty, BATCH, "WN")
    return new.select("OPERATION_NO_KEY", "OPERATION_NO", "OPERATION_NAME", "PLANT")


# Lines are suppliers; those with a low balance are known under old attributes.
def cells(spark: SparkSession, folder: str) -> DataFrame:
    return (
        load(spark, folder, "supplier")
        .join(load(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(load(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_name").alias("JIT_CELL_NO"),
            F.concat(F.lit("L"), F.col("s_suppkey").cast("string")).alias("LINE_NO"),
            F.col("n_name").alias("ROOM"),
            F.col("r_name").alias("LOCATION"),
            F.right("s_name", F.lit(2)).alias("JIT_CELL_DIGIT"),
        )
    )


def known_lines(spark: SparkSession, folder: str) -> DataFrame:
    rows = load(spark, folder, "supplier").filter(F.col("s_acctbal") < 5000)
    old = rows.select(
        (F.col("s_suppkey") + 100_000_001).cast("int").alias("LINE_NO_KEY"),
        F.col("s_name").alias("LINE_NO"),
        F.lit("old room").alias("ROOM"),
        F.lit(None).cast("string").alias("LOCATION"),
        F.when(F.col("s_acctbal") < 1000, "WH").otherwise("WA").alias("PLANT"),
        F.lit("old").alias("LINE_CODE"),
        F.lit("0").alias("LINE_DIGIT"),
    )
    return with_audit(old, "seed", "seed", BATCH, ["LINE_NO"])


LINE_COLUMNS = ["LINE_NO_KEY", "LINE_NO", "ROOM", "LOCATION", "PLANT", "LINE_CODE", "LINE_DIGIT"]


@query(
    """WITH cells AS (SELECT s_suppkey, s_acctbal, s_name, 'L' || s_suppkey AS code,
                             n_name AS room, r_name AS location, right(s_name, 2) AS digit
                      FROM supplier JOIN nation ON s_nationkey = n_nationkey
                           JOIN region ON n_regionkey = r_regionkey)
       SELECT CAST(s_suppkey + 100000001 AS INTEGER) AS LINE_NO_KEY, s_name AS LINE_NO,
              room AS ROOM, location AS LOCATION, 'WA' AS PLANT, code AS LINE_CODE,
              digit AS LINE_DIGIT
       FROM cells WHERE s_acctbal >= 1000 AND s_acctbal < 5000
       UNION ALL
       SELECT CAST((SELECT max(s_suppkey) + 100000001 FROM cells
                    WHERE s_acctbal >= 1000 AND s_acctbal < 5000)
                   + row_number() OVER (ORDER BY s_name) AS INTEGER),
              s_name, room, location, 'WA', code, digit
       FROM cells WHERE s_acctbal < 1000 OR s_acctbal >= 5000"""
)
def dim_update_matched(spark: SparkSession, folder: str) -> DataFrame:
    whole = dims.dim_line(cells(spark, folder), known_lines(spark, folder), BATCH, PLANT)
    return whole.select(LINE_COLUMNS)


# Products are customers, families are nations; families of one region are closed.
def product_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    customer = load(spark, folder, "customer")
    nation = load(spark, folder, "nation")
    overall = customer.select(
        F.concat(F.lit(" "), "c_name", F.lit("  ")).alias("PRODUCT_PART_NO"),
        F.col("c_mktsegment").alias("PRODUCT_ID"),
        F.concat(F.lit("prog "), "c_mktsegment").alias("PROGRAM_NAME"),
        F.lit("TAB").alias("PART_TYPE_NAME"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey").cast("string")).alias(
            "FAMILY_PRODUCT_ID"
        ),
    )
    families = nation.select(
        F.col("n_nationkey").cast("string").alias("FAMILY_PRODUCT_ID"),
        F.col("n_name").alias("FAMILY_NAME"),
        F.when(F.col("n_regionkey") == 0, "CLOSED")
        .when(F.col("n_regionkey") != 1, "ACTIVE")
        .alias("STATUS"),
    )
    parts = customer.filter(F.col("c_acctbal") > 2000).select(
        F.col("c_name").alias("PRODUCT_PART_NO"),
        F.col("c_mktsegment").alias("GL_PRODUCT_CODE"),
        F.substring("c_mktsegment", 1, 1).alias("FIRST_JOB_DIGIT"),
        F.lit("S1").alias("TG_SITE"),
        F.concat(F.lit("part of "), "c_name").alias("PRODUCT_PART_DESC"),
    )
    return overall, families, parts


PRODUCTS_SQL = """
    SELECT c_name AS PRODUCT_PART_NO, c_mktsegment AS MPT_PART_NO,
           'prog ' || c_mktsegment AS PRODUCT_NAME, n_name AS FAMILY_NAME, 'WA' AS PLANT,
           'TAB' AS TAB,
           CASE WHEN c_acctbal > 2000 THEN c_mktsegment END AS GL_PRODUCT_CODE,
           CASE WHEN c_acctbal > 2000 THEN left(c_mktsegment, 1) END AS FIRST_JOB_DIGIT,
           CASE WHEN c_acctbal > 2000 THEN 'S1' END AS TG_SITE,
           CASE WHEN c_acctbal > 2000 THEN 'part of ' || c_name END AS PRODUCT_PART_DESC,
           CASE n_regionkey WHEN 0 THEN 'CLOSED' WHEN 1 THEN NULL ELSE
                CASE WHEN n_regionkey IS NOT NULL THEN 'ACTIVE' END END AS STATUS,
           c_custkey, c_acctbal, c_mktsegment
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND c_acctbal >= 0"""
PRODUCT_COLUMNS = (
    "PRODUCT_PART_NO, MPT_PART_NO, PRODUCT_NAME, FAMILY_NAME, PLANT, TAB, GL_PRODUCT_CODE, "
    "FIRST_JOB_DIGIT, TG_SITE, PRODUCT_PART_DESC, STATUS"
)


@query(
    f"""WITH products AS ({PRODUCTS_SQL})
        SELECT {PRODUCT_COLUMNS}, 'daily' AS load FROM products WHERE STATUS = 'ACTIVE'
        UNION ALL SELECT {PRODUCT_COLUMNS}, 'initial' FROM products"""
)
def product_dim_source(spark: SparkSession, folder: str) -> DataFrame:
    inputs = product_inputs(spark, folder)
    daily = dims.product_source(*inputs, PLANT).withColumn("load", F.lit("daily"))
    initial = dims.product_source(*inputs, PLANT, active_only=False)
    return daily.unionByName(initial.withColumn("load", F.lit("initial")))


def known_products(spark: SparkSession, folder: str) -> DataFrame:
    """Products of two segments, with a status that may be outdated or missing."""
    rows = load(spark, folder, "customer").filter(
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    )
    old = rows.select(
        (F.col("c_custkey") + 100_000_001).cast("int").alias("PRODUCT_PART_NO_KEY"),
        F.col("c_name").alias("PRODUCT_PART_NO"),
        *[F.lit("old").alias(name) for name in ("MPT_PART_NO", "PRODUCT_NAME", "FAMILY_NAME")],
        F.lit(PLANT).alias("PLANT"),
        *[
            F.lit("old").alias(name)
            for name in ("TAB", "GL_PRODUCT_CODE", "FIRST_JOB_DIGIT", "TG_SITE")
        ],
        F.lit("old").alias("PRODUCT_PART_DESC"),
        F.when(F.col("c_acctbal") < 6000, "ACTIVE").alias("STATUS"),
    )
    return with_audit(old, "seed", "seed", BATCH, ["PRODUCT_PART_NO"])


@query(
    f"""WITH products AS ({PRODUCTS_SQL}),
        old AS (SELECT c_custkey + 100000001 AS key, *,
                       CASE WHEN c_acctbal < 6000 THEN 'ACTIVE' END AS old_status
                FROM products WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
        SELECT CAST(key AS INTEGER) AS PRODUCT_PART_NO_KEY, PRODUCT_PART_NO,
               'old' AS FAMILY_NAME,
               CASE WHEN old_status <> STATUS THEN STATUS ELSE old_status END AS STATUS
        FROM old
        UNION ALL
        SELECT CAST((SELECT max(key) FROM old) + row_number() OVER (ORDER BY PRODUCT_PART_NO)
                    AS INTEGER), PRODUCT_PART_NO, FAMILY_NAME, STATUS
        FROM products WHERE STATUS = 'ACTIVE' AND c_mktsegment NOT IN ('BUILDING', 'MACHINERY')"""
)
def dim_conditional_update(spark: SparkSession, folder: str) -> DataFrame:
    inputs = product_inputs(spark, folder)
    whole = dims.dim_product(*inputs, known_products(spark, folder), BATCH, PLANT)
    return whole.select("PRODUCT_PART_NO_KEY", "PRODUCT_PART_NO", "FAMILY_NAME", "STATUS")


SPAN_SQL = """
    SELECT d.PRODUCT_PART_NO, d.EER_NO, d.ROUTING_SEQ, d.OPERATION_NO,
           e.ROUTING_SEQ AS ROUTING_SEQ_START_YIELD, f.ROUTING_SEQ AS ROUTING_SEQ_END_YIELD,
           CASE WHEN d.ROUTING_SEQ >= e.ROUTING_SEQ AND d.ROUTING_SEQ <= f.ROUTING_SEQ
                THEN 'YIELD' END AS YIELD
    FROM routing d
         LEFT JOIN (SELECT r.* FROM start_ops s JOIN routing r
                    USING (PRODUCT_PART_NO, EER_NO, OPERATION_NO) WHERE s.TYPE = 'YIELD') e
           ON e.PRODUCT_PART_NO = d.PRODUCT_PART_NO AND e.EER_NO = d.EER_NO
         LEFT JOIN (SELECT r.* FROM start_ops s JOIN routing r
                    USING (PRODUCT_PART_NO, EER_NO, OPERATION_NO) WHERE s.TYPE = 'ENDYI') f
           ON f.PRODUCT_PART_NO = d.PRODUCT_PART_NO AND f.EER_NO = d.EER_NO"""


@query(sql("moves routing start_ops", SPAN_SQL))
def yield_span(spark: SparkSession, folder: str) -> DataFrame:
    return dims.yield_span(views.routing(spark, folder), views.start_ops(spark, folder))


# Routes written in two spellings.
MIXED_SQL = """
    SELECT DISTINCT PRODUCT_PART_NO,
           CASE WHEN MACHINE_NO < 'Supplier#000000050' THEN lower(EER_NO) ELSE EER_NO END AS EER_NO,
           OPERATION_NO, ROUTING_SEQ
    FROM moves"""
CANONICAL_SQL = """
    SELECT PRODUCT_PART_NO, max(EER_NO) AS EER_NO, max(OPERATION_NAME) AS OPERATION_NAME,
           OPERATION_SEQ, OPERATION_NO, max(LAT_LOT_TYPE) AS LOT_TYPE
    FROM (SELECT r.PRODUCT_PART_NO, r.EER_NO, r.OPERATION_NO, o.OPERATION_NAME, d.LAT_LOT_TYPE,
                 CASE o.OPERATION_GROUP WHEN 'LAT' THEN '480' WHEN 'PACK' THEN '490'
                      ELSE CAST(r.ROUTING_SEQ AS VARCHAR) END AS OPERATION_SEQ
          FROM {routing} r LEFT JOIN operations o ON r.OPERATION_NO = o.OPERATION_NO
               LEFT JOIN docs d ON r.PRODUCT_PART_NO = d.PRODUCT_PART_NO AND r.EER_NO = d.EERNO)
    GROUP BY upper(EER_NO), OPERATION_NO, PRODUCT_PART_NO, OPERATION_SEQ"""


def mixed_routing(spark: SparkSession, folder: str) -> DataFrame:
    spelled = F.when(
        F.col("MACHINE_NO") < "Supplier#000000050", F.lower("EER_NO")
    ).otherwise(F.col("EER_NO"))
    rows = views.moves(spark, folder).withColumn("EER_NO", spelled)
    return rows.select("PRODUCT_PART_NO", "EER_NO", "OPERATION_NO", "ROUTING_SEQ").distinct()


@query(sql("docs moves operations", CANONICAL_SQL.format(routing="mixed"), mixed=MIXED_SQL))
def case_fold_group(spark: SparkSession, folder: str) -> DataFrame:
    return dims.canonical_routing(
        mixed_routing(spark, folder), views.operations(spark, folder), views.docs(spark, folder)
    )


# Routing with product keys for the products of customers in credit only.
SOURCE_SQL = """
    SELECT a.*, b.ROUTING_SEQ_START_YIELD, b.ROUTING_SEQ_END_YIELD, b.YIELD, p.key
    FROM canonical a
         LEFT JOIN spans b ON a.PRODUCT_PART_NO = b.PRODUCT_PART_NO AND a.EER_NO = b.EER_NO
                          AND a.OPERATION_NO = b.OPERATION_NO
         LEFT JOIN (SELECT c_name, c_custkey + 100000001 AS key FROM customer
                    WHERE c_acctbal >= 0) p ON a.PRODUCT_PART_NO = p.c_name"""


def routing_source(spark: SparkSession, folder: str) -> DataFrame:
    products = views.product_dim(spark, folder).join(
        load(spark, folder, "customer").filter(F.col("c_acctbal") >= 0),
        F.col("PRODUCT_PART_NO") == F.col("c_name"),
        "left_semi",
    )
    return dims.routing_source(
        views.routing(spark, folder),
        views.operations(spark, folder),
        views.docs(spark, folder),
        views.start_ops(spark, folder),
        products,
        PLANT,
    )


@query(
    sql(
        "docs moves routing start_ops operations",
        """SELECT CAST(100000000 + row_number() OVER (ORDER BY OPERATION_NO, PRODUCT_PART_NO,
                      EER_NO, OPERATION_SEQ) AS INTEGER) AS ROUTE_OPERATION_NO_KEY,
                  OPERATION_NO, key AS PRODUCT_PART_NO_KEY, EER_NO, OPERATION_NAME, OPERATION_SEQ,
                  LOT_TYPE, ROUTING_SEQ_START_YIELD, ROUTING_SEQ_END_YIELD, YIELD
           FROM source s
           WHERE NOT EXISTS (SELECT 1 FROM source t
               WHERE t.OPERATION_SEQ IN ('10', '20', '480') AND t.OPERATION_NO = s.OPERATION_NO
                 AND t.EER_NO = s.EER_NO AND t.OPERATION_SEQ = s.OPERATION_SEQ
                 AND coalesce(t.key, 0) = coalesce(s.key, 0))""",
        spans=SPAN_SQL,
        canonical=CANONICAL_SQL.format(routing="routing"),
        source=SOURCE_SQL,
    )
)
def null_key_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """New routing steps, where early steps are known, some without a product key."""
    source = materialise(routing_source(spark, folder), "routing")
    known = source.filter(F.col("OPERATION_SEQ").isin("10", "20", "480"))
    target = with_audit(known, "seed", "seed", BATCH, ["OPERATION_NO"]).withColumn(
        "ROUTE_OPERATION_NO_KEY", F.lit(100_000_001)
    )
    new = dims.dim_routing(source, target, BATCH, PLANT)
    return new.select(
        "ROUTE_OPERATION_NO_KEY",
        "OPERATION_NO",
        "PRODUCT_PART_NO_KEY",
        "EER_NO",
        "OPERATION_NAME",
        "OPERATION_SEQ",
        "LOT_TYPE",
        "ROUTING_SEQ_START_YIELD",
        "ROUTING_SEQ_END_YIELD",
        "YIELD",
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
              300000000 + row_number() OVER (ORDER BY l_partkey, l_suppkey, l_orderkey,
                       l_linenumber, l_extendedprice) AS line_key
       FROM lineitem"""
)
def key_assign(spark: SparkSession, folder: str) -> DataFrame:
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    empty = lines.select(F.lit(0).cast("long").alias("line_key")).filter(F.lit(False))
    order = ["l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice"]
    return keys.assign_keys(lines, empty, "line_key", order, keys.KEY_BASE["WH"])


@query(
    """WITH old AS (SELECT o_custkey AS k, o_orderstatus AS s FROM orders
                    WHERE o_orderdate < DATE '1998-01-01'),
            new AS (SELECT o_custkey AS k, o_orderstatus AS s FROM orders
                    WHERE o_orderdate >= DATE '1998-01-01')
       SELECT 'all' AS kind,
              (SELECT count(*) FROM old JOIN new ON old.k = new.k) AS rows_to_update,
              (SELECT count(*) FROM new LEFT JOIN old ON old.k = new.k WHERE old.k IS NULL)
                  AS rows_to_insert
       UNION ALL
       SELECT 'changed', (SELECT count(*) FROM old JOIN new ON old.k = new.k AND old.s <> new.s),
              (SELECT count(*) FROM new LEFT JOIN old ON old.k = new.k WHERE old.k IS NULL)"""
)
def merge_preview(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select("o_custkey", "o_orderstatus", "o_orderdate")
    day = F.lit(date(1998, 1, 1))
    old, new = orders.filter(F.col("o_orderdate") < day), orders.filter(F.col("o_orderdate") >= day)
    every = preview(old, new, ["o_custkey"]).withColumn("kind", F.lit("all"))
    changed = preview(old, new, ["o_custkey"], ["o_orderstatus"])
    return every.unionByName(changed.withColumn("kind", F.lit("changed")))


@query(
    sql(
        "telemetry",
        """SELECT upper(substr(MACHINENAME, 1, 6)) AS MachineNo, COLLECTEDDATE AS CreateDate,
                  VID AS Vid, NAME AS VariableName FROM telemetry""",
    )
)
def telemetry_insert_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    """Telemetry whose first half is loaded already, merged with all of it."""
    rows = views.telemetry(spark, folder).select(
        F.upper(F.substring("MACHINENAME", 1, 6)).alias("MachineNo"),
        F.col("COLLECTEDDATE").alias("CreateDate"),
        F.col("VID").alias("Vid"),
        F.col("NAME").alias("VariableName"),
    )
    loaded = rows.filter(F.col("CreateDate") < F.lit("2024-01-15").cast("timestamp_ntz"))
    return merge.upsert_insert(loaded, rows, ["MachineNo", "CreateDate", "Vid", "VariableName"])


# --- audit --------------------------------------------------------------------


@query(
    """SELECT p_partkey, 'REC_' || sha256(CAST(p_partkey AS VARCHAR) || chr(1) || p_name) AS REC_ID,
              'part' AS SOURCE_TABLE_NAME, 42 AS INF_BATCH_ID, 'Staging_part' AS INF_SESS_NAME,
              'admin' AS DM_MODIFIED_BY, TIMESTAMP '2024-02-01 08:30:00' AS DM_MODIFIED_DATE,
              'admin' AS DM_CREATED_BY, TIMESTAMP '2024-02-01 08:30:00' AS DM_CREATED_DATE,
              TIMESTAMP '2024-02-01 08:30:00' AS DM_DATE_FROM,
              TIMESTAMP '2024-02-01 08:30:00' AS DM_DATE_TO
       FROM part"""
)
def audit_columns(spark: SparkSession, folder: str) -> DataFrame:
    parts = load(spark, folder, "part").select("p_partkey", "p_name")
    audited = with_audit(parts, "part", "Staging_part", BATCH, ["p_partkey", "p_name"])
    return audited.drop("p_name")


# Control table with one batch per day that has events.
CONTROL_SQL = """
    SELECT CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS INF_BATCH_ID,
           day + INTERVAL '07:00:01' AS DATE_FROM, day + INTERVAL 31 HOUR AS DATE_TO
    FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)"""


def control(spark: SparkSession, folder: str) -> DataFrame:
    days = load(spark, folder, "events").select(F.to_date("ts").alias("day")).distinct()
    numbered = keys.number_rows(days, ["day"], "INF_BATCH_ID")
    start = F.col("day").cast("timestamp_ntz")
    return numbered.select(
        F.col("INF_BATCH_ID").cast("int"),
        (start + F.expr("INTERVAL '07:00:01' HOUR TO SECOND")).alias("DATE_FROM"),
        (start + F.expr("INTERVAL '31' HOUR")).alias("DATE_TO"),
    )


@query(
    f"""WITH control AS ({CONTROL_SQL})
        SELECT CAST(max(INF_BATCH_ID) AS INTEGER) AS batch_id, max(INF_BATCH_ID) = 1 AS is_first FROM control"""
)
def current_batch_id(spark: SparkSession, folder: str) -> DataFrame:
    """The batch that loads of the day write into their rows."""
    batch_id = current_batch(control(spark, folder))
    return spark.createDataFrame([(batch_id, batch_id == 1)], "batch_id int, is_first boolean")


@query(
    f"""WITH control AS ({CONTROL_SQL})
        SELECT * FROM control
        UNION ALL SELECT max(INF_BATCH_ID) + 1, TIMESTAMP '2024-03-01 07:00:01',
                         TIMESTAMP '2024-03-02 07:00:00' FROM control"""
)
def next_batch_id(spark: SparkSession, folder: str) -> DataFrame:
    """The control table after a new day, and after a day that is listed already."""
    listed = control(spark, folder)
    whole = listed.unionByName(next_batch(listed, date(2024, 3, 2)))
    return whole.unionByName(next_batch(whole, date(2024, 1, 11)))


@query(
    """SELECT event_type, count(*) FILTER (ts < TIMESTAMP '2024-01-20') AS rows_before,
              count(*) AS rows_after, count(*) FILTER (ts >= TIMESTAMP '2024-01-20') AS rows_added
       FROM events GROUP BY event_type"""
)
def load_report(spark: SparkSession, folder: str) -> DataFrame:
    after = load(spark, folder, "events")
    before = after.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return report(before, after, ["event_type"])


@query(
    """SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, NULL AS segment, 'WA' AS PLANT
       FROM supplier
       UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment, 'WH' FROM customer"""
)
def unify_plants(spark: SparkSession, folder: str) -> DataFrame:
    """Tables of two plants that differ by a column."""
    first = load(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    second = load(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    return joins.unify_plants({"WA": first, "WH": second})
