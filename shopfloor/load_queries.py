"""Load modes: every query writes a table below the shared folder and reads it back.

The loads that promise to be repeatable run twice.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.registry import query
from shopfloor.views import load
from yieldmill.functions.prodtime import in_window, ntz, span_window
from yieldmill.operators import loads
from yieldmill.operators.audit import Batch
from yieldmill.plans import schemas, staging
from yieldmill.session import scratch_path
from yieldmill.sources.lake import Lake, Table

COLUMNS = "event_id, ts, machine, day, batch, session, value"

# Events as a load table; `value` of replaced rows is raised by 1000.
SEED_SQL = """
    SELECT event_id, ts, event_type AS machine, CAST(ts AS DATE) AS day,
           CAST(day(ts) AS INTEGER) AS batch,
           CASE WHEN value < 40 THEN 'daily' ELSE 'initial' END AS session, value
    FROM events"""

SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("machine", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("batch", T.IntegerType()),
        T.StructField("session", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def seed(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "events").select(
        "event_id",
        "ts",
        F.col("event_type").alias("machine"),
        F.to_date("ts").alias("day"),
        F.dayofmonth("ts").alias("batch"),
        F.when(F.col("value") < 40, "daily").otherwise("initial").alias("session"),
        "value",
    )


def corrected(rows: DataFrame) -> DataFrame:
    return rows.withColumn("value", F.col("value") + 1000)


def new_table(spark: SparkSession, *partition_by: str) -> Table:
    return Lake(scratch_path(spark, "lake")).table("process", "events", SCHEMA, partition_by)


def seeded(spark: SparkSession, folder: str, *partition_by: str) -> tuple[Table, DataFrame]:
    table, rows = new_table(spark, *partition_by), seed(spark, folder)
    loads.create_table(spark, table)
    loads.append(table, rows)
    return table, rows


def replaced_sql(where: str, keep: str = "true", removed: str | None = None) -> str:
    """Seed rows; those that meet ``where`` are raised, or gone without ``keep``."""
    removed = removed or where
    return f"""
        WITH seed AS ({SEED_SQL})
        SELECT {COLUMNS} FROM seed WHERE NOT ({removed})
        UNION ALL SELECT * REPLACE (value + 1000 AS value) FROM seed WHERE {where} AND {keep}"""


@query(f"WITH seed AS ({SEED_SQL}) SELECT {COLUMNS} FROM seed")
def full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    table, rows = seeded(spark, folder, "machine")
    loads.load_full(table, rows.filter(F.col("machine") == "error"))
    loads.load_full(table, rows)
    return table.read(spark)


@query(
    f"""WITH seed AS ({SEED_SQL})
        SELECT {COLUMNS} FROM seed WHERE ts <= TIMESTAMP '2024-01-20 07:00:00'"""
)
def full_refresh_cutoff(spark: SparkSession, folder: str) -> DataFrame:
    table, rows = seeded(spark, folder)
    loads.load_full_until(table, rows, "ts", date(2024, 1, 20))
    return table.read(spark)


@query(
    f"""WITH seed AS ({SEED_SQL})
        SELECT {COLUMNS} FROM seed WHERE ts <= TIMESTAMP '2024-01-12 07:00:00'"""
)
def initial_backfill(spark: SparkSession, folder: str) -> DataFrame:
    table, rows = new_table(spark, "day"), seed(spark, folder)
    loads.create_table(spark, table)
    loads.load_initial(table, rows, "ts", date(2024, 1, 12))
    return table.read(spark)


@query(
    f"""WITH seed AS ({SEED_SQL})
        SELECT {COLUMNS} FROM seed
        UNION ALL SELECT * REPLACE (value + 1000 AS value) FROM seed"""
)
def append(spark: SparkSession, folder: str) -> DataFrame:
    table, rows = seeded(spark, folder, "machine", "day")
    loads.append(table, corrected(rows))
    return table.read(spark)


@query(
    f"""WITH seed AS ({SEED_SQL})
        SELECT machine, day, sum(n) AS rows FROM (
            SELECT machine, day, count(*) AS n FROM seed GROUP BY ALL) GROUP BY ALL"""
)
def replace_table(spark: SparkSession, folder: str) -> DataFrame:
    """A table made from itself."""
    table, _ = seeded(spark, folder)
    counts = table.read(spark).withColumn("value", F.lit(1.0))
    loads.replace_table(table, counts)
    rows = table.read(spark).groupBy("machine", "day")
    return rows.agg(F.sum("value").cast("long").cast("decimal(38,0)").alias("rows"))


def replace_twice(
    spark: SparkSession, folder: str, partition_by: tuple[str, ...], where: Column, replace
) -> DataFrame:
    table, rows = seeded(spark, folder, *partition_by)
    for _ in range(2):
        replace(table, corrected(rows.filter(where)))
    return table.read(spark)


AUDIT_NAMES = {"batch": "INF_BATCH_ID", "session": "INF_SESS_NAME"}


@query(replaced_sql("batch = 10 AND session = 'daily'"))
def replace_batch(spark: SparkSession, folder: str) -> DataFrame:
    """A batch of one session in a table by machine, whose partitions it has to look for."""
    schema = T.StructType([T.StructField(AUDIT_NAMES.get(f.name, f.name), f.dataType) for f in SCHEMA])
    table = Lake(scratch_path(spark, "lake")).table("process", "events", schema, ("machine",))
    rows = seed(spark, folder).withColumnsRenamed(AUDIT_NAMES)
    loads.create_table(spark, table)
    loads.append(table, rows)
    fresh = corrected(rows.filter((F.col("INF_BATCH_ID") == 10) & (F.col("INF_SESS_NAME") == "daily")))
    for _ in range(2):
        loads.replace_batch(table, fresh, 10, "daily")
    return table.read(spark).withColumnsRenamed({new: old for old, new in AUDIT_NAMES.items()})


@query(
    replaced_sql(
        "ts BETWEEN TIMESTAMP '2024-01-09 07:00:01' AND TIMESTAMP '2024-01-15 07:00:00'"
    )
)
def replace_window(spark: SparkSession, folder: str) -> DataFrame:
    window = span_window(date(2024, 1, 9), date(2024, 1, 15))
    return replace_twice(
        spark,
        folder,
        ("day",),
        in_window("ts", window),
        lambda table, rows: loads.replace_window(table, rows, "ts", window, day="day"),
    )


@query(
    replaced_sql(
        "batch IN (SELECT batch FROM seed WHERE value > 250)", keep="machine <> 'error'"
    )
)
def replace_by_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Batches with a high value are replaced, without their errors."""
    table, rows = seeded(spark, folder, "batch")
    keys = rows.filter(F.col("value") > 250).select("batch")
    fresh = rows.join(keys.distinct(), "batch", "left_semi").filter(F.col("machine") != "error")
    for _ in range(2):
        loads.replace_by_keys(table, corrected(fresh), keys, ["batch"])
    return table.read(spark)


@query(replaced_sql("day = DATE '2024-01-17'"))
def replace_day(spark: SparkSession, folder: str) -> DataFrame:
    day = datetime.strptime("20240117", "%Y%m%d").date()
    parsed = F.to_date(F.lit("20240117"), "yyyyMMdd")
    return replace_twice(
        spark,
        folder,
        ("day",),
        F.col("day") == parsed,
        lambda table, rows: loads.replace_values(table, rows, {"day": day}),
    )


CLICKS = "machine = 'click' AND day IN (DATE '2024-01-17', DATE '2024-01-18')"


@query(replaced_sql(CLICKS, keep="day = DATE '2024-01-17'"))
def replace_machine_day(spark: SparkSession, folder: str) -> DataFrame:
    """A machine's day is loaded again; a rerun of the next day finds no rows and empties it."""
    table, rows = seeded(spark, folder, "machine", "day")
    days = (date(2024, 1, 17), date(2024, 1, 18))
    own = corrected(rows.filter((F.col("machine") == "click") & (F.col("day") == F.lit(days[0]))))
    for day, fresh in zip(days * 2, (own, own.limit(0)) * 2):
        loads.replace_values(table, fresh, {"machine": "click", "day": day})
    return table.read(spark)


@query(
    f"""WITH seed AS ({SEED_SQL})
        SELECT 'append' AS load, 0 AS deleted, count(*) AS inserted FROM seed
        UNION ALL SELECT 'day', count(*), count(*) FILTER (session = 'daily') FROM seed
        WHERE day = DATE '2024-01-17'
        UNION ALL SELECT 'window', count(*), count(*) FILTER (machine <> 'error') FROM seed
        WHERE ts BETWEEN TIMESTAMP '2024-01-09 07:00:01' AND TIMESTAMP '2024-01-15 07:00:00'
        UNION ALL SELECT 'where', count(*), 0 FROM seed
        WHERE value > 250 AND NOT (day = DATE '2024-01-17' AND session <> 'daily')
          AND NOT (machine = 'error' AND ts BETWEEN TIMESTAMP '2024-01-09 07:00:01'
                                                AND TIMESTAMP '2024-01-15 07:00:00')
        UNION ALL SELECT 'full', NULL, count(*) FROM seed WHERE machine = 'error'"""
)
def load_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What each load says it removed and wrote, counted inside the writes."""
    table, rows = new_table(spark, "day"), seed(spark, folder)
    loads.create_table(spark, table)
    window = span_window(date(2024, 1, 9), date(2024, 1, 15))
    day = date(2024, 1, 17)
    daily = rows.filter((F.col("day") == F.lit(day)) & (F.col("session") == "daily"))
    reports = {
        "append": loads.append(table, rows),
        "day": loads.replace_values(table, daily, {"day": day}),
        "window": loads.replace_window(table, rows.filter("machine <> 'error'"), "ts", window, day="day"),
        "where": loads.replace_where(table, rows.limit(0), F.col("value") > 250),
        "full": loads.load_full(table, rows.filter("machine = 'error'")),
    }
    found = [(name, report.deleted, report.inserted) for name, report in reports.items()]
    return spark.createDataFrame(found, "load string, deleted long, inserted long")


@query(
    """SELECT 'EIS_JIT_CELL' AS table_name, count(*) AS rows_before, 0 AS rows_after FROM supplier
       UNION ALL SELECT 'EIS_MACHINE', count(*), 0 FROM part"""
)
def truncate_layer(spark: SparkSession, folder: str) -> DataFrame:
    """Two staging tables, filled and then reset as before an initial load."""
    lake = Lake(scratch_path(spark, "lake"))
    cells = load(spark, folder, "supplier").select(
        F.col("s_name").alias("JIT_CELL_NO"),
        *[F.lit("x").alias(name) for name in ("LINE_NO", "ROOM", "LOCATION", "JIT_CELL_DIGIT")],
    )
    machines = load(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("MACHINE_NO"), F.col("p_name").alias("MACHINE_NAME")
    )
    tables = {
        name: schemas.staging_table(lake, name, rows.schema)
        for name, rows in (("EIS_JIT_CELL", cells), ("EIS_MACHINE", machines))
    }
    loads.truncate_all(spark, list(tables.values()))
    batch = Batch(1, datetime(2024, 3, 1, 7, 15))
    filled = {
        name: staging.stage_full(tables[name], rows, name, "WA", batch).inserted
        for name, rows in (("EIS_JIT_CELL", cells), ("EIS_MACHINE", machines))
    }
    loads.truncate_all(spark, list(tables.values()))
    found = [(name, filled[name], table.read(spark).count()) for name, table in tables.items()]
    return spark.createDataFrame(found, "table_name string, rows_before long, rows_after int")


@query(replaced_sql("session = 'initial' AND ts >= TIMESTAMP '2024-01-25 00:00:00'"))
def replace_where(spark: SparkSession, folder: str) -> DataFrame:
    where = (F.col("session") == "initial") & (F.col("ts") >= ntz("2024-01-25 00:00:00"))
    return replace_twice(
        spark,
        folder,
        ("machine",),
        where,
        lambda table, rows: loads.replace_where(table, rows, where),
    )
