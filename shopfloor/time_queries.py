"""Production time, filters and scalar functions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor import views
from shopfloor.registry import query
from shopfloor.views import load, sql
from yieldmill.functions import exprs, prodtime, spc
from yieldmill.operators.audit import scalar_max
from yieldmill.operators.joins import week_of
from yieldmill.plans import dims, telemetry
from yieldmill.plans.marts import operation_yield


def start_sql(ts: str, in_gap: str = "NULL") -> str:
    """Production-day start, stated with the closed window of each day."""
    day = f"date_trunc('day', {ts})"
    return (
        f"CASE WHEN {ts} >= {day} + INTERVAL '07:00:01' THEN CAST({day} + INTERVAL '07:00:01' AS TIMESTAMP) "
        f"WHEN {ts} <= {day} + INTERVAL '07:00:00' "
        f"THEN CAST({day} - INTERVAL 1 DAY + INTERVAL '07:00:01' AS TIMESTAMP) ELSE {in_gap} END"
    )


@query(
    f"""SELECT event_id, {start_sql("ts")} AS day_start,
               {start_sql("ts", "CAST(date_trunc('day', ts) + INTERVAL '07:00:01' AS TIMESTAMP)")}
                   AS day_start_next
        FROM events"""
)
def production_day(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "events").select(
        "event_id",
        prodtime.production_start("ts").alias("day_start"),
        prodtime.production_start("ts", gap="next").alias("day_start_next"),
    )


@query(
    """SELECT event_id, CASE WHEN hour(ts) < 7 THEN CAST(CAST(ts AS DATE) - 1 AS DATE)
                             ELSE CAST(ts AS DATE) END AS production_date
       FROM events"""
)
def production_day_hour(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "events").select(
        "event_id", prodtime.production_date("ts").alias("production_date")
    )


@query(
    """SELECT event_id, ts, 'rerun' AS load FROM events
       WHERE ts BETWEEN TIMESTAMP '2024-01-09 07:00:01' AND TIMESTAMP '2024-01-19 07:00:00'
       UNION ALL
       SELECT event_id, ts, 'daily' FROM events
       WHERE ts BETWEEN TIMESTAMP '2024-01-20 07:00:01' AND TIMESTAMP '2024-01-21 07:00:00'
       UNION ALL
       SELECT event_id, ts, 'initial' FROM events WHERE ts <= TIMESTAMP '2024-01-05 07:00:00'"""
)
def window_filter(spark: SparkSession, folder: str) -> DataFrame:
    events = load(spark, folder, "events").select("event_id", "ts")
    rerun = prodtime.span_window(date(2024, 1, 9), date(2024, 1, 19))
    daily = prodtime.production_window(date(2024, 1, 21))
    parts = [
        (prodtime.in_window("ts", rerun), "rerun"),
        (prodtime.in_window("ts", daily), "daily"),
        (prodtime.until("ts", date(2024, 1, 5)), "initial"),
    ]
    frames = [events.filter(rows).withColumn("load", F.lit(name)) for rows, name in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    sql(
        "moves",
        """SELECT RUN_NO, OPERATION_NO, INPUT, OUTPUT, TRANSFER_DATE FROM moves
           WHERE coalesce(INPUT, 0) > 0 AND OUTPUT >= 0""",
    )
)
def valid_moves(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.moves(spark, folder).filter(exprs.valid_move())
    return rows.select("RUN_NO", "OPERATION_NO", "INPUT", "OUTPUT", "TRANSFER_DATE")


@query(
    sql(
        "telemetry",
        """SELECT REC_ID, DM_CREATED_DATE FROM telemetry
           WHERE DM_CREATED_DATE = (SELECT max(DM_CREATED_DATE) FROM telemetry WHERE CEID = 2)""",
    )
)
def high_watermark(spark: SparkSession, folder: str) -> DataFrame:
    staged = views.telemetry(spark, folder)
    mark = scalar_max(staged, "DM_CREATED_DATE", F.col("CEID") == 2)
    rows = staged.filter(F.col("DM_CREATED_DATE") == prodtime.ntz(mark))
    return rows.select("REC_ID", "DM_CREATED_DATE")


@query(
    sql(
        "telemetry",
        """SELECT REC_ID, MACHINENAME, DM_CREATED_DATE FROM telemetry
           WHERE DM_CREATED_DATE > (SELECT max(DM_CREATED_DATE) FROM telemetry
                                    WHERE CREATE_DATE <= DATE '2024-01-28')
             AND DM_CREATED_DATE <= TIMESTAMP '2024-01-29 18:34:00'
           UNION ALL
           SELECT 'first ' || REC_ID, MACHINENAME, DM_CREATED_DATE FROM telemetry
           WHERE DM_CREATED_DATE <= TIMESTAMP '2024-01-29 18:34:00'""",
    )
)
def incremental_slice(spark: SparkSession, folder: str) -> DataFrame:
    staged = views.telemetry(spark, folder)
    as_of = datetime(2024, 1, 29, 18, 34, 56)
    loaded = F.col("CREATE_DATE") <= F.lit(date(2024, 1, 28))
    mark = scalar_max(staged, "DM_CREATED_DATE", loaded)
    later = telemetry.incremental_slice(staged, mark, as_of)
    first = telemetry.incremental_slice(staged, None, as_of)
    columns = ["REC_ID", "MACHINENAME", "DM_CREATED_DATE"]
    first = first.withColumn("REC_ID", F.concat(F.lit("first "), F.col("REC_ID")))
    return later.select(columns).unionByName(first.select(columns))


@query(
    sql(
        "cards",
        """SELECT RUN_NO, APP_NAME FROM cards WHERE APP_NAME <> 'PSUDO' OR APP_NAME IS NULL""",
    )
)
def null_safe_exclude(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.cards(spark, folder).filter(exprs.differs_or_null("APP_NAME", "PSUDO"))
    return rows.select("RUN_NO", "APP_NAME")


@query(
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag FROM lineitem
       WHERE l_linenumber IN (6, 7) AND l_returnflag NOT IN ('R')"""
)
def route_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = load(spark, folder, "lineitem").filter(
        F.col("l_linenumber").isin(6, 7) & ~F.col("l_returnflag").isin("R")
    )
    return rows.select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag")


@query(
    sql(
        "weeks",
        """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS DATE_BEGIN, WW, MONTH, QUARTER, YEAR
           FROM orders JOIN weeks
             ON CAST(SAT_FROM_DATE AS DATE) <= CAST(o_orderdate AS DATE)
            AND CAST(SAT_TO_DATE AS DATE) >= CAST(o_orderdate AS DATE) + 1""",
    )
)
def calendar_week(spark: SparkSession, folder: str) -> DataFrame:
    days = load(spark, folder, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("DATE_BEGIN")
    )
    return week_of(days, views.weeks(spark, folder))


@query(
    sql(
        "weeks",
        """SELECT DATE_BEGIN, CAST(DATE_BEGIN + 1 AS DATE) AS DATE_END, WW, MONTH, QUARTER, YEAR,
                  DATE_BEGIN + INTERVAL 7 HOUR AS DATETIME_BEGIN,
                  DATE_BEGIN + INTERVAL 31 HOUR AS DATETIME_END,
                  DATE_BEGIN + INTERVAL 7 HOUR AS TIME_BEGIN,
                  DATE_BEGIN + INTERVAL 31 HOUR AS TIME_END
           FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS DATE_BEGIN FROM lineitem) JOIN weeks
             ON CAST(SAT_FROM_DATE AS DATE) <= DATE_BEGIN
            AND CAST(SAT_TO_DATE AS DATE) >= DATE_BEGIN + 1""",
    )
)
def date_dim_source(spark: SparkSession, folder: str) -> DataFrame:
    days = load(spark, folder, "lineitem").select(F.to_date("l_shipdate").alias("DATE_BEGIN"))
    return dims.date_source(views.weeks(spark, folder), dims.day_bounds(days.distinct()))


@query(
    """SELECT p_partkey, trim(' ' || p_name || '  ') AS trimmed, upper(p_name) AS upper_name,
              lower(p_brand) AS lower_brand, p_type || '/' || p_brand AS joined,
              concat_ws('-', p_type, p_brand, p_size) AS separated,
              substr(p_name, 1, 6) AS first_six, right(p_brand, 2) AS last_two,
              length(p_name) AS name_length, length(p_brand) = 8 AS is_eight,
              'DTC' || upper(substr(p_name, 1, 3)) AS machine
       FROM part"""
)
def string_funcs(spark: SparkSession, folder: str) -> DataFrame:
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    return load(spark, folder, "part").select(
        "p_partkey",
        F.trim(F.concat(F.lit(" "), name, F.lit("  "))).alias("trimmed"),
        F.upper(name).alias("upper_name"),
        F.lower(brand).alias("lower_brand"),
        F.concat(kind, F.lit("/"), brand).alias("joined"),
        F.concat_ws("-", kind, brand, F.col("p_size").cast("string")).alias("separated"),
        F.substring(name, 1, 6).alias("first_six"),
        F.right(brand, F.lit(2)).alias("last_two"),
        F.length(name).cast("long").alias("name_length"),
        (F.length(brand) == 8).alias("is_eight"),
        exprs.machine_code(F.concat(F.lit("dtc"), F.substring(name, 1, 3))).alias("machine"),
    )


@query(
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + 1 AS DATE) AS next_day,
              CAST(CAST(o_orderdate AS DATE) - 1000 AS DATE) AS look_back,
              CAST(DATE '2002-01-01' - CAST(o_orderdate AS DATE) AS INTEGER) AS age,
              CAST(month(o_orderdate) AS INTEGER) AS month_number,
              strftime(o_orderdate, '%Y-%m-%d') AS day_text,
              strftime(placed, '%H') AS hour_text, CAST(hour(placed) AS INTEGER) AS hour_number,
              date_trunc('minute', placed) AS to_minute,
              CAST(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS parsed,
              right(CAST(year(o_orderdate) AS VARCHAR), 2) || upper(strftime(o_orderdate, '%b'))
                  AS label,
              right('Q' || quarter(o_orderdate), 1) AS quarter_label,
              placed + INTERVAL 7 HOUR AS local_time
       FROM (SELECT *, o_orderdate + to_seconds(CAST(floor(o_totalprice) AS BIGINT)) AS placed
             FROM orders)"""
)
def date_funcs(spark: SparkSession, folder: str) -> DataFrame:
    day, placed = F.to_date("o_orderdate"), F.col("placed")
    orders = load(spark, folder, "orders").withColumn(
        "placed", views.created()
    )
    quarter = F.concat(F.lit("Q"), F.quarter(day).cast("string"))
    return orders.select(
        "o_orderkey",
        F.date_add(day, 1).alias("next_day"),
        F.date_sub(day, 1000).alias("look_back"),
        F.datediff(F.lit(date(2002, 1, 1)), day).alias("age"),
        F.month(day).alias("month_number"),
        F.date_format(day, "yyyy-MM-dd").alias("day_text"),
        F.date_format(placed, "HH").alias("hour_text"),
        F.hour(placed).alias("hour_number"),
        F.date_trunc("minute", placed).cast("timestamp_ntz").alias("to_minute"),
        F.to_date(F.date_format(day, "yyyyMMdd"), "yyyyMMdd").alias("parsed"),
        prodtime.month_label(day, F.year(day)).alias("label"),
        prodtime.quarter_digit(quarter).alias("quarter_label"),
        prodtime.shift_zone(placed, "Asia/Bangkok").alias("local_time"),
    )


@query(
    sql(
        "moves telemetry",
        """SELECT 'move' AS kind, RUN_NO || OPERATION_NO AS id, coalesce(INPUT, 0) AS quantity,
                  CASE OPERATION_NO WHEN '0060' THEN '480' WHEN '0070' THEN '490'
                       ELSE OPERATION_NO END AS label,
                  SCRAP IS NULL AS no_scrap
           FROM moves
           UNION ALL
           SELECT 'value', REC_ID, coalesce(CAST(try_cast("VALUES" AS DECIMAL(10,2))
                      AS DECIMAL(15,5)), 0),
                  CASE WHEN lower(trim(NAME)) IN ('bondforce', 'bondforcefloat')
                            THEN 'BondForceFloat'
                       WHEN trim(NAME) = '' OR NAME IS NULL THEN '0'
                       WHEN lower(trim(NAME)) = 'dispenserpressure' THEN 'DispenserPressure'
                       WHEN lower(trim(NAME)) = 'pbiquality' THEN 'PbiQuality'
                       ELSE trim(NAME) END,
                  nullif(CEID, 1) IS NULL
           FROM telemetry""",
    )
)
def case_null_funcs(spark: SparkSession, folder: str) -> DataFrame:
    operation = F.col("OPERATION_NO")
    moves = views.moves(spark, folder).select(
        F.lit("move").alias("kind"),
        F.concat("RUN_NO", operation).alias("id"),
        exprs.or_zero("INPUT").alias("quantity"),
        F.when(operation == "0060", "480")
        .when(operation == "0070", "490")
        .otherwise(operation)
        .alias("label"),
        F.col("SCRAP").isNull().alias("no_scrap"),
    )
    values = views.telemetry(spark, folder).select(
        F.lit("value").alias("kind"),
        F.col("REC_ID").alias("id"),
        exprs.or_zero(exprs.text_number("VALUES").cast("decimal(15,5)")).alias("quantity"),
        spc.canonical_name(F.col("NAME")).alias("label"),
        F.nullif(F.col("CEID"), F.lit(1)).isNull().alias("no_scrap"),
    )
    return moves.unionByName(values)


@query(
    """SELECT l_orderkey, l_linenumber, l_suppkey,
              CAST(l_quantity AS DECIMAL(15,5)) AS quantity,
              CAST(l_extendedprice AS DECIMAL(22,3)) AS price,
              CAST(l_discount AS DECIMAL(7,4)) AS discount, CAST(l_tax AS DECIMAL(5,2)) AS tax,
              CAST(floor(l_extendedprice) AS INTEGER) AS whole, CAST(l_shipdate AS DATE) AS ship_day,
              try_cast(l_returnflag || CAST(l_linenumber AS VARCHAR) AS INTEGER) AS not_a_number,
              try_cast(CAST(l_linenumber AS VARCHAR) AS DECIMAL(10,2)) AS text_number,
              CAST(CAST((l_quantity - l_quantity * l_discount) / l_quantity * 100
                   AS DECIMAL(20,9)) AS DECIMAL(15,2)) AS yield_percent,
              least(l_discount, nullif(l_tax, 0)) AS lower_rate, abs(l_discount - l_tax) AS rate_gap
       FROM lineitem"""
)
def decimal_casts(spark: SparkSession, folder: str) -> DataFrame:
    quantity, discount = F.col("l_quantity"), F.col("l_discount")
    return load(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        quantity.cast("decimal(15,5)").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(22,3)").alias("price"),
        discount.cast("decimal(7,4)").alias("discount"),
        F.col("l_tax").cast("decimal(5,2)").alias("tax"),
        F.floor("l_extendedprice").cast("int").alias("whole"),
        F.to_date("l_shipdate").alias("ship_day"),
        F.concat("l_returnflag", F.col("l_linenumber").cast("string"))
        .try_cast("int")
        .alias("not_a_number"),
        exprs.text_number(F.col("l_linenumber").cast("string")).alias("text_number"),
        operation_yield(quantity - quantity * discount, quantity).alias("yield_percent"),
        F.least(discount, F.nullif(F.col("l_tax"), F.lit(0.0))).alias("lower_rate"),
        F.abs(discount - F.col("l_tax")).alias("rate_gap"),
    )
