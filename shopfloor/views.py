"""The driver's tables seen as a plant.

Orders are run cards, their customers products, their status the document, their
priority the line; line items are moves, suppliers are machines, events are
telemetry.  Every view covers its whole tables.
``SQL`` holds the same views for DuckDB.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PLANT = "WA"
AS_OF = datetime(2024, 2, 1, 8, 30, 0)
# All dates of the driver's orders and shipments lie inside.
WHOLE = (datetime(1994, 12, 31, 7, 0, 1), datetime(2002, 1, 1, 7, 0, 0))
LOOK_BACK_AS_OF = date(1997, 6, 30)
FIRST_DAY, LAST_DAY = date(1994, 12, 31), date(2001, 12, 31)


# Columns of the driver's tables, so that no job is needed to infer them.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def later(ts: str, seconds: str) -> Column:
    """Timestamp moved on by the whole seconds of a number."""
    return F.timestamp_add("SECOND", F.floor(seconds), F.col(ts))


def run_no(key: str) -> Column:
    return F.concat(F.lit("R"), F.lpad(F.col(key).cast("string"), 10, "0"))


def code(number: Column) -> Column:
    return F.lpad((number * 10).cast("string"), 4, "0")


def product_no(customer: str) -> Column:
    """Name of a customer, which is its number in a fixed form."""
    return F.concat(F.lit("Customer#"), F.lpad(F.col(customer).cast("string"), 9, "0"))


def document_no(status: str) -> Column:
    return F.concat(F.lit("EER-"), F.col(status))


def lot_type(document: str) -> Column:
    number = F.col(document)
    return F.when(number == "EER-F", "MAT").when(number == "EER-O", "UDP").otherwise("NRM")


def created() -> Column:
    return later("o_orderdate", "o_totalprice")


def cards(spark: SparkSession, folder: str) -> DataFrame:
    """Run cards: one per order."""
    priority = F.col("o_orderpriority")
    return load(spark, folder, "orders").select(
        product_no("o_custkey").alias("PRODUCT_PART_NO"),
        run_no("o_orderkey").alias("RUN_NO"),
        document_no("o_orderstatus").alias("EER_NO"),
        created().alias("CREATED_DATE"),
        priority.alias("JIT_CELL_NO"),
        F.when(priority == "1-URGENT", "PSUDO").when(priority == "2-HIGH", "MES").alias("APP_NAME"),
        F.concat(F.lit("MPT"), F.floor(F.col("o_custkey") / 10).cast("string")).alias(
            "MPT_PRODUCT_PART_NO"
        ),
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
    )


def docs(spark: SparkSession, folder: str) -> DataFrame:
    """Documents: one per product, line and status that has orders."""
    first = (
        load(spark, folder, "orders")
        .groupBy("o_custkey", "o_orderpriority", "o_orderstatus")
        .agg(F.min(created()).alias("CREATED_DATE"))
    )
    return first.select(
        product_no("o_custkey").alias("PRODUCT_PART_NO"),
        F.col("o_orderpriority").alias("JIT_CELL_NO"),
        document_no("o_orderstatus").alias("EERNO"),
        "CREATED_DATE",
        F.when(F.col("o_orderpriority") == "5-LOW", "RAW").otherwise("WIP").alias("MATERIAL_TYPE"),
    ).withColumn("LAT_LOT_TYPE", lot_type("EERNO"))


def moves(spark: SparkSession, folder: str) -> DataFrame:
    """Moves: one per line item, with missing and negative quantities."""
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    quantity = F.col("l_quantity")
    lost = quantity * F.col("l_discount")
    rejected = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    shipped = later("l_shipdate", "l_extendedprice")
    return (
        load(spark, folder, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            product_no("o_custkey").alias("PRODUCT_PART_NO"),
            run_no("l_orderkey").alias("RUN_NO"),
            code(F.col("l_linenumber")).alias("OPERATION_NO"),
            (F.col("l_linenumber") * 10).cast("int").alias("ROUTING_SEQ"),
            F.when(F.col("l_tax") != 0, quantity.cast("decimal(15,5)")).alias("INPUT"),
            F.when(rejected, F.lit(-1).cast("decimal(15,5)"))
            .otherwise((quantity - lost).cast("decimal(15,5)"))
            .alias("OUTPUT"),
            F.when(F.col("l_discount") != 0, lost.cast("decimal(15,5)")).alias("SCRAP"),
            shipped.alias("TRANSFER_DATE"),
            F.col("l_shipdate").alias("DATE_IN"),
            (shipped + F.expr("INTERVAL '1' HOUR")).alias("DATE_OUT"),
            F.concat(
                F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")
            ).alias("MACHINE_NO"),
            document_no("o_orderstatus").alias("EER_NO"),
        )
    )


def routing(spark: SparkSession, folder: str, numbers: list[int] | None = None) -> DataFrame:
    """Routing steps that occur in the moves, reduced to distinct numbers before naming them."""
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    if numbers is not None:
        lines = lines.filter(F.col("l_linenumber").isin(numbers))
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    steps = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("o_custkey", "o_orderstatus", "l_linenumber")
        .distinct()
    )
    return steps.select(
        product_no("o_custkey").alias("PRODUCT_PART_NO"),
        document_no("o_orderstatus").alias("EER_NO"),
        code(F.col("l_linenumber")).alias("OPERATION_NO"),
        (F.col("l_linenumber") * 10).cast("int").alias("ROUTING_SEQ"),
    )


def operations(spark: SparkSession, folder: str) -> DataFrame:
    """Operations: the line numbers; six and seven belong to the transaction groups."""
    number = F.col("l_linenumber")
    return (
        load(spark, folder, "lineitem")
        .select("l_linenumber")
        .distinct()
        .select(
            code(number).alias("OPERATION_NO"),
            F.concat(F.lit(" Step "), number.cast("string"), F.lit(" ")).alias("OPERATION_NAME"),
            F.when(number == 6, "LAT").when(number == 7, "PACK").otherwise("ASSY").alias(
                "OPERATION_GROUP"
            ),
        )
    )


# Role of a line number on its route.
ROLES = {2: "YIELD", 5: "ENDYI", 6: "LAT", 7: "PACK"}


def start_ops(spark: SparkSession, folder: str) -> DataFrame:
    """Start operations: the routing steps with a role."""
    role = F.lit(None).cast("string")
    for number, name in ROLES.items():
        role = F.when(F.col("ROUTING_SEQ") == number * 10, name).otherwise(role)
    return routing(spark, folder, list(ROLES)).select(
        "PRODUCT_PART_NO",
        "EER_NO",
        "OPERATION_NO",
        role.alias("TYPE"),
        F.when(F.col("EER_NO") == "EER-P", "CLOSED").otherwise("ACTIVE").alias("STATUS"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """LAT and PACK transactions among others: one per line item."""
    number = F.col("l_linenumber")
    quantity = F.col("l_quantity").cast("int")
    flag = F.col("l_returnflag")
    return load(spark, folder, "lineitem").select(
        run_no("l_orderkey").alias("RUN_NO"),
        F.when(number == 6, "480").when(number == 7, "490").otherwise(code(number)).alias(
            "OPERATION_NO"
        ),
        quantity.alias("INPUT"),
        (quantity - 1).alias("OUTPUT"),
        F.lit(1).alias("SCRAP"),
        (later("l_shipdate", "l_extendedprice")).alias("TRANSFER_DATE"),
        F.when(flag == "R", "N").otherwise("Y").alias("WIP_ALREADY"),
        F.when(F.col("l_tax") < 0.06, "Y").otherwise("N").alias("ACCEPT_ALREADY"),
        F.when(flag == "A", 2).alias("OQA_SAMPLE"),
        F.when(flag == "N", 3).alias("OQA_DEFECT"),
        F.when(F.col("l_discount") > 0.05, 1).alias("PCK"),
    )


def days(spark: SparkSession, folder: str) -> DataFrame:
    """The days with orders or shipments."""
    ordered = load(spark, folder, "orders").select(F.to_date("o_orderdate").alias("DATE_BEGIN"))
    shipped = load(spark, folder, "lineitem").select(F.to_date("l_shipdate").alias("DATE_BEGIN"))
    return ordered.distinct().unionByName(shipped.distinct()).distinct()


def weeks(spark: SparkSession, folder: str) -> DataFrame:
    """Work weeks, Saturday to Saturday, of the days with orders or shipments."""
    start = F.date_sub(F.next_day("DATE_BEGIN", "Sat"), 7)
    return days(spark, folder).select(start.alias("start")).distinct().select(
        F.year("start").cast("string").alias("YEAR"),
        F.concat(F.lit("Q"), F.quarter("start").cast("string")).alias("QUARTER"),
        F.month("start").cast("string").alias("MONTH"),
        F.date_format("start", "yyyyMMdd").alias("WW"),
        F.col("start").cast("timestamp_ntz").alias("SAT_FROM_DATE"),
        F.date_add("start", 7).cast("timestamp_ntz").alias("SAT_TO_DATE"),
    )


def card_dim(spark: SparkSession, folder: str) -> DataFrame:
    """Run-card dimension of all orders."""
    return cards(spark, folder).select(
        (F.col("o_orderkey") + 100_000_001).alias("RUNCARD_NO_KEY"),
        F.col("RUN_NO").alias("RUNCARD_NO"),
        (F.col("o_custkey") + 100_000_001).alias("PRODUCT_PART_NO_KEY"),
        "EER_NO",
        lot_type("EER_NO").alias("LAT_LOT_TYPE"),
        "CREATED_DATE",
        line_key("JIT_CELL_NO").alias("LINE_NO_KEY"),
        F.lit(None).cast("string").alias("FROM_RUN"),
        F.lit(PLANT).alias("PLANT"),
    )


def line_key(cell: str) -> Column:
    return (F.substring(F.col(cell), 1, 1).cast("int") + 100_000_000).cast("int")


def product_dim(spark: SparkSession, folder: str) -> DataFrame:
    """Product dimension of all customers."""
    customer, nation = load(spark, folder, "customer"), load(spark, folder, "nation")
    region = load(spark, folder, "region")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            (F.col("c_custkey") + 100_000_001).alias("PRODUCT_PART_NO_KEY"),
            F.col("c_name").alias("PRODUCT_PART_NO"),
            F.col("n_name").alias("MPT_PART_NO"),
            F.col("r_name").alias("FAMILY_NAME"),
            F.lit(PLANT).alias("PLANT"),
        )
    )


def line_dim(spark: SparkSession, folder: str) -> DataFrame:
    """Line dimension of the order priorities."""
    return (
        load(spark, folder, "orders")
        .select("o_orderpriority")
        .distinct()
        .select(
            line_key("o_orderpriority").alias("LINE_NO_KEY"),
            F.col("o_orderpriority").alias("LINE_NO"),
            F.lit(PLANT).alias("PLANT"),
        )
    )


def machine_dim(spark: SparkSession, folder: str) -> DataFrame:
    """Machine dimension of the suppliers with a positive balance."""
    return (
        load(spark, folder, "supplier")
        .filter(F.col("s_acctbal") > 0)
        .select(
            (F.col("s_suppkey") + 100_000_001).alias("MACHINE_NO_KEY"),
            F.col("s_name").alias("MACHINE_NO"),
        )
    )


def edges(spark: SparkSession, folder: str) -> DataFrame:
    """Run conversions: every order but the first comes from an earlier one.

    Filled orders follow the order just before them, the others branch off the
    order with half their number, which gives chains and forks.
    """
    key = F.col("o_orderkey")
    source = F.when(F.col("o_orderstatus") == "F", key - 1).otherwise(F.floor(key / 2))
    rows = cards(spark, folder).filter(key > 0).withColumn("_from", source)
    return rows.select(
        "RUN_NO",
        run_no("_from").alias("FROM_RUN"),
        F.col("CREATED_DATE").alias("CONVERTED_DATE"),
        "PRODUCT_PART_NO",
        "EER_NO",
        "JIT_CELL_NO",
    )


def merged_edges(spark: SparkSession, folder: str) -> DataFrame:
    """``edges``, where pending orders come from a second order, that with a third of their number."""
    rows = cards(spark, folder).filter((F.col("o_orderkey") > 0) & (F.col("o_orderstatus") == "P"))
    second = rows.withColumn("_from", F.floor(F.col("o_orderkey") / 3)).select(
        "RUN_NO", run_no("_from").alias("FROM_RUN"), F.col("CREATED_DATE").alias("CONVERTED_DATE"),
        "PRODUCT_PART_NO", "EER_NO", "JIT_CELL_NO",
    )
    return edges(spark, folder).unionByName(second)


# Variable, id and message kind of each event type.
VARIABLES = {
    "click": "BondForce",
    "view": "bondforcefloat",
    "purchase": "PbiQuality",
    "error": "DispenserPressure ",
    "signup": "",
}
VARIABLE_IDS = {"click": 1, "view": 2, "purchase": 3, "error": 4, "signup": 5}


def by_type(values: dict[str, object]) -> Column:
    chosen = F.lit(None)
    for name, value in values.items():
        chosen = F.when(F.col("event_type") == name, F.lit(value)).otherwise(chosen)
    return chosen


def machine_name() -> Column:
    """Ten machines, with a suffix after the machine number."""
    number = (F.col("user_id") % 10 + 140).cast("string")
    return F.concat(F.lit("dtc"), number, F.lit("-eq"))


def measured() -> Column:
    """Value as text; large error values are no numbers."""
    text = F.col("value").cast("string")
    return F.when((F.col("event_type") == "error") & (F.col("value") > 150), "n/a").otherwise(text)


def telemetry(spark: SparkSession, folder: str) -> DataFrame:
    """Staged telemetry: one row per event, which arrives five minutes after it."""
    arrival = F.col("ts") + F.expr("INTERVAL '5' MINUTE")
    return load(spark, folder, "events").select(
        machine_name().alias("MACHINENAME"),
        F.col("ts").alias("COLLECTEDDATE"),
        F.when(F.col("value") < 50, 1).otherwise(2).alias("CEID"),
        F.lit("Sample").alias("COLLECTIONEVENTNAME"),
        F.lit(10).alias("RPTID"),
        by_type(VARIABLE_IDS).cast("int").alias("VID"),
        by_type(VARIABLES).alias("NAME"),
        measured().alias("VALUES"),
        F.concat(F.lit("REC_"), F.col("event_id").cast("string")).alias("REC_ID"),
        arrival.alias("DM_CREATED_DATE"),
        F.to_date(arrival).alias("CREATE_DATE"),
    )


def limits(spark: SparkSession, folder: str) -> DataFrame:
    """Control limits from the range of the values of each machine and variable.

    The lower limit of one variable is zero, one variable has a second row in
    another spelling, one has none.
    """
    ranges = (
        load(spark, folder, "events")
        .filter(F.col("event_type") != "signup")
        .groupBy(F.upper(F.substring(machine_name(), 1, 6)).alias("MachineNo"), "event_type")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"))
    )
    bounds = ranges.select(
        "MachineNo",
        by_type(VARIABLES).alias("VariableName"),
        F.when(F.col("event_type") == "purchase", 0)
        .otherwise(F.floor("low") + 1)
        .cast("int")
        .alias("SpecLCL"),
        F.floor("high").cast("int").alias("SpecUCL"),
    )
    second = bounds.filter(F.col("VariableName") == "BondForce").withColumn(
        "VariableName", F.lit("BONDFORCE")
    )
    return bounds.unionByName(second)


# Lines of the log: a message in each spelling, a broken one, one without values
# and one without a message.
def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Log lines: one per event, with the value and the property as variables."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    message = F.concat(
        F.lit('{"MachineName":"'),
        machine_name(),
        F.lit('","MDLN":"M1","SOFTREV":"1.0","CollectedDate":"'),
        stamp,
        F.lit('","CEID":'),
        F.col("event_id").cast("string"),
        F.lit(',"CollectionEventName":"'),
        F.col("event_type"),
        F.lit('","RPTID":10,"Values":['),
        F.when(
            F.col("event_type") != "signup",
            F.concat(
                F.lit('{"VID":1,"Name":"value","Value":"'),
                F.col("value").cast("string"),
                F.lit('"},{"VID":2,"Name":"props","Value":"'),
                F.get_json_object("props", "$.k"),
                F.lit('"}'),
            ),
        ).otherwise(""),
        F.lit("]}"),
    )
    kind = F.col("event_type")
    line = (
        F.when(kind == "view", F.concat(F.lit("INFO collected: "), message))
        .when(kind == "error", F.concat(F.lit("WARN Collected: {broken "), F.col("props")))
        .when(kind == "purchase", F.concat(F.lit("INFO Collected:"), message))
        .otherwise(F.concat(F.lit("INFO Collected:   "), message))
    )
    return load(spark, folder, "events").select(line.alias("value"), kind.alias("kind"), "ts")


def json_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The messages without their marks, one per line; those of errors are broken JSON."""
    message = F.regexp_extract("value", r"(\{.*\})", 1)
    return log_lines(spark, folder).select(message.alias("value"))


SQL: dict[str, str] = {
    "cards": """
        SELECT 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS PRODUCT_PART_NO,
               'R' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS RUN_NO,
               'EER-' || o_orderstatus AS EER_NO,
               o_orderdate + to_seconds(CAST(floor(o_totalprice) AS BIGINT)) AS CREATED_DATE,
               o_orderpriority AS JIT_CELL_NO,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'PSUDO' WHEN '2-HIGH' THEN 'MES' END
                   AS APP_NAME,
               'MPT' || (o_custkey // 10) AS MPT_PRODUCT_PART_NO,
               o_orderkey, o_custkey, o_orderstatus
        FROM orders""",
    "docs": """
        SELECT PRODUCT_PART_NO, JIT_CELL_NO, EER_NO AS EERNO, min(CREATED_DATE) AS CREATED_DATE,
               CASE EER_NO WHEN 'EER-F' THEN 'MAT' WHEN 'EER-O' THEN 'UDP' ELSE 'NRM' END
                   AS LAT_LOT_TYPE,
               CASE JIT_CELL_NO WHEN '5-LOW' THEN 'RAW' ELSE 'WIP' END AS MATERIAL_TYPE
        FROM cards GROUP BY PRODUCT_PART_NO, JIT_CELL_NO, EER_NO""",
    "moves": """
        SELECT 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS PRODUCT_PART_NO,
               'R' || lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS RUN_NO,
               lpad(CAST(l_linenumber * 10 AS VARCHAR), 4, '0') AS OPERATION_NO,
               CAST(l_linenumber * 10 AS INTEGER) AS ROUTING_SEQ,
               CASE WHEN l_tax <> 0 THEN CAST(l_quantity AS DECIMAL(15,5)) END AS INPUT,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN CAST(-1 AS DECIMAL(15,5))
                    ELSE CAST(l_quantity - l_quantity * l_discount AS DECIMAL(15,5)) END AS OUTPUT,
               CASE WHEN l_discount <> 0 THEN CAST(l_quantity * l_discount AS DECIMAL(15,5)) END
                    AS SCRAP,
               l_shipdate + to_seconds(CAST(floor(l_extendedprice) AS BIGINT)) AS TRANSFER_DATE,
               l_shipdate AS DATE_IN,
               l_shipdate + to_seconds(CAST(floor(l_extendedprice) AS BIGINT))
                   + INTERVAL 1 HOUR AS DATE_OUT,
               'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS MACHINE_NO,
               'EER-' || o_orderstatus AS EER_NO
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "routing": """
        SELECT DISTINCT PRODUCT_PART_NO, EER_NO, OPERATION_NO, ROUTING_SEQ FROM moves""",
    "operations": """
        SELECT DISTINCT lpad(CAST(l_linenumber * 10 AS VARCHAR), 4, '0') AS OPERATION_NO,
               ' Step ' || l_linenumber || ' ' AS OPERATION_NAME,
               CASE l_linenumber WHEN 6 THEN 'LAT' WHEN 7 THEN 'PACK' ELSE 'ASSY' END
                   AS OPERATION_GROUP
        FROM lineitem""",
    "start_ops": """
        SELECT * FROM (
            SELECT PRODUCT_PART_NO, EER_NO, OPERATION_NO,
                   CASE OPERATION_NO WHEN '0020' THEN 'YIELD' WHEN '0050' THEN 'ENDYI'
                        WHEN '0060' THEN 'LAT' WHEN '0070' THEN 'PACK' END AS TYPE,
                   CASE EER_NO WHEN 'EER-P' THEN 'CLOSED' ELSE 'ACTIVE' END AS STATUS
            FROM routing) WHERE TYPE IS NOT NULL""",
    "transactions": """
        SELECT 'R' || lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS RUN_NO,
               CASE l_linenumber WHEN 6 THEN '480' WHEN 7 THEN '490'
                    ELSE lpad(CAST(l_linenumber * 10 AS VARCHAR), 4, '0') END AS OPERATION_NO,
               CAST(l_quantity AS INTEGER) AS INPUT, CAST(l_quantity AS INTEGER) - 1 AS OUTPUT,
               1 AS SCRAP,
               l_shipdate + to_seconds(CAST(floor(l_extendedprice) AS BIGINT)) AS TRANSFER_DATE,
               CASE l_returnflag WHEN 'R' THEN 'N' ELSE 'Y' END AS WIP_ALREADY,
               CASE WHEN l_tax < 0.06 THEN 'Y' ELSE 'N' END AS ACCEPT_ALREADY,
               CASE l_returnflag WHEN 'A' THEN 2 END AS OQA_SAMPLE,
               CASE l_returnflag WHEN 'N' THEN 3 END AS OQA_DEFECT,
               CASE WHEN l_discount > 0.05 THEN 1 END AS PCK
        FROM lineitem""",
    "weeks": """
        SELECT CAST(year(start) AS VARCHAR) AS YEAR, 'Q' || quarter(start) AS QUARTER,
               CAST(month(start) AS VARCHAR) AS MONTH, strftime(start, '%Y%m%d') AS WW,
               CAST(start AS TIMESTAMP) AS SAT_FROM_DATE,
               CAST(start + 7 AS TIMESTAMP) AS SAT_TO_DATE
        FROM (SELECT DISTINCT CAST(day - CAST((dayofweek(day) + 1) % 7 AS INTEGER) AS DATE) AS start
              FROM (SELECT CAST(o_orderdate AS DATE) AS day FROM orders
                    UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem))""",
    "card_dim": """
        SELECT o_orderkey + 100000001 AS RUNCARD_NO_KEY, RUN_NO AS RUNCARD_NO,
               o_custkey + 100000001 AS PRODUCT_PART_NO_KEY, EER_NO,
               CASE EER_NO WHEN 'EER-F' THEN 'MAT' WHEN 'EER-O' THEN 'UDP'
                    ELSE 'NRM' END AS LAT_LOT_TYPE,
               CREATED_DATE,
               CAST(CAST(left(JIT_CELL_NO, 1) AS INTEGER) + 100000000 AS INTEGER) AS LINE_NO_KEY,
               CAST(NULL AS VARCHAR) AS FROM_RUN, 'WA' AS PLANT
        FROM cards""",
    "product_dim": """
        SELECT c_custkey + 100000001 AS PRODUCT_PART_NO_KEY,
               c_name AS PRODUCT_PART_NO, n_name AS MPT_PART_NO, r_name AS FAMILY_NAME,
               'WA' AS PLANT
        FROM customer JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey""",
    "line_dim": """
        SELECT DISTINCT CAST(CAST(left(o_orderpriority, 1) AS INTEGER) + 100000000 AS INTEGER)
                   AS LINE_NO_KEY, o_orderpriority AS LINE_NO, 'WA' AS PLANT
        FROM orders""",
    "machine_dim": """
        SELECT s_suppkey + 100000001 AS MACHINE_NO_KEY, s_name AS MACHINE_NO
        FROM supplier WHERE s_acctbal > 0""",
    "edges": """
        SELECT RUN_NO,
               'R' || lpad(CAST(CASE WHEN o_orderstatus = 'F' THEN o_orderkey - 1
                                     ELSE o_orderkey // 2 END AS VARCHAR), 10, '0') AS FROM_RUN,
               CREATED_DATE AS CONVERTED_DATE, PRODUCT_PART_NO, EER_NO, JIT_CELL_NO
        FROM cards WHERE o_orderkey > 0""",
    "merged_edges": """
        SELECT * FROM edges UNION ALL
        SELECT RUN_NO, 'R' || lpad(CAST(o_orderkey // 3 AS VARCHAR), 10, '0'), CREATED_DATE,
               PRODUCT_PART_NO, EER_NO, JIT_CELL_NO
        FROM cards WHERE o_orderkey > 0 AND o_orderstatus = 'P'""",
    "telemetry": """
        SELECT 'dtc' || (user_id % 10 + 140) || '-eq' AS MACHINENAME, ts AS COLLECTEDDATE,
               CASE WHEN value < 50 THEN 1 ELSE 2 END AS CEID, 'Sample' AS COLLECTIONEVENTNAME,
               10 AS RPTID,
               CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3
                    WHEN 'error' THEN 4 WHEN 'signup' THEN 5 END AS INTEGER) AS VID,
               CASE event_type WHEN 'click' THEN 'BondForce' WHEN 'view' THEN 'bondforcefloat'
                    WHEN 'purchase' THEN 'PbiQuality' WHEN 'error' THEN 'DispenserPressure '
                    WHEN 'signup' THEN '' END AS NAME,
               CASE WHEN event_type = 'error' AND value > 150 THEN 'n/a'
                    ELSE CAST(value AS VARCHAR) END AS "VALUES",
               'REC_' || event_id AS REC_ID, ts + INTERVAL 5 MINUTE AS DM_CREATED_DATE,
               CAST(ts + INTERVAL 5 MINUTE AS DATE) AS CREATE_DATE
        FROM events""",
    "limits": """
        WITH bounds AS (
            SELECT 'DTC' || (user_id % 10 + 140) AS MachineNo,
                   CASE event_type WHEN 'click' THEN 'BondForce' WHEN 'view' THEN 'bondforcefloat'
                        WHEN 'purchase' THEN 'PbiQuality' WHEN 'error' THEN 'DispenserPressure '
                        END AS VariableName,
                   CAST(CASE event_type WHEN 'purchase' THEN 0 ELSE floor(min(value)) + 1 END
                        AS INTEGER) AS SpecLCL,
                   CAST(floor(max(value)) AS INTEGER) AS SpecUCL
            FROM events WHERE event_type <> 'signup' GROUP BY 1, event_type)
        SELECT * FROM bounds UNION ALL
        SELECT MachineNo, 'BONDFORCE', SpecLCL, SpecUCL FROM bounds
        WHERE VariableName = 'BondForce'""",
}

NEEDS: dict[str, tuple[str, ...]] = {
    "docs": ("cards",),
    "routing": ("moves",),
    "start_ops": ("routing",),
    "card_dim": ("cards",),
    "edges": ("cards",),
    "merged_edges": ("cards", "edges"),
}


def sql(views: str, body: str, **extra: str) -> str:
    """SQL text with the named views, then ``extra`` ones, as common table expressions."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, ()):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in views.split():
        add(name)
    parts = [f"{name} AS ({SQL[name]})" for name in ordered]
    parts += [f"{name} AS ({text})" for name, text in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
