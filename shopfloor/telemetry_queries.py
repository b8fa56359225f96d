"""Telemetry, control limits and process control."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor import views
from shopfloor.registry import query
from shopfloor.views import sql
from yieldmill import sources, streaming
from yieldmill.functions import spc
from yieldmill.operators import loads
from yieldmill.operators.audit import Batch, with_audit
from yieldmill.plans import marts, schemas, telemetry
from yieldmill.session import scratch_path
from yieldmill.sources.lake import Lake
from yieldmill.warehouse import Warehouse

BATCH = Batch(7, views.AS_OF)

EXPECTED_EVENTS = """
    SELECT 'dtc' || (user_id % 10 + 140) || '-eq' AS MACHINENAME, ts AS COLLECTEDDATE,
           CAST(event_id AS INTEGER) AS CEID, event_type AS COLLECTIONEVENTNAME, 10 AS RPTID,
           variable AS VID, CASE variable WHEN 1 THEN 'value' ELSE 'props' END AS NAME,
           CASE variable WHEN 1 THEN CAST(value AS VARCHAR)
                ELSE json_extract_string(props, '$.k') END AS "VALUES"
    FROM events, (SELECT unnest([1, 2]) AS variable)
    WHERE event_type NOT IN ('error', 'signup')"""


def fact(spark: SparkSession, folder: str) -> DataFrame:
    """Telemetry fact over all staged rows."""
    staged = views.telemetry(spark, folder)
    return telemetry.fact_events(
        staged,
        views.limits(spark, folder),
        BATCH,
        "process_FACT_DATA_CON_TRANSACTION",
        "STAGING_DTC_TRANSACTION_REDIS",
    )


FACT_SQL = """
    SELECT upper(substr(MACHINENAME, 1, 6)) AS MachineNo, COLLECTEDDATE AS CreateDate,
           CAST(COLLECTEDDATE AS DATE) AS Date, CAST(hour(COLLECTEDDATE) AS INTEGER) AS Time,
           CAST(CASE WHEN hour(COLLECTEDDATE) < 7 THEN CAST(COLLECTEDDATE AS DATE) - 1
                ELSE CAST(COLLECTEDDATE AS DATE) END AS DATE) AS Date_7,
           CEID AS CeId, COLLECTIONEVENTNAME AS CollectionEventName, RPTID AS RptId, VID AS Vid,
           NAME AS VariableName, "VALUES" AS Value, 'N' AS Status,
           coalesce(SpecLCL, 0) AS SpecLCL, coalesce(SpecUCL, 0) AS SpecUCL,
           REC_ID, DM_CREATED_DATE
    FROM telemetry LEFT JOIN limits
      ON upper(substr(MACHINENAME, 1, 6)) = MachineNo AND lower(NAME) = lower(VariableName)"""


def dec(expression: str, digits: int = 10) -> str:
    """Double as a decimal with two digits, rounded half up at nine digits first."""
    return f"CAST(CAST({expression} AS DECIMAL(28,9)) AS DECIMAL({digits},2))"


# Means of decimals as Spark rounds them: to six digits, then to two, half up, in
# whole numbers (the values are not negative).
MEAN = (
    "CAST(((((2 * sum(cents) * 10000 + count(cents)) // (2 * count(cents))) + 5000) // 10000)"
    " AS DECIMAL(12,0)) / 100"
)

SPC_SQL = sql(
    "telemetry limits",
    f"""
    SELECT DISTINCT MachineNo, CeId, CollectionEventName, RptId, Vid, Status, Date, Value,
           CASE WHEN lower(trim(name)) IN ('bondforce', 'bondforcefloat') THEN 'BondForceFloat'
                WHEN trim(name) = '' THEN '0'
                WHEN lower(trim(name)) = 'dispenserpressure' THEN 'DispenserPressure'
                WHEN lower(trim(name)) = 'pbiquality' THEN 'PbiQuality'
                ELSE trim(name) END AS VariableName,
           CASE WHEN MachineNo IN ('DTC128', 'DTC147', 'DTC148') THEN 60
                WHEN MachineNo = 'DTC149' AND lower(trim(name)) = 'bondforcefloat' THEN 60
                WHEN lower(trim(name)) = 'pbiquality' THEN 60 ELSE 70 END AS "Trigger",
           LCL, UCL, MEAN, SIGMA,
           CASE WHEN SIGMA = 0 THEN NULL
                WHEN spec = 0 THEN {dec("least(abs(UCL - m) / (3 * s), (m - LCL) / (3 * s))")}
                ELSE {dec("(UCL - m) / (3 * s)")} END AS CPK,
           '170' AS LCL_DOTSIZE, '260' AS UCL_DOTSIZE, MEAN AS MEAN_DOTSIZE,
           SIGMA AS SIGMA_DOTSIZE,
           CASE WHEN m > 0 AND SIGMA <> 0
                THEN abs({dec("least(abs(260 - m) / (3 * s), (m - 170) / (3 * s))")}) END
               AS CPK_DOTSIZE
    FROM groups""",
    fact=FACT_SQL,
    readings="""
        SELECT f.*, l.VariableName AS name, try_cast(Value AS DECIMAL(10,2)) AS v,
               CAST(try_cast(Value AS DECIMAL(10,2)) * 100 AS HUGEINT) AS cents
        FROM fact f JOIN limits l
          ON f.MachineNo = l.MachineNo AND lower(f.VariableName) = lower(l.VariableName)""",
    sums=f"""
        SELECT MachineNo, CeId, CollectionEventName, RptId, Vid, Status, SpecLCL AS spec, name,
               Date, CAST(sum(v) AS DECIMAL(20,2)) AS Value, avg(SpecLCL) AS LCL,
               avg(SpecUCL) AS UCL, CAST({MEAN} AS DECIMAL(10,2)) AS MEAN,
               {dec("stddev_pop(CAST(v AS DOUBLE))")} AS SIGMA
        FROM readings
        GROUP BY MachineNo, CeId, CollectionEventName, RptId, Vid, Status, SpecLCL, name, Date""",
    groups="SELECT *, CAST(MEAN AS DOUBLE) AS m, CAST(SIGMA AS DOUBLE) AS s FROM sums",
)


@query(SPC_SQL)
def spc_daily(spark: SparkSession, folder: str) -> DataFrame:
    return marts.mart_spc(fact(spark, folder), views.limits(spark, folder))


@query(
    sql(
        "telemetry",
        f"""SELECT MACHINENAME, VID, MEAN, SIGMA,
                   CASE WHEN SIGMA <> 0 AND m > 0
                        THEN abs({dec("least(abs(90 - m) / (3 * s), (m - 10) / (3 * s))")}) END
                       AS CPK
            FROM (SELECT *, CAST(MEAN AS DOUBLE) AS m, CAST(SIGMA AS DOUBLE) AS s
                  FROM (SELECT MACHINENAME, VID, CAST({MEAN} AS DECIMAL(10,2)) AS MEAN,
                               {dec("stddev_pop(CAST(v AS DOUBLE))")} AS SIGMA
                        FROM (SELECT *, try_cast("VALUES" AS DECIMAL(10,2)) AS v,
                                     CAST(try_cast("VALUES" AS DECIMAL(10,2)) * 100 AS HUGEINT)
                                         AS cents
                              FROM telemetry)
                        GROUP BY MACHINENAME, VID))""",
    )
)
def spc_fixed_limits(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("VALUES").try_cast("decimal(10,2)")
    groups = views.telemetry(spark, folder).groupBy("MACHINENAME", "VID")
    stats = groups.agg(spc.mean_2(value).alias("MEAN"), spc.sigma_2(value).alias("SIGMA"))
    cpk = spc.capability_between(10, 90, F.col("MEAN"), F.col("SIGMA"))
    return stats.withColumn("CPK", cpk)


@query(
    sql(
        "telemetry",
        """SELECT REC_ID, CASE WHEN MACHINENAME IN ('dtc147-eq', 'dtc148-eq') THEN 60
                   WHEN MACHINENAME = 'dtc149-eq' AND NAME = 'bondforcefloat' THEN 60
                   WHEN NAME = 'PbiQuality' THEN 60 ELSE 70 END AS trigger_limit
           FROM telemetry""",
    )
)
def trigger_limit(spark: SparkSession, folder: str) -> DataFrame:
    machine = F.upper(F.substring("MACHINENAME", 1, 6))
    return views.telemetry(spark, folder).select(
        "REC_ID", spc.trigger_limit(machine, F.col("NAME")).alias("trigger_limit")
    )


@query(
    sql(
        "telemetry limits",
        """SELECT REC_ID, SpecLCL, SpecUCL, 'ignore case' AS match FROM telemetry LEFT JOIN limits
             ON upper(substr(MACHINENAME, 1, 6)) = MachineNo AND lower(NAME) = lower(VariableName)
           UNION ALL
           SELECT REC_ID, SpecLCL, SpecUCL, 'exact' FROM telemetry LEFT JOIN limits
             ON upper(substr(MACHINENAME, 1, 6)) = upper(MachineNo) AND NAME = VariableName""",
    )
)
def limit_match(spark: SparkSession, folder: str) -> DataFrame:
    limits = views.limits(spark, folder)
    events = views.telemetry(spark, folder).select(
        "REC_ID", F.upper(F.substring("MACHINENAME", 1, 6)).alias("machine"), "NAME"
    )
    parts = []
    for ignore_case, label in ((True, "ignore case"), (False, "exact")):
        matched = telemetry.match_limits(events, limits, "machine", "NAME", ignore_case)
        parts.append(matched.select("REC_ID", "SpecLCL", "SpecUCL", F.lit(label).alias("match")))
    return parts[0].unionByName(parts[1])


@query(sql("telemetry limits", "SELECT * FROM fact", fact=FACT_SQL))
def telemetry_fact(spark: SparkSession, folder: str) -> DataFrame:
    return fact(spark, folder).select(
        "MachineNo",
        "CreateDate",
        "Date",
        "Time",
        "Date_7",
        "CeId",
        "CollectionEventName",
        "RptId",
        "Vid",
        "VariableName",
        "Value",
        "Status",
        "SpecLCL",
        "SpecUCL",
        "REC_ID",
        "DM_CREATED_DATE",
    )


@query(EXPECTED_EVENTS)
def json_explode(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.extract_events(views.log_lines(spark, folder).select("value"))


def write_lines(lines: DataFrame, label: str) -> str:
    """The lines as text files below the shared folder, as a machine would leave them."""
    path = scratch_path(lines.sparkSession, label)
    lines.write.partitionBy("kind").text(path)
    return path


@query(EXPECTED_EVENTS)
def log_extract(spark: SparkSession, folder: str) -> DataFrame:
    lines = views.log_lines(spark, folder).select("value", "kind")
    path = write_lines(lines, "log")
    read = sources.read_text(spark, path + "/kind={kind}/*.txt", kind="*")
    return telemetry.extract_events(read)


@query(
    """SELECT 'kind=' || event_type AS folder, count(*) AS lines FROM events GROUP BY event_type"""
)
def file_provenance(spark: SparkSession, folder: str) -> DataFrame:
    path = write_lines(views.log_lines(spark, folder).select("value", "kind"), "log")
    tagged = sources.with_source_file(sources.read_text(spark, f"{path}/*/*.txt"), f"{path}/")
    name = F.substring_index("SOURCE_TABLE_NAME", "/", 1)
    return tagged.groupBy(name.alias("folder")).agg(F.count(F.lit(1)).alias("lines"))


@query(
    sql("limits", "SELECT MachineNo, VariableName, SpecLCL, SpecUCL FROM limits")
)
def limits_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "limits")
    # Trailing blanks are part of a name.
    written = views.limits(spark, folder).select(schemas.LIMIT_COLUMNS)
    written.write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(path)
    raw = sources.read_csv(spark, path, schemas.LIMIT_COLUMNS)
    return telemetry.control_limits(raw)


def staged_events(events: DataFrame) -> DataFrame:
    """Streamed rows as the staging table holds them."""
    audited = telemetry.audited_events(events, "telemetry", BATCH)
    return audited.withColumn("COLLECTED_DAY", F.to_date("COLLECTEDDATE"))


EVENT_COLUMNS = [
    "MACHINENAME",
    "COLLECTEDDATE",
    "CEID",
    "COLLECTIONEVENTNAME",
    "RPTID",
    "VID",
    "NAME",
    "VALUES",
]


def run_stream(spark: SparkSession, rows: DataFrame) -> DataFrame:
    lake = Lake(scratch_path(spark, "lake"))
    table = schemas.telemetry_staging_table(lake)
    loads.create_table(spark, table)
    checkpoint = scratch_path(spark, "stream")
    for _ in range(2):  # the second start finds nothing new
        streaming.stream_append(staged_events(rows), table, checkpoint).awaitTermination()
    return table.read(spark).select(EVENT_COLUMNS)


@query(EXPECTED_EVENTS)
def stream_log_ingest(spark: SparkSession, folder: str) -> DataFrame:
    path = write_lines(views.log_lines(spark, folder).select("value", "kind"), "log")
    lines = streaming.stream_text(spark, f"{path}/*/*.txt", files=16)
    return run_stream(spark, telemetry.extract_events(lines.select("value")))


@query(
    """SELECT 'kind=' || event_type AS folder, count(*) AS lines FROM events GROUP BY event_type"""
)
def stream_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the files that a stream moved to its archive after it had landed them.

    A file is moved when a micro-batch after its own is committed, so a last file
    without lines follows.
    """
    path, archive = (scratch_path(spark, label) for label in ("log", "archive"))
    lines = views.log_lines(spark, folder).select("value", "kind")
    # One file per folder, which the stream reads in one micro-batch.
    lines.repartition("kind").write.partitionBy("kind").text(path)
    table = schemas.telemetry_staging_table(Lake(scratch_path(spark, "lake")))
    loads.create_table(spark, table)
    checkpoint = scratch_path(spark, "stream")
    for last in range(3):
        stream = streaming.stream_text(spark, f"{path}/*/*.txt", archive_dir=archive)
        events = staged_events(telemetry.extract_events(stream.select("value")))
        streaming.stream_append(events, table, checkpoint).awaitTermination()
        none = spark.createDataFrame([], "value string").coalesce(1)
        none.write.mode("append").text(f"{path}/kind=none{last}")
    # The archive repeats the whole path of a file below its own.
    read = sources.with_source_file(
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(archive), archive
    )
    kind = F.regexp_extract("SOURCE_TABLE_NAME", "/(kind=[^/]+)/[^/]+$", 1)
    return read.groupBy(kind.alias("folder")).agg(F.count(F.lit(1)).alias("lines"))


@query(
    sql(
        "telemetry limits",
        """SELECT MachineNo, CAST(Date AS DATE) AS Date, CAST(count(*) AS BIGINT) AS readings, slice
           FROM (SELECT *, CASE WHEN DM_CREATED_DATE <= TIMESTAMP '2024-01-15 12:00:00' THEN 1 ELSE 2 END
                             AS slice FROM fact)
           GROUP BY ALL""",
        fact=FACT_SQL,
    )
)
def telemetry_slices(spark: SparkSession, folder: str) -> DataFrame:
    """Two slices by arrival; the load of each dies once after its rows are written."""
    house = Warehouse(spark, Lake(scratch_path(spark, "lake")))
    limits, staged = schemas.master_table(house.lake, "DATA_CON_PARAM_SPEC"), views.telemetry(spark, folder)
    arrivals = schemas.telemetry_staging_table(house.lake, "STAGING_DTC_TRANSACTION_REDIS")
    target = schemas.process_table(house.lake, "FACT_DATA_CON_TRANSACTION")
    loads.truncate_all(spark, [limits, arrivals, target, schemas.slice_table(house.lake)])
    loads.append(limits, with_audit(views.limits(spark, folder), "limits", "limits", BATCH, ["MachineNo"]))
    columns = {"CREATE_DATE": F.to_date("DM_CREATED_DATE"), "STREAM_BATCH": F.lit("load")}
    rows = telemetry.audited_events(staged.select(*EVENT_COLUMNS, "DM_CREATED_DATE"), "telemetry", BATCH, arrival=F.col("DM_CREATED_DATE"))
    loads.append(arrivals, rows.withColumns(columns).select(arrivals.columns))
    for as_of in (datetime(2024, 1, 15, 12, 0), datetime(2030, 1, 1)):
        dying = DyingWarehouse(spark, house.lake)
        try:
            dying.load_events(Batch(1, as_of))
        except DriverGone:
            house.load_events(Batch(1, as_of))
    fact = target.read(spark).groupBy("MachineNo", "Date", F.col("INF_SLICE_ID").cast("int").alias("slice"))
    return fact.agg(F.count(F.lit(1)).alias("readings"))


class DriverGone(Exception):
    pass


class DyingWarehouse(Warehouse):
    """A warehouse whose driver is lost before it can mark a slice as loaded."""

    def _mark_slice(self, stream, target, part, done):
        if done:
            raise DriverGone
        super()._mark_slice(stream, target, part, done)


@query(EXPECTED_EVENTS)
def stream_json_ingest(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "json")
    views.json_lines(spark, folder).write.text(path)
    messages = streaming.stream_json(spark, f"{path}/*.txt", schemas.TELEMETRY_MESSAGE)
    return run_stream(spark, telemetry.explode_values(messages))
