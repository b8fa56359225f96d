"""Table catalogue.

Column names and types are fixed values: sources and reports depend on them.
Staging tables are not listed column by column: they hold whatever the source
table has, plus the plant and the audit columns; only the columns that later
plans read are stated and checked.
"""

from __future__ import annotations

from pyspark.sql import types as T

from yieldmill.sources.lake import Lake, Table


def ddl(text: str) -> T.StructType:
    """Schema from column text; Spark reads the text, so a session must be active."""
    return T.StructType.fromDDL(text)


PLANTS = ("WA", "WH", "WN")

AUDIT = (
    "REC_ID string, SOURCE_TABLE_NAME string, INF_BATCH_ID int, INF_SESS_NAME string, "
    "DM_MODIFIED_BY string, DM_MODIFIED_DATE timestamp_ntz, DM_CREATED_BY string, "
    "DM_CREATED_DATE timestamp_ntz, DM_DATE_FROM timestamp_ntz, DM_DATE_TO timestamp_ntz"
)

BATCH_CONTROL = "INF_BATCH_ID int, DATE_FROM timestamp_ntz, DATE_TO timestamp_ntz"

# Columns of the source tables that later plans read.
SOURCE_COLUMNS = {
    "EIS_PRODUCT": "PRODUCT_ID string",
    "EIS_PRODUCT_FAMILY": "FAMILY_PRODUCT_ID string, FAMILY_NAME string, STATUS string",
    "EIS_PRODUCT_PART": (
        "PRODUCT_PART_NO string, GL_PRODUCT_CODE string, FIRST_JOB_DIGIT string, "
        "TG_SITE string, PRODUCT_PART_DESC string"
    ),
    "EIS_PRODUCT_OVERALL": (
        "PRODUCT_PART_NO string, PRODUCT_ID string, PROGRAM_NAME string, "
        "PART_TYPE_NAME string, FAMILY_PRODUCT_ID string"
    ),
    "EIS_JIT_CELL": (
        "JIT_CELL_NO string, LINE_NO string, ROOM string, LOCATION string, JIT_CELL_DIGIT string"
    ),
    "EIS_DOCUMENT_EER": (
        "PRODUCT_PART_NO string, JIT_CELL_NO string, EERNO string, "
        "CREATED_DATE timestamp_ntz, MATERIAL_TYPE string, LAT_LOT_TYPE string"
    ),
    "EIS_MACHINE": "MACHINE_NO string, MACHINE_NAME string",
    "EIS_WORK_WEEK": (
        "YEAR string, QUARTER string, MONTH string, WW string, "
        "SAT_FROM_DATE timestamp_ntz, SAT_TO_DATE timestamp_ntz"
    ),
    "EIS_WIP_FA": (
        "PRODUCT_PART_NO string, RUN_NO string, OPERATION_NO string, ROUTING_SEQ int, "
        "INPUT decimal(15,5), OUTPUT decimal(15,5), SCRAP decimal(15,5), "
        "TRANSFER_DATE timestamp_ntz, DATE_IN timestamp_ntz, DATE_OUT timestamp_ntz, "
        "MACHINE_NO string"
    ),
    "EIS_WIP_FA_RUNCARD": (
        "PRODUCT_PART_NO string, RUN_NO string, EER_NO string, CREATED_DATE timestamp_ntz, "
        "JIT_CELL_NO string, APP_NAME string, MPT_PRODUCT_PART_NO string"
    ),
    "EIS_WIP_FA_START_OPERATION": (
        "PRODUCT_PART_NO string, EER_NO string, OPERATION_NO string, TYPE string, STATUS string"
    ),
    "EIS_WIP_FA_WIP_TRANS": (
        "RUN_NO string, OPERATION_NO string, INPUT int, OUTPUT int, SCRAP int, "
        "TRANSFER_DATE timestamp_ntz, WIP_ALREADY string, ACCEPT_ALREADY string, "
        "OQA_SAMPLE int, OQA_DEFECT int, PCK int"
    ),
    "EIS_ROUTING_OPERATION": (
        "PRODUCT_PART_NO string, EER_NO string, OPERATION_NO string, ROUTING_SEQ int"
    ),
    "EIS_OPERATION": "OPERATION_NO string, OPERATION_NAME string, OPERATION_GROUP string",
    "EIS_RUNCARD_CONVERT": (
        "RUN_NO string, FROM_RUN string, CONVERTED_DATE timestamp_ntz, "
        "PRODUCT_PART_NO string, EER_NO string, JIT_CELL_NO string"
    ),
}

TELEMETRY_MESSAGE = (
    "MachineName string, MDLN string, SOFTREV string, CollectedDate timestamp, CEID int, "
    "CollectionEventName string, RPTID int, "
    "Values array<struct<VID:int,Name:string,Value:string>>"
)

TELEMETRY_STAGING = (
    "MACHINENAME string, COLLECTEDDATE timestamp_ntz, CEID int, COLLECTIONEVENTNAME string, "
    "RPTID int, VID int, NAME string, VALUES string"
)

LIMIT_COLUMNS = ["MachineNo", "VariableName", "SpecLCL", "SpecUCL"]

MASTER_COLUMNS = {
    "MFG_DATE_DIM": (
        "DATE_KEY int, DATE_BEGIN date, DATE_END date, WW string, MONTH string, QUARTER string, "
        "YEAR string, DATETIME_BEGIN timestamp_ntz, DATETIME_END timestamp_ntz, "
        "TIME_BEGIN timestamp_ntz, TIME_END timestamp_ntz"
    ),
    "MFG_PRODUCT_DIM": (
        "PRODUCT_PART_NO_KEY int, PRODUCT_PART_NO string, MPT_PART_NO string, "
        "PRODUCT_NAME string, FAMILY_NAME string, PLANT string, TAB string, "
        "GL_PRODUCT_CODE string, FIRST_JOB_DIGIT string, TG_SITE string, "
        "PRODUCT_PART_DESC string, STATUS string"
    ),
    "MFG_LINE_DIM": (
        "LINE_NO_KEY int, LINE_NO string, ROOM string, LOCATION string, PLANT string, "
        "LINE_CODE string, LINE_DIGIT string"
    ),
    "MFG_MACHINE_DIM": (
        "MACHINE_NO_KEY int, MACHINE_NO string, MACHINE_NAME string, MACHINE_GROUP string"
    ),
    "MFG_OPERATION_DIM": (
        "OPERATION_NO_KEY int, OPERATION_NO string, OPERATION_NAME string, PLANT string"
    ),
    "SFC_RUNCARD_DIM": (
        "RUNCARD_NO_KEY int, RUNCARD_NO string, PRODUCT_PART_NO_KEY int, EER_NO string, "
        "LAT_LOT_TYPE string, CREATED_DATE timestamp_ntz, LINE_NO_KEY int, FROM_RUN string, "
        "ETL_DATE timestamp_ntz, PLANT string"
    ),
    "MFG_ROUTING_OPERATION_DIM": (
        "ROUTE_OPERATION_NO_KEY int, OPERATION_NO string, PRODUCT_PART_NO_KEY int, "
        "EER_NO string, OPERATION_NAME string, OPERATION_SEQ string, LOT_TYPE string, "
        "ROUTING_SEQ_START_YIELD int, ROUTING_SEQ_END_YIELD int, YIELD string"
    ),
    "DATA_CON_PARAM_SPEC": "MachineNo string, VariableName string, SpecLCL int, SpecUCL int",
}

PROCESS_COLUMNS = {
    "SFC_WIP_RUNCARD_FACT": (
        "DATE_KEY int, LINE_NO_KEY int, ROUTE_OPERATION_NO_KEY int, RUNCARD_NO_KEY int, "
        "MACHINE_NO_KEY int, INPUT_QTY decimal(15,5), OUTPUT_QTY decimal(15,5), "
        "SCRAP_QTY decimal(15,5), DATE_IN timestamp_ntz, DATE_OUT timestamp_ntz, "
        "ETL_DATE timestamp_ntz, EN_OPERATE string"
    ),
    "FACT_DATA_CON_TRANSACTION": (
        "MachineNo string, CreateDate timestamp_ntz, Date date, Second timestamp_ntz, Time int, "
        "Date_7 date, CeId int, CollectionEventName string, RptId int, Vid int, "
        "VariableName string, Value string, Status string, SpecLCL int, SpecUCL int"
    ),
}

MART_COLUMNS = {
    "CUMULATIVE_YIELD": (
        "DATE_BEGIN date, WW string, MMM string, QUARTER string, PRODUCT_FAMILY string, "
        "MPT_PART_NO string, LINE_NO string, LAT_LOT_TYPE string, OPERATION_NO string, "
        "INPUT_QTY decimal(25,5), OUTPUT_QTY decimal(25,5), SCRAP_QTY decimal(25,5), "
        "OPERATION_YIELD decimal(15,2), CUM_YIELD decimal(15,2)"
    ),
    "DATA_CON_TRANSACTION": (
        "MachineNo string, CeId int, CollectionEventName string, RptId int, Vid int, "
        "Status string, Date date, Value decimal(20,2), VariableName string, Trigger int, "
        "LCL double, UCL double, MEAN decimal(10,2), SIGMA decimal(10,2), CPK decimal(10,2), "
        "LCL_DOTSIZE string, UCL_DOTSIZE string, MEAN_DOTSIZE decimal(10,2), "
        "SIGMA_DOTSIZE decimal(10,2), CPK_DOTSIZE decimal(10,2)"
    ),
}

# Columns that tables have beside those of their source, for their partitions: the
# production day of a move, blocks of a million run-card keys, the slice of a load and
# the micro-batch of a stream.
PARTITION_COLUMNS = {
    "EIS_WIP_FA": "TRANSFER_DAY date",
    "EIS_WIP_FA_WIP_TRANS": "TRANSFER_DAY date",
    "SFC_RUNCARD_DIM": "KEY_BLOCK int",
    "FACT_DATA_CON_TRANSACTION": "INF_SLICE_ID bigint",
}
KEY_BLOCK = 1_000_000

# Partition columns follow the predicates of the replace loads and of the readers:
# plant for dimensions, production day and batch for staged moves, production day for
# the run-card fact and the yield mart, machine and day for telemetry.  What a load may
# have to repeat after a crash (a slice, a micro-batch) is a partition of its own.
PARTITIONS = {
    "EIS_WIP_FA": ("PLANT", "TRANSFER_DAY", "INF_BATCH_ID"),
    "EIS_WIP_FA_WIP_TRANS": ("PLANT", "TRANSFER_DAY", "INF_BATCH_ID"),
    "SFC_RUNCARD_DIM": ("PLANT", "KEY_BLOCK"),
    "MFG_DATE_DIM": (),
    "MFG_MACHINE_DIM": (),
    "MFG_ROUTING_OPERATION_DIM": ("INF_SESS_NAME",),
    "SFC_WIP_RUNCARD_FACT": ("INF_SESS_NAME", "DATE_KEY"),
    "FACT_DATA_CON_TRANSACTION": ("MachineNo", "Date", "INF_SLICE_ID"),
    "DATA_CON_PARAM_SPEC": (),
    "DATA_CON_TRANSACTION": ("Date",),
    "CUMULATIVE_YIELD": ("DATE_BEGIN",),
}


# The history that a day's runs are looked up in, by what it is joined on.
BUCKETS = {
    "EIS_WIP_FA": ("RUN_NO",),
    "EIS_WIP_FA_WIP_TRANS": ("RUN_NO",),
    "EIS_WIP_FA_RUNCARD": ("RUN_NO",),
    "EIS_DOCUMENT_EER": ("PRODUCT_PART_NO", "EERNO", "JIT_CELL_NO"),
}

# Report order of the yield mart; its first column is the partition.
SORTED = {
    "CUMULATIVE_YIELD": ("PRODUCT_FAMILY", "MPT_PART_NO", "LINE_NO", "LAT_LOT_TYPE", "OPERATION_NO"),
}


def with_audit_columns(schema: T.StructType, name: str | None = None) -> T.StructType:
    """The columns, the audit columns, and those that the table is partitioned by."""
    own = ddl(PARTITION_COLUMNS[name]).fields if name in PARTITION_COLUMNS else []
    return T.StructType(schema.fields + ddl(AUDIT).fields + own)


def staging_schema(source: T.StructType, name: str) -> T.StructType:
    """Staging columns of a source table; fails when a needed column is missing."""
    missing = [f.name for f in ddl(SOURCE_COLUMNS[name]).fields if f.name not in source.names]
    if missing:
        raise ValueError(f"{name} lacks {', '.join(missing)}")
    plant = T.StructField("PLANT", T.StringType())
    own = [f for f in source.fields if f.name != "PLANT"]
    return with_audit_columns(T.StructType(own + [plant]), name)


def staging_table(lake: Lake, name: str, source: T.StructType | None = None) -> Table:
    """Staging table; by default with only the columns that later plans read."""
    schema = staging_schema(source or ddl(SOURCE_COLUMNS[name]), name)
    return lake.table(
        "staging", name, schema, PARTITIONS.get(name, ("PLANT",)), bucket_by=BUCKETS.get(name, ())
    )


def telemetry_staging_table(lake: Lake, name: str = "STAGING_DTC_TRANSACTION") -> Table:
    """Staged telemetry, by machine, day and micro-batch of the stream that brought it.

    The second partition column holds the collection day, or the day of arrival
    for the table that feeds the incremental fact.
    """
    day = "CREATE_DATE" if name.endswith("_REDIS") else "COLLECTED_DAY"
    schema = with_audit_columns(ddl(TELEMETRY_STAGING)).add(day, T.DateType())
    schema = schema.add("STREAM_BATCH", T.StringType())
    return lake.table("staging", name, schema, ("MACHINENAME", day, "STREAM_BATCH"))


def master_table(lake: Lake, name: str) -> Table:
    schema = with_audit_columns(ddl(MASTER_COLUMNS[name]), name)
    return lake.table("master", name, schema, PARTITIONS.get(name, ("PLANT",)))


def process_table(lake: Lake, name: str) -> Table:
    plain = name.removesuffix("_TEST")
    schema = with_audit_columns(ddl(PROCESS_COLUMNS[plain]), plain)
    return lake.table("process", name, schema, PARTITIONS[plain])


def mart_table(lake: Lake, name: str) -> Table:
    plain = name.removesuffix("_TEST")
    return lake.table("mart", name, ddl(MART_COLUMNS[plain]), PARTITIONS[plain], SORTED.get(plain, ()))


def control_table(lake: Lake) -> Table:
    return lake.table("control", "INF_BATCH_ID_CTRL", ddl(BATCH_CONTROL))


def slice_table(lake: Lake) -> Table:
    """Slices of streams by target: a row when one is opened and one when it is loaded."""
    columns = "STREAM string, TARGET string, SLICE bigint, AFTER timestamp_ntz, UPTO timestamp_ntz, DONE boolean"
    return lake.table("control", "LOAD_SLICES", ddl(columns))


def change_table(lake: Lake) -> Table:
    """Days of a fact that a load is about to change; a NULL day stands for all."""
    return lake.table("control", "CHANGED_DAYS", ddl("TABLE_NAME string, DATE_KEY int, CHANGE bigint"))


def build_table(lake: Lake) -> Table:
    """The last change that each build of a mart has seen."""
    return lake.table("control", "MART_BUILDS", ddl("MART string, CHANGE bigint"))


def all_tables(lake: Lake) -> list[Table]:
    """Every table of the lakehouse, for creation and for the reset."""
    return [
        *[staging_table(lake, name) for name in SOURCE_COLUMNS],
        telemetry_staging_table(lake),
        telemetry_staging_table(lake, "STAGING_DTC_TRANSACTION_REDIS"),
        telemetry_staging_table(lake, "STAGING_DTC_TRANSACTION_TEST"),
        *[master_table(lake, name) for name in MASTER_COLUMNS],
        *[process_table(lake, name) for name in PROCESS_COLUMNS],
        process_table(lake, "FACT_DATA_CON_TRANSACTION_TEST"),
        *[mart_table(lake, name) for name in MART_COLUMNS],
        mart_table(lake, "DATA_CON_TRANSACTION_TEST"),
        control_table(lake),
        slice_table(lake),
        change_table(lake),
        build_table(lake),
    ]
