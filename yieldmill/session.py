"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# AQE splits skewed join partitions and merges small ones at run time; a join
# side is broadcast only when its measured size is under the threshold.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Rows in buckets by run are also joined by run and product without a shuffle.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


# Codec of stored rows: random record ids and long names pack far better than with the default.
COMPRESSION = "zstd"

# Short rows that are worth a file and a task of their own.
FILE_ROWS = 8_192

# A rule that drops empty inputs at run time, and with them the counts taken inside.
EMPTY_RULE = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
EXCLUDED_RULES = "spark.sql.adaptive.optimizer.excludedRules"

# Temporary folders of local sessions without the setting, by application.
LOCAL_FOLDERS: dict[str, str] = {}


def build_session(app: str = "yieldmill", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators expect; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may run without the setting; it then gets a temporary
    folder.  On a cluster a missing setting is an error, because a folder on one
    machine would be lost with it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        app = context.applicationId
        if app not in LOCAL_FOLDERS:
            LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="yieldmill-")
        folder = LOCAL_FOLDERS[app]
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, grouped by application for clean-up."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/yieldmill/{app}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, partition_by: tuple[str, ...] = (), rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage for loops and fixes values that would differ if Spark
    computed the rows again.  The files outlive any executor, and their size is
    known to the planner when it chooses a join.

    With ``rows``, an upper bound of short rows, no more files are written than
    there are cores or than hold ``FILE_ROWS`` each; many near-empty partitions
    would each open a file, and on a local disk start processes for its mode.
    """
    path = scratch_path(df.sparkSession, label)
    if rows is not None:
        df = df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / FILE_ROWS)))
    df.write.partitionBy(*partition_by).parquet(path, compression=COMPRESSION)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> bool:
    """Delete what this application left in the shared folder; False when there is nothing.

    Frames that ``materialise`` returned can no longer be read afterwards.
    """
    jvm = spark.sparkContext._jvm
    folder = f"{shared_folder(spark)}/yieldmill/{spark.sparkContext.applicationId}"
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def keeping_counts(spark: SparkSession) -> Iterator[None]:
    """Inside, no input of a write is dropped as empty before its rows are counted."""
    before = spark.conf.get(EXCLUDED_RULES, None)
    spark.conf.set(EXCLUDED_RULES, ",".join(filter(None, [before, EMPTY_RULE])))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(EXCLUDED_RULES)
        else:
            spark.conf.set(EXCLUDED_RULES, before)
