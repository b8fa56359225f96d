"""File streams into staging tables.

The transformations are those of the batch plans.  Every micro-batch is a partition of
its own, named by the stream and its number, which the checkpoint keeps.  A micro-batch
that is replayed after a crash overwrites what its first try left, so every input file
counts once, and batch loads may write the same table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from yieldmill.operators import loads
from yieldmill.sources.lake import Table

STREAM_BATCH = "STREAM_BATCH"
BY_BATCH = "load"  # in rows that no stream brought


def archive_options(archive_dir: str | None) -> dict[str, str]:
    """Move files to ``archive_dir`` once the batch that read them is committed."""
    if archive_dir is None:
        return {}
    return {"cleanSource": "archive", "sourceArchiveDir": archive_dir}


def stream_text(
    spark: SparkSession, path: str, archive_dir: str | None = None, files: int | None = None
) -> DataFrame:
    """Text lines of a growing set of files; ``files`` bounds one micro-batch."""
    reader = spark.readStream.format("text").options(**archive_options(archive_dir))
    if files is not None:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.load(path)


def stream_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    archive_dir: str | None = None,
    files: int | None = None,
) -> DataFrame:
    """JSON objects, one per line, of a growing set of files."""
    reader = spark.readStream.schema(schema).options(**archive_options(archive_dir))
    if files is not None:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.json(path)


def stream_append(
    df: DataFrame,
    table: Table,
    checkpoint: str,
    every: str | None = None,
    landed: Callable[[int, loads.LoadReport], None] | None = None,
) -> StreamingQuery:
    """Add the stream to a staging table that has a partition column STREAM_BATCH.

    Runs for good with ``every`` as the trigger interval, or once over all files
    present when it is None.  ``landed`` gets each micro-batch's number and report.
    """

    def land(rows: DataFrame, number: int) -> None:
        # The id stays with the checkpoint; a new checkpoint starts a new stream.
        stream = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch = F.lit(f"{stream}-{number:010d}")
        report = loads.overwrite_partitions(table, rows.withColumn(STREAM_BATCH, batch))
        if landed is not None:
            landed(number, report)

    writer = df.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()
