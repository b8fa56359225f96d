"""Lakehouse tables by layer and name."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from yieldmill.session import COMPRESSION
from yieldmill.sources import folders

VERSION = re.compile(r"v(\d{10})")
TRACKING = "spark.sql.hive.manageFilesourcePartitions"


@dataclass(frozen=True)
class Table:
    """A Parquet table: a folder, its schema, its partition columns and the order in files.

    The rows stand in a sub-folder, the version.  A full refresh writes a new one
    beside it; the table switches when Spark marks that write as successful, so a job
    that fails while writing leaves the table as it was.

    With ``bucket_by`` rows with equal values of these columns stand in files of one
    bucket, so joins and groups on them read the table without a shuffle.  Spark takes
    buckets from its catalog only, so such a version is entered there, as an external
    table under a name made from its folder.  ``dealt`` says that the rows to write come
    dealt by bucket already; then they are not dealt again by partition.
    """

    path: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0
    dealt: bool = False

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1]

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows; the schema is given, so no file is opened to infer it."""
        location = self.location(spark)
        if self.bucket_by:
            name = self._entered(spark, location)
            spark.catalog.refreshTable(name)  # another session may have written
            return spark.table(name).select(*self.columns)
        return spark.read.schema(self.schema).parquet(location).select(*self.columns)

    def write(self, rows: DataFrame, location: str, mode: str = "append") -> None:
        """Write rows below a version's folder; ``overwrite`` replaces their partitions."""
        parts, spark = list(self.partition_by), rows.sparkSession
        if parts and not self.dealt:
            # One file per partition where it is small, several where it is large: the
            # adaptive plan splits a hot partition instead of giving it to one task.
            rows = rows.hint("rebalance", *parts)
        if self.sort_by:
            rows = rows.sortWithinPartitions(*parts, *self.sort_by)
        if self.bucket_by:
            name = self._entered(spark, location)
            rows = rows.select(*[c for c in self.columns if c not in parts], *parts)
            rows.write.insertInto(name, overwrite=mode == "overwrite")
            return
        writer = rows.write.mode(mode)
        if parts:
            writer = writer.partitionBy(*parts).option("partitionOverwriteMode", "dynamic")
        writer.parquet(location, compression=COMPRESSION)

    def _entered(self, spark: SparkSession, location: str) -> str:
        """Name under which the catalog knows a version of a bucketed table."""
        name = f"yieldmill_{hashlib.md5(location.encode()).hexdigest()}"
        if not spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            quoted = lambda names: ", ".join(f"`{name}`" for name in names)
            by_part = f"PARTITIONED BY ({quoted(self.partition_by)})" if self.partition_by else ""
            by_key = quoted(self.bucket_by)
            with _setting(spark, TRACKING, "false"):  # partitions are found by listing
                spark.sql(f"""
                    CREATE TABLE {name} ({columns}) USING parquet
                    OPTIONS (partitionOverwriteMode 'dynamic', compression '{COMPRESSION}') {by_part}
                    CLUSTERED BY ({by_key}) SORTED BY ({by_key}) INTO {self.buckets} BUCKETS
                    LOCATION '{location}'""")
        return name

    def location(self, spark: SparkSession) -> str:
        """Folder of the current version: the latest whose write was completed."""
        for number in reversed(self._versions(spark)):
            folder = self._folder(number)
            if folders.exists(spark, f"{folder}/_SUCCESS"):
                return folder
        raise ValueError(f"{self.path} has not been created")

    def next_location(self, spark: SparkSession) -> str:
        """Folder for the next version; what a failed write left there does not count."""
        return self._folder(max(self._versions(spark), default=0) + 1)

    def drop_old(self, spark: SparkSession) -> None:
        """Delete versions except the current one and, for its readers, the one before."""
        complete = []
        for number in reversed(self._versions(spark)):
            if len(complete) < 2 and folders.exists(spark, f"{self._folder(number)}/_SUCCESS"):
                complete.append(number)
            elif complete:
                if self.bucket_by:
                    spark.sql(f"DROP TABLE IF EXISTS {self._entered(spark, self._folder(number))}")
                folders.delete(spark, self._folder(number))

    def _folder(self, number: int) -> str:
        return f"{self.path}/v{number:010d}"

    def _versions(self, spark: SparkSession) -> list[int]:
        found = (VERSION.fullmatch(name) for name in folders.names(spark, self.path))
        return sorted(int(match[1]) for match in found if match)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@dataclass(frozen=True)
class Lake:
    """Tables below one root folder, one sub-folder per layer.

    ``buckets``, at least the session's shuffle partitions, lays the history of runs out
    by run; without it no table has buckets.
    """

    root: str
    buckets: int = 0

    def table(
        self,
        layer: str,
        name: str,
        schema: T.StructType,
        partition_by: tuple[str, ...] = (),
        sort_by: tuple[str, ...] = (),
        bucket_by: tuple[str, ...] = (),
    ) -> Table:
        path = f"{self.root.rstrip('/')}/{layer}/{name}"
        if not self.buckets or not bucket_by:
            return Table(path, schema, partition_by, sort_by)
        return Table(path, schema, partition_by, sort_by, bucket_by, self.buckets)
