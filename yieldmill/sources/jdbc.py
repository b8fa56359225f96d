"""Relational sources over JDBC."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcSplit:
    """How one table read is divided into parallel range queries."""

    column: str
    lower: int | str | datetime
    upper: int | str | datetime
    parts: int

    def options(self) -> dict[str, str]:
        if self.parts < 1:
            raise ValueError("a split needs at least one part")
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


def jdbc_options(
    url: str, table: str, split: JdbcSplit | None = None, fetch_rows: int = 10_000, **extra: str
) -> dict[str, str]:
    """Reader options; user, password and driver come in through ``extra``."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), **extra}
    return {**options, **split.options()} if split else options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split: JdbcSplit | None = None,
    slices: Sequence[str] | None = None,
    **extra: str,
) -> DataFrame:
    """A relational table as a DataFrame.

    Without ``split`` or ``slices`` Spark reads the table through one connection,
    so give one of them for every table that is not small.  ``slices`` are WHERE
    conditions, one per task, for a key that is skewed or has no numeric range;
    they have to cover every row exactly once.
    """
    if split and slices:
        raise ValueError("give either split or slices")
    if slices:
        properties = {key: value for key, value in extra.items()}
        properties.setdefault("fetchsize", "10000")
        return spark.read.jdbc(url, table, predicates=list(slices), properties=properties)
    return spark.read.format("jdbc").options(**jdbc_options(url, table, split, **extra)).load()
