"""File sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV with a header and quoted fields that may span lines; every column is text."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    reader = spark.read.option("header", True).option("multiLine", True)
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def read_text(spark: SparkSession, path: str, **parts: str) -> DataFrame:
    """Text lines; ``{name}`` places in the path, such as machine or day, are filled from ``parts``."""
    return spark.read.text(path.format(**parts) if parts else path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON files with one object per line and a fixed schema."""
    return spark.read.schema(schema).json(path)


def with_source_file(df: DataFrame, prefix: str, name: str = "SOURCE_TABLE_NAME") -> DataFrame:
    """Add the path of the file each row came from, without ``prefix``.

    Call it on the frame just read, before joins and aggregations.
    """
    path = F.col("_metadata.file_path")
    start = F.instr(path, prefix)
    rest = F.substring(path, start + F.lit(len(prefix)), F.length(path))
    return df.withColumn(name, F.when(start > 0, rest).otherwise(path))
