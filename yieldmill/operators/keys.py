"""Dense surrogate keys without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldmill.session import materialise

# First key of each plant, and of tables that no plant owns.
KEY_BASE = {"WA": 100_000_000, "WH": 300_000_000, "WN": 600_000_000}
DATE_KEY_BASE = 0


def number_rows(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Number all rows 1..n in the order of ``order_by``.

    A window without partition columns would pull all rows into one task.  Here
    the rows are range-partitioned and numbered inside each partition, and each
    partition starts where the ones before it end.  The sort key ends with a row
    marker, so equal keys, however many, are spread over partitions too.  The
    numbered rows are written once, because the ranges are drawn from a sample
    and may differ if Spark computed them again.
    """
    ordered = [F.col(column).asc_nulls_first() for column in order_by]
    marked = df.withColumn("_row", F.monotonically_increasing_id())
    ranged = marked.repartitionByRange(*ordered, F.col("_row")).sortWithinPartitions(
        *ordered, F.col("_row")
    )
    placed = ranged.drop("_row").withColumns(
        {
            "_part": F.spark_partition_id(),
            # The lower 33 bits of the id count the rows of a partition.
            "_place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )
    placed = materialise(placed, "numbered")
    # One row per partition: bounded by the partition count, not by the data.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
    )
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_place") + 1)
        .drop("_part", "_place", "_start")
    )


def assign_keys(
    new: DataFrame,
    target: DataFrame,
    key: str,
    order_by: Sequence[str],
    base: int,
    scope: Column | None = None,
) -> DataFrame:
    """Give new rows the keys that follow the highest one in the target.

    ``scope`` limits the target rows whose highest key counts, such as one plant
    or one session; without any the keys start after ``base``.  ``order_by`` should
    end with the full business key so the numbering is repeatable.  Keys have the
    type of the target column.  Plants have ranges of keys; a key beyond the range
    that starts at ``base`` ends the job, as marts could not tell it from a key of
    the next plant.
    """
    kind = target.schema[key].dataType
    rows = target if scope is None else target.filter(scope)
    highest = rows.agg(F.coalesce(F.max(key), F.lit(base)).cast("long").alias("_highest"))
    numbered = number_rows(new.drop(key), order_by, "_number")
    columns = [F.col(name) for name in numbered.columns if name != "_number"]
    value = F.col("_number") + highest.scalar()
    border = min((b for b in KEY_BASE.values() if b > base), default=None)
    if border is not None:
        full = F.raise_error(F.lit(f"{key}: the keys from {base} reach the next range at {border}"))
        value = F.when(value <= border, value).otherwise(full.cast("long"))
    return numbered.select(value.cast(kind).alias(key), *columns)
