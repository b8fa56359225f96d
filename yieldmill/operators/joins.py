"""Join forms the plans share.

No join carries a broadcast hint on data: the planner broadcasts a side only when
its measured size is below the session threshold and shuffles otherwise, and the
adaptive skew join splits hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldmill.session import materialise


def lookup_key(
    df: DataFrame, dim: DataFrame, on: Mapping[str, str], keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Add the surrogate ``keys`` of a dimension by its business key.

    ``on`` maps columns of ``df`` to columns of the dimension.
    """
    slim = dim.select(
        *[F.col(theirs).alias(f"_d_{ours}") for ours, theirs in on.items()],
        *[F.col(key) for key in keys],
    )
    match = reduce(
        lambda left, right: left & right, [F.col(ours) == F.col(f"_d_{ours}") for ours in on]
    )
    return df.join(slim, match, how).drop(*[f"_d_{ours}" for ours in on])


def not_in(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Rows whose ``column`` is NOT IN the one-column frame ``values``.

    Keeps the SQL meaning: a NULL among the values leaves nothing, an empty list
    leaves everything, and a NULL on the left passes only against an empty list.
    Spark would broadcast the list whatever its size; this is an ordinary anti join
    on distinct values plus a one-row check for NULL.  The distinct values are
    written once, because both need them.
    """
    listed, holds_null = _listed(values)
    open_rows = df.filter(holds_null.isNull() | (~holds_null & F.col(column).isNotNull()))
    return open_rows.join(listed, F.col(column) == F.col("_value"), "left_anti")


def with_not_in(df: DataFrame, column: str, values: DataFrame, name: str) -> DataFrame:
    """All rows, with ``name`` true where ``not_in`` would keep the row."""
    listed, holds_null = _listed(values)
    rows = df.join(listed, F.col(column) == F.col("_value"), "left")
    unlisted = F.col(column).isNotNull() & F.col("_value").isNull()
    return rows.withColumn(name, holds_null.isNull() | (~holds_null & unlisted)).drop("_value")


def _listed(values: DataFrame) -> tuple[DataFrame, Column]:
    """Distinct values, and whether a NULL is among them (NULL for an empty list)."""
    name = values.columns[0]
    listed = materialise(values.select(F.col(name).alias("_value")).distinct(), "listed")
    return listed, listed.agg(F.bool_or(F.col("_value").isNull())).scalar()


def in_pairs(df: DataFrame, on: Mapping[str, str], pairs: DataFrame) -> DataFrame:
    """Rows whose tuple of columns occurs in ``pairs``."""
    listed = pairs.select(*[F.col(theirs).alias(f"_p_{ours}") for ours, theirs in on.items()])
    match = reduce(
        lambda left, right: left & right, [F.col(ours) == F.col(f"_p_{ours}") for ours in on]
    )
    return df.join(listed.distinct(), match, "left_semi")


def with_group_max(
    df: DataFrame, rows: DataFrame, on: Sequence[str], value: str, name: str
) -> DataFrame:
    """Add the highest ``value`` among the ``rows`` with the same key, NULL without any."""
    highest = rows.groupBy(*on).agg(F.max(value).alias(name))
    return df.join(highest, list(on), "left")


def latest_per(df: DataFrame, by: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` of each group.

    A greatest-value aggregation combines rows before the shuffle, so a group of
    any size is no burden for one task, unlike a row number over sorted groups.
    Equal rows are decided by the remaining columns.
    """
    rest = [name for name in df.columns if name not in (*by, *order_by)]
    best = F.max(F.struct(*order_by, *rest)).alias("_best")
    grouped = df.groupBy(*by).agg(best)
    return grouped.select(
        *[F.col(name) if name in by else F.col(f"_best.{name}").alias(name) for name in df.columns]
    )


def week_of(days: DataFrame, weeks: DataFrame, day: str = "DATE_BEGIN") -> DataFrame:
    """Calendar week that holds a production day and the day after it.

    Each week is unfolded into the days it can hold, so the lookup is an equality
    join and no comparison of every day with every week.
    """
    first, last = F.to_date("SAT_FROM_DATE"), F.to_date("SAT_TO_DATE")
    labels = ["WW", "MONTH", "QUARTER", "YEAR"]
    unfolded = weeks.filter(first < last).select(
        F.explode(F.sequence(first, F.date_sub(last, 1))).alias(day), *labels
    )
    return days.join(unfolded, day)


def union_all(frames: Sequence[DataFrame], distinct: bool = False) -> DataFrame:
    """UNION ALL by column name, or UNION with ``distinct``."""
    whole = reduce(lambda left, right: left.unionByName(right), frames)
    return whole.distinct() if distinct else whole


def unify_plants(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Tables of several plants as one, with a PLANT column.

    Columns that a plant does not have are NULL there.
    """
    tagged = [df.withColumn("PLANT", F.lit(plant)) for plant, df in frames.items()]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), tagged)
