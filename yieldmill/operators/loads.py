"""Load modes on partitioned Parquet tables.

Every load writes beside the rows it replaces and switches when the write is done: a
full refresh to a new version of the table, a replace to Spark's staging folder of a
dynamic partition overwrite.  A job that fails while writing leaves the old rows
readable, and repeating a load with the same rows gives the same table.

A replace takes one of three ways, by what is known of the partitions it touches:

* Values of partition columns, such as machine and day, name whole partitions.  The
  new rows overwrite them and nothing else is read or written.
* A range of partitions (``within``), such as the days of a time window, is overwritten
  by its remaining and its new rows.  The scan has the range as a partition filter.
* Otherwise the partitions that lose or gain rows are found first, from the columns of
  the predicate alone, and kept as a frame.  They are joined to the table, which is
  read in their range, to get the rows to keep.

In all of them the rows of the table are written once.  Partitions that end up without
rows are not part of the overwrite; their folders are deleted afterwards.  Row counts
are observed in the write itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldmill.functions.prodtime import in_window, until
from yieldmill.operators.audit import counted, rows_seen
from yieldmill.session import keeping_counts, materialise
from yieldmill.sources import folders
from yieldmill.sources.lake import Table


@dataclass(frozen=True)
class LoadReport:
    """Rows a load removed (None where it does not look) and wrote."""

    deleted: int | None
    inserted: int


@dataclass(frozen=True)
class Between:
    """Closed range of a partition column; ``or_null`` adds the partition of NULL."""

    low: object
    high: object
    or_null: bool = False


Within = Mapping[str, object]


def create_table(spark: SparkSession, table: Table) -> None:
    """Create the table, or empty it when it exists."""
    load_full(table, spark.createDataFrame([], table.schema))


def truncate_all(spark: SparkSession, tables: Sequence[Table]) -> None:
    """Empty every table of a layer before an initial load."""
    for table in tables:
        create_table(spark, table)


def load_full(table: Table, df: DataFrame, where: Column | None = None) -> LoadReport:
    """Full refresh: the table holds exactly ``df``, which may read the table."""
    spark = df.sparkSession
    rows, seen = counted(_typed(table, df if where is None else df.filter(where)), "inserted")
    with keeping_counts(spark):
        table.write(rows, table.next_location(spark))
    table.drop_old(spark)
    return LoadReport(None, rows_seen(seen))


def load_full_until(table: Table, df: DataFrame, ts: str, as_of: date) -> LoadReport:
    """Full refresh with the rows up to ``as_of`` 07:00:00."""
    return load_full(table, df, until(ts, as_of))


def load_initial(table: Table, df: DataFrame, ts: str, as_of: date) -> LoadReport:
    """First back-fill: append all rows up to ``as_of`` 07:00:00."""
    return append(table, df.filter(until(ts, as_of)))


def append(table: Table, df: DataFrame) -> LoadReport:
    """Add rows."""
    spark = df.sparkSession
    rows, seen = counted(_typed(table, df), "inserted")
    with keeping_counts(spark):
        table.write(rows, table.location(spark))
    return LoadReport(0, rows_seen(seen))


def replace_table(table: Table, df: DataFrame) -> LoadReport:
    """Create or replace the table from a query that may read the table itself."""
    return load_full(table, df.select(*table.columns))


def overwrite_partitions(table: Table, df: DataFrame) -> LoadReport:
    """Replace exactly the partitions that ``df`` has rows in."""
    spark = df.sparkSession
    rows, seen = counted(_typed(table, df), "inserted")
    with keeping_counts(spark):
        _overwrite(table, rows)
    return LoadReport(None, rows_seen(seen))


def replace_where(
    table: Table,
    df: DataFrame,
    where: Column,
    within: Within | None = None,
    before: Callable[[DataFrame], None] | None = None,
) -> LoadReport:
    """Replace the rows that meet ``where`` by ``df``.

    ``within`` names partitions, by value or range, that hold all rows which meet
    ``where`` and all new ones; a new row outside ends the job.  Without it the
    partitions are looked up, and ``before`` gets them, one row each, ahead of the write.
    """
    spark = df.sparkSession
    gone = F.coalesce(where, F.lit(False))
    if not table.partition_by:
        return _replace_unpartitioned(table, df, table.read(spark).withColumn("_gone", gone))
    if within:
        return _replace_within(table, df, gone, within)
    target = table.read(spark)
    # The bare predicate, so that its parts reach the partitions and the row groups.
    return _replace_touched(table, df, target.filter(where), lambda rows: rows.filter(~gone), before)


def replace_batch(
    table: Table,
    df: DataFrame,
    batch_id: int,
    session: str | None = None,
    before: Callable[[DataFrame], None] | None = None,
) -> LoadReport:
    """Replace the rows of one batch, optionally of one session only."""
    values: dict[str, object] = {"INF_BATCH_ID": batch_id}
    if session is not None:
        values["INF_SESS_NAME"] = session
    if set(values) <= set(table.partition_by):
        return replace_values(table, df, values)
    return replace_where(table, _only(df, values), _equal(values), before=before)


def replace_window(
    table: Table, df: DataFrame, ts: str, window: tuple[datetime, datetime], day: str | None = None
) -> LoadReport:
    """Replace the rows of a closed time window by the rows of ``df`` in it.

    ``day`` names the partition column that holds the calendar day of ``ts``; then only
    the days of the window are read and written.
    """
    inside = in_window(ts, window)
    within = {day: Between(window[0].date(), window[1].date())} if day else None
    return replace_where(table, df.filter(inside), inside, within)


def replace_by_keys(
    table: Table,
    df: DataFrame,
    keys: DataFrame,
    on: Sequence[str],
    before: Callable[[DataFrame], None] | None = None,
) -> LoadReport:
    """Replace the rows whose key occurs in ``keys``; a NULL in a key occurs nowhere."""
    spark, on = df.sparkSession, list(on)
    keys = materialise(keys.select(*on).distinct(), "keys")
    target = table.read(spark)
    if not table.partition_by:
        marked = target.join(keys.withColumn("_gone", F.lit(True)), on, "left")
        marked = marked.withColumn("_gone", F.coalesce("_gone", F.lit(False)))
        return _replace_unpartitioned(table, df, marked.select(*table.columns, "_gone"))
    parts = [name for name in on if name in table.partition_by]
    # Only partitions in the range of the keys can hold them.
    near = target.filter(_condition(_range_of(keys, parts))) if parts else target
    found = near.join(keys, on, "left_semi")
    return _replace_touched(table, df, found, lambda rows: rows.join(keys, on, "left_anti"), before)


def replace_values(table: Table, df: DataFrame, values: Mapping[str, object]) -> LoadReport:
    """Replace the rows that have the given column values, such as machine and day.

    All rows of ``df`` must have these values too; one that has not ends the job.
    ``df`` may read the table.
    """
    rows = _only(df, values)
    within = {name: value for name, value in values.items() if name in table.partition_by}
    if not within or len(within) < len(values):
        return replace_where(table, rows, _equal(values), within or None)
    spark = df.sparkSession
    fresh, inserted = counted(_typed(table, rows), "inserted")
    # The old rows are counted without reading a column, and none passes the filter.
    old = table.read(spark).filter(_condition(within)).select(F.lit(1).alias("_old"))
    old, deleted = counted(old, "deleted")
    none = old.filter(F.monotonically_increasing_id() < 0)
    none = none.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema.fields])
    with keeping_counts(spark), _dropping_emptied(table, spark, within):
        _overwrite(table, fresh.unionByName(none))
    return LoadReport(rows_seen(deleted), rows_seen(inserted))


def _replace_unpartitioned(table: Table, df: DataFrame, marked: DataFrame) -> LoadReport:
    """New version of a table without partitions: its rows not ``_gone``, and ``df``."""
    spark = df.sparkSession
    seen = Observation("deleted")
    old = marked.observe(seen, F.count(F.when(F.col("_gone"), 1)).alias("rows"))
    fresh, inserted = counted(_typed(table, df), "inserted")
    kept = old.filter(~F.col("_gone")).drop("_gone")
    with keeping_counts(spark):
        table.write(kept.unionByName(fresh), table.next_location(spark))
    table.drop_old(spark)
    return LoadReport(rows_seen(seen), rows_seen(inserted))


def _replace_within(table: Table, df: DataFrame, gone: Column, within: Within) -> LoadReport:
    spark = df.sparkSession
    inside = _condition(within)
    outside = F.raise_error(F.lit(f"a row lies outside {dict(within)}")).cast("boolean")
    rows = _typed(table, df).filter(F.when(F.coalesce(inside, F.lit(False)), True).otherwise(outside))
    fresh, inserted = counted(rows, "inserted")
    seen = Observation("deleted")
    old = table.read(spark).filter(inside).observe(seen, F.count(F.when(gone, 1)).alias("rows"))
    with keeping_counts(spark), _dropping_emptied(table, spark, within):
        _overwrite(table, old.filter(~gone).unionByName(fresh))
    return LoadReport(rows_seen(seen), rows_seen(inserted))


def _replace_touched(
    table: Table,
    df: DataFrame,
    found: DataFrame,
    keep: Callable[[DataFrame], DataFrame],
    before: Callable[[DataFrame], None] | None,
) -> LoadReport:
    """Rewrite the partitions of the rows ``found`` and of the new ones."""
    spark, cols = df.sparkSession, list(table.partition_by)
    incoming, inserted = counted(_typed(table, df), "incoming")
    with keeping_counts(spark):
        incoming = materialise(incoming, "incoming")
        lost, deleted = counted(found.select(*cols), "deleted")
        parts = lost.groupBy(*cols).agg(F.count(F.lit(1)).alias("_rows"))
        new = incoming.groupBy(*cols).agg(F.count(F.lit(1)).alias("_rows"))
        both = parts.unionByName(new).groupBy(*cols).agg(F.sum("_rows").alias("_rows"))
        touched = materialise(both, "touched")
    report = LoadReport(rows_seen(deleted), rows_seen(inserted))
    if not report.deleted and not report.inserted:
        return report
    if before is not None:
        before(touched.select(*cols))
    within = _range_of(touched, cols)
    near = table.read(spark).filter(_condition(within))
    # The comparison tells Spark that the small side is selective, so that it also
    # reads only the partitions named there.
    named = touched.filter(F.col("_rows") > 0).select(*[F.col(name).alias(f"_t_{name}") for name in cols])
    same = reduce(lambda a, b: a & b, [near[name].eqNullSafe(named[f"_t_{name}"]) for name in cols])
    kept = keep(near.join(named, same, "left_semi"))
    with _dropping_emptied(table, spark, within, touched):
        _overwrite(table, kept.select(*table.columns).unionByName(incoming))
    return report


@contextmanager
def _dropping_emptied(
    table: Table, spark: SparkSession, within: Within, touched: DataFrame | None = None
) -> Iterator[None]:
    """Afterwards delete the folders of the range that the write inside left as they were.

    They held rows and got none.  With ``touched`` only folders listed there count; the
    folders are compared with it as a frame.
    """
    location = table.location(spark)
    held = {folder: folders.names(spark, f"{location}/{folder}") for folder in _folders(table, spark, within)}
    yield
    left = [f for f, files in held.items() if not set(files).isdisjoint(folders.names(spark, f"{location}/{f}"))]
    if left and touched is not None:
        cols = list(table.partition_by)
        rows = [(folder, *folders.partition_values(spark, folder)) for folder in left]
        schema = T.StructType([T.StructField(name, T.StringType()) for name in ["_folder", *cols]])
        texts = spark.createDataFrame(rows, schema)
        same = [texts[name].cast(table.schema[name].dataType).eqNullSafe(touched[name]) for name in cols]
        listed = texts.join(touched, reduce(lambda a, b: a & b, same), "left_semi")
        left = [row["_folder"] for row in listed.select("_folder").collect()]
    for folder in left:
        folders.delete(spark, f"{location}/{folder}")


def _folders(table: Table, spark: SparkSession, within: Within) -> list[str]:
    """Folders of the partitions in the range; equal values are part of the listing."""
    ranges = {k: v for k, v in within.items() if isinstance(v, Between)}
    equal = {k: v for k, v in within.items() if k not in ranges}
    texts = {}
    if equal:
        typed = [F.lit(v).cast(table.schema[k].dataType).cast("string").alias(k) for k, v in equal.items()]
        texts = spark.range(1).select(*typed).first().asDict()
    parts = [
        folders.partition_folder(spark, name, texts[name]) if name in equal else f"{name}=*"
        for name in table.partition_by
    ]
    found = folders.matching(spark, table.location(spark), "/".join(parts))
    if not ranges:
        return list(found)
    rows = [(folder, *folders.partition_values(spark, folder)) for folder in found]
    if not rows:
        return []
    schema = T.StructType([T.StructField(name, T.StringType()) for name in ["_folder", *table.partition_by]])
    # A local frame: Spark reads the folder names as the types they stand for.
    typed = spark.createDataFrame(rows, schema).select(
        "_folder", *[F.col(name).cast(table.schema[name].dataType).alias(name) for name in table.partition_by]
    )
    return [row["_folder"] for row in typed.filter(_condition(ranges)).select("_folder").collect()]


def _condition(within: Within) -> Column:
    """The range as a filter of literals, which prunes partitions when planning."""
    return reduce(lambda a, b: a & b, [_inside(F.col(name), value) for name, value in within.items()])


def _inside(column: Column, value: object) -> Column:
    if not isinstance(value, Between):
        return column.isNull() if value is None else column == F.lit(value)
    inside = F.lit(False) if value.low is None else column.between(F.lit(value.low), F.lit(value.high))
    return inside | column.isNull() if value.or_null else inside


def _range_of(rows: DataFrame, cols: Sequence[str]) -> dict[str, Between]:
    """Lowest and highest value of each column, one row in all."""
    aggregates = [f(name) for name in cols for f in (F.min, F.max, lambda n: F.bool_or(F.col(n).isNull()))]
    found = rows.agg(*aggregates).first()
    return {name: Between(*found[3 * k : 3 * k + 2], bool(found[3 * k + 2])) for k, name in enumerate(cols)}


def _equal(values: Mapping[str, object]) -> Column:
    return _condition(values)


def _only(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """``df``, which ends the job at a row with other values."""
    alien = F.raise_error(F.lit(f"a row has other values than {dict(values)}")).cast("boolean")
    return df.filter(F.when(_equal(values), F.lit(True)).otherwise(alien))


def _typed(table: Table, df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in table.schema.fields])


def _overwrite(table: Table, rows: DataFrame) -> None:
    table.write(rows, table.location(rows.sparkSession), "overwrite")
