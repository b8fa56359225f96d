from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import values
from yieldmill.functions.prodtime import in_window
from yieldmill.operators import loads
from yieldmill.plans import schemas
from yieldmill.sources import folders, with_source_file
from yieldmill.sources.files import read_csv
from yieldmill.sources.lake import Lake, Table

SCHEMA = "id int, machine string, day date, v string"


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path))


def rows(spark, *data):
    return spark.createDataFrame(
        [(i, m, date.fromisoformat(d) if d else None, v) for i, m, d, v in data], SCHEMA
    )


SEED = [
    (1, "a", "2024-01-01", "old"),
    (2, "a", "2024-01-02", "old"),
    (3, "b b/=%", "2024-01-02", "old"),
    (4, None, "2024-01-02", "old"),
    (5, "b b/=%", None, "old"),
]


def table(spark, lake, *partition_by) -> Table:
    made = lake.table("process", "t", schemas.ddl(SCHEMA), partition_by)
    loads.create_table(spark, made)
    loads.append(made, rows(spark, *SEED))
    return made


def content(spark, made):
    return {row.id: (row.machine, str(row.day), row.v) for row in made.read(spark).collect()}


PARTITIONS = [(), ("machine",), ("day",), ("machine", "day")]


@pytest.mark.parametrize("by", PARTITIONS)
def test_replace_is_repeatable_and_leaves_the_rest(spark, lake, by):
    made = table(spark, lake, *by)
    before = content(spark, made)
    assert set(before) == {1, 2, 3, 4, 5}
    new = rows(spark, (6, "b b/=%", "2024-01-02", "new"), (7, "b b/=%", "2024-01-02", "new"))
    values_ = {"machine": "b b/=%", "day": date(2024, 1, 2)}
    first = loads.replace_values(made, new, values_)
    assert (first.deleted, first.inserted) == (1, 2)
    after = content(spark, made)
    assert {k: after.pop(k)[2] for k in (6, 7)} == {6: "new", 7: "new"}
    assert after == {k: v for k, v in before.items() if k != 3}
    repeated = loads.replace_values(made, new.filter("id = 6"), values_)
    assert (repeated.deleted, repeated.inserted) == (2, 1)
    assert made.read(spark).count() == 5
    # New rows of a free predicate may go anywhere; those of given values may not.
    other = rows(spark, (8, "c", "2024-01-03", "new"))
    report = loads.replace_where(made, other, F.col("id") == 6)
    assert (report.deleted, report.inserted) == (1, 1)
    assert set(content(spark, made)) == {1, 2, 4, 5, 8}
    with pytest.raises(PySparkException, match="other values"):
        loads.replace_values(made, other, values_)
    assert set(content(spark, made)) == {1, 2, 4, 5, 8}


@pytest.mark.parametrize("by", PARTITIONS)
def test_replace_by_nothing_empties(spark, lake, by):
    made = table(spark, lake, *by)
    none = rows(spark, *SEED).limit(0)
    report = loads.replace_where(made, none, F.col("machine").isNull() | (F.col("id") == 1))
    assert (report.deleted, report.inserted) == (2, 0)
    assert set(content(spark, made)) == {2, 3, 5}
    assert loads.replace_where(made, none, F.col("id") > 0).deleted == 3
    assert made.read(spark).count() == 0
    loads.append(made, rows(spark, *SEED))
    assert made.read(spark).count() == 5


@pytest.mark.parametrize("by", PARTITIONS)
def test_replace_by_keys(spark, lake, by):
    made = table(spark, lake, *by)
    keys = rows(spark, *SEED).select("machine", "day").filter("machine = 'a'")
    new = rows(spark, (1, "a", "2024-01-01", "new"))
    for _ in range(2):
        loads.replace_by_keys(made, new, keys, ["machine", "day"])
        got = content(spark, made)
        assert set(got) == {1, 3, 4, 5} and got[1][2] == "new"


def test_untouched_partitions_keep_their_files(spark, lake):
    made = table(spark, lake, "machine", "day")
    files = lambda: set(
        row[0]
        for row in made.read(spark)
        .select("id", "machine", F.input_file_name().alias("f"))
        .filter("machine = 'a' and id = 1")
        .select("f")
        .collect()
    )
    before = files()
    loads.replace_values(made, rows(spark, (2, "a", "2024-01-02", "n")), {"day": date(2024, 1, 2)})
    assert files() == before


def test_replace_window_limits_the_new_rows(spark, lake):
    schema = schemas.ddl("id int, ts timestamp_ntz")
    made = lake.table("staging", "w", schema)
    stamp = lambda i: datetime(2024, 1, 1, 6 + i, 0, 1)
    df = spark.createDataFrame([(i, stamp(i)) for i in range(5)], schema)
    loads.create_table(spark, made)
    loads.append(made, df)
    window = (stamp(1), datetime(2024, 1, 1, 8, 30))
    for _ in range(2):
        loads.replace_window(made, df.withColumn("id", F.col("id") + 10), "ts", window)
        assert [row[0] for row in values(made.read(spark), "id")] == [0, 11, 12, 3, 4]
    assert made.read(spark).filter(in_window("ts", window)).count() == 2


def failing(spark, *data):
    """Rows of which the last cannot be computed: the write fails on the way."""
    bad = F.when(F.col("id") == data[-1][0], F.raise_error(F.lit("broken row"))).otherwise(F.col("v"))
    return rows(spark, *data).repartition(3, "id").withColumn("v", bad.cast("string"))


@pytest.mark.parametrize("by", PARTITIONS)
def test_a_load_that_fails_leaves_the_old_rows(spark, lake, by):
    made = table(spark, lake, *by)
    before = content(spark, made)
    new = failing(spark, (6, "a", "2024-01-02", "n"), (7, "a", "2024-01-02", "n"))
    values_ = {"machine": "a", "day": date(2024, 1, 2)}
    for load in (
        lambda: loads.load_full(made, new),
        lambda: loads.replace_table(made, new),
        lambda: loads.replace_values(made, new, values_),
        lambda: loads.replace_where(made, new, F.col("machine") == "a"),
        lambda: loads.replace_by_keys(made, new, rows(spark, *SEED), ["machine", "day"]),
        lambda: loads.append(made, new),
    ):
        with pytest.raises(PySparkException, match="broken row"):
            load()
        assert content(spark, made) == before
    # The folders that failed writes left do not stand in the way.
    loads.load_full(made, rows(spark, (9, "z", "2024-01-09", "x")))
    assert set(content(spark, made)) == {9}


def test_a_refresh_keeps_the_version_that_readers_hold(spark, lake):
    made = table(spark, lake, "machine")
    held = made.read(spark)
    loads.load_full(made, rows(spark, (9, "z", "2024-01-09", "x")))
    assert held.count() == 5 and made.read(spark).count() == 1
    for _ in range(3):
        loads.load_full(made, made.read(spark))
    assert len(folders.names(spark, made.path)) == 2


def dayed(spark, lake):
    """Hourly rows of ten days in a table by day, and the same rows with new values."""
    schema = schemas.ddl("id int, ts timestamp_ntz, day date, v string")
    made = lake.table("staging", "d", schema, ("day",))
    hours = spark.range(240).select(
        F.col("id").cast("int").alias("id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("ts"),
    )
    every = hours.select("*", F.to_date("ts").alias("day"), F.lit("old").alias("v"))
    loads.create_table(spark, made)
    loads.append(made, every)
    return made, every.withColumn("v", F.lit("new"))


def test_replace_window_touches_the_days_of_the_window(spark, lake, monkeypatch):
    made, new = dayed(spark, lake)
    window = (datetime(2024, 1, 3, 7, 0, 1), datetime(2024, 1, 5, 7, 0))
    plans, writes = [], []
    write = loads._overwrite
    monkeypatch.setattr(loads, "_overwrite", lambda t, df: (plans.append(df), write(t, df)))
    monkeypatch.setattr(loads, "materialise", lambda df, label: writes.append(label) or df)
    files = lambda: {r[0] for r in made.read(spark).filter("day NOT BETWEEN '2024-01-03' AND '2024-01-05'")
                     .select(F.input_file_name()).distinct().collect()}
    before = files()
    for _ in range(2):
        report = loads.replace_window(made, new, "ts", window, day="day")
        assert (report.deleted, report.inserted) == (48, 48)
    assert made.read(spark).count() == 240 and files() == before
    assert made.read(spark).filter("v = 'new'").count() == 48
    # The old rows are read with a filter on partitions, and no row is written elsewhere.
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    scan = plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "2024-01-03" in scan and "2024-01-05" in scan and not writes
    # A window without new rows empties its whole day, whose folder goes.
    gone = (datetime(2024, 1, 7), datetime(2024, 1, 7, 23))
    assert loads.replace_window(made, new.limit(0), "ts", gone, day="day").deleted == 24
    assert "day=2024-01-07" not in folders.names(spark, made.location(spark))
    assert made.read(spark).count() == 216
    with pytest.raises(PySparkException, match="outside"):
        loads.replace_where(made, new, F.lit(True), {"day": loads.Between(date(2024, 1, 1), date(2024, 1, 2))})


def test_touched_partitions_stay_off_the_driver(spark, lake):
    """Partitions far apart are rewritten, those between them are not."""
    made, new = dayed(spark, lake)
    stamp = lambda: {r.day: r.f for r in made.read(spark).groupBy("day").agg(F.max("_metadata.file_path").alias("f")).collect()}
    before, seen = stamp(), []
    where = F.col("id").isin(5, 215)
    report = loads.replace_where(made, new.filter(where), where, before=seen.append)
    assert (report.deleted, report.inserted) == (2, 2)
    assert values(seen[0]) == [(date(2024, 1, 1),), (date(2024, 1, 9),)]
    changed = {day for day, file in stamp().items() if file != before[day]}
    assert changed == {date(2024, 1, 1), date(2024, 1, 9)}
    assert values(made.read(spark).filter("v = 'new'"), "id") == [(215,), (5,)]


def test_the_search_for_touched_partitions_is_pruned(spark, lake, monkeypatch):
    made, new = dayed(spark, lake)
    searched = []
    plain = loads._replace_touched
    monkeypatch.setattr(loads, "_replace_touched", lambda t, df, found, *more: searched.append(found) or plain(t, df, found, *more))
    where = (F.col("day") == F.lit(date(2024, 1, 4))) & (F.col("id") < 75)
    assert loads.replace_where(made, new.filter(where), where) == loads.LoadReport(3, 3)
    plan = searched[0]._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "LessThan(id,75)" in plan


def test_counts_come_from_the_write(spark, lake):
    made = table(spark, lake, "machine")
    assert loads.append(made, rows(spark, *SEED)).inserted == 5
    assert loads.append(made, rows(spark, *SEED).limit(0)).inserted == 0
    assert loads.load_full(made, rows(spark, *SEED), F.col("id") < 3) == loads.LoadReport(None, 2)
    report = loads.overwrite_partitions(made, rows(spark, (8, "a", "2024-01-01", "n")))
    assert report.inserted == 1 and set(content(spark, made)) == {8}
    assert loads.replace_values(made, rows(spark, *SEED).limit(0), {"machine": "none"}) == loads.LoadReport(0, 0)


def test_full_loads_and_self_replace(spark, lake):
    made = table(spark, lake, "machine")
    loads.load_full(made, rows(spark, (9, "z", "2024-01-09", "x")), F.col("id") > 0)
    assert set(content(spark, made)) == {9}
    loads.replace_table(made, made.read(spark).withColumn("v", F.lit("self")))
    assert content(spark, made)[9][2] == "self"


def test_every_table_can_be_created_and_reset(spark, lake):
    tables = schemas.all_tables(lake)
    names = {"/".join(t.path.rsplit("/", 2)[1:]) for t in tables}
    assert len(names) == len(tables)
    assert {
        *[f"staging/{name}" for name in schemas.SOURCE_COLUMNS],
        *[f"staging/STAGING_DTC_TRANSACTION{end}" for end in ("", "_REDIS", "_TEST")],
        *[f"master/{name}" for name in schemas.MASTER_COLUMNS],
        *[f"process/{name}" for name in schemas.PROCESS_COLUMNS],
        "process/FACT_DATA_CON_TRANSACTION_TEST",
        "mart/CUMULATIVE_YIELD",
        "mart/DATA_CON_TRANSACTION",
        "mart/DATA_CON_TRANSACTION_TEST",
        "control/INF_BATCH_ID_CTRL",
        "control/LOAD_SLICES",
        "control/CHANGED_DAYS",
        "control/MART_BUILDS",
    } == names
    for made in tables:
        assert all(name in made.columns for name in made.partition_by)
    some = tables[:2] + tables[-3:]
    loads.truncate_all(spark, some)
    assert [t.read(spark).count() for t in some] == [0] * 5


def test_staging_schema_takes_extra_columns_and_misses_none(spark):
    source = schemas.ddl("MACHINE_NO string, MACHINE_NAME string, ZONE string")
    names = schemas.staging_schema(source, "EIS_MACHINE").fieldNames()
    assert names[:4] == ["MACHINE_NO", "MACHINE_NAME", "ZONE", "PLANT"] and len(names) == 14
    with pytest.raises(ValueError, match="MACHINE_NAME"):
        schemas.staging_schema(schemas.ddl("MACHINE_NO string"), "EIS_MACHINE")


def test_csv_with_line_breaks_and_provenance(spark, tmp_path):
    path = tmp_path / "limits.csv"
    path.write_text('a,b\n1,"two\nlines"\n3,"q, x"\n')
    assert values(read_csv(spark, str(path), ["a", "b"])) == [("1", "two\nlines"), ("3", "q, x")]
    named = with_source_file(spark.read.text(str(path)), f"{tmp_path}/")
    assert values(named.select("SOURCE_TABLE_NAME").distinct()) == [("limits.csv",)]
