import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import values
from yieldmill import streaming
from yieldmill.operators import loads
from yieldmill.operators.audit import Batch
from yieldmill.plans import marts, schemas, telemetry
from yieldmill.sources.lake import Lake
from yieldmill.warehouse import Warehouse


def message(machine="DTC140-eq", at="2024-01-02T06:30:00", found=(("BondForce", "1.5"),), **more):
    body = {
        "MachineName": machine,
        "MDLN": "m",
        "SOFTREV": "1",
        "CollectedDate": at,
        "CEID": 1,
        "CollectionEventName": "e",
        "RPTID": 2,
        "Values": [{"VID": i, "Name": n, "Value": v} for i, (n, v) in enumerate(found)],
    }
    return json.dumps({**body, **more})


THREE = (("a", "1"), ("b", "x"), ("c", ""))
LINES = [
    "INFO Collected: " + message(found=THREE),
    "INFO collected:" + message(found=(("lower", "2"),)),
    "INFO Collected: none",
    "INFO Collected: {broken",
    "INFO Collected: " + message(found=()),
    "INFO Collected: " + message(Values=None),
    "nothing here " + message(),
    "",
]


def lines(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def test_extraction(spark):
    got = values(telemetry.extract_events(lines(spark, *LINES)), "NAME", "VALUES", "VID")
    assert got == [("a", "1", 0), ("b", "x", 1), ("c", "", 2), ("lower", "2", 0)]


def test_zone_shift_happens_once(spark):
    df = telemetry.extract_events(lines(spark, "Collected: " + message()), "Asia/Bangkok")
    assert df.first()["COLLECTEDDATE"] == datetime(2024, 1, 2, 13, 30)
    assert df.schema["COLLECTEDDATE"].dataType.simpleString() == "timestamp_ntz"


def test_limits(spark):
    raw = spark.createDataFrame(
        [("DTC140", "BONDFORCE", "0", "10"), ("DTC140", "x", "", "n/a"), ("DTC140", "X", "1", "2")],
        "MachineNo string, VariableName string, SpecLCL string, SpecUCL string",
    )
    limits = telemetry.control_limits(raw)
    assert values(limits, "SpecLCL", "SpecUCL") == [(0, 10), (1, 2), (None, None)]
    assert values(telemetry.duplicate_limits(limits)) == [("DTC140", "x", 2)]
    events = spark.createDataFrame(
        [("DTC140", "bondforce"), ("DTC140", "x"), ("DTC141", "x"), ("DTC140", None)],
        "MachineNo string, VariableName string",
    )
    loose = telemetry.match_limits(events, limits)
    assert loose.count() == 5
    exact = telemetry.match_limits(events, limits, ignore_case=False)
    assert exact.filter("SpecLCL is not null").count() == 0


def test_stream_equals_batch_restarts_and_archives(spark, tmp_path):
    source, archive = tmp_path / "in", tmp_path / "done"
    source.mkdir()
    lake = Lake(str(tmp_path / "lake"))
    table = schemas.telemetry_staging_table(lake)
    loads.create_table(spark, table)

    def run():
        raw = streaming.stream_text(spark, f"{source}/*.txt", str(archive), files=1)
        events = telemetry.audited_events(
            telemetry.extract_events(raw.select("value")), "s", Batch(1, datetime(2024, 1, 3))
        ).withColumn("COLLECTED_DAY", F.to_date("COLLECTEDDATE"))
        streaming.stream_append(events, table, str(tmp_path / "cp")).awaitTermination()
        return table.read(spark)

    (source / "one.txt").write_text("\n".join(LINES))
    batch = telemetry.extract_events(spark.read.text(str(source)))
    expected = values(batch)
    assert values(run(), *batch.columns) == expected
    (source / "two.txt").write_text("Collected: " + message(found=(("later", "3"),)))
    (source / "three.txt").write_text("no message")
    assert run().count() == len(expected) + 1
    assert run().count() == len(expected) + 1
    assert "one.txt" in {path.name for path in archive.rglob("*.txt")}


def test_telemetry_jobs(spark, tmp_path):
    """Stream, incremental fact, rerun and mart on one machine day."""
    house = Warehouse(spark, Lake(str(tmp_path / "lake")))
    house.create()
    batch = house.open_batch(datetime(2024, 1, 3, 1, 0))
    assert (batch.batch_id, house.open_batch(datetime(2024, 1, 3, 9, 0)).batch_id) == (1, 1)
    assert house.open_batch(datetime(2024, 1, 4, 1, 0)).batch_id == 2

    limits = tmp_path / "limits.csv"
    limits.write_text("MachineNo,VariableName,SpecLCL,SpecUCL\nDTC140,bondforce,0,10\n")
    for _ in range(2):
        house.load_limits(str(limits), batch)
    assert house.master("DATA_CON_PARAM_SPEC").count() == 1

    inbox = tmp_path / "json"
    inbox.mkdir()
    texts = [message(found=(("BondForce", v),), at=f"2024-01-02T0{h}:00:00") for v, h in
             (("1.0", 5), ("2.0", 7), ("3.0", 8), ("bad", 9))]
    (inbox / "a.json").write_text("\n".join(texts + ["{not json"]))
    house.stream_messages(str(inbox), str(tmp_path / "cp1"), batch).awaitTermination()
    tomorrow = Batch(2, datetime(2030, 1, 1))
    house.load_events(tomorrow)
    fact = schemas.process_table(house.lake, "FACT_DATA_CON_TRANSACTION")
    got = values(fact.read(spark), "Time", "Value", "SpecUCL", F.col("Date_7").cast("string"))
    assert got == [(5, "1.0", 10, "2024-01-01"), (7, "2.0", 10, "2024-01-02"),
                   (8, "3.0", 10, "2024-01-02"), (9, "bad", 10, "2024-01-02")]
    house.load_events(tomorrow)
    assert fact.read(spark).count() == 4

    day = date(2024, 1, 2)
    for _ in range(2):
        house.load_spc_mart(day)
    mart = schemas.mart_table(house.lake, "DATA_CON_TRANSACTION")
    row = mart.read(spark).collect()
    assert len(row) == 1
    assert [str(row[0][n]) for n in ("Value", "MEAN", "SIGMA", "CPK", "VariableName")] == [
        "6.00", "2.00", "0.82", "0.81", "BondForceFloat"]

    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "x.txt").write_text("Collected: " + message(found=(("BondForce", "9"),)))
    staged = schemas.telemetry_staging_table(house.lake)
    for _ in range(2):
        house.stream_logs(str(logs), str(tmp_path / "cp2"), batch).awaitTermination()
        assert staged.read(spark).count() == 1
    assert house.compact_logs(day).inserted == 1
    assert values(staged.read(spark), "STREAM_BATCH") == [("compacted",)]
    redo = lines(spark, "Collected: " + message(found=(("BondForce", "4"), ("BondForce", "6"))))
    for _ in range(2):
        report = house.stage_logs(redo, batch, "DTC140", day)
    assert (report.deleted, report.inserted) == (2, 2)
    for _ in range(2):
        report = house.reload_events(batch, day, "DTC140")
    assert (report.deleted, report.inserted) == (2, 2)
    assert {v for (v,) in values(fact.read(spark), "Value")} == {"4", "6"}
    house.load_spc_mart(day, "DTC140")
    assert {str(v) for (v,) in values(mart.read(spark), "MEAN")} == {"4.00", "6.00"}


def test_two_raw_names_with_one_label(spark):
    limits = spark.createDataFrame(
        [("DTC1", "bondforce", 0, 9), ("DTC1", "BONDFORCE", 0, 9), ("DTC1", "bondforcefloat", 0, 9)],
        schemas.ddl(schemas.MASTER_COLUMNS["DATA_CON_PARAM_SPEC"]),
    )
    fact = spark.createDataFrame(
        [("DTC1", 1, "e", 1, 1, "N", 0, 9, name, date(2024, 1, 1), value)
         for name, value in (("BondForce", "1"), ("BondForce", "3"), ("BondForceFloat", "7"))],
        "MachineNo string, CeId int, CollectionEventName string, RptId int, Vid int, "
        "Status string, SpecLCL int, SpecUCL int, VariableName string, Date date, Value string",
    )
    got = values(marts.mart_spc(fact, limits), "VariableName", F.col("MEAN").cast("string"))
    # The two spellings of one limit agree in all values and fall together.
    assert got == [("BondForceFloat", "2.00"), ("BondForceFloat", "7.00")]
    assert marts.mart_spc(fact, limits, limits_from_master=True).count() == 2


def test_no_row_is_lost_or_doubled_between_loads(spark, tmp_path):
    """An outage of days, a reload in between, and landed logs that a rerun replaced."""
    house = Warehouse(spark, Lake(str(tmp_path / "lake")))
    house.create()
    batch = house.open_batch(datetime(2024, 1, 3, 1, 0))
    arrivals = schemas.telemetry_staging_table(house.lake, "STAGING_DTC_TRANSACTION_REDIS")
    fact = schemas.process_table(house.lake, "FACT_DATA_CON_TRANSACTION")

    def arrive(at, value):
        events = telemetry.extract_events(
            lines(spark, "Collected: " + message(found=(("BondForce", value),)))
        )
        rows = house._audited(events, arrivals, batch, F.lit(at).cast("timestamp_ntz"))
        loads.append(arrivals, rows)

    arrive(datetime(2024, 1, 2, 7, 0), "1")
    assert house.load_events(Batch(1, datetime(2024, 1, 2, 8, 0))).inserted == 1
    arrive(datetime(2024, 1, 3, 7, 0), "2")
    # Seven days without a load: the row of 3 January is still taken.
    assert house.load_events(Batch(1, datetime(2024, 1, 10, 8, 0))).inserted == 1
    house.reload_events(batch, date(2024, 1, 2))
    left = fact.read(spark).count()
    assert house.load_events(Batch(1, datetime(2024, 1, 10, 9, 0))).inserted == 0
    assert fact.read(spark).count() == left

    with pytest.raises(ValueError):
        house.stage_logs(lines(spark), batch, "DTC140")


def test_a_load_that_dies_after_its_rows_is_repeated_as_it_was(spark, tmp_path, monkeypatch):
    """Between the rows and the finished mark: no row twice, none lost, later rows later."""
    house = Warehouse(spark, Lake(str(tmp_path / "lake")))
    house.create()
    batch = house.open_batch(datetime(2024, 1, 3, 1, 0))
    arrivals = schemas.telemetry_staging_table(house.lake, "STAGING_DTC_TRANSACTION_REDIS")
    fact = schemas.process_table(house.lake, "FACT_DATA_CON_TRANSACTION")

    def arrive(at, *found):
        events = telemetry.extract_events(
            lines(spark, *["Collected: " + message(found=(("BondForce", v),), at=f"2024-01-0{v}T08:00:00") for v in found])
        )
        loads.append(arrivals, house._audited(events, arrivals, batch, F.lit(at).cast("timestamp_ntz")))

    arrive(datetime(2024, 1, 4, 7, 0), "1", "2")
    mark = Warehouse._mark_slice

    def dies(self, stream, target, part, done):
        if done:
            raise RuntimeError("the driver is gone")
        mark(self, stream, target, part, done)

    monkeypatch.setattr(Warehouse, "_mark_slice", dies)
    for _ in range(2):
        with pytest.raises(RuntimeError):
            house.load_events(Batch(1, datetime(2024, 1, 4, 8, 0)))
    assert fact.read(spark).count() == 2
    monkeypatch.setattr(Warehouse, "_mark_slice", mark)
    # A row with an earlier stamp comes in late, one after the slice as well.
    arrive(datetime(2024, 1, 4, 7, 30), "3")
    arrive(datetime(2024, 1, 4, 8, 30), "4")
    assert house.load_events(Batch(1, datetime(2024, 1, 4, 9, 0))).inserted == 3
    assert house.load_events(Batch(1, datetime(2024, 1, 4, 9, 0))).inserted == 1
    assert house.load_events(Batch(1, datetime(2024, 1, 4, 9, 0))).inserted == 0
    assert values(fact.read(spark), "Value", "INF_SLICE_ID") == [("1", 1), ("2", 1), ("3", 1), ("4", 2)]
    # A reload of a day stands in a slice of its own; the next load leaves it alone.
    loads.append(schemas.telemetry_staging_table(house.lake), house._audited(
        telemetry.extract_events(lines(spark, "Collected: " + message(found=(("BondForce", "9"),), at="2024-01-02T09:00:00"))),
        schemas.telemetry_staging_table(house.lake), batch))
    assert house.reload_events(batch, date(2024, 1, 2)) == loads.LoadReport(1, 1)
    assert values(fact.read(spark).filter("Date = '2024-01-02'"), "Value", "INF_SLICE_ID") == [("9", 0)]
    labels = [
        ("process_FACT_DATA_CON_TRANSACTION", "STAGING_DTC_TRANSACTION_REDIS"),
        ("process_FACT_DATA_CON_TRANSACTION_ADHOC", "STAGING_DTC_TRANSACTION"),
    ]
    loaded = fact.read(spark).select("INF_SESS_NAME", "SOURCE_TABLE_NAME")
    assert values(loaded.distinct(), "INF_SESS_NAME", "SOURCE_TABLE_NAME") == labels
    # One machine's day is a rerun: the session of the daily load, the fact as its source.
    house.reload_events(batch, date(2024, 1, 2), "DTC140")
    rerun = fact.read(spark).filter("Date = '2024-01-02'")
    assert values(rerun, "INF_SESS_NAME", "SOURCE_TABLE_NAME") == [
        ("process_FACT_DATA_CON_TRANSACTION", "FACT_DATA_CON_TRANSACTION")
    ]


def test_a_replayed_micro_batch_leaves_the_same_rows(spark, tmp_path):
    source, checkpoint = tmp_path / "in", tmp_path / "cp"
    source.mkdir()
    table = schemas.telemetry_staging_table(Lake(str(tmp_path / "lake")))
    loads.create_table(spark, table)
    reports = []

    def run(path):
        raw = streaming.stream_text(spark, f"{source}/*.txt", files=1)
        events = telemetry.audited_events(telemetry.extract_events(raw.select("value")), "s", Batch(1, datetime(2024, 1, 3)))
        events = events.withColumn("COLLECTED_DAY", F.to_date("COLLECTEDDATE"))
        streaming.stream_append(events, table, str(path), landed=lambda n, r: reports.append((n, r.inserted))).awaitTermination()
        return values(table.read(spark), "NAME", "STREAM_BATCH")

    (source / "one.txt").write_text("\n".join(LINES))
    (source / "two.txt").write_text("Collected: " + message(found=(("later", "3"),)))
    first = run(checkpoint)
    assert len(first) == 5 and sorted(reports) == [(0, 4), (1, 1)] or sorted(reports) == [(0, 1), (1, 4)]
    # The crash: rows of the last micro-batch are written, its commit is not.
    for file in (checkpoint / "commits").glob("*1*"):
        file.unlink()
    assert run(checkpoint) == first and len(reports) == 3
    # Another stream of the same files is another source, with partitions of its own.
    assert len(run(tmp_path / "cp_other")) == 10


def test_trial_runs_leave_production_alone(spark, tmp_path):
    house = Warehouse(spark, Lake(str(tmp_path / "lake")))
    house.create()
    batch = house.open_batch(datetime(2024, 1, 3, 1, 0))
    limits = tmp_path / "limits.csv"
    limits.write_text("MachineNo,VariableName,SpecLCL,SpecUCL\nDTC140,BondForce,0,10\n")
    house.load_limits(str(limits), batch)
    staged = schemas.telemetry_staging_table(house.lake, "STAGING_DTC_TRANSACTION_TEST")
    events = telemetry.extract_events(lines(spark, "Collected: " + message(found=(("BondForce", "5"),))))
    loads.append(staged, house._audited(events, staged, batch))
    mart = schemas.mart_table(house.lake, "DATA_CON_TRANSACTION")
    fact = schemas.process_table(house.lake, "FACT_DATA_CON_TRANSACTION")
    assert house.load_events(Batch(1, datetime(2099, 1, 1)), shadow=True).inserted == 1
    house.load_spc_mart(date(2024, 1, 2), shadow=True)
    assert fact.read(spark).count() == mart.read(spark).count() == 0
    assert schemas.mart_table(house.lake, "DATA_CON_TRANSACTION_TEST").read(spark).count() == 1


def test_rerun_scans_one_day(spark, tmp_path):
    house = Warehouse(spark, Lake(str(tmp_path)))
    house.create()
    table = schemas.telemetry_staging_table(house.lake)
    events = telemetry.extract_events(lines(spark, "Collected: " + message()))
    loads.append(table, house._audited(events, table, house.open_batch(datetime(2024, 1, 3, 1, 0))))
    rows = table.read(spark).filter(telemetry.collected_on(date(2024, 1, 2), "DTC140"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == 1
    assert "COLLECTED_DAY" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
