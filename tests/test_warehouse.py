"""The batch warehouse from source tables to the yield mart, on a hand-made plant."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import values
from yieldmill.functions.prodtime import production_window
from yieldmill.operators import loads
from yieldmill.operators.audit import Batch
from yieldmill.plans import dims, facts, marts, schemas
from yieldmill.sources.lake import Lake
from yieldmill.warehouse import Warehouse

AS_OF = datetime(2024, 3, 6, 7, 15)
IN = datetime(2024, 3, 5, 12, 0)
WINDOW = production_window(AS_OF.date())


def d(value):
    return None if value is None else Decimal(str(value))


def source(spark, name, *rows):
    schema = schemas.ddl(schemas.SOURCE_COLUMNS[name])
    return spark.createDataFrame([tuple(row) for row in rows], schema)


def move(run, op, seq, qty, out, scrap, at=IN, machine="M1", part="P1"):
    return (part, run, op, seq, d(qty), d(out), d(scrap), at, at, at, machine)


def sources(spark, lot="NRM"):
    s = lambda name, *rows: source(spark, name, *rows)
    old = datetime(2024, 1, 1)
    return {
        "EIS_JIT_CELL": s("EIS_JIT_CELL", ("C1", "L1", "R", "LOC", "1")),
        "EIS_MACHINE": s("EIS_MACHINE", ("M1", "one")),
        "EIS_OPERATION": s(
            "EIS_OPERATION",
            (" 0010 ", " cut ", "X"),
            ("0010", "cut", "X"),
            ("0020", "glue", "X"),
            ("0060", "lat", "LAT"),
        ),
        "EIS_PRODUCT_OVERALL": s("EIS_PRODUCT_OVERALL", (" P1 ", "MPT1", "prog", "TAB", "F1")),
        "EIS_PRODUCT_FAMILY": s("EIS_PRODUCT_FAMILY", ("F1", "FAM", "ACTIVE")),
        "EIS_PRODUCT_PART": s("EIS_PRODUCT_PART", ("P1", "GL", "1", "S", "text")),
        "EIS_DOCUMENT_EER": s("EIS_DOCUMENT_EER", ("P1", "C1", "E1", old, "WIP", lot)),
        "EIS_WIP_FA_START_OPERATION": s(
            "EIS_WIP_FA_START_OPERATION",
            ("P1", "E1", "0010", "YIELD", "ACTIVE"),
            ("P1", "E1", "0060", "ENDYI", "ACTIVE"),
            ("P1", "E1", "0060", "LAT", "ACTIVE"),
        ),
        "EIS_ROUTING_OPERATION": s(
            "EIS_ROUTING_OPERATION",
            ("P1", "E1", "0010", 10),
            ("P1", "E1", "0020", 20),
            ("P1", "E1", "0060", 60),
            ("P1", "E1", "0090", 90),
        ),
        "EIS_WORK_WEEK": s(
            "EIS_WORK_WEEK",
            ("2024", "Q1", "3", "WW10", datetime(2024, 3, 2), datetime(2024, 3, 9)),
        ),
        "EIS_WIP_FA_RUNCARD": s(
            "EIS_WIP_FA_RUNCARD",
            ("P1", "R1", "E1", IN, "C1", None, "MPT1"),
            ("P1", "R1", "E1", IN, "C1", None, "MPT1"),
            ("P1", "R2", "E1", IN, "C1", "PSUDO", "MPT1"),
            ("P1", "R3", "E1", datetime(2024, 3, 6, 9), "C1", None, "MPT1"),
        ),
        "EIS_RUNCARD_CONVERT": s(
            "EIS_RUNCARD_CONVERT",
            ("R1b", "R1", IN, "P1", "E1", "C1"),
            ("R1c", "R1b", IN, "P1", "E1", "C1"),
        ),
        "EIS_WIP_FA": s(
            "EIS_WIP_FA",
            move("R1", "0010", 10, 100, 98, 2),
            move("R1", "0010", 10, 100, 98, 2),
            move("R1", "0020", 20, 98, 49, 49, machine="M?"),
            move("R1", "0060", 60, 50, 50, None),
            move("R1", "0060", 60, 40, 40, None),
            move("R1", "0090", 90, None, 1, 0),
            move("R1", "0090", 90, 5, -1, 0),
            move("R1", "0010", 10, 7, 7, 0, at=datetime(2024, 3, 6, 7, 0, 0, 500000)),
            move("R1", "0010", 10, 9, 9, 0, at=datetime(2024, 3, 1, 12, 0)),
        ),
        "EIS_WIP_FA_WIP_TRANS": s(
            "EIS_WIP_FA_WIP_TRANS",
            ("R1", "480", 10, 9, 1, IN, "Y", "Y", 2, None, 1),
            ("R1", "480", 10, 10, None, IN, "Y", "Y", None, 1, None),
            ("R1", "480", 99, 99, 0, IN, "N", "Y", None, None, None),
        ),
    }


def run_day(house, spark, plant, batch, lot="NRM", convert=False):
    for name, df in sources(spark, lot).items():
        house.stage(name, plant, df, batch)
    house.refresh_dates(date(2024, 3, 2), date(2024, 3, 8), batch, plant)
    house.refresh_base_dims(plant, batch)
    house.refresh_routing(plant, batch)
    house.refresh_runcards(plant, batch)
    if convert:
        house.convert_runs(plant, batch)
    return house.load_runcard_fact(plant, batch)


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    house = Warehouse(spark, Lake(str(tmp_path_factory.mktemp("lake"))))
    house.create()
    batch = house.open_batch(AS_OF)
    first = run_day(house, spark, "WA", batch)
    again = run_day(house, spark, "WA", batch)
    assert (first.deleted, first.inserted) == (0, 3)
    assert (again.deleted, again.inserted) == (3, 3)
    house.build_yield_mart()
    return house


def test_a_second_run_changes_nothing(house, spark):
    counts = {
        "MFG_DATE_DIM": 7,
        "MFG_LINE_DIM": 1,
        "MFG_MACHINE_DIM": 1,
        "MFG_PRODUCT_DIM": 1,
        "MFG_ROUTING_OPERATION_DIM": 4,
        "SFC_RUNCARD_DIM": 1,
    }
    assert {name: house.master(name).count() for name in counts} == counts
    assert house.staged("EIS_WIP_FA", "WA").count() == 5
    assert house.staged("EIS_WIP_FA_RUNCARD", "WA").count() == 3
    # Both spellings of an operation are new rows once; keys stay dense.
    keys = values(house.master("MFG_OPERATION_DIM"), "OPERATION_NO_KEY", "OPERATION_NO")
    assert keys == [
        (100000001, "0010"),
        (100000002, "0010"),
        (100000003, "0020"),
        (100000004, "0060"),
    ]


def test_fact_rows(house, spark):
    fact = schemas.process_table(house.lake, "SFC_WIP_RUNCARD_FACT").read(spark)
    routing = house.master("MFG_ROUTING_OPERATION_DIM")
    got = values(
        fact.join(routing, "ROUTE_OPERATION_NO_KEY"),
        "OPERATION_NO",
        "OPERATION_SEQ",
        *[F.col(n).cast("int") for n in ("INPUT_QTY", "OUTPUT_QTY", "SCRAP_QTY")],
        F.col("MACHINE_NO_KEY").isNull(),
    )
    # Two transactions meet two LAT moves and two run-card rows: a factor of four.
    assert got == [
        ("0010", "10", 100, 98, 2, False),
        ("0020", "20", 98, 49, 49, True),
        ("0060", "480", 80, 76, 20, True),
    ]


def test_mart(house, spark):
    mart = schemas.mart_table(house.lake, "CUMULATIVE_YIELD").read(spark)
    got = values(mart, "OPERATION_NO", "MMM", *[F.col(n).cast("string") for n in
                                                ("OPERATION_YIELD", "CUM_YIELD")])
    # Sequence 480 lies outside the span, but the flag comes from the routing step.
    assert [row[0] for row in got] == ["0010", "0020", "0060"]
    assert [row[2] for row in got] == ["98.00", "50.00", "95.00"]
    assert {row[3] for row in got} == {"46.55"} and {row[1] for row in got} == {"24MAR"}


def test_rerun_and_other_plant(house, spark):
    batch = Batch(2, AS_OF)
    run_day(house, spark, "WH", batch, lot="UDP")
    table = schemas.process_table(house.lake, "SFC_WIP_RUNCARD_FACT")
    # The material branch brings the start operation back; equal rows fall together.
    by_plant = dict(values(table.read(spark).groupBy("INF_SESS_NAME").count()))
    assert by_plant == {
        "process_SFC_WIP_RUNCARD_FACT_WA": 3,
        "process_SFC_WIP_RUNCARD_FACT_WH": 3,
    }
    assert house.master("MFG_MACHINE_DIM").count() == 1
    lines = values(house.master("MFG_LINE_DIM"), "LINE_NO_KEY", "PLANT")
    assert lines == [(100000001, "WA"), (300000001, "WH")]
    raw = sources(spark)["EIS_WIP_FA"]
    for _ in range(2):
        house.stage("EIS_WIP_FA", "WA", raw, batch, span=(date(2024, 3, 4), date(2024, 3, 6)))
    assert house.staged("EIS_WIP_FA", "WA").count() == 5
    report = house.rerun_runcard_fact("WA", batch, date(2024, 3, 4), date(2024, 3, 6))
    assert (report.deleted, report.inserted) == (3, 3)
    report = house.reload_runcard_fact("WA", batch, date(2024, 3, 1))
    assert (report.deleted, report.inserted) == (3, 3)


def test_initial_staging(spark, tmp_path):
    house = Warehouse(spark, Lake(str(tmp_path)))
    house.create()
    batch = Batch(5, AS_OF)
    house.stage("EIS_WIP_FA", "WN", sources(spark)["EIS_WIP_FA"], batch, initial=True)
    staged = house.staged("EIS_WIP_FA", "WN")
    assert values(staged.select("INF_BATCH_ID").distinct()) == [(1,)]
    assert staged.count() == 6


def mart_rows(house, spark):
    return values(schemas.mart_table(house.lake, "CUMULATIVE_YIELD").read(spark))


def test_the_mart_follows_the_changed_days(house, spark, monkeypatch):
    """A second build reads the days that loads have changed, and equals a whole one."""
    house.build_yield_mart(whole=True)
    before = mart_rows(house, spark)
    read = []
    plain = marts.mart_yield
    monkeypatch.setattr(marts, "mart_yield", lambda fact, *dims: read.append(fact) or plain(fact, *dims))
    house.build_yield_mart()
    assert read[-1].count() == 0 and mart_rows(house, spark) == before
    # Another day: the moves of 1 March, of which 9 pieces enter and leave.
    monkeypatch.setattr(marts, "mart_yield", plain)
    earlier = Batch(1, datetime(2024, 3, 2, 7, 15))
    house.refresh_dates(date(2024, 2, 24), date(2024, 3, 8), earlier, "WA")
    for name in ("EIS_WIP_FA", "EIS_WIP_FA_WIP_TRANS"):
        house.stage(name, "WA", sources(spark)[name], earlier)
    weeks = source(spark, "EIS_WORK_WEEK", ("2024", "Q1", "2", "WW09", datetime(2024, 2, 24), datetime(2024, 3, 2)))
    house.stage("EIS_WORK_WEEK", "WA", weeks, earlier)
    house.refresh_dates(date(2024, 2, 24), date(2024, 3, 1), earlier, "WA")
    house.rerun_runcard_fact("WA", earlier, date(2024, 3, 1), date(2024, 3, 2))
    monkeypatch.setattr(marts, "mart_yield", lambda fact, *dims: read.append(fact) or plain(fact, *dims))
    house.build_yield_mart()
    days = {row.DATE_KEY for row in read[-1].select("DATE_KEY").distinct().collect()}
    assert len(days) == 1
    after = mart_rows(house, spark)
    assert len(after) == len(before) + 1 and set(before) < set(after)
    house.build_yield_mart(whole=True)
    assert mart_rows(house, spark) == after
    # A day that a rerun empties leaves the mart.
    house.stage("EIS_WIP_FA", "WA", sources(spark)["EIS_WIP_FA"].limit(0), earlier)
    assert house.rerun_runcard_fact("WA", earlier, date(2024, 3, 1), date(2024, 3, 2)).deleted == 1
    house.build_yield_mart()
    assert mart_rows(house, spark) == before


def test_conversion_renames_the_card(house, spark):
    batch = Batch(1, AS_OF)
    before = values(house.master("SFC_RUNCARD_DIM").filter("PLANT = 'WA'"), "RUNCARD_NO_KEY")
    for _ in range(2):
        house.convert_runs("WA", batch)
        got = values(
            house.master("SFC_RUNCARD_DIM").filter("PLANT = 'WA'"),
            "RUNCARD_NO_KEY", "RUNCARD_NO", "FROM_RUN", "EER_NO",
        )
        assert got == [(before[0][0], "R1c", "R1", "E1")]
    other = schemas.master_table(house.lake, "SFC_RUNCARD_DIM")
    far = other.read(spark).filter("PLANT = 'WA'").withColumns(
        {"RUNCARD_NO_KEY": F.lit(105_000_000), "KEY_BLOCK": F.lit(105), "RUNCARD_NO": F.lit("far")}
    )
    loads.append(other, far)
    stamps = lambda: dict(values(other.read(spark).groupBy("KEY_BLOCK").agg(F.max("_metadata.file_path"))))
    held = stamps()
    house.reload_runcards("WA", batch, WINDOW)
    house.convert_runs("WA", batch)
    changed = {block for block, file in stamps().items() if held.get(block) != file}
    assert changed == {100}
    loads.replace_where(other, far.limit(0), F.col("RUNCARD_NO") == "far")
    house.reload_runcards("WA", batch, WINDOW)
    got = values(house.master("SFC_RUNCARD_DIM").filter("PLANT = 'WA'"), "RUNCARD_NO")
    assert got == [("R1",)]


def test_yield_span_edges(spark):
    routing = source(
        spark, "EIS_ROUTING_OPERATION",
        *[("P", "E", f"{n}", n) for n in (5, 10, 15, 20, 25)], ("P", "only start", "10", 10),
        ("P", "none", "10", 10),
    )
    markers = source(
        spark, "EIS_WIP_FA_START_OPERATION",
        ("P", "E", "10", "YIELD", "X"), ("P", "E", "20", "ENDYI", "X"),
        ("P", "only start", "10", "YIELD", "X"),
    )
    got = values(dims.yield_span(routing, markers), "EER_NO", "ROUTING_SEQ", "YIELD")
    flagged = [(row[0], row[1]) for row in got if row[2] == "YIELD"]
    assert sorted(flagged) == [("E", 10), ("E", 15), ("E", 20)] and len(got) == 7


def test_cumulative_yield_skips_zero_output(spark):
    rows = [("g", "1", 100, 100), ("g", "2", 100, 0), ("g", "3", 100, 50), ("h", "1", 0, 0)]
    df = spark.createDataFrame(
        [(g, o, d(i), d(t)) for g, o, i, t in rows],
        "g string, op string, INPUT_QTY decimal(15,5), OUTPUT_QTY decimal(15,5)",
    )
    got = values(marts.with_cumulative_yield(df, ["g"]), "g", "op",
                 *[F.col(n).cast("string") for n in ("OPERATION_YIELD", "CUM_YIELD")])
    assert got == [
        ("g", "1", "100.00", "50.00"),
        ("g", "2", "0.00", "50.00"),
        ("g", "3", "50.00", "50.00"),
        ("h", "1", None, None),
    ]


def test_trans_totals_equal_the_plain_join(spark):
    """Totals per side with a factor against the join of all rows."""
    s = sources(spark)
    trans, cards, wip = s["EIS_WIP_FA_WIP_TRANS"], s["EIS_WIP_FA_RUNCARD"], s["EIS_WIP_FA"]
    docs, ops = s["EIS_DOCUMENT_EER"], s["EIS_OPERATION"]
    docs = docs.unionByName(docs)
    got = facts.trans_totals(trans, cards, docs, wip, ops, WINDOW).first()
    for name, df in {"t": trans, "c": cards, "w": wip, "e": docs, "o": ops}.items():
        df.createOrReplaceTempView(f"plain_{name}")
    want = spark.sql("""
        SELECT sum(coalesce(t.INPUT, 0)), sum(coalesce(t.OUTPUT, 0)),
               sum(coalesce(t.SCRAP, 0) + coalesce(OQA_SAMPLE, 0) + coalesce(OQA_DEFECT, 0)
                   + coalesce(PCK, 0))
        FROM plain_t t JOIN plain_c c ON t.RUN_NO = c.RUN_NO
             JOIN plain_e e ON c.PRODUCT_PART_NO = e.PRODUCT_PART_NO AND c.EER_NO = e.EERNO
                           AND c.JIT_CELL_NO = e.JIT_CELL_NO
             JOIN plain_w w ON t.RUN_NO = w.RUN_NO
             JOIN plain_o o ON w.OPERATION_NO = o.OPERATION_NO AND o.OPERATION_GROUP = 'LAT'
        WHERE t.OPERATION_NO = '480' AND WIP_ALREADY = 'Y' AND ACCEPT_ALREADY = 'Y'""").first()
    assert (got.INPUT, got.OUTPUT, got.SCRAP) == tuple(want)


def test_case_variants_fold(spark):
    routing = source(spark, "EIS_ROUTING_OPERATION", ("P", "a1", "10", 1), ("P", "A1", "10", 1))
    ops = source(spark, "EIS_OPERATION", ("10", "x", "G"), ("10", "y", "G"))
    docs = source(spark, "EIS_DOCUMENT_EER", ("P", "C", "A1", IN, "WIP", "NRM"))
    got = dims.canonical_routing(routing, ops, docs).collect()
    assert [(r.EER_NO, r.OPERATION_NAME, r.LOT_TYPE, r.OPERATION_SEQ) for r in got] == [
        ("a1", "y", "NRM", "1")
    ]
