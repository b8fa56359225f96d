"""The registered queries: contract, plans, and a few results against DuckDB."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as contract
from tools.check_oracle import TABLES, kinds, rows_of

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()
COMPARED = [
    "cumulative_yield",
    "dim_conditional_update",
    "dim_date",
    "dim_runcard",
    "key_assign",
    "replace_by_keys",
    "run_lineage_apply",
    "spc_daily",
    "stream_json_ingest",
    "trans_moves_month",
    "trans_moves_stored",
    "wip_moves_month",
]


def test_contract(spark):
    from shopfloor import catalogue

    assert set(catalogue.ORACLE) == set(catalogue.QUERIES)
    assert set(catalogue.QUERIES) <= set(QUERIES) and set(ORACLE) <= set(QUERIES)
    df = contract.entry(spark)
    assert df.columns[0] == "MachineNo" and df.count() > 0


@pytest.mark.parametrize("name", COMPARED)
def test_equals_duckdb(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got = QUERIES[name](spark, FOLDER).toArrow()
    want = con.execute(ORACLE[name]).to_arrow_table()
    assert kinds(got) == kinds(want)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize(
    "name",
    ["spc_daily", "limit_match", "calendar_week", "yield_span", "trans_moves", "correlated_max",
     "merge_preview", "not_in_subquery", "move_union"],
)
def test_plans_have_no_row_pairs_and_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "NestedLoop", "Python", "Pandas"):
        assert word not in plan


def test_window_filter_reaches_the_scan(spark):
    df = QUERIES["window_filter"](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


@pytest.mark.parametrize("name", ["wip_moves_month", "trans_moves_month"])
def test_history_is_reduced_to_the_window_before_it_is_summed(spark, name):
    """Documents meet the cards of the window below their aggregate."""
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    by_lot = re.compile(r"Aggregate \[PRODUCT_PART_NO#\d+, EER_NO#\d+, JIT_CELL_NO#\d+, LAT_LOT_TYPE#")
    places = [i for i, line in enumerate(lines) if by_lot.search(line)]
    assert places
    for at in places:
        first = next(line for line in lines[at + 1 :] if "Join" in line or "Relation" in line)
        assert "LeftSemi" in first


def test_history_laid_out_by_run_is_not_shuffled(spark):
    """Moves, cards and documents meet the month's runs where they lie, without a broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["trans_moves_stored"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    history = [i for i, line in enumerate(lines) if "FileScan" in line and "yieldmill_" in line]
    assert len(history) >= 4
    for at in history:
        above, level = [], depth(lines[at])
        for line in reversed(lines[:at]):
            if depth(line) < level:
                above.append(line)
                level = depth(line)
        first = next(line for line in above if "Exchange" in line or "Join" in line or "Aggregate" in line)
        assert "Exchange" not in first


def test_first_shuffle_of_the_star_join_is_of_key_sums(spark):
    from shopfloor import warehouse_queries

    plan = warehouse_queries.star_join_yield(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "INPUT_QTY" in line)
    up = [line for line in lines[:scan] if "Exchange" in line or "Aggregate" in line or "Join" in line]
    assert "partial_sum(INPUT_QTY" in up[-1] and "ROUTE_OPERATION_NO_KEY" in up[-2] and "Exchange" in up[-2]


def planned(spark, build):
    """The lines of a plan without broadcasts, as of tables that are too large for them."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return build()._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_union_of_moves_removes_repeats_where_the_moves_lie(spark):
    lines = planned(spark, lambda: QUERIES["move_union"](spark, FOLDER))
    assert any("Union" in line for line in lines)
    assert not any("Exchange hashpartitioning(DATE_BEGIN#" in line for line in lines)


def test_moves_meet_dimensions_without_a_copy_of_the_union(spark):
    """Transactions are dealt by run and product, as the moves lie, and no union is written before."""
    lines = planned(spark, lambda: QUERIES["surrogate_lookup"](spark, FOLDER))
    assert any("Union" in line for line in lines)
    dealt = [line for line in lines if "REPARTITION_BY_COL" in line]
    assert dealt and all("hashpartitioning(RUN_NO#" in line for line in dealt)


def test_stored_rows_are_dealt_once_and_packed(spark):
    from shopfloor import warehouse_queries

    tables = warehouse_queries.stored(spark, FOLDER, buckets=4)
    for df in tables.values():
        names = [name.rsplit("/", 1)[-1] for name in df.inputFiles()]
        assert names and all(name.endswith(".zstd.parquet") for name in names)
        buckets = [name.split("_")[-1].split(".")[0] for name in names]
        assert len(buckets) == len(set(buckets))


def test_run_cards_are_numbered_before_their_audit_columns(spark, monkeypatch):
    from yieldmill.operators import keys

    seen, write = [], keys.materialise
    monkeypatch.setattr(keys, "materialise", lambda df, label: seen.append(df.columns) or write(df, label))
    df = QUERIES["dim_runcard"](spark, FOLDER)
    assert seen and not any("REC_ID" in columns for columns in seen)
    assert df.filter("INF_SESS_NAME IS NULL").isEmpty()
