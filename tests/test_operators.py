import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import values
from yieldmill.operators import audit, joins, keys, lineage, merge

# --- upserts --------------------------------------------------------------------


def frames(spark, target, source, kinds="k string, p string, v string"):
    return spark.createDataFrame(target, kinds), spark.createDataFrame(source, kinds)


def test_insert_only_keeps_old_rows_and_duplicates(spark):
    target, source = frames(
        spark,
        [("a", "WA", "old"), ("b", "WH", "old")],
        [("a", "WA", "new"), ("b", "WA", "new"), ("c", "WA", "1"), ("c", "WA", "2")],
    )
    got = merge.upsert_insert(target, source, ["k", "p"])
    assert values(got) == [
        ("a", "WA", "old"),
        ("b", "WA", "new"),
        ("b", "WH", "old"),
        ("c", "WA", "1"),
        ("c", "WA", "2"),
    ]
    assert merge.upsert_insert(got, source, ["k", "p"]).count() == 5
    assert merge.upsert_insert(target, source, ["k", "p"], dedupe=True).count() == 4


def test_insert_with_null_keys(spark):
    target, source = frames(spark, [("a", None, "old")], [("a", None, "new"), ("b", None, "new")])
    assert merge.rows_to_insert(target, source, ["k", "p"]).count() == 2
    new = merge.rows_to_insert(target, source, ["k", "p"], nullable=["p"])
    assert values(new) == [("b", None, "new")]


def test_insert_where_zero_stands_for_null(spark):
    target, source = frames(spark, [("a", 0)], [("a", None), ("b", None)], "k string, p int")
    new = merge.rows_to_insert(target, source, ["k", "p"], nullable=["p"], zero_is_null=True)
    assert values(new) == [("b", None)]


def test_update_matched(spark):
    target, source = frames(
        spark, [("a", "WA", "old"), ("b", "WA", "old")], [("a", "WA", None), ("c", "WA", "x")]
    )
    got = merge.upsert_update(target, source, ["k", "p"], ["v"])
    assert values(got) == [("a", "WA", None), ("b", "WA", "old")]


def test_conditional_update_ignores_null_status(spark):
    target, source = frames(
        spark,
        [("a", "", "x"), ("b", "", "x"), ("c", "", None), ("d", "", "x")],
        [("a", "", "x"), ("b", "", "y"), ("c", "", "y"), ("d", "", None)],
    )
    plain = merge.upsert_update(target, source, ["k"], ["v"], merge.status_changed("v"))
    assert [row[2] for row in values(plain)] == ["x", "y", None, "x"]
    safe = merge.upsert_update(target, source, ["k"], ["v"], merge.status_changed("v", True))
    assert [row[2] for row in values(safe)] == ["x", "y", "y", None]


def test_update_of_the_key_itself(spark):
    target, source = frames(spark, [("a", "WA", "1"), ("a", "WH", "2")], [("a", "b", "9")])
    got = merge.upsert_update(target, source, ["k"], {"k": "p"}, only=target["p"] == "WA")
    assert values(got) == [("a", "WH", "2"), ("b", "WA", "1")]


def test_two_source_rows_for_one_target_row_fail(spark):
    target, source = frames(spark, [("a", "", "x")], [("a", "", "1"), ("a", "", "2")])
    with pytest.raises(PySparkException, match="several source rows"):
        merge.upsert_update(target, source, ["k"], ["v"]).collect()
    unmatched, source = frames(spark, [("z", "", "x")], [("a", "", "1"), ("a", "", "2")])
    assert merge.upsert_update(unmatched, source, ["k"], ["v"]).count() == 1


# --- keys -------------------------------------------------------------------------


def test_keys_are_dense_and_ordered_under_skew(spark):
    # A third of the rows share one sort key.
    rows = [("hot", i) for i in range(1000)] + [(f"k{i:05d}", i) for i in range(2000)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, i int").repartition(7)
    numbered = keys.number_rows(df, ["k", "i"], "n")
    got = [(row.k, row.i) for row in sorted(numbered.collect(), key=lambda row: row.n)]
    assert got == sorted(rows)
    by_key = keys.number_rows(df, ["k"], "n")
    got = sorted((row.n, row.k) for row in by_key.collect())
    assert [n for n, _ in got] == list(range(1, 3001))
    assert [k for _, k in got] == sorted(k for k, _ in rows)


def test_hot_sort_key_is_spread(spark):
    df = spark.range(20_000).select(F.lit("same").alias("k"), "id")
    ranged = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(
        4, "k", "_row"
    )
    sizes = [row["count"] for row in ranged.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 10_000
    assert keys.number_rows(df, ["k"], "n").select(F.max("n")).first()[0] == 20_000


def test_keys_follow_the_target_or_the_base(spark):
    new = spark.createDataFrame([("b",), ("a",)], "k string")
    old = spark.createDataFrame([(5, "x", "WA"), (900, "y", "WH")], "id int, k string, p string")
    got = keys.assign_keys(new, old, "id", ["k"], 100, F.col("p") == "WA")
    assert values(got) == [(6, "a"), (7, "b")]
    got = keys.assign_keys(new, old, "id", ["k"], 100, F.col("p") == "WN")
    assert values(got) == [(101, "a"), (102, "b")]
    assert got.schema["id"].dataType.simpleString() == "int"
    assert keys.assign_keys(new.limit(0), old, "id", ["k"], 100).count() == 0


# --- joins -----------------------------------------------------------------------


@pytest.mark.parametrize(
    ("listed", "kept"),
    [(["a"], ["b"]), (["a", None], []), ([], ["a", "b", None]), (["z", "z"], ["a", "b"])],
)
def test_not_in(spark, listed, kept):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    values_df = spark.createDataFrame([(v,) for v in listed], "y string")
    got = [row[0] for row in joins.not_in(df, "x", values_df).collect()]
    assert Counter(got) == Counter(kept)
    df.createOrReplaceTempView("left_rows")
    values_df.createOrReplaceTempView("listed_rows")
    flagged = joins.with_not_in(df, "x", values_df, "keep")
    assert flagged.count() == 3
    assert Counter(row.x for row in flagged.filter("keep").collect()) == Counter(kept)
    sql = "SELECT x FROM left_rows WHERE x NOT IN (SELECT y FROM listed_rows)"
    assert Counter(got) == Counter(row[0] for row in spark.sql(sql).collect())


def test_not_in_has_no_forced_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(10).select(F.col("id").cast("string").alias("x"))
        plan = joins.not_in(df, "x", df.limit(3))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan and "NestedLoop" not in plan


def test_in_pairs_and_lookup(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (1, "b")], "i int, s string")
    pairs = spark.createDataFrame([(1, "a"), (1, "a"), (2, "z")], "j int, t string")
    assert values(joins.in_pairs(df, {"i": "j", "s": "t"}, pairs)) == [(1, "a")]
    dim = spark.createDataFrame([("a", 10), ("b", 20)], "s string, key int")
    got = joins.lookup_key(df, dim.filter("s = 'a'"), {"s": "s"}, ["key"], "left")
    assert values(got) == [(1, "a", 10), (1, "b", None), (2, "b", None)]


def test_week_of(spark):
    weeks = spark.createDataFrame(
        [("W1", "1", "Q1", "2024", "2024-01-06", "2024-01-13")],
        "WW string, MONTH string, QUARTER string, YEAR string, f string, t string",
    ).select(
        "*",
        F.col("f").cast("timestamp_ntz").alias("SAT_FROM_DATE"),
        F.col("t").cast("timestamp_ntz").alias("SAT_TO_DATE"),
    )
    days = spark.createDataFrame(
        [("2024-01-05",), ("2024-01-06",), ("2024-01-09",), ("2024-01-12",), ("2024-01-13",)],
        "d string",
    ).select(F.to_date("d").alias("DATE_BEGIN"))
    got = values(joins.week_of(days, weeks), F.dayofmonth("DATE_BEGIN"), "WW")
    assert got == [(12, "W1"), (6, "W1"), (9, "W1")]


def test_latest_and_group_max(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")], "g string, n int, t string")
    assert values(joins.latest_per(df, ["g"], ["n"])) == [("a", 3, "y"), ("b", 2, "z")]
    got = joins.with_group_max(df, df.filter("g = 'a'"), ["g"], "t", "best")
    assert values(got, "g", "best") == [("a", "y"), ("a", "y"), ("b", None)]


def test_unify_plants(spark):
    a = spark.createDataFrame([(1, "x")], "i int, only_a string")
    b = spark.createDataFrame([(2, "y")], "i int, only_b string")
    got = joins.unify_plants({"WA": a, "WH": b})
    assert values(got, "i", "only_a", "only_b", "PLANT") == [
        (1, "x", None, "WA"),
        (2, None, "y", "WH"),
    ]


# --- lineage -----------------------------------------------------------------------


def walk(edges):
    """Descendants of every run with their greatest distance, by brute force."""
    children = {}
    for run, source in edges:
        children.setdefault(source, set()).add(run)
    found = {}
    for root in children:
        depths, level, depth = {}, {root}, 0
        while level:
            level = {c for run in level for c in children.get(run, ())}
            depth += 1
            depths.update(dict.fromkeys(level, depth))
        found[root] = depths
    return found


def last(spark, edges, latest="max"):
    df = spark.createDataFrame(edges, "RUN_NO string, FROM_RUN string")
    rows = lineage.last_descendants(df, latest).collect()
    return {row.FROM_RUN: (row.RUN_NO, row.depth) for row in rows}


def chain(length):
    return [(f"r{i + 1:04d}", f"r{i:04d}") for i in range(length)]


@pytest.mark.parametrize("latest", ["max", "deepest"])
def test_lineage_matches_brute_force(spark, latest):
    rng = random.Random(5)
    tree = [(f"t{rng.randrange(10**6):06d}{i}", None) for i in range(60)]
    edges = [
        (tree[i][0], tree[rng.randrange(max(0, i - 6), i)][0]) for i in range(1, len(tree))
    ]
    star = [(f"s{i}", "hub") for i in range(40)]
    diamond = [("d2", "d1"), ("d3", "d1"), ("d4", "d2"), ("d4", "d3"), ("d9", "d4"), ("d9", "d1")]
    every = edges + star + diamond + chain(37) + [("x2", "x1"), ("x2", "x1")]
    rank = {
        "max": lambda pair: (pair[0], pair[1]),
        "deepest": lambda pair: (pair[1], pair[0]),
    }[latest]
    expected = {root: max(found.items(), key=rank) for root, found in walk(set(every)).items()}
    assert last(spark, every, latest) == expected


@pytest.mark.parametrize("latest", ["max", "deepest"])
def test_lineage_of_runs_with_two_parents(spark, latest):
    """Every third run of a chain is merged from two runs."""
    rng = random.Random(7)
    edges = []
    for i in range(1, 25):
        edges.append((f"m{i * 37 % 61:02d}", f"m{(i - 1) * 37 % 61:02d}"))
        if i > 3 and i % 3 == 0:
            edges.append((f"m{i * 37 % 61:02d}", f"m{rng.randrange(i - 1) * 37 % 61:02d}"))
    rank = {
        "max": lambda pair: (pair[0], pair[1]),
        "deepest": lambda pair: (pair[1], pair[0]),
    }[latest]
    expected = {root: max(found.items(), key=rank) for root, found in walk(set(edges)).items()}
    assert last(spark, edges, latest) == expected


def test_lineage_of_merges_in_a_row_takes_few_rounds(spark, monkeypatch):
    """A chain whose runs are all merged from two halves like any other, and no round holds more links."""
    edges = chain(48) + [(run, f"x{run}") for run, _ in chain(48)]
    rounds = []
    written = lineage._written

    def counted(*args):
        state, left = written(*args)
        rounds.append(left)
        return state, left

    monkeypatch.setattr(lineage, "_written", counted)
    expected = {root: max(found.items()) for root, found in walk(set(edges)).items()}
    assert last(spark, edges) == expected
    assert len(rounds) <= 9 and max(rounds) == len(edges)


def test_lineage_handles_settled_runs_that_links_reach_late(spark):
    """Links that moved on to a run after it was settled still get its best descendant."""
    edges = [("z", "a")] + [(f"b{i}", f"b{i + 1}") for i in range(9)] + [("a", "b0")]
    edges += [("b7", "w"), ("c", "w"), ("a", "v"), ("b3", "v")]
    for latest, rank in (("max", lambda p: p), ("deepest", lambda p: p[::-1])):
        expected = {root: max(found.items(), key=rank) for root, found in walk(set(edges)).items()}
        assert last(spark, edges, latest) == expected


def test_lineage_cycle_over_merges_is_reported(spark):
    edges = [("b", "a"), ("b", "x"), ("c", "b"), ("a", "c"), ("a", "y")]
    with pytest.raises(lineage.LineageCycle):
        last(spark, edges)
    with pytest.raises(lineage.LineageCycle):
        last(spark, [("a", "a"), ("a", "b")])


def test_lineage_cycle_is_reported(spark):
    for cycle in ([("a", "a")], [("b", "a"), ("a", "b")], chain(5) + [("r0000", "r0005")]):
        with pytest.raises(lineage.LineageCycle):
            last(spark, cycle)


def test_run_lineage_respects_window_and_keys(spark):
    cards = spark.createDataFrame(
        [(1, "a"), (2, "b"), (3, "z"), (9, "a")], "RUNCARD_NO_KEY int, RUNCARD_NO string"
    )
    edges = spark.createDataFrame(
        [("b", "a", "2024-01-02 08:00:00"), ("c", "b", "2024-01-02 09:00:00"),
         ("d", "c", "2024-01-03 08:00:00"), (None, "c", "2024-01-02 08:00:00")],
        "RUN_NO string, FROM_RUN string, t string",
    ).withColumn("CONVERTED_DATE", F.col("t").cast("timestamp_ntz"))
    window = (datetime(2024, 1, 2, 7, 0, 1), datetime(2024, 1, 3, 7, 0, 0))
    got = values(lineage.run_lineage(cards, edges, window))
    assert got == [(1, "a", "c"), (2, "b", "c")]
    got = values(lineage.run_lineage(cards, edges))
    assert got == [(1, "a", "d"), (2, "b", "d")]
    none = lineage.run_lineage(cards, edges.limit(0))
    assert none.count() == 0


# --- audit -------------------------------------------------------------------------


def test_batches(spark):
    control = spark.createDataFrame(
        [], "INF_BATCH_ID int, DATE_FROM timestamp_ntz, DATE_TO timestamp_ntz"
    )
    assert audit.current_batch(control) is None
    day = datetime(2024, 3, 5).date()
    first = audit.next_batch(control, day)
    assert values(first) == [(1, datetime(2024, 3, 4, 7, 0, 1), datetime(2024, 3, 5, 7, 0))]
    assert audit.next_batch(first, day).count() == 0
    second = audit.next_batch(first, datetime(2024, 3, 6).date())
    assert second.first()["INF_BATCH_ID"] == 2
    assert audit.current_batch(first.unionByName(second)) == 2


def test_preview_counts_what_the_joins_give(spark):
    target = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", None)], "k string, v string")
    source = spark.createDataFrame([("a", "1"), ("b", "1"), (None, "1"), ("c", "1")], "k string, v string")
    assert tuple(audit.merge_preview(target, source, ["k"]).first()) == (3, 2)
    assert tuple(audit.merge_preview(target, source, ["k"], ["v"]).first()) == (1, 2)


def test_one_pass_merge_equals_its_parts(spark):
    target = spark.createDataFrame(
        [(1, "a", "x"), (2, "b", "x"), (3, "c", None), (4, None, "x"), (5, "d", "x"), (6, "d", "x")],
        "id int, k string, v string",
    )
    source = spark.createDataFrame(
        [("a", "y", 1), ("b", "x", 1), ("c", "y", 1), (None, "y", 1), (None, "z", 1), ("n", "y", 1), ("n", "z", 0)],
        "k string, v string, w int",
    )
    differs = merge.status_changed("v")
    found = merge.merge(target, source, ["k"], values=["v"], when=differs)
    assert values(found.target) == values(merge.upsert_update(target, source, ["k"], ["v"], when=differs))
    assert values(found.new) == values(merge.rows_to_insert(target, source, ["k"]))
    assert (found.updated, found.inserted) == (1, 4)
    assert (found.updated, found.inserted) == tuple(audit.merge_preview(target, source, ["k"], ["v"]).first())
    some = merge.merge(target, source, ["k"], insert_when=lambda new: new["w"] == 1, nullable=["k"])
    assert values(some.target) == values(target) and (some.updated, some.inserted) == (0, 1)
    none = merge.merge(target.limit(0), source.limit(0), ["k"], values=["v"])
    assert none.target.count() == none.inserted == none.updated == 0
    plan = merge.merge_actions(target, source, ["k"], ["v"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "Join FullOuter" in plan
    with pytest.raises(Exception, match="several source rows"):
        merge.merge(target, source.unionByName(source), ["k"], values=["v"])
    # Two source rows of a known key are no error where nothing is updated.
    twice = merge.merge(target, source.unionByName(source), ["k"])
    assert values(twice.target) == values(target) and twice.inserted == 8


def test_audit_columns_and_counts(spark, tmp_path):
    batch = audit.Batch(3, datetime(2024, 3, 5, 7, 15))
    df = spark.range(5).withColumn("name", F.lit("x"))
    audited = audit.with_audit(df, "src", "sess", batch, ["id"])
    assert len(audited.columns) == 12
    row = audited.filter("id = 1").first()
    assert (row.SOURCE_TABLE_NAME, row.INF_BATCH_ID, row.DM_DATE_TO) == ("src", 3, batch.as_of)
    counted, seen = audit.counted(audited, "loaded")
    counted.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"rows": 5}
    random_ids = audit.with_audit(df, "src", "sess", batch).select("REC_ID").distinct()
    assert random_ids.count() == 5


def test_keys_stop_at_the_next_range(spark):
    target = spark.createDataFrame([(299_999_999,)], "K int")
    new = spark.createDataFrame([("a",), ("b",)], "name string")
    one = keys.assign_keys(new.limit(1), target, "K", ["name"], keys.KEY_BASE["WA"])
    assert [row["K"] for row in one.collect()] == [300_000_000]
    two = keys.assign_keys(new, target, "K", ["name"], keys.KEY_BASE["WA"])
    with pytest.raises(Exception, match="next range"):
        two.collect()
