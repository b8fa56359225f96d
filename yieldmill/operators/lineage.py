"""Run-to-run lineage: the last run that each run card was converted into."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from yieldmill.functions.prodtime import in_window
from yieldmill.operators.audit import rows_seen
from yieldmill.session import keeping_counts, materialise


class LineageCycle(ValueError):
    """The conversions lead back to a run they started from."""


def conversions(
    edges: DataFrame, window: tuple[datetime, datetime] | None = None
) -> DataFrame:
    """Conversions FROM_RUN -> RUN_NO, optionally of one window."""
    rows = edges if window is None else edges.filter(in_window("CONVERTED_DATE", window))
    rows = rows.filter(F.col("RUN_NO").isNotNull() & F.col("FROM_RUN").isNotNull())
    return rows.select("RUN_NO", "FROM_RUN")


def last_descendants(edges: DataFrame, latest: str = "max") -> DataFrame:
    """For each run that was converted, the run its descendants end in.

    ``latest="max"`` takes the greatest run number among all descendants,
    ``latest="deepest"`` the one most conversions away, then the greatest.

    A run starts with its children as offers and as open links.  In each round a link to a
    settled run, one without open links, hands over that run's best descendant and is used
    up; a link to a run with one open child hands over what that run has so far and moves on
    to the child.  So leaves fall off while chains halve: a chain of n runs takes log2(n)
    rounds, also through runs merged from several.  Only links still open and the runs at
    their ends go on to the next round, never more links than conversions.  In a cycle a
    round comes that uses up no link; that is reported.
    """
    if latest not in ("max", "deepest"):
        raise ValueError(f"latest must be 'max' or 'deepest', not {latest!r}")
    rank = ("run", "depth") if latest == "max" else ("depth", "run")
    offers = edges.select(
        F.col("FROM_RUN").alias("node"),
        F.col("RUN_NO").alias("child"),
        F.lit(1).alias("dist"),
        F.col("RUN_NO").alias("run"),
        F.lit(1).alias("depth"),
        F.lit(False).alias("listed"),
        F.lit("link").alias("kind"),
    )
    state, left = _written(offers, "lineage", "link")
    settled = [state.where("kind = 'settled'")]
    while left:
        state, still_left = _written(_next_round(state, rank), "lineage", "link")
        if still_left == left:
            raise LineageCycle("run conversions form a cycle")
        left = still_left
        settled.append(state.where("kind = 'settled'"))
    # What the last links have led to is settled without a further round.
    rest = _runs(state, rank).where("low IS NULL AND NOT listed")
    best = reduce(DataFrame.unionByName, [rows.select("node", "run", "depth") for rows in [*settled, rest]])
    return best.select(F.col("node").alias("FROM_RUN"), F.col("run").alias("RUN_NO"), "depth")


def _runs(state: DataFrame, rank: tuple[str, str]) -> DataFrame:
    """Per run its best descendant so far, its least and greatest open child, and the way there."""
    # The filter is the one that joins would add, so that all uses share one shuffle.
    rows = state.where("kind <> 'settled' AND node IS NOT NULL")
    found = rows.groupBy("node").agg(
        F.max(F.struct(*rank)).alias("best"),
        F.min("child").alias("low"),
        F.max("child").alias("high"),
        F.max("dist").alias("dist"),
        F.bool_or("listed").alias("listed"),
    )
    return found.select("node", "best.run", "best.depth", "low", "high", "dist", "listed")


def _next_round(state: DataFrame, rank: tuple[str, str]) -> DataFrame:
    """The state after each open link has met the run it leads to.

    Rows of a state: open links, with what they have handed over last; values, the best
    of a run so far; and runs settled in this round.  A settled run stays as a ``listed``
    value as long as links lead to it, because others may still move on to it.
    """
    runs = _runs(state, rank)
    ends = runs.select(*[F.col(name).alias(f"end_{name}") for name in runs.columns])
    links = state.where("kind = 'link'").select("node", "child", "dist")
    met = links.join(ends, F.col("child") == F.col("end_node"), "left")

    def row(node, child, dist, run, depth, listed: bool) -> Column:
        kind = F.when(child.isNotNull(), "link").otherwise("value")
        values = {"node": node, "child": child, "dist": dist, "run": run, "depth": depth}
        values |= {"listed": F.lit(listed), "kind": kind}
        return F.struct(*[value.alias(name) for name, value in values.items()])

    node, child, dist = F.col("node"), F.col("child"), F.col("dist")
    run, depth = F.col("end_run"), F.col("end_depth")
    no_run, no_number = F.lit(None).cast(state.schema["run"].dataType), F.lit(None).cast("int")
    used_up = F.array(
        row(node, no_run, no_number, run, dist + depth, False),
        row(child, no_run, no_number, run, depth, True),
    )
    moved = F.array(row(node, F.col("end_low"), dist + F.col("end_dist"), run, dist + depth, False))
    waiting = F.array(row(node, child, dist, no_run, no_number, False))
    after = (
        F.when(F.col("end_node").isNull(), F.array().cast(met.select(waiting).schema[0].dataType))
        .when(F.col("end_listed") | F.col("end_low").isNull(), used_up)
        .when(F.col("end_low") == F.col("end_high"), moved)
        .otherwise(waiting)
    )
    # Here and in the join all columns of the runs are named, so that their shuffle is used twice.
    open_ = F.col("low").isNotNull() & F.col("high").isNotNull() & F.col("dist").isNotNull()
    own = runs.where(open_ | ~F.col("listed")).select(
        row(node, no_run, no_number, F.col("run"), F.col("depth"), False).alias("row"), open_.alias("open")
    )
    values = own.select("row.*", "open").withColumn("kind", F.when(F.col("open"), "value").otherwise("settled"))
    return met.select(F.explode(after).alias("row")).select("row.*").unionByName(values.drop("open"))


def _written(state: DataFrame, label: str, kind: str) -> tuple[DataFrame, int]:
    """The state of a round, written once by kind, and its rows of one kind."""
    seen = Observation(label)
    state = state.observe(seen, F.count(F.when(F.col("kind") == kind, 1)).alias("rows"))
    with keeping_counts(state.sparkSession):
        state = materialise(state, label, ("kind",))
    return state, rows_seen(seen)


def run_lineage(
    cards: DataFrame,
    edges: DataFrame,
    window: tuple[datetime, datetime] | None = None,
    latest: str = "max",
) -> DataFrame:
    """The current run of every run card converted in the window.

    One row per run number; of cards that share one, the lowest key counts.
    """
    last = last_descendants(conversions(edges, window), latest)
    # The window's few runs reduce the cards before these are grouped.
    found = cards.select("RUNCARD_NO", "RUNCARD_NO_KEY").join(last, F.col("RUNCARD_NO") == F.col("FROM_RUN"))
    return (
        found.groupBy(F.col("RUNCARD_NO").alias("original_runcard_no"), F.col("RUN_NO").alias("current_run_no"))
        .agg(F.min("RUNCARD_NO_KEY").alias("RUNCARD_NO_KEY"))
        .select("RUNCARD_NO_KEY", "original_runcard_no", "current_run_no")
    )
