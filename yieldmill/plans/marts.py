"""Marts: cumulative yield and statistical process control."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldmill.functions import spc
from yieldmill.functions.exprs import steady_decimal, text_number
from yieldmill.functions.prodtime import month_label, quarter_digit
from yieldmill.plans.dims import YIELD_FLAG
from yieldmill.plans.schemas import SORTED

QTY = ["INPUT_QTY", "OUTPUT_QTY", "SCRAP_QTY"]
MART_ORDER = ["DATE_BEGIN", *SORTED["CUMULATIVE_YIELD"]]


def ratio(output_qty: Column, input_qty: Column) -> Column:
    """Output over input as decimals; NULL without input."""
    return F.try_divide(output_qty.try_cast("decimal(15,5)"), input_qty.try_cast("decimal(15,5)"))


def operation_yield(output_qty: Column, input_qty: Column) -> Column:
    """Yield of one operation in percent."""
    return (ratio(output_qty, input_qty) * 100).try_cast("decimal(15,2)")


def with_cumulative_yield(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add operation and cumulative yield to rows with one row per operation.

    The cumulative yield is the product of the ratios of all rows of a group, as a
    sum of logarithms.  A row without output has no logarithm and is skipped.  The
    rows must already be summed to the operation, so a window partition holds one
    group's operations and not its moves.
    """
    share = ratio(F.col("OUTPUT_QTY"), F.col("INPUT_QTY"))
    total = F.sum(F.ln(share)).over(Window.partitionBy(*by))
    return df.withColumns(
        {
            "OPERATION_YIELD": operation_yield(F.col("OUTPUT_QTY"), F.col("INPUT_QTY")),
            "CUM_YIELD": steady_decimal(F.exp(total) * 100, 15, 2),
        }
    )


def star_join_yield(
    fact: DataFrame,
    routing: DataFrame,
    products: DataFrame,
    lines: DataFrame,
    dates: DataFrame,
) -> DataFrame:
    """Quantities of yield operations by day, product, line, lot type and operation.

    The fact is summed by its surrogate keys first, in each task and then by one shuffle
    of sums.  The dimensions meet these sums and not the moves, and the sums are added
    again where several keys share a label.
    """
    steps = routing.filter(F.col("YIELD") == YIELD_FLAG).select(
        "ROUTE_OPERATION_NO_KEY",
        "PRODUCT_PART_NO_KEY",
        F.col("LOT_TYPE").alias("LAT_LOT_TYPE"),
        "OPERATION_NO",
    )
    product = products.select(
        "PRODUCT_PART_NO_KEY", F.col("FAMILY_NAME").alias("PRODUCT_FAMILY"), "MPT_PART_NO"
    )
    days = dates.select(
        "DATE_KEY",
        "DATE_BEGIN",
        "WW",
        month_label(F.col("DATE_BEGIN"), F.col("YEAR")).alias("MMM"),
        quarter_digit(F.col("QUARTER")).alias("QUARTER"),
    )
    sums = fact.groupBy("ROUTE_OPERATION_NO_KEY", "LINE_NO_KEY", "DATE_KEY").agg(
        *[F.sum(name).alias(name) for name in QTY]
    )
    joined = (
        sums.join(steps, "ROUTE_OPERATION_NO_KEY")
        .join(product, "PRODUCT_PART_NO_KEY")
        .join(lines.select("LINE_NO_KEY", "LINE_NO"), "LINE_NO_KEY")
        .join(days, "DATE_KEY")
    )
    return joined.groupBy(
        "DATE_BEGIN",
        "WW",
        "MMM",
        "QUARTER",
        "PRODUCT_FAMILY",
        "MPT_PART_NO",
        "LINE_NO",
        "LAT_LOT_TYPE",
        "OPERATION_NO",
    ).agg(*[F.sum(name).cast("decimal(25,5)").alias(name) for name in QTY])


def mart_yield(
    fact: DataFrame,
    routing: DataFrame,
    products: DataFrame,
    lines: DataFrame,
    dates: DataFrame,
) -> DataFrame:
    """Cumulative-yield mart."""
    grouped = star_join_yield(fact, routing, products, lines, dates)
    return with_cumulative_yield(grouped, ["DATE_BEGIN", "LINE_NO", "MPT_PART_NO", "LAT_LOT_TYPE"])


def ordered_mart(mart: DataFrame) -> DataFrame:
    """The mart in report order."""
    return mart.orderBy(*MART_ORDER)


def spc_groups(fact: DataFrame, limits: DataFrame, limits_from_master: bool = False) -> DataFrame:
    """Measured values by machine, event, variable, limit and day with mean and deviation.

    Limits are those stored with the fact; ``limits_from_master`` takes the current
    ones of the limit table.
    """
    bounds = limits.select(
        F.col("MachineNo").alias("_machine"),
        F.lower("VariableName").alias("_variable"),
        F.col("VariableName").alias("_name"),
        F.col("SpecLCL").alias("_lcl"),
        F.col("SpecUCL").alias("_ucl"),
    )
    rows = fact.join(
        bounds,
        (F.col("MachineNo") == F.col("_machine"))
        & (F.lower("VariableName") == F.col("_variable")),
    )
    lcl, ucl = ("_lcl", "_ucl") if limits_from_master else ("SpecLCL", "SpecUCL")
    value = text_number("Value")
    return rows.groupBy(
        "MachineNo",
        "CeId",
        "CollectionEventName",
        "RptId",
        "Vid",
        "Status",
        F.col(lcl).alias("_spec_lcl"),
        F.col("_name"),
        "Date",
    ).agg(
        F.sum(value).alias("Value"),
        F.avg(lcl).alias("LCL"),
        F.avg(ucl).alias("UCL"),
        spc.mean_2(value).alias("MEAN"),
        spc.sigma_2(value).alias("SIGMA"),
    )


def mart_spc(fact: DataFrame, limits: DataFrame, limits_from_master: bool = False) -> DataFrame:
    """Process-control mart.

    Names are put in report spelling after grouping by the raw name, so two raw
    names stay two rows unless all their values agree.
    """
    name, machine = F.col("_name"), F.col("MachineNo")
    mean, sigma = F.col("MEAN"), F.col("SIGMA")
    return (
        spc_groups(fact, limits, limits_from_master)
        .select(
            "MachineNo",
            "CeId",
            "CollectionEventName",
            "RptId",
            "Vid",
            "Status",
            "Date",
            "Value",
            spc.canonical_name(name).alias("VariableName"),
            spc.trigger_limit(machine, name).alias("Trigger"),
            "LCL",
            "UCL",
            "MEAN",
            "SIGMA",
            spc.capability(F.col("LCL"), F.col("UCL"), F.col("_spec_lcl"), mean, sigma).alias(
                "CPK"
            ),
            F.lit(str(spc.DOT_LCL)).alias("LCL_DOTSIZE"),
            F.lit(str(spc.DOT_UCL)).alias("UCL_DOTSIZE"),
            mean.alias("MEAN_DOTSIZE"),
            sigma.alias("SIGMA_DOTSIZE"),
            spc.capability_between(spc.DOT_LCL, spc.DOT_UCL, mean, sigma).alias("CPK_DOTSIZE"),
        )
        .distinct()
    )
