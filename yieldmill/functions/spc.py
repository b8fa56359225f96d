"""Statistical process control expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from yieldmill.functions.exprs import steady_decimal

# Variable names with one spelling in reports.
CANONICAL_NAMES = {
    "bondforce": "BondForceFloat",
    "bondforcefloat": "BondForceFloat",
    "dispenserpressure": "DispenserPressure",
    "pbiquality": "PbiQuality",
}
MISSING_NAME = "0"

# Trigger limits by machine and variable.
LOW_TRIGGER_MACHINES = ["DTC128", "DTC147", "DTC148"]
LOW_TRIGGER_PAIR = ("DTC149", "bondforcefloat")
LOW_TRIGGER_VARIABLE = "pbiquality"
LOW_TRIGGER, USUAL_TRIGGER, OTHER_TRIGGER = 60, 70, 100

# Dot-size limits.
DOT_LCL, DOT_UCL = 170, 260


def canonical_name(name: Column, names: dict[str, str] | None = None) -> Column:
    """Report spelling of a variable; blank or missing becomes '0'."""
    names = CANONICAL_NAMES if names is None else names
    trimmed = F.trim(name)
    spelling = F.when(name.isNull() | (trimmed == ""), F.lit(MISSING_NAME))
    for raw, label in names.items():
        spelling = spelling.when(F.lower(trimmed) == raw, F.lit(label))
    return spelling.otherwise(trimmed)


def trigger_limit(machine: Column, variable: Column) -> Column:
    """Trigger of a machine and variable.

    Every machine with a number that is not in the low group gets the usual
    limit; only a missing machine number falls through to the last one.
    """
    machine, variable = F.upper(F.trim(machine)), F.lower(F.trim(variable))
    pair_machine, pair_variable = LOW_TRIGGER_PAIR
    low = (
        machine.isin(LOW_TRIGGER_MACHINES)
        | ((machine == pair_machine) & (variable == pair_variable))
        | (variable == LOW_TRIGGER_VARIABLE)
    )
    return (
        F.when(low, LOW_TRIGGER)
        .when(machine.isNotNull(), USUAL_TRIGGER)
        .otherwise(OTHER_TRIGGER)
    )


def mean_2(value: Column) -> Column:
    """Mean of decimals, rounded to two digits before any further use."""
    return F.avg(value).try_cast("decimal(10,2)")


def sigma_2(value: Column) -> Column:
    """Population deviation, rounded to two digits before any further use."""
    return steady_decimal(F.stddev_pop(value), 10, 2)


def capability(lcl: Column, ucl: Column, spec_lcl: Column, mean: Column, sigma: Column) -> Column:
    """Process capability index.

    With a lower limit of zero the nearer side counts; otherwise only the upper
    side does.  Without spread there is no index.
    """
    mean, spread = mean.cast("double"), (3 * sigma).cast("double")
    upper = F.try_divide(ucl - mean, spread)
    nearer = F.least(F.try_divide(F.abs(ucl - mean), spread), F.try_divide(mean - lcl, spread))
    index = F.when(spec_lcl == 0, nearer).otherwise(upper)
    return index.try_cast("decimal(10,2)")


def capability_between(lcl: float, ucl: float, mean: Column, sigma: Column) -> Column:
    """Capability against two fixed limits, without sign; only for a positive mean."""
    mean, spread = mean.cast("double"), (3 * sigma).cast("double")
    nearer = F.least(
        F.try_divide(F.abs(F.lit(float(ucl)) - mean), spread),
        F.try_divide(mean - F.lit(float(lcl)), spread),
    )
    return F.when(mean > 0, F.abs(nearer.try_cast("decimal(10,2)")))
