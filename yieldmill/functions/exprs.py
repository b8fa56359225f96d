"""Small column helpers shared by the plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_zero(value: Column | str) -> Column:
    """NULL counts as zero."""
    column = F.col(value) if isinstance(value, str) else value
    return F.coalesce(column, F.lit(0).cast("decimal(15,5)"))


def valid_move(input_qty: str = "INPUT", output_qty: str = "OUTPUT") -> Column:
    """Moves with a positive input and an output that is not negative.

    A NULL input counts as zero and so never passes; stated on the bare columns
    the test reaches the source.
    """
    return (F.col(input_qty) > 0) & (F.col(output_qty) >= 0)


def differs_or_null(value: Column | str, excluded: str) -> Column:
    """Not equal to ``excluded``, where NULL passes."""
    column = F.col(value) if isinstance(value, str) else value
    return ~column.eqNullSafe(F.lit(excluded))


def same_or_both_null(left: Column, right: Column, zero_is_null: bool = False) -> Column:
    """Key equality in which two NULLs match.

    ``zero_is_null`` also lets NULL match a stored 0, for targets that keep 0 as
    the missing key.
    """
    if zero_is_null:
        return F.coalesce(left, F.lit(0)) == F.coalesce(right, F.lit(0))
    return left.eqNullSafe(right)


def steady_decimal(value: Column, precision: int, scale: int) -> Column:
    """Floating result as a decimal, NULL when it does not fit.

    Sums of doubles vary in the last bits with the order of the partial results.
    Rounding to nine digits first keeps values on a rounding tie stable.
    """
    return F.round(value, 9).try_cast(f"decimal({precision},{scale})")


def text_number(value: Column | str, precision: int = 10, scale: int = 2) -> Column:
    """Number written as text, NULL when it is none or does not fit."""
    column = F.col(value) if isinstance(value, str) else value
    return column.try_cast(f"decimal({precision},{scale})")


def machine_code(name: Column | str) -> Column:
    """Machine number: the first six characters in upper case."""
    column = F.col(name) if isinstance(name, str) else name
    return F.upper(F.substring(column, 1, 6))


def rec_id(keys: Sequence[str] | None = None) -> Column:
    """Record id.

    With ``keys`` it is a hash of them and so the same on every run and retry;
    without, a random id that changes each time Spark computes the row.
    """
    if not keys:
        return F.concat(F.lit("REC_"), F.expr("uuid()"))
    parts = [F.coalesce(F.col(key).cast("string"), F.lit("\u0000")) for key in keys]
    return F.concat(F.lit("REC_"), F.sha2(F.concat_ws("\u0001", *parts), 256))
