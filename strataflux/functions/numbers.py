"""Number tests and conversions that never throw, with ANSI mode on or off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegralType, StringType


# Characters no plain decimal number has. Spark's cast takes type suffixes, hexadecimal notation and
# names such as NaN besides; of what it takes, these tell such texts from plain numbers.
OTHER_CHARACTER = r"[^\s0-9eE+.-]"
WHOLE = r"^\s*[+-]?([0-9]+(\.0*)?|\.0+)\s*$"


def is_plain(column: Column) -> Column:
    return ~column.cast("string").rlike(OTHER_CHARACTER)


def as_number(column: Column) -> Column:
    """The double a text holds as a plain decimal number, NULL when it holds none."""
    return F.when(is_plain(column), column.try_cast("double"))


def as_exact(column: Column) -> Column:
    """The decimal a text holds; digits beyond a double's 53 bits are kept."""
    return F.when(is_plain(column), F.trim(column).try_cast("decimal(38,18)"))


def is_whole(column: Column) -> Column:
    """True for a text that holds a whole number, such as 7, 07, 7.0 or 70e-1.

    Decided on the digits, so a fraction too small for any number type still counts.
    """
    text = F.trim(column.cast("string"))
    mantissa = "^[+-]?([0-9]*)\\.?([0-9]*)[eE]"
    fraction = F.regexp_extract(text, mantissa, 2)
    digits = F.concat(F.regexp_extract(text, mantissa, 1), fraction)
    exponent = F.regexp_extract(text, "[eE]([+-]?[0-9]+)$", 1).try_cast("int")
    kept = F.length(F.regexp_replace(digits, "0+$", ""))
    scaled = (kept == 0) | (F.length(fraction) - exponent <= F.length(digits) - kept)
    with_exponent = text.rlike("[eE]") & as_number(column).isNotNull()
    whole = F.when(column.cast("string").rlike(WHOLE), True).when(with_exponent, scaled)
    return F.coalesce(whole, F.lit(False))


# Spark orders NaN above infinity, so an upper bound keeps out both. Text is parsed once for
# every mention of the number, hence one comparison where one will do.
INFINITY = float("inf")


def is_finite(column: Column) -> Column:
    """True for a usable number; false for NULL, other text, NaN and the infinities."""
    return F.coalesce(F.abs(as_number(column)) < F.lit(INFINITY), F.lit(False))


def within(column: Column, low: float, high: float) -> Column:
    """True when the column holds a number from low to high, both included."""
    number = column.try_cast("double")
    return F.coalesce((number >= low) & (number <= high) & is_plain(column), F.lit(False))


def above(column: Column, bound: float) -> Column:
    """True when the column holds a finite number greater than the bound."""
    number = column.try_cast("double")
    return F.coalesce((number > bound) & (number < F.lit(INFINITY)) & is_plain(column), F.lit(False))


def conform(column: Column, have: DataType, want: DataType) -> Column:
    """Cast to the wanted type; a value that does not fit becomes NULL.

    Whole-number targets drop the fraction of a text, so ``'359.7'`` is stored as 359; they
    read it as a decimal, so long numbers keep all their digits. A text is a number only as a plain decimal.
    """
    if have == want:
        return column
    if isinstance(have, StringType) and isinstance(want, IntegralType):
        exact = as_exact(column)
        whole = F.when(exact < 0, F.ceil(exact)).otherwise(F.floor(exact))
        return whole.try_cast(want)
    if isinstance(have, StringType) and isinstance(want, (DoubleType, FloatType)):
        return as_number(column).try_cast(want)
    return column.try_cast(want)


def rounded(column: Column, decimals: int) -> Column:
    """Round half up on the decimal reading of a double.

    A sum of doubles differs in its last bits with the order of the rows, which would flip
    values that lie on a tie; eight decimal places hide that noise. Numbers too large for
    the decimal carry no such digits and take the plain rounding.
    """
    exact = F.round(column.try_cast("decimal(38,8)"), decimals).cast("double")
    return F.coalesce(exact, F.round(column, decimals))
