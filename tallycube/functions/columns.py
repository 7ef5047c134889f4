"""Column expressions shared by the operators; all of them stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallycube.schema import RESIDUAL_SUFFIX, VALUE_TYPE


NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# Digits other than zero after the sixth decimal, of a number without an exponent.
MORE_DECIMALS = r"^[+-]?\d*\.\d{6}\d*[1-9]\d*$"
NONZERO = r"^[^eE]*[1-9]"


def clean_number(text: str | Column) -> Column:
    """Number written with blank thousands separators; anything else becomes null.

    A number that the value type cannot hold, being too large or having more decimals, is an error and not a missing
    or a rounded value.
    """
    packed = F.regexp_replace(F.col(text) if isinstance(text, str) else text, " ", "")
    held = packed.try_cast(VALUE_TYPE)
    # With an exponent, the value itself tells: eighteen decimals of it, and that it is not too small for those.
    exact = packed.try_cast("decimal(38,18)")
    kept = F.coalesce(exact == held, F.lit(True)) & ~((held == 0) & packed.rlike(NONZERO))
    whole = held.isNotNull() & kept & ~packed.rlike(MORE_DECIMALS)
    lost = F.raise_error(F.concat(F.lit("number does not fit the value type: "), packed)).cast(VALUE_TYPE)
    return F.when(packed.rlike(NUMBER), F.when(whole, held).otherwise(lost))


def clean_year(text: str | Column) -> Column:
    return (F.col(text) if isinstance(text, str) else text).try_cast("int")


def blank_to_null(code: str | Column) -> Column:
    column = F.col(code) if isinstance(code, str) else code
    return F.when(column != "", column)


def base_code(code: str | Column) -> Column:
    """Residual code without its suffix; other codes stay as they are."""
    return F.regexp_replace(code, r"\.01$", "")


def residual_code(code: str | Column) -> Column:
    return F.concat(code, F.lit(RESIDUAL_SUFFIX))


def strict_sum(value: str | Column) -> Column:
    """Sum that is null as soon as one input is null."""
    return F.when(F.count(F.lit(1)) == F.count(value), F.sum(value))


def lenient_sum(value: str | Column) -> Column:
    """Sum of the values that exist; 0 if none does."""
    return F.coalesce(F.sum(value), F.lit(0))


def relative_change(new: str | Column, old: str | Column) -> Column:
    """(new - old) / old as a double, null for a zero base."""
    a, b = _col(new), _col(old)
    return F.try_divide((a - b).cast("double"), b.cast("double"))


def percent_change(new: str | Column, old: str | Column) -> Column:
    return relative_change(new, old) * 100


def release_text(release: Column, variant: str | Column) -> Column:
    """`release-variant`, or the release alone for a series without variants."""
    return F.concat_ws("-", release, variant)


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
